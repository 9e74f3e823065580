"""Column contracts of the tables the operators read."""

from __future__ import annotations

from pyspark.sql import types as T

# The seven 0-1 audio features shown on radar charts and in profiles. Fixed field names
# of the lookup.
RADAR_FEATURES = (
    "danceability",
    "energy",
    "speechiness",
    "acousticness",
    "instrumentalness",
    "liveness",
    "valence",
)

# Everything the track lookup returns, in the lookup's own order. Fixed field names.
TRACK_FEATURES = (
    "danceability",
    "energy",
    "key",
    "loudness",
    "mode",
    "speechiness",
    "acousticness",
    "instrumentalness",
    "liveness",
    "valence",
    "tempo",
)

# Fixed field names of the artist attributes.
ARTIST_ATTRIBUTES = ("image", "genre", "followers")

_FEATURE_TYPES = {"key": T.IntegerType(), "mode": T.IntegerType()}


def _feature(name: str) -> T.StructField:
    return T.StructField(name, _FEATURE_TYPES.get(name, T.DoubleType()))


def _string(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())


# One row per play. `time` is the UTC wall clock.
PLAYS = T.StructType(
    [
        T.StructField("time", T.TimestampNTZType(), False),
        T.StructField("hour", T.IntegerType(), False),
        _string("username"),
        T.StructField("ms_played", T.LongType(), False),
        _string("track_name"),
        _string("artist_name"),
        _string("album_name"),
        _string("genre"),
        _string("image"),
        T.StructField("followers", T.LongType()),
        *[_feature(name) for name in TRACK_FEATURES],
        _string("spotify_track_uri"),
    ]
)

# A raw account export: text timestamps, long column names, private columns.
RAW_EXPORT = T.StructType(
    [
        _string("ts"),
        T.StructField("ms_played", T.LongType()),
        _string("master_metadata_track_name"),
        _string("master_metadata_album_album_name"),
        _string("master_metadata_album_artist_name"),
        _string("spotify_track_uri"),
        _string("platform"),
        _string("conn_country"),
        _string("ip_addr_decrypted"),
        _string("user_agent_decrypted"),
    ]
)

# The artist lookup before its lists are flattened.
ARTIST_PROFILES = T.StructType(
    [
        _string("artist_id"),
        T.StructField("genres", T.ArrayType(T.StringType())),
        T.StructField("images", T.ArrayType(T.StructType([_string("url")]))),
        T.StructField("followers", T.LongType()),
    ]
)

SONGS = T.StructType(
    [
        _string("person"),
        _string("track_name"),
        _string("artist_name"),
        T.StructField("duration_ms", T.LongType()),
        *[_feature(name) for name in TRACK_FEATURES],
    ]
)

PLAYLIST = T.StructType(
    [
        _string("who"),
        _string("artist_name"),
        _string("track_name"),
        T.StructField("count", T.LongType()),
        T.StructField("time", T.DoubleType()),
        _string("image"),
    ]
)

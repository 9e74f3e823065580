"""From raw account exports to the enriched plays table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions import day_before, file_order, first_per_key
from earshot.functions.columns import day_after
from earshot.schema import ARTIST_ATTRIBUTES, TRACK_FEATURES

# Fixed names and formats of the export.
EXPORT_NAMES = {
    "ts": "time",
    "master_metadata_track_name": "track_name",
    "master_metadata_album_album_name": "album_name",
    "master_metadata_album_artist_name": "artist_name",
}
EXPORT_TIME_SHAPE = "____-__-__T__:__:__Z%"
TRACK_URI_PREFIX = "spotify:track:"
PRIVATE_COLUMNS = (
    "X.1",
    "X",
    "platform",
    "ip_addr_decrypted",
    "conn_country",
    "user_agent_decrypted",
)


def normalise_export(raw: DataFrame, username: str | None = None) -> DataFrame:
    """Rename, parse and strip a raw export; the trailing Z is read as a letter.

    `username` names the owner of the whole export; without it the export's own
    `username` column is kept. A time of another shape is missing, and a play without a
    length is an error.
    """
    private = [name for name in raw.columns if name in PRIVATE_COLUMNS]
    plays = raw.drop(*private).withColumnsRenamed(EXPORT_NAMES)
    length = F.coalesce("ms_played", F.raise_error(F.lit("ms_played is missing")).cast("bigint"))
    # Casting the text is much faster than matching it against a date pattern.
    time = F.when(
        F.col("time").like(EXPORT_TIME_SHAPE),
        F.substring("time", 1, 19).try_cast("timestamp_ntz"),
    )
    plays = plays.withColumns({"time": time, "ms_played": length}).withColumn(
        "hour", F.hour("time")
    )
    return plays if username is None else plays.withColumn("username", F.lit(username))


def track_id(uri: str = "spotify_track_uri") -> Column:
    """The id inside a track URI."""
    return F.regexp_replace(uri, f"^{TRACK_URI_PREFIX}", "")


def first_tracks(plays: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first play row of every track name, with its track id."""
    order = list(order_by or file_order(plays))
    narrow = plays.select("track_name", "spotify_track_uri", *order)
    return first_per_key(narrow, ["track_name"], order).select(
        "track_name", track_id().alias("track_id")
    )


def first_rows(
    plays: DataFrame, key: str, order_by: Sequence[str] | None = None
) -> DataFrame:
    """The first play row of every name, as a state that later exports are merged into:
    the name, the row's place in the order and its URI."""
    order = list(order_by or file_order(plays))
    return first_per_key(plays.select(key, "spotify_track_uri", *order), [key], order)


def merged_dim(
    state: DataFrame, firsts: DataFrame, key: str, attributes: Sequence[str], look_up
) -> DataFrame:
    """A stored dimension with a new export's first rows merged in.

    `state` has what `first_rows` gives and the `attributes`; `firsts` are the new
    export's. Old plays aren't read: a name keeps its attributes unless the new export
    has an earlier row of it. Only names that are new, or whose URI changed, are looked up,
    by `look_up`, which takes rows with the key and `spotify_track_uri` and adds the
    attributes.
    """
    order = file_order(firsts)
    columns = [key, "spotify_track_uri", *order]
    known = state.select(*columns, F.struct(*attributes).alias("_known"), F.lit(0).alias("_new"))
    fresh = firsts.select(*columns, F.lit(1).alias("_new"))
    # Of equal places the stored row counts, as both are the same play.
    first = first_per_key(
        known.unionByName(fresh, allowMissingColumns=True), [key], [*order, "spotify_track_uri", "_new"]
    )
    kept = first.filter("_new = 0").select(*columns, "_known.*")
    looked_up = look_up(first.filter("_new = 1").select(*columns))
    return kept.unionByName(looked_up.select(*columns, *attributes))


def with_features_by_uri(firsts: DataFrame, track_features: DataFrame) -> DataFrame:
    """First rows with the features of their track."""
    known = one_per_id(track_features, "track_id")
    return firsts.withColumn("track_id", track_id()).join(known, "track_id", "left").drop("track_id")


def one_per_id(lookup: DataFrame, key: str) -> DataFrame:
    """A lookup with one row per id, the least of those that repeat it."""
    return first_per_key(lookup, [key], [])


def track_dim(
    plays: DataFrame, track_features: DataFrame, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Features per track name, looked up by the id of the name's first row."""
    return (
        first_tracks(plays, order_by)
        .join(one_per_id(track_features, "track_id"), "track_id", "left")
        .select("track_name", *TRACK_FEATURES)
    )


def attach_track_features(plays: DataFrame, dim: DataFrame) -> DataFrame:
    """Plays with the features of their track name; a missing name matches itself."""
    right = dim.select(F.col("track_name").alias("_track_name"), *TRACK_FEATURES)
    same_name = plays.track_name.eqNullSafe(right._track_name)
    return plays.join(right, same_name, "left").drop("_track_name")


def first_of_list(profiles: DataFrame) -> DataFrame:
    """Artist lookups flattened to the first genre and the first image, if any."""
    return profiles.select(
        "artist_id",
        F.get("genres", F.lit(0)).alias("genre"),
        F.get("images", F.lit(0)).getField("url").alias("image"),
        "followers",
    )


def artist_dim(
    plays: DataFrame,
    track_artists: DataFrame,
    artist_profiles: DataFrame,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Attributes per artist name, looked up by the first artist of its first track."""
    order = list(order_by or file_order(plays))
    narrow = plays.select("artist_name", "spotify_track_uri", *order)
    named = narrow.filter(F.col("artist_name").isNotNull())
    first = first_per_key(named, ["artist_name"], order)
    return with_attributes_by_uri(first, track_artists, artist_profiles).select(
        "artist_name", *ARTIST_ATTRIBUTES
    )


def with_attributes_by_uri(
    firsts: DataFrame, track_artists: DataFrame, artist_profiles: DataFrame
) -> DataFrame:
    """First rows with the attributes of the first artist of their track."""
    known = one_per_id(track_artists.select("track_id", "artist_ids"), "track_id")
    ids = known.select("track_id", F.get("artist_ids", F.lit(0)).alias("artist_id"))
    profiles = one_per_id(artist_profiles, "artist_id")
    return (
        firsts.withColumn("track_id", track_id())
        .join(ids, "track_id", "left")
        .join(first_of_list(profiles), "artist_id", "left")
        .drop("track_id", "artist_id")
    )


def attach_artist_attributes(plays: DataFrame, dim: DataFrame) -> DataFrame:
    """Plays with the image, genre and followers of their artist."""
    return plays.join(dim.select("artist_name", *ARTIST_ATTRIBUTES), "artist_name", "left")


def apply_cutoff(plays: DataFrame, cutoffs: Mapping[str, date | str]) -> DataFrame:
    """Drop a user's plays from their cutoff day on; other users stay whole."""
    for user, day in cutoffs.items():
        plays = plays.filter(~F.col("username").eqNullSafe(user) | day_before(day))
    return plays


def apply_floor(plays: DataFrame, floors: Mapping[str, date | str]) -> DataFrame:
    """Keep a user's plays only after their floor day; other users stay whole."""
    for user, day in floors.items():
        plays = plays.filter(~F.col("username").eqNullSafe(user) | day_after(day))
    return plays

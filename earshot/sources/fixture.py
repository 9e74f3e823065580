"""Play tables derived from the generic test tables, as FIXTURES.md describes.

`events` supplies the plays, `part` the catalogue of tracks and artists. Joins here
carry no broadcast hint: Spark broadcasts the catalogue while its measured size is
under the session's threshold, and otherwise shuffles, where adaptive execution
splits the partition of a track that holds much of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.schema import RADAR_FEATURES, TRACK_FEATURES

USERS = ("user_a", "user_b", "user_c")

# Fixed values of the mapping in FIXTURES.md.
_MULTIPLIERS = dict(zip(RADAR_FEATURES, (13, 17, 19, 29, 31, 41, 43)))


# Stated, so that building a query does not read file footers.
_SCHEMAS = {
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
        "value double, props string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _features() -> list[str]:
    """The mapping's feature columns as SQL over `p_partkey`."""
    columns = {
        name: f"(p_partkey * {multiplier} % 1000) / 1000D"
        for name, multiplier in _MULTIPLIERS.items()
    }
    columns["energy"] = f"IF(p_partkey % 31 != 0, {columns['energy']}, NULL)"
    columns["key"] = "CAST(p_partkey % 12 AS INT)"
    columns["mode"] = "CAST(p_partkey % 2 AS INT)"
    columns["loudness"] = "CAST(-(p_partkey % 60) AS DOUBLE)"
    columns["tempo"] = "IF(p_partkey % 29 != 0, (600 + p_partkey * 37 % 1200) / 10D, NULL)"
    return [f"{columns[name]} AS {name}" for name in TRACK_FEATURES]


_BRAND = "CAST(substring(p_brand, 7) AS BIGINT)"
_TRACK_ID = "CAST(p_partkey AS STRING) AS track_id"
# The integer `k` of the flat JSON objects in `props`; a JSON parser takes four times
# as long and would dominate every query.
_K_PATTERN = '"k" *: *(-?[0-9]+)'


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per track key: names, artist attributes, features, length."""
    named = "p_partkey % 23 != 0"
    return _table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        "p_name AS track_name",
        f"IF({named}, p_brand, NULL) AS artist_name",
        "concat('album ', p_size) AS album_name",
        f"IF({named} AND {_BRAND} % 8 != 0, concat('genre ', {_BRAND} % 6), NULL) AS genre",
        f"IF({named} AND {_BRAND} % 9 != 0, concat('img/', {_BRAND}), NULL) AS image",
        f"IF({named} AND {_BRAND} % 5 != 0, {_BRAND} * 1371, NULL) AS followers",
        *_features(),
        "concat('spotify:track:', p_partkey) AS spotify_track_uri",
        "IF(p_partkey % 37 != 0, 120000 + p_partkey * 700, NULL) AS duration_ms",
    )


def _listening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plays' own columns: when, who, how long and which track key."""
    users = ", ".join(f"'{user}'" for user in USERS)
    return (
        _table(spark, sf_dir, "events")
        .selectExpr(
            "event_id",
            "ts + make_dt_interval(CAST(event_id % 330 AS INT)) AS time",
            f"element_at(array({users}), CAST(user_id % 3 + 1 AS INT)) AS username",
            "CAST(round(value * 1000) AS BIGINT) AS ms_played",
            "user_id % 3 AS _user",
            f"TRY_CAST(regexp_extract(props, '{_K_PATTERN}', 1) AS BIGINT) AS _k",
        )
        .selectExpr("* EXCEPT (_user, _k)", "(_k * _k) div (50 + 200 * _user) AS track_key")
    )


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated plays table, one row per event.

    Catalogue keys are present, so null-safe equality joins the same rows. With plain
    equality Spark would repeat filters on catalogue columns on the other side, where
    every mention of the key searches the event's text again.
    """
    listening = _listening(spark, sf_dir)
    tracks = catalogue(spark, sf_dir).filter(F.col("p_partkey").isNotNull())
    same_key = listening.track_key.eqNullSafe(tracks.p_partkey)
    joined = listening.join(tracks, same_key, "inner")
    return joined.drop("track_key", "p_partkey").withColumn("hour", F.hour("time"))


def raw_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plays as accounts export them; `username` says whose export a row is from."""
    return plays(spark, sf_dir).selectExpr(
        "event_id",
        "username",
        "concat(replace(substring(CAST(time AS STRING), 1, 19), ' ', 'T'), 'Z') AS ts",
        "ms_played",
        "track_name AS master_metadata_track_name",
        "album_name AS master_metadata_album_album_name",
        "artist_name AS master_metadata_album_artist_name",
        "spotify_track_uri",
        "'web' AS platform",
        "'XX' AS conn_country",
        "'0.0.0.0' AS ip_addr_decrypted",
        "'agent' AS user_agent_decrypted",
    )


def track_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The track lookup: features by track id."""
    return _table(spark, sf_dir, "part").selectExpr(_TRACK_ID, *_features())


def track_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The track lookup's other half: the list of a track's artists."""
    return _table(spark, sf_dir, "part").selectExpr(_TRACK_ID, "array(p_brand) AS artist_ids")


def artist_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The artist lookup, with genres and images still as lists."""
    genre = f"array(concat('genre ', {_BRAND} % 6))"
    image = f"array(named_struct('url', concat('img/', {_BRAND})))"
    return (
        _table(spark, sf_dir, "part")
        .select("p_brand")
        .distinct()
        .selectExpr(
            "p_brand AS artist_id",
            f"IF({_BRAND} % 8 != 0, {genre}, CAST(array() AS array<string>)) AS genres",
            f"IF({_BRAND} % 9 != 0, {image}, CAST(array() AS array<struct<url:string>>)) AS images",
            f"IF({_BRAND} % 5 != 0, {_BRAND} * 1371, NULL) AS followers",
        )
    )


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every person's distinct songs, with the position of their first play."""
    features = [F.col(name) for name in TRACK_FEATURES]
    keys = [F.col("username").alias("person"), "track_name", "artist_name", "duration_ms"]
    return (
        plays(spark, sf_dir)
        .filter(F.col("duration_ms").isNotNull())
        .groupBy(*keys, *features)
        .agg(F.min("time").alias("time"))
    )

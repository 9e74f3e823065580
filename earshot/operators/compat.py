"""Two persons' compatibility and joint playlists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions import asc, desc, minutes, top_n, whole
from earshot.functions.columns import MS_PER_MINUTE
from earshot.schema import RADAR_FEATURES

# Fixed value: what playlists show where no song has an image.
DEFAULT_IMAGE = "default_value"


def feature_profile(plays: DataFrame, popularity: str | None = None) -> DataFrame:
    """Mean features per person in long form, with `popularity` as an eighth on request."""
    features = [*RADAR_FEATURES, *([popularity] if popularity else [])]
    means = plays.groupBy(F.col("username").alias("person")).agg(
        *[F.avg(name).alias(name) for name in features]
    )
    return means.unpivot("person", features, "feature", "value")


def compatibility_profile(profile: DataFrame, left: str, right: str) -> DataFrame:
    """Two persons' values per feature next to the full bar of 1 behind them."""

    def of(person: str, name: str):
        return F.max(F.when(F.col("person") == person, F.col("value"))).alias(name)

    return (
        profile.filter(F.col("person").isin(left, right))
        .groupBy("feature")
        .agg(of(left, "left_value"), of(right, "right_value"))
        .withColumn("background", F.lit(1.0))
        .orderBy("feature")
    )


# Parts that a person's artists are dealt into when long lists are cut.
_PARTS = 16


def _first_places(df: DataFrame, keys: Sequence[str], order: list, n: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def _shared(plays: DataFrame, left: str, right: str, n: int) -> DataFrame:
    per_artist = (
        plays.filter(F.col("username").isin(left, right))
        .groupBy("username", "artist_name")
        .agg(F.sum("ms_played").alias("ms"))
        .dropna()
    )
    order = [desc("ms"), asc("artist_name")]
    limit = int(plays.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n > limit:
        # Spark cuts no such list before it shuffles it, so parts of a person are cut first.
        part = F.pmod(F.xxhash64("artist_name"), F.lit(_PARTS))
        per_artist = _first_places(per_artist.withColumn("part", part), ["username", "part"], order, n)
    best = _first_places(per_artist, ["username"], order, n)
    all_ms = F.sum("ms").over(Window.partitionBy("username"))
    pointed = best.select(
        "username",
        "artist_name",
        (F.col("ms") / F.lit(MS_PER_MINUTE)).alias("time"),
        (F.col("ms") / all_ms * 100).alias("points"),
    )

    def of(person: str, column: str, name: str):
        return F.max(F.when(F.col("username") == person, F.col(column))).alias(name)

    # Both lists sit in one frame of at most 2n rows, so meeting on the artist
    # is a grouping; an artist of one list only lacks the other's points.
    return (
        pointed.groupBy("artist_name")
        .agg(
            of(left, "time", "time_left"),
            of(left, "points", "points_left"),
            of(right, "time", "time_right"),
            of(right, "points", "points_right"),
        )
        .dropna()
        .withColumn("score", F.greatest("points_left", "points_right"))
    )


def shared_artists(plays: DataFrame, left: str, right: str, n: int = 100) -> DataFrame:
    """Artists in both persons' top `n`, with time, points and score.

    Points are an artist's share in percent of the time its person gave to the whole
    top `n`; the score is the higher of the two. Each task sends on its own first `n`
    artists of a person while `n` is at most Spark's limit for that
    (`spark.sql.optimizer.windowGroupLimitThreshold`, 1,000). For a larger `n` a person's
    artists are dealt into parts first, and each part sends on its own first `n`.
    """
    return _shared(plays, left, right, n).orderBy(desc("time_left"), asc("artist_name"))


def compatibility_score(plays: DataFrame, left: str, right: str, n: int = 100) -> DataFrame:
    """One row: the summed score as a whole number and how many artists are shared."""
    total = F.coalesce(whole(F.sum("score")), F.lit(0.0)).cast("bigint")
    return _shared(plays, left, right, n).agg(
        total.alias("total_score"), F.count(F.lit(1)).alias("mutual_artists")
    )


def compatibility_artists(
    plays: DataFrame, left: str, right: str, n: int = 100, first: int = 3
) -> DataFrame:
    """The `first` shared artists the left person listened to longest."""
    shared = _shared(plays, left, right, n).select("artist_name", "time_left")
    return top_n(shared, first, desc("time_left"), asc("artist_name"))


def personal_playlist(plays: DataFrame) -> DataFrame:
    """Plays, minutes and picture per person, artist and track, the playlist's input."""
    return (
        plays.dropna(subset=["username", "artist_name", "track_name"])
        .groupBy(F.col("username").alias("who"), "artist_name", "track_name")
        .agg(
            F.count(F.lit(1)).alias("count"),
            minutes().alias("time"),
            F.min("image").alias("image"),
        )
    )


def group_playlist(playlist: DataFrame, persons: Sequence[str], n: int = 15) -> DataFrame:
    """Tracks for several persons: most persons first, then mean plays and minutes."""
    joint = (
        playlist.filter(F.col("who").isin(list(persons)))
        .groupBy("artist_name", "track_name")
        .agg(
            F.count(F.lit(1)).alias("people"),
            whole(F.avg("count")).cast("bigint").alias("avg_count"),
            F.avg("time").alias("avg_time"),
            F.coalesce(F.min("image"), F.lit(DEFAULT_IMAGE)).alias("image"),
        )
    )
    order = [desc("people"), desc("avg_count"), desc("avg_time")]
    return top_n(joint, n, *order, asc("artist_name"), asc("track_name"))

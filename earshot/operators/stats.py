"""One user's listening over a date range.

Every function takes plays already cut to the rows it should describe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions import (
    asc,
    desc,
    file_order,
    first_per_key,
    iso_weekday,
    minutes,
    n_distinct,
    numbered,
    top_n,
    weekday_name,
    whole,
)
from earshot.functions.columns import MS_PER_MINUTE
from earshot.operators.density import density
from earshot.schema import RADAR_FEATURES

PLAYS_COUNT = "songs_played"
MINUTES = "minutes_listened"
_ARTIST_KEYS = ("artist_name", "image", "genre", "followers")


def _minutes_and_plays(plays: DataFrame, keys: Sequence[str], rounded: bool) -> DataFrame:
    total = whole(minutes()) if rounded else minutes()
    return plays.groupBy(*keys).agg(total.alias(MINUTES), F.count(F.lit(1)).alias(PLAYS_COUNT))


def top_tracks(plays: DataFrame, n: int = 5, min_ms: int = 30000) -> DataFrame:
    """The most played tracks among plays longer than `min_ms`, numbered."""
    keys = ("track_name", "artist_name", "album_name", "genre")
    order = [desc(PLAYS_COUNT), desc(MINUTES), *map(asc, keys)]
    long_plays = plays.filter(F.col("ms_played") > min_ms)
    complete = _minutes_and_plays(long_plays, keys, rounded=False).dropna()
    return numbered(top_n(complete, n, *order), *order)


def top_tracks_all_time(plays: DataFrame, n: int = 10) -> DataFrame:
    """The most played tracks with whole minutes, whatever a play's length."""
    keys = ("track_name", "artist_name", "album_name")
    complete = _minutes_and_plays(plays, keys, rounded=True).dropna()
    return top_n(complete, n, desc(PLAYS_COUNT), *map(asc, keys))


def _share(plays: DataFrame, key: Column, name: str) -> DataFrame:
    # At most 24 hours or 7 weekdays reach the window over the whole table.
    per_key = plays.groupBy(key.alias(name)).agg(F.sum("ms_played").alias("_ms"))
    total = F.sum("_ms").over(Window.partitionBy())
    return per_key.select(
        name,
        (F.col("_ms") / F.lit(MS_PER_MINUTE)).alias(MINUTES),
        (total / F.lit(MS_PER_MINUTE)).alias("total_time"),
        (F.col("_ms") / total * 100).alias("repartition"),
    ).orderBy(asc(name))


def hourly_share(plays: DataFrame) -> DataFrame:
    """Minutes per hour of day and their share of the total in percent."""
    return _share(plays, F.col("hour"), "hour")


def weekday_share(plays: DataFrame) -> DataFrame:
    """Minutes per weekday, Monday = 1, and their share of the total in percent."""
    share = _share(plays, iso_weekday(F.to_date("time")), "weekday")
    return share.withColumn("day_of_week", weekday_name("weekday"))


def daily_unique_artists(plays: DataFrame) -> DataFrame:
    """Different artists per day; plays without an artist count as one more."""
    return (
        plays.groupBy(F.to_date("time").alias("date"))
        .agg(n_distinct("artist_name").alias("unique_artists_n"))
        .orderBy("date")
    )


def favourite_artist(plays: DataFrame) -> DataFrame:
    """The artist with the most whole minutes."""
    complete = _minutes_and_plays(plays, _ARTIST_KEYS, rounded=True).dropna()
    return top_n(complete, 1, desc(MINUTES), *map(asc, _ARTIST_KEYS))


def favourite_artist_by_plays(plays: DataFrame, attributes: bool = True) -> DataFrame:
    """The artist with the most plays.

    With `attributes` artists are told apart by image, genre and followers too and
    minutes are whole; without, by name alone and minutes are exact.
    """
    keys = _ARTIST_KEYS if attributes else ("artist_name",)
    complete = _minutes_and_plays(plays, keys, rounded=attributes).dropna()
    return top_n(complete, 1, desc(PLAYS_COUNT), *map(asc, keys))


def _plays_of_favourite(plays: DataFrame, everyone: DataFrame) -> DataFrame:
    name = favourite_artist(plays).select("artist_name").scalar()
    return everyone.filter(F.col("artist_name") == name)


def artist_tempo_range(plays: DataFrame, everyone: DataFrame) -> DataFrame:
    """Slowest and fastest tempo of the favourite artist, over everybody's plays."""
    return (
        _plays_of_favourite(plays, everyone)
        .groupBy("artist_name")
        .agg(F.min("tempo").alias("min_tempo"), F.max("tempo").alias("max_tempo"))
    )


def artist_tempo_density(plays: DataFrame, everyone: DataFrame) -> DataFrame:
    """Density of the favourite artist's tempo, over everybody's plays."""
    return density(_plays_of_favourite(plays, everyone), "tempo")


def top_track_names(plays: DataFrame, n: int = 5) -> DataFrame:
    """The most played track names, whatever a play's length."""
    counts = plays.groupBy("track_name").agg(F.count(F.lit(1)).alias(PLAYS_COUNT)).dropna()
    return top_n(counts, n, desc(PLAYS_COUNT), asc("track_name"))


def top_track_features(
    plays: DataFrame, n: int = 5, order_by: Sequence[str] | None = None
) -> DataFrame:
    """Mean features of the top track names, each taken from its first play."""
    order = list(order_by or file_order(plays))
    names = top_track_names(plays, n).select("track_name")
    narrow = plays.select("track_name", *RADAR_FEATURES, *order)
    of_top = narrow.join(names, "track_name", "left_semi")
    return first_per_key(of_top, ["track_name"], order).agg(
        *[F.avg(name).alias(name) for name in RADAR_FEATURES]
    )


def radar_frame(features: DataFrame) -> DataFrame:
    """A row of ones, a row of zeros and the features, as radar charts want them."""

    def row(position: int, kind: str, values: Sequence[Column]) -> Column:
        named = [value.alias(name) for name, value in zip(RADAR_FEATURES, values)]
        return F.struct(F.lit(position).alias("position"), F.lit(kind).alias("kind"), *named)

    constant = lambda number: [F.lit(number) for _ in RADAR_FEATURES]
    rows = F.array(
        row(1, "max", constant(1.0)),
        row(2, "min", constant(0.0)),
        row(3, "value", [F.col(name) for name in RADAR_FEATURES]),
    )
    return features.select(F.inline(rows))

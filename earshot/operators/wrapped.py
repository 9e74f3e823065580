"""One person's year: weekdays, hours, top artists and tracks, song features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from earshot.functions import (
    asc,
    desc,
    file_order,
    first_per_key,
    iso_weekday,
    minutes,
    numbered,
    strict_mean,
    top_n,
    weekday_name,
    whole,
)
from earshot.functions.columns import months_between
from earshot.operators.density import density
from earshot.operators.stats import radar_frame
from earshot.schema import RADAR_FEATURES


def _in_months(calendar: DataFrame, year: int, first: int, last: int) -> DataFrame:
    month = F.month("date")
    return calendar.filter((F.year("date") == year) & month.between(first, last))


def weekday_average_minutes(
    plays: DataFrame, calendar: DataFrame, year: int, first: int = 1, last: int = 12
) -> DataFrame:
    """Minutes per weekday divided by the number of such days, within the months.

    Only weekdays of months in which something was played count as days.
    """
    plays = plays.filter(months_between(year, first, last))
    day = F.to_date("time")
    keys = {"weekday": iso_weekday(day), "month": F.month(day), "year": F.year(day)}
    played = plays.groupBy(*[value.alias(name) for name, value in keys.items()]).agg(
        F.sum("ms_played").alias("ms")
    )
    days = (
        _in_months(calendar, year, first, last)
        .groupBy(
            iso_weekday(F.col("date")).alias("weekday"),
            F.month("date").alias("month"),
            F.year("date").alias("year"),
        )
        .agg(F.count(F.lit(1)).alias("days"))
    )
    # One year has at most 7 x 12 weekday-month cells.
    return (
        played.join(F.broadcast(days), ["weekday", "month", "year"])
        .groupBy("weekday")
        .agg((minutes("ms") / F.sum("days")).alias("time"))
        .select("weekday", weekday_name("weekday").alias("day_of_week"), "time")
        .orderBy("weekday")
    )


def hourly_average_minutes(
    plays: DataFrame, calendar: DataFrame, year: int, first: int = 1, last: int = 12
) -> DataFrame:
    """Minutes per hour of day divided by the number of calendar days, within the months."""
    plays = plays.filter(months_between(year, first, last))
    days = _in_months(calendar, year, first, last).agg(F.nullif(F.count("date"), F.lit(0)))
    per_hour = plays.groupBy(F.hour("time").alias("hour")).agg(minutes().alias("minutes"))
    return per_hour.select("hour", (F.col("minutes") / days.scalar()).alias("time")).orderBy(
        "hour"
    )


def top_artists(plays: DataFrame, n: int = 10) -> DataFrame:
    """Artists by minutes; plays without an artist take a place before they are dropped."""
    per_artist = plays.groupBy("artist_name").agg(minutes().alias("time"))
    return top_n(per_artist, n, desc("time"), asc("artist_name")).dropna()


def _top_artist(plays: DataFrame) -> Column:
    first = top_n(top_artists(plays), 1, desc("time"), asc("artist_name"))
    return first.select("artist_name").scalar()


def first_track_lengths(songs: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """One length per track name, from the name's first song."""
    order = list(order_by or file_order(songs))
    narrow = songs.select("track_name", "duration_ms", *order)
    return first_per_key(narrow, ["track_name"], order).select("track_name", "duration_ms")


def artist_track_play_equivalents(
    plays: DataFrame, songs: DataFrame, artist: str | None = None, n: int = 10
) -> DataFrame:
    """An artist's tracks by how many full plays the listening time amounts to.

    The artist is the one listened to longest unless named. A track's length is that of
    its name's first song; only songs of the artist's track names are looked through. A
    track without a known length has no figure and comes last.
    """
    chosen = _top_artist(plays) if artist is None else F.lit(artist)
    listened = (
        plays.filter(F.col("artist_name") == chosen)
        .groupBy("artist_name", "track_name")
        .agg(F.sum("ms_played").alias("ms"))
        .dropna()
    )
    times = whole(F.col("ms") / F.col("duration_ms")).cast("bigint")
    lengths = first_track_lengths(songs.join(listened, "track_name", "left_semi"))
    counted = listened.join(lengths, "track_name", "left").select(
        "artist_name", "track_name", times.alias("times_played")
    )
    order = [desc("times_played"), asc("artist_name"), asc("track_name")]
    return numbered(top_n(counted, n, *order), *order, name="lp")


def artist_mean_features(songs: DataFrame) -> DataFrame:
    """Mean features per artist; an artist with any missing value is left out."""
    return (
        songs.groupBy("artist_name")
        .agg(*[strict_mean(name).alias(name) for name in RADAR_FEATURES])
        .dropna()
    )


def artist_radar(plays: DataFrame, songs: DataFrame, artist: str | None = None) -> DataFrame:
    """Radar rows of an artist's mean features, by default of the one heard longest."""
    chosen = _top_artist(plays) if artist is None else F.lit(artist)
    return radar_frame(artist_mean_features(songs.filter(F.col("artist_name") == chosen)))


def top_track_counts(plays: DataFrame, n: int = 10, min_ms: int = 30000) -> DataFrame:
    """Track names by plays longer than `min_ms`, with the short label charts use."""
    counts = (
        plays.filter(F.col("ms_played") > min_ms)
        .groupBy("track_name")
        .agg(F.count(F.lit(1)).alias("times_played"))
        .dropna()
    )
    label = F.substring("track_name", 1, 16).alias("label")
    return top_n(counts, n, desc("times_played"), asc("track_name")).select("*", label)


def feature_distribution(
    songs: DataFrame, person: str, feature: str, heard: DataFrame | None = None
) -> DataFrame:
    """Density of one feature over a person's complete songs, within [0, 1].

    With `heard` only songs whose name occurs in these plays are described.
    """
    if feature not in RADAR_FEATURES:
        raise ValueError(f"unknown feature {feature!r}, expected one of {RADAR_FEATURES}")
    chosen = songs.filter(F.col("person") == person)
    if heard is not None:
        names = heard.select(F.col("track_name").alias("_heard"))
        chosen = chosen.join(names, chosen.track_name.eqNullSafe(names._heard), "left_semi")
    complete = chosen.select(*RADAR_FEATURES).dropna()
    return density(complete.filter(F.col(feature).between(0, 1)), feature)

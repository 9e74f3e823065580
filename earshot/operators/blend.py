"""Comparing users over a date range."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions import asc, desc, minutes, n_distinct, whole
from earshot.functions.columns import MS_PER_MINUTE


def rank_listening_time(plays: DataFrame) -> DataFrame:
    """Users by minutes listened."""
    total = plays.groupBy("username").agg(minutes().alias("minutes_listened"))
    return total.orderBy(desc("minutes_listened"), asc("username"))


def rank_average_tempo(plays: DataFrame) -> DataFrame:
    """Users by the mean tempo of their plays."""
    means = plays.groupBy("username").agg(F.avg("tempo").alias("average_tempo"))
    return means.orderBy(desc("average_tempo"), asc("username"))


def rank_artist_count(plays: DataFrame) -> DataFrame:
    """Users by number of different artists; a missing artist counts as one."""
    counts = plays.groupBy("username").agg(n_distinct("artist_name").alias("artists_number"))
    return counts.orderBy(desc("artists_number"), asc("username"))


def rank_average_followers(plays: DataFrame) -> DataFrame:
    """Users by the mean followers of their artists, each artist counting once."""
    per_artist = plays.groupBy("username", "artist_name").agg(
        F.avg("followers").alias("followers")
    )
    mean = whole(F.avg("followers")).cast("bigint")
    return (
        per_artist.groupBy("username")
        .agg(mean.alias("average_followers_n"))
        .orderBy(desc("average_followers_n"), asc("username"))
    )


def favourite_genre(plays: DataFrame) -> DataFrame:
    """Every user's most frequent genre, the alphabetically first of equals.

    Missing genres are ignored; a user without any genre is left out.
    """
    counts = (
        plays.filter(F.col("genre").isNotNull())
        .groupBy("username", "genre")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.row_number().over(Window.partitionBy("username").orderBy(desc("n"), asc("genre")))
    return (
        counts.withColumn("place", best)
        .filter("place = 1")
        .select("username", F.col("genre").alias("fav_genre"))
        .orderBy(asc("username"))
    )


def rankings(plays: DataFrame) -> DataFrame:
    """All five measures of every user in one row, from one pass over the plays.

    Plays are added up per user, artist and genre; those sums once per artist and once
    per genre (two grouping sets of one aggregation), and these per user. Sums of a user
    are taken from the sets by artist, the genre from the others.
    """
    finest = plays.groupBy("username", "artist_name", "genre").agg(
        F.sum("ms_played").alias("ms"),
        F.count(F.lit(1)).alias("n"),
        F.sum("tempo").alias("tempo"),
        F.count("tempo").alias("n_tempo"),
        F.sum("followers").alias("followers"),
        F.count("followers").alias("n_followers"),
    )
    sums = [F.sum(name).alias(name) for name in ("ms", "n", "tempo", "n_tempo", "followers", "n_followers")]
    sets = [["username", "artist_name"], ["username", "genre"]]
    columns = [F.col(name) for name in ("username", "artist_name", "genre")]
    both = finest.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.grouping("genre").alias("by_artist"), *sums
    )
    by_artist = F.col("by_artist") == 1

    def total(name: str) -> Column:
        return F.sum(F.when(by_artist, F.col(name)))

    per_artist = F.when(by_artist, F.col("followers") / F.nullif(F.col("n_followers"), F.lit(0)))
    common = F.when(~by_artist & F.col("genre").isNotNull(), F.struct((-F.col("n")).alias("less"), "genre"))
    return (
        both.groupBy("username")
        .agg(
            (total("ms") / F.lit(MS_PER_MINUTE)).alias("minutes_listened"),
            (total("tempo") / F.nullif(total("n_tempo"), F.lit(0))).alias("average_tempo"),
            F.count_if(by_artist).alias("artists_number"),
            whole(F.avg(per_artist)).cast("bigint").alias("average_followers_n"),
            F.min(common).getField("genre").alias("fav_genre"),
        )
        .orderBy(asc("username"))
    )


RANKINGS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "listening_time": rank_listening_time,
    "average_tempo": rank_average_tempo,
    "artist_count": rank_artist_count,
    "average_followers": rank_average_followers,
    "favourite_genre": favourite_genre,
}


def rank(plays: DataFrame, metric: str) -> DataFrame:
    """One of the rankings by name."""
    if metric not in RANKINGS:
        raise ValueError(f"unknown metric {metric!r}, expected one of {sorted(RANKINGS)}")
    return RANKINGS[metric](plays)


def mutual_items(
    plays: DataFrame, keys: Sequence[str], users: Sequence[str], threshold: int
) -> DataFrame:
    """Items that each of the named users played more than `threshold` times.

    One column of plays per user, `n_<user>`, and their sum `total`. Users whose names
    differ only in case can't both have a column; use `mutual_items_of_everyone`.
    """
    if len({user.lower() for user in users}) < len(users):
        raise ValueError(f"user names must differ in more than case: {sorted(users)}")
    # Counted by position, as a name may hold dots or backticks.
    counts = [F.count_if(F.col("username") == user).alias(f"_{i}") for i, user in enumerate(users)]
    places = [F.col(f"_{i}") for i in range(len(users))]
    return (
        plays.filter(F.col("username").isin(list(users)))
        .groupBy(*keys)
        .agg(*counts)
        .filter(reduce(and_, [place > threshold for place in places]))
        .select(
            *keys,
            *[place.alias(f"n_{user}") for place, user in zip(places, users)],
            reduce(add, places).alias("total"),
        )
    )


def mutual_items_of_everyone(plays: DataFrame, keys: Sequence[str], threshold: int) -> DataFrame:
    """Items that every user in `plays` played more than `threshold` times.

    Counts per item and user are compared with the number of users, so the number of
    columns does not depend on who is there. Both come from one aggregation: the number
    of users is taken from the counts, which is why it mentions `n`.
    """
    counts = (
        plays.filter(F.col("username").isNotNull())
        .groupBy(*keys, "username")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    everyone = counts.agg(F.count_distinct(F.when(F.col("n") > 0, F.col("username")))).scalar()
    return (
        counts.filter(F.col("n") > threshold)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("users"), F.sum("n").alias("total"))
        .filter(F.col("users") == everyone)
    )


def mutual_artist(plays: DataFrame, users: Sequence[str], threshold: int = 30) -> DataFrame:
    """The alphabetically first artist all users played often; no row if there is none."""
    found = mutual_items(plays, ["artist_name"], users, threshold)
    return found.dropna(subset=["artist_name"]).orderBy("artist_name").limit(1)


def mutual_track(plays: DataFrame, users: Sequence[str], threshold: int = 10) -> DataFrame:
    """The first track, by artist and name, that all users played often."""
    found = mutual_items(plays, ["artist_name", "track_name"], users, threshold)
    named = found.dropna(subset=["track_name"])
    return named.orderBy(asc("artist_name"), asc("track_name")).limit(1)


def cumulative_minutes(plays: DataFrame) -> DataFrame:
    """Minutes per user and day with a running total, which starts with the first play given."""
    per_day = plays.groupBy("username", F.to_date("time").alias("date")).agg(
        F.sum("ms_played").alias("ms")
    )
    so_far = (
        Window.partitionBy("username")
        .orderBy("date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return per_day.select(
        F.col("username").alias("name"),
        "date",
        (F.col("ms") / F.lit(MS_PER_MINUTE)).alias("total_minutes"),
        (F.sum("ms").over(so_far) / F.lit(MS_PER_MINUTE)).alias("cumsum"),
    ).orderBy("name", "date")

"""Relations between results that must hold on the test tables."""

import pytest
from pyspark.sql import functions as F

from earshot.operators import blend, compat, stats
from earshot.operators.filters import all_plays_in_range, user_plays
from earshot.plans import panels
from earshot.sources import calendar, fixture

START, END = "2024-01-01", "2024-12-31"


@pytest.fixture(scope="module")
def plays(spark, sf_dir):
    return fixture.plays(spark, sf_dir).persist()


@pytest.fixture(scope="module")
def ranged(plays):
    return all_plays_in_range(plays, START, END)


def _one(df):
    return df.collect()[0][0]


def test_every_event_is_a_play(spark, sf_dir, plays):
    assert plays.count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()


@pytest.mark.parametrize("share", [stats.hourly_share, stats.weekday_share])
def test_shares_sum_to_a_hundred(plays, share):
    own = user_plays(plays, "user_b", START, END)
    assert _one(share(own).agg(F.sum("repartition"))) == pytest.approx(100)


def test_last_running_total_is_the_users_ranking(ranged):
    totals = {r.username: r.minutes_listened for r in blend.rank_listening_time(ranged).collect()}
    running = blend.cumulative_minutes(ranged).groupBy("name").agg(F.max("cumsum").alias("c"))
    assert {r.name: r.c for r in running.collect()} == pytest.approx(totals)


def test_compatibility_is_symmetric_and_bounded(plays):
    there = compat.compatibility_score(plays, "user_a", "user_c").collect()[0]
    back = compat.compatibility_score(plays, "user_c", "user_a").collect()[0]
    assert there == back
    assert 0 <= there.total_score <= 200


def test_mutual_forms_agree(ranged):
    named = blend.mutual_items(ranged, ["artist_name"], fixture.USERS, 30)
    everyone = blend.mutual_items_of_everyone(ranged, ["artist_name"], 30)
    columns = ["artist_name", "total"]
    assert sorted(map(tuple, named.select(columns).collect()), key=repr) == sorted(
        map(tuple, everyone.select(columns).collect()), key=repr
    )


def test_partitioning_does_not_change_first_rows(ranged):
    own = ranged.filter("username = 'user_a'")
    once = stats.top_track_features(own).collect()
    again = stats.top_track_features(own.repartition(7, "event_id")).collect()
    assert once == again


def test_panels_compute(spark, sf_dir, plays):
    from datetime import date

    songs = fixture.songs(spark, sf_dir)
    days = calendar(spark, date(2024, 1, 1), date(2024, 12, 31))
    profile = compat.feature_profile(plays)
    frames = {
        **panels.user_panel(plays, "user_a", START, END),
        **panels.blend_panel(plays, fixture.USERS, START, END, {"user_c": "2024-12-08"}),
        **panels.wrapped_panel(plays, songs, days, "user_b", 2024, 2, 8),
        **panels.compatibility_panel(plays, profile, "user_a", "user_b"),
    }
    empty = [name for name, frame in frames.items() if frame.isEmpty()]
    assert not empty

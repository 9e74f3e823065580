"""The semantics that differ from Spark's defaults, on hand-written plays."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from earshot.functions import first_per_key, months_between, n_distinct, strict_mean, whole
from earshot.operators import blend, compat, filters, stats, wrapped
from earshot.operators.prepare import apply_cutoff, apply_floor
from earshot.schema import PLAYLIST
from earshot.sources import calendar


def test_both_ends_of_a_day_range_are_exclusive(make_plays):
    plays = make_plays(
        {"time": "2024-01-01 23:59:59", "track_name": "on start"},
        {"time": "2024-01-02 00:00:00", "track_name": "first inside"},
        {"time": "2024-01-09 23:59:59", "track_name": "last inside"},
        {"time": "2024-01-10 00:00:00", "track_name": "on end"},
    )
    inside = filters.all_plays_in_range(plays, "2024-01-01", date(2024, 1, 10))
    assert {row.track_name for row in inside.collect()} == {"first inside", "last inside"}


def test_user_plays_are_one_users(make_plays):
    plays = make_plays({"username": "ann"}, {"username": "bob"}, {"username": None})
    assert filters.user_plays(plays, "ann", "2024-01-01", "2024-12-31").count() == 1


def test_month_range_is_inclusive(make_plays):
    plays = make_plays(
        {"time": "2024-02-29 23:59:59"},
        {"time": "2024-03-01 00:00:00"},
        {"time": "2024-12-31 23:59:59"},
        {"time": "2025-03-01 00:00:00"},
    )
    assert filters.plays_by_months(plays, "ann", 2024, 3, 12).count() == 2
    assert filters.plays_by_months(plays, "ann", 2024, 2, 2).count() == 1
    assert filters.plays_by_months(plays, "ann", 2024, 5, 4).count() == 0
    with pytest.raises(ValueError):
        months_between(2024, 0, 3)


def test_cutoff_touches_one_user_and_keeps_nameless_plays(make_plays):
    plays = make_plays(
        {"username": "ann", "time": "2024-05-01 00:00:00"},
        {"username": "ann", "time": "2024-04-30 23:59:59"},
        {"username": "bob", "time": "2024-06-01 00:00:00"},
        {"username": None, "time": "2024-06-01 00:00:00"},
    )
    kept = apply_cutoff(plays, {"ann": "2024-05-01"})
    assert sorted(str(r.username) for r in kept.collect()) == ["None", "ann", "bob"]


def test_floor_day_itself_is_dropped(make_plays):
    plays = make_plays({"time": "2024-05-01 23:59:59"}, {"time": "2024-05-02 00:00:00"})
    assert apply_floor(plays, {"ann": "2024-05-01"}).count() == 1


def test_missing_counts_as_one_distinct_value(make_plays, rows):
    plays = make_plays({"artist_name": "x"}, {"artist_name": "x"}, {"artist_name": None})
    assert rows(plays.agg(n_distinct("artist_name"))) == [(2,)]
    assert rows(stats.daily_unique_artists(plays)) == [(date(2024, 3, 5), 2)]
    assert rows(blend.rank(plays, "artist_count")) == [("ann", 2)]


def test_halves_round_to_even(spark, rows):
    frame = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-2.5,)], "x double")
    assert [r[0] for r in rows(frame.select(whole(F.col("x"))))] == [0.0, 2.0, 2.0, -2.0]


def test_strict_mean_is_missing_with_any_missing_value(spark, rows):
    frame = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 3.0)], "k string, x double")
    means = frame.groupBy("k").agg(strict_mean("x").alias("x"))
    assert sorted(rows(means)) == [("a", None), ("b", 3.0)]


def test_first_per_key_follows_the_export_order(make_plays):
    plays = make_plays(
        {"track_name": "t", "time": "2024-03-05 11:00:00", "album_name": "later"},
        {"track_name": "t", "time": "2024-03-05 10:00:00", "album_name": "earlier"},
        {"track_name": None, "album_name": "nameless"},
    )
    first = first_per_key(plays, ["track_name"])
    assert {r.album_name for r in first.collect()} == {"earlier", "nameless"}


def test_top_tracks_drop_missing_before_cutting(make_plays, rows):
    many = [{"track_name": "unknown", "genre": None}] * 3
    plays = make_plays(
        *many,
        {"track_name": "b"},
        {"track_name": "a"},
        {"track_name": "a", "ms_played": 30000},
    )
    top = stats.top_tracks(plays, n=2)
    assert [r[:2] for r in rows(top)] == [(1, "a"), (2, "b")]
    assert [r.songs_played for r in top.collect()] == [1, 1]


def test_top_tracks_order_by_plays_then_minutes(make_plays):
    plays = make_plays(
        {"track_name": "short", "ms_played": 40000},
        {"track_name": "long", "ms_played": 90000},
        {"track_name": "often"},
        {"track_name": "often"},
    )
    assert [r.track_name for r in stats.top_tracks(plays).collect()] == ["often", "long", "short"]


def test_top_artists_cut_before_dropping_missing(make_plays):
    plays = make_plays(
        {"artist_name": None, "ms_played": 900000},
        {"artist_name": "a"},
        {"artist_name": "b"},
    )
    assert [r.artist_name for r in wrapped.top_artists(plays, n=2).collect()] == ["a"]


def test_favourite_artist_is_ranked_by_whole_minutes(make_plays):
    plays = make_plays(
        {"artist_name": "z", "ms_played": 119000},
        {"artist_name": "a", "ms_played": 100000},
        {"artist_name": "no image", "image": None, "ms_played": 900000},
    )
    # 1.98 and 1.67 minutes both are 2, so the name decides.
    favourite = stats.favourite_artist(plays).collect()
    assert [(r.artist_name, r.minutes_listened) for r in favourite] == [("a", 2.0)]


def test_favourite_artist_by_plays(make_plays):
    plays = make_plays(
        {"artist_name": "long", "ms_played": 900000},
        {"artist_name": "often", "image": "1"},
        {"artist_name": "often", "image": "2"},
    )
    by_name = stats.favourite_artist_by_plays(plays, attributes=False).collect()
    assert [(r.artist_name, r.songs_played) for r in by_name] == [("often", 2)]
    # With attributes the artist splits, and all are equal at one play.
    assert stats.favourite_artist_by_plays(plays).collect()[0].artist_name == "long"


def test_tempo_range_uses_everybodys_plays(make_plays, rows):
    everyone = make_plays(
        {"artist_name": "fav", "tempo": 100.0},
        {"artist_name": "fav", "username": "bob", "tempo": 180.0},
        {"artist_name": "other", "username": "bob", "tempo": 60.0},
    )
    own = everyone.filter("username = 'ann'")
    assert rows(stats.artist_tempo_range(own, everyone)) == [("fav", 100.0, 180.0)]


def test_no_favourite_means_no_rows(make_plays):
    everyone = make_plays({"image": None, "tempo": 1.0})
    assert stats.artist_tempo_range(everyone, everyone).count() == 0
    assert stats.artist_tempo_density(everyone, everyone).count() == 0


def test_top_track_features_come_from_the_first_play(make_plays):
    plays = make_plays(
        {"track_name": "t", "time": "2024-03-05 12:00:00", "valence": 0.9},
        {"track_name": "t", "time": "2024-03-05 10:00:00", "valence": 0.1},
        {"track_name": "u", "valence": 0.3},
        {"track_name": "v", "valence": None},
        {"track_name": None, "valence": 1.0},
    )
    features = stats.top_track_features(plays).collect()[0]
    assert features.valence == pytest.approx(0.2)
    assert features.energy is None


def test_radar_frame_starts_with_ones_and_zeros(make_plays):
    frame = stats.radar_frame(stats.top_track_features(make_plays({"valence": 0.25})))
    assert [(r.kind, r.valence) for r in frame.collect()] == [
        ("max", 1.0),
        ("min", 0.0),
        ("value", 0.25),
    ]


def test_hours_without_plays_have_no_row(make_plays, rows):
    plays = make_plays(
        {"time": "2024-03-05 10:00:00", "ms_played": 60000},
        {"time": "2024-03-05 22:30:00", "ms_played": 180000},
    )
    assert rows(stats.hourly_share(plays)) == [(10, 1.0, 4.0, 25.0), (22, 3.0, 4.0, 75.0)]


def test_weeks_start_on_monday(make_plays):
    plays = make_plays({"time": "2024-03-04 10:00:00"}, {"time": "2024-03-10 10:00:00"})
    days = [(r.weekday, r.day_of_week) for r in stats.weekday_share(plays).collect()]
    assert days == [(1, "Monday"), (7, "Sunday")]


def test_rankings_put_missing_last(make_plays, rows):
    plays = make_plays({"username": "ann", "tempo": None}, {"username": "bob", "tempo": 90.0})
    assert rows(blend.rank(plays, "average_tempo")) == [("bob", 90.0), ("ann", None)]
    with pytest.raises(ValueError):
        blend.rank(plays, "loudest")


def test_average_followers_count_every_artist_once(make_plays, rows):
    plays = make_plays(
        *[{"artist_name": "big", "followers": 100}] * 3,
        {"artist_name": "small", "followers": 1},
        {"artist_name": "unknown", "followers": None},
    )
    # The mean of 100 and 1 is 50.5, which rounds to the even 50.
    assert rows(blend.rank(plays, "average_followers")) == [("ann", 50)]


def test_favourite_genre_ignores_missing_and_breaks_ties_by_name(make_plays, rows):
    plays = make_plays(
        {"genre": "rock"},
        {"genre": "jazz"},
        {"genre": None},
        {"genre": None},
        {"username": "bob", "genre": None},
    )
    assert rows(blend.rank(plays, "favourite_genre")) == [("ann", "jazz")]


def _played(counts):
    return [
        {"username": user, "artist_name": artist}
        for (user, artist), n in counts.items()
        for _ in range(n)
    ]


def test_mutual_artist_is_the_alphabetically_first(make_plays, rows):
    plays = make_plays(
        *_played({("ann", "b"): 3, ("bob", "b"): 3, ("ann", "c"): 9, ("bob", "c"): 9}),
        *_played({("ann", "a"): 9, ("bob", "a"): 2, ("eve", "b"): 9}),
        *_played({("ann", None): 9, ("bob", None): 9}),
    )
    users = ["ann", "bob"]
    assert rows(blend.mutual_artist(plays, users, 2)) == [("b", 3, 3, 6)]
    assert rows(blend.mutual_artist(plays, users, 9)) == []
    assert rows(blend.mutual_artist(plays, [*users, "eve"], 2)) == [("b", 3, 3, 9, 15)]


def test_mutual_track_keeps_a_missing_artist_last(make_plays, rows):
    both = [{"artist_name": None, "username": u, "track_name": "t"} for u in ("ann", "bob")]
    plays = make_plays(*both)
    assert rows(blend.mutual_track(plays, ["ann", "bob"], 0)) == [(None, "t", 1, 1, 2)]
    named = [{"artist_name": "z", "username": u, "track_name": "u"} for u in ("ann", "bob")]
    first = blend.mutual_track(make_plays(*both, *named), ["ann", "bob"], 0)
    assert [r.track_name for r in first.collect()] == ["u"]


def test_mutual_items_of_everyone_equal_the_named_form(make_plays):
    plays = make_plays(
        *_played({("ann", "b"): 3, ("bob", "b"): 3, ("ann", "c"): 1, ("bob", "c"): 9})
    )
    everyone = blend.mutual_items_of_everyone(plays, ["artist_name"], 2).collect()
    assert [(r.artist_name, r.users, r.total) for r in everyone] == [("b", 2, 6)]


def test_running_total_restarts_with_the_range_and_per_user(make_plays, rows):
    plays = make_plays(
        {"time": "2024-01-01 10:00:00"},
        {"time": "2024-01-02 10:00:00"},
        {"time": "2024-01-04 10:00:00", "ms_played": 30000},
        {"time": "2024-01-04 11:00:00", "username": "bob"},
    )
    ranged = filters.all_plays_in_range(plays, "2024-01-01", "2024-02-01")
    assert rows(blend.cumulative_minutes(ranged)) == [
        ("ann", date(2024, 1, 2), 1.0, 1.0),
        ("ann", date(2024, 1, 4), 0.5, 1.5),
        ("bob", date(2024, 1, 4), 1.0, 1.0),
    ]


def test_weekday_average_divides_by_days_of_heard_months_only(spark, make_plays, rows):
    # January 2024 has five Mondays; other months are not heard on Mondays.
    plays = make_plays(
        {"time": "2024-01-01 10:00:00", "ms_played": 600000},
        {"time": "2024-02-06 10:00:00", "ms_played": 240000},
    )
    days = calendar(spark, date(2024, 1, 1), date(2024, 12, 31))
    assert rows(wrapped.weekday_average_minutes(plays, days, 2024)) == [
        (1, "Monday", 2.0),
        (2, "Tuesday", 1.0),
    ]


def test_hourly_average_divides_by_all_days_of_the_months(spark, make_plays, rows):
    plays = make_plays({"time": "2024-02-06 10:00:00", "ms_played": 60000 * 29})
    days = calendar(spark, date(2024, 1, 1), date(2024, 12, 31))
    assert rows(wrapped.hourly_average_minutes(plays, days, 2024, 2, 2)) == [(10, 1.0)]
    assert rows(wrapped.hourly_average_minutes(plays, days, 2023)) == []


SONGS = (
    "person string, track_name string, artist_name string, duration_ms bigint, "
    "danceability double, energy double, speechiness double, acousticness double, "
    "instrumentalness double, liveness double, valence double, time timestamp_ntz"
)


def _song(person, track, artist, duration, valence, energy=0.5, day=1):
    from datetime import datetime

    plain = (0.5, energy, 0.5, 0.5, 0.5, 0.5, valence)
    return (person, track, artist, duration, *plain, datetime(2024, 1, day))


def test_unknown_track_length_is_kept_and_sorted_last(spark, make_plays, rows):
    plays = make_plays(
        {"track_name": "known", "ms_played": 250000},
        {"track_name": "unknown", "ms_played": 900000},
        {"track_name": "other artist's", "artist_name": "x"},
    )
    songs = spark.createDataFrame(
        [
            _song("bob", "known", "somebody", 100000, 0.1, day=1),
            _song("ann", "known", "artist", 10000, 0.1, day=2),
        ],
        SONGS,
    )
    expected = [(1, "artist", "known", 2), (2, "artist", "unknown", None)]
    assert rows(wrapped.artist_track_play_equivalents(plays, songs)) == expected
    named = wrapped.artist_track_play_equivalents(plays, songs, artist="x")
    assert rows(named) == [(1, "x", "other artist's", None)]


def test_artist_with_a_missing_feature_is_left_out(spark):
    songs = spark.createDataFrame(
        [
            _song("ann", "t", "whole", 1, 0.2),
            _song("ann", "u", "whole", 1, 0.4),
            _song("ann", "v", "holey", 1, 0.4),
            _song("ann", "w", "holey", 1, 0.4, energy=None),
        ],
        SONGS,
    )
    means = wrapped.artist_mean_features(songs).collect()
    assert [r.artist_name for r in means] == ["whole"]
    assert means[0].valence == pytest.approx(0.3)


def test_artist_radar_defaults_to_the_top_artist(spark, make_plays):
    plays = make_plays({"artist_name": "top", "ms_played": 99000}, {"artist_name": "less"})
    songs = spark.createDataFrame(
        [_song("ann", "t", "top", 1, 0.2), _song("ann", "u", "less", 1, 0.4)], SONGS
    )
    assert [r.valence for r in wrapped.artist_radar(plays, songs).collect()] == [1.0, 0.0, 0.2]


def test_top_track_counts_label_is_short(make_plays, rows):
    plays = make_plays(
        {"track_name": "a very long track name"},
        {"track_name": "a very long track name", "ms_played": 30000},
        {"track_name": None},
    )
    assert rows(wrapped.top_track_counts(plays)) == [
        ("a very long track name", 1, "a very long trac")
    ]


def test_feature_distribution_limits_and_restriction(spark, make_plays):
    songs = spark.createDataFrame(
        [
            _song("ann", "a", "x", 1, 0.2),
            _song("ann", "b", "x", 1, 0.4),
            _song("ann", "c", "x", 1, 0.8),
            _song("ann", "too loud", "x", 1, 1.5),
            _song("ann", "incomplete", "x", 1, 0.9, energy=None),
            _song("bob", "d", "x", 1, 1.0),
        ],
        SONGS,
    )
    everything = wrapped.feature_distribution(songs, "ann", "valence").orderBy("x").collect()
    assert (everything[0].x, everything[-1].x) == (0.2, pytest.approx(0.8))
    heard = make_plays({"track_name": "a"}, {"track_name": "b"})
    some = wrapped.feature_distribution(songs, "ann", "valence", heard).orderBy("x").collect()
    assert (some[0].x, some[-1].x) == (0.2, pytest.approx(0.4))
    with pytest.raises(ValueError):
        wrapped.feature_distribution(songs, "ann", "tempo")


def test_compatibility_counts_shared_top_artists(make_plays, rows):
    plays = make_plays(
        {"artist_name": "s", "ms_played": 60000},
        {"artist_name": "only ann", "ms_played": 180000},
        {"artist_name": "s", "username": "bob", "ms_played": 30000},
        {"artist_name": "t", "username": "bob", "ms_played": 30000},
        {"artist_name": None, "username": "bob"},
        {"artist_name": "s", "username": "eve"},
    )
    assert rows(compat.shared_artists(plays, "ann", "bob")) == [("s", 1.0, 25.0, 0.5, 50.0, 50.0)]
    assert rows(compat.compatibility_score(plays, "ann", "bob")) == [(50, 1)]
    assert rows(compat.compatibility_artists(plays, "ann", "bob")) == [("s", 1.0)]
    # In each one's top 1 there is nothing in common, since bob's tie goes to "s".
    assert rows(compat.compatibility_score(plays, "ann", "bob", n=1)) == [(0, 0)]


def test_profile_compares_two_persons(make_plays):
    plays = make_plays(
        {"valence": 0.2}, {"username": "bob", "valence": 0.6}, {"username": "eve", "valence": 1.0}
    )
    profile = compat.feature_profile(plays)
    compared = {r.feature: r for r in compat.compatibility_profile(profile, "ann", "bob").collect()}
    assert len(compared) == 7
    valence = compared["valence"]
    assert (valence.left_value, valence.right_value, valence.background) == (0.2, 0.6, 1.0)
    eight = compat.feature_profile(plays.withColumn("popularity", F.lit(0.5)), "popularity")
    assert compat.compatibility_profile(eight, "ann", "bob").count() == 8


def test_group_playlist_prefers_tracks_of_more_people(spark, rows):
    playlist = spark.createDataFrame(
        [
            ("ann", "x", "both", 2, 1.0, None),
            ("bob", "x", "both", 3, 2.0, "pic"),
            ("ann", "y", "one", 50, 9.0, None),
            ("eve", "z", "not asked", 99, 9.0, None),
        ],
        PLAYLIST,
    )
    assert rows(compat.group_playlist(playlist, ["ann", "bob"])) == [
        ("x", "both", 2, 2, 1.5, "pic"),
        ("y", "one", 1, 50, 9.0, "default_value"),
    ]
    assert compat.group_playlist(playlist, ["ann", "bob"], 1).count() == 1
    assert compat.group_playlist(playlist, ["ann", "bob"], 51).count() == 2


def test_mutual_items_take_any_user_name(make_plays, rows):
    users = ["ann.b", "o`hara", "Ann"]
    plays = make_plays(*[{"username": user, "artist_name": "a"} for user in users for _ in range(2)])
    found = blend.mutual_items(plays, ["artist_name"], users, 1)
    assert found.columns == ["artist_name", "n_ann.b", "n_o`hara", "n_Ann", "total"]
    assert rows(found) == [("a", 2, 2, 2, 6)]
    with pytest.raises(ValueError, match="case"):
        blend.mutual_items(plays, ["artist_name"], ["Ann", "ann"], 1)


def test_averages_look_at_their_months_only(spark, make_plays, rows):
    inside = {"time": "2024-01-01 10:00:00", "ms_played": 31 * 60000}
    outside = [{"time": t, "ms_played": 10**8} for t in ("2023-01-01 10:00:00", "2024-02-01 10:00:00")]
    days = calendar(spark, date(2023, 1, 1), date(2024, 12, 31))
    plays = make_plays(inside, *outside)
    assert rows(wrapped.hourly_average_minutes(plays, days, 2024, 1, 1)) == [(10, 1.0)]
    assert rows(wrapped.weekday_average_minutes(plays, days, 2024, 1, 1)) == [(1, "Monday", 6.2)]


def test_number_of_compatibility_artists(make_plays, rows):
    plays = make_plays(*[{"username": u, "artist_name": f"a{i}"} for u in ("ann", "bob") for i in range(5)])
    assert [r[0] for r in rows(compat.compatibility_artists(plays, "ann", "bob", first=4))] == ["a0", "a1", "a2", "a3"]
    assert compat.compatibility_artists(plays, "ann", "bob").count() == 3

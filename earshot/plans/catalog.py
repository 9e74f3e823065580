"""Every query by name, over plays derived from the test tables.

Means of doubles depend on the order of addition in their last digits, so the
columns concerned are rounded to six decimals here, as in the oracles.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.operators import blend, compat, filters, prepare, stats, wrapped
from earshot.plans import etl
from earshot.schema import ARTIST_ATTRIBUTES, PLAYLIST, PLAYS, RADAR_FEATURES, TRACK_FEATURES
from earshot.sources import (
    Scan,
    calendar,
    csv_lines,
    csv_record,
    csv_values,
    days_spanned,
    fixture,
    json_lines,
    json_values,
    merge_plays,
    read_csv_table,
    read_plays,
    read_user_tables,
    scan_csv,
    scan_json,
    shared_folder,
    write_csv,
    write_plays,
)

Query = Callable[[SparkSession, str], DataFrame]

USER, OTHER = "user_a", "user_b"
START, END = "2024-01-01", "2024-12-31"
YEAR = 2024
CUTOFFS = {"user_c": "2024-12-08"}
FLOORS = {"user_b": "2024-02-01"}
FIRST_MONTH, LAST_MONTH = 3, 9
FEATURE = "valence"
SMALL_TOP = 10

LARGE_TOP = 5000

QUERIES: dict[str, Query] = {}
# Queries that write files under the shared folder and read them.
STORING: set[str] = set()


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def storing(build: Query) -> Query:
    STORING.add(build.__name__)
    return query(build)


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in columns})


def _own(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.user_plays(fixture.plays(spark, sf_dir), USER, START, END)


def _ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.all_plays_in_range(fixture.plays(spark, sf_dir), START, END)


def _year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.plays_by_months(fixture.plays(spark, sf_dir), USER, YEAR)


def _days(spark: SparkSession) -> DataFrame:
    return calendar(spark, date(YEAR, 1, 1), date(YEAR, 12, 31))


def _normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.normalise_export(fixture.raw_export(spark, sf_dir))


# Sources and preparation


@query
def union_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Several users' exports in one scan, each row with its owner.
    export = fixture.raw_export(spark, sf_dir)
    return prepare.normalise_export(export.filter(F.col("username").isin(*fixture.USERS)))


@query
def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return days_spanned(fixture.plays(spark, sf_dir))


@query
def normalise_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalised(spark, sf_dir)


@query
def track_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.track_dim(_normalised(spark, sf_dir), fixture.track_features(spark, sf_dir))


@query
def artist_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.artist_dim(
        _normalised(spark, sf_dir),
        fixture.track_artists(spark, sf_dir),
        fixture.artist_profiles(spark, sf_dir),
    )


@query
def enrich_track_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.with_track_features(
        _normalised(spark, sf_dir), fixture.track_features(spark, sf_dir)
    )


@query
def first_of_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.first_of_list(fixture.artist_profiles(spark, sf_dir))


@query
def enrich_artist_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.with_artist_attributes(
        _normalised(spark, sf_dir),
        fixture.track_artists(spark, sf_dir),
        fixture.artist_profiles(spark, sf_dir),
    )


@query
def apply_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.apply_cutoff(fixture.plays(spark, sf_dir), CUTOFFS)


@query
def curated_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return etl.curated_plays(
        fixture.raw_export(spark, sf_dir),
        fixture.track_features(spark, sf_dir),
        fixture.track_artists(spark, sf_dir),
        fixture.artist_profiles(spark, sf_dir),
        cutoffs=CUTOFFS,
    )


@query
def personal_playlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(compat.personal_playlist(fixture.plays(spark, sf_dir)), "time")


@query
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return csv_values(csv_lines(personal_playlist(spark, sf_dir)), PLAYLIST)


@query
def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_values(json_lines(personal_playlist(spark, sf_dir)), PLAYLIST)


@query
def json_array_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One array per person and artist, as a file of records is one array.
    records = personal_playlist(spark, sf_dir)
    # An artist with much of a person's songs has several arrays.
    part = F.pmod(F.xxhash64("track_name"), F.lit(256))
    grouped = records.groupBy("who", "artist_name", part).agg(
        F.to_json(F.collect_list(F.struct(*records.columns))).alias("line")
    )
    return json_values(grouped, PLAYLIST, array=True)


# Files and stored tables


def _text_files(texts: DataFrame, folder: str, header: str | None = None) -> str:
    """Files of the lines in `line`, each with the header, if there is one."""
    lines = texts.select(F.pmod(F.xxhash64("line"), F.lit(4)).alias("part"), F.lit(1).alias("at"), "line")
    if header is not None:
        heads = texts.sparkSession.range(4).select(F.col("id").alias("part"), F.lit(0).alias("at"), F.lit(header).alias("line"))
        lines = lines.unionByName(heads)
    placed = lines.repartition("part").sortWithinPartitions("part", "at").select("part", "line")
    placed.write.partitionBy("part").text(folder)
    return folder


def _csv_scan(spark: SparkSession, sf_dir: str) -> Scan:
    """Playlists as CSV files; by its count a row is cut short, or has a word as count."""
    rows = personal_playlist(spark, sf_dir).withColumn("kind", F.col("count") % 5)
    text = F.when(F.col("kind") == 1, "many").otherwise(F.col("count").cast("string"))
    line = csv_record(PLAYLIST.fieldNames())
    cut = F.when(F.col("kind") == 0, F.substring_index(line, ",", 2)).otherwise(line)
    lines = rows.withColumn("count", text).select(cut.alias("line"))
    folder = _text_files(lines, shared_folder(spark), ",".join(PLAYLIST.fieldNames()))
    return scan_csv(spark, folder, PLAYLIST)


def _json_scan(spark: SparkSession, sf_dir: str) -> Scan:
    """Playlists as JSON lines, broken as in `_csv_scan`."""
    rows = personal_playlist(spark, sf_dir).withColumn("kind", F.col("count") % 5)
    names = [name for name in PLAYLIST.fieldNames() if name != "count"]
    whole = F.to_json(F.struct(*names, "count"))
    word = F.to_json(F.struct(*names, F.lit("many").alias("count")))
    cut = whole.substr(F.lit(1), F.length(whole) - 1)
    line = F.when(F.col("kind") == 0, cut).when(F.col("kind") == 1, word).otherwise(whole)
    return scan_json(spark, _text_files(rows.select(line.alias("line")), shared_folder(spark)), PLAYLIST)


@storing
def csv_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _csv_scan(spark, sf_dir).rows


@storing
def csv_broken_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.split(F.translate("record", '"', ""), ",")
    return _csv_scan(spark, sf_dir).broken.select(
        fields[0].alias("who"), fields[1].alias("artist_name"), "reason"
    )


@storing
def json_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json_scan(spark, sf_dir).rows


@storing
def json_broken_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    def field(name: str):
        return F.regexp_extract("record", f'"{name}":"([^"]*)"', 1).alias(name)

    return _json_scan(spark, sf_dir).broken.select(field("who"), field("track_name"), "reason")


@storing
def stacked_user_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Each user's file has other columns: two are missing, one is more, the order differs.
    everyone = fixture.plays(spark, sf_dir).select(*PLAYS.fieldNames())
    folder, files = shared_folder(spark), {}
    for user in fixture.USERS:
        own = everyone.filter(F.col("username") == user).drop("username")
        if user == "user_a":
            own = own.drop("image", "followers")
        elif user == "user_b":
            own = own.withColumn("device", F.concat(F.lit("d"), "hour"))
        else:
            own = own.select(*reversed(own.columns))
        files[user] = f"{folder}/{user}"
        write_csv(own, files[user])
    return read_user_tables(spark, files, PLAYS)


@storing
def enriched_csv_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched, folder = curated_plays(spark, sf_dir), shared_folder(spark)
    write_csv(enriched, folder)
    return read_csv_table(spark, folder, enriched.schema)


@storing
def months_stored_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A corrected export of some months replaces them; storing it twice changes nothing.
    everyone, folder = fixture.plays(spark, sf_dir), shared_folder(spark)
    write_plays(everyone, folder)
    own = filters.plays_by_months(everyone, OTHER, YEAR, FIRST_MONTH, LAST_MONTH)
    corrected = own.filter(F.col("ms_played") >= 60000)
    merge_plays(corrected, folder)
    merge_plays(corrected, folder)
    return read_plays(spark, folder)


def _exports(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two exports of the same accounts, interleaved in time."""
    both = _normalised(spark, sf_dir)
    return both.filter("event_id % 3 <> 0"), both.filter("event_id % 3 = 0")


def _kept(state: DataFrame) -> DataFrame:
    """A state as the job before left it."""
    folder = shared_folder(state.sparkSession)
    state.write.parquet(folder)
    return state.sparkSession.read.schema(state.schema).parquet(folder)


@storing
def merged_track_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    older, newer = _exports(spark, sf_dir)
    features = fixture.track_features(spark, sf_dir)

    def look_up(rows: DataFrame) -> DataFrame:
        return prepare.with_features_by_uri(rows, features)

    key = "track_name"
    state = _kept(look_up(prepare.first_rows(older, key)))
    firsts = prepare.first_rows(newer, key)
    return prepare.merged_dim(state, firsts, key, TRACK_FEATURES, look_up).select(key, *TRACK_FEATURES)


@storing
def merged_artist_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    older, newer = _exports(spark, sf_dir)
    lookups = fixture.track_artists(spark, sf_dir), fixture.artist_profiles(spark, sf_dir)

    def look_up(rows: DataFrame) -> DataFrame:
        return prepare.with_attributes_by_uri(rows, *lookups)

    key = "artist_name"
    state = _kept(look_up(prepare.first_rows(older.filter("artist_name IS NOT NULL"), key)))
    firsts = prepare.first_rows(newer.filter("artist_name IS NOT NULL"), key)
    merged = prepare.merged_dim(state, firsts, key, ARTIST_ATTRIBUTES, look_up)
    return merged.select(key, *ARTIST_ATTRIBUTES)


# Selections


@query
def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.plays(spark, sf_dir)


@query
def user_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _own(spark, sf_dir)


@query
def all_plays_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranged(spark, sf_dir)


@query
def plays_by_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    everyone = fixture.plays(spark, sf_dir)
    return filters.plays_by_months(everyone, USER, YEAR, FIRST_MONTH, LAST_MONTH)


# One user


@query
def top_tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.top_tracks(_own(spark, sf_dir))


@query
def top_tracks_all_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.top_tracks_all_time(fixture.plays(spark, sf_dir))


@query
def hourly_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.hourly_share(_own(spark, sf_dir))


@query
def weekday_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.weekday_share(_own(spark, sf_dir))


@query
def daily_unique_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.daily_unique_artists(_own(spark, sf_dir))


@query
def favourite_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.favourite_artist(_own(spark, sf_dir))


@query
def favourite_artist_by_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.favourite_artist_by_plays(_own(spark, sf_dir))


@query
def favourite_artist_all_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.favourite_artist_by_plays(fixture.plays(spark, sf_dir), attributes=False)


@query
def artist_tempo_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.artist_tempo_range(_own(spark, sf_dir), fixture.plays(spark, sf_dir))


@query
def artist_tempo_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = stats.artist_tempo_density(_own(spark, sf_dir), fixture.plays(spark, sf_dir))
    return _rounded(dense, "x", "density")


@query
def top_track_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.top_track_names(_own(spark, sf_dir))


@query
def top_track_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(stats.top_track_features(_own(spark, sf_dir)), *RADAR_FEATURES)


@query
def radar_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stats.radar_frame(stats.top_track_features(_own(spark, sf_dir)))
    return _rounded(rows, *RADAR_FEATURES)


# Users compared


@query
def rank_listening_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blend.rank(_ranged(spark, sf_dir), "listening_time")


@query
def rank_average_tempo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(blend.rank(_ranged(spark, sf_dir), "average_tempo"), "average_tempo")


@query
def rank_artist_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blend.rank(_ranged(spark, sf_dir), "artist_count")


@query
def rank_average_followers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blend.rank(_ranged(spark, sf_dir), "average_followers")


@query
def favourite_genre(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blend.rank(_ranged(spark, sf_dir), "favourite_genre")


@query
def rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(blend.rankings(_ranged(spark, sf_dir)), "average_tempo")


@query
def mutual_artist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blend.mutual_artist(_ranged(spark, sf_dir), fixture.USERS)


@query
def mutual_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blend.mutual_track(_ranged(spark, sf_dir), fixture.USERS)


@query
def mutual_tracks_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["artist_name", "track_name"]
    return blend.mutual_items(_ranged(spark, sf_dir), keys, fixture.USERS, 10)


@query
def mutual_artists_of_everyone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blend.mutual_items_of_everyone(_ranged(spark, sf_dir), ["artist_name"], 30)


@query
def cumulative_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranged = prepare.apply_cutoff(_ranged(spark, sf_dir), CUTOFFS)
    return blend.cumulative_minutes(prepare.apply_floor(ranged, FLOORS))


# One person's year


@query
def weekday_average_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapped.weekday_average_minutes(_year(spark, sf_dir), _days(spark), YEAR)


@query
def hourly_average_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapped.hourly_average_minutes(_year(spark, sf_dir), _days(spark), YEAR)


@query
def top_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapped.top_artists(_year(spark, sf_dir))


@query
def artist_track_play_equivalents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapped.artist_track_play_equivalents(_year(spark, sf_dir), fixture.songs(spark, sf_dir))


@query
def artist_mean_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    songs = fixture.songs(spark, sf_dir).filter(F.col("person") == USER)
    return _rounded(wrapped.artist_mean_features(songs), *RADAR_FEATURES)


@query
def artist_radar(spark: SparkSession, sf_dir: str) -> DataFrame:
    songs = fixture.songs(spark, sf_dir).filter(F.col("person") == USER)
    return _rounded(wrapped.artist_radar(_year(spark, sf_dir), songs), *RADAR_FEATURES)


@query
def top_track_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrapped.top_track_counts(_year(spark, sf_dir))


@query
def feature_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = wrapped.feature_distribution(fixture.songs(spark, sf_dir), USER, FEATURE)
    return _rounded(dense, "x", "density")


@query
def feature_distribution_heard(spark: SparkSession, sf_dir: str) -> DataFrame:
    everyone = fixture.plays(spark, sf_dir)
    heard = filters.plays_by_months(everyone, USER, YEAR, FIRST_MONTH, FIRST_MONTH)
    dense = wrapped.feature_distribution(fixture.songs(spark, sf_dir), USER, FEATURE, heard)
    return _rounded(dense, "x", "density")


# Two persons and groups


@query
def compatibility_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = compat.feature_profile(fixture.plays(spark, sf_dir))
    return _rounded(
        compat.compatibility_profile(profile, USER, OTHER), "left_value", "right_value"
    )


@query
def shared_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compat.shared_artists(fixture.plays(spark, sf_dir), USER, OTHER)


@query
def compatibility_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compat.compatibility_score(fixture.plays(spark, sf_dir), USER, OTHER)


@query
def compatibility_score_small_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compat.compatibility_score(fixture.plays(spark, sf_dir), USER, OTHER, SMALL_TOP)


@query
def compatibility_score_large_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compat.compatibility_score(fixture.plays(spark, sf_dir), USER, OTHER, LARGE_TOP)


@query
def compatibility_artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compat.compatibility_artists(fixture.plays(spark, sf_dir), USER, OTHER)


@query
def group_playlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    playlist = compat.personal_playlist(fixture.plays(spark, sf_dir))
    return _rounded(compat.group_playlist(playlist, fixture.USERS), "avg_time")

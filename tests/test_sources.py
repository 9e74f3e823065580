"""Reading and writing play tables, and the preparation of raw exports."""

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import types as T

from earshot.operators import prepare
from earshot.plans import etl
from earshot.schema import ARTIST_PROFILES, PLAYLIST, PLAYS, RAW_EXPORT, TRACK_FEATURES
from earshot.sources import (
    calendar,
    csv_lines,
    csv_values,
    days_spanned,
    json_lines,
    json_values,
    merge_plays,
    read_csv_table,
    read_exports,
    read_json_table,
    read_plays,
    read_user_tables,
    scan_csv,
    scan_json,
    union_by_name,
    write_csv,
    write_plays,
)

MIXED = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("x", T.DoubleType()),
    ]
)


def test_csv_reads_na_as_missing_and_keeps_blanks_of_text(spark, tmp_path, rows):
    path = tmp_path / "in.csv"
    path.write_text('name,n,x\nNA,1,0.5\n"NA",NA,NA\n,,\n"",2, 1.5\n"a, ""b""",3,NA\n')
    assert rows(read_csv_table(spark, str(path), MIXED)) == [
        (None, 1, 0.5),
        (None, None, None),
        ("", None, None),
        ("", 2, 1.5),
        ('a, "b"', 3, None),
    ]


def test_csv_columns_are_checked_against_the_header(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("n,name,x\n1,a,0.5\n")
    with pytest.raises(Exception, match="header"):
        read_csv_table(spark, str(path), MIXED).collect()


def test_csv_round_trip(spark, make_plays, tmp_path, rows):
    plays = make_plays(
        {"track_name": 'say "hi", you', "genre": None, "tempo": 120.5, "key": 3},
        {"track_name": "", "username": "bob", "followers": None},
    )
    path = str(tmp_path / "out")
    write_csv(plays, path)
    text = "".join(p.read_text() for p in sorted(Path(path).glob("*.csv")))
    assert text.splitlines()[0] == ",".join(f'"{name}"' for name in PLAYS.fieldNames())
    back = read_csv_table(spark, path, PLAYS)
    assert sorted(rows(back), key=repr) == sorted(rows(plays), key=repr)


HARD = ["  lead", "trail  ", "a\nb", "a\rb", "a\r\nb", 'say "x"', "back\\slash", "\\", "#no", "", None, "a,b", "\t", '"', "'"]


def test_csv_loses_nothing(spark, tmp_path, rows):
    frame = spark.createDataFrame([(t, i, i / 2) for i, t in enumerate(HARD)], MIXED)
    path = str(tmp_path / "out")
    write_csv(frame, path)
    assert sorted(rows(read_csv_table(spark, path, MIXED)), key=repr) == sorted(rows(frame), key=repr)
    assert sorted(rows(csv_values(csv_lines(frame), MIXED)), key=repr) == sorted(rows(frame), key=repr)


def test_broken_csv_row_is_an_error(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("name,n,x\na,1,0.5\nb,2\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv_table(spark, str(path), MIXED).collect()


def test_csv_without_line_breaks_is_split(spark, tmp_path, rows):
    path = tmp_path / "in.csv"
    path.write_text("name,n,x\na,1,0.5\n")
    assert rows(read_csv_table(spark, str(path), MIXED, multiline=False)) == [("a", 1, 0.5)]


def test_json_text_forms(spark, rows):
    expected = [("ann", None, None, 2, 1.5, None), ("bob", None, None, None, None, None)]
    array = spark.createDataFrame([('[{"who": "ann", "count": 2, "time": 1.5}, {"who": "bob"}]',), ("[]",)], "line string")
    assert rows(json_values(array, PLAYLIST, array=True)) == expected
    frame = spark.createDataFrame(expected, PLAYLIST)
    assert rows(json_values(json_lines(frame), PLAYLIST)) == expected


def test_lookups_with_repeated_ids_do_not_multiply_plays(spark):
    raw = _export(spark, {"master_metadata_track_name": "t", "master_metadata_album_artist_name": "a"})
    features = _features(spark, {"track_id": "7", "tempo": 2.0}, {"track_id": "7", "tempo": 1.0})
    artists = spark.createDataFrame([("7", ["i"]), ("7", ["i"]), ("7", ["j"])], "track_id string, artist_ids array<string>")
    profiles = spark.createDataFrame([("i", ["b"], [], 2), ("i", ["a"], [], 1), ("j", [], [], 9)], ARTIST_PROFILES)
    plays = etl.curated_plays(raw, features, artists, profiles, "ann").collect()
    assert [(r.track_name, r.genre, r.followers) for r in plays] == [("t", "a", 1)]
    assert prepare.track_dim(prepare.normalise_export(raw, "ann"), features).count() == 1


def test_raw_files_to_stored_plays(spark, tmp_path):
    """Two users' export files, one of them a folder, to one stored table."""
    record = {"ms_played": 5, "spotify_track_uri": "spotify:track:7", "master_metadata_track_name": "t", "master_metadata_album_artist_name": "a"}
    (tmp_path / "bob").mkdir()
    files = {"ann x+1.json": ["2024-01-01T10:00:00Z"], "bob/1.json": ["2024-02-01T10:00:00Z"], "bob/2.json": ["2024-03-01T10:00:00Z", "2024-05-01T10:00:00Z"]}
    for name, times in files.items():
        (tmp_path / name).write_text(json.dumps([record | {"ts": t} for t in times]))
    tables = {
        "track_features": _features(spark, {"track_id": "7", "tempo": 2.0}),
        "track_artists": spark.createDataFrame([("7", ["i"])], "track_id string, artist_ids array<string>"),
        "artist_profiles": spark.createDataFrame([("i", ["b"], [], 2)], ARTIST_PROFILES),
    }
    for name, table in tables.items():
        table.write.parquet(str(tmp_path / name))
    exports = {"ann": str(tmp_path / "ann x+1.json"), "bob": str(tmp_path / "bob")}
    lookups = {name: str(tmp_path / name) for name in tables}
    stored = etl.store_plays(spark, exports, lookups, str(tmp_path / "plays"), {"bob": "2024-05-01"})
    found = sorted((r.username, str(r.time), r.tempo, r.genre) for r in stored.collect())
    assert found == [("ann", "2024-01-01 10:00:00", 2.0, "b"), ("bob", "2024-02-01 10:00:00", 2.0, "b"), ("bob", "2024-03-01 10:00:00", 2.0, "b")]
    with pytest.raises(ValueError, match="no exports"):
        read_exports(spark, {})


def test_json_array_and_lines(spark, tmp_path, rows):
    array, lines = tmp_path / "array.json", tmp_path / "lines.json"
    array.write_text('[{"who": "ann", "count": 2,\n "time": 1.5}, {"who": "bob"}]')
    lines.write_text('{"who": "ann", "count": 2, "time": 1.5}\n{"who": "bob"}\n')
    expected = [("ann", None, None, 2, 1.5, None), ("bob", None, None, None, None, None)]
    assert rows(read_json_table(spark, str(array), PLAYLIST)) == expected
    assert sorted(rows(read_json_table(spark, str(lines), PLAYLIST, lines=True))) == expected


def test_union_aligns_by_name(spark, rows):
    left = spark.createDataFrame([(1, "a")], "n int, s string")
    right = spark.createDataFrame([("b", 2.0)], "s string, x double")
    assert rows(union_by_name(left, right)) == [(1, "a", None), (None, "b", 2.0)]


def test_calendar_includes_both_ends(spark, make_plays):
    days = [r.date for r in calendar(spark, date(2024, 2, 28), date(2024, 3, 1)).collect()]
    assert days == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
    plays = make_plays({"time": "2024-03-05 23:00:00"}, {"time": "2024-03-07 01:00:00"})
    assert [r.date.day for r in days_spanned(plays).collect()] == [5, 6, 7]


def test_storing_splits_a_big_user(spark, tmp_path):
    path = str(tmp_path / "plays")
    plays = spark.range(0, 60000, 1, 6).selectExpr(
        "TIMESTAMP_NTZ '2024-03-05 00:00:00' + make_dt_interval(0, 0, 0, id) AS time",
        "IF(id % 3 = 0, 'u' || id, 'ann') AS username",
        "sha2(CAST(id AS STRING), 256) AS track_name",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200KB")
    try:
        write_plays(plays, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert read_plays(spark, path).count() == 60000
    files = [str(p) for p in Path(path).glob("play_month=2024-03-01/*.parquet")]
    of_ann = [spark.read.parquet(f).filter("username = 'ann'").count() for f in files]
    assert max(of_ann) < 20000


def test_stored_plays_come_back_and_prune_months(spark, make_plays, tmp_path, rows):
    big = [{"time": f"2024-03-{d:02d} 10:00:00", "username": "ann"} for d in range(1, 29)]
    small = [{"time": "2024-04-01 10:00:00", "username": "bob"}, {"time": "2024-05-01 10:00:00"}]
    plays = make_plays(*big, *small)
    path = str(tmp_path / "plays")
    write_plays(plays, path)
    months = sorted(p.name for p in Path(path).glob("play_month=*"))
    assert months == [f"play_month=2024-{m}-01" for m in ("03", "04", "05")]
    stored = read_plays(spark, path)
    assert sorted(rows(stored), key=repr) == sorted(rows(plays.select(stored.columns)), key=repr)
    some = read_plays(spark, path, since=date(2024, 3, 20), before=date(2024, 5, 1))
    assert some.count() == 10
    scan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(play_month" in scan


def _export(spark, *rows):
    plain = {"ts": "2024-03-05T23:59:59Z", "ms_played": 1, "spotify_track_uri": "spotify:track:7"}
    names = RAW_EXPORT.fieldNames()
    complete = [tuple((dict.fromkeys(names, "x") | plain | row)[n] for n in names) for row in rows]
    return spark.createDataFrame(complete, RAW_EXPORT)


def test_export_is_renamed_parsed_and_stripped(spark):
    plays = prepare.normalise_export(_export(spark, {}), "ann")
    row = plays.collect()[0]
    assert set(plays.columns) == {
        *("time", "hour", "username", "ms_played"),
        *("track_name", "album_name", "artist_name", "spotify_track_uri"),
    }
    assert (row.time, row.hour, row.username) == (datetime(2024, 3, 5, 23, 59, 59), 23, "ann")


def test_export_times_of_another_shape_are_missing(spark):
    texts = ["2024-02-30T10:00:00Z", "2024-02-03", "2024-02-03 10:00:00", None, "soon"]
    raw = _export(spark, {"ts": "2024-02-29T00:00:00Z"}, *[{"ts": text} for text in texts])
    plays = prepare.normalise_export(raw, "ann").collect()
    assert [(r.time, r.hour) for r in plays] == [
        (datetime(2024, 2, 29), 0),
        *[(None, None)] * len(texts),
    ]


def test_export_without_a_length_is_an_error(spark):
    with pytest.raises(Exception, match="ms_played is missing"):
        prepare.normalise_export(_export(spark, {"ms_played": None})).collect()


def _features(spark, *rows):
    schema = T.StructType(
        [
            T.StructField("track_id", T.StringType()),
            *[f for f in PLAYS.fields if f.name in TRACK_FEATURES],
        ]
    )
    named = [dict.fromkeys(schema.fieldNames()) | row for row in rows]
    return spark.createDataFrame([tuple(r[n] for n in schema.fieldNames()) for r in named], schema)


def test_track_features_follow_the_names_first_uri(spark):
    raw = _export(
        spark,
        {"master_metadata_track_name": "t", "spotify_track_uri": "spotify:track:2"},
        {
            "master_metadata_track_name": "t",
            "spotify_track_uri": "spotify:track:1",
            "ts": "2024-01-01T00:00:00Z",
        },
        {"master_metadata_track_name": None, "spotify_track_uri": "spotify:track:3"},
        {"master_metadata_track_name": "no features", "spotify_track_uri": "spotify:track:4"},
    )
    plays = prepare.normalise_export(raw, "ann")
    lookup = _features(
        spark,
        {"track_id": "1", "tempo": 100.0},
        {"track_id": "2", "tempo": 200.0},
        {"track_id": "3", "tempo": 300.0},
    )
    enriched = prepare.attach_track_features(plays, prepare.track_dim(plays, lookup))
    assert sorted((str(r.track_name), r.tempo) for r in enriched.collect()) == [
        ("None", 300.0),
        ("no features", None),
        ("t", 100.0),
        ("t", 100.0),
    ]


def test_artist_attributes_take_the_first_of_each_list(spark):
    raw = _export(
        spark,
        {"master_metadata_album_artist_name": "listed", "spotify_track_uri": "spotify:track:1"},
        {"master_metadata_album_artist_name": "bare", "spotify_track_uri": "spotify:track:2"},
        {"master_metadata_album_artist_name": None, "spotify_track_uri": "spotify:track:1"},
        {"master_metadata_album_artist_name": "unknown", "spotify_track_uri": "spotify:track:9"},
    )
    plays = prepare.normalise_export(raw, "ann")
    artists = spark.createDataFrame(
        [("1", ["i", "j"]), ("2", ["k"])], "track_id string, artist_ids array<string>"
    )
    profiles = spark.createDataFrame(
        [
            ("i", ["pop", "rock"], [("u",), ("v",)], 5),
            ("j", ["no"], [("no",)], 6),
            ("k", [], [], 7),
        ],
        ARTIST_PROFILES,
    )
    dim = prepare.artist_dim(plays, artists, profiles)
    assert sorted(tuple(r) for r in dim.collect() if r.artist_name != "unknown") == [
        ("bare", None, None, 7),
        ("listed", "u", "pop", 5),
    ]
    enriched = prepare.attach_artist_attributes(plays, dim)
    assert sorted((str(r.artist_name), r.followers) for r in enriched.collect()) == [
        ("None", None),
        ("bare", 7),
        ("listed", 5),
        ("unknown", None),
    ]


# Broken rows, users' files, stored months


NUMBERS = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])


def test_broken_csv_rows_are_set_aside_and_counted(spark, tmp_path, rows):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text('name,n\na,1\n"b ""x""\nc",2\nNA,NA\n"",\n')
    bad.write_text("name,n\nd\ne,many\nf,3,4\ng,5\n")
    scan = scan_csv(spark, [str(good), str(bad)], NUMBERS)
    assert sorted(rows(scan.rows), key=repr) == sorted(
        [("a", 1), ('b "x"\nc', 2), (None, None), ("", None), ("g", 5)], key=repr
    )
    assert scan.counts.get == {"records": 8, "broken": 3}
    found = sorted((r.reason, r.record, r.file.endswith("/bad.csv")) for r in scan.broken.collect())
    assert found == [("fields", "d", True), ("fields", "f,3,4", True), ("n", "e,many", True)]
    # What a query needs doesn't change which rows are good.
    again = scan_csv(spark, [str(good), str(bad)], NUMBERS)
    assert again.rows.count() == 5 and again.rows.select("name").filter("name = 'd'").count() == 0


def test_broken_json_rows_are_set_aside_and_counted(spark, tmp_path, rows):
    path = tmp_path / "rows.json"
    path.write_text('{"name":"a","n":1}\n{"name":"b","n":\n{"name":"c","n":"many"}\n{"n":4}\n')
    scan = scan_json(spark, str(path), NUMBERS)
    assert sorted(rows(scan.rows), key=repr) == [("a", 1), (None, 4)]
    assert scan.counts.get == {"records": 4, "broken": 2}
    assert sorted(r.record for r in scan.broken.collect()) == ['{"name":"b","n":', '{"name":"c","n":"many"}']
    assert scan_json(spark, str(path), NUMBERS).rows.select("name").count() == 2


def test_an_empty_folder_has_no_rows_and_no_broken_ones(spark, tmp_path):
    spark.createDataFrame([], "line string").write.text(str(tmp_path / "none"))
    scan = scan_json(spark, str(tmp_path / "none"), NUMBERS)
    assert scan.rows.count() == 0 and scan.broken.count() == 0


def test_users_files_with_other_columns_are_stacked(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("n,name,username\n1,x,someone\nNA,NA,someone\n")
    (tmp_path / "b.csv").write_text("name,mood\ny,calm\n")
    files = {user: str(tmp_path / f"{user}.csv") for user in "ab"}
    stacked = read_user_tables(spark, files, T.StructType([*NUMBERS.fields, T.StructField("username", T.StringType())]))
    assert dict(stacked.dtypes) == {"name": "string", "n": "bigint", "username": "string", "mood": "string"}
    found = rows(stacked.select("username", "name", "n", "mood"))
    assert sorted(found, key=repr) == sorted(
        [("a", "x", 1, None), ("a", None, None, None), ("b", "y", None, "calm")], key=repr
    )
    with pytest.raises(ValueError):
        read_user_tables(spark, {}, NUMBERS)


def _months(path):
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in path.glob("play_month=*")}


def test_merging_rewrites_only_the_months_touched(spark, make_plays, tmp_path, rows):
    path = tmp_path / "plays"

    def play(user, day, track):
        return {"username": user, "time": f"2024-{day} 10:00:00", "track_name": track}

    first = make_plays(play("ann", "01-03", "a"), play("bob", "01-04", "b"), play("ann", "02-01", "c"), play(None, "02-02", "d"))
    merge_plays(first, str(path))  # nothing is stored yet
    before = _months(path)
    export = make_plays(play("ann", "02-05", "new"), play("ann", "03-01", "more"), play(None, "02-07", "e"))
    merge_plays(export, str(path))
    expected = [("ann", "a"), ("bob", "b"), ("ann", "new"), ("ann", "more"), (None, "e")]

    def stored():
        return sorted(rows(read_plays(spark, str(path)).select("username", "track_name")), key=repr)

    assert stored() == sorted(expected, key=repr)
    after = _months(path)
    assert after["play_month=2024-01-01"] == before["play_month=2024-01-01"]
    assert after["play_month=2024-02-01"] != before["play_month=2024-02-01"]
    merge_plays(export, str(path))
    merge_plays(export.limit(0), str(path))
    assert stored() == sorted(expected, key=repr)


def test_merged_first_rows_equal_a_rebuild(spark, rows):
    """Earlier, later, equal and new rows of a name; only changed names are looked up."""
    schema = "time timestamp_ntz, event_id long, track_name string, spotify_track_uri string"

    def plays(*found):
        return spark.createDataFrame([(datetime(2024, 1, d), i, n, f"spotify:track:{u}") for d, i, n, u in found], schema)

    older = plays((5, 1, "a", "1"), (6, 2, "b", "2"), (7, 3, None, "3"))
    newer = plays((4, 4, "a", "4"), (8, 5, "b", "5"), (9, 6, "c", "6"), (1, 7, None, "7"), (6, 2, "b", "2"))
    features = spark.createDataFrame([(str(i), *[i / 10] * 11) for i in range(1, 8)], ["track_id", *prepare.TRACK_FEATURES])
    asked = []

    def look_up(found):
        asked.append(sorted(r.spotify_track_uri[-1] for r in found.collect()))
        return prepare.with_features_by_uri(found, features)

    state = look_up(prepare.first_rows(older, "track_name"))
    merged = prepare.merged_dim(state, prepare.first_rows(newer, "track_name"), "track_name", prepare.TRACK_FEATURES, look_up)
    rebuilt = prepare.track_dim(older.unionByName(newer), features)
    assert sorted(rows(merged.select(rebuilt.columns)), key=repr) == sorted(rows(rebuilt), key=repr)
    assert asked == [["1", "2", "3"], ["4", "6", "7"]]

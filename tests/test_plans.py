"""Physical plans: what is read, what is shuffled, what is broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from earshot.functions import first_per_key
from earshot.operators import filters, prepare, stats
from earshot.operators.wrapped import _top_artist
from earshot.plans import etl
from earshot.plans.catalog import QUERIES, STORING
from earshot.sources import read_plays, write_plays



def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The plays as a stored table, as they are on a cluster."""
    path = str(tmp_path_factory.mktemp("stored") / "plays")
    write_plays(QUERIES["plays"](spark, sf_dir), path)
    return path


@pytest.fixture
def unbroadcast(spark):
    """A session in which no table is small enough to be broadcast unasked."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SMALL))
    for operator in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in plan


@pytest.mark.parametrize("name", QUERIES)
def test_only_bounded_sides_are_broadcast(unbroadcast, name):
    """Without automatic broadcasts only hinted ones are left."""
    hinted = {
        "weekday_average_minutes",
        "artist_tempo_density",
        "feature_distribution",
        "feature_distribution_heard",
    }
    plan = plan_of(QUERIES[name](unbroadcast, SMALL))
    assert ("BroadcastExchange" in plan) == (name in hinted)


def test_range_and_user_reach_the_scan(spark, stored):
    own = filters.user_plays(read_plays(spark, stored), "user_a", "2024-03-01", "2024-03-09")
    scan = plan_of(stats.hourly_share(own))
    assert "GreaterThanOrEqual(time,2024-03-02T00:00)" in scan
    assert "LessThan(time,2024-03-09T00:00)" in scan
    assert "EqualTo(username,user_a)" in scan
    read = re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"time", "hour", "username", "ms_played"}


def test_month_range_reaches_the_scan(spark, stored):
    mine = filters.plays_by_months(read_plays(spark, stored), "user_a", 2024, 3, 12)
    scan = plan_of(mine)
    assert "GreaterThanOrEqual(time,2024-03-01T00:00)" in scan
    assert "LessThan(time,2025-01-01T00:00)" in scan


def test_chosen_artist_reaches_the_scan(spark, stored):
    plays = read_plays(spark, stored)
    of_top = plays.filter(F.col("artist_name") == _top_artist(plays))
    pushed = re.findall(r"PushedFilters: \[[^\]]*", of_top._jdf.queryExecution().toString())
    assert any("EqualTo(artist_name,ScalarSubquery" in filters for filters in pushed)


def test_top_k_never_sorts_everything(spark, stored):
    plan = plan_of(stats.top_tracks(read_plays(spark, stored)))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_first_rows_are_cut_before_the_shuffle(spark, stored):
    plan = plan_of(first_per_key(read_plays(spark, stored), ["track_name"]))
    assert re.search(r"row_number\(\), 1, Partial", plan)


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A key with a third of the rows leaves each task as one row."""
    plays = spark.range(0, 90000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("time")
    )
    frame = first_per_key(plays, ["k"])
    assert frame.count() == 60001
    lines = _metrics(frame)
    written = [v for name, v in lines if name == "shuffleRecordsWritten"]
    assert max(written) <= 60000 + 6


def _metrics(frame):
    plan = frame._jdf.queryExecution().executedPlan()
    frame._jdf.queryExecution().toRdd().count()
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        metrics = node.metrics().iterator()
        while metrics.hasNext():
            entry = metrics.next()
            found.append((entry._1(), entry._2().value()))
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


def test_hot_track_is_split_in_the_feature_join(unbroadcast):
    """Adaptive execution splits the partition that one hot track name fills."""
    spark = unbroadcast
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        plays = spark.range(0, 200000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, "hot")
            .otherwise(F.concat(F.lit("t"), F.col("id") % 5000))
            .alias("track_name"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        dim = spark.range(0, 5000, 1, 4).select(
            F.concat(F.lit("t"), F.col("id")).alias("track_name"),
            *[F.lit(0.5).alias(name) for name in prepare.TRACK_FEATURES],
        )
        joined = prepare.attach_track_features(plays, dim)
        frame = joined.groupBy("payload").count()
        assert frame.count() == 200000
        assert joined.filter("track_name = 'hot'").count() == 66667
        joined.write.format("noop").mode("overwrite").save()
        frame.collect()
        assert "skew=true" in plan_of(frame)
    finally:
        for key in settings:
            spark.conf.unset(key)


def _stages(spark):
    context = spark.sparkContext
    quantiles = context._gateway.new_array(context._jvm.double, 0)
    stages = context._jsc.sc().statusStore().stageList(None, False, False, quantiles, None)
    return {s.stageId(): s for s in (stages.apply(i) for i in range(stages.size()))}


@pytest.mark.parametrize(
    "name, scans",
    [("artist_tempo_density", 2), ("feature_distribution", 1), ("feature_distribution_heard", 2)],
)
def test_density_reads_its_values_once(spark, name, scans):
    """All steps share one shuffle of (value, count) pairs; finding the artist is one more."""
    events = spark.read.parquet(f"{SMALL}/events.parquet").count()
    before = set(_stages(spark))
    QUERIES[name](spark, SMALL).collect()
    new = [stage for number, stage in _stages(spark).items() if number not in before]
    assert sum(stage.inputRecords() for stage in new if stage.inputRecords() >= events) == (
        scans * events
    )


def _jobs(spark):
    return spark.sparkContext._jsc.sc().statusStore().jobsList(None).size()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORING))
def test_building_a_query_starts_no_job(spark, name):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = _jobs(spark)
    QUERIES[name](spark, SMALL)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    assert _jobs(spark) == before


def test_curated_plays_shuffle_the_plays_once(unbroadcast, sf_dir):
    """Above the plays' own shuffle there is one on both names, and no other of plays."""
    plan = plan_of(QUERIES["curated_plays"](unbroadcast, sf_dir))
    both = re.findall(r"hashpartitioning\(coalesce\(track_name#\d+, \), isnull\(track_name#\d+\), coalesce\(artist_name", plan)
    assert len(both) == 1, "\n".join(x for x in plan.splitlines() if "Exchange" in x)


def test_curated_plays_read_the_export_twice(unbroadcast, sf_dir):
    events = unbroadcast.read.parquet(f"{sf_dir}/events.parquet").count()
    before = set(_stages(unbroadcast))
    QUERIES["curated_plays"](unbroadcast, sf_dir).write.format("noop").mode("overwrite").save()
    new = [stage for number, stage in _stages(unbroadcast).items() if number not in before]
    assert sum(s.inputRecords() for s in new if s.inputRecords() >= events) <= 2 * events


def test_hot_missing_artist_is_split(unbroadcast):
    """A third of the plays without an artist meet many tracks, so no task gets them all."""
    spark = unbroadcast
    raw = spark.range(0, 60000, 1, 6).select(
        F.lit("2024-01-01T00:00:00Z").alias("ts"),
        F.lit(1).cast("long").alias("ms_played"),
        F.concat(F.lit("t"), F.col("id") % 3000).alias("master_metadata_track_name"),
        F.lit("al").alias("master_metadata_album_album_name"),
        F.when(F.col("id") % 3 > 0, F.concat(F.lit("a"), F.col("id") % 3000)).alias("master_metadata_album_artist_name"),
        F.concat(F.lit("spotify:track:"), F.col("id") % 3000).alias("spotify_track_uri"),
    )
    ids = spark.range(3000).select(F.col("id").cast("string").alias("track_id"))
    features = ids.select("track_id", *[F.lit(0.5).alias(n) for n in prepare.TRACK_FEATURES])
    artists = ids.select("track_id", F.array("track_id").alias("artist_ids"))
    profiles = ids.select(F.col("track_id").alias("artist_id"), F.array(F.lit("g")).alias("genres"), F.expr("array(named_struct('url', 'u'))").alias("images"), F.lit(1).alias("followers"))
    frame = etl.curated_plays(raw, features, artists, profiles, "ann")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = frame.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r[1] for r in sizes) == 60000 and max(r[1] for r in sizes) < 15000
    assert frame.where("artist_name is null and tempo = 0.5 and genre is null").count() == 20000


def test_long_lists_are_cut_in_parts(spark, make_plays):
    """At n = 5,000 no task gets all 200,000 artists of a person."""
    from earshot.operators import compat

    one = make_plays({"username": "ann"}).drop("artist_name", "username")
    artists = spark.range(0, 200_000, 1, 4).selectExpr("concat('artist ', id) AS artist_name", "id % 1000 AS ms")
    people = spark.createDataFrame([("ann",), ("bob",)], "username string")
    plays = artists.join(people).join(F.broadcast(one)).withColumn("ms_played", F.col("ms"))
    frame = compat._shared(plays, "ann", "bob", 5000)
    plan = plan_of(frame)
    assert plan.index("hashpartitioning(username") < plan.rindex("part#")
    before = set(_stages(spark))
    assert frame.count() == 5000
    store, most = spark.sparkContext._jsc.sc().statusStore(), 0
    for number in set(_stages(spark)) - before:
        tasks = store.taskList(number, 0, 10_000)
        for i in range(tasks.size()):
            metrics = tasks.apply(i).taskMetrics()
            if metrics.isDefined():
                most = max(most, metrics.get().shuffleReadMetrics().recordsRead())
    # Of 400,000 rows a task gets a few parts, and at last two lists of 16 parts.
    assert 0 < most <= 170_000


def test_rankings_read_the_plays_once(spark):
    plan = plan_of(QUERIES["rankings"](spark, SMALL))
    assert plan.count("FileScan parquet") == 2  # the events and their catalogue


@pytest.mark.parametrize("name", ["feature_distribution", "artist_tempo_density"])
def test_density_plan_stays_small(spark, name):
    """One scalar subquery for the band, and four uses of the pairs' shuffle, in line."""
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    found = {"feature_distribution": 1, "artist_tempo_density": 2}[name]
    assert len(set(re.findall(r"scalar-subquery#\d+", plan))) <= found * 5
    assert plan.count("Aggregate [point") == 1 and plan.count("Window") <= 12


def test_grouping_a_bucketed_table_by_user_shuffles_nothing(unbroadcast, make_plays, sf_dir):
    from earshot.operators import blend
    from earshot.sources import write_plays_by_user

    spark, table = unbroadcast, "plays_by_user_of_a_test"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    try:
        write_plays_by_user(QUERIES["plays"](spark, sf_dir), table, 4)
        own = spark.table(table)
        grouped = own.groupBy("username").agg(F.sum("ms_played").alias("ms"))
        assert "Exchange" not in plan_of(grouped)
        daily = own.groupBy("username", F.to_date("time").alias("date")).agg(F.sum("ms_played").alias("ms"))
        assert "Exchange" not in plan_of(daily)
        assert grouped.count() == 3
        ranked = blend.rank(own, "artist_count")
        plain = blend.rank(QUERIES["plays"](spark, sf_dir), "artist_count")
        assert [tuple(r) for r in ranked.collect()] == [tuple(r) for r in plain.collect()]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")

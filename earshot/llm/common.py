"""Helpers shared by the operators: stored intermediate tables, words, components."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: what separates words.
SPACES = " \t\n\x0b\x0c\r"


def scratch(spark: SparkSession) -> str:
    """A new path in the folder all executors share.

    That is the folder the session names in `spark.checkpoint.dir`; a session that names
    none, as in tests, gets a folder beside its tables. The path is removed when the
    driver's JVM ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/llm-scratch"
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stored(frame: DataFrame) -> DataFrame:
    """The same rows read back from the shared folder: computed once, and lost executors
    cost nothing. Later plans know the table's size.

    Spark deletes the shuffle files behind a table when the driver's collector finds them
    unused; asking for it here keeps the disk from filling with those of earlier steps."""
    spark, schema = frame.sparkSession, frame.schema
    path = scratch(spark)
    frame.write.parquet(path)
    del frame
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Deletes a stored table that nothing will read again."""
    spark = frame.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def as_text(column: str) -> Column:
    """An id on its way to Python: pandas makes doubles of whole numbers beside a null,
    which changes those above 2^53. `as_long` takes it back."""
    return F.col(column).cast("string").alias(column)


def as_long(frame: DataFrame, column: str) -> DataFrame:
    return frame.withColumn(column, F.col(column).cast("long"))


def words(text: Column) -> Column:
    """The maximal runs of anything but ASCII white space, in order; null has none."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def _print(edges: DataFrame) -> tuple:
    """Changes whenever the set of edges does."""
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b of type long): `node`, `root`.

    `root` is the smallest node reachable. Nodes without an edge have no row. Alternates
    the two star contractions until nothing moves, which takes few rounds even for long
    chains; every round is stored. A node with many neighbours is aggregated per task
    first, and its join is one that adaptive execution can split.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _print(now)
    while before[0]:
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        now = stored(small.select("e.*").where("a <> b").distinct())
        after = _print(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))

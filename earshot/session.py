"""Session settings the operators are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps text timestamps on the wall clock they were exported with. Adaptive
# execution sizes reduce tasks, turns joins into broadcasts once a side has been
# measured, and splits reduce partitions that one hot key has filled.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def session(
    app: str = "earshot",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with the library's settings; the cluster's own values stay otherwise.

    `extra` takes further settings with `__` in place of the dots.
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()

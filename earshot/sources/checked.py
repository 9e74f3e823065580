"""File scans that set broken rows aside instead of failing.

A row is broken if its text isn't a record of the table's columns (`fields`), or if a
value isn't of its column's type (that column's name). Good and broken rows are two
frames over the same files; an `Observation` counts both while the good rows are computed,
so a job over many files ends, and says how much it left out and why.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.sources.files import MISSING_TEXT, as_text_schema, csv_options, from_text

BROKEN = "_broken_record"


class Scan(NamedTuple):
    """`rows` are the good ones; `broken` has the file, the record's text and the reason.
    `counts.get` has `records` and `broken` once `rows` has been computed."""

    rows: DataFrame
    broken: DataFrame
    counts: Observation


def _unreadable(field: T.StructField) -> Column:
    """Whether a text that is present isn't a value of the field's type."""
    if isinstance(field.dataType, T.StringType):
        return F.lit(False)
    text = F.trim(F.col(field.name))
    present = (text != MISSING_TEXT) & (text != "")
    return F.coalesce(present & text.try_cast(field.dataType).isNull(), F.lit(False))


def _scan(raw: DataFrame, reason: Column, record: Column, typed) -> Scan:
    counts = Observation()
    marked = raw.withColumns({"_reason": reason, "_file": F.col("_metadata.file_path")})
    observed = marked.observe(
        counts,
        F.count(F.lit(1)).alias("records"),
        F.count("_reason").alias("broken"),
    )
    rows = typed(observed.filter(F.col("_reason").isNull()))
    broken = marked.filter(F.col("_reason").isNotNull()).select(
        F.col("_file").alias("file"), record.alias("record"), F.col("_reason").alias("reason")
    )
    return Scan(rows, broken, counts)


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    multiline: bool = True,
) -> Scan:
    """CSV as `read_csv_table` reads it, with its broken rows apart.

    Columns that a query doesn't need are parsed all the same, as a row's number of
    fields is part of what makes it good.
    """
    text = as_text_schema(schema).add(BROKEN, T.StringType())
    options = {
        **csv_options(multiline),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": BROKEN,
        "columnPruning": "false",
    }
    reader = spark.read.schema(text).options(header="true", enforceSchema="false", **options)
    raw = reader.csv(path)
    wrong = [F.when(_unreadable(f), F.lit(f.name)) for f in schema.fields]
    reason = F.coalesce(F.when(F.col(BROKEN).isNotNull(), F.lit("fields")), *wrong)
    whole = F.struct(*[F.col(f.name) for f in schema.fields])
    record = F.coalesce(F.col(BROKEN), F.to_csv(whole, {"nullValue": MISSING_TEXT}))
    return _scan(raw, reason, record, lambda rows: from_text(rows, schema))


def scan_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType, lines: bool = True
) -> Scan:
    """JSON records with their broken rows apart; by default one record per line, as a
    broken array is one broken record."""
    known = T.StructType(list(schema.fields)).add(BROKEN, T.StringType())
    raw = spark.read.schema(known).json(
        path, multiLine=not lines, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN
    )
    names = [F.col(f.name) for f in schema.fields]
    # True, and mentions every column, as one that isn't parsed can't be found broken.
    parsed = F.xxhash64(*names) >= F.lit(-(2**63))
    reason = F.when(F.col(BROKEN).isNotNull() & parsed, F.lit("fields"))
    return _scan(raw, reason, F.col(BROKEN), lambda rows: rows.select(*names))


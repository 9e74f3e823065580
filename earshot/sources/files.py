"""Reading and writing play tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from earshot.functions.columns import day_before
from earshot.schema import RAW_EXPORT
from earshot.sources.shared import exists

MISSING_TEXT = "NA"
MONTH = "play_month"


def _parsed(field: T.StructField) -> Column:
    text = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        # A blank text field is an empty string, not a missing one.
        value = F.when(text == MISSING_TEXT, None).otherwise(F.coalesce(text, F.lit("")))
    else:
        present = F.nullif(F.nullif(F.trim(text), F.lit(MISSING_TEXT)), F.lit(""))
        value = present.cast(field.dataType)
    return value.alias(field.name)


# Quotes are doubled, blanks belong to the text, and a broken row is an error.
_CSV = {
    "escape": '"',
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def as_text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])


def csv_options(multiline: bool = True) -> dict[str, str]:
    """How CSV is read, by files and by `from_csv` alike."""
    return {**_CSV, "mode": "FAILFAST", "multiLine": str(multiline).lower()}


def from_text(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to values: `NA` is missing; a blank is a missing number, but a text."""
    return raw.select(*[_parsed(field) for field in schema.fields])


def read_csv_table(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    multiline: bool = True,
) -> DataFrame:
    """CSV with a header, where the text `NA` means missing.

    Fields are read as text in one pass without inference. In text columns `NA`
    is missing and a blank stays an empty string; in all others both are missing.
    Text may hold line breaks, so a file is one task's work; pass `multiline=False` for
    large files known to have none, which are then split. A row with another number of
    fields than the header is an error.
    """
    raw = spark.read.schema(as_text_schema(schema)).csv(
        path, header=True, enforceSchema=False, **csv_options(multiline)
    )
    return from_text(raw, schema)


def read_json_table(
    spark: SparkSession, path: str | list[str], schema: T.StructType, lines: bool = False
) -> DataFrame:
    """JSON records, either one array per file or one record per line.

    An array file is one task's work, so large inputs should use lines.
    """
    return spark.read.schema(schema).json(path, multiLine=not lines)


def read_exports(
    spark: SparkSession, exports: Mapping[str, str], schema: T.StructType = RAW_EXPORT
) -> DataFrame:
    """Several users' exports, JSON arrays of records, in one scan with their `username`.

    `exports` has each user's file or folder. A row belongs to the user whose path its
    file is or lies under; of paths inside each other the longer one counts.
    """
    if not exports:
        raise ValueError("no exports to read")
    raw = spark.read.schema(schema).json(list(exports.values()), multiLine=True)
    place = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    owner = F.lit(None).cast("string")
    for user, path in sorted(exports.items(), key=lambda e: len(e[1])):
        plain = path.rstrip("/")
        plain = plain if "://" in plain or plain.startswith("file:") else f"/{plain.lstrip('/')}"
        mine = place.endswith(plain) | F.contains(place, F.lit(f"{plain}/"))
        owner = F.when(mine, F.lit(user)).otherwise(owner)
    return raw.withColumn("username", owner)


def csv_text(df: DataFrame) -> DataFrame:
    """All values as text, as CSV files hold them."""
    # As text a timestamp keeps its fraction if it has one, and is plain otherwise.
    times = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({name: F.col(name).cast("string") for name in times})


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """CSV with a header, no row index and `NA` for missing values."""
    csv_text(df).write.mode(mode).csv(
        path, header=True, nullValue=MISSING_TEXT, quoteAll=True, **_CSV
    )


def csv_record(columns: Sequence[str]) -> Column:
    """A row's CSV record, in the form of `write_csv`."""
    options = {**_CSV, "nullValue": MISSING_TEXT, "quoteAll": "true"}
    return F.to_csv(F.struct(*[F.col(name) for name in columns]), options)


def csv_lines(df: DataFrame) -> DataFrame:
    """One column `line`, a CSV record per row, in the form of `write_csv`."""
    return csv_text(df).select(csv_record(df.columns).alias("line"))


def csv_values(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of `csv_lines`, parsed as `read_csv_table` parses files."""
    ddl = ", ".join(f"`{f.name}` string" for f in schema.fields)
    parsed = lines.select(F.from_csv("line", F.lit(ddl), csv_options()).alias("row"))
    return from_text(parsed.select("row.*"), schema)


def json_lines(df: DataFrame) -> DataFrame:
    """One column `line`, a JSON record per row."""
    return df.select(F.to_json(F.struct(*[F.col(name) for name in df.columns])).alias("line"))


def json_values(texts: DataFrame, schema: T.StructType, array: bool = False) -> DataFrame:
    """Rows from the JSON text in column `line`: a record, or an array of records."""
    if array:
        return texts.select(F.inline(F.from_json("line", T.ArrayType(schema))))
    return texts.select(F.from_json("line", schema).alias("row")).select("row.*")


def reconciled(table: DataFrame, schema: T.StructType) -> DataFrame:
    """A user's table with the schema's columns, then its own others.

    Columns it lacks are missing, and those of another type are cast; text is read as
    CSV holds it. What can't be cast is an error.
    """
    types = dict(table.dtypes)
    own = []
    for field in schema.fields:
        if field.name not in types:
            own.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif types[field.name] == "string":
            own.append(_parsed(field))
        else:
            own.append(F.col(field.name).cast(field.dataType).alias(field.name))
    others = [F.col(f"`{name}`") for name in table.columns if name not in schema.fieldNames()]
    return table.select(*own, *others)


def read_user_tables(
    spark: SparkSession, tables: Mapping[str, str], schema: T.StructType, multiline: bool = True
) -> DataFrame:
    """Several users' CSV files, each with a header of its own, as one table.

    Columns are aligned by name, in any order: those of the schema with its types, then
    what other columns any user has, as text. A column that a user lacks is missing in
    their rows. `username` is the mapping's key.
    """
    if not tables:
        raise ValueError("no tables to read")
    own = []
    for user, path in tables.items():
        raw = spark.read.csv(path, header=True, **csv_options(multiline))
        own.append(reconciled(raw.drop("username"), schema).withColumn("username", F.lit(user)))
    return union_by_name(*own)


def union_by_name(*tables: DataFrame) -> DataFrame:
    """Stack users' tables by column name; a column one of them lacks is missing there."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), tables)


def write_plays(plays: DataFrame, path: str, mode: str = "error") -> None:
    """Store plays as Parquet, one folder per month, clustered by user and time.

    A folder per user would mean millions of small folders and one giant. Month
    folders stay few. Rows are shuffled once by month and user into tasks of the
    session's advisory size, whatever the number of shuffle partitions: adaptive
    execution joins small ones and splits those a busy user fills. Sorted files let a
    user filter skip row groups.
    """
    stamped = plays.withColumn(MONTH, F.trunc(F.col("time").cast("date"), "month"))
    sized = stamped.hint("rebalance", F.col(MONTH), F.col("username"))
    clustered = sized.sortWithinPartitions(MONTH, "username", "time")
    clustered.write.mode(mode).partitionBy(MONTH).parquet(path)


def merge_plays(plays: DataFrame, path: str) -> None:
    """Store plays in what `write_plays` stored, in place of what they replace.

    The plays of an export replace their users' stored plays of the months they are from;
    other users and months stay. So storing an export again changes nothing, and a corrected
    one corrects. Only the folders of those months are read and written (dynamic partition
    overwrite): new files are complete before any folder is exchanged, so a run that fails
    can be repeated. Plays without a time are in a folder of their own and count as a month.
    """
    spark = plays.sparkSession
    if not exists(spark, path):
        write_plays(plays, path)
        return
    stamped = plays.withColumn(MONTH, F.trunc(F.col("time").cast("date"), "month"))
    touched = stamped.select(F.col("username").alias("_user"), F.col(MONTH).alias("_month")).distinct()
    # As many as there are months in a calendar, whatever the number of plays.
    months = [row[0] for row in stamped.select(MONTH).distinct().collect()]
    if not months:
        return
    dated = [month for month in months if month is not None]
    inside = F.col(MONTH).isin(dated) if dated else F.lit(False)
    stored = spark.read.parquet(path)
    stored = stored.filter(inside | F.col(MONTH).isNull() if None in months else inside)
    replaced = stored.username.eqNullSafe(touched._user) & stored[MONTH].eqNullSafe(touched._month)
    kept = stored.join(touched, replaced, "left_anti")
    merged = kept.unionByName(stamped, allowMissingColumns=True)
    sized = merged.hint("rebalance", F.col(MONTH), F.col("username"))
    clustered = sized.sortWithinPartitions(MONTH, "username", "time")
    writer = clustered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(MONTH).parquet(path)
    spark.catalog.refreshByPath(path)


def write_plays_by_user(plays: DataFrame, table: str, buckets: int, mode: str = "error") -> None:
    """Store plays as a table bucketed by user and sorted by user and time.

    What groups by user then reads each bucket in one task and shuffles nothing. A user
    with much of the data fills a bucket, so this suits many users of bounded size; month
    folders (`write_plays`) suit the others. Rows are shuffled once, by bucket.
    """
    shuffled = plays.repartition(buckets, "username")
    writer = shuffled.write.mode(mode).format("parquet")
    writer.bucketBy(buckets, "username").sortBy("username", "time").saveAsTable(table)


def read_plays(
    spark: SparkSession, path: str, since: date | None = None, before: date | None = None
) -> DataFrame:
    """Plays stored by `write_plays`, opening only the months from `since` up to `before`."""
    plays = spark.read.parquet(path)
    if since is not None:
        first_month = since.replace(day=1)
        plays = plays.filter(F.col(MONTH) >= F.lit(first_month))
        plays = plays.filter(~day_before(since))
    if before is not None:
        plays = plays.filter(F.col(MONTH) <= F.lit(before))
        plays = plays.filter(day_before(before))
    return plays.drop(MONTH)

"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only.

Texts are equal if they are identical once every run of ASCII white space is one space.
A text is cut into chunks where its content says so: after a word whose hash together
with the word before it is divisible by `every`, and after `longest` words without such
a place, or `widest` characters. Equal passages are so cut alike wherever they stand, and a chunk of
long documents that are mostly alike is moved once for all of them.

Every distinct chunk of the corpus crosses the network once, copies having met in their
tasks before. There chunks with the same 64-bit identifier are compared as texts: the
identifiers of two different chunks are told apart (`doubtful` ones name their text as
well), so an identifier stands for one text, verified. A corpus with more than `limit`
doubtful identifiers, which only a forger could make, is hashed again with another seed.
A document is then its recipe, the ordered list of its chunks' identifiers, about eight
bytes for 32 words, and documents with equal recipes are equal: only recipes are shuffled.
Groups are aggregated per task first; the at most `hottest` groups with at least that part of all
rows are dealt over `salts` tasks when their rows are joined with them.

Of a group the row with the smallest doc_id stays; of rows that repeat this doc_id one,
whichever, as they differ in nothing that this operator reads. A missing doc_id is larger
than any other; a group of those only has no keep_id, and one of its rows stays. Missing
text is empty text. An empty table has no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

WHITE = "[\\x20\\x09-\\x0D]+"


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def chunks(text: Column, every: int = 32, longest: int = 128, widest: int = 8192) -> Column:
    """The chunks of a normalised text, in order; together they are the text and a space."""

    def cut(words: Column) -> Column:
        ends = F.transform(words, lambda w, i: F.when(F.pmod(F.xxhash64(F.get(words, i - 1), w), F.lit(every)) == 0, i + 1))
        inner = F.filter(ends, lambda e: e < F.size(words))
        return _bound(F.concat(F.array(F.lit(0)), inner, F.array(F.size(words))), lambda places: between(words, places))

    def between(words: Column, places: Column) -> Column:
        def parts(k: Column) -> Column:
            first, end = F.get(places, k), F.get(places, k + 1)
            return F.transform(F.sequence(first, end - 1, F.lit(longest)), lambda s: piece(words, s, F.least(s + longest, end)))

        return F.flatten(F.flatten(F.transform(F.sequence(F.lit(0), F.size(places) - 2), parts)))

    def piece(words: Column, first: Column, end: Column) -> Column:
        whole = F.concat(F.array_join(F.slice(words, first + 1, end - first), " "), F.lit(" "))
        return _bound(whole, lambda c: F.when(F.length(c) <= widest, F.array(c)).otherwise(F.regexp_extract_all(c, F.lit(f"(?s).{{1,{widest}}}"), F.lit(0))))

    return _bound(F.split(text, " "), cut)


def identifier(chunk: Column, seed: int = 0, bits: int = 64) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), chunk), 64 - bits)


def doubtful(parts: DataFrame, seed: int = 0, bits: int = 64) -> DataFrame:
    """Identifiers (`id`) of more than one chunk, of a table of chunks (column `chunk`)."""
    distinct = parts.select(identifier(F.col("chunk"), seed, bits).alias("id"), "chunk").distinct()
    return distinct.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")


def recipes(docs: DataFrame, bits: int = 64, limit: int = 100_000, **cutting) -> DataFrame:
    """Per row of `docs`: doc_id, text_sha256, `ids`, the recipe, `extra`, the texts of the
    chunks whose identifier is doubtful, and `row`, a number of the row's own."""
    texts = docs.select("doc_id", normalised(F.col("text")).alias("text"))
    parts = texts.select(F.explode(chunks(F.col("text"), **cutting)).alias("chunk"))
    seed = 0
    while True:
        found = stored(doubtful(parts, seed, bits))
        if found.count() <= limit:
            break
        discard(found)
        seed += 1
    known = [r.id for r in found.collect()]
    discard(found)
    cut = texts.select("doc_id", F.sha2("text", 256).alias("text_sha256"), chunks(F.col("text"), **cutting).alias("chunks"))
    ids = F.transform("chunks", lambda c: identifier(c, seed, bits))
    extra = F.filter("chunks", lambda c: identifier(c, seed, bits).isin(known)) if known else F.array().cast("array<string>")
    return cut.select("doc_id", "text_sha256", ids.alias("ids"), extra.alias("extra"), F.monotonically_increasing_id().alias("row"))


def exact_duplicates(docs: DataFrame, hottest: int = 1000, salts: int = 64, **options) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, keep_id, group_size, kept,
    text_sha256."""
    own = stored(recipes(docs, **options).withColumn("print", F.xxhash64("ids", "extra")))
    first = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))
    groups = own.groupBy("print", "ids", "extra").agg(F.count("*").alias("group_size"), F.min(first).alias("first"))
    groups = stored(groups.select("print", "ids", "extra", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row")))
    # Not more than `hottest` groups are that large.
    least = max(1000, own.count() // hottest)
    hot = stored(groups.where(F.col("group_size") >= least).select("print", F.lit(True).alias("hot")).distinct())

    def salted(frame: DataFrame, salt: Column) -> DataFrame:
        return frame.join(F.broadcast(hot), "print", "left").withColumn("salt", salt).drop("hot")

    every = F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0))))
    rows = salted(own, F.when(F.col("hot"), F.pmod("row", F.lit(salts)).cast("int")).otherwise(0))
    joined = rows.join(salted(groups, every), ["print", "ids", "extra", "salt"])
    return joined.select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def distinct_rows(docs: DataFrame, **options) -> DataFrame:
    """The documents that stay; of rows of one doc_id with equal texts one stays, the least
    by its other columns' text."""
    kept = exact_duplicates(docs, **options).where("kept").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.col("text_sha256").alias("digest")).distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole")
    packed = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.sha2(normalised(F.col("text")), 256).alias("digest"), whole)
    rows = packed.join(kept, ["id", "digest"], "left_semi")
    return rows.groupBy("id", "digest").agg(F.min_by("whole", F.to_json("whole")).alias("whole")).select("whole.*")

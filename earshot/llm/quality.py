"""Quality rules whose cutoffs are chosen under a guarantee, in DataFrame functions only.

Each rule measures a document; a document fails the rule if its measure is over the
cutoff of its stratum (its language). Cutoffs come from labelled documents: of the
grid's cutoffs only those count whose share of good documents rejected is shown to be at
most `risk` by the exact (Clopper-Pearson) bound, at an error probability that is
`error` divided by the number of all tests made (strata x rules x cutoffs, Bonferroni).
So with probability 1 - `error` no stratum loses more than `risk` of its good documents
to any one rule. Among those the cutoff that rejects most bad documents, less good ones,
is taken, the loosest on ties; where none rejects a bad document or none is proved
safe, the rule rejects nothing in that stratum.

Missing text has no words. A missing language is a stratum of its own; a missing label
or a label for an unknown doc_id counts for nothing; of labels that repeat for one
doc_id the least counts. Repeated rows are judged alike. An empty table or one without
labels gives the base verdict alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, words

SYMBOLS = "#*$%&|<>"
LINE_SPACES = " \t\x0b\x0c\r"

#: The grids of cutoffs, loosest last. Measures are shares or per-word rates.
RULES: dict[str, list[float]] = {
    "symbol_rate": [0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.8, 1.2],
    "exclamation_rate": [0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.8],
    "duplicate_line_share": [0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9],
    "repeated_word_share": [0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3],
    "capital_share": [0.1, 0.2, 0.3, 0.45, 0.6, 0.8],
    "digit_share": [0.05, 0.1, 0.2, 0.3, 0.5],
    "mean_word_length": [8.0, 9.0, 10.0, 12.0, 15.0, 20.0],
    "shortness": [0.02, 0.03, 0.04, 0.05],
}

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measured(docs: DataFrame, window: int = 8) -> DataFrame:
    """`docs` (doc_id, text, lang and whatever else) inside a struct `row`, with `stratum`,
    the five counts and one column per rule."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    frame = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    frame = frame.select(
        "row",
        words(F.col("row.text")).alias("words"),
        F.length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(text) - F.length(F.translate(text, "!", ""))).alias("bangs"),
        (F.length(text) - F.length(F.translate(text, "0123456789", ""))).alias("digits"),
        F.length(F.regexp_replace(text, r"\P{Lu}+", "")).alias("capitals"),
        F.filter(F.split(text, "\n"), lambda x: F.translate(x, LINE_SPACES, "") != "").alias("lines"),
    )
    frame = frame.withColumn("n_words", F.size("words").cast("long")).withColumn(
        "found",
        F.when(
            F.col("n_words") >= window,
            F.transform(F.sequence(F.lit(1), (F.col("n_words") - (window - 1)).cast("int")), lambda i: F.xxhash64(F.slice("words", i, window))),
        ),
    )
    frame = frame.drop("words").withColumn("some", F.size(F.array_distinct("found")) < F.size("found"))
    frame = frame.withColumn("marked", F.when(F.col("some"), F.array_sort(F.transform("found", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    frame = frame.drop("found", "some").withColumn(
        "starts",
        F.array_sort(
            F.transform(
                F.filter(
                    "marked",
                    lambda x, i: F.coalesce(x["h"] == F.get("marked", i + 1)["h"], F.lit(False))
                    | F.coalesce(x["h"] == F.get("marked", F.when(i > 0, i - 1))["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    )
    covered = F.aggregate(
        "starts",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(window), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"],
    )
    n = F.greatest(F.col("n_words"), F.lit(1))
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    frame = frame.select(
        "row",
        F.coalesce(F.col("row.lang"), F.lit("")).alias("stratum"),
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        "bangs",
        "digits",
        "capitals",
    )
    rules = {
        "symbol_rate": F.col("n_symbols") / n,
        "exclamation_rate": F.col("bangs") / n,
        "duplicate_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeated_word_share": F.col("n_repeat_words") / n,
        "capital_share": F.col("capitals") / chars,
        "digit_share": F.col("digits") / chars,
        "mean_word_length": F.col("word_chars") / n,
        "shortness": 1 / n,
    }
    return frame.select("row", "stratum", *COUNTS, *[v.alias(f"rule_{k}") for k, v in rules.items()])


def _binomial_tail(k: Column, n: Column, p: float) -> Column:
    """The probability of k or fewer among n independent events of probability p."""
    start = F.struct((n * math.log1p(-p)).alias("lp"), F.exp(n * math.log1p(-p)).alias("total"))

    def step(acc: Column, i: Column) -> Column:
        lp = acc["lp"] + F.log((n - i + 1) / i) + math.log(p / (1 - p))
        return F.struct(lp.alias("lp"), (acc["total"] + F.exp(lp)).alias("total"))

    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(terms, start, step, lambda acc: acc["total"])


def cutoffs(features: DataFrame, labels: DataFrame, risk: float = 0.01, error: float = 0.05, rules: dict[str, list[float]] = RULES) -> DataFrame:
    """One row per labelled stratum: `stratum` and `cut_<rule>`, null where a rule is off.

    `features`: doc_id, stratum and the rule columns; `labels`: doc_id, quality (1 good)."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = features.join(known, "doc_id").select("stratum", "quality", *[f"rule_{k}" for k in rules])
    over = [
        F.struct(F.lit(k).alias("rule"), sum((F.coalesce(F.col(f"rule_{k}") > c, F.lit(False)).cast("int") for c in grid), F.lit(0)).alias("over"))
        for k, grid in rules.items()
    ]
    counted = stored(
        rows.select("stratum", "quality", F.explode(F.array(*over)).alias("m"))
        .groupBy("stratum", F.col("m.rule").alias("rule"), F.col("m.over").alias("over"))
        .agg(F.sum((F.col("quality") == 1).cast("long")).alias("good"), F.sum((F.col("quality") != 1).cast("long")).alias("bad"))
    )
    tests = max(1, counted.select("stratum").distinct().count() * sum(map(len, rules.values())))
    grids = F.create_map(*[x for k, grid in rules.items() for x in (F.lit(k), F.array(*map(F.lit, grid)))])
    tested = (
        counted.withColumn("grid", grids[F.col("rule")])
        .select("stratum", "rule", "over", "good", "bad", F.posexplode("grid").alias("at", "cutoff"))
        .groupBy("stratum", "rule", "cutoff")
        .agg(
            F.sum("good").alias("n"),
            F.sum(F.when(F.col("over") > F.col("at"), F.col("good")).otherwise(0)).alias("k"),
            F.sum(F.when(F.col("over") > F.col("at"), F.col("bad")).otherwise(0)).alias("caught"),
        )
        .where((F.col("caught") > F.col("k")) & (F.col("n") > 0) & (F.col("k") <= risk * F.col("n")))
        .where(_binomial_tail(F.col("k"), F.col("n"), risk) <= error / tests)
        .groupBy("stratum", "rule")
        .agg(F.max_by("cutoff", F.struct(F.col("caught") - F.col("k"), "cutoff")).alias("cutoff"))
    )
    return stored(tested.groupBy("stratum").agg(*[F.max(F.when(F.col("rule") == k, F.col("cutoff"))).alias(f"cut_{k}") for k in rules]))


def judged(features: DataFrame, chosen: DataFrame, min_words: int = 20, max_repeated: int = 30, rules: dict[str, list[float]] = RULES) -> DataFrame:
    """`features` with `base_failed` and `kept`."""
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeated * F.col("n_words"))
    failed = F.lit(False)
    for k in rules:
        failed = failed | F.coalesce(F.col(f"rule_{k}") > F.col(f"cut_{k}"), F.lit(False))
    return features.join(chosen, "stratum", "left").withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & ~failed)


def quality(docs: DataFrame, labels: DataFrame, risk: float = 0.01, error: float = 0.05) -> DataFrame:
    """One row per document: doc_id, the counts, `base_failed`, `kept`."""
    features = measured(docs.select("doc_id", "text", "lang"))
    features = stored(features.select(F.col("row.doc_id").alias("doc_id"), *[c for c in features.columns if c != "row"]))
    return judged(features, cutoffs(features, labels, risk, error)).select("doc_id", *COUNTS, "base_failed", "kept")


def good_documents(docs: DataFrame, labels: DataFrame, risk: float = 0.01, error: float = 0.05) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    features = stored(measured(docs))
    named = features.select(F.col("row.doc_id").alias("doc_id"), *[c for c in features.columns if c != "row"])
    return judged(features, cutoffs(named, labels, risk, error)).where("kept").select("row.*")

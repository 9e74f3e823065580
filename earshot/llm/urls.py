"""URL filters: rules first, gradient-boosted trees on lexical features for the rest.

A rule names a host and a path; it fits the host and all its subdomains where the url's
path starts with the rule's, and the longest rule that fits decides. Urls that no rule
fits get the verdict of boosted trees (Spark's own) over lexical features: lengths,
depth, digit ratio, entropy of the characters, parameter counts, and statistics of the
host's suffix, the share of labelled urls blocked under its last two labels' two ends,
smoothed. Labelled are the urls that rules decide, blocked ones 1 and allowed ones 0;
those that are judged are no part of the training or the statistics. The trees learn from
about `fit_rows` urls, seeded, half of each label as far as there are as many.

DataFrame functions only. A missing url has empty parts, fits no rule, and is judged by
the trees on its (zero) features. Without urls of both labels there is nothing to learn,
and urls get the one verdict known, or `allow`. Repeated rows are judged alike.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

Rule = tuple[str, str]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def url_host(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """From the host's end up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: list[Rule], host: Column, path: Column) -> Column:
    """The rule (host and path as one text) that decides, else null."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at = rule.index("/")
        name, start = rule[:at], rule[at:]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _entropy(text: Column) -> Column:
    """Bits per character."""
    n = F.length(text)
    each = F.transform(F.array_distinct(F.split(text, "")), lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.aggregate(each, F.lit(0.0), lambda acc, p: acc - F.when(p > 0, p * F.log2(p)).otherwise(0.0))


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    whole = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(whole), F.lit(1))
    query = F.coalesce(F.regexp_extract(whole, r"\?([^#]*)", 1), F.lit(""))
    return {
        "length": F.length(whole),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.size(F.array_remove(F.split(path, "/"), "")),
        "labels": F.size(F.split(host, r"\.")),
        "digit_ratio": _count(whole, "0123456789") / n,
        "host_digits": _count(host, "0123456789"),
        "hyphens": _count(host, "-"),
        "entropy": F.when(F.length(whole) > 0, _entropy(whole)).otherwise(0.0),
        "host_entropy": F.when(F.length(host) > 0, _entropy(host)).otherwise(0.0),
        "parameters": F.when(F.length(query) > 0, _count(query, "&") + 1).otherwise(0),
        "fragment": F.instr(whole, "#") > 0,
        "secure": whole.startswith("https"),
        "extension": F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1) != "",
    }


def _suffixes(host: Column) -> list[Column]:
    return [F.substring_index(host, ".", -1), F.substring_index(host, ".", -2)]


def _with_suffix_statistics(rows: DataFrame, labelled: DataFrame) -> DataFrame:
    """Smoothed shares of labelled urls blocked and their number, per host suffix."""
    for i, suffix in enumerate(_suffixes(F.col("host"))):
        known = stored(labelled.groupBy(suffix.alias(f"suffix{i}")).agg(((F.sum("label") + 1) / (F.count("*") + 2)).alias(f"share{i}"), F.log1p(F.count("*")).alias(f"seen{i}")))
        rows = rows.withColumn(f"suffix{i}", suffix).join(known, f"suffix{i}", "left")
        rows = rows.withColumn(f"share{i}", F.coalesce(f"share{i}", F.lit(0.5))).withColumn(f"seen{i}", F.coalesce(f"seen{i}", F.lit(0.0)))
    return rows


def judged(pages: DataFrame, rules: list[Rule], fit_rows: int = 20000, trees: int = 10, depth: int = 4, seed: int = 11) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and `block_score`, the
    trees' probability of `block`, null where a rule decides."""
    rows = pages.select("page_id", F.col("url"), url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    rows = rows.withColumn("rule", longest_rule(rules, F.col("host"), F.col("path")))
    names = list(features(F.col("url"), F.col("host"), F.col("path")))
    rows = stored(rows.withColumns({f"f_{k}": v.cast("double") for k, v in features(F.col("url"), F.col("host"), F.col("path")).items()}).drop("url"))
    blocked = F.lit(0.0)
    for rule, verdict in rules:
        if verdict == "block":
            blocked = F.when(F.col("rule") == rule, 1.0).otherwise(blocked)
    labelled = rows.where("rule is not null").withColumn("label", blocked)
    kinds = labelled.agg(F.count("*").alias("n"), F.sum("label").alias("blocks")).first()
    n, blocks = kinds["n"], int(kinds["blocks"] or 0)
    by_rule = F.when(blocked == 1.0, "block").otherwise("allow")
    # One in so many of each label; all, where there are few.
    one_in = [max(1, 2 * of // fit_rows) for of in (n - blocks, blocks)]
    chosen = F.xxhash64(F.lit(seed), "page_id", "host", "path")
    fit = labelled.where(F.pmod(chosen, F.when(F.col("label") == 1.0, one_in[1]).otherwise(one_in[0])) == 0)
    if not 0 < blocks < n:
        only = F.lit("block" if n and blocks == n else "allow")
        return rows.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), by_rule).otherwise(only).alias("verdict"), F.lit(None).cast("double").alias("block_score"))
    inputs = [f"f_{k}" for k in names] + ["share0", "seen0", "share1", "seen1"]
    assemble = VectorAssembler(inputCols=inputs, outputCol="features")
    fit = assemble.transform(_with_suffix_statistics(fit, labelled)).select("features", "label")
    open_rows = assemble.transform(_with_suffix_statistics(rows.where("rule is null"), labelled))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed, maxMemoryInMB=64).fit(fit)
    scored = model.transform(open_rows).select(
        "page_id", "host", "path", "rule", F.when(F.col("prediction") == 1.0, "block").otherwise("allow").alias("verdict"), vector_to_array("probability")[1].alias("block_score")
    )
    decided = rows.where("rule is not null").select("page_id", "host", "path", "rule", by_rule.alias("verdict"), F.lit(None).cast("double").alias("block_score"))
    return decided.unionByName(scored)

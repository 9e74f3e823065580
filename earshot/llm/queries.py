"""The operators as registered queries, each over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, exact, html, langid, mixing, oracles, phrases, pieces, pii, quality, simhash, suffix, urls, variants


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.digest().alias("fingerprint"), "component_id")


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(_table(spark, sf_dir, "pages"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def vocabulary_path() -> str:
    """The public vocabulary the query encodes with."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.checked(_table(spark, sf_dir, "documents"), pieces.read_vocabulary(vocabulary_path()))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(_table(spark, sf_dir, "documents"))


def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(_table(spark, sf_dir, "documents"))


#: Rules of the url query: host and path, and what becomes of the pages.
URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(_table(spark, sf_dir, "pages"), URL_RULES)


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixed(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = variants.misspelt_words(_table(spark, sf_dir, "documents"))
    found = variants.variants(variants.common_words(counted))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run

    return run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash,
        op2_html,
        op3_pii,
        op4_sentencepiece,
        op5_langid,
        op6_suffix,
        op7_urls,
        op8_ann,
        op9_mixing,
        op10_quality,
        op11_exact,
        op12_phrases,
        op13_variants,
        pipeline,
    )
}

#: The SQL of those that SQL can express. Fingerprints, parsing, models and flows it
#: can't; tests/llm/ holds them against brute-force versions.
ORACLES: dict[str, str] = oracles.ORACLES

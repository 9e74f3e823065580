"""A corpus from raw documents to token ids, in five stages.

Every stage works on all that the one before it kept. Stages are joined by tables: each
result is written and read again, so a stage can be repeated alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from earshot.llm import mixing, pieces, pii, quality, simhash
from earshot.llm.common import stored
from earshot.llm.queries import vocabulary_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a base rule or a risk-controlled rule go."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints two or fewer bits apart stays, the one of
    the smallest doc_id; shingle length and distance are those of `op1_simhash`."""
    return simhash.distinct_documents(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.masked_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source has its share of the words; documents are repeated or left out."""
    return mixing.mixture(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become ids: doc_id, lang, source, n_chars, ids."""
    return pieces.encoded(docs, pieces.read_vocabulary(vocabulary_path()))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixture", mixture),
    ("encoding", encoding),
]

#: Fingerprints, the tagger and the encoder aren't SQL; tests/llm/ holds the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs

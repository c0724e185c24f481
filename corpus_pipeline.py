"""A corpus made ready for training, in five stages over the ``documents`` table.

Each stage takes ``(spark, docs, sf_dir)`` and is written as Parquet and read
again before the next one. ``run`` does that in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lowfold.llm import mixing, ngram_join, packing, pii, quality_rules
from lowfold.llm.util import steps


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.kept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares runs of five words at a similarity of 0.8 or more: the one with the smallest id."""
    return ngram_join.one_of_each(docs, size=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data masked."""
    return pii.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of their source takes them."""
    return mixing.mixed(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, label="pack-stage")


STAGES = [("quality rules", quality), ("near duplicates", near_duplicates), ("personal data", personal_data), ("mixing", mixture), ("packing", sequences)]

#: Outliers, masked disguises and token ids have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    store = steps(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = store.save(stage(spark, docs, sf_dir), f"stage{k}-{name.replace(' ', '-')}")
    return docs

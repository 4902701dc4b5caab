"""Training corpus pipeline: five stages, each one operator of ``regloom.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet to the session's shared folder and reads it back as the
next stage's documents.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regloom.llm import mixing, near_dup, quality_rules, ss_packing, weak_classifier
from regloom.llm.staging import materialize


def by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and lie near their group's robust centre."""
    return quality_rules.keep_good(docs)


def by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer trained on weak labels keeps."""
    return weak_classifier.keep_good(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dup.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in token sequences."""
    return ss_packing.pack(docs)


STAGES = [("quality_rules", by_rules), ("quality_classifier", by_classifier), ("near_dedup", without_near_copies),
          ("mixing", mixed), ("packing", packed)]

#: Robust estimates, training and packing are not expressible in SQL; the tests
#: hold near-dedup, mixing and packing against plain Python on their own input, the
#: rules and the classifier against labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: documents in, documents with their shards out. Each stage gets what the one before it kept.

Stages judge rows, whether their doc_ids are missing, repeated or neither; empty tables pass as empty tables, and extra
columns are kept, but for those named like the store's own (see ``sharding``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandweave.llm.common import documents, written
from strandweave.llm.decontaminate import drop_leaky
from strandweave.llm.jaccard_join import drop_near_duplicates
from strandweave.llm.mixing import mixed_documents
from strandweave.llm.quality_rules import keep_good
from strandweave.llm.sharding import sharded


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the quality rules; rows without a text don't."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, the first by doc_id, of each group of near duplicates; rows without a doc_id come last."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text holds no benchmark item."""
    return drop_leaky(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix to target weights; at most one epoch, so that no row comes back after deduplication."""
    return mixed_documents(docs, max_epochs=1)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows from a compacted store, with their shards."""
    return sharded(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: The near-duplicate stage takes a transitive closure over similar pairs of all texts, which SQL can't give in time.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between them the rows are written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

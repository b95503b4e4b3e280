"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandweave.operators.graph import shared_folder, without_shuffle_files, written  # noqa: F401

#: Words are maximal runs of anything but the ASCII blanks; ``bytes.split()`` cuts UTF-8 text in the same places.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def parallelism(spark: SparkSession) -> int:
    """The number of shuffle partitions of the session, which is set from the size of the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def has_clean_ids(docs: DataFrame) -> bool:
    """Whether each row has a doc_id of its own; a count over the ids alone."""
    return docs.groupBy(F.col("doc_id").cast("long").alias("id")).count().where("count > 1 or id is null").isEmpty()


def numbered(docs: DataFrame, row: bool = False) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """(doc_id, text) with a number for each row as doc_id, and a function that gives a result its true doc_ids back.

    Where every row has a doc_id of its own, that is the number. Else the rows are numbered in the order of doc_id (none
    last) and text, in a written table, so that numbers stay the same when a task runs again. ``row`` adds the whole row
    as a struct of that name.
    """
    whole = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if row else []
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), *whole)
    if has_clean_ids(docs):
        return docs, lambda found, *columns: found
    # The place in the input keeps many equal rows from ending in one range of the sort.
    docs = docs.withColumn("place", F.monotonically_increasing_id()).orderBy(F.col("doc_id").asc_nulls_last(), "text", "place")
    docs = written(docs.drop("place").withColumn("number", F.monotonically_increasing_id()), "numbered")
    of = docs.select(F.col("number").alias("__number"), F.col("doc_id").alias("__id"))

    def named(found: DataFrame, *columns: str) -> DataFrame:
        for column in columns or ("doc_id",):
            found = found.join(of, found[column] == of["__number"]).select(*(F.col("__id").alias(c) if c == column else F.col(c) for c in found.columns))
        return found

    return docs.select(F.col("number").alias("doc_id"), "text", *(["row"] if row else [])), named


def words(text: Column) -> Column:
    """The words of a text as an array (null: no words)."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD_PATTERN})"), F.lit(1))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

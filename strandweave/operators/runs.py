"""Reports on the runs of an annotation pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_rows(df: DataFrame, columns: Sequence[str], equal: dict, order: Sequence[str | Column], n: int | None = None) -> DataFrame:
    """Columns of the rows that have the given values, in order, the first ``n`` of them."""
    for name, value in equal.items():
        df = df.where(F.col(name) == value)
    df = df.select(*columns).orderBy(*order)
    return df if n is None else df.limit(n)


def status_counts(runs: DataFrame) -> DataFrame:
    return runs.groupBy("status").agg(F.count("*").alias("n"))


def readiness(runs: DataFrame, chunks: DataFrame) -> DataFrame:
    """Per sequence: chunks, those whose tasks are all finished (status from 10 to 12), statuses seen, and whether all are."""
    by_chunk = runs.groupBy("seq_id", "chunk_no").agg(F.bool_and(F.col("status").between(10, 12)).alias("finished"), F.collect_set("status").alias("seen"))
    joined = chunks.join(by_chunk, ["seq_id", "chunk_no"], "left").withColumn("finished", F.coalesce("finished", F.lit(False)))
    rows = joined.groupBy("seq_id").agg(F.count("*").alias("chunks"), F.count_if("finished").alias("finished"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("seen")))).alias("seen"))
    return rows.select("seq_id", "chunks", "finished", F.array_join(F.transform("seen", lambda s: s.cast("string")), ",").alias("statuses"), (F.col("chunks") == F.col("finished")).alias("ready"))


def timings(runs: DataFrame, column: str = "real_time") -> DataFrame:
    """Least, most, mean and total time by kind of step."""
    c = F.col(column)
    return runs.groupBy("kind").agg(F.min(c).alias("least"), F.max(c).alias("most"), F.avg(c).alias("mean"), F.sum(c).alias("total"), F.count("*").alias("n"))


def chunk_counts(chunks: DataFrame, finished: DataFrame) -> DataFrame:
    """(seq_id, chunks, runs): chunks of each sequence with finished runs, and how many runs these are."""
    joined = chunks.join(finished.select("seq_id", "chunk_no"), ["seq_id", "chunk_no"])
    return joined.groupBy("seq_id").agg(F.count_distinct("chunk_no").alias("chunks"), F.count("*").alias("runs"))


def totals(runs: DataFrame, columns: Sequence[str] = ("real_time",), by: Sequence[str] = ("seq_id",)) -> DataFrame:
    """(by, columns, n): sums of what the runs took, and their number."""
    return runs.groupBy(*by).agg(*(F.sum(c).alias(c) for c in columns), F.count("*").alias("n"))


def report(runs: DataFrame, ready: DataFrame) -> DataFrame:
    """A row a sequence: progress of its chunks, the statuses seen, total time and number of runs."""
    spent = runs.groupBy("seq_id").agg(F.round(F.sum("real_time"), 2).alias("total"), F.count("*").alias("runs"))
    return ready.join(spent, "seq_id").select("seq_id", "chunks", "finished", "statuses", "total", "runs")

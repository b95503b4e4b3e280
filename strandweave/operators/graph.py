"""Connected components of a table of edges, by contraction."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
_USERS: list[str | None] = []


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the cluster; only a local session may have none (as in tests), and gets a local one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strandweave-"))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


@contextmanager
def without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """Jobs inside remove their shuffle files once they are done. The setting is the session's: the last thread resets it."""
    with _LOCK:
        _USERS.append(spark.conf.get(CLEANUP, None) if not _USERS else _USERS[0])
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            before = _USERS.pop()
            if not _USERS:
                spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with without_shuffle_files(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Edges (32 bytes or so each) that one task takes at the end of ``components``.
REMAINDER = 20_000


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(node, root) of the few edges that are left."""
    root: dict = {}

    def top(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root.setdefault(root[x], root[x])
        return x

    for batch in batches:
        for u, v in zip(batch["u"], batch["v"], strict=True):
            a, b = top(u), top(v)
            root[max(a, b)] = min(a, b)
    yield pd.DataFrame({"node": list(root), "root": [top(x) for x in list(root)]}, columns=["node", "root"])


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for each node of the undirected ``edges(u, v)``: the root is the least node that it is linked to.

    Each round points every node at the one with the least hash among itself and its neighbours, and replaces the ends
    of all edges by these; edges inside a group vanish and the rest meet as one, so that the table shrinks by a constant
    factor, and quickly where a group is linked many times over. The rounds' tables are written to the shared folder,
    and the pointers are followed at the end. Once at most ``REMAINDER`` edges are left, one task finishes them instead
    of many more rounds. Self edges are ignored.
    """
    now = written(edges.where("u <> v").select("u", "v").distinct(), name)
    steps = []
    while (left := now.count()) > 0:
        if left <= REMAINDER:
            kind = now.schema["u"].dataType.simpleString()
            steps.append(written(now.coalesce(1).mapInPandas(_joined, f"node {kind}, root {kind}"), name))
            break
        arcs = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ranked = lambda c, salt=len(steps): F.struct(F.xxhash64(c, F.lit(salt)).alias("hash"), F.col(c).alias("id"))
        step = arcs.groupBy(F.col("u").alias("node")).agg(F.min(ranked("v")).alias("near")).select("node", F.least("near", ranked("node"))["id"].alias("root"))
        step = written(step, name)
        steps.append(step)
        ends = now.join(step.select(F.col("node").alias("u"), F.col("root").alias("a")), "u")
        ends = ends.join(step.select(F.col("node").alias("v"), F.col("root").alias("b")), "v")
        now = written(ends.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), name)
    if not steps:
        return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = steps.pop()
    while steps:
        after = found.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        found = steps.pop().join(after, "root", "left").select("node", F.coalesce("beyond", "root").alias("root"))
    found = written(found, name)
    return found.join(found.groupBy("root").agg(F.min("node").alias("least")), "root").select("node", F.col("least").alias("root"))

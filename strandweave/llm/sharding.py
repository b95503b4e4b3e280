"""Shards of a growing corpus, compacted by size tiers.

A store is a folder of immutable data and of versions. An append writes its rows as files of the size that its tasks make,
in ``data/store_batch=b.../store_file=arrivals``, each arrival (a shard) in one file, with the shard's number in each row.
A compaction writes a file for each run, in ``data/store_batch=b.../store_file=n``. A version lists the live shards with
their batch, rows and bytes, and has the columns of the store; it is committed by an atomic rename as the next version of
the one that its writer read, so that readers see one version or the other, and of two writers who started from the same
version one fails (``Conflict``) and nothing is lost. Readers scan the batches that the version lists, pruned by a join
with its shards. ``vacuum`` removes what the newest version doesn't list.

The columns of a store are those of all its appends: a new one is added at the end (older rows have nulls), an absent one
is null, and one that has another type than before is refused with ``ValueError`` before anything is written.

Arrivals are small shards of ``ARRIVAL_ROWS`` neighbouring doc_ids each. A shard's tier grows by one with each factor of
``fan_in`` in size from ``smallest`` on. Compaction is planned on the table of shard sizes alone: in each round, runs of
one tier below the target, in the order of their first shard, are merged ``fan_in`` at a time (fewer in the upper tiers,
so that no merged run passes twice the target), and rounds go on until none merges. ``compact`` rewrites the runs that
merged, a file each, with the few others that shared a file of arrivals with them, and leaves the rest where they lie.

Null texts have no bytes. Rows without a doc_id are dealt to the shards -1 to -4096 by their texts. Repeated rows are
kept. An empty table gives an empty result (no version is committed). Extra columns are kept as they are; those named like
the store's own (``store_batch``, ``store_file``, ``store_shard``, ``shard``, ``shard_rows``, ``shard_bytes``, ``tier``, in upper
or lower case) are replaced. A text lies in one row of one file, however long.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import documents, parallelism, scratch_dir, without_shuffle_files, written
from .store import children, commit, newest, remove, stage, version_path

ARRIVAL_ROWS, FAN_IN, SMALLEST, TARGET = 200, 4, 1 << 20, 32 << 20
#: Rows of a table of shards (about 40 bytes each) up to which it is broadcast.
MAX_BROADCAST_SHARDS = 200_000
#: Neighbouring shards that are numbered in one task while compaction is planned.
SECTION = 4096
#: The file name of shards that came together.
ARRIVALS = "arrivals"
#: Shards (about 40 bytes each) in one file of a version's list.
LISTED = 1_000_000
OWN = ("store_batch", "store_file", "store_shard", "shard", "shard_rows", "shard_bytes", "tier")
VERSION = "store_batch string, store_file string, shard long, rows long, bytes long"
LIST = ("store_batch", "store_file", "shard", "rows", "bytes")


def arrival_of(rows: int = ARRIVAL_ROWS) -> Column:
    """The arrival that a document came with."""
    spread = F.conv(F.substring(F.md5(F.coalesce("text", F.lit("")).cast("binary")), 1, 3), 16, 10).cast("long")
    return F.coalesce(F.floor(F.col("doc_id").cast("long") / rows), -1 - spread).cast("long")


def tier_bounds(fan_in: int, smallest: int, target: int) -> list[int]:
    """The least size of each tier but the lowest."""
    bounds = [smallest]
    while bounds[-1] * fan_in < target:
        bounds.append(bounds[-1] * fan_in)
    return bounds


def fan_ins(fan_in: int, smallest: int, target: int) -> list[int]:
    """How many runs of each tier merge into one: ``fan_in`` at most and two at least, so that twice the target isn't passed."""
    return [max(2, min(fan_in, 2 * target // min(high, target))) for high in [*tier_bounds(fan_in, smallest, target), target]]


def _numbered(runs: DataFrame) -> DataFrame:
    """``n``: the place of each run among those of its tier, from 0, by sections and then inside them."""
    section = F.floor(F.col("shard") / SECTION)
    runs = runs.withColumn("section", section)
    ahead = runs.groupBy("tier", "section").agg(F.count("*").alias("many"))
    ahead = ahead.withColumn("ahead", F.coalesce(F.sum("many").over(W.partitionBy("tier").orderBy("section").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    inside = F.row_number().over(W.partitionBy("tier", "section").orderBy("shard")) - 1
    return runs.withColumn("inside", inside).join(ahead.select("tier", "section", "ahead"), ["tier", "section"]).withColumn("n", F.col("ahead") + F.col("inside"))


def plan_compaction(shards: DataFrame, fan_in: int = FAN_IN, smallest: int = SMALLEST, target: int = TARGET) -> DataFrame:
    """(old, shard, shard_rows, shard_bytes, tier) from ``shards(shard, rows, bytes)``: the run that each shard ends in.

    A run is named by its first shard; shards with one number are one run. The table of runs shrinks with each round and is written in between.
    """
    bounds, fans = tier_bounds(fan_in, smallest, target), fan_ins(fan_in, smallest, target)
    tier = sum(((F.col("bytes") >= b).cast("int") for b in bounds), F.lit(0))
    fan = F.element_at(F.array(*map(F.lit, fans)), F.col("tier") + 1)
    runs = written(shards.groupBy("shard").agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")), "runs")
    at = written(runs.select(F.col("shard").alias("old"), "shard"), "shards")
    while True:
        small = _numbered(runs.where(F.col("bytes") < target).withColumn("tier", tier)).withColumn("part", F.floor(F.col("n") / fan))
        whole = small.groupBy("tier", "part").agg(F.min("shard").alias("name"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.count("*").alias("many")).where(F.col("many") == fan)
        whole = written(whole, "merged-runs")
        if whole.isEmpty():
            break
        moves = written(small.select("shard", "tier", "part").join(whole.select("tier", "part", "name"), ["tier", "part"]).select("shard", "name"), "moves")
        at = written(at.join(moves, "shard", "left").select("old", F.coalesce("name", "shard").alias("shard")), "shards")
        runs = written(runs.join(moves, "shard", "left_anti").unionAll(whole.select(F.col("name").alias("shard"), "rows", "bytes")), "runs")
    return at.join(runs, "shard").select("old", "shard", F.col("rows").alias("shard_rows"), F.col("bytes").alias("shard_bytes"), tier.alias("tier"))


def current(spark: SparkSession, store: str) -> tuple[int, DataFrame]:
    """The newest version, 0 if there is none, and its live shards (store_batch, store_file, shard, rows, bytes)."""
    version = newest(spark, f"{store}/versions")
    return version, spark.read.schema(VERSION).parquet(f"{version_path(f'{store}/versions', version)}/shards") if version else spark.createDataFrame([], VERSION)


def columns_of(spark: SparkSession, store: str, version: int) -> StructType:
    """The documents' columns in a version."""
    return StructType.fromJson(json.loads(spark.read.text(f"{version_path(f'{store}/versions', version)}/columns").first()[0])) if version else StructType([])


def merged_columns(before: StructType, now: StructType) -> StructType:
    """The columns before and the new ones after them; raises ``ValueError`` if one has another type than before."""
    known, out = {f.name.lower(): f for f in before}, list(before)
    for field in now:
        old, own = known.get(field.name.lower()), StructField(field.name, _nullable(field.dataType))
        if old is None:
            out.append(own)
        elif old.dataType != own.dataType:
            raise ValueError(f"column {field.name} is {own.dataType.simpleString()}, in the store it is {old.dataType.simpleString()}")
    return StructType(out)


def _nullable(kind):
    """A type whose parts may all be null, as files give it back."""
    text = StructType([StructField("x", kind)]).json()
    for part in ("nullable", "containsNull", "valueContainsNull"):
        text = text.replace(f'"{part}":false', f'"{part}":true')
    return StructType.fromJson(json.loads(text))["x"].dataType


def _commit(spark: SparkSession, store: str, rows: DataFrame, columns: StructType, base: int) -> int:
    staged = f"{store}/staged/{uuid.uuid4().hex}"
    stage(rows.select(*LIST), f"{staged}/shards", 1 + rows.count() // LISTED)
    spark.createDataFrame([(columns.json(),)], "columns string").coalesce(1).write.text(f"{staged}/columns")
    return commit(spark, staged, f"{store}/versions", base)


def _write(rows: DataFrame, store: str, run_files: bool) -> DataFrame:
    """Write rows with their ``store_shard`` as one new batch; returns its shards (store_batch, store_file, shard, rows, bytes).

    ``run_files``: a file for each shard, else each task writes one file of the shards that were dealt to it.
    """
    spark, batch = rows.sparkSession, f"b{uuid.uuid4().hex}"
    columns = [c for c in rows.columns if c != "store_shard"]
    file = F.col("store_shard").cast("string") if run_files else F.lit(ARRIVALS)
    dealt = rows.repartition(parallelism(spark), "store_shard").select(*(F.col(f"`{c}`") for c in columns), "store_shard", file.alias("store_file")).sortWithinPartitions("store_file", "store_shard")
    with without_shuffle_files(spark):
        dealt.write.option("compression", "zstd").partitionBy("store_file").parquet(f"{store}/data/store_batch={batch}")
    found = _files(spark, store, [batch], StructType([f for f in rows.schema if f.name.lower() == "text"]))
    size = F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).cast("long")
    return written(found.groupBy("store_batch", "store_file", F.col("store_shard").alias("shard")).agg(F.count("*").alias("rows"), size.alias("bytes")), "new-shards")


def _files(spark: SparkSession, store: str, batches: list[str], columns: StructType) -> DataFrame:
    """The rows of some batches, dead ones too, with store_shard, store_batch and store_file."""
    schema = StructType([*columns, StructField("store_shard", LongType()), StructField("store_batch", StringType()), StructField("store_file", StringType())])
    return spark.read.schema(schema).option("basePath", f"{store}/data").parquet(*(f"{store}/data/store_batch={b}" for b in batches))


def append(docs: DataFrame, store: str, rows: int = ARRIVAL_ROWS) -> int:
    """Write new documents as small immutable shards and commit a version that lists them too; returns the version.

    An arrival that the store has already gets another shard of the same number; both are read. An empty table commits
    nothing.
    """
    spark = docs.sparkSession
    base, live = current(spark, store)
    docs = docs.drop(*OWN)
    columns = merged_columns(columns_of(spark, store, base), docs.schema)
    if docs.isEmpty():
        return base
    new = _write(docs.withColumn("store_shard", arrival_of(rows)), store, False)
    return _commit(spark, store, live.unionByName(new), columns, base)


def _small(table: DataFrame) -> DataFrame:
    """Sent to all tasks if it has few rows, else left to a shuffle join."""
    return F.broadcast(table) if table.limit(MAX_BROADCAST_SHARDS + 1).count() <= MAX_BROADCAST_SHARDS else table


def _live(spark: SparkSession, store: str, version: int, live: DataFrame) -> DataFrame:
    """The documents of the ``live`` shards of a version, with ``store_shard``."""
    columns = columns_of(spark, store, version)
    batches = sorted(r[0] for r in live.select("store_batch").distinct().collect())  # one for each append or compaction
    if not batches:
        return spark.createDataFrame([], StructType([*columns, StructField("store_shard", LongType())]))
    rows = _files(spark, store, batches, columns)
    keys = _small(live.select("store_batch", F.col("shard").alias("store_shard")))
    return rows.join(keys, ["store_batch", "store_shard"], "left_semi").select(*(F.col(f"`{c}`") for c in columns.names), "store_shard")


def read(spark: SparkSession, store: str) -> DataFrame:
    """The documents of the newest version, with their ``shard``."""
    version, live = current(spark, store)
    if not version:
        raise ValueError(f"{store} has no version")
    return _live(spark, store, version, live).withColumnRenamed("store_shard", "shard")


def compact(spark: SparkSession, store: str, plan: DataFrame, base: int) -> int:
    """Rewrite the runs of ``plan(old, shard)`` that merge several shards and commit the version after ``base``.

    Shards that lie in a file of arrivals with merging ones get files of their own, so that ``vacuum`` can remove that file.
    """
    version, live = current(spark, store)
    if version != base:
        raise ValueError(f"the plan is for version {base}, the store is at {version}")
    runs = plan.select(F.col("old").alias("shard"), F.col("shard").alias("run"))
    many = runs.groupBy("run").agg((F.count("*") > 1).alias("merges"))
    moves = live.join(runs.join(many, "run"), "shard", "left").select(*LIST, F.coalesce("run", "shard").alias("run"), F.coalesce("merges", F.lit(False)).alias("merges"))
    # A number that was appended twice is one shard in the plan, in two batches.
    twice = live.groupBy("shard").agg((F.count("*") > 1).alias("twice"))
    moves = moves.join(twice, "shard").withColumn("merges", F.col("merges") | F.col("twice"))
    touched = moves.where("merges").select("store_batch", "store_file").distinct().withColumn("touched", F.lit(True))
    moves = written(moves.join(touched, ["store_batch", "store_file"], "left").withColumn("touched", F.coalesce("touched", F.lit(False))), "moves")
    moving = moves.where("touched")
    if moving.isEmpty():
        return base
    columns = columns_of(spark, store, base)
    rows = _live(spark, store, base, moving)
    of_run = _small(moving.select(F.col("shard").alias("store_shard"), F.col("run").alias("shard")).distinct())
    rows = rows.join(of_run, "store_shard").select(*(F.col(f"`{c}`") for c in columns.names), F.col("shard").alias("store_shard"))
    new = _write(rows, store, True)
    return _commit(spark, store, moves.where("not touched").select(*LIST).unionByName(new), columns, base)


def vacuum(spark: SparkSession, store: str) -> None:
    """Remove files that the newest version doesn't list, and older versions. Not while others write to the store."""
    version, live = current(spark, store)
    kept = {r["store_batch"]: r["n"] for r in live.select("store_batch", "store_file").distinct().groupBy("store_batch").agg(F.count("*").alias("n")).collect()}
    for folder in children(spark, f"{store}/data"):
        path, batch = f"{store}/data/{folder}", folder.partition("=")[2]
        if batch not in kept:
            remove(spark, path)
            continue
        files = [x for x in children(spark, path) if x.startswith("store_file=")]
        if kept[batch] < len(files):
            mine = {f"store_file={r[0]}" for r in live.where(F.col("store_batch") == batch).select("store_file").distinct().toLocalIterator()}
            for dead in files:
                if dead not in mine:
                    remove(spark, f"{path}/{dead}")
    for old in children(spark, f"{store}/versions"):
        if old != version_path("", version)[1:]:
            remove(spark, f"{store}/versions/{old}")


def sharded(docs: DataFrame, rows: int = ARRIVAL_ROWS, fan_in: int = FAN_IN, smallest: int = SMALLEST, target: int = TARGET) -> DataFrame:
    """``docs`` from a new store, with shard, shard_rows, shard_bytes and tier: appended, planned, compacted, read again."""
    spark = docs.sparkSession
    if docs.isEmpty():
        return docs.drop(*OWN).select("*", *(F.lit(None).cast(t).alias(c) for c, t in (("shard", "long"), ("shard_rows", "long"), ("shard_bytes", "long"), ("tier", "int"))))
    store = scratch_dir(spark, "store")
    version = append(docs, store, rows)
    plan = written(plan_compaction(current(spark, store)[1], fan_in, smallest, target), "compaction")
    compact(spark, store, plan, version)
    vacuum(spark, store)
    of_shard = plan.select("shard", "shard_rows", "shard_bytes", "tier").distinct()
    found = read(spark, store)
    return found.join(_small(of_shard), "shard").select(*(F.col(f"`{c}`") for c in found.columns if c != "shard"), "shard", "shard_rows", "shard_bytes", "tier")


def op1_sharding(spark, sf_dir: str) -> DataFrame:
    return sharded(documents(spark, sf_dir)).select("doc_id", "shard", "shard_rows", "shard_bytes", "tier")


_TIER = " + ".join(f"(bytes >= {b})::INT" for b in tier_bounds(FAN_IN, SMALLEST, TARGET))
_FAN = f"list_extract([{', '.join(map(str, fan_ins(FAN_IN, SMALLEST, TARGET)))}], tier + 1)"
#: Rounds of the SQL; more than the tables of the correctness check need (rounds without a merge change nothing).
_SQL_ROUNDS = 8


def _round_sql(k: int) -> str:
    return f"""
t{k} AS (SELECT *, {_TIER} AS tier, bytes < {TARGET} AS small FROM r{k}),
q{k} AS (SELECT *, (row_number() OVER (PARTITION BY small, tier ORDER BY shard) - 1) // {_FAN} AS part FROM t{k}),
m{k} AS (SELECT *, CASE WHEN small AND count(*) OVER (PARTITION BY small, tier, part) = {_FAN} THEN min(shard) OVER (PARTITION BY small, tier, part) ELSE shard END AS name FROM q{k}),
r{k + 1} AS (SELECT name AS shard, flatten(list(arrivals)) AS arrivals, sum(rows)::BIGINT AS rows, sum(bytes)::BIGINT AS bytes FROM m{k} GROUP BY name)"""


_ARRIVAL = f"coalesce(CAST(floor(doc_id / {ARRIVAL_ROWS}) AS BIGINT), -1 - CAST(concat('0x', substr(md5(coalesce(text, '')), 1, 3)) AS BIGINT))"
SQL = f"""
WITH s AS (SELECT {_ARRIVAL} AS arrival, count(*) AS rows, coalesce(sum(octet_length(encode(text))), 0)::BIGINT AS bytes FROM documents GROUP BY 1),
r0 AS (SELECT arrival AS shard, [arrival] AS arrivals, rows::BIGINT AS rows, bytes FROM s),
{",".join(_round_sql(k) for k in range(_SQL_ROUNDS)).strip()},
p AS (SELECT unnest(arrivals) AS arrival, shard, rows AS shard_rows, bytes AS shard_bytes, {_TIER} AS tier FROM r{_SQL_ROUNDS})
SELECT doc_id, shard, shard_rows, shard_bytes, tier FROM documents JOIN p ON {_ARRIVAL} = arrival
"""

"""Joins and windows over intervals (start_pos, end_pos; 1-based, inclusive).

Every operator takes the columns that its groups have in common (``keys``, with the sequence among them).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Width of the bins of a range join, and of the tiles that split a long sequence in running computations.
BIN, TILE = 10_000, 1 << 20


def _bins(first: Column, last: Column, width: int) -> Column:
    return F.sequence(F.floor(first / width), F.floor(last / width))


#: Bins of an interval at its own scale at most, and how much wider the bins of the next scale are; the number of scales.
SPREAD, SCALES = 16, 7


def _scale(width: int) -> Column:
    """The scale of an interval: its bins are ``width * SPREAD ** scale`` wide, so that it lies in ``SPREAD`` + 1 at most."""
    size = F.col("end_pos") - F.col("start_pos")
    return sum(((size >= width * SPREAD ** (k + 1)).cast("int") for k in range(SCALES - 1)), F.lit(0))


def _scales(left: DataFrame, right: DataFrame, width: int) -> tuple[list[int], list[int]]:
    """The scales of both tables' intervals, ``SCALES`` numbers each at most, by one small job."""
    of = lambda df, side: df.where("start_pos is not null and end_pos is not null").select(F.lit(side).alias("side"), _scale(width).alias("scale"))
    found = of(left, 0).unionAll(of(right, 1)).distinct().collect()
    return tuple(sorted(r["scale"] for r in found if r["side"] == side) or [0] for side in (0, 1))


def _dealt(df: DataFrame, width: int, other: Sequence[int], own: Sequence[int]) -> DataFrame:
    """``df`` with ``__at`` (scale and bin): bins at the own scale, and at the greater scales that the other side has.

    An interval is shorter than the bins of a greater scale, and lies in two of them at most.
    """
    bins = lambda k: F.transform(_bins(F.col("start_pos"), F.col("end_pos"), width * SPREAD**k), lambda b: F.struct(F.lit(k).alias("scale"), b.alias("bin")))
    rows = df.withColumn("__scale", _scale(width))
    parts = [F.when((F.col("__scale") == k) | (F.lit(k in other) & (F.col("__scale") < k)), bins(k)) for k in sorted({*own, *other})]
    return rows.withColumn("__at", F.explode(F.flatten(F.array_compact(F.array(*parts)))))


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], strict: bool = True, width: int = BIN, how: str = "inner") -> DataFrame:
    """Pairs of overlapping intervals with equal keys; the right side's columns get the prefix ``r_``.

    ``strict``: intervals that share just one boundary base don't overlap. Both sides are dealt to bins, so that a join on
    (keys, scale, bin) is an equi-join. An interval has bins of its own scale, by its length, and a bin or two of each
    greater scale that the other side has, so that a long feature makes few rows and doesn't meet all short ones of its
    kind at a narrow scale. A pair meets at the greater one of its scales, in the first bin that both have there, which
    makes it once without a ``distinct``. A bin with very many intervals is split by Spark's adaptive join.
    ``how`` may be ``left_semi``: then each left row that overlaps any comes once.
    """
    ours, theirs = _scales(left, right, width)
    a = _dealt(left, width, theirs, ours)
    b = _dealt(right, width, ours, theirs)
    b = b.select(*(F.col(c).alias(f"r_{c}") for c in right.columns), F.col("__at").alias("__r_at"), F.col("__scale").alias("__r_scale"))
    on = (F.col("__at") == F.col("__r_at")) & (F.col("__at.scale") == F.greatest("__scale", "__r_scale"))
    for k in keys:
        on &= F.col(k) == F.col(f"r_{k}")
    if strict:
        on &= (F.col("start_pos") < F.col("r_end_pos")) & (F.col("end_pos") > F.col("r_start_pos"))
    else:
        on &= (F.col("start_pos") <= F.col("r_end_pos")) & (F.col("end_pos") >= F.col("r_start_pos"))
    if how == "left_semi":
        return a.join(b, on, "left_semi").select(*left.columns).distinct()
    wide = sum((F.when(F.col("__at.scale") == k, F.lit(width * SPREAD**k)).otherwise(0) for k in {*ours, *theirs}), F.lit(0))
    once = F.col("__at.bin") == F.floor(F.greatest("start_pos", "r_start_pos") / wide)
    return a.join(b, on & once).drop("__at", "__r_at", "__scale", "__r_scale", *(f"r_{k}" for k in keys))


def comparisons(left: DataFrame, right: DataFrame, keys: Sequence[str], width: int = BIN) -> float:
    """How many rows of the two sides meet in the bins of ``overlap_join``, by a job that shuffles a row for each bin."""
    ours, theirs = _scales(left, right, width)
    sizes = lambda df, other, own, name: _dealt(df, width, other, own).groupBy(*keys, "__at").agg(F.count("*").cast("double").alias(name))
    both = sizes(left, theirs, ours, "ours").join(sizes(right, ours, theirs, "theirs"), [*keys, "__at"])
    return both.agg(F.coalesce(F.sum(F.col("ours") * F.col("theirs")), F.lit(0.0))).first()[0]


def overlap_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], groups: Sequence[str], width: int = TILE, **flags: Column) -> DataFrame:
    """(keys, groups, n_overlaps): how many right intervals each left one overlaps, added up over the groups of left rows.

    No pair is made: what overlaps an interval starts before its end and doesn't end by its start, so that the number is a
    difference of two ranks (intervals that share just one boundary base don't overlap, as in ``overlap_join``). Running
    counts cross stretches of ``width`` places by a small table, so that no sequence is one task. Every group of left rows
    with keys and positions comes, with 0 if nothing overlaps it. ``start_pos`` may not be behind ``end_pos``.
    ``flags`` are conditions on right rows; the overlaps with those that meet one come as a column of its name.
    """
    known = " and ".join(f"{c} is not null" for c in (*keys, "start_pos", "end_pos"))
    point, counts = F.col("start_pos") == F.col("end_pos"), {"n_overlaps": F.lit(True), **flags}
    # Steps order what lies at one place; of two intervals of one base there, neither overlaps the other.
    event = lambda place, step, kind: F.struct(F.col(place).cast("long").alias("place"), step.alias("step"), F.lit(kind).alias("kind"))
    asked = F.array(event("end_pos", F.lit(0), "upto"), event("start_pos", F.when(point, 2).otherwise(4), "from"))
    given = F.array(event("start_pos", F.lit(1), "start"), event("end_pos", F.when(point, 3).otherwise(1), "end"))
    rows = left.where(known).select(*keys, F.struct(*groups).alias("__of"), *(F.lit(0).alias(c) for c in counts), F.inline(asked))
    none = F.lit(None).cast(rows.schema["__of"].dataType)
    rows = rows.unionAll(right.where(known).select(*keys, none, *(F.when(on, 1).otherwise(0).alias(c) for c, on in counts.items()), F.inline(given)))
    rows = rows.withColumn("__stretch", F.floor(F.col("place") / width))
    by = [*keys, "__stretch"]
    before = W.partitionBy(*keys).orderBy("__stretch").rowsBetween(W.unboundedPreceding, -1)
    upto = W.partitionBy(*by).orderBy("place", "step").rowsBetween(W.unboundedPreceding, W.currentRow)
    of_kind = {(c, kind): F.sum(F.when(F.col("kind") == kind, F.col(c)).otherwise(0)) for c in counts for kind in ("start", "end")}
    ahead = rows.groupBy(*by).agg(*(n.alias(f"{c}_{kind}") for (c, kind), n in of_kind.items()))
    ahead = ahead.select(*by, *(F.coalesce(F.sum(f"{c}_{kind}").over(before), F.lit(0)).alias(f"__{c}_{kind}") for c, kind in of_kind))
    rows = rows.withColumns({f"{c}_{kind}": n.over(upto) for (c, kind), n in of_kind.items()}).where("kind in ('upto', 'from')").join(ahead, by)
    rank = lambda c, kind: F.col(f"{c}_{kind}") + F.col(f"__{c}_{kind}")
    found = rows.groupBy(*keys, "__of").agg(*(F.sum(F.when(F.col("kind") == "upto", rank(c, "start")).otherwise(-rank(c, "end"))).alias(c) for c in counts))
    return found.select(*keys, "__of.*", *counts)


def band_join(left: DataFrame, right: DataFrame, keys: Sequence[str], column: str, reach: int, step: int = 1) -> DataFrame:
    """Pairs whose ``column`` differs by at most ``reach`` and by a multiple of ``step``; right columns get ``r_``."""
    prefixed = right.select(*(F.col(c).alias(f"r_{c}") for c in right.columns))
    width = reach + 1
    a = left.withColumn("__bin", F.floor(F.col(column) / width))
    b = prefixed.withColumn("__r_bin", F.explode(_bins(F.col(f"r_{column}") - reach, F.col(f"r_{column}") + reach, width)))
    apart = F.col(column) - F.col(f"r_{column}")
    on = (F.col("__bin") == F.col("__r_bin")) & (F.abs(apart) <= reach) & (apart % step == 0)
    for k in keys:
        on &= F.col(k) == F.col(f"r_{k}")
    return a.join(b, on).drop("__bin", "__r_bin", *(f"r_{k}" for k in keys))


def islands(df: DataFrame, keys: Sequence[str], reach: int, tile: int = TILE) -> DataFrame:
    """``df`` with ``island_start``: the first base of the chain of intervals that each one belongs to.

    An interval joins the chain before it if it starts at most ``reach`` bases behind the furthest end so far: 1 joins
    touching intervals, 0 only those that share a base. Sequences are cut into tiles by start; running ends and chain
    starts cross the tiles by way of a small table of tile totals, so that no sequence is one task.
    """
    t = df.withColumn("__tile", F.floor(F.col("start_pos") / tile))
    by = [*keys, "__tile"]
    before = W.partitionBy(*keys).orderBy("__tile").rowsBetween(W.unboundedPreceding, -1)
    ends = t.groupBy(*by).agg(F.max("end_pos").alias("__end")).select(*by, F.max("__end").over(before).alias("__before"))
    order = W.partitionBy(*by).orderBy("start_pos", "end_pos")
    t = t.join(ends, by)
    furthest = F.greatest("__before", F.max("end_pos").over(order.rowsBetween(W.unboundedPreceding, -1)))
    opens = furthest.isNull() | (F.col("start_pos") > furthest + reach)
    t = t.withColumn("__opens", F.when(opens, F.col("start_pos")))
    starts = t.groupBy(*by).agg(F.max("__opens").alias("__last")).select(*by, F.max("__last").over(before).alias("__from"))
    t = t.join(starts, by)
    # By range, so that of equal intervals each gets the start that one of them opens.
    return t.withColumn("island_start", F.coalesce(F.max("__opens").over(order.rangeBetween(W.unboundedPreceding, W.currentRow)), "__from")).drop("__tile", "__before", "__opens", "__from")


def merge_intervals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, start_pos, end_pos, n): intervals that overlap or touch become one; ``n`` counts them."""
    merged = islands(df.select(*keys, "start_pos", "end_pos"), keys, 1).groupBy(*keys, "island_start")
    return merged.agg(F.max("end_pos").alias("end_pos"), F.count("*").alias("n")).select(*keys, F.col("island_start").alias("start_pos"), "end_pos", "n")


def cluster_intervals(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with ``cluster_start``: clusters of intervals that share bases (touching ones don't)."""
    return islands(df, keys, 0).withColumnRenamed("island_start", "cluster_start")


def longest_gap(merged: DataFrame, lengths: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, longest_gap): the longest run of bases outside the merged intervals of each row of ``lengths(keys, length)``."""
    nexts = following(merged.select(*keys, "start_pos", "end_pos"), keys, F.col("start_pos"), F.col("start_pos"))
    inner = nexts.groupBy(*keys).agg(F.max(F.col("next") - F.col("end_pos") - 1).alias("between"), F.min("start_pos").alias("first"), F.max("end_pos").alias("last"))
    found = lengths.join(inner, list(keys), "left")
    gap = F.greatest("between", F.col("first") - 1, F.col("length") - F.col("last"))
    return found.select(*keys, F.when(F.col("first").isNull(), F.col("length")).otherwise(gap).alias("longest_gap"))


def tiles_of(seqs: DataFrame, longest: int, overlap: int) -> DataFrame:
    """Chunks (chunk_no, chunk_start, chunk_end) of rows with a ``length``: each starts ``longest - overlap`` after the last."""
    step = longest - overlap
    n = F.when(F.col("length") > longest, F.floor((F.col("length") - longest) / step) + 2).otherwise(1).cast("int")
    rows = seqs.withColumn("chunk_no", F.explode(F.sequence(F.lit(1), n)))
    start = (F.col("chunk_no") - 1).cast("long") * step + 1
    return rows.withColumn("chunk_start", start).withColumn("chunk_end", F.least(F.col("length"), F.col("chunk_start") + longest - 1))


def introns(exons: DataFrame, transcript: Sequence[str]) -> DataFrame:
    """(transcript, donor_end, acceptor_start, intron_len) between neighbouring exons of a transcript."""
    following = F.lead("start_pos").over(W.partitionBy(*transcript).orderBy("start_pos", "end_pos"))
    pairs = exons.withColumn("acceptor_start", following).where("acceptor_start is not null").withColumnRenamed("end_pos", "donor_end")
    return pairs.withColumn("intron_len", F.col("acceptor_start") - F.col("donor_end") - 1).drop("start_pos")


def cumulative_offset(exons: DataFrame, transcript: Sequence[str], strand: str = "strand") -> DataFrame:
    """``exons`` with ``offset``: the bases of a transcript before an exon, in the direction of its strand."""
    order = W.partitionBy(*transcript).orderBy(F.col("start_pos") * F.col(strand), F.col("end_pos") * F.col(strand))
    length = F.col("end_pos") - F.col("start_pos") + 1
    return exons.withColumn("offset", F.coalesce(F.sum(length).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))


def numbered(df: DataFrame, groups: Sequence[str], order: Sequence[str | Column], name: str = "number", place: Column | None = None, width: int = TILE) -> DataFrame:
    """Rows numbered from 1 inside each group.

    ``place``: what the order begins with, if that is a number. Groups are then cut into stretches of ``width`` places and
    numbered inside them; the counts of the stretches before come from a small table, so that no group is one task.
    """
    if place is None:
        return df.withColumn(name, F.row_number().over(W.partitionBy(*groups).orderBy(*order)))
    t = df.withColumn("__stretch", F.floor(place / width))
    by = [*groups, "__stretch"]
    before = W.partitionBy(*groups).orderBy("__stretch").rowsBetween(W.unboundedPreceding, -1)
    ahead = t.groupBy(*by).agg(F.count("*").alias("__n")).select(*by, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__ahead"))
    inside = F.row_number().over(W.partitionBy(*by).orderBy(*order))
    return t.withColumn("__inside", inside).join(ahead, by).withColumn(name, F.col("__ahead") + F.col("__inside")).drop("__stretch", "__inside", "__ahead")


def latest(df: DataFrame, keys: Sequence[str], value: Column, order: Sequence[str], stretch: Column, name: str) -> DataFrame:
    """``df`` with the last ``value`` up to each row that isn't null, in the order of ``order``.

    ``stretch`` grows with the order: values cross from stretch to stretch by way of a small table of last values.
    """
    t = df.withColumn("__v", value).withColumn("__stretch", stretch)
    by = [*keys, "__stretch"]
    before = W.partitionBy(*keys).orderBy("__stretch").rowsBetween(W.unboundedPreceding, -1)
    ends = t.groupBy(*by).agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.struct(*order))).alias("__last"))
    ends = ends.select(*by, F.last("__last", ignorenulls=True).over(before).alias("__before"))
    inside = F.last("__v", ignorenulls=True).over(W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return t.withColumn("__inside", inside).join(ends, by).withColumn(name, F.coalesce("__inside", "__before")).drop("__v", "__stretch", "__inside", "__before")


def following(df: DataFrame, keys: Sequence[str], value: Column, place: Column, name: str = "next", width: int = TILE) -> DataFrame:
    """``df`` with the next larger ``value`` among the rows of its keys (null for the last), in the order of ``place``.

    Places are cut into stretches of ``width``; the last row of a stretch gets the first value of the next one that has
    any, from a small table of first values, so that no sequence is one task.
    """
    t = df.withColumn("__v", value).withColumn("__stretch", F.floor(place / width))
    by = [*keys, "__stretch"]
    beyond = t.groupBy(*by).agg(F.min("__v").alias("__first")).select(*by, F.lead("__first").over(W.partitionBy(*keys).orderBy("__stretch")).alias("__beyond"))
    inside = F.lead("__v").over(W.partitionBy(*by).orderBy("__v"))
    return t.withColumn("__inside", inside).join(beyond, by).withColumn(name, F.coalesce("__inside", "__beyond")).drop("__v", "__stretch", "__inside", "__beyond")


class Overlaps:
    """Intervals of one group in a task, in classes by length, each sorted by start.

    Of a class of lengths below ``2 ** k`` those that reach into a stretch start at most that far before it, so that looking
    them up costs about what is found. A class is packed once half of what it had is gone.
    """

    def __init__(self, start: np.ndarray, end: np.ndarray):
        self.start, self.end, self.left = start, end, np.ones(len(start), bool)
        kind = np.ceil(np.log2(np.maximum(end - start, 1) + 1)).astype(int)
        self.classes = {k: rows[np.argsort(start[rows], kind="stable")] for k in np.unique(kind).tolist() for rows in [np.flatnonzero(kind == k)]}
        self.starts = {k: start[rows] for k, rows in self.classes.items()}
        self.gone = dict.fromkeys(self.classes, 0)

    def over(self, low: int, high: int) -> np.ndarray:
        """What is left of the intervals that start before ``high`` and end behind ``low``."""
        found = [np.zeros(0, np.int64)]
        for k, rows in self.classes.items():
            first, last = np.searchsorted(self.starts[k], (low - (1 << k), high))
            rows = rows[first:last]
            found.append(rows[self.left[rows] & (self.end[rows] > low)])
        return np.concatenate(found)

    def drop(self, rows: np.ndarray) -> None:
        self.left[rows] = False
        for k, of in self.classes.items():
            self.gone[k] += len(rows)
            if 2 * self.gone[k] > len(of) > 64:
                self.classes[k] = of = of[self.left[of]]
                self.starts[k], self.gone[k] = self.start[of], 0


def folded(df: DataFrame, keys: Sequence[str], order: Sequence[str], fold: Callable[[tuple, dict], list[tuple]], schema: str, per_partition: int = 8) -> DataFrame:
    """``fold`` over each group of ``keys``, for results that depend on an order: new rows from a group's names and arrays.

    The arrays are sorted by ``order`` (a minus sign: downwards). Groups are dealt to a few buckets a partition, so that
    many small ones share a call; a bucket has to fit into memory.
    """
    buckets = per_partition * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys, columns = list(keys), [c.split()[0] for c in schema.split(", ")]

    def each(bucket: pd.DataFrame) -> pd.DataFrame:
        bucket = bucket.sort_values([*keys, *(c.lstrip("-") for c in order)], ascending=[True] * len(keys) + [c[0] != "-" for c in order], kind="stable", ignore_index=True)
        first = np.flatnonzero((bucket[keys] != bucket[keys].shift()).any(axis=1).to_numpy())
        last = np.append(first[1:], len(bucket))
        arrays = {c: bucket[c].to_numpy() for c in bucket.columns}
        names = zip(*(arrays[k][first].tolist() for k in keys), strict=True)
        rows = [row for name, low, high in zip(names, first.tolist(), last.tolist(), strict=True) for row in fold(name, {c: a[low:high] for c, a in arrays.items()})]
        return pd.DataFrame(rows, columns=columns)

    return df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("__bucket")).applyInPandas(each, schema)


def chosen(df: DataFrame, keys: Sequence[str], order: Sequence[str], choose: Callable[[dict], tuple[Sequence[int], dict]], schema: str, per_partition: int = 8) -> DataFrame:
    """Rows that ``choose`` takes from each group of ``keys``, for choices that depend on an order.

    ``choose`` gets the columns of one group as arrays, sorted by ``order``, and gives the places of its rows and new values
    of columns for them. Groups of one row pass as they are. Groups are dealt to a few buckets a partition, so that many
    small ones share a call; a bucket has to fit into memory.
    """
    buckets = per_partition * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys, columns = list(keys), [c.split()[0] for c in schema.split(", ")]

    def each(bucket: pd.DataFrame) -> pd.DataFrame:
        bucket = bucket.sort_values([*keys, *order], kind="stable", ignore_index=True)
        first = np.flatnonzero((bucket[keys] != bucket[keys].shift()).any(axis=1).to_numpy())
        last = np.append(first[1:], len(bucket))
        arrays = {c: bucket[c].to_numpy() for c in bucket.columns}
        single = last - first == 1
        rows, values = [first[single]], {}
        for low, high in zip(first[~single].tolist(), last[~single].tolist(), strict=True):
            at, new = choose({c: a[low:high] for c, a in arrays.items()})
            rows.append(np.asarray(at, np.int64) + low)
            for c, v in new.items():
                values.setdefault(c, [arrays[c][first[single]]]).append(np.asarray(v))
        found = bucket.iloc[np.concatenate(rows)][columns]
        return found.assign(**{c: np.concatenate(v) for c, v in values.items()})

    return df.groupBy(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("__bucket")).applyInPandas(each, schema)

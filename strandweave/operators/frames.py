"""Reading frames on tiles: what lies between two stop codons of a frame.

Each tile finds its own codons. What lies between two stops of one tile is known there at once; what crosses the borders
is put together from a summary for each tile, strand and frame: its first and last stop, and the first and last ATG before
the former and behind the latter (an open tile has no stop). Summaries between two stops merge by least and greatest, so
that a sequence is a few rows for each tile, and codons are rows only where they bound a stretch.

Places are those of a codon's first base on the plus strand (``p``, from 1) until spans are on their strand's own axis.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .kmers import tile_chunks

STOPS = ("TAA", "TAG", "TGA")

_CODE = np.full(256, 4, np.uint8)
for _letters in (b"ACGT", b"acgt"):
    _CODE[np.frombuffer(_letters, np.uint8)] = range(4)
_COMPLEMENT = str.maketrans("ACGT", "TGCA")


def _flags() -> np.ndarray:
    """For each codon's number: 1 for a stop, 2 for ATG on the plus strand, 4 and 8 for those on the minus strand."""
    out = np.zeros(125, np.uint8)
    number = lambda c: sum("ACGT".index(x) * 5**i for i, x in zip((2, 1, 0), c, strict=True))
    for flag, codons in ((1, STOPS), (2, ("ATG",))):
        for codon in codons:
            out[number(codon)] |= flag
            out[number(codon.translate(_COMPLEMENT)[::-1])] |= 4 * flag
    return out


_FLAGS = _flags()
#: Stops and ATGs of a tile and frame have keys of this size each, so that a tile has fewer bases.
_ROOM = 1 << 40
SPANS = "seq_id string, strand int, r int, before_p long, next_p long, atg_p long"
SUMMARIES = "seq_id string, strand int, r int, tile_start long, first_stop long, last_stop long, head_low long, head_high long, tail_low long, tail_high long"
PIECES = "seq_id string, strand int, r int, start_pos long, end_pos long, part string"


def _codons(starts: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each strand: tile and remainder of each stop (``3 * tile + p % 3``), and the sorted keys of stops and of ATGs.

    A key holds tile and remainder above and ``p`` below.
    """
    codes = _CODE[data].astype(np.int16)
    n = max(len(codes) - 2, 0)
    number = codes[:n] * 25 + codes[1 : n + 1] * 5 + codes[2 : n + 2]
    flags = _FLAGS[number]
    at = np.flatnonzero(flags)
    tile = np.searchsorted(bounds, at, "right") - 1
    inside = at + 2 < bounds[tile + 1]
    at, tile = at[inside], tile[inside]
    p = starts[tile] + 1 + at - bounds[tile]
    keys, kind = (3 * tile + p % 3) * _ROOM + p, flags[at]
    for strand, stop in ((1, 1), (-1, 4)):
        stops = np.sort(keys[(kind & stop) > 0])
        yield strand, stops // _ROOM, stops, np.sort(keys[(kind & (2 * stop)) > 0])


def _inner(strand: int, group: np.ndarray, stops: np.ndarray, atgs: np.ndarray) -> tuple[np.ndarray, ...]:
    """Group, ``p`` of the stops before and behind on the strand's axis and of the first ATG (0: none) of the spans in tiles."""
    pair = np.flatnonzero(group[1:] == group[:-1])
    low, high = stops[pair], stops[pair + 1]
    atgs = np.concatenate([[-1], atgs, [np.iinfo(np.int64).max]])
    if strand == 1:
        atg = atgs[np.searchsorted(atgs, low, "right")]
    else:
        atg = atgs[np.searchsorted(atgs, high, "left") - 1]
    atg = np.where((low < atg) & (atg < high), atg % _ROOM, 0)
    low, high = low % _ROOM, high % _ROOM
    return (group[pair], low, high, atg) if strand == 1 else (group[pair], high, low, atg)


def _nullable(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64(), mask=values == 0)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, starts, data, bounds in tile_chunks(batches):
        for strand, group, stops, atgs in _codons(starts, data, bounds):
            group, before, behind, atg = _inner(strand, group, stops, atgs)
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(group // 3)), pa.array(np.full(len(group), strand, np.int32)), pa.array((group % 3).astype(np.int32)), pa.array(before), pa.array(behind), _nullable(atg)], names=[c.split()[0] for c in SPANS.split(", ")])


def _pieces(shortest: int, longest: int, starts_only: bool, reverse: bool):
    """The spans in tiles (or from their first ATG on) of a size, on the plus strand's axis and with their bases there."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, starts, data, bounds in tile_chunks(batches):
            upper = np.where((data >= 97) & (data <= 122), data - np.uint8(32), data)
            for strand, group, stops, atgs in _codons(starts, data, bounds):
                if strand == -1 and not reverse:
                    continue
                group, before, behind, atg = _inner(strand, group, stops, atgs)
                low, high = (before + 3, behind - 1) if strand == 1 else (behind + 3, before - 1)
                if starts_only:
                    low, high = (atg, high) if strand == 1 else (low, atg + 2)
                size = high - low + 1
                good = np.flatnonzero((size >= shortest) & (size <= longest) & ((atg > 0) | (not starts_only)))
                group, low, high, size = group[good], low[good], high[good], size[good]
                tile = group // 3
                ends = np.cumsum(size)
                first = bounds[tile] + low - 1 - starts[tile]
                text = upper[np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
                parts = pa.LargeStringArray.from_buffers(len(good), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)), pa.py_buffer(text)).cast(pa.string())
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(tile)), pa.array(np.full(len(good), strand, np.int32)), pa.array((group % 3).astype(np.int32)), pa.array(low), pa.array(high), parts], names=[c.split()[0] for c in PIECES.split(", ")])

    return of


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, starts, data, bounds in tile_chunks(batches):
        for strand, group, stops, atgs in _codons(starts, data, bounds):
            groups = np.unique(np.concatenate([group, atgs // _ROOM]))
            floor, roof = groups * _ROOM, (groups + 1) * _ROOM
            none, many = np.zeros(1, np.int64), lambda keys, side, at: np.searchsorted(keys, at, side)
            first, last = many(stops, "left", floor), many(stops, "left", roof) - 1
            padded = np.concatenate([stops, none])
            has = first <= last
            first_stop, last_stop = np.where(has, padded[first], 0), np.where(has, padded[last], 0)
            # ATGs before the first stop (all, if there is none) and behind the last one.
            head = (many(atgs, "left", floor), many(atgs, "left", np.where(has, first_stop, roof)) - 1)
            tail = (many(atgs, "left", np.where(has, last_stop, roof)), many(atgs, "left", roof) - 1)
            wide = np.concatenate([atgs, none])
            values = [first_stop, last_stop, *(np.where(a <= b, wide[x], 0) for a, b in (head, tail) for x in (a, b))]
            tile = groups // 3
            columns = [ids.take(pa.array(tile)), pa.array(np.full(len(groups), strand, np.int32)), pa.array((groups % 3).astype(np.int32)), pa.array(starts[tile] + 1), *(_nullable(v % _ROOM) for v in values)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SUMMARIES.split(", ")])


def _tiles(tiles: DataFrame) -> DataFrame:
    return tiles.select("seq_id", F.col("tile_start").cast("long"), "residues").where("residues is not null")


def _framed(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """``rows`` with the length of the sequence and the frame on the strand's axis instead of the remainder."""
    frame = F.when(F.col("strand") == 1, F.pmod(F.col("r") - 1, F.lit(3))).otherwise(F.pmod(F.col("length") - F.col("r") - 2, F.lit(3))).cast("int")
    return rows.join(lengths.select("seq_id", "length"), "seq_id").withColumn("frame", frame).drop("r")


def _axis(p: Column | str) -> Column:
    p = F.col(p) if isinstance(p, str) else p
    return F.when(F.col("strand") == 1, p).otherwise(F.col("length") - p - 1)


def border_spans(tiles: DataFrame, lengths: DataFrame) -> DataFrame:
    """The spans of ``open_spans`` that aren't between two stops of one tile."""
    key = ["seq_id", "strand", "r"]
    rows = _tiles(tiles).mapInArrow(_summaries, SUMMARIES)
    # One row for each tile and frame.
    passed = F.sum(F.col("first_stop").isNotNull().cast("long")).over(W.partitionBy(*key).orderBy("tile_start").rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("g", F.coalesce(passed, F.lit(0)))
    piece = lambda g, low, high, left, right: F.struct(g.alias("g"), F.col(low).alias("low"), F.col(high).alias("high"), left.alias("left"), right.alias("right"))
    none = F.lit(None).cast("long")
    head, tail = piece(F.col("g"), "head_low", "head_high", none, F.col("first_stop")), piece(F.col("g") + 1, "tail_low", "tail_high", F.col("last_stop"), none)
    pieces = rows.select(*key, F.explode(F.when(F.col("first_stop").isNull(), F.array(head)).otherwise(F.array(head, tail))).alias("x")).select(*key, "x.*")
    sides = F.array(*(F.struct(F.lit(s).alias("strand"), F.lit(r).alias("r")) for s in (1, -1) for r in (0, 1, 2)))
    ends = lengths.select("seq_id", F.explode(sides).alias("s")).select("seq_id", "s.*", F.lit(0).cast("long").alias("g"), *(none.alias(c) for c in ("low", "high", "left", "right")))
    merged = pieces.unionByName(ends).groupBy(*key, "g").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("left").alias("left"), F.max("right").alias("right"))
    rows = _framed(merged, lengths)
    plus = F.col("strand") == 1
    start = (F.col("frame") - 2).cast("long")
    end = (F.col("frame") + F.greatest(F.floor((F.col("length") - F.col("frame")) / 3), F.lit(0)) * 3 + 1).cast("long")
    first, last = F.when(plus, F.col("left")).otherwise(F.col("right")), F.when(plus, F.col("right")).otherwise(F.col("left"))
    return rows.select("seq_id", "length", "strand", "frame", F.coalesce(_axis(first), start).alias("before"), F.coalesce(_axis(last), end).alias("next"), last.isNotNull().alias("stops"), _axis(F.when(plus, F.col("low")).otherwise(F.col("high"))).alias("atg"))


def open_spans(tiles: DataFrame, lengths: DataFrame) -> DataFrame:
    """(seq_id, length, strand, frame, before, next, stops, atg): what lies between two stops of a frame, on its strand's axis.

    ``before`` and ``next`` are the first bases of the stops around; the ends of the sequence count as stops, and ``stops``
    tells whether ``next`` is a real one. ``atg`` is the first ATG behind ``before``, if one comes before ``next``.
    ``tiles`` share two bases with the next one.
    """
    inner = _framed(_tiles(tiles).mapInArrow(_spans, SPANS), lengths)
    inner = inner.select("seq_id", "length", "strand", "frame", _axis("before_p").alias("before"), _axis("next_p").alias("next"), F.lit(True).alias("stops"), _axis("atg_p").alias("atg"))
    return inner.unionByName(border_spans(tiles, lengths))


def inner_frames(tiles: DataFrame, lengths: DataFrame, shortest: int, longest: int, starts_only: bool, reverse: bool) -> DataFrame:
    """(seq_id, length, strand, frame, start_pos, end_pos, part): spans between two stops of a tile, with their bases on the
    plus strand; ``starts_only`` takes them from their first ATG on."""
    return _framed(_tiles(tiles).mapInArrow(_pieces(shortest, longest, starts_only, reverse), PIECES), lengths)

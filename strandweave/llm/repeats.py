"""Exact search for windows of units (bytes or words) that occur more than once in a corpus.

A window of ``window`` units holds one *anchor*, a stretch of units that its content alone determines, so that equal
windows have their anchors at equal offsets. Consecutive windows with one anchor form a *run*; its ``context`` is all
units that they cover.

Round 1 deals packed anchors by key, the anchor's name. A run whose context repeats is settled at once; a run whose key
repeats in other contexts goes on to round 2, which compares its single windows. Rounds ship about one row for
``window / 3`` units, and repeated contexts of one batch are merged before the shuffle, so that frequent passages don't
pile up in one task.

Names (``Hasher``) are residues modulo the prime 2**61 - 1: they only bring candidates together. Whether contexts or
windows are equal is decided by their content: by the first 128 bits of the SHA-256 of their bytes (``digests``).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parallelism

U = np.uint64
PRIME = (1 << 61) - 1
BASE = 0x1E3779B97F4A7C15 % PRIME
_P, _LOW31, _LOW30 = U(PRIME), U((1 << 31) - 1), U((1 << 30) - 1)
#: Bytes of text in one pass, anchors in one flush, contexts of a key beyond which its windows are dealt one by one.
CHUNK_BYTES, FLUSH, HOT_CONTEXTS = 700_000, 250_000, 20_000
#: Contexts of one key in one flush beyond which its rows are dealt by context.
HOT_IN_FLUSH = 64
SETTLED, OPEN, HOT, SALTED = 1, 2, 3, 8
BLOB = "bucket int, key binary, ctx binary, doc binary, pk binary"


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x ^= x >> U(29)
    x *= U(0xA24BAED4963EE407)
    x ^= x >> U(32)
    return x


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & _P) + (x >> U(61))
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a * b`` modulo the prime, for residues."""
    a1, a0, b1, b0 = a >> U(31), a & _LOW31, b >> U(31), b & _LOW31
    middle = a1 * b0 + a0 * b1
    return _reduced(((a1 * b1) << U(1)) + (middle >> U(30)) + ((middle & _LOW30) << U(31)) + a0 * b0)


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, by doubling; ``n`` is a power of two."""
    out = []
    for base in (BASE, pow(BASE, -1, PRIME)):
        powers, step = np.ones(1, U), base
        while len(powers) < n:
            powers, step = np.concatenate([powers, times(powers, U(step))]), step * step % PRIME
        out.append(powers)
    return out[0], out[1]


class Hasher:
    """Names of any stretch of a unit array, from prefix sums of ``value * BASE**-i`` modulo 2**61 - 1.

    Two unequal stretches of ``n`` units share a name with a chance of about ``n / 2**61``.
    """

    def __init__(self, values: np.ndarray):
        size = 1 << max(20, int(len(values) + 1).bit_length())
        self.up, down = _powers(size)
        # Sums of 31 and 30 bits each stay below 2**63 for any text that fits into memory.
        terms = times(_reduced(values), down[: len(values)])
        self.low, self.high = np.zeros(len(values) + 1, U), np.zeros(len(values) + 1, U)
        np.cumsum(terms & _LOW31, dtype=U, out=self.low[1:])
        np.cumsum(terms >> U(31), dtype=U, out=self.high[1:])

    def __len__(self) -> int:
        return len(self.low) - 1

    @staticmethod
    def _name(low: np.ndarray, high: np.ndarray, power: np.ndarray) -> np.ndarray:
        high = _reduced(high)
        return mix(times(_reduced(_reduced(low) + ((high & _LOW30) << U(31)) + (high >> U(30))), power))

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._name(self.low[end] - self.low[start], self.high[end] - self.high[start], self.up[start])

    def fixed(self, length: int) -> np.ndarray:
        n = len(self.low) - length
        return self._name(self.low[length:] - self.low[:n], self.high[length:] - self.high[:n], self.up[:n])


def digests(content: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """128 bits of the SHA-256 of each stretch of bytes, as two numbers in a row."""
    view, sha = memoryview(content), hashlib.sha256
    joined = b"".join([sha(view[a:b]).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)])
    return np.ascontiguousarray(np.frombuffer(joined, U).reshape(-1, 4)[:, :2])


def equal_bytes(data: np.ndarray, one: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes at ``one`` and at ``other`` are the same, for each pair of places."""
    edges = np.concatenate([[0], np.cumsum(size)])
    step = np.arange(edges[-1]) - np.repeat(edges[:-1], size)
    differs = np.concatenate([[0], np.cumsum(data[np.repeat(one, size) + step] != data[np.repeat(other, size) + step])])
    return differs[edges[1:]] == differs[edges[:-1]]


def leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, the index of its first least value."""
    at, best, span = np.arange(len(values), dtype=np.int32), values, 1
    while span < width:
        step = min(span, width - span)
        lower = best[step:] < best[:-step]
        best = np.where(lower, best[step:], best[:-step])
        at = np.where(lower, at[step:], at[:-step])
        span += step
    return at


def runs_of(at: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first window and number of windows of each run, from the anchor ``at`` of every window."""
    n = len(at)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    inside = np.arange(n) + window <= bounds[doc + 1]
    new = np.ones(n, bool)
    new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new & inside)
    # Windows that cross into the next document end a run early.
    stop = np.append(first[1:], n)
    return doc[first], first, np.minimum(stop, bounds[doc[first] + 1] - window + 1) - first


def pack(first: np.ndarray, q: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first`` must already count from the start of its document."""
    return (first.astype(np.int64) << 16) | ((q - first).astype(np.int64) << 10) | (count.astype(np.int64) << 4)


def unpack(pk: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, anchor's distance from it, windows, status."""
    return pk >> 16, (pk >> 10) & 63, (pk >> 4) & 63, pk & 15


def text_chunks(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row range, UTF-8 bytes and the documents' bounds in them, for about CHUNK_BYTES at a time."""
    texts = batch.column(batch.schema.get_field_index(column))
    big = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    if not len(texts):
        return
    offsets = np.frombuffer(offsets, np.int64 if big else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + CHUNK_BYTES, "right")) - 1)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def release() -> None:
    """Give memory that Arrow keeps for later back: a reused worker would hold it through the stages to come."""
    pa.default_memory_pool().release_unused()


def split_groups(order_key: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    order = np.argsort(order_key, kind="stable")
    sorted_key = order_key[order]
    edges = np.flatnonzero(np.diff(sorted_key, prepend=-1, append=-1)) if len(order) else []
    for low, high in zip(edges[:-1], edges[1:], strict=False):
        yield int(sorted_key[low]), [c[order[low:high]] for c in columns]


def _flush(parts: list[tuple], buckets: int, earlier: bool) -> Iterator[pa.RecordBatch]:
    key, ctx, doc, pk = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((pk, doc, ctx[:, 1], ctx[:, 0], key))
    key, ctx, doc, pk = key[order], ctx[order], doc[order], pk[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (ctx[1:] != ctx[:-1]).any(1)
    head = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    if earlier:  # a later document's copy is settled here; the first document's rows go on
        done = doc[head] < doc
    else:  # copies are settled; the first goes on with a mark that it is one of several
        again = np.append(~new[1:], False) & new
        done = ~new
        pk = np.where(again, pk | SETTLED, pk)
    pk = np.where(done, pk | SETTLED, pk)
    # A key with many contexts is dealt by context, but for one row, which tells the key's own bucket that it is hot.
    new_key = np.append(True, key[1:] != key[:-1])
    group = np.cumsum(new_key) - 1
    hot = (np.bincount(group, new)[group] > HOT_IN_FLUSH) & ~done
    pk = np.where(hot, pk | SALTED, pk)
    # Settled rows only pass through: they have key 0 and may go to any bucket.
    bucket = np.where(done, mix(doc.astype(U)), np.where(hot & ~new_key, mix(key ^ ctx[:, 0]), key))
    bucket = (bucket % U(buckets)).astype(np.int64)
    # Inside a bucket half of the key tells keys apart; should two share it, their contexts still differ.
    key = np.where(done, U(0), np.maximum(key >> U(32), U(1))).astype(np.uint32)
    # Back in the order of the text, in which documents and places compress well.
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    bucket, key, ctx, doc, pk = (c[back] for c in (bucket, key, ctx, doc, pk))
    rows = []
    for b, cols in split_groups(bucket, key, ctx, doc, pk):
        going = cols[0] != 0
        rows.append((b, cols[0].tobytes(), cols[1][going].tobytes(), cols[2].tobytes(), cols[3].tobytes()))
    if rows:
        cols = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["bucket", "key", "ctx", "doc", "pk"])


def anchor_rows(docs: DataFrame, chunk_runs: Callable, buckets: int, earlier: bool) -> DataFrame:
    """Packed anchors of ``docs(doc_id, text)``.

    ``chunk_runs(bytes, bounds)`` gives the runs of a chunk (key, context's digest, document, first window, anchor, windows)
    and the documents' bounds in units. A key of 0 is not used (it marks settled rows).
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for low, high, data, bounds in text_chunks(batch):
                key, ctx, doc, first, q, count, units = chunk_runs(data, bounds)
                start = units[doc]
                parts.append((np.maximum(key, U(1)), ctx, ids[low:high][doc].astype(np.int64), pack(first - start, q - start, count)))
                held += len(key)
                if held >= FLUSH:
                    yield from _flush(parts, buckets, earlier)
                    parts, held = [], 0
            release()
        if held:
            yield from _flush(parts, buckets, earlier)

    return docs.select("doc_id", "text").mapInArrow(of, BLOB)


def buckets_of(batches: Iterator[pa.RecordBatch], dtypes: list) -> Iterator[list[np.ndarray]]:
    """The columns of one bucket after another from rows sorted by bucket."""
    now, held = None, []
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for i, bucket in enumerate(columns[0].to_pylist()):
            if bucket != now and held:
                yield [np.concatenate(c) for c in zip(*held, strict=True)]
                held = []
            now = bucket
            held.append([np.frombuffer(c[i].as_buffer(), t) for c, t in zip(columns[1:], dtypes, strict=True)])
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def bucket_count(df: DataFrame) -> int:
    """Two buckets for each shuffle partition: a packed row for each task and bucket, and half a partition in memory."""
    return 2 * parallelism(df.sparkSession)


def dealt(blobs: DataFrame) -> DataFrame:
    """Buckets are dealt by their number, so that each partition gets as many."""
    return blobs.repartitionById(parallelism(blobs.sparkSession), "bucket").sortWithinPartitions("bucket")


def settle(blobs: DataFrame, earlier: bool) -> DataFrame:
    """Round 1: rows (doc_id, pk) of runs that are settled (status 1), or go on to single windows (2, or 3 for hot keys).

    ``earlier``: a run counts if a smaller doc_id has its context, else if it occurs anywhere else.
    A status of ``OPEN | 4`` or ``HOT | 4`` marks a settled run that stands for its context in round 2.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, ctx, doc, pk in buckets_of(batches, [np.uint32, U, np.int64, np.int64]):
            passed, ctx = key == 0, ctx.reshape(-1, 2)
            out_doc, out_pk = [doc[passed]], [(pk[passed] & ~15) | SETTLED]
            key, doc, pk = (c[~passed] for c in (key, doc, pk))
            if len(key):
                order = np.lexsort((doc, ctx[:, 1], ctx[:, 0], key))
                key, ctx, doc, pk = key[order], ctx[order], doc[order], pk[order]
                index = np.arange(len(key))
                new_key = np.ones(len(key), bool)
                new_key[1:] = key[1:] != key[:-1]
                new_ctx = new_key.copy()
                new_ctx[1:] |= (ctx[1:] != ctx[:-1]).any(1)
                head = np.maximum.accumulate(np.where(new_ctx, index, 0))
                group = np.cumsum(new_key) - 1
                contexts = np.bincount(group, new_ctx)[group]
                salted = np.maximum.reduceat(pk & SALTED, np.flatnonzero(new_key))[group] > 0
                several = (contexts > 1) | salted
                if earlier:
                    settled = doc[head] < doc
                    goes_on = several & ~settled
                else:
                    size = np.bincount(np.cumsum(new_ctx) - 1)[np.cumsum(new_ctx) - 1]
                    marked = np.maximum.reduceat((pk & SETTLED != 0).astype(np.int8), np.flatnonzero(new_ctx))[np.cumsum(new_ctx) - 1] > 0
                    settled = (size > 1) | marked
                    goes_on = several & new_ctx
                status = np.where(goes_on, np.where((contexts > HOT_CONTEXTS) | salted, HOT, OPEN), 0) | np.where(settled, 4, 0)
                keep = status > 0
                out_doc.append(doc[keep])
                status = np.where(status == 4, SETTLED, status)
                out_pk.append((pk[keep] & ~15) | status[keep])
            doc, pk = np.concatenate(out_doc), np.concatenate(out_pk)
            release()
            for low in range(0, len(doc), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(doc[low : low + 200_000]), pa.array(pk[low : low + 200_000])], names=["doc_id", "pk"])

    return dealt(blobs).mapInArrow(of, "doc_id long, pk long")


def is_settled(pk: np.ndarray) -> np.ndarray:
    return ((pk & 15) == SETTLED) | ((pk & 4) > 0)


def listed(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` with the array ``marks`` of all pk of each document (null: none).

    With the same filter and columns each time, Spark shuffles the texts once for all joins of a plan.
    """
    return docs.where("doc_id is not null").select("doc_id", "text").join(marks.groupBy("doc_id").agg(F.collect_list("pk").alias("marks")), "doc_id", "left")


def marks_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_id, and flat marks with their bounds, of a batch of ``listed`` rows."""
    lists = batch.column(2)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.array([len(x) if x is not None else 0 for x in lists.to_numpy(zero_copy_only=False)], np.int64) if len(lists) else np.zeros(0, np.int64)
    return batch.column(0).to_numpy(zero_copy_only=False), flat, np.concatenate([[0], np.cumsum(sizes)])


def covered(length: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``length`` units lie in any of the intervals [start, end)."""
    if not len(start):
        return np.zeros(length, bool)
    steps = np.zeros(length + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, end, -1)
    return np.cumsum(steps[:-1]) > 0

"""Removal of byte strings that an earlier document already has, by longest-previous-factor arrays.

``LPF[i]`` is the length of the longest string that starts at suffix ``i`` and also starts in an earlier document. In
suffix order it is the larger of two common prefixes: with the nearest suffix above that belongs to an earlier document
(previous smaller position) and with the nearest one below (next smaller position). A window of ``min_bytes`` goes if the
LPF at its start is that long.

A corpus has no single suffix array. ``repeats`` deals all windows by an anchor (the least 20-byte gram in them), so that
equal windows are in one bucket; windows whose anchor no other document has take no further part, and runs of windows
whose whole content an earlier document has too are settled as copies of it before the sort (equal suffixes would only
stand side by side). Suffix, common-prefix and previous-factor arrays of the rest are built a bucket at a time.

Null texts are empty. Texts shorter than ``min_bytes`` stay whole. Each row is a document. Rows are taken in the order of
their doc_ids, rows with one doc_id in the order of their texts, rows without a doc_id last (see ``numbered``). A text has to fit
into a task, with about 50 bytes for each of its own. An empty table gives an empty result. Other columns are ignored and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats as R
from .common import documents, numbered, written

#: Length of the hashed grams that anchor the windows.
GRAM = 20
#: Suffixes sorted at once.
SLICE = 400_000
#: Windows of hot anchors that are merged at once (50 bytes each).
HELD = 200_000
_TABLE = R.mix(np.arange(1, 257, dtype=np.uint64) * R.U(0x9E3779B97F4A7C15))
_STEP = R.U(0x9FB21C651E98DF25)


def words_at(data: np.ndarray, order: str = "<") -> np.ndarray:
    """The eight bytes from each place on as a number; ``>`` makes numbers in the order of the bytes."""
    return np.ndarray(max(len(data) - 7, 0), f"{order}u8", np.ascontiguousarray(data), strides=(1,)).astype(np.uint64)


def window_names(data: np.ndarray, length: int) -> np.ndarray:
    """A name for the ``length`` bytes at each place. Equal bytes have equal names, others hardly ever; nothing relies on it."""
    n = max(len(data) - length + 1, 0)
    if length < 8 or not n:
        return R.Hasher(_TABLE[data]).fixed(length) if n else np.zeros(0, R.U)
    eight, names = words_at(data), np.zeros(n, R.U)
    for k in sorted({*range(0, length - 7, 8), length - 8}):
        names = (names + eight[k : k + n]) * _STEP
        names ^= names >> R.U(29)
    return R.mix(names)


def _chunk_runs(min_bytes: int):
    gram = min(GRAM, max(1, min_bytes // 2))

    def of(data: np.ndarray, bounds: np.ndarray) -> tuple:
        n = len(data) - min_bytes + 1
        if n < 1:
            return np.zeros(0, R.U), np.zeros((0, 2), R.U), *(np.zeros(0, np.int64) for _ in range(4)), bounds
        names = window_names(data, gram)
        at = R.leftmost_minimum(names, min_bytes - gram + 1)[:n]
        doc, first, count = R.runs_of(at, bounds, min_bytes)
        q = at[first].astype(np.int64)
        return names[q], R.digests(data.tobytes(), first, first + count - 1 + min_bytes), doc, first, q, count, bounds

    return of


def suffix_order(data: np.ndarray, start: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``start``, cut to ``depth``; and the length of each one's common prefix with the one before."""
    eight = words_at(np.concatenate([data, np.zeros(8, np.uint8)]), ">")
    offsets = sorted({*range(0, depth - 7, 8), depth - 8}) if depth >= 8 else [0]
    words = [eight[start + o] for o in offsets]
    if depth < 8:
        words = [words[0] >> np.uint64(64 - 8 * depth) << np.uint64(64 - 8 * depth)]
    order = np.lexsort(words[::-1])
    common = np.full(len(order), depth)
    common[:1] = 0
    for o, w in zip(reversed(offsets), reversed(words), strict=True):
        w = w[order]
        changed = np.zeros(len(order), np.uint64)
        changed[1:] = w[1:] ^ w[:-1]
        at = np.flatnonzero(changed)
        # The first byte that differs: 8 minus the bytes up to the highest one that is set.
        same = sum((changed[at] < np.uint64(1) << np.uint64(56 - 8 * k)).astype(np.int64) for k in range(7))
        common[at] = o + same
    return order, common


def nearest_smaller(rank: np.ndarray, common: np.ndarray, longest: int) -> np.ndarray:
    """For each place, the least of ``common`` on the way up to the previous smaller ``rank``; 0 if there is none.

    ``common[i]`` belongs to the step from ``i - 1`` to ``i``. Blocks of doubling size are skipped as long as no rank in
    them is smaller; ways are followed for ``longest`` places.
    """
    n = len(rank)
    rank = np.concatenate([[np.iinfo(np.int64).min], rank])  # stops all ways; the step to it has no common prefix
    common = np.concatenate([[0, 0], common[1:]]) if n else common
    lows, steps = [rank], [common]  # over the 2**k places that end at i
    while 1 << (len(lows) - 1) < min(longest, n):
        half = 1 << (len(lows) - 1)
        low, step = lows[-1].copy(), steps[-1].copy()
        low[half:] = np.minimum(lows[-1][half:], lows[-1][:-half])
        step[half:] = np.minimum(steps[-1][half:], steps[-1][:-half])
        lows.append(low), steps.append(step)
    own = rank[1:]
    at, least = np.arange(n), common[1:].copy()  # ``at``: the place above, after the step to it
    for k in range(len(lows) - 1, -1, -1):
        skip = lows[k][at] >= own
        least = np.where(skip, np.minimum(least, steps[k][at]), least)
        at = np.where(skip, np.maximum(at - (1 << k), 0), at)
    return np.where(rank[at] < own, least, 0)


def longest_previous_factors(data: np.ndarray, start: np.ndarray, doc: np.ndarray, depth: int) -> np.ndarray:
    """LPF, cut to ``depth``, of the suffixes at ``start`` that belong to ``doc``; all have ``depth`` bytes.

    Suffixes whose neighbours share less than ``depth`` bytes with them get the longer of these common prefixes, as a
    bound: theirs is below ``depth`` anyhow.
    """
    order, common = suffix_order(data, start, depth)
    below = np.append(common[1:], 0)[: len(common)]
    lpf = np.zeros(len(order), np.int64)
    lpf[order] = np.maximum(common, below)
    deep = np.flatnonzero((common >= depth) | (below >= depth))
    if len(deep):
        rank, step = doc[order[deep]], common[deep]
        groups = np.flatnonzero(step < depth)
        longest = int(np.diff(np.append(groups, len(deep))).max())
        up = nearest_smaller(rank, step, longest)
        down = nearest_smaller(rank[::-1], np.append(0, step[:0:-1]), longest)[::-1]
        lpf[order[deep]] = np.maximum(up, down)
    return lpf


def _first_of_equal(windows: np.ndarray, names: np.ndarray, doc: np.ndarray, local: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``windows`` (a row of bytes each) that go on, and those whose bytes a smaller ``doc`` among them has."""
    order = np.lexsort((local, doc, names))
    new = np.ones(len(order), bool)
    new[1:] = (names[order][1:] != names[order][:-1]) | (windows[order[1:]] != windows[order[:-1]]).any(1)
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    later = doc[order][head] < doc[order]
    return np.sort(order[~later]), order[later]


def _contexts(min_bytes: int, buckets: int):
    """Round 2, map side: the bytes around open runs, dealt by anchor, or window by window where the anchor is hot.

    Windows of hot anchors are held back and merged: those that an earlier document of the task has are settled here, so
    that a passage of very many documents is a row for each flush.
    """
    gram = min(GRAM, max(1, min_bytes // 2))

    def blobs(bucket: np.ndarray, data: np.ndarray, at: np.ndarray, many: np.ndarray, docs: np.ndarray, pk: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows, size = [], np.where(many > 0, many + min_bytes - 1, 0)
        for b, (a, d, p, z) in R.split_groups(bucket.astype(np.int64), at, docs, pk, size):
            index = np.repeat(a - np.cumsum(z) + z, z) + np.arange(z.sum())
            rows.append((b, data[index].tobytes(), d.tobytes(), p.tobytes()))
        if rows:
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])], names=["bucket", "bytes", "doc", "pk"])

    def merged(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        windows, names, doc, local = (np.concatenate(x) for x in zip(*held, strict=True))
        going, done = _first_of_equal(windows, names, doc, local)
        one = np.full(len(going), 1)
        yield from blobs(names[going] % np.uint64(buckets), windows.ravel(), going * min_bytes, one, doc[going], local[going] << 16 | 1 << 4)
        yield from blobs(R.mix(doc[done].astype(R.U)) % np.uint64(buckets), windows.ravel(), done, np.zeros(len(done), np.int64), doc[done], local[done] << 16 | 1 << 4 | R.SETTLED)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            ids, flat, edges = R.marks_of(batch)
            for low, high, data, bounds in R.text_chunks(batch):
                marks = flat[edges[low] : edges[high]]
                if not len(marks):
                    continue
                row = np.repeat(np.arange(high - low), np.diff(edges[low : high + 1]))
                first, dq, count, status = R.unpack(marks)
                docs, at = ids[low:high][row].astype(np.int64), first + bounds[row]
                hot = status == R.HOT
                cold = ~hot
                yield from blobs(window_names(data, gram)[(at + dq)[cold]] % np.uint64(buckets), data, at[cold], count[cold], docs[cold], first[cold] << 16 | count[cold] << 4)
                spread = np.repeat(np.flatnonzero(hot), count[hot])
                if len(spread):
                    step = np.arange(len(spread)) - np.repeat(np.cumsum(count[hot]) - count[hot], count[hot])
                    start = at[spread] + step
                    held.append((np.lib.stride_tricks.sliding_window_view(data, min_bytes)[start], window_names(data, min_bytes)[start], docs[spread], first[spread] + step))
                    if sum(len(x[1]) for x in held) >= HELD:
                        yield from merged(held)
                        held = []
        if held:
            yield from merged(held)

    return of


def _factors(min_bytes: int):
    """Round 2, reduce side: windows with a previous factor, as runs."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, doc, pk in R.buckets_of(batches, [np.uint8, np.int64, np.int64]):
            passed = pk & 15 == R.SETTLED
            yield pa.RecordBatch.from_arrays([pa.array(doc[passed]), pa.array(pk[passed])], names=["doc_id", "pk"])
            doc, pk = doc[~passed], pk[~passed]
            first, _, count, _ = R.unpack(pk)
            base = np.cumsum(count + min_bytes - 1) - (count + min_bytes - 1)
            run = np.repeat(np.arange(len(pk)), count)
            step = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
            start = base[run] + step
            found = np.zeros(len(run), bool)
            names = window_names(data, min_bytes)[start]
            # A window whose name no other has has no factor of its length; equal windows are in one slice.
            order = np.argsort(names, kind="stable")
            same = names[order][1:] == names[order][:-1]
            shared = order[np.append(same, False) | np.append(False, same)]
            names, low = names[shared], 0
            while low < len(shared):
                high = int(np.searchsorted(names, names[min(low + SLICE, len(shared)) - 1], "right"))
                own = shared[low:high]
                found[own] = longest_previous_factors(data, start[own], doc[run[own]], min_bytes) >= min_bytes
                low = high
            R.release()
            new = found.copy()
            new[1:] &= ~(found[:-1] & (run[1:] == run[:-1]))
            begin = np.flatnonzero(new)
            length = np.bincount(np.cumsum(new)[found] - 1, minlength=len(begin)) if len(begin) else begin
            at = first[run[begin]] + step[begin]
            yield pa.RecordBatch.from_arrays([pa.array(doc[run[begin]]), pa.array(at << 16 | length << 4 | R.SETTLED)], names=["doc_id", "pk"])

    return of


def find_repeated_bytes(docs: DataFrame, min_bytes: int = 50) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept (binary: the bytes that stay).

    A byte goes if a string of ``min_bytes`` bytes covers it that also starts in a document with a smaller doc_id.
    """
    if min_bytes > 60 or min_bytes < 2:
        raise ValueError("min_bytes must be from 2 to 60")
    docs, named = numbered(docs)
    buckets = R.bucket_count(docs)
    marks = written(R.settle(R.anchor_rows(docs, _chunk_runs(min_bytes), buckets, True), True), "suffix-runs")
    open_docs = R.listed(docs, marks.where("pk & 15 > 1"))
    blobs = open_docs.where("marks is not null").mapInArrow(_contexts(min_bytes, buckets), "bucket int, bytes binary, doc binary, pk binary")
    found = R.dealt(blobs).mapInArrow(_factors(min_bytes), "doc_id long, pk long")
    done = R.listed(docs, marks.where("pk & 15 = 1").unionAll(found))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            R.release()
            ids, flat, edges = R.marks_of(batch)
            for low, high, data, bounds in R.text_chunks(batch):
                first, _, count, _ = R.unpack(flat[edges[low] : edges[high]])
                at = first + np.repeat(bounds[:-1], np.diff(edges[low : high + 1]))
                gone = R.covered(len(data), at, at + count - 1 + min_bytes)
                rises = gone.copy()
                rises[1:] &= ~gone[:-1]
                inner = bounds[:-1][np.diff(bounds) > 0]
                rises[inner] = gone[inner]
                sums, ups = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, rises))
                kept = [data[a:b].tobytes() if sums[a] == sums[b] else data[a:b][~gone[a:b]].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids[low:high]), pa.array(np.diff(bounds)), pa.array(np.diff(sums[bounds])), pa.array(np.diff(ups[bounds])), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return named(done.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))


def op10_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    found = find_repeated_bytes(documents(spark, sf_dir), 50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

"""Removal of word passages that occur more than once, found by recompression.

Words get names; rounds then name, alike everywhere, runs of equal words and then pairs of a left and a right symbol,
where a coin of the name says which it is. Each round's names are hashes of what they stand for, so all tasks name alike
without a table (one of all pairs would have more bytes than the texts). The symbols' lengths grow by about 4/3 a round.
``recompress`` knows of each symbol which words it depends on: equal passages share all symbols that depend on their own
words alone, their interior symbols.

Every window of ``window`` words is represented by the longest symbol of its interior. Windows meet by a join on these
high-level symbols, and are then compared by their whole content (``repeats``), first in runs with one symbol, then one
by one.

Null or empty texts have no words. Each row is a document; rows with one doc_id, or without, are told apart (see
``numbered``), and equal texts are repeats of each other. A text has to fit into a task, with about 50 bytes for each of its
own. An empty table gives an empty result. Other columns are
ignored and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats as R
from .common import documents, numbered, written

#: Rounds of pairs, words beyond which a symbol joins no other, words of the shortest symbol that windows are joined on.
ROUNDS, LONGEST, SHORTEST = 6, 12, 3
_TABLE = R.mix(np.arange(501, 757, dtype=np.uint64) * R.U(0x9E3779B97F4A7C15))
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word in the bytes, and the documents' bounds in words."""
    solid = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], solid[:-1]])
    after = np.concatenate([solid[1:], [False]])
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(start, bounds)


def recompress(names: np.ndarray, units: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, ...]:
    """Symbols after a round of runs and ``rounds`` rounds of pairs: name, start, end, low, high (in words).

    A symbol is there because of the words from ``low`` to ``high`` alone: any text with these words has it at the same
    place. Words beyond the document's ends count as outside, so such a symbol depends on the end of its text.
    """
    n = len(names)
    doc = np.repeat(np.arange(len(units) - 1), np.diff(units))
    head = np.ones(n, bool)
    head[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(head)
    end = np.append(start[1:], n)[: len(start)]
    size = end - start
    name = np.where(size > 1, R.mix(names[start] + size.astype(R.U)), names[start])
    doc, low, high = doc[start], start - 1, end + 1  # runs end where the words beside them differ
    for turn in range(1, rounds + 1):
        side = (R.mix(name ^ R.U(0x5851F42D4C957F2D * turn & 0xFFFFFFFFFFFFFFFF)) & R.U(1)).astype(np.int8)
        side = np.where(end - start > LONGEST, 2, side)
        joins = np.zeros(len(name) + 1, bool)
        joins[1:-1] = (side[:-1] == 0) & (side[1:] == 1) & (doc[:-1] == doc[1:])
        gets, goes = joins[1:], joins[:-1]
        # A left symbol that stays single has looked at its right neighbour, a right one at its left neighbour.
        edge_high, edge_low = units[doc + 1] + 1, units[doc] - 1
        next_high = np.where(np.append(doc[1:] == doc[:-1], False)[: len(name)], np.append(high[1:], 0)[: len(name)], edge_high)
        last_low = np.where(np.append(False, doc[1:] == doc[:-1])[: len(name)], np.append(0, low[:-1])[: len(name)], edge_low)
        high = np.where(gets | (side == 0), next_high, high)
        low = np.where(~gets & ~goes & (side == 1), last_low, low)
        after = np.minimum(np.arange(1, len(name) + 1), max(len(name) - 1, 0))
        name = np.where(gets, R.mix(name * R.U(3) + R.mix(name[after])), name)[~goes]
        end = np.where(gets, end[after], end)[~goes]
        start, low, high, doc = start[~goes], low[~goes], high[~goes], doc[~goes]
    return name, start, end, low, high


def anchors(names: np.ndarray, units: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The anchor of the window at each word: its number, the key to join on, and its first word.

    The anchor is the longest symbol that the window's own words determine (of several, that with the least name). A
    window without one of ``SHORTEST`` words is its own anchor.
    """
    n = max(len(names) - window + 1, 0)
    name, start, end, low, high = recompress(names, units)
    size = end - start
    rank = (R.U(255) - np.minimum(size, 255).astype(R.U) << R.U(56)) | (name >> R.U(8))
    first = np.cumsum(np.bincount(low + 1, minlength=n + 2))[:n]  # symbols with low < i
    last = np.concatenate([[0], np.cumsum(np.bincount(high, minlength=n + window + 2))])[window + 1 : window + 1 + n]
    best, best_rank = np.full(n, -1), np.full(n, ~R.U(0))
    k, open_ = 0, np.arange(n)
    while len(open_):
        at = first[open_] + k
        open_, at = open_[at < last[open_]], at[at < last[open_]]
        lower = rank[at] < best_rank[open_]
        best[open_[lower]], best_rank[open_[lower]] = at[lower], rank[at[lower]]
        k += 1
    known = best >= 0
    known[known] = size[best[known]] >= SHORTEST
    whole = R.Hasher(names).fixed(window) if not known.all() else np.zeros(n, R.U)
    pick = np.where(known, best, 0)
    safe = (lambda x, fill: np.where(known, x[pick], fill)) if len(name) else (lambda x, fill: fill)
    return np.where(known, pick, len(name) + np.arange(n)), safe(name, whole), safe(start, np.arange(n))


def _content(data: np.ndarray, bounds: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words of a chunk joined by one space, and where each begins in it (and one place more)."""
    raw = data.tobytes()
    texts = (b" ".join(raw[a:b].split()) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
    return b" ".join(x for x in texts if x), np.concatenate([[0], np.cumsum(end - start + 1)])


def _chunk_runs(window: int):
    def of(data: np.ndarray, bounds: np.ndarray) -> tuple:
        start, end, units = word_spans(data, bounds)
        names = R.Hasher(_TABLE[data])(start, end)
        at, key, place = anchors(names, units, window)
        doc, first, count = R.runs_of(at, units, window)
        content, begin = _content(data, bounds, start, end)
        return key[first], R.digests(content, begin[first], begin[first + count - 1 + window] - 1), doc, first, place[first], count, units

    return of


def _open_windows(window: int, buckets: int):
    """Round 2, map side: the single windows of open runs, by name and by digest of their content."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            ids, flat, edges = R.marks_of(batch)
            for low, high, data, bounds in R.text_chunks(batch):
                marks = flat[edges[low] : edges[high]]
                if not len(marks):
                    continue
                start, end, units = word_spans(data, bounds)
                content, begin = _content(data, bounds, start, end)
                row = np.repeat(np.arange(high - low), np.diff(edges[low : high + 1]))
                first, _, count, _ = R.unpack(marks)
                run = np.repeat(np.arange(len(marks)), count)
                local = first[run] + np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
                at = local + units[row[run]]
                digest = R.digests(content, begin[at], begin[at + window] - 1)
                parts.append((np.maximum(digest[:, 0], R.U(1)), digest, ids[low:high][row[run]].astype(np.int64), R.pack(local, local, np.ones(len(local), np.int64))))
                held += len(run)
                if held >= R.FLUSH:
                    yield from R._flush(parts, buckets, False)
                    parts, held = [], 0
        if held:
            yield from R._flush(parts, buckets, False)

    return of


def remove_repeated_passages(docs: DataFrame, window: int = 35) -> DataFrame:
    """One row a document: doc_id, n_words, n_removed, kept (the words that stay, joined by one space).

    A word goes if a window of ``window`` words covers it whose words also start anywhere else.
    """
    if not 2 <= window <= 60:
        raise ValueError("window must be from 2 to 60")
    docs, named = numbered(docs)
    buckets = R.bucket_count(docs)
    marks = written(R.settle(R.anchor_rows(docs, _chunk_runs(window), buckets, False), False), "passage-runs")
    open_docs = R.listed(docs, marks.where("pk & 2 > 0"))
    blobs = open_docs.where("marks is not null").mapInArrow(_open_windows(window, buckets), R.BLOB)
    found = R.settle(blobs, False)
    done = R.listed(docs, marks.where("pk & 15 <> 2 and pk & 15 <> 3").unionAll(found.where("pk & 15 = 1 or pk & 4 > 0")))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, flat, edges = R.marks_of(batch)
            for low, high, data, bounds in R.text_chunks(batch):
                kept, n_words, n_removed = [], [], []
                for i in range(low, high):
                    words = data[bounds[i - low] : bounds[i - low + 1]].tobytes().split()
                    n_words.append(len(words))
                    if edges[i] < edges[i + 1]:
                        first, _, count, _ = R.unpack(flat[edges[i] : edges[i + 1]])
                        gone = R.covered(len(words), first, first + count - 1 + window)
                        words = [words[k] for k in np.flatnonzero(~gone)]
                    n_removed.append(n_words[-1] - len(words))
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays([pa.array(ids[low:high]), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return named(done.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string"))


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    found = remove_repeated_passages(documents(spark, sf_dir), 35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

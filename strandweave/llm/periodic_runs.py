"""Periodic stretches of texts: runs of words that repeat with one period three times or more, and texts without the copies.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are the same) and at least
``max(SHORTEST, REPEATS * q)`` words that can't be extended by a word on either side with the same period.

Periods below ``DIRECT`` come from direct scans of the words against themselves at each lag. Longer ones come from
minimizers at several scales. The scale of periods from ``2 w`` to below ``4 w`` names all stretches of ``w`` words and
samples a place where the name is the least of a window of ``w`` places that begins there. Inside a run of period ``q``
the window at the least name of a period has its minimum at its own first place, and so has the one a period on: the
same name is sampled ``q`` words apart. Pairs of equal samples at such a distance are seeds, and a seed that extends to
a run's length at its lag is a run. Stretches that have a period of ``w / 3`` words or less themselves are not sampled
(they lie in runs found at smaller scales); others with the same name are more than ``w / 3`` places apart, so that a
sample has at most a dozen partners, however repetitive the text. Each period of a run has a stretch that is sampled,
since a run all of whose stretches had a shorter period would have that period itself.

A stretch found at a lag has a shorter period too only if it is a run of that period with the same ends, so that of
stretches with the same ends the one with the least lag is the run. Every seed's stretch is compared word by word in
the end; words are told apart by 64-bit names.

The texts of a partition are handled some megabytes at a time, with a word of its own between neighbours; there is no
shuffle. A text has to fit into a task, with about 80 bytes for each word. Each row of the input gets one row, whether its
doc_id is missing, repeated or neither. Null and empty texts have no words and no runs; an empty table gives an empty
result. Other columns are ignored and may have any name.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents
from .repeats import Hasher, release, text_chunks
from .words import mix, word_bounds, word_names

SHORTEST, REPEATS = 24, 3
#: Periods below this are scanned directly. Scales begin here, so their stretches have ``DIRECT / 2 = SHORTEST`` words at least.
DIRECT = 2 * SHORTEST
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def rebuilt_places(doc_id: int | None, n: int) -> np.ndarray:
    """The contract's rebuilding: the place of the original word that stands at each place. Rows without a doc_id stay."""
    places = np.arange(n)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            places[a:] = a + (places[a:] - a) % p
    return places


def _stretches(x: np.ndarray, lag: int) -> np.ndarray:
    """(start, end, lag) of the longest stretches of period ``lag`` that are long enough for a run."""
    same = np.zeros(max(len(x) - lag, 0) + 2, bool)
    np.equal(x[lag:], x[:-lag], out=same[1:-1])
    edges = np.flatnonzero(same[1:] != same[:-1])
    start, end = edges[::2], edges[1::2] + lag
    long = end - start >= max(SHORTEST, REPEATS * lag)
    return np.stack([start[long], end[long], np.full(long.sum(), lag)], 1)


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each place on, by running minima of blocks from either side."""
    n = len(values)
    blocks = -(-n // width) + 1
    padded = np.full(blocks * width, _MOST)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, 1).ravel()
    return np.minimum(ahead[:n], behind[width - 1 : width - 1 + n])


def _common(hasher: Hasher, one: np.ndarray, other: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """How many words from (or before) two places on are the same, ``most`` at most, by halving."""
    low, high = np.zeros_like(most), most.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        if back:
            same = hasher(one - middle, one) == hasher(other - middle, other)
        else:
            same = hasher(one, one + middle) == hasher(other, other + middle)
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def _seeded(x: np.ndarray, hasher: Hasher, bounds: np.ndarray, runs: np.ndarray, width: int) -> np.ndarray:
    """(start, end, lag) of stretches whose lag is from ``2 * width`` to below ``4 * width``, from pairs of equal minimizers."""
    names = hasher.fixed(width)
    short = runs[runs[:, 2] * 3 <= width]
    inner = np.zeros(len(x) + 1, np.int32)
    whole = short[:, 1] - width + 1 > short[:, 0]
    np.add.at(inner, short[whole, 0], 1)
    np.add.at(inner, short[whole, 1] - width + 1, -1)
    names = np.where(np.cumsum(inner)[: len(names)] > 0, _MOST, np.minimum(names, _MOST - np.uint64(1)))
    at = np.flatnonzero((_window_minima(names, width) == names) & (names != _MOST))
    at = at[np.lexsort((at, names[at]))]
    of, doc = names[at], np.searchsorted(bounds, at, "right") - 1
    found = []
    for step in range(1, len(at)):
        lag = at[step:] - at[:-step]
        near = (of[step:] == of[:-step]) & (doc[step:] == doc[:-step]) & (lag < 4 * width)
        if not near.any():
            break
        good = near & (lag >= 2 * width)
        found.append(np.stack([at[:-step][good], lag[good]], 1))
    pairs = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
    # Pairs of one lag at most ``width`` places apart lie in one stretch: only the first is extended.
    pairs = pairs[np.lexsort((pairs[:, 0], pairs[:, 1]))]
    head = np.ones(len(pairs), bool)
    head[1:] = (pairs[1:, 1] != pairs[:-1, 1]) | (pairs[1:, 0] - pairs[:-1, 0] > width)
    place, lag = pairs[head].T
    d = np.searchsorted(bounds, place, "right") - 1
    start = place - _common(hasher, place, place + lag, place - bounds[d], True)
    end = place + lag + _common(hasher, place, place + lag, bounds[d + 1] - place - lag, False)
    good = end - start >= np.maximum(SHORTEST, REPEATS * lag)
    return np.stack([start, end, lag], 1)[good]


def find_runs(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """(start, end, period) of all runs of the texts ``x[bounds[i]:bounds[i + 1]]``, by start and period.

    ``x`` are names of words. The last word of each text is the separator, which occurs once in ``x``.
    """
    runs = np.concatenate([_stretches(x, lag) for lag in range(1, min(DIRECT, len(x)))] or [np.zeros((0, 3), np.int64)])
    width, sizes, place = DIRECT // 2, np.diff(bounds), None
    while (long := sizes - 1 >= REPEATS * 2 * width).any():
        # Only texts that can hold such a run go on, without the others between them.
        keep = np.flatnonzero(long)
        sizes_ = sizes[keep]
        edges = np.concatenate([[0], np.cumsum(sizes_)])
        place = np.repeat(bounds[keep] - edges[:-1], sizes_) + np.arange(edges[-1])
        shift = np.zeros(len(bounds) - 1, np.int64)
        shift[keep] = bounds[keep] - edges[:-1]
        doc = np.searchsorted(bounds, runs[:, 0], "right") - 1
        inside = runs[long[doc]] - np.stack([shift[doc], shift[doc], np.zeros(len(doc), np.int64)], 1)[long[doc]]
        part = x[place]
        seeded = _seeded(part, Hasher(part), edges, _smallest(inside), width)
        back = (bounds[keep] - edges[:-1])[np.searchsorted(edges, seeded[:, 0], "right") - 1]
        runs = np.concatenate([runs, seeded + np.stack([back, back, np.zeros(len(back), np.int64)], 1)])
        width *= 2
    runs = _smallest(runs)
    exact = [bool((x[a + q : b] == x[a : b - q]).all()) for a, b, q in runs.tolist()]
    return runs[np.array(exact, bool)]


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of stretches with the same ends the one with the least period, in order."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[first]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _judged(ids: list, data: np.ndarray, bounds: np.ndarray, rebuild: bool) -> Iterator[tuple]:
    """(doc_id, runs, words, kept words' places) of each text of a chunk."""
    start, end, edges = word_bounds(data, bounds)
    names = word_names(data, start, end)
    content, starts, ends = data.tobytes(), start.tolist(), end.tolist()
    n = np.diff(edges)
    # Texts with a word of its own after each.
    own = np.concatenate([[0], np.cumsum(n + 1)])
    places = [rebuilt_places(doc_id if rebuild else None, int(k)) for doc_id, k in zip(ids, n, strict=True)]
    x = np.empty(own[-1], np.uint64)
    for i, at in enumerate(places):
        x[own[i] : own[i + 1] - 1] = names[edges[i] + at]
    x[own[1:] - 1] = mix(np.arange(len(n), dtype=np.uint64) ^ np.uint64(0x5A5A5A5AC3C3C3C3))
    runs = find_runs(x, own)
    low = np.searchsorted(runs[:, 0], own)
    for i, at in enumerate(places):
        of = runs[low[i] : low[i + 1]] - np.array([own[i], own[i], 0])
        word = [content[starts[k] : ends[k]] for k in (edges[i] + at).tolist()]
        yield ids[i], of, word


def collapsed(word: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run contains after its first period."""
    steps = np.zeros(len(word) + 1, np.int64)
    np.add.at(steps, runs[:, 0] + runs[:, 2], 1)
    np.add.at(steps, runs[:, 1], -1)
    drop = np.cumsum(steps)[:-1] > 0
    return [w for w, gone in zip(word, drop.tolist(), strict=True) if not gone] if len(runs) else word


RUNS = "doc_id long, n_words long, runs array<struct<start long, length long, period long>>, collapsed string"


def periodic_runs(docs: DataFrame, rebuild: bool = False) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row of ``docs``: its runs by start and period, and the words that no run
    contains after its first period, joined by a space.

    ``rebuild`` plants long repetitions into a tenth of the texts first (``rebuilt_places``).
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for low, high, data, bounds in text_chunks(batch):
                rows = [(d, len(w), [{"start": a, "length": b - a, "period": q} for a, b, q in r.tolist()], b" ".join(collapsed(w, r))) for d, r, w in _judged(ids[low:high], data, bounds, rebuild)]
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], kind), pa.array(columns[3], pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])
            release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(of, RUNS)


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run (start, length, period) with the greatest length in periods; of equal ones the first, then the shortest period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            runs = [(r["start"], r["length"], r["period"]) for r in row["runs"]]
            best = strongest(runs)
            start, length, period = best or (None, None, None)
            rows.append((row["doc_id"], row["n_words"], len(runs), start, length, period, best and 1000 * length // period, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(row["collapsed"])))
        names = [c.split()[0] for c in DIGEST.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


DIGEST = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    return periodic_runs(documents(spark, sf_dir), rebuild=True).mapInArrow(_digest, DIGEST)

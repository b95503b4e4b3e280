"""Counts of k-mers by minimizers: stretches of sequence are dealt to buckets, and each bucket counts its own k-mers.

The minimizer of a k-mer is the least name among its m-mers and their reverse complements, so that a k-mer and its reverse
complement have the same one. Neighbouring k-mers of one bucket are shipped together as a stretch of bases, two bits each.
A minimizer that holds a large share of all k-mers (its share is known from a count of all minimizers, of which there are
``4 ** M`` at most) isn't dealt to a bucket: its k-mers, and those with other letters than A, C, G and T, are rows that are
grouped and joined, with combining before the shuffle, so that no task gets them all. The number of buckets follows from
that count too, so that a bucket has about the same size whatever the input.

Short k-mers (up to ``SHORT`` letters) need no buckets: each task counts them in a table of all ``4 ** k``, the sums go to all
tasks, and places are looked up in their own tile. Nothing but the tables is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.functions.sequence import revcomp

#: Letters of a minimizer at most, and of a k-mer that fits into 64 bits.
M, LONGEST = 7, 31
#: K-mers up to this length are counted in a table of all of them: 65,536 numbers.
SHORT = 8
#: K-mers of a bucket at most, on average; a task needs some 60 bytes for each.
BUCKET = 1 << 22
#: A minimizer with more than this part of a bucket's even share is hot.
HOT = 0.5
#: Bases that are handled at a time.
CHUNK = 1 << 21
_CODE = np.full(256, 4, np.uint8)
_CODE[np.frombuffer(b"ACGT", np.uint8)] = range(4)
_LETTER = np.frombuffer(b"ACGT", np.uint8)
STRETCHES = "bucket int, seq_ids array<string>, seq binary, start binary, places binary, bases binary"
FOUND = "seq_id string, pos long, strand string, mer string, n long"


def tile_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """seq_ids, first places (from 0), bytes and bounds of some tiles (seq_id, tile_start, residues) at a time."""
    for batch in batches:
        texts = batch.column(2).cast(pa.large_string())
        _, offsets, data = texts.buffers()
        if not len(texts):
            continue
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        starts, low = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64) - 1, 0
        while low < len(texts):
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + CHUNK, "right")) - 1)
            yield batch.column(0).slice(low, high - low), starts[low:high], data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
            low = high


def _joined(codes: np.ndarray, k: int) -> np.ndarray:
    """The numbers of all stretches of ``k`` two-bit codes, by doubling."""
    out, size = np.zeros(len(codes) + 1, np.uint64), 0
    power, width = codes.astype(np.uint64), 1
    while True:
        if k & width:
            n = len(codes) - size - width + 1
            if n <= 0:
                return np.zeros(0, np.uint64)
            out, size = (power[:n] << np.uint64(2 * size)) | out[width : width + n], size + width
        if 2 * width > k:
            return out[: max(len(codes) - k + 1, 0)]
        if len(power) <= width:
            return np.zeros(0, np.uint64)
        power, width = (power[:-width] << np.uint64(2 * width)) | power[width:], 2 * width


def _complement(mers: np.ndarray, k: int) -> np.ndarray:
    """The numbers of the reverse complements."""
    x = ~mers
    for shift, mask in ((2, 0x3333333333333333), (4, 0x0F0F0F0F0F0F0F0F), (8, 0x00FF00FF00FF00FF), (16, 0x0000FFFF0000FFFF), (32, 0x00000000FFFFFFFF)):
        x = ((x >> np.uint64(shift)) & np.uint64(mask)) | ((x & np.uint64(mask)) << np.uint64(shift))
    return x >> np.uint64(64 - 2 * k)


def _places(data: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code of each base, and for each place the minimizer of its k-mer and whether that is a k-mer of A, C, G and T (1), another
    one (2) or none that ends inside its tile (0)."""
    codes = _CODE[data]
    n = len(codes) - k + 1
    if n <= 0:
        return codes, np.zeros(0, np.uint32), np.zeros(0, np.int8)
    m = min(M, k)
    mers = _joined(codes & np.uint8(3), m)
    names = np.minimum(mers, _complement(mers, m)).astype(np.uint32) * np.uint32(0x9E3779B1)
    width = 1
    while width < k - m + 1:
        step = min(width, k - m + 1 - width)
        names, width = np.minimum(names[step:], names[:-step]), width + step
    other = np.concatenate([[0], np.cumsum(codes > 3)])
    kind = np.where(other[k:] > other[:-k], np.int8(2), np.int8(1))
    tile = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    kind[tile[:n] != tile[k - 1 :]] = 0
    return codes, names, kind


def _weights(k: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for _, _, data, bounds in tile_chunks(batches):
            _, names, kind = _places(data, bounds, k)
            for name, n in zip(*(x.tolist() for x in np.unique(names[kind == 1], return_counts=True)), strict=True):
                total[name] = total.get(name, 0) + n
            total[-1] = total.get(-1, 0) + int((kind == 2).sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["name", "n"])

    return of


def _stretches(k: int, buckets: int, hot: np.ndarray):
    """Packed stretches of k-mers of one bucket."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, starts, data, bounds in tile_chunks(batches):
            codes, names, kind = _places(data, bounds, k)
            good = (kind == 1) & ~np.isin(names, hot)
            bucket = np.where(good, ((names ^ (names >> np.uint32(15))) % np.uint32(buckets)).astype(np.int64), -1)
            new = np.ones(len(bucket), bool)
            new[1:] = (bucket[1:] != bucket[:-1]) | (kind[:-1] == 0)
            first = np.flatnonzero(new & good)
            stop = np.append(np.flatnonzero(new), len(bucket))
            places = stop[np.searchsorted(stop, first, "right")] - first
            order = np.argsort(bucket[first], kind="stable")
            first, places = first[order], places[order]
            of_bucket = bucket[first]
            tile = np.searchsorted(bounds, first, "right") - 1
            start = starts[tile] + first - bounds[tile]
            edges = np.flatnonzero(np.diff(of_bucket, prepend=-1, append=-1)).tolist()
            rows = []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                seqs, seq = np.unique(tile[a:b], return_inverse=True)
                size = places[a:b] + k - 1
                ends = np.cumsum(size)
                bases = codes[np.repeat(first[a:b] - (ends - size), size) + np.arange(ends[-1])]
                bases = np.concatenate([bases, np.zeros(-len(bases) % 4, np.uint8)]).reshape(-1, 4)
                packed = (bases << np.array([6, 4, 2, 0], np.uint8)).sum(1, dtype=np.uint8)
                rows.append((int(of_bucket[a]), ids.take(pa.array(seqs)).to_pylist(), seq.astype(np.int32).tobytes(), start[a:b].astype(np.int64).tobytes(), places[a:b].astype(np.int32).tobytes(), packed.tobytes()))
            if rows:
                kinds = [pa.int32(), pa.list_(pa.string()), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["bucket", "seq_ids", "seq", "start", "places", "bases"])

    return of


def _letters(mers: np.ndarray, k: int) -> pa.Array:
    """K-mers as strings."""
    out = np.empty((len(mers), k), np.uint8)
    for j in range(k):
        out[:, j] = _LETTER[(mers >> np.uint64(2 * (k - 1 - j))) & np.uint64(3)]
    return pa.LargeStringArray.from_buffers(len(mers), pa.py_buffer((np.arange(len(mers) + 1) * k).astype(np.int64)), pa.py_buffer(out)).cast(pa.string())


def _counted(k: int, strand: str, everywhere: bool):
    """The counts at all places of a bucket's stretches."""

    def bucket_of(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        mers, place, seq, ids, seen = [], [], [], [], 0
        for row in rows:
            places = np.frombuffer(row["places"], np.int32).astype(np.int64)
            size = places + k - 1
            packed = np.frombuffer(row["bases"], np.uint8)
            codes = ((packed[:, None] >> np.array([6, 4, 2, 0], np.uint8)) & 3).ravel()[: size.sum()]
            step = np.arange(places.sum()) - np.repeat(np.cumsum(places) - places, places)
            mers.append(_joined(codes, k)[np.repeat(np.cumsum(size) - size, places) + step])
            place.append(np.repeat(np.frombuffer(row["start"], np.int64), places) + step)
            seq.append(np.repeat(np.frombuffer(row["seq"], np.int32), places) + seen)
            ids += row["seq_ids"]
            seen += len(row["seq_ids"])
        mers, place, seq = (np.concatenate(x) for x in (mers, place, seq))
        names = pa.array(ids, pa.string())
        distinct, of_, n = np.unique(mers, return_inverse=True, return_counts=True)
        sides = [("+", distinct, n)] if "f" in strand else []
        if "p" in strand:
            other = _complement(distinct, k)
            at = np.minimum(np.searchsorted(distinct, other), len(distinct) - 1)
            sides.append(("-", other, np.where(distinct[at] == other, n[at], 0)))
        for sign, mer, count in sides:
            text, count = _letters(mer, k), count[of_]
            there = np.arange(len(count)) if everywhere else np.flatnonzero(count)
            for low in range(0, len(there), 200_000):
                part = there[low : low + 200_000]
                yield pa.RecordBatch.from_arrays([names.take(pa.array(seq[part])), pa.array(place[part]), pa.array([sign]).take(pa.array(np.zeros(len(part), np.int8))), text.take(pa.array(of_[part])), pa.array(count[part].astype(np.int64))], names=["seq_id", "pos", "strand", "mer", "n"])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["bucket"] != now and held:
                    yield from bucket_of(held)
                    held = []
                now = row["bucket"]
                held.append(row)
        if held:
            yield from bucket_of(held)

    return of


def _rows(k: int, hot: np.ndarray):
    """(seq_id, pos, mer) of the k-mers that aren't dealt to buckets."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, starts, data, bounds in tile_chunks(batches):
            _, names, kind = _places(data, bounds, k)
            at = np.flatnonzero((kind == 2) | ((kind == 1) & np.isin(names, hot)))
            # A base outside ASCII would make places of bytes differ from places of letters.
            for low in range(0, len(at), 200_000):
                part = at[low : low + 200_000]
                tile = np.searchsorted(bounds, part, "right") - 1
                mers = np.lib.stride_tricks.sliding_window_view(data, k)[part]
                text = pa.LargeStringArray.from_buffers(len(part), pa.py_buffer((np.arange(len(part) + 1) * k).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(mers))).cast(pa.string())
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(tile)), pa.array(starts[tile] + part - bounds[tile]), text], names=["seq_id", "pos", "mer"])

    return of


def _whole(data: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the k-mers of A, C, G and T that end inside their tile, and the numbers of these."""
    codes = _CODE[data]
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    other = np.concatenate([[0], np.cumsum(codes > 3)])
    good = other[k:] == other[:-k]
    for end in bounds[1:-1].tolist():
        good[max(end - k + 1, 0) : end] = False
    at = np.flatnonzero(good)
    return at, _joined(codes & np.uint8(3), k)[at].astype(np.int64)


def _short_weights(k: int):
    """(name, n): how often each k-mer occurs; -1 stands for those with other letters."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, other = np.zeros(4**k, np.int64), 0
        for _, _, data, bounds in tile_chunks(batches):
            at, mers = _whole(data, bounds, k)
            total += np.bincount(mers, minlength=4**k)
            other += int(np.maximum(np.diff(bounds) - k + 1, 0).sum()) - len(at)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1)), pa.array(np.append(total[seen], other))], names=["name", "n"])

    return of


def _looked_up(k: int, strand: str, everywhere: bool, total: np.ndarray):
    """The counts at all places of the tiles by the table of all k-mers."""
    mers = np.arange(4**k, dtype=np.uint64)
    sides = [("+", _letters(mers, k), total)] if "f" in strand else []
    if "p" in strand:
        other = _complement(mers, k)
        sides.append(("-", _letters(other, k), total[other.astype(np.int64)]))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, starts, data, bounds in tile_chunks(batches):
            at, mers = _whole(data, bounds, k)
            for low in range(0, len(at), 200_000):
                places, names = at[low : low + 200_000], mers[low : low + 200_000]
                tile = np.searchsorted(bounds, places, "right") - 1
                seqs, place = ids.take(pa.array(tile)), starts[tile] + places - bounds[tile]
                for sign, text, count in sides:
                    n = count[names]
                    there = slice(None) if everywhere or n.all() else np.flatnonzero(n)
                    of_place = seqs if isinstance(there, slice) else seqs.take(pa.array(there))
                    yield pa.RecordBatch.from_arrays([of_place, pa.array(place[there]), pa.array([sign]).take(pa.array(np.zeros(len(of_place), np.int8))), text.take(pa.array(names[there])), pa.array(n[there])], names=["seq_id", "pos", "strand", "mer", "n"])

    return of


def place_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seq_id, start_pos, end_pos, n): neighbouring rows of one length that overlap or touch, in order, as one row; ``n`` counts them."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, (start, end) = batch.column(0), (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2))
        name = ids.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        opens = np.ones(len(start), bool)
        opens[1:] = (name[1:] != name[:-1]) | (start[1:] < start[:-1]) | (start[1:] > end[:-1] + 1)
        first = np.flatnonzero(opens)
        last = np.append(first[1:], len(start)) - 1
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(first)), pa.array(start[first]), pa.array(end[last]), pa.array(last - first + 1)], names=["seq_id", "start_pos", "end_pos", "n"])


def count_by_rows(mers: DataFrame, strand: str, everywhere: bool = False) -> DataFrame:
    """``mers(seq_id, pos, mer)`` with the number of each k-mer (of its reverse complement where the strand is -)."""
    counts = mers.groupBy("mer").agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0).cast("long")).alias("n")
    side = lambda rows, sign: rows.join(counts, "mer", "left" if everywhere else "inner").select("seq_id", "pos", F.lit(sign).alias("strand"), "mer", n)
    parts = [side(mers, "+")] if "f" in strand else []
    parts += [side(mers.withColumn("mer", revcomp("mer")), "-")] if "p" in strand else []
    return parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])


def kmer_counts(tiles: DataFrame, k: int = 17, strand: str = "f", everywhere: bool = False) -> DataFrame:
    """(seq_id, pos, strand, mer, n): each place of the tiles (from 0), its k-mer and how often that occurs in all of them.

    ``strand``: ``f`` looks up the k-mers as they are (+), ``p`` their reverse complements (-, left out where it doesn't
    occur unless ``everywhere``, then with 0), ``fp`` both; counts are those of the forward k-mers. ``tiles(seq_id, tile_start, residues)`` have to share
    ``k - 1`` bases with the next one, so that no k-mer is missed or counted twice; residues are ASCII letters.
    """
    if strand not in ("f", "p", "fp"):
        raise ValueError("strand is f, p or fp")
    if not 1 <= k <= LONGEST:
        raise ValueError(f"k is from 1 to {LONGEST}")
    spark = tiles.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = tiles.select("seq_id", F.col("tile_start").cast("long"), "residues").where("residues is not null")
    short = k <= SHORT
    # At most 4 ** M or 4 ** SHORT rows.
    weights = {r["name"]: r["total"] for r in rows.mapInArrow(_short_weights(k) if short else _weights(k), "name long, n long").groupBy("name").agg(F.sum("n").alias("total")).collect()}
    other = weights.pop(-1, 0)
    if short:
        total, hot = np.zeros(4**k, np.int64), np.zeros(0, np.uint32)
        total[list(weights)] = list(weights.values())
        found = rows.mapInArrow(_looked_up(k, strand, everywhere, total), FOUND)
    else:
        buckets = max(2 * parts, -(-sum(weights.values()) // BUCKET))
        share = HOT * sum(weights.values()) / buckets
        hot = np.array([name for name, n in weights.items() if n > share], np.uint32)
        dealt = rows.mapInArrow(_stretches(k, buckets, hot), STRETCHES).repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int")).sortWithinPartitions("bucket")
        found = dealt.mapInArrow(_counted(k, strand, everywhere), FOUND)
    if not other and not len(hot):
        return found
    others = rows.mapInArrow(_rows(k, hot), "seq_id string, pos long, mer string")
    return found.unionAll(count_by_rows(others, strand, everywhere).select("seq_id", "pos", "strand", "mer", "n"))

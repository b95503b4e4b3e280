"""Benchmark decontamination by template canonicalisation.

Words lose surrounding punctuation and case; numbers, units after numbers, and names (capitalised words inside a
sentence) become typed placeholders. Two kinds of windows of ``WINDOW`` tokens are hashed: all windows by their literal
tokens, and those with placeholders and two literal tokens at least by their templates. Windows of documents that no
benchmark item has are dropped early, the rest are hash-joined with the items' windows. A literal hit counts as it is,
so verbatim and recased copies are found whatever their tokens are taken for. For template hits, the values that fill
the placeholders of an alignment of a document with an item have to map one to one (slot consistency): windows with a
slot that more other slots contradict are dropped, the rest stays, so a re-parameterised question is caught and a chance
fit of placeholders isn't. An item counts as leaked if ``CONTAINED`` of its windows, or of those with two literal tokens,
are found, or if one alignment matches ``RUN`` windows.

A template that most items share would pair most documents with most items. Pairs are therefore found by an item's
rarest windows first: an item of ``n`` windows that has to be matched in ``m`` of them is matched in one of any
``n - m + 1``, so its ``m - 1`` most common windows needn't find it, and are joined only with documents that it is found
in.

Null and empty texts and items match nothing. Case folding and names cover the letters of one and two UTF-8 bytes
(Latin, Greek, Cyrillic and others). A text has to fit into a task, with about 300 bytes for each word. An item of fewer than
``WINDOW`` words is one literal window: a text leaks it if it holds these words in a row, however few they are. Repeated
item_ids count as one item with all their windows; items without an item_id are left out. Leaks belong to texts, not to
doc_ids: ``drop_leaky`` drops a row for its own text, whether its doc_id is missing, repeated or neither. Empty tables
give empty results. Other columns are ignored, or kept by ``drop_leaky``, and may have any name.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import repeats as R
from .common import documents, written
from .substring_dedup import _TABLE, word_spans

WINDOW, CONTAINED, RUN = 5, 0.5, 9
#: Item windows whose hashes are sent to all tasks (16 MB at most); of more of them a Bloom filter of fixed size is sent.
MAX_BROADCAST_WINDOWS = 2_000_000
#: Bits of the filter (16 MB), two for each window, and those of one part that a task fills.
BLOOM_BITS, BLOOM_PART = 1 << 27, 1 << 19
#: Units that are replaced when they follow a number.
UNITS = "km m cm mm mi ft kg g mg lb oz t l ml s sec secs seconds min mins minutes h hour hours day days week weeks month months year years usd eur dollars dollar euros euro pounds percent mph kmh km/h mw kw gb mb".split()

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ALNUM = np.zeros(256, bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = True
_ALNUM[128:] = True
_NUMBER, _UNIT, _NAME = (np.uint64(x) for x in (11, 22, 33))


#: Letters of two UTF-8 bytes (Latin, Greek, Cyrillic, Armenian and others) by code point: their lower case, and capitals.
_LOWER2 = np.array([ord(low) if len(low := chr(c).lower()) == 1 and 0x80 <= ord(low) < 0x800 else c for c in range(0x800)], np.int64)
_UPPER2 = np.array([c >= 0x80 and chr(c).isupper() for c in range(0x800)])


def _pairs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places among ``at`` where a letter of two bytes begins, and its code point."""
    at = at[at + 1 < len(data)]
    at = at[(data[at] >= 0xC2) & (data[at] <= 0xDF)]
    return at, ((data[at] & 0x1F).astype(np.int64) << 6) | (data[at + 1] & 0x3F)


def _folded(data: np.ndarray) -> np.ndarray:
    out = _LOWER[data]
    at, code = _pairs(data, np.flatnonzero(data >= 0xC2))
    low = _LOWER2[code]
    out[at], out[at + 1] = 0xC0 | (low >> 6), 0x80 | (low & 0x3F)
    return out


def _capitals(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a capital letter stands at each place."""
    found = (data[at] >= 65) & (data[at] <= 90)
    two, code = _pairs(data, at)
    found[np.isin(at, two[_UPPER2[code]])] = True
    return found


_UNIT_NAMES = np.sort(np.array([R.Hasher(_TABLE[np.frombuffer(u.encode(), np.uint8)])(np.array([0]), np.array([len(u.encode())]))[0] for u in UNITS], np.uint64))


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


class Bloom:
    """A filter of hashes: those that were put in pass, of others as many as its bits are full."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        last = np.uint64(BLOOM_BITS - 1)
        return values & last, R.mix(values) & last

    def passes(self, values: np.ndarray) -> np.ndarray:
        one, other = (p.astype(np.int64) for p in self.places(values))
        return ((self.bits[one >> 3] >> (one & 7)) & (self.bits[other >> 3] >> (other & 7)) & 1).astype(bool)

    @classmethod
    def of(cls, hashes: DataFrame) -> Bloom:
        """The filter of ``hashes(hash)``; parts of it are filled in tasks, and the driver gets its 16 MB."""

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(cls.places(values))).astype(np.int64))], names=["place"])

        def filled(part: pa.Table) -> pa.Table:
            place = part.column("place").to_numpy()
            bits = np.zeros(BLOOM_PART, np.uint8)
            bits[place % BLOOM_PART] = 1
            return pa.table({"part": pa.array([int(place[0]) // BLOOM_PART], pa.int64()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

        places = hashes.mapInArrow(placed, "place long").distinct()
        bits = np.zeros(BLOOM_BITS // 8, np.uint8)
        for row in places.groupBy(F.floor(F.col("place") / BLOOM_PART).alias("part")).applyInArrow(filled, "part long, bits binary").toLocalIterator():
            low = row["part"] * BLOOM_PART // 8
            bits[low : low + BLOOM_PART // 8] = np.frombuffer(row["bits"], np.uint8)
        return cls(bits)


def templates(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of documents: template name, name of the literal, whether it is a placeholder; and bounds in tokens.

    Words without a letter or digit give no token.
    """
    start, end, units = word_spans(data, bounds)
    solid = np.flatnonzero(_ALNUM[data])
    low, high = np.searchsorted(solid, start), np.searchsorted(solid, end)
    real = high > low
    sums = np.concatenate([[0], np.cumsum(real)])
    stop_after = np.isin(data[end - 1], list(b".!?:")) if len(end) else real
    fresh = np.ones(len(start), bool)
    fresh[1:] = stop_after[:-1]
    fresh[units[:-1][np.diff(units) > 0]] = True
    start, end, fresh = solid[low[real]], solid[high[real] - 1] + 1, fresh[real]
    units = sums[units]
    literal = R.Hasher(_TABLE[_folded(data)])(start, end)
    digits = np.concatenate([[0], np.cumsum((data >= 48) & (data <= 57))])
    letters = np.concatenate([[0], np.cumsum(_ALNUM[data] & ~((data >= 48) & (data <= 57)))])
    number = (digits[end] > digits[start]) & (letters[end] == letters[start])
    capital = _capitals(data, start) if len(start) else number
    unit = np.zeros(len(start), bool)
    unit[1:] = number[:-1]
    unit &= _among(literal, _UNIT_NAMES)
    name = capital & ~fresh & ~unit
    token = np.where(number, _NUMBER, np.where(unit, _UNIT, np.where(name, _NAME, literal)))
    return token, literal, number | unit | name, units


def _windows(data: np.ndarray, bounds: np.ndarray, window: int, shorter: list[int] | None) -> Iterator[tuple]:
    """Windows by literal tokens, then by templates: hash, document, place, whether two tokens are literal, and slots.

    ``shorter``: lengths below ``window`` that are taken at all places too; without it, a shorter text is one window.
    """
    token, literal, slot, units = templates(data, bounds)
    size, slots, exact = np.diff(units), np.concatenate([[0], np.cumsum(slot)]), R.Hasher(literal)
    for width in [*(range(1, window) if shorter is None else shorter), window]:
        many = np.maximum(size - width + 1, 0) if shorter is not None or width == window else (size == width).astype(np.int64)
        doc = np.repeat(np.arange(len(many)), many)
        at = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
        first = units[:-1][doc] + at
        names = R.mix(exact(first, first + width) + R.U(width))
        filled = slots[first + width] - slots[first]
        fit = (filled <= window - 2) & (width == window)
        if width < window:  # such an item has no other window, so that one place in a text is enough
            once = np.unique(np.stack([doc.astype(np.uint64), names]), axis=1, return_index=True)[1] if shorter is not None else slice(None)
            yield names[once], doc[once], at[once], fit[once], None, None
            continue
        yield names, doc, at, fit, None, None
        typed = np.flatnonzero(fit & (filled > 0))
        first = first[typed]
        index = first[:, None] + np.arange(window)
        yield R.Hasher(token)(first, first + window), doc[typed], at[typed], fit[typed], slot[index], literal[index]


def token_counts(texts: DataFrame) -> DataFrame:
    """The number of tokens of each text of ``texts(id, text)`` that has some, as ``words``."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, bounds in R.text_chunks(batch):
                size = np.diff(templates(data, bounds)[3])
                yield pa.RecordBatch.from_arrays([pa.array(size[size > 0].astype(np.int32))], names=["words"])

    return texts.mapInArrow(of, "words int")


WINDOW_ROWS = "id long, text_id binary, at int, hash long, exact boolean, fit boolean, fill array<long>, place array<int>"


def window_rows(texts: DataFrame, window: int, wanted: np.ndarray | Bloom | None = None, shorter: list[int] | None = None) -> DataFrame:
    """Windows of ``texts(id, text)``: place, hash, kind, and for templates the placeholders' values and places.

    ``wanted``: sorted hashes, or a filter; other windows are dropped. ``shorter``: see ``_windows``.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in R.text_chunks(batch):
                text_ids: dict[int, bytes] = {}
                for names, doc, at, fit, slot, literal in _windows(data, bounds, window, shorter):
                    hit = slice(None) if wanted is None else np.flatnonzero(wanted.passes(names) if isinstance(wanted, Bloom) else _among(names, wanted))
                    names, doc, at, fit = names[hit], doc[hit], at[hit], fit[hit]
                    for d in np.unique(doc).tolist():
                        if d not in text_ids:
                            text_ids[d] = hashlib.md5(data[bounds[d] : bounds[d + 1]].tobytes(), usedforsecurity=False).digest()
                    slot = np.zeros((len(names), 0), bool) if slot is None else slot[hit]
                    values = pa.array((np.zeros(0, np.uint64) if literal is None else literal[hit][slot]).view(np.int64))
                    edges = pa.array(np.concatenate([[0], np.cumsum(slot.sum(1))]).astype(np.int32))
                    places = pa.array((at[:, None] + np.arange(slot.shape[1]))[slot], pa.int32())
                    kind = pa.array(np.full(len(names), literal is None))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low).take(pa.array(doc)), pa.array([text_ids[d] for d in doc.tolist()], pa.binary()), pa.array(at, pa.int32()), pa.array(names.view(np.int64)), kind, pa.array(fit), pa.ListArray.from_arrays(edges, values), pa.ListArray.from_arrays(edges, places)], names=["id", "text_id", "at", "hash", "exact", "fit", "fill", "place"])

    return texts.mapInArrow(of, WINDOW_ROWS)


def undisputed(typed: list[int] | None, fills: list | None, window: int) -> list[int] | None:
    """The windows of an alignment without a slot that is outvoted: one of its values maps to another value at more places.

    Values at equally many places stay: different slots of an item can hold equal values by chance.
    """
    if fills is None:
        return None
    votes = Counter((a, b) for _, a, b in fills)
    most: dict = {}
    for (a, b), n in votes.items():
        most["a", a], most["b", b] = max(most.get(("a", a), 0), n), max(most.get(("b", b), 0), n)
    lost = {p - k for p, a, b in fills if votes[a, b] < max(most["a", a], most["b", b]) for k in range(window)}
    return [x for x in typed if x not in lost]


def _voted(window: int) -> Callable:
    def of(typed: pd.Series, p: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([undisputed(t, None if x is None else list(zip(x, y, z, strict=True)), window) for t, x, y, z in zip(typed, p, a, b, strict=True)], dtype=object)

    return of


def _leaks(docs: DataFrame, benchmark: DataFrame, window: int, contained: float, run: int) -> DataFrame:
    """(doc_id, text_id, item_id, n_windows, n_found): items by the documents' texts, which ``text_id`` is the MD5 of."""
    texts = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("id"), "text")
    items = written(window_rows(texts, window).drop("text_id"), "item-windows")
    hashes = items.select("hash").distinct()
    few = hashes.limit(MAX_BROADCAST_WINDOWS + 1)
    if few.count() <= MAX_BROADCAST_WINDOWS:
        wanted = np.sort(np.array([r.hash for r in few.toLocalIterator()], np.int64).view(np.uint64))
    else:
        wanted = Bloom.of(hashes)
    shorter = sorted(r.words for r in token_counts(texts).where(F.col("words") < window).distinct().collect())
    rows = written(window_rows(docs.select(F.col("doc_id").cast("long").alias("id"), "text"), window, wanted, shorter), "document-windows")
    rows = rows.select(F.col("id").alias("doc_id"), "text_id", "at", "hash", "fill")
    totals = items.groupBy(F.col("id").alias("item_id")).agg(F.count_distinct("at").alias("n_windows"), F.count_distinct(F.when(F.col("fit"), F.col("at"))).alias("n_fit"))
    sides = items.select(F.col("id").alias("item_id"), F.col("at").alias("item_at"), "hash", "exact", "fit", F.col("fill").alias("item_fill"), F.col("place").alias("item_place"))
    # The fewest places that have to be found in an item, by any of the three rules.
    half = lambda n: F.greatest(F.ceil(F.col(n) * contained), F.lit(1))
    needed = F.least(half("n_windows"), F.when(F.col("n_fit") > 0, half("n_fit")), F.lit(run)).alias("needed")
    # A place counts as common as the most common of its windows, literal or template.
    common = sides.groupBy("hash").agg(F.count_distinct("item_id").alias("common"))
    places = sides.join(common, "hash").groupBy("item_id", "item_at").agg(F.max("common").alias("common"))
    order = W.partitionBy("item_id").orderBy("common", "item_at")
    probes = places.withColumn("nth", F.row_number().over(order)).join(totals.select("item_id", "n_windows", needed), "item_id").where("nth <= n_windows - needed + 1").select("item_id", "item_at")
    probes = sides.join(probes, ["item_id", "item_at"], "left_semi").select("item_id", "hash").distinct()
    suspects = rows.select("doc_id", "text_id", "hash").distinct().join(probes, "hash").select("doc_id", "text_id", "item_id").distinct()
    suspects = suspects.withColumnsRenamed({"doc_id": "s_doc", "text_id": "s_text"})
    hits = rows.join(suspects, F.col("doc_id").eqNullSafe(F.col("s_doc")) & (F.col("text_id") == F.col("s_text"))).drop("s_doc", "s_text")
    pairs = hits.join(sides, ["item_id", "hash"])
    fills = F.when(~F.col("exact"), F.arrays_zip(F.col("item_place").alias("p"), F.col("item_fill").alias("a"), F.col("fill").alias("b")))
    chosen = lambda condition, name: F.collect_set(F.when(condition, F.col("item_at"))).alias(name)
    lines = pairs.groupBy("doc_id", "text_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).agg(chosen(F.expr("exact and fit"), "sure"), chosen(F.expr("exact and not fit"), "bare"), chosen(F.expr("not exact"), "typed"), F.array_distinct(F.flatten(F.collect_set(fills))).alias("fills"))
    distinct = lambda *names: F.size(F.array_distinct(F.arrays_zip(*(f"fills.{x}" for x in names))))
    clash = (distinct("a") != distinct("a", "b")) | (distinct("b") != distinct("a", "b"))
    voted = F.pandas_udf(_voted(window), "array<int>")(F.when(clash, F.col("typed")), *(F.when(clash, F.col(f"fills.{x}")) for x in ("p", "a", "b")))
    lines = lines.withColumn("fitting", F.array_union("sure", F.coalesce(voted, "typed"))).withColumn("found", F.array_union("fitting", "bare"))
    spread = lambda name: F.size(F.array_distinct(F.flatten(F.collect_list(name))))
    found = lines.groupBy("doc_id", "text_id", "item_id").agg(spread("found").alias("n_found"), spread("fitting").alias("n_fitting"), F.max(F.size("found")).alias("longest"))
    leaked = F.expr("n_found > 0") & ((F.col("n_found") >= contained * F.col("n_windows")) | F.expr("n_fit > 0") & (F.col("n_fitting") >= contained * F.col("n_fit")) | (F.col("longest") >= run))
    return found.join(totals, "item_id").where(leaked).select("doc_id", "text_id", "item_id", F.col("n_windows").cast("long").alias("n_windows"), F.col("n_found").cast("long").alias("n_found"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, contained: float = CONTAINED, run: int = RUN) -> DataFrame:
    """Rows (doc_id, item_id, n_windows, n_found): the benchmark items that a document holds.

    Found windows are counted once each, over all alignments and both kinds. A doc_id that several texts have is listed
    for each of them that holds an item; equal texts under one doc_id count once.
    """
    return _leaks(docs, benchmark, window, contained, run).drop("text_id")


def drop_leaky(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, with all their columns."""
    leaky = _leaks(docs, benchmark, WINDOW, CONTAINED, RUN).select(F.lower(F.hex("text_id")).alias("__leaky")).distinct()
    return docs.join(leaky, F.md5(docs["text"].cast("binary")) == leaky["__leaky"], "left_anti")


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    return find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

"""Log probabilities of texts under a Katz backoff model of their own corpus.

Tokens are lower-cased words and an end after each text. The model has the counts of all n-grams up to ``order`` in the
training texts (nothing is pruned), discounted by Good and Turing:

* ``P(w | h) = d(c(hw)) c(hw) / c(h)`` if ``hw`` was seen,
* else ``a(h) P(w | h')`` if ``h`` was seen (``h'`` is ``h`` without its first word), else ``P(w | h')``.

``a(h)``, the backoff weight, is what the seen words leave of 1 over what their lower-order probabilities leave of 1, so
that the probabilities of all words and the unknown one sum to 1 after each ``h``. The empty context backs off to the
unknown word. Discounts of an order come from the numbers ``n(r)`` of its n-grams seen ``r`` times: ``d(r) = (r + 1)
n(r + 1) / (r n(r))`` up to ``TURING``, where those lie between 0 and 1, and the same of the line fitted to the logarithms
of ``n(1)`` to ``n(FITTED)`` elsewhere; it never reaches 1, so that each context leaves something for words it hasn't seen.

Counts and weights are tables dealt by the names of n-grams. Documents are dealt to chunks of some megabytes. In the first
round each chunk sends its distinct n-grams with their counts in its training texts to the buckets, and gets the corpus's
counts back; one of the chunks that hold an n-gram is told to be its owner. In the second round chunks send what their own
n-grams take from their contexts, and get the weights of the contexts that they back off from. Then each chunk evaluates its
texts, token by token from the highest order down. A frequent word or n-gram is one entry for each chunk, whoever holds it.

N-grams are told apart by 64-bit names. Rows without a doc_id, or with one that others have, are rows like all others.
Null and empty texts consist of the end alone; an empty table gives an empty result; without training texts all scores are 0.
A text has to fit into a task, with about 300 bytes for each word. Other columns are ignored and may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, numbered, parallelism, written
from .repeats import release, text_chunks
from .words import lowered, mix, word_bounds, word_names

U = np.uint64
#: Counts up to which Turing's estimate is used, and counts that the line is fitted to.
TURING, FITTED = 5, 10
#: Bytes of text in a chunk: most of them, and those below which small inputs aren't dealt further.
CHUNK, LEAST_CHUNK = 8 << 20, 1 << 20
END, START, ROOT, _STEP = U(0x1F83D9ABFB41BD6B), U(0x5BE0CD19137E2179), U(0), U(0x9E3779B97F4A7C15)
#: Order under which the contexts of texts' beginnings are counted: they are contexts, but no n-grams.
STARTS = 0
BLOB = "bucket int, order int, chunk long, names binary, counts binary, own binary"
SUMS = "bucket int, order int, chunk long, names binary, counts binary, taken binary, low binary, needed binary"


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as bytes, the lowest of all first: small ones compress well."""
    return numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(U)


def _bounds(buckets: int) -> np.ndarray:
    """The least name of each bucket."""
    return (np.arange(buckets, dtype=np.float64) * (2.0**64 / buckets)).astype(U)


def _split(names: np.ndarray, buckets: int) -> Iterator[tuple[int, slice, bytes]]:
    """Bucket, range and packed differences of sorted names."""
    low = _bounds(buckets)
    edges = np.append(np.searchsorted(names, low), len(names))
    for b in np.flatnonzero(np.diff(edges)).tolist():
        part = slice(int(edges[b]), int(edges[b + 1]))
        yield b, part, packed(np.diff(names[part], prepend=low[b]))


def _names(blob: bytes, bucket: int, buckets: int) -> np.ndarray:
    return np.cumsum(unpacked(blob), dtype=U) + _bounds(buckets)[bucket]


class Discounts:
    """d(r) of one order from ``n[r]``, the numbers of n-grams seen ``r`` times (``n[0]`` is ignored)."""

    def __init__(self, n: np.ndarray):
        r = np.arange(1, FITTED + 1)
        seen = n[1 : FITTED + 1] > 0
        slope = np.polyfit(np.log(r[seen]), np.log(n[1 : FITTED + 1][seen]), 1)[0] if seen.sum() > 1 else -2.0
        self.power = min(float(slope), -1.1) + 1
        self.table = np.array([(1 + 1 / x) ** self.power for x in range(1, TURING + 1)])
        if (n[1 : TURING + 2] > 0).all():
            turing = np.array([(x + 1) * n[x + 1] / (x * n[x]) for x in range(1, TURING + 1)])
            if ((turing > 0) & (turing < 1)).all():
                self.table = turing

    def __call__(self, r: np.ndarray) -> np.ndarray:
        high = np.maximum(r, 1).astype(np.float64)
        return np.where(r <= TURING, self.table[np.clip(r.astype(np.int64), 1, TURING) - 1], (1 + 1 / high) ** self.power)


class Grams:
    """The n-grams of a chunk: for each order the names of those that end in each token, and of their contexts."""

    def __init__(self, texts: list[pa.Array], order: int):
        names, sizes = [], []
        for text in texts:
            for _, _, data, bounds in text_chunks(pa.RecordBatch.from_arrays([text], names=["text"])):
                data = lowered(data)
                start, end, edges = word_bounds(data, bounds)
                own = word_names(data, start, end)
                x = np.full(len(own) + len(edges) - 1, END)
                x[np.arange(len(own)) + np.repeat(np.arange(len(edges) - 1), np.diff(edges))] = own
                names.append(x)
                sizes.append(np.diff(edges) + 1)
        x, self.sizes = np.concatenate(names), np.concatenate(sizes)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.order = order
        start = START
        self.starts, self.at, self.context = [ROOT], [x], [np.full(len(x), ROOT)]
        for _ in range(1, order):
            context = np.concatenate([self.at[-1][:1], self.at[-1][:-1]])
            context[self.first] = start
            self.starts.append(start)
            self.context.append(context)
            self.at.append(mix(context * _STEP + x))
            start = mix(np.array([start]) * _STEP + START)[0]
        self.distinct, self.example, self.of = zip(*(np.unique(a, return_index=True, return_inverse=True) for a in self.at), strict=True)

    def counted(self, counts: list[np.ndarray], starts: dict[int, int], total: int) -> None:
        """Take the corpus's counts of the distinct n-grams in: for each token those of its n-grams and of their contexts."""
        self.count = [c[i] for c, i in zip(counts, self.of, strict=True)]
        self.around = [np.full(len(self.at[0]), total)]
        for k in range(1, self.order):
            around = np.concatenate([self.count[k - 1][:1], self.count[k - 1][:-1]])
            around[self.first] = starts.get(int(self.starts[k]), 0)
            self.around.append(around)

    def backs_off(self, k: int) -> np.ndarray:
        """Tokens whose n-gram of order ``k + 1`` wasn't seen though its context was."""
        return (self.count[k] == 0) & (self.around[k] > 0)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of one chunk after another as (chunk, slice of a batch)."""
    for batch in batches:
        chunk = batch.column("chunk").to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            if high > low:
                yield int(chunk[low]), batch.slice(low, high - low)


class Chunk:
    """One chunk's texts and the answers that it got."""

    def __init__(self, slices: list[pa.RecordBatch]):
        ids, learn, texts, self.answers = [], [], [], []
        for part in slices:
            text = part.filter(pc.is_null(part.column("order")))
            if len(text):
                ids.append(text.column("doc_id").to_numpy(zero_copy_only=False))
                learn.append(text.column("learn").to_numpy(zero_copy_only=False).astype(bool))
                texts.append(text.column("text"))
            if len(part) > len(text) and "counts" in part.schema.names:
                self.answers += part.filter(pc.is_valid(part.column("order"))).select(["order", "bucket", "counts", "own", "weights"]).to_pylist()
        self.ids, self.learn = np.concatenate(ids), np.concatenate(learn)
        self.texts = texts

    def grams(self, order: int, total: int = 0) -> Grams:
        """The n-grams, with the counts of the answers if there are any."""
        grams = Grams(self.texts, order)
        counts = [a for a in self.answers if a["counts"] is not None]
        if counts:
            joined = lambda k, column: [a[column] for a in counts if a["order"] == k]
            starts = np.unique(np.array(grams.starts[1:], U))
            at_start = np.concatenate([unpacked(b) for b in joined(STARTS, "counts")]) if order > 1 else []
            grams.counted([np.concatenate([unpacked(b) for b in joined(k + 1, "counts")]).astype(np.int64) for k in range(order)], dict(zip(starts.tolist(), map(int, at_start), strict=False)), total)
            grams.own = [np.concatenate([np.unpackbits(np.frombuffer(a["own"], np.uint8), count=len(a["counts"]) // 8) for a in counts if a["order"] == k + 1]).astype(bool) for k in range(order)]
        return grams

    def weights(self, order: int) -> list[np.ndarray]:
        """Backoff weights of the contexts that the chunk asked for, by order and name."""
        none = np.zeros(0)
        return [np.concatenate([none, *(np.frombuffer(a["weights"], np.float64) for a in self.answers if a["weights"] is not None and a["order"] == k)]) for k in range(order)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Chunk]]:
    """The chunks of a partition that is sorted by chunk, order and bucket."""
    now, held = None, []
    for chunk, part in _rows(batches):
        if chunk != now and held:
            yield now, Chunk(held)
            held = []
            release()
        now = chunk
        held.append(part)
    if held:
        yield now, Chunk(held)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    columns = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[kind]) for v, (_, kind) in zip(zip(*rows, strict=True), columns, strict=True)], names=[c for c, _ in columns])


def _asking(order: int, buckets: int) -> Callable:
    """Round 1, chunks: distinct n-grams of each order, with their counts in the chunk's training texts."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in _chunks(batches):
            grams = chunk.grams(order)
            learn = np.repeat(chunk.learn, grams.sizes)
            starts = np.unique(np.array(grams.starts[1:], U))
            asked = [(k + 1, grams.distinct[k], np.bincount(grams.of[k][learn], minlength=len(grams.distinct[k]))) for k in range(order)]
            for k, names, counts in [(STARTS, starts, np.full(len(starts), chunk.learn.sum())), *asked]:
                rows = [(b, k, number, names_, packed(counts[part]), None) for b, part, names_ in _split(names, buckets)]
                if rows:
                    yield _batch(rows, BLOB)

    return of


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[dict]]]:
    """(bucket, order, rows) from a partition that is sorted by bucket and order."""
    now, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            at = (row["bucket"], row["order"])
            if at != now and held:
                yield *now, held
                held = []
            now = at
            held.append(row)
    if held:
        yield *now, held


def _sorted_names(rows: list[dict], bucket: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How many names each row has, the order of all by name, where a new one begins, and the number of each one's name."""
    names = [_names(r["names"], bucket, buckets) for r in rows]
    joined = np.concatenate(names)
    order = np.argsort(joined, kind="stable")
    joined = joined[order]
    new = np.append(True, joined[1:] != joined[:-1])
    return np.array([len(n) for n in names]), order, joined[new], np.cumsum(new) - 1


def _counting(buckets: int) -> Callable:
    """Round 1, buckets: the corpus's counts for each chunk that asked, and (without a chunk) the model's part of the table."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, k, rows in _groups(batches):
            sizes, order, names, number = _sorted_names(rows, bucket, buckets)
            counts = np.concatenate([unpacked(r["counts"]) for r in rows]).astype(np.int64)[order]
            total = np.bincount(number, counts, minlength=len(names)).astype(np.int64)
            holds = np.flatnonzero(counts > 0)
            own = np.zeros(len(counts), bool)
            own[holds[np.append(True, number[holds][1:] != number[holds][:-1])[: len(holds)]]] = True
            answer, mine = np.empty(len(counts), np.int64), np.empty(len(counts), bool)
            answer[order], mine[order] = total[number], own
            edges = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            out = [(bucket, k, r["chunk"], None, packed(answer[a:b]), np.packbits(mine[a:b]).tobytes()) for r, a, b in zip(rows, edges[:-1], edges[1:], strict=True)]
            seen = total > 0
            if seen.any():
                out.append((bucket, k, None, packed(np.diff(names[seen], prepend=_bounds(buckets)[bucket])), packed(total[seen]), None))
            yield _batch(out, BLOB)
            release()

    return of


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many n-grams of each order have each count (higher ones together), and the sum of the counts."""
    for batch in batches:
        rows = []
        for k, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            counts = unpacked(blob).astype(np.int64)
            n = np.bincount(np.minimum(counts, FITTED + 1), minlength=FITTED + 2)
            sums = np.bincount(np.minimum(counts, FITTED + 1), counts, minlength=FITTED + 2)
            rows += [(k, r, int(n[r]), int(sums[r])) for r in range(1, FITTED + 2)]
        if rows:
            yield _batch(rows, "order int, r int, n long, total long")


def _taking(order: int, buckets: int, total: int, discounts: list[Discounts]) -> Callable:
    """Round 2, chunks: what own n-grams take of their contexts and of these' lower order, and contexts to back off from."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in _chunks(batches):
            grams = chunk.grams(order, total)
            for k in range(order):
                at = grams.example[k][grams.own[k]]
                count = grams.count[k][at]
                taken = discounts[k](count) * count
                low = np.zeros(len(at))
                if k:
                    below = grams.count[k - 1][at]
                    low = discounts[k - 1](below) * below / grams.around[k - 1][at]
                off = np.flatnonzero(grams.backs_off(k))
                joined = np.concatenate([grams.context[k][at], grams.context[k][off]])
                names, first, of_ = np.unique(joined, return_index=True, return_inverse=True)
                around = np.concatenate([grams.around[k][at], grams.around[k][off]])[first]
                sums = [np.bincount(of_[: len(at)], x, minlength=len(names)) for x in (taken, low)]
                needed = np.bincount(of_[len(at) :], minlength=len(names)) > 0
                rows = [(b, k, number, names_, packed(around[part]), sums[0][part].tobytes(), sums[1][part].tobytes(), np.packbits(needed[part]).tobytes()) for b, part, names_ in _split(names, buckets)]
                if rows:
                    yield _batch(rows, SUMS)

    return of


def _weighing(buckets: int) -> Callable:
    """Round 2, buckets: the backoff weight of each context, for the chunks that need it and (without a chunk) for the model."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = "bucket int, order int, chunk long, names binary, weights binary"
        for bucket, k, rows in _groups(batches):
            sizes, order, names, number = _sorted_names(rows, bucket, buckets)
            joined = lambda column, rows=rows, order=order: np.concatenate([np.frombuffer(r[column], np.float64) for r in rows])[order]
            around = np.empty(len(names))
            around[number] = np.concatenate([unpacked(r["counts"]) for r in rows])[order]
            taken, low = (np.bincount(number, joined(c), minlength=len(names)) for c in ("taken", "low"))
            weights = (around - taken) / around / (1 - low)
            answer = np.empty(len(order))
            answer[order] = weights[number]
            edges = np.concatenate([[0], np.cumsum(sizes)]).tolist()
            out = [(bucket, k, None, packed(np.diff(names, prepend=_bounds(buckets)[bucket])), weights.tobytes())]
            for r, a, b in zip(rows, edges[:-1], edges[1:], strict=True):
                needed = np.unpackbits(np.frombuffer(r["needed"], np.uint8), count=b - a).astype(bool)
                if needed.any():
                    out.append((bucket, k, r["chunk"], None, answer[a:b][needed].tobytes()))
            yield _batch(out, schema)
            release()

    return of


def evaluated(grams: Grams, weights: list[np.ndarray], discounts: list[Discounts]) -> np.ndarray:
    """The log10 probability of each token, from the highest order down."""
    log, open_ = np.zeros(len(grams.at[0])), np.ones(len(grams.at[0]), bool)
    for k in reversed(range(grams.order)):
        seen = open_ & (grams.count[k] > 0)
        log[seen] += np.log10(discounts[k](grams.count[k][seen]) * grams.count[k][seen] / grams.around[k][seen])
        off = grams.backs_off(k)
        if off.any():
            log[off] += np.log10(weights[k][np.unique(grams.context[k][off], return_inverse=True)[1]])
        open_ &= ~seen
    return log


def _scoring(order: int, total: int, vocabulary: int, discounts: list[Discounts]) -> Callable:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, chunk in _chunks(batches):
            grams = chunk.grams(order, total)
            log = evaluated(grams, chunk.weights(order), discounts)
            base = np.log10((grams.count[0] + 0.5) / (total + 0.5 * (vocabulary + 1)))
            by_text = lambda x, at=grams.first: np.add.reduceat(x, at)
            columns = [chunk.ids.astype(np.int64), chunk.learn, grams.sizes, by_text((grams.count[0] > 0).astype(np.int64)), by_text(base), by_text(log)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "learn", "n_tokens", "n_known", "base_score", "score"])

    return of


def katz_scores(docs: DataFrame, learn: Column, order: int = 2) -> DataFrame:
    """(doc_id, learn, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    ``learn``: the rows whose texts the model is made from (null: not). ``score`` is the model's log10 probability of the
    text, ``base_score`` that of the words alone, half a count added to each.
    """
    spark = docs.sparkSession
    rows, named = numbered(docs.select("doc_id", "text", F.coalesce(learn, F.lit(False)).alias("learn")), row=True)
    rows = rows.select("doc_id", "text", F.col("row.learn").alias("learn"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks, buckets = parallelism(spark), 2 * parallelism(spark)
    chunks = min(tasks * -(-size // (CHUNK * tasks)), -(-size // LEAST_CHUNK)) or 1
    texts = rows.select(F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).alias("chunk"), "doc_id", "learn", F.coalesce("text", F.lit("")).alias("text"))
    none = lambda kind, *columns: [F.lit(None).cast(kind).alias(c) for c in columns]
    texts = texts.select("*", *none("int", "order", "bucket"), *none("binary", "counts", "own", "weights"))

    def gathered(*answers: DataFrame) -> DataFrame:
        """Texts and what their chunks were answered, chunk by chunk."""
        found = texts
        for answer in answers:
            found = found.unionByName(answer.where("chunk is not null").drop("names"), allowMissingColumns=True)
        return found.repartitionById(tasks, F.pmod("chunk", F.lit(tasks)).cast("int")).sortWithinPartitions("chunk", F.col("order").asc_nulls_first(), "bucket")

    by_bucket = lambda blobs: blobs.repartitionById(tasks, F.pmod("bucket", F.lit(tasks)).cast("int")).sortWithinPartitions("bucket", "order", "chunk")
    counts = written(by_bucket(gathered().mapInArrow(_asking(order, buckets), BLOB)).mapInArrow(_counting(buckets), BLOB), "ngram-counts")
    frequent = counts.where(F.col("chunk").isNull() & (F.col("order") > STARTS)).select("order", "counts").mapInArrow(_frequencies, "order int, r int, n long, total long")
    found = {(r["order"], r["r"]): (r["n"], r["total"]) for r in frequent.groupBy("order", "r").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()}
    n = np.array([[found.get((k, r), (0, 0))[0] for r in range(FITTED + 2)] for k in range(1, order + 1)], np.float64)
    total, vocabulary = sum(found.get((1, r), (0, 0))[1] for r in range(FITTED + 2)), int(n[0].sum())
    discounts = [Discounts(row) for row in n]
    weights = written(by_bucket(gathered(counts).mapInArrow(_taking(order, buckets, total, discounts), SUMS)).mapInArrow(_weighing(buckets), "bucket int, order int, chunk long, names binary, weights binary"), "backoff-weights")
    scored = gathered(counts, weights).mapInArrow(_scoring(order, total, vocabulary, discounts), "doc_id long, learn boolean, n_tokens long, n_known long, base_score double, score double")
    return named(scored.select("doc_id", "learn", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"))


#: The registered query's n-grams: a word and the one before it.
ORDER = 2


def op11_lm_scoring(spark, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))
    found = katz_scores(documents(spark, sf_dir), ~held_out, ORDER)
    return found.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

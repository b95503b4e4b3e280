"""Similarity join on word shingles: a MinHash LSH forest finds candidates, shingle sets verify them exactly.

1. Texts with equal shingle sets form one class; its least doc_id represents it from here on.
2. Each tree of the forest is a prefix trie: a text's label in it is a sequence of ``DEEPEST`` minima, and texts that share
   the first ``d`` of them are in one node of depth ``d``. Labels are numbers whose order is that of the trie, so a node is
   a range of them and a shorter prefix a shift. If all trees are matched at depth ``d``, two texts of similarity
   ``threshold`` miss each other in all of them with a chance of ``(1 - threshold**d) ** TREES``; ``floor_depth`` is the
   longest prefix at which this meets the target recall, so no prefix has to be shorter.
3. Prefixes are shortened to the floor only where its node holds at most ``SPLIT`` texts; elsewhere a text stops at the
   shortest prefix whose node does. From the depths that its trees end at, each text gets its own bound of the recall;
   texts short of the target in their crowded nodes are all tied together there, which loses nothing.
4. The texts of a node are grouped with *leaders* when their signatures agree, which leaves a row a text instead of all
   pairs. A text is a leader's member at an estimate of ``MEMBER`` and is tied to it from ``TIED`` on, and leads on itself
   if it is tied only: texts of similarity 0.8 end in one group (triangle inequality of the Jaccard distance, with four
   standard errors of room).
5. Components of these stars are verified exactly. A component of up to ``block`` texts is one group. A larger one goes
   the cheaper of two exact ways: cut into blocks, with a group for each pair of blocks (each set is then shipped as often
   as there are blocks); or dealt to groups that share one of their rarest shingles (prefix filter: similar texts share
   one of the first ``size - ceil(threshold * size) + 1`` in any common order, here by rarity). A pair counts in the
   group of the least shingle that both prefixes hold.

Shingles are 64-bit names of words and of their sequences (see ``repeats.Hasher``); sets are compared by all their names.

Null texts, and texts without words, are linked to nothing. Texts of fewer than ``n`` words are one shingle. Each row is
a document; rows with one doc_id, or without, are told apart (see ``numbered``). An empty table gives an empty result. A
text has to fit into a task, with about 100 bytes for each word. Other columns are ignored, or kept by
``drop_near_duplicates``, and may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.operators.graph import components

from . import repeats as R
from .common import documents, numbered, parallelism, written
from .substring_dedup import _TABLE, word_spans

TREES, DEEPEST, RECALL = 24, 6, 0.99999
MEMBER, TIED = 0.85, 0.35
#: Texts of a node, or of a component, that one task takes at once.
SPLIT, BLOCK = 1024, 1024
#: Counters for the rarity of shingles; shingles that share one only make prefixes less rare.
COUNTERS = 1 << 18


def floor_depth(threshold: float, recall: float = RECALL, trees: int = TREES, deepest: int = DEEPEST) -> int:
    """The longest prefix at which ``trees`` tries find pairs of the threshold's similarity with the target recall."""
    depth = deepest
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(data: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingle set of each document as hashes, sorted by document and hash: (hashes, bounds)."""
    start, end, units = word_spans(data, bounds)
    names = R.Hasher(R.Hasher(_TABLE[data])(start, end))
    count = np.diff(units)
    many = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    doc = np.repeat(np.arange(len(count)), many)
    first = units[:-1][doc] + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    found = names(first, first + np.minimum(count, n)[doc])
    order = np.lexsort((found, doc))
    found, doc = found[order], doc[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (doc[1:] != doc[:-1])
    return found[new], np.searchsorted(doc[new], np.arange(len(count) + 1))


def _signatures(n: int):
    """Digest of the shingle set, one byte of each minimum (the signature), and the labels in the trees."""
    rng = np.random.default_rng(20240229)
    scale = rng.integers(1, 2**63, TREES * DEEPEST, dtype=np.uint64) * R.U(2) + R.U(1)
    shift = rng.integers(0, 2**63, TREES * DEEPEST, dtype=np.uint64)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for low, high, data, bounds in R.text_chunks(batch):
                found, edges = shingles(data, bounds, n)
                some = np.flatnonzero(np.diff(edges))
                least = np.zeros((len(some), TREES * DEEPEST), np.uint8)
                for k in range(TREES * DEEPEST if len(some) else 0):
                    least[:, k] = R.mix(np.minimum.reduceat((found * scale[k] + shift[k]) >> R.U(24), edges[some])) & R.U(255)
                labels = np.broadcast_to(np.arange(TREES, dtype=np.int64), (len(some), TREES)).copy()
                for k in range(DEEPEST):
                    labels = labels << 8 | least[:, k::DEEPEST]
                digest = [hashlib.sha256(found[edges[i] : edges[i + 1]].tobytes()).digest()[:16] for i in some]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(some) * TREES + 1, TREES, dtype=np.int32)), pa.array(labels.reshape(-1)))
                yield pa.RecordBatch.from_arrays([pa.array(ids[low:high][some].astype(np.int64)), pa.array(digest, pa.binary()), pa.array([row.tobytes() for row in least], pa.binary()), lists], names=["doc_id", "digest", "sig", "labels"])

    return of


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[list]]:
    """Rows of one group after another, as lists of columns, from rows sorted by their first ``keys`` columns."""
    now, held = None, None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:keys] != now:
                if held:
                    yield held
                now, held = row[:keys], [[] for _ in row]
            for column, value in zip(held, row, strict=True):
                column.append(value)
    if held:
        yield held


def _leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups of each node (depth, node, doc_id, sig): (u, v) with the least doc_id of u's group as v."""
    out: list[tuple] = []
    for _, _, docs, sigs in _grouped(batches, 2):
        order = sorted(range(len(docs)), key=docs.__getitem__)
        sig = np.frombuffer(b"".join(sigs[i] for i in order), np.uint8).reshape(len(docs), -1)
        docs = np.array([docs[i] for i in order])
        outside = np.arange(len(docs))
        while len(outside):
            root, outside = outside[0], outside[1:]
            leaders, met = [root], []
            while leaders and len(outside):
                alike = (sig[outside] == sig[leaders.pop()]).mean(1)
                # Whoever is similar to a member is tied to the leader too; others that are tied lead on.
                leaders += list(outside[(alike >= TIED) & (alike < MEMBER)])
                met += list(outside[alike >= TIED])
                outside = outside[alike < TIED]
            out += [(int(docs[x]), int(docs[root])) for x in met]
        if len(out) >= 20_000:
            yield _rows(out)
            out = []
    if out:
        yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    u, v = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _node(depth: int):
    return F.shiftright("label", 8 * (DEEPEST - depth))


def _crowded(rows: DataFrame, threshold: float, floor: int) -> tuple[DataFrame, DataFrame]:
    """For rows (doc_id, label) whose nodes at the floor are too large: longer prefixes, and ties where these miss the target.

    Returns (depth, node, doc_id) with two texts or more in each node, and edges (u, v).
    """
    left, ends = written(rows, "crowded"), []
    for depth in range(floor + 1, DEEPEST + 1):
        sized = left.withColumn("node", _node(depth))
        sized = sized.join(sized.groupBy("node").agg(F.count("*").alias("size")), "node")
        fits = F.col("size") <= SPLIT
        ends.append(sized.where(fits).select(F.lit(depth).alias("depth"), "node", "doc_id", "label", "size"))
        left = written(sized.where(~fits).select("doc_id", "label"), "crowded")
        if left.isEmpty():
            break
    # What is still crowded at the longest prefix isn't searched in this tree: it counts as a miss.
    ends.append(left.select(F.lit(None).cast("int").alias("depth"), F.lit(None).cast("long").alias("node"), "doc_id", "label", F.lit(0).cast("long").alias("size")))
    found = ends[0]
    for more in ends[1:]:
        found = found.unionAll(more)
    found = written(found, "longer-prefixes")
    log_miss = F.coalesce(F.log(1 - F.pow(F.lit(threshold), F.col("depth"))), F.lit(0.0))
    usual = float(np.log1p(-(threshold**floor)))
    short = found.groupBy("doc_id").agg(F.sum(log_miss - usual).alias("lost")).where(F.lit(TREES * usual) + F.col("lost") > float(np.log1p(-RECALL))).select("doc_id")
    tied = rows.join(short, "doc_id", "left_semi").withColumn("node", _node(floor))
    least = tied.groupBy("node").agg(F.min("doc_id").alias("v"))
    edges = tied.join(least, "node").where("doc_id <> v").select(F.col("doc_id").alias("u"), "v")
    return found.where("size > 1").select("depth", "node", "doc_id"), edges


def _candidate_edges(reps: DataFrame, threshold: float) -> DataFrame:
    """Stars (u, v) over texts (doc_id, sig, labels) whose components hold all pairs that the forest finds."""
    parts, floor = parallelism(reps.sparkSession), floor_depth(threshold)
    labels = reps.select("doc_id", F.explode("labels").alias("label")).withColumn("node", _node(floor))
    shared = labels.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    rows = labels.join(shared, "node")
    nodes = rows.where(F.col("size") <= SPLIT).select(F.lit(floor).alias("depth"), "node", "doc_id")
    ties = None
    if not shared.where(F.col("size") > SPLIT).isEmpty():
        longer, ties = _crowded(rows.where(F.col("size") > SPLIT).select("doc_id", "label"), threshold, floor)
        nodes = nodes.unionAll(longer)
    nodes = nodes.join(reps.select("doc_id", "sig"), "doc_id").select("depth", "node", "doc_id", "sig")
    stars = nodes.repartition(parts, "depth", "node").sortWithinPartitions("depth", "node").mapInArrow(_leaders, "u long, v long")
    return stars if ties is None else stars.unionAll(ties)


def _sets(n: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, bounds in R.text_chunks(batch):
                found, edges = shingles(data, bounds, n)
                sets = [found[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), batch.column(2).slice(low, high - low), batch.column(3).slice(low, high - low), pa.array(sets, pa.binary())], names=["doc_id", "root", "weight", "grams"])

    return of


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for grams in batch.column(0).to_pylist():
            total += np.bincount((np.frombuffer(grams, np.uint64) % R.U(COUNTERS)).astype(np.int64), minlength=COUNTERS)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["counter", "count"])


def _prefixes(threshold: float, counts: np.ndarray):
    """The rarest shingles of each set, of which two sets of the threshold's similarity share one at least."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for grams in batch.column(2).to_pylist():
                grams = np.frombuffer(grams, np.uint64)
                many = len(grams) - int(np.ceil(threshold * len(grams) - 1e-9)) + 1
                found.append(np.sort(grams[np.lexsort((grams, counts[grams % R.U(COUNTERS)]))[:many]]))
            tokens = pa.array([x.view(np.int64) for x in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), tokens, pa.array([x.tobytes() for x in found], pa.binary())], names=["doc_id", "root", "tokens", "prefix"])

    return of


def _dealt(sets: DataFrame, sizes: DataFrame, threshold: float, block: int) -> DataFrame:
    """Sets with the groups and numbers of blocks they are verified in: (root, token, blocks, doc_id, weight, grams, prefix)."""
    whole = lambda df: df.select("root", F.lit(0).cast("long").alias("token"), "blocks", "doc_id", "weight", "grams", F.lit(None).cast("binary").alias("prefix"))
    large = sizes.where("blocks > 1")
    if large.isEmpty():
        return whole(sets)
    sets = written(sets, "sets")
    counts = np.zeros(COUNTERS, np.int64)
    for r in sets.where("blocks > 1").select("grams").mapInArrow(_counts, "counter long, count long").groupBy("counter").agg(F.sum("count").alias("count")).toLocalIterator():
        counts[r["counter"]] = r["count"]
    rare = sets.where("blocks > 1").select("doc_id", "root", "grams").mapInArrow(_prefixes(threshold, counts), "doc_id long, root long, tokens array<long>, prefix binary")
    rare = rare.select("root", F.explode("tokens").alias("token"), "doc_id", "prefix")
    groups = written(rare.groupBy("root", "token").agg(F.count("*").alias("n")).where("n > 1").select("root", "token", "n", F.ceil(F.col("n") / block).alias("blocks")), "rare-shingles")
    cost = groups.groupBy("root").agg(F.sum(F.col("n") * F.col("n")).alias("cost"))
    sparse = large.join(cost, "root", "left").where(F.coalesce("cost", F.lit(0)) < F.col("n") * F.col("n") / 2).select("root")
    sparse = written(sparse, "sparse-components")
    members = rare.join(groups.join(sparse, "root", "left_semi").select("root", "token", "blocks"), ["root", "token"])
    members = members.join(sets.select("doc_id", "weight", "grams"), "doc_id").select("root", "token", "blocks", "doc_id", "weight", "grams", "prefix")
    return whole(sets.join(sparse, "root", "left_anti")).unionAll(members)


def _overlaps(sets: list[np.ndarray]):
    """A function from the number of a set to the sizes of its intersections with all sets, by posting lists."""
    m, edges_of, flat = len(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])]), np.concatenate(sets)
    if not len(flat):
        return lambda x: np.zeros(m, np.int64)
    owner = np.repeat(np.arange(m), np.diff(edges_of))
    order = np.argsort(flat, kind="stable")
    column = np.cumsum(np.diff(flat[order], prepend=flat[order[:1]]) != 0)
    posts, edges = owner[order], np.searchsorted(column, np.arange(column[-1] + 2))
    column_of = np.empty(len(flat), np.int64)
    column_of[order] = column

    def of(x: int) -> np.ndarray:
        columns = column_of[edges_of[x] : edges_of[x + 1]]
        low, many = edges[columns], edges[columns + 1] - edges[columns]
        hit = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        return np.bincount(posts[hit], minlength=m)

    return of


def _verify(threshold: float):
    """Exact similarities inside a group (root, token, i, j): pairs of block i with block j, by posting lists of the grams."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, token, i, j, block, docs, weights, grams, prefix in _grouped(batches, 4):
            m = len(docs)
            sizes = np.array([len(g) // 8 for g in grams])
            common_with = _overlaps([np.frombuffer(g, np.uint64) for g in grams])
            if prefix[0] is not None:  # a pair counts in the group of the least shingle of both prefixes
                least = np.array(token[:1], np.int64).view(np.uint64)
                lower = [np.frombuffer(x, np.uint64) for x in prefix]
                lower_with = _overlaps([x[x < least] for x in lower])
            docs, weights, block = np.array(docs), np.array(weights), np.array(block)
            links, root = np.zeros(m, np.int64), np.arange(m)

            def top(x: int, root=root) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for x in np.flatnonzero(block == i[0]):
                common = common_with(x)
                ok = common >= threshold * (sizes + sizes[x] - common) - 1e-9
                ok[x] = False
                if i[0] != j[0]:
                    ok &= block == j[0]
                if prefix[0] is not None:
                    ok &= lower_with(x) == 0
                near = np.flatnonzero(ok)
                links[x] += weights[near].sum()
                if i[0] != j[0]:
                    links[near] += weights[x]
                for y in near:
                    a, b = top(x), top(y)
                    if a != b:
                        root[max(a, b, key=docs.__getitem__)] = min(a, b, key=docs.__getitem__)
            yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(docs[[top(x) for x in range(m)]]), pa.array(links)], names=["doc_id", "top", "links"])

    return of


def jaccard_classes(docs: DataFrame, threshold: float = 0.8, n: int = 5, block: int = BLOCK) -> DataFrame:
    """One row a document: doc_id, class_id, n_links.

    Two documents are linked if the Jaccard similarity of their sets of ``n``-word shingles is ``threshold`` or more.
    ``n_links`` counts the other documents that one is linked to; ``class_id`` is the least doc_id that it is linked to
    directly or through others. Other columns are ignored and may have any name. In a table with missing or repeated
    doc_ids each row is a document of its own, and a class of rows without doc_ids has none as its class_id.
    """
    rows, named = numbered(docs)
    return named(_classes(rows, threshold, n, block), "doc_id", "class_id")


def _classes(docs: DataFrame, threshold: float, n: int, block: int = BLOCK) -> DataFrame:
    parts = parallelism(docs.sparkSession)
    signed = written(docs.select("doc_id", "text").mapInArrow(_signatures(n), "doc_id long, digest binary, sig binary, labels array<long>"), "signatures")
    equal = signed.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("weight"))
    equal = written(equal, "equal-sets")
    reps = signed.join(equal.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "sig", "labels")
    near = components(_candidate_edges(reps, threshold), "candidates").withColumnsRenamed({"node": "doc_id"})
    sizes = near.groupBy("root").agg(F.count("*").alias("n"), F.ceil(F.count("*") / block).alias("blocks"))
    texts = docs.join(near.join(equal.select(F.col("rep").alias("doc_id"), "weight"), "doc_id"), "doc_id").select("doc_id", "text", "root", "weight")
    sets = texts.mapInArrow(_sets(n), "doc_id long, root long, weight long, grams binary").join(sizes.select("root", "blocks"), "root")
    own = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).alias("block")
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j")))
    rows = ["block", "doc_id", "weight", "grams", "prefix"]
    tasks = _dealt(sets, sizes, threshold, block).select("*", own).select("root", "token", F.explode(pairs).alias("p"), *rows).select("root", "token", "p.i", "p.j", *rows)
    group = ["root", "token", "i", "j"]
    verified = tasks.repartition(parts, *group).sortWithinPartitions(*group).mapInArrow(_verify(threshold), "doc_id long, top long, links long")
    verified = written(verified, "verified")
    tops = components(verified.select(F.col("doc_id").alias("u"), F.col("top").alias("v")), "classes")
    links = verified.groupBy("doc_id").agg(F.sum("links").alias("links"))
    by_set = equal.join(links.withColumnRenamed("doc_id", "rep"), "rep", "left").join(tops.withColumnRenamed("node", "rep"), "rep", "left")
    by_set = by_set.select("digest", F.coalesce("root", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    found = signed.select("doc_id", "digest").join(by_set, "digest").select("doc_id", "class_id", "n_links")
    return docs.select("doc_id").join(found, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def op8_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_classes(documents(spark, sf_dir), 0.8, 5)


def drop_near_duplicates(docs: DataFrame, threshold: float = 0.8, n: int = 5) -> DataFrame:
    """The rows of ``docs`` that represent their class, each class by its first; all columns stay.

    Of repeated rows one stays; rows without a doc_id come last in their class.
    """
    rows, _ = numbered(docs, row=True)
    heads = _classes(rows.select("doc_id", "text"), threshold, n).where("doc_id = class_id").select("doc_id")
    return rows.join(heads, "doc_id", "left_semi").select("row.*")

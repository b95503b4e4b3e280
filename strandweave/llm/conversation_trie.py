"""The trie of all conversations by their turns, built by halving sequences (van Emde Boas recursion).

A node stands for the conversations that begin with the same turns (role and text). The recursion cuts all sequences at
half of the greatest depth and names each cut prefix after its least conversation; the distinct prefixes are the upper
trie, and what is left of the sequences is a forest below each cut. Both go on in the same way. All problems of one size
are handled by the same two Spark jobs, so that depth ``d`` takes ``log2(d)`` rounds: an aggregation names the cut
prefixes (with combining before the shuffle, so that a very common first turn isn't a bottleneck), and a join hands each
sequence the name that it goes on under. Equal sequences are one row with a weight from the start, and prefixes become
one row each when they are named, so that the rows of a round are at most the trie's nodes.

On the way back, the path of a sequence through the trie is that of its upper part and that of its lower part together,
and the totals of each lower forest (leaves, saved tokens) are grafted onto all nodes above its cut, along the upper path.

Turns are ordered by ``turn`` (none first); equal ones by role, then by the digest of role and text. Null roles and texts
are empty. Rows without a conv_id belong to no conversation and are left out; repeated rows are turns like any other. An
empty table has no nodes, not even a root. Turns are told apart by 128 bits of the SHA-256 of role and text; texts are
never shuffled. A conversation has to fit into a row, with about 40 bytes a turn. Other columns are ignored and may have
any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Neighbouring conv_ids whose decimals are joined into one string before the digest of a node's conversations is taken.
BLOCK = 4096


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as digests and code points of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)), 1, 16)
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").cast("long").alias("turn"), role.alias("role"), digest.alias("digest"), F.length(text).cast("long").alias("chars")).alias("t"))
    turns = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["chars"].alias("chars")))
    return rows.groupBy("conv_id").agg(turns.alias("turns"))


def share_heads(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) of the contract's rebuilt conversations: the first ``h`` turns come from the conversation whose number
    is the next multiple of 100 towards zero, ``h`` being the CRC of the own number modulo 6."""
    own = written(_turns(conversations), "conversations")
    heads = own.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, 5).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")
    rows = own.select("conv_id", "turns", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % 100).alias("base")).join(heads, "base", "left")
    none = F.slice("turns", 1, 0)
    return rows.select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), none), F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def _name(turns: Column | str) -> Column:
    """128 bits of the SHA-256 of the turns' digests."""
    return F.substring(F.unhex(F.sha2(F.array_join(F.transform(turns, lambda t: F.hex(t["digest"])), ""), 256)), 1, 16)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(whole, ends_sha256) from rows (whole, block, ids) in order; one digest goes on from row to row."""
    whole, sha = None, None
    out: list[tuple[bytes, str]] = []
    for batch in batches:
        for at, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if at == whole:
                sha.update(b",")
            else:
                if sha is not None:
                    out.append((whole, sha.hexdigest()))
                whole, sha = at, hashlib.sha256()
            sha.update(ids.encode())
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.binary(), pa.string()), strict=True)], names=["whole", "ends_sha256"])
            out = []
    if sha is not None:
        out.append((whole, sha.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.binary(), pa.string()), strict=True)], names=["whole", "ends_sha256"])


def _digests_of_ends(members: DataFrame) -> DataFrame:
    """(whole, ends_sha256) from ``members(whole, conv_id)``: conv_ids are joined in blocks and the blocks hashed in order."""
    blocks = members.groupBy("whole", F.floor(F.col("conv_id") / BLOCK).alias("block")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    return blocks.repartition("whole").sortWithinPartitions("whole", "block").mapInArrow(_ends, "whole binary, ends_sha256 string")


def _cut(problems: DataFrame, half: int) -> tuple[DataFrame, DataFrame]:
    """One round: ``problems(at, root, conv, turns, weight)`` cut after ``half`` turns.

    Returns the problems of half the size and the cuts (at, root, conv, upper, below): the name of each sequence's upper
    part, and whether it goes on below.
    """
    rows = problems.withColumn("head", _name(F.slice("turns", 1, half)))
    upper = written(rows.groupBy("at", "root", "head").agg(F.min("conv").alias("upper"), F.sum("weight").alias("weight"), F.first(F.slice("turns", 1, half)).alias("turns")), "trie-upper")
    cut = rows.join(upper.select("at", "root", "head", "upper"), ["at", "root", "head"]).select("at", "root", "conv", "upper", "weight", F.slice("turns", F.lit(half + 1), F.size("turns")).alias("turns"))
    cut = written(cut, "trie-cuts")
    lower = cut.where(F.size("turns") > 0).select((F.col("at") + half).alias("at"), F.col("upper").alias("root"), "conv", "turns", "weight")
    cuts = cut.select("at", "root", "conv", "upper", (F.size("turns") > 0).alias("below"))
    return upper.select("at", "root", F.col("upper").alias("conv"), "turns", "weight").unionByName(lower), cuts


def _grafted(totals: DataFrame, paths: DataFrame, half: int) -> DataFrame:
    """Add the totals of the forest below each cut to all nodes on the upper path that ends in the cut."""
    above = F.col("depth") - 1
    forests = totals.where(above % (2 * half) == half).groupBy(above.alias("cut"), F.col("parent").alias("name")).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    ending = paths.where(F.col("at") % (2 * half) == 0).select((F.col("at") + half).alias("cut"), F.col("conv").alias("name"), "at", "path")
    more = forests.join(ending, ["cut", "name"]).select(F.posexplode("path").alias("i", "conv"), "at", "leaves", "saved")
    more = more.select((F.col("at") + F.col("i") + 1).alias("depth"), "conv", F.lit(None).cast("long").alias("parent"), "leaves", "saved")
    return totals.unionByName(more).groupBy("depth", "conv").agg(F.max("parent").alias("parent"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def build_trie(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie of ``sequences(conv_id, turns)``, ``turns`` being arrays of (digest, chars), one row a conversation.

    Columns: conv_id (the least of the node's conversations), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens (the code points of all turns below and including the node that a cache of prefixes saves) and
    ends_sha256 (of the conversations that end here).
    """
    members = written(sequences.select("conv_id", "turns", _name("turns").alias("whole")), "trie-members")
    whole = members.agg(F.min("conv_id"), F.count("*"), F.max(F.size("turns"))).first()
    root, n_convs, deepest = whole
    distinct = written(members.groupBy("whole").agg(F.min("conv_id").alias("conv"), F.count("*").alias("weight"), F.first("turns").alias("turns")), "trie-sequences")
    problems = distinct.where(F.size("turns") > 0).select(F.lit(0).cast("long").alias("at"), F.lit(root).cast("long").alias("root"), "conv", "turns", "weight")
    half, rounds = 1 << max((deepest or 1) - 1, 0).bit_length(), []
    while half > 1:
        half //= 2
        problems, cuts = _cut(problems, half)
        rounds.append((half, cuts))
    nodes = problems.select((F.col("at") + 1).alias("depth"), "conv", F.col("root").alias("parent"), F.col("weight").alias("n_convs"), F.col("turns")[0]["chars"].alias("chars"))
    nodes = written(nodes, "trie-nodes")
    children = written(nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("conv")).agg(F.count("*").alias("n_children")), "trie-children")
    totals = nodes.join(children, ["depth", "conv"], "left").select("depth", "conv", "parent", F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    totals = written(totals, "trie-totals")
    paths = nodes.select((F.col("depth") - 1).alias("at"), F.col("parent").alias("root"), "conv", F.array("conv").alias("path"))
    for half, cuts in reversed(rounds):
        totals = written(_grafted(totals, paths, half), "trie-totals")
        upper = paths.select("at", "root", F.col("conv").alias("upper"), F.col("path").alias("first"))
        lower = paths.select((F.col("at") - half).alias("at"), F.col("root").alias("upper"), "conv", F.col("path").alias("then"), F.lit(True).alias("below"))
        joined = cuts.join(upper, ["at", "root", "upper"]).join(lower, ["at", "upper", "conv", "below"], "left")
        paths = written(joined.select("at", "root", "conv", F.concat("first", F.coalesce("then", F.slice("first", 1, 0))).alias("path")), "trie-paths")
    ends = distinct.select("whole", F.col("conv").alias("rep")).join(_digests_of_ends(members), "whole")
    # A sequence ends in the last node of its path; the one without turns ends in the root.
    last = paths.select(F.col("conv").alias("rep"), F.size("path").cast("long").alias("depth"), F.element_at("path", -1).alias("conv"))
    ended = ends.join(last, "rep", "left").select(F.coalesce("depth", F.lit(0).cast("long")).alias("depth"), F.coalesce("conv", F.lit(root).cast("long")).alias("conv"), "ends_sha256")
    top = totals.where("depth = 1").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    number = lambda x: F.lit(x).cast("long")
    top = top.where(F.lit(n_convs > 0)).select(number(0).alias("depth"), number(root).alias("conv"), number(None).alias("parent"), number(n_convs).alias("n_convs"), F.coalesce("leaves", number(1)).alias("leaves"), F.coalesce("saved", number(0)).alias("saved"))
    found = nodes.select("depth", "conv", "parent", "n_convs").join(totals.drop("parent"), ["depth", "conv"]).unionByName(top)
    found = found.join(children, ["depth", "conv"], "left").join(ended, ["depth", "conv"], "left")
    return found.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", F.coalesce("n_children", number(0)).alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """``build_trie`` of conversations (conv_id, turn, role, text) as they are."""
    return build_trie(_turns(conversations))


def op12_conversation_trie(spark, sf_dir: str) -> DataFrame:
    return build_trie(share_heads(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


_CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i::INT, 1))::BIGINT)), lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)), lambda y, k: xor(y >> 1, (y & 1) * 3988292384))), 4294967295)"
SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS n FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, {_CRC} % 6 AS h, conv_id - conv_id % 100 AS base FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS s FROM t)),
r AS (SELECT c.conv_id, 0 AS part, t.n, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.n <= c.h
  UNION ALL SELECT c.conv_id, 1, t.n, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.n > c.h),
d AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, n) AS depth, concat(length(role), ':', role, text) AS turn, length(text) AS chars FROM r),
l AS (SELECT conv_id, list(sha256(turn) ORDER BY depth) AS turns FROM d GROUP BY conv_id),
p AS (SELECT d.conv_id, d.depth, d.chars, md5(array_to_string(l.turns[1:d.depth], '')) AS prefix FROM d JOIN l USING (conv_id)
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
g AS (SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM p GROUP BY depth, prefix),
q AS (SELECT g.*, above.prefix AS above FROM g LEFT JOIN p AS above ON above.conv_id = g.conv_id AND above.depth = g.depth - 1),
k AS (SELECT depth - 1 AS depth, above AS prefix, count(*) AS n_children FROM q WHERE depth > 0 GROUP BY 1, 2),
n AS (SELECT g.*, coalesce(k.n_children, 0) AS n_children FROM g LEFT JOIN k USING (depth, prefix)),
s AS (SELECT p.depth, p.prefix, sum((n.n_children = 0)::BIGINT) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
  FROM p JOIN n ON n.conv_id = p.conv_id AND p.depth <= n.depth GROUP BY p.depth, p.prefix),
e AS (SELECT depth, prefix, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends FROM (SELECT conv_id, depth, prefix FROM p QUALIFY depth = max(depth) OVER (PARTITION BY conv_id)) GROUP BY depth, prefix)
SELECT n.conv_id, n.depth::BIGINT AS depth, parent.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM n JOIN s USING (depth, prefix) LEFT JOIN e USING (depth, prefix)
LEFT JOIN q ON q.depth = n.depth AND q.prefix = n.prefix LEFT JOIN g AS parent ON parent.depth = n.depth - 1 AND parent.prefix = q.above
"""

"""The trie of conversations against one built turn by turn."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

from strandweave.llm import conversation_trie as T

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, at long, weight string"


def brute_trie(sequences: dict[int, list[tuple[str, str]]]) -> set[tuple]:
    """The rows of ``build_trie`` from (role, text) sequences by conv_id."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    rows = set()
    for node, of in members.items():
        below = [x for x in members if x[: len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = sum(not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below) for x in below)
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        rows.add((min(of), len(node), min(members[node[:-1]]) if node else None, len(of), len(children), leaves, saved, digest))
    return rows


def ordered(rows) -> dict[int, list[tuple[str, str]]]:
    """Turns (role, text) in order by conv_id, from (conv_id, turn, role, text)."""
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            found[c].append(((turn is not None, turn or 0), role, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16], text))
    return {c: [(role, text) for _, role, _, text in sorted(turns)] for c, turns in found.items()}


def brute_rebuilt(rows) -> dict[int, list[tuple[str, str]]]:
    own = ordered(rows)
    found = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = abs(c) // 100 * 100 * (1 if c >= 0 else -1)
        found[c] = own.get(base, [])[:h] + turns[h:]
    return found


def random_rows(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-120, 400), 70) + [0, 100, 2**40]:
        n = rng.choice([1, 2, 3, 5, 9, 40])
        for t in range(n):
            turn = None if rng.random() < 0.05 else t
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice([None, "", "a", "é𝄞", f"text {t}"])))
    rows += rows[:40] + [(None, 1, "user", "lost")] * 3
    for c in (500, 501, 502, 503):  # equal ones, and one that goes on
        rows += [(c, t, "user", f"same {t}") for t in range(12)]
    rows += [(503, 12, "user", "more"), (600, 0, "user", "only")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "w") for r in rows], SCHEMA).repartition(3)


def test_trie_equals_one_built_turn_by_turn(spark):
    rows = random_rows(1)
    assert {tuple(r) for r in T.conversation_trie(frame(spark, rows)).collect()} == brute_trie(ordered(rows))


def test_rebuilt_conversations(spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK", 3)
    rows = random_rows(2)
    got = T.build_trie(T.share_heads(frame(spark, rows))).collect()
    want = brute_trie(brute_rebuilt(rows))
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert any(not turns for turns in brute_rebuilt(rows).values())  # a turnless one ends in the root


def test_small_and_empty_tables(spark):
    empty = frame(spark, random_rows(1)).limit(0)
    assert T.conversation_trie(empty).collect() == [] and T.build_trie(T.share_heads(empty)).collect() == []
    for rows in ([(5, 0, "u", "x")], [(5, 0, "u", "x"), (6, 0, "u", "x")], [(5, 0, "u", "x"), (5, 1, "u", "y"), (4, 0, "u", "x")], [(7, 0, "ab", "c"), (8, 0, "a", "bc")]):
        assert {tuple(r) for r in T.conversation_trie(frame(spark, rows)).collect()} == brute_trie(ordered(rows))
        assert {tuple(r) for r in T.build_trie(T.share_heads(frame(spark, rows))).collect()} == brute_trie(brute_rebuilt(rows))


def test_query_equals_brute_force_and_sql(spark):
    import duckdb

    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect()]
    got = T.op12_conversation_trie(spark, SMALL)
    assert {tuple(r) for r in got.collect()} == brute_trie(brute_rebuilt(rows))
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{SMALL}/conversations.parquet'")
    want = con.sql(T.SQL)
    assert want.columns == got.columns and set(want.fetchall()) == {tuple(r) for r in got.collect()}

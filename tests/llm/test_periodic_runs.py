"""Periodic runs against a scan of all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from strandweave.llm import periodic_runs as P
from strandweave.llm.words import word_bounds, word_names

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by scanning every period."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text) -> tuple:
    """The contract's row."""
    words = WORD.findall((text or "").encode())
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda x: hashlib.sha256(x).hexdigest()
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, n, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2], sha("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()), sha(kept))


def repetitive(rng: random.Random) -> list[str]:
    """Words with repeated, nested and broken stretches of all periods."""
    vocabulary, out = [f"w{i}" for i in range(rng.choice([1, 2, 3, 30, 1000]))], []
    for _ in range(rng.randint(1, 5)):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        if rng.random() < 0.4:
            base = base[: max(1, len(base) // 6)] * rng.randint(1, 6) + base[: rng.randint(1, 20)]
        part = base * rng.choice([1, 1, 2, 3, 4, 5]) + base[: rng.randint(0, len(base))]
        if rng.random() < 0.3:
            part[rng.randrange(len(part))] = "broken"
        out += part
    return out


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_a_scan_of_all_periods(seed):
    rng = random.Random(seed)
    for _ in range(10):
        texts = [" ".join(repetitive(rng)).encode() for _ in range(4)]
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        for text, (_, runs, words) in zip(texts, P._judged([None] * 4, np.frombuffer(b"".join(texts), np.uint8), bounds, False), strict=True):
            assert words == text.split()
            assert [(a, b - a, q) for a, b, q in runs.tolist()] == brute_runs(words)


def test_a_long_period_is_found_among_words_that_repeat_inside_it():
    block = ["a", "b"] * 150 + [f"c{i}" for i in range(40)] + ["a", "b"] * 150 + [f"d{i}" for i in range(41)]
    words = ["start", *block, *block, *block, *block[:17], "end"]
    text = " ".join(words).encode()
    (_, runs, _), = P._judged([None], np.frombuffer(text, np.uint8), np.array([0, len(text)]), False)
    assert [(a, b - a, q) for a, b, q in runs.tolist()] == brute_runs(words)
    assert (1, 3 * len(block) + 17, len(block)) in [(a, b - a, q) for a, b, q in runs.tolist()]


def test_query_equals_brute_force_over_a_whole_table(spark):
    path = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()
    got = {tuple(r) for r in P.op13_periodic_runs(spark, path).collect()}
    assert got == {brute_row(r.doc_id, r.text) for r in rows}


def test_nulls_repeated_rows_and_empty_tables(spark):
    rows = [(None, "x " * 30, "k"), (None, "x " * 30, "k"), (7, None, "k"), (8, "", "k"), (8, " \n\t\x0b ", "k"), (9, "é " * 23, "k"), (10, "é a " * 24, "k"), (24, "word", "k"), (11, "one two three " * 9, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(2)
    got = P.periodic_runs(table, rebuild=True).mapInArrow(P._digest, P.DIGEST).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((brute_row(d, t) for d, t, _ in rows), key=repr)
    assert P.periodic_runs(table.limit(0)).collect() == []


def test_names_tell_words_apart():
    words = [b"a", b"b", b"ab", b"ba", b"abcdefgh", b"abcdefghi", b"abcdefgh\xc3\xa9", b"x" * 16, b"x" * 17, b"x" * 4000, b"a"]
    data, bounds = np.frombuffer(b" ".join(words), np.uint8), np.array([0, len(b" ".join(words))])
    start, end, edges = word_bounds(data, bounds)
    names = word_names(data, start, end).tolist()
    assert edges.tolist() == [0, len(words)] and len(set(names)) == len(words) - 1 and names[0] == names[-1]
    joined = np.frombuffer(b"abcd ef", np.uint8)
    assert [x.tolist() for x in word_bounds(joined, np.array([0, 0, 2, 7, 7]))] == [[0, 2, 5], [2, 4, 7], [0, 0, 1, 3, 3]]

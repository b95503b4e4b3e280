"""Katz scores against a model of plain dictionaries."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandweave.llm import lm_scoring as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens(text: str | None) -> list[str]:
    return [*WORD.findall((text or "").translate(UPPER)), "</s>end"]


class Brute:
    """The model from dictionaries of tuples."""

    def __init__(self, texts: list, order: int):
        self.order = order
        self.count = [Counter() for _ in range(order)]
        self.around = [Counter() for _ in range(order)]
        for text in texts:
            for i, h, w in self.steps(text):
                for k in range(order):
                    context = h[len(h) - k :]
                    self.count[k][context, w] += 1
                    self.around[k][context] += 1
        self.discount = [L.Discounts(np.array([sum(c == r for c in n.values()) for r in range(L.FITTED + 2)], float)) for n in self.count]
        self.after = [defaultdict(list) for _ in range(order)]
        for k in range(order):
            for h, w in self.count[k]:
                self.after[k][h].append(w)
        self.weight: dict = {}

    def steps(self, text):
        history = ["<s>start"] * (self.order - 1)
        for i, w in enumerate(tokens(text)):
            yield i, tuple(history[len(history) - self.order + 1 :]), w
            history.append(w)

    def direct(self, h, w) -> float:
        k, c = len(h), self.count[len(h)][h, w]
        return float(self.discount[k](np.array([c]))[0]) * c / self.around[k][h]

    def p(self, h, w) -> float:
        k = len(h)
        if self.count[k][h, w]:
            return self.direct(h, w)
        below = self.p(h[1:], w) if h else 1.0
        if not self.around[k][h]:
            return below
        if h not in self.weight:
            seen = self.after[k][h]
            self.weight[h] = (1 - sum(self.direct(h, x) for x in seen)) / (1 - (sum(self.direct(h[1:], x) for x in seen) if h else 0))
        return self.weight[h] * below

    def row(self, text) -> tuple:
        words, n = tokens(text), sum(self.count[0].values())
        base = sum(math.log10((self.count[0][(), w] + 0.5) / (n + 0.5 * (len(self.count[0]) + 1))) for w in words)
        return len(words), sum(self.count[0][(), w] > 0 for w in words), n, base, sum(math.log10(self.p(h, w)) for _, h, w in self.steps(text))


def texts() -> list[tuple]:
    rng = random.Random(9)
    vocabulary = [f"W{i}é" if i % 5 == 0 else f"word{i}" for i in range(150)]
    prose = lambda n: " ".join(vocabulary[min(int(rng.expovariate(0.05)), 149)] for _ in range(n))
    rows = [(i, prose(rng.randint(1, 120)), i % 3 != 1) for i in range(60)]
    rows += [(100, None, True), (101, "", False), (102, " \n\t ", True), (103, "ÉTÉ A unknown1 unknown2 word1", False), (104, "the " * 500, True), (105, "x" * 5000 + " y", False)]
    return rows + [(None, prose(30), True), (None, prose(30), None), (7, prose(20), True), (7, prose(20), True), (7, prose(9), False)]


SCHEMA = "doc_id long, text string, learn boolean"


def close(got, want) -> bool:
    return got[:3] == want[:3] and all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(got[3:], want[3:], strict=True))


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_plain_dictionaries(spark, order, monkeypatch):
    monkeypatch.setattr(L, "LEAST_CHUNK", 4000)
    rows = texts()
    model = Brute([t for _, t, learn in rows if learn], order)
    table = spark.createDataFrame([(d, t, x, 1, "c", 0) for d, t, x in rows], f"{SCHEMA}, chunk long, counts string, `order` int").repartition(3)
    got = sorted(((str(r.doc_id), r.learn, (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)) for r in L.katz_scores(table, F.col("learn"), order).collect()), key=str)
    want = sorted(((str(d), bool(x), model.row(t)) for d, t, x in rows), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(close(g[2], w[2]) for g, w in zip(got, want, strict=True))


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_sum_to_one_after_every_context(order):
    model = Brute([t for _, t, learn in texts() if learn][:25], order)
    vocabulary = [w for _, w in model.count[0]]
    contexts = [h for k in range(order) for h in list(model.around[k])[:40]]
    for h in [*contexts, *[("unknown1",) * (order - 1)]]:
        assert math.isclose(sum(model.p(h, w) for w in [*vocabulary, "never seen"]), 1, rel_tol=1e-9)


def test_discounts_are_good_and_turings_where_they_hold():
    n = np.array([0, 1000, 300, 150, 90, 60, 40, 30, 25, 20, 15, 100.0])
    d = L.Discounts(n)(np.array([1, 2, 5, 6, 1000]))
    assert np.allclose(d[:3], [2 * 300 / 1000, 3 * 150 / (2 * 300), 6 * 40 / (5 * 60)]) and (np.diff(d[3:]) > 0).all() and (d < 1).all()
    for bad in (np.zeros(12), np.array([0, 5, *[0] * 10], float), np.array([0, 1, 50, 400, *[1] * 8], float)):
        d = L.Discounts(bad)(np.arange(1, 2000))
        assert ((d > 0) & (d < 1)).all()


def test_query_equals_plain_dictionaries_over_a_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows}
    model = Brute([t for d, t in rows if not held[d]], L.ORDER)
    got = {r.doc_id: tuple(r) for r in L.op11_lm_scoring(spark, SMALL).collect()}
    assert len(got) == len(rows) and all(got[d][1] == held[d] and close(got[d][2:], model.row(t)) for d, t in rows)


def test_empty_tables_and_no_training_texts(spark):
    table = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert L.katz_scores(table.limit(0), F.lit(True)).collect() == []
    assert sorted(map(tuple, L.katz_scores(table, F.lit(False)).collect())) == [(1, False, 3, 0, 0, 0.0, 0.0), (2, False, 1, 0, 0, 0.0, 0.0)]


def test_numbers_come_back_from_bytes():
    numbers = np.array([0, 1, 255, 256, 2**40, 2**64 - 1], np.uint64)
    assert L.unpacked(L.packed(numbers)).tolist() == numbers.tolist() and len(L.unpacked(b"")) == 0

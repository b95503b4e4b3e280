"""The pipeline against a plain version of each stage, and its stages on rows with nulls."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import corpus_pipeline
from strandweave.llm import mixing
from tests.llm.test_operators import SCHEMA, SMALL, TEXTS, WORD, brute_classes, brute_leaks, brute_quality, table


def brute_budgets(leaves: dict[tuple, int], percent: int, epochs: int) -> dict[tuple, int]:
    """Token budgets of leaves (domain, lang, source) with their tokens, from the root down."""
    total = sum(leaves.values())
    given = {(): min(total * percent // 100, total * epochs)}
    for depth, level in enumerate(mixing.LEVELS, 1):
        below = defaultdict(int)
        for leaf, tokens in leaves.items():
            below[leaf[:depth]] += tokens * epochs
        after = {}
        for node, rest in given.items():
            children = [c for c in below if c[:-1] == node]
            weight = {c: mixing.WEIGHTS[level].get(c[-1], 1) for c in children}
            children.sort(key=lambda c: (below[c] / weight[c], c[-1]))
            weights = sum(weight.values())
            for i, c in enumerate(children):
                if below[c] * weights > rest * weight[c]:
                    after |= {x: rest * weight[x] // weights for x in children[i:]}
                    break
                after[c] = below[c]
                rest, weights = rest - below[c], weights - weight[c]
        given = after
    return given


def brute_mix(rows: list, percent: int, epochs: int) -> dict[int, int]:
    """Copies of each doc_id."""
    leaf_of, words = {}, {}
    for r in rows:
        number = re.search("([0-9]+)$", r.source or "")
        leaf_of[r.doc_id] = (f"domain{int(number[1]) % 3 if number else 0}", r.lang or "unknown", r.source or "unknown")
        words[r.doc_id] = len(WORD.findall(r.text or ""))
    leaves = defaultdict(int)
    for d, leaf in leaf_of.items():
        leaves[leaf] += words[d]
    leaves = {leaf: n for leaf, n in leaves.items() if n}
    copies = dict.fromkeys(leaf_of, 0)
    for leaf, budget in brute_budgets(leaves, percent, epochs).items():
        whole, rest = divmod(budget, leaves[leaf])
        used = 0
        for d in sorted((d for d in leaf_of if leaf_of[d] == leaf), key=lambda d: hashlib.md5(f"{mixing.SEED}:{whole}:{d}".encode()).hexdigest()):
            used += words[d]
            copies[d] = whole + (rest > 0 and used <= rest)
    return copies


def brute_pipeline(rows: list, items: dict[int, str]) -> set[int]:
    rows = [r for r in rows if brute_quality(r.text)[-1]]
    heads = {c for c, _ in brute_classes({r.doc_id: r.text for r in rows}).values()}
    rows = [r for r in rows if r.doc_id in heads]
    leaky = {d for d, _ in brute_leaks({r.doc_id: r.text or "" for r in rows}, items)}
    rows = [r for r in rows if r.doc_id not in leaky]
    copies = brute_mix(rows, mixing.BUDGET_PERCENT, 1)
    return {d for d, n in copies.items() if n}


def test_pipeline_over_the_whole_table(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    items = {r.item_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    got = corpus_pipeline.run(spark, SMALL)
    assert set(rows[0].asDict()) <= set(got.columns)
    found = sorted(r.doc_id for r in got.collect())
    assert found == sorted(brute_pipeline(rows, items)) and found


def test_stages(spark, tmp_path):
    docs = table(spark, TEXTS.items())
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    leak = " ".join((TEXTS[13] or "").split()[:30])
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    wanted = brute_pipeline(docs.collect(), {1: leak})
    assert 13 not in wanted and wanted
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == wanted


def test_stages_keep_columns_and_take_rows_without_ids(spark, tmp_path):
    spark.createDataFrame([(1, TEXTS[30])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = table(spark, [(None, TEXTS[10]), (None, TEXTS[30]), (11, TEXTS[11]), (11, TEXTS[12]), (15, None), (15, TEXTS[15])])
    docs = rows
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == rows.columns, name
    texts = {r.text for r in corpus_pipeline.decontamination(spark, corpus_pipeline.near_duplicates(spark, corpus_pipeline.quality_rules(spark, rows, ""), ""), str(tmp_path)).collect()}
    assert texts == {TEXTS[10], TEXTS[11], TEXTS[12], TEXTS[15]}


def test_stages_take_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0

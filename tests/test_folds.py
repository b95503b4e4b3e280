"""Operators whose result depends on an order or a search, against plain versions over whole derived tables."""

from __future__ import annotations

import os
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strandweave.operators import transcripts as T
from strandweave.operators.masking import to_tiles
from strandweave.plans import QUERIES, transcript_queries
from strandweave.plans.model_queries import scored
from strandweave.plans.registry import Tables

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the given tables")
STOPS = {"TAA", "TAG", "TGA"}
PAIR = {"A": "T", "C": "G", "G": "C", "T": "A"}


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, DATA)


@pytest.fixture(scope="module")
def sequences(tables):
    return {r.seq_id: r.residues.upper() for r in tables.fx_sequences.collect()}


def test_gene_model_selection(spark, tables):
    by_seq = defaultdict(list)
    for r in scored(tables).collect():
        by_seq[r.seq_id].append(r)
    wanted = set()
    for models in by_seq.values():
        done = set()
        touch = lambda a, b: a.start_pos < b.end_pos and a.end_pos > b.start_pos
        for seed in sorted(models, key=lambda m: (m.file_level, m.start_pos, m.end_pos, m.model_id)):
            if seed.model_id in done:
                continue
            rivals = [m for m in models if m.model_id not in done and m.file_level >= seed.file_level and (touch(m, seed) or m.model_id == seed.model_id)]
            rivals.sort(key=lambda m: (-m.hit_coverage, m.file_level, m.start_pos, m.end_pos, m.model_id))
            winner, best = rivals[0], 0.0
            for m in rivals:
                if m.score > best:
                    winner, best = m, m.score
            wanted.add(winner.model_id)
            done |= {seed.model_id, winner.model_id} | {m.model_id for m in models if touch(m, winner)}
    assert {r.model_id for r in QUERIES["n1_select_gene_models"](spark, DATA).collect()} == wanted


def spliced(seq: str, exons: list[tuple[int, int]], strand: int, limit: int) -> tuple[list[int], list[int], list[int], dict[int, str]]:
    """Places before, in and behind the exons in the direction of the strand, and the letter at each place."""
    exons = sorted(exons)
    inside = [p for a, b in exons for p in range(a, b + 1)]
    low, high = list(range(max(1, exons[0][0] - limit), exons[0][0])), list(range(exons[-1][1] + 1, min(len(seq), exons[-1][1] + limit) + 1))
    letter = {p: seq[p - 1] for p in [*low, *inside, *high]}
    if strand == -1:
        return high[::-1], inside[::-1], low[::-1], {p: PAIR.get(x, x) for p, x in letter.items()}
    return low, inside, high, letter


def test_start_and_stop_repair(spark, tables, sequences):
    exons = defaultdict(set)
    for r in tables.fx_cds.collect():
        exons[r.parent_id, r.seq_id, r.strand].add((r.start_pos, r.end_pos))
    wanted = {}
    for (model, seq_id, strand), parts in exons.items():
        if seq_id not in sequences:
            continue
        seq = sequences[seq_id]
        merged = sorted(parts)
        coding = "".join(seq[a - 1 : b] for a, b in merged)
        low, high = merged[0][0], max(b for _, b in merged)
        read = lambda p: seq[p - 1 : p + 2] if strand == 1 else "".join(PAIR.get(x, x) for x in reversed(seq[p - 3 : p]))  # noqa: B023, E731
        inner = coding if strand == 1 else "".join(PAIR.get(x, x) for x in reversed(coding))
        first, last = inner[:3], inner[len(inner) // 3 * 3 - 3 : len(inner) // 3 * 3]
        size = (lambda a, b: b - a + 1)(*(merged[0] if strand == 1 else max(merged, key=lambda x: (x[0], x[1]))))
        inside = (12 if size - 12 > 6 else max(0, size - 6)) // 3 * 3
        begin, start_shift, stop_shift, unsure = (low if strand == 1 else high), None, None, False
        if first != "ATG":
            for shift in range(-inside, 601, 3):
                p = begin - strand * shift
                codon = read(p) if 1 <= min(p, p + 2 * strand) and max(p, p + 2 * strand) <= len(seq) else None
                if codon is None:
                    break
                unsure |= "N" in codon
                if codon in STOPS:
                    break
                if codon == "ATG":
                    start_shift = shift
                    break
        end = high if strand == 1 else low
        if last not in STOPS:
            for shift in range(3, 601, 3):
                p = end + strand * (shift - 2)
                codon = read(p) if 1 <= min(p, p + 2 * strand) and max(p, p + 2 * strand) <= len(seq) else None
                if codon is None:
                    break
                unsure |= "N" in codon
                if codon in STOPS:
                    stop_shift = shift
                    break
        a, b = start_shift or 0, stop_shift or 0
        wanted[model] = (strand, low - a if strand == 1 else low - b, high + b if strand == 1 else high + a, start_shift, stop_shift, unsure)
    got = {r.parent_id: (r.strand, r.start_pos, r.end_pos, r.start_shift, r.stop_shift, r.unsure) for r in QUERIES["n6_repair_start_stop"](spark, DATA).collect()}
    assert got == wanted


def brute_extension(seq: str, parts: list, strand: int, limit: int, mode: int) -> set:
    exons: list[list[int]] = []
    for a, b in sorted((r.start_pos, r.end_pos) for r in parts):
        if exons and a <= exons[-1][1] + 1:
            exons[-1][1] = max(b, exons[-1][1])
        else:
            exons.append([a, b])
    head, inside, tail, letter = spliced(seq, [tuple(x) for x in exons], strand, limit)
    utr = sum(r.end_pos - r.start_pos + 1 for r in parts if r.type == "five_prime_UTR")
    size = sum(r.end_pos - r.start_pos + 1 for r in parts if r.type == "polypeptide")
    if size < 3:
        return set()
    path = head + inside + tail
    codon = lambda k: "".join(letter[p] for p in path[k : k + 3])
    plain = lambda c: set(c) <= set("ACGT")
    begin = len(head) + utr
    if not (mode == 2 and utr > 2 or mode == 1 and codon(begin) == "ATG"):
        k, best, ends = begin, None, None
        while k >= 0:
            c = codon(k)
            if c in STOPS or (k <= len(head) + 2 and not plain(c)):
                ends = k + 3
                break
            best = k if c == "ATG" else best
            k -= 3
        begin_new = best if best is not None else ends if ends is not None else k + 3
    else:
        begin_new = begin
    last = exons[-1] if strand == 1 else exons[0]
    border = len(head) + len(inside) - (last[1] - last[0] + 1)
    k = begin + size // 3 * 3 - 3
    while True:
        c = codon(k)
        if c in STOPS or (k >= border and not plain(c)) or k + 6 > len(path):
            break
        k += 3
    end_new = k + 3
    kept = range(min(len(head), begin_new), max(len(head) + len(inside), end_new))
    kinds = {path[i]: "five_prime_UTR" if i < begin_new else "polypeptide" if i < end_new else "three_prime_UTR" for i in kept}
    out, run = set(), []
    for p in sorted(kinds):
        if run and (p != run[-1] + 1 or kinds[p] != kinds[run[-1]]):
            out.add((kinds[run[0]], run[0], run[-1]))
            run = []
        run.append(p)
    return out | {(kinds[run[0]], run[0], run[-1])}


def test_cds_extension(spark, tables, sequences):
    models = defaultdict(list)
    for r in transcript_queries.coding_pieces(tables).collect():
        models[r.parent_id, r.seq_id, r.strand].append(r)
    wanted = {(mode, m, *x) for mode in (0, 1, 2) for (m, s, strand), parts in models.items() if s in sequences for x in brute_extension(sequences[s], parts, strand, 60, mode)}
    got = {(r.mode, r.parent_id, r.type, r.start_pos, r.end_pos) for r in QUERIES["n22_extend_cds"](spark, DATA).collect()}
    assert got == wanted and len(got) > 1000


def test_cds_extension_by_hand(spark):
    #      5' flank   exon 1        intron  exon 2          3' flank
    seq = "CCATGCC" + "GGGCATGAA" + "GTAAAG" + "CCCAAACCC" + "GGGTGACC"
    rows = [("s", "t", 1, "polypeptide", 8, 16), ("s", "t", 1, "polypeptide", 23, 31)]
    parts = spark.createDataFrame(rows, "seq_id string, parent_id string, strand int, type string, start_pos long, end_pos long")
    seqs = spark.createDataFrame([("s", seq)], "seq_id string, residues string")
    lengths = spark.createDataFrame([("s", len(seq))], "seq_id string, length long")
    got = {(r.type, r.start_pos, r.end_pos) for r in T.extend_cds(parts, to_tiles(seqs, 16, 2), lengths, 7, 0, width=16).collect()}
    # In frame upstream of 8 stand CCC (5) and ATG? no: the codons begin at 5 and 2; the one at 2 is CAT, so the limit is taken.
    assert got == {("polypeptide", 2, 16), ("polypeptide", 23, 37)}
    mirrored = "".join(PAIR[x] for x in reversed(seq))
    n = len(seq)
    parts = spark.createDataFrame([("s", "t", -1, k, n + 1 - b, n + 1 - a) for _, _, _, k, a, b in rows], parts.schema)
    seqs = spark.createDataFrame([("s", mirrored)], "seq_id string, residues string")
    again = {(r.type, n + 1 - r.end_pos, n + 1 - r.start_pos) for r in T.extend_cds(parts, to_tiles(seqs, 16, 2), lengths, 7, 0, width=16).collect()}
    assert again == got


def brute_chains(rows: list, coverage: float, t_gap: int = 10, g_gap: int = 10_000) -> set:
    by_query = defaultdict(list)
    groups = defaultdict(list)
    for r in rows:
        groups[r.query_id, r.hit_id, r.strand].append(r)
    for (q, h, strand), hsps in groups.items():
        free = sorted(hsps, key=lambda r: (-r.bit_score, r.q_start, r.q_end, r.h_start, r.h_end))
        n = 0
        while free:
            chain = [free.pop(0)]
            while True:
                a, b = chain[0].q_start, chain[-1].q_end
                g0, g1 = (chain[0].h_start, chain[-1].h_end) if strand != -1 else (chain[0].h_end, chain[-1].h_start)
                up = [(abs(a - r.q_end), g0 - r.h_end if strand != -1 else r.h_start - g0, i) for i, r in enumerate(free) if r.q_start < a and r.q_end < b and a - r.q_end > -t_gap]
                down = [(abs(r.q_start - b), r.h_start - g1 if strand != -1 else g1 - r.h_end, i) for i, r in enumerate(free) if r.q_end > b and r.q_start > a and r.q_start - b > -t_gap]
                up, down = (min((x for x in side if 0 < x[1] < g_gap), default=None) for side in (up, down))
                if up is None and down is None:
                    break
                first, last = (free[x[2]] if x else None for x in (up, down))
                chain = ([first] if first else []) + chain + ([last] if last else [])
                free = [r for r in free if r is not first and r is not last]
            size, same = sum(r.align_len for r in chain), sum(r.n_identical for r in chain)
            h0, h1 = (chain[0].h_start, chain[-1].h_end) if strand != -1 else (chain[-1].h_start, chain[0].h_end)
            by_query[q].append((q, h, strand, n, chain[0].q_start, chain[-1].q_end, h0, h1, len(chain), min(1.0, size / chain[0].query_len), same / size))
            n += 1
    out = set()
    for chains in by_query.values():
        level = coverage
        while not any(c[9] >= level - 1e-9 for c in chains):
            level -= 0.05
        good = [c for c in chains if c[9] >= level - 1e-9]
        best = max(c[10] for c in good)
        out |= {(*c[:9], round(c[9], 9), round(c[10], 9)) for c in good if c[10] >= best - 0.05}
    return out


def test_chains_of_both_strands(spark, tables):
    rows = tables.fx_hsps.collect()
    assert {r.strand for r in rows} == {1, -1}
    got = {(*r[:9], round(r.coverage, 9), round(r.identity, 9)) for r in QUERIES["n24_chain_hsps"](spark, DATA).collect()}
    assert got == brute_chains(rows, 0.3)
    # Larger groups make longer chains; each of them is kept.
    fewer = tables.fx_hsps.withColumns({"query_id": F.substring("query_id", 1, 2), "n_identical": F.col("align_len")})
    got = {(*r[:9], round(r.coverage, 9), round(r.identity, 9)) for r in T.chain_hsps(fewer, coverage=0.01).collect()}
    assert got == brute_chains(fewer.collect(), 0.01) and {c[2] for c in got if c[8] > 1} == {1, -1}


def brute_windows(rows: list) -> set:
    out = set()
    by_seq = defaultdict(list)
    for r in rows:
        by_seq[r.seq_id].append(r)
    for seq, windows in by_seq.items():
        clusters: list[list] = []
        high = 0
        for w in sorted(windows, key=lambda w: (w.start_pos, w.end_pos)):
            if not clusters or w.start_pos > high:
                clusters.append([])
                high = w.end_pos
            clusters[-1].append(w)
            high = max(high, w.end_pos)
        for cluster in clusters:
            cluster.sort(key=lambda w: (w.g_start, w.g_end, w.window_id))
            dropped = set()
            for w in cluster:
                if w.window_id in dropped:
                    continue
                start, end = w.start_pos, w.end_pos
                for o in cluster:
                    if o is w:
                        continue
                    if o.g_end < w.g_start:
                        start = o.g_end + 1
                    elif w.g_end < o.g_start:
                        end = o.g_start - 1
                        break
                    else:
                        common = ((w.end_pos - w.start_pos + 1 + o.end_pos - o.start_pos + 1) - abs(w.start_pos - o.start_pos) - abs(w.end_pos - o.end_pos)) / 2
                        if common / (o.end_pos - o.start_pos + 1) >= 0.9:
                            dropped.add(o.window_id)
                out.add((seq, w.window_id, start, end))
    return out


def test_windows_are_dropped_and_trimmed(spark, tables):
    rows = transcript_queries.windows(tables).collect()
    got = {tuple(r) for r in QUERIES["n26_dedupe_windows"](spark, DATA).collect()}
    kept, given = {r[1]: r[2:] for r in got}, {r.window_id: (r.start_pos, r.end_pos) for r in rows}
    assert any(kept[w] != given[w] for w in kept)
    assert got == brute_windows(rows)


def test_long_sequences_pass_in_tiles(spark):
    """Two million bases: no row holds the sequence, frames cross tile borders."""
    n, width = 2_000_000, 65_536
    base = spark.range(0, n // width + 1).select(F.lit("c").alias("seq_id"), F.col("id").cast("int").alias("tile_no"), (F.col("id") * width + 1).alias("tile_start"))
    size = F.least(F.lit(width + 2), F.lit(n) - F.col("tile_start") + 1)
    tiles = base.withColumn("residues", F.substring(F.repeat(F.lit("ACGGCC"), width // 6 + 12), (F.col("tile_start") % 6).cast("int") + 1, size.cast("int")))
    lengths = spark.createDataFrame([("c", n)], "seq_id string, length long")
    frames = T.scan_orfs(tiles, lengths, longest=10**9).select("strand", "frame", F.length("orf").alias("n")).collect()
    assert len(frames) == 6 and all(r.n >= n - 3 for r in frames)


def test_one_component_of_many_models_is_chosen_as_plainly(spark):
    """30,000 models of one locus, some of them very long."""
    import numpy as np

    from strandweave.operators import models as G

    rng, n = np.random.default_rng(2), 30_000
    start = np.sort(rng.integers(1, 3_000_000, n))
    end = start + np.where(rng.random(n) < 0.001, rng.integers(100_000, 2_000_000, n), rng.integers(50, 2000, n))
    level, coverage, score = rng.integers(0, 4, n), rng.integers(0, 50, n).astype(float), rng.integers(-20, 90, n).astype(float)
    name = np.char.add("m", np.char.zfill(np.arange(n).astype(str), 5))
    order = np.lexsort((name, end, start, level))
    start, end, level, coverage, score, name = (c[order] for c in (start, end, level, coverage, score, name))
    done, wanted = np.zeros(n, bool), set()
    for seed in range(n):
        if done[seed]:
            continue
        near = (start < end[seed]) & (end > start[seed]) & ~done & (level >= level[seed])
        near[seed] = True
        rows = np.flatnonzero(near)
        rows = rows[np.argsort(-coverage[rows], kind="stable")]
        best = int(np.argmax(score[rows]))
        winner = int(rows[best] if score[rows[best]] > 0 else rows[0])
        wanted.add(str(name[winner]))
        done |= (start < end[winner]) & (end > start[winner])
        done[[seed, winner]] = True
    import pandas as pd

    table = spark.createDataFrame(pd.DataFrame({"seq_id": "c", "model_id": name, "file_level": level, "start_pos": start, "end_pos": end, "hit_coverage": coverage, "score": score}))
    assert {r.model_id for r in G.select_models(table).collect()} == wanted


def plain_chains(rows, t_gap=10, g_gap=10_000):
    """Chains of one hit, looking at all that is free at each step; rows are (score, q_start, q_end, h_start, h_end)."""
    rows = sorted(rows, key=lambda r: (-r[0], *r[1:]))
    free, out = set(range(len(rows))), []
    while free:
        seed = min(free)
        free.discard(seed)
        (_, q0, q1, a0, a1), n = rows[seed], 1
        while True:
            before = [(abs(q0 - rows[i][2]), a0 - rows[i][4], i) for i in free if rows[i][1] < q0 and rows[i][2] < q1 and q0 - rows[i][2] > -t_gap and 0 < a0 - rows[i][4] < g_gap]
            behind = [(abs(rows[i][1] - q1), rows[i][3] - a1, i) for i in free if rows[i][2] > q1 and rows[i][1] > q0 and rows[i][1] - q1 > -t_gap and 0 < rows[i][3] - a1 < g_gap]
            if not before and not behind:
                break
            one, other = min(before, default=None), min(behind, default=None)
            if one:
                free.discard(one[2])
                q0, a0, n = rows[one[2]][1], rows[one[2]][3], n + 1
            if other:
                free.discard(other[2])
                q1, a1, n = rows[other[2]][2], rows[other[2]][4], n + 1
        out.append((q0, q1, a0, a1, n))
    return sorted(out)


@pytest.mark.parametrize("few", [0, 8, 256])
def test_chains_of_many_alignments(spark, monkeypatch, few):
    import random

    monkeypatch.setattr(T._Facing, "FEW", few)
    rng = random.Random(few)
    rows = []
    for _ in range(500):
        q, h = rng.randrange(1, 3000), rng.randrange(1, 60_000)
        rows.append((rng.randrange(100), q, q + rng.randrange(5, 60), h, h + rng.randrange(5, 60)))
    # One coverage and identity for all, so that every chain is kept.
    table = spark.createDataFrame([("q", "h", 1, 1, s, q0, q1, a, b, 10, 9) for s, q0, q1, a, b in rows], "query_id string, hit_id string, strand int, query_len long, bit_score long, q_start long, q_end long, h_start long, h_end long, align_len long, n_identical long")
    got = sorted((r.q_start, r.q_end, r.h_start, r.h_end, r.n_hsps) for r in T.chain_hsps(table).collect())
    assert got == plain_chains(rows)


def test_a_hundred_thousand_alignments_of_one_hit(spark):
    n = 100_000
    table = spark.range(n).select(F.lit("q").alias("query_id"), F.lit("h").alias("hit_id"), F.lit(1).alias("strand"), F.lit(1).cast("long").alias("query_len"), (F.xxhash64("id") % 1000).alias("bit_score"), *((F.col("id") * step + plus).alias(c) for c, step, plus in (("q_start", 40, 1), ("q_end", 40, 30), ("h_start", 90, 1), ("h_end", 90, 30))), F.lit(30).cast("long").alias("align_len"), F.lit(29).cast("long").alias("n_identical"))
    rows = T.chain_hsps(table).collect()
    assert [(r.q_start, r.q_end, r.h_start, r.h_end, r.n_hsps) for r in rows] == [(1, 40 * n - 10, 1, 90 * n - 60, n)]


def test_a_cluster_of_many_windows(spark):
    """4,000 windows of one cluster, against a plain pass over neighbours."""
    import numpy as np

    rng, n = np.random.default_rng(5), 4000
    inner = np.sort(rng.integers(1, 400_000, n))
    outer = inner + rng.integers(20, 900, n)
    low, high = inner - rng.integers(0, 500, n), outer + rng.integers(0, 500, n)
    rows = [(f"w{i:05d}", int(low[i]), int(high[i]), int(inner[i]), int(outer[i])) for i in range(n)]
    rows.append(("whole", 1, 500_000, 400_500, 400_600))
    table = spark.createDataFrame([("c", *r) for r in rows], "seq_id string, window_id string, start_pos long, end_pos long, g_start long, g_end long")
    got = {tuple(r) for r in T.dedupe_windows(table).collect()}

    class Row:
        def __init__(self, r):
            self.seq_id, (self.window_id, self.start_pos, self.end_pos, self.g_start, self.g_end) = "c", r

    assert got == brute_windows([Row(r) for r in rows])

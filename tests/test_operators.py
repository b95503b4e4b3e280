"""Operators against naive versions and worked examples."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strandweave.functions import sequence as S
from strandweave.operators import intervals as I
from strandweave.operators import models as G
from strandweave.operators import transcripts as T
from strandweave.operators.masking import extract_subseq, mask_tiles, to_tiles


def spans(spark, rows):
    return spark.createDataFrame([("c", i, a, b) for i, (a, b) in enumerate(rows)], "seq_id string, id long, start_pos long, end_pos long")


@pytest.mark.parametrize(("given", "wanted"), [([(1, 108), (109, 200)], [(1, 200)]), ([(1, 108), (100, 150)], [(1, 150)]), ([(1, 108), (500, 700)], [(1, 108), (500, 700)]), ([(1, 1000), (50, 625)], [(1, 1000)])])
def test_merge(spark, given, wanted):
    assert sorted((r.start_pos, r.end_pos) for r in I.merge_intervals(spans(spark, given), ["seq_id"]).collect()) == wanted


def test_clusters_need_a_shared_base(spark):
    count = lambda rows: I.cluster_intervals(spans(spark, rows), ["seq_id"]).select("cluster_start").distinct().count()
    assert count([(1, 108), (109, 200)]) == 2
    assert count([(1, 108), (108, 200)]) == 1


def test_islands_cross_tiles(spark):
    rng = random.Random(3)
    rows = [(a, a + rng.randrange(60)) for a in (rng.randrange(1, 4000) for _ in range(300))]
    rows += rows[:150]
    assert I.islands(spans(spark, rows), ["seq_id"], 1, 64).where("island_start is null or island_start > start_pos").count() == 0
    small, whole = (sorted((r.id, r.island_start) for r in I.islands(spans(spark, rows), ["seq_id"], 1, tile).collect()) for tile in (64, 1 << 20))
    assert small == whole


@pytest.mark.parametrize("strict", [True, False])
def test_overlap_join_is_the_theta_join(spark, strict):
    rng = random.Random(strict)
    a, b = ([(s, s + rng.randrange(90)) for s in (rng.randrange(1, 900) for _ in range(80))] for _ in range(2))
    got = sorted((r.id, r.r_id) for r in I.overlap_join(spans(spark, a), spans(spark, b), ["seq_id"], strict, 32).collect())
    hit = (lambda x, y: x[0] < y[1] and x[1] > y[0]) if strict else (lambda x, y: x[0] <= y[1] and x[1] >= y[0])
    assert got == sorted((i, j) for i, x in enumerate(a) for j, y in enumerate(b) if hit(x, y))
    semi = I.overlap_join(spans(spark, a), spans(spark, b), ["seq_id"], strict, 32, "left_semi")
    assert sorted(r.id for r in semi.collect()) == sorted({i for i, _ in got})


def test_band_join(spark):
    rng = random.Random(9)
    a, b = ([(s, s) for s in (rng.randrange(1, 600) for _ in range(60))] for _ in range(2))
    got = sorted((r.id, r.r_id) for r in I.band_join(spans(spark, a), spans(spark, b), ["seq_id"], "start_pos", 21, 3).collect())
    assert got == sorted((i, j) for i, x in enumerate(a) for j, y in enumerate(b) if abs(x[0] - y[0]) <= 21 and (x[0] - y[0]) % 3 == 0)


@pytest.mark.parametrize(("length", "wanted"), [(250, [(1, 100), (81, 180), (161, 250)]), (180, [(1, 100), (81, 180), (161, 180)]), (100, [(1, 100)])])
def test_chunks(spark, length, wanted):
    rows = I.tiles_of(spark.createDataFrame([("s", length)], "seq_id string, length long"), 100, 20).orderBy("chunk_no")
    assert [(r.chunk_start, r.chunk_end) for r in rows.collect()] == wanted


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_sequence_functions(spark):
    assert value(spark, S.revcomp(S.revcomp(F.lit("ACGTTGCAN")))) == "ACGTTGCAN"
    assert value(spark, S.translate_codons(F.lit("atgGCCTAANNNAC"), "X")) == "MA*XX"
    assert value(spark, S.translate_codons(F.lit("AC"))) == "" and value(spark, S.translate_codons(F.lit(""))) == ""
    with pytest.raises(Exception, match="multiple of 3"):
        value(spark, S.translate_codons(F.lit("ACGT"), "fail"))
    assert [value(spark, S.orf_status(F.lit(p))) for p in ("MA*", "A*", "MA", "A")] == ["complete", "5'partial", "3'partial", "5'3'partial"]


def test_scores(spark):
    rows = spark.createDataFrame([(80, 90, 50, 3, 3, False, False, 1), (80, 70, 50, 3, 3, False, False, 1)], "hit_coverage int, query_coverage int, identity int, n_valid int, n_sites int, partially_sequenced boolean, wrong_splice boolean, file_level int")
    assert [r.score for r in G.score(rows).collect()] == [600.0, 410.0]


def test_selection_marks_only_what_the_winner_overlaps(spark):
    # The seed d loses to a, which overlaps b too; c overlaps b alone and stays in the race.
    rows = [("s", "a", 0, 100, 200, 10.0, 5.0), ("s", "b", 0, 150, 300, 20.0, 50.0), ("s", "c", 0, 290, 400, 90.0, 1.0), ("s", "d", 0, 50, 120, 1.0, 2.0)]
    models = spark.createDataFrame(rows, "seq_id string, model_id string, file_level int, start_pos long, end_pos long, hit_coverage double, score double")
    assert sorted(r.model_id for r in G.select_models(models).collect()) == ["a", "c"]
    again = sorted(r.model_id for r in G.select_models(models.repartition(3)).collect())
    assert again == sorted(r.model_id for r in G.select_models(models).collect())


def test_subsequences_and_masks_cross_tiles(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("ACGT") for _ in range(300))
    tiles = to_tiles(spark.createDataFrame([("c", text)], "seq_id string, residues string"), 64)
    rows = [(1, 300), (60, 70), (64, 64), (65, 129), (290, 300)]
    got = {(r.start_pos, r.end_pos): r.part for r in extract_subseq(spans(spark, rows), tiles, ["id"], 64).collect()}
    assert got == {(a, b): text[a - 1 : b] for a, b in rows}
    masked = "".join(r.residues for r in mask_tiles(tiles, spans(spark, rows[1:4]), "letter", "N", 64).orderBy("tile_no").collect())
    assert masked == text[:59] + "N" * 70 + text[129:]


def test_transcript_clusters_are_transitive(spark):
    exons = spark.createDataFrame([("c", 1, "a", 1, 10), ("c", 1, "b", 10, 20), ("c", 1, "d", 20, 30), ("c", 1, "e", 40, 50), ("c", -1, "f", 1, 50)], "seq_id string, strand int, parent_id string, start_pos long, end_pos long")
    assert {r.parent_id: r.cluster for r in T.cluster_transcripts(exons).collect()} == {"a": "a", "b": "a", "d": "a", "e": "e", "f": "f"}


def test_covered_windows_go_and_others_are_trimmed(spark):
    rows = spark.createDataFrame([("c", "big", 1, 100, 5, 50), ("c", "in", 10, 95, 20, 60), ("c", "half", 80, 130, 90, 120)], "seq_id string, window_id string, start_pos long, end_pos long, g_start long, g_end long")
    # The windows "big" and "in" share 86 bases, all of "in"; "half" begins behind both alignments.
    assert sorted(tuple(r)[1:] for r in T.dedupe_windows(rows).collect()) == [("big", 1, 89), ("half", 61, 130)]


def test_chains(spark):
    columns = "query_id string, hit_id string, strand int, query_len long, q_start long, q_end long, h_start long, h_end long, align_len long, n_identical long, bit_score long"
    rows = [("q", "h", 1, 100, 1, 40, 1001, 1040, 40, 40, 50), ("q", "h", 1, 100, 41, 100, 2001, 2060, 60, 60, 90), ("q", "h", 1, 100, 41, 100, 90_001, 90_060, 60, 60, 10)]
    got = T.chain_hsps(spark.createDataFrame(rows, columns)).collect()
    assert [(r.q_start, r.q_end, r.h_start, r.h_end, r.n_hsps, r.coverage) for r in got] == [(1, 100, 1001, 2060, 2, 1.0)]


def test_chains_on_the_minus_strand(spark):
    columns = "query_id string, hit_id string, strand int, query_len long, q_start long, q_end long, h_start long, h_end long, align_len long, n_identical long, bit_score long"
    rows = [("q", "h", -1, 100, 1, 40, 2001, 2040, 40, 40, 50), ("q", "h", -1, 100, 41, 100, 1001, 1060, 60, 60, 90), ("q", "h", -1, 100, 41, 100, 3001, 3060, 60, 60, 10)]
    got = T.chain_hsps(spark.createDataFrame(rows, columns)).collect()
    assert [(r.q_start, r.q_end, r.h_start, r.h_end, r.n_hsps, r.coverage) for r in got] == [(1, 100, 1001, 2040, 2, 1.0)]


def scaled(rng, n, longest):
    starts = [rng.randrange(1, 3_000_000) for _ in range(n)]
    return [(a, a + int(10 ** (rng.random() * longest))) for a in starts]


@pytest.mark.parametrize(("ours", "theirs"), [(2, 2), (2, 6.5), (6.5, 2), (6.5, 6.5)])
@pytest.mark.parametrize("strict", [True, False])
def test_range_join_of_all_lengths(spark, ours, theirs, strict):
    rng = random.Random(11)
    left, right = scaled(rng, 150, ours), scaled(rng, 150, theirs)
    meets = (lambda a, b: a[0] < b[1] and a[1] > b[0]) if strict else (lambda a, b: a[0] <= b[1] and a[1] >= b[0])
    want = sorted((i, j) for i, a in enumerate(left) for j, b in enumerate(right) if meets(a, b))
    l, r = spans(spark, left), spans(spark, right)
    assert sorted((x.id, x.r_id) for x in I.overlap_join(l, r, ["seq_id"], strict, 100).collect()) == want
    assert sorted(x.id for x in I.overlap_join(l, r, ["seq_id"], strict, 100, "left_semi").collect()) == sorted({i for i, _ in want})
    assert I.overlap_join(l, r.limit(0), ["seq_id"]).collect() == []


def test_a_long_feature_makes_few_rows(spark):
    long = spans(spark, [(1, 100_000_000), (5, 9), (7, 160_000), (9, 160_009)])
    n = {r.id: r.n for r in I._dealt(long, I.BIN, [0, 1, 2, 3, 4], [0, 1, 2, 3, 4]).groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert n[0] < 50 and n[1] == 5 and n[2] == 17 + 5 and max(n.values()) < 50


def test_numbers_and_latest_values_cross_stretches(spark):
    rng = random.Random(12)
    rows = [(rng.choice("ab"), rng.randrange(1, 500), i, rng.choice([None, None, f"v{i}"])) for i in range(300)]
    table = spark.createDataFrame(rows, "seq_id string, start_pos long, id long, v string")
    got = {r.id: (r.number, r.last) for r in I.latest(I.numbered(table, ["seq_id"], ["start_pos", "id"], place=F.col("start_pos"), width=7), ["seq_id"], F.col("v"), ["start_pos", "id"], F.floor(F.col("start_pos") / 16), "last").collect()}
    for name in "ab":
        last = None
        for k, (_, _, i, v) in enumerate(sorted((r for r in rows if r[0] == name), key=lambda r: (r[1], r[2])), 1):
            last = v or last
            assert got[i] == (k, last)


def test_longest_gap(spark):
    lengths = spark.createDataFrame([("a", 100), ("b", 50), ("c", 9)], "seq_id string, length long")
    merged = spark.createDataFrame([("a", 11, 20), ("a", 61, 70), ("b", 40, 45), ("z", 1, 2)], "seq_id string, start_pos long, end_pos long")
    assert {tuple(r) for r in I.longest_gap(merged, lengths, ["seq_id"]).collect()} == {("a", 40), ("b", 39), ("c", 9)}


def _random_spans(r, n, longest=40, upto=300):
    return [(a, a + r.choice((0, 1, r.randint(0, longest)))) for a in (r.randint(1, upto) for _ in range(n))]


@pytest.mark.parametrize("seed", range(3))
def test_overlaps_counted_by_ranks(spark, seed):
    r = random.Random(seed)
    table = lambda n: [(r.choice("cd"), i % 5, *s) for i, s in enumerate(_random_spans(r, n))] + [("c", 6, None, 9), (None, 6, 1, 9)]
    left, right = table(60), table(80)
    frame = lambda rows: spark.createDataFrame(rows, "seq_id string, id int, start_pos long, end_pos long")
    want = {}
    for seq, i, a, b in left[:-2]:
        want[seq, i] = want.get((seq, i), 0) + sum(q == seq and a < y and b > x for q, _, x, y in right[:-2])
    got = I.overlap_counts(frame(left), frame(right), ["seq_id"], ["id"], 16).collect()
    assert len(got) == len(want) and {(x.seq_id, x.id): x.n_overlaps for x in got} == want
    assert {x.n_overlaps for x in I.overlap_counts(frame(left), frame(right[:0]), ["seq_id"], ["id"]).collect()} == {0}
    assert I.overlap_counts(frame(left[:0]), frame(right), ["seq_id"], ["id"]).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_evidence_summary_counts_what_pairs_would(spark, seed):
    r = random.Random(seed)
    exons = [("c", r.choice((1, -1)) if seed == 3 else 1 - 2 * (i % 2), f"m{i % 8}", *s) for i, s in enumerate(_random_spans(r, 50, 60))]
    exons += [("c", 1, None, 5, 50), ("c", 1, "m0", None, 7)]  # An exon without a model, one without a start.
    # Most evidence has one row, some several; ids, categories and databases may be missing; some rows are there twice.
    ids = lambda i: r.choice((f"v{i}", f"v{i}", f"v{i % 9}", None))
    evidence = [("c", r.choice((1, -1)), ids(i), r.choice(("p", "q", None)), r.choice(("db1", "db2", None)), *s) for i, s in enumerate(_random_spans(r, 70, 120))]
    evidence += evidence[:5] + [("c", 1, "w", "p", "db1", 3, None), ("c", None, "w", "p", "db9", 1, 900)]
    ours = spark.createDataFrame(exons, "seq_id string, strand int, parent_id string, start_pos long, end_pos long")
    theirs = spark.createDataFrame(evidence, "seq_id string, strand int, evidence_id string, category string, db string, start_pos long, end_pos long")
    found = {}
    for q, s, m, a, b in exons:
        for w, t, i, c, d, x, y in evidence:
            if None not in (m, a, b, x, y, t) and (q, s) == (w, t) and a < y and b > x:
                found.setdefault(m, []).append((i, (c, d)))
    want = {m: (len({i for i, _ in f} - {None}), len({s for _, s in f})) for m, f in found.items()}
    assert {x.parent_id: (x.n_features, x.n_sources) for x in G.evidence_summary(ours, theirs).collect()} == want
    seen = {m for m, f in found.items() if any(d == "db1" for _, (_, d) in f)}
    assert {x.parent_id: x.expressed for x in G.expressed(ours, theirs, ["db1"]).collect() if x.parent_id} == {m: m in seen for m in {e[2] for e in exons} - {None}}


def test_features_meet_their_chunks_by_number(spark):
    from strandweave.operators.stitching import in_chunks

    rng = random.Random(6)
    rows = [(a, a + rng.choice([5, 40, 99, 100, 140])) for a in (rng.randrange(1, 900) for _ in range(200))] + [(1, 100), (81, 180), (901, 950)]
    features = spans(spark, rows)
    chunks = I.tiles_of(spark.createDataFrame([("c", 950)], "seq_id string, length long"), 100, 20)
    want = features.join(chunks, "seq_id").where("start_pos >= chunk_start and end_pos <= chunk_end").select("id", "chunk_no", "chunk_start", "chunk_end")
    got = in_chunks(features, chunks, 100, 20).select("id", "chunk_no", "chunk_start", "chunk_end")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_an_intron_may_be_an_inner_exon_of_the_transcript(spark):
    exons = lambda name, *parts: [("c", name, 1, a, b) for a, b in parts]
    schema = "seq_id string, parent_id string, file_order long, start_pos long, end_pos long"
    chains = T.junction_chains(spark.createDataFrame(exons("t", (1, 100), (500, 600), (900, 990)) + exons("u", (1, 100), (500, 700)), schema), ["seq_id", "parent_id"])
    models = spark.createDataFrame(exons("m", (450, 500), (600, 650)) + exons("k", (20, 100), (500, 520)), schema).withColumnRenamed("parent_id", "model_id")
    found = T.contained_chains(chains, T.junction_chains(models, ["seq_id", "model_id", "file_order"]))
    assert sorted((r.parent_id, r.model_id) for r in found.collect()) == [("t", "k"), ("t", "m"), ("u", "k")]


def test_repairs_look_at_few_codons_of_a_model(spark):
    rng = random.Random(5)
    residues = "".join(rng.choice("ACGT") for _ in range(3000))
    seqs = spark.createDataFrame([("c", residues)], "seq_id string, residues string")
    parts = spark.createDataFrame([("c", f"m{i}", 1, 700 + i, 700 + i + 5 * i) for i in range(60)], "seq_id string, parent_id string, strand int, start_pos long, end_pos long")
    found = G.repair_start_stop(parts, to_tiles(seqs, 512), spark.createDataFrame([("c", 3000)], "seq_id string, length long"), width=512)
    assert "transform(sequence" not in found._jdf.queryExecution().analyzed().toString().replace("lambdafunction", "")
    for r in found.collect():
        i = int(r.parent_id[1:])
        low, high = 700 + i, 700 + 6 * i
        codon = lambda at: residues[at - 1 : at + 2]
        whole = (high - low + 1) // 3
        if not (whole and codon(low + 3 * whole - 3) in ("TAA", "TAG", "TGA")):
            stops = [k for k in range(1, 201) if codon(high + 1 + 3 * (k - 1)) in ("TAA", "TAG", "TGA")]
            assert r.stop_shift == (3 * stops[0] if stops else None)

"""Steps that once did the same work several times, held together in one."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from strandweave.functions.sequence import translate_codons
from strandweave.operators import intervals as I
from strandweave.operators import models as G
from strandweave.operators import transcripts as T
from strandweave.operators.masking import coding_sequences, pieces, to_tiles


def test_extension_reads_texts_once_for_all_modes(spark):
    n = 60
    seqs = spark.createDataFrame([("s", "CCATGATGCCCNAAATTTCATGGGCCCTAACCATTTAGGGATGCCCATTAACCGGTTACC")], "seq_id string, residues string")
    lengths = seqs.select("seq_id", F.length("residues").cast("long").alias("length"))
    rows = [("s", "a", 1, "five_prime_UTR", 13, 15), ("s", "a", 1, "polypeptide", 16, 27), ("s", "b", -1, "polypeptide", 31, 45), ("s", "b", -1, "three_prime_UTR", 28, 30), ("s", "out", 1, "polypeptide", n + 40, n + 60)]
    parts = spark.createDataFrame(rows, "seq_id string, parent_id string, strand int, type string, start_pos long, end_pos long")
    tiles = to_tiles(seqs, 16, 2)
    together = T.extend_cds(parts, tiles, lengths, 9, (0, 1, 2), width=16)
    got = {tuple(r) for r in together.select("mode", "parent_id", "strand", "type", "start_pos", "end_pos").collect()}
    alone = {(m, *tuple(r)) for m in (0, 1, 2) for r in T.extend_cds(parts, tiles, lengths, 9, m, width=16).drop("seq_id").collect()}
    assert got == alone and {r[1] for r in got} == {"a", "b"}


@pytest.mark.parametrize("text", ["atgGCCTAANNNAC", "", "AC", "ACGTTé" * 3, "ACG\nTTACC\rGATT", "AC\U0001f600TTA", None])
def test_translation_by_batches(spark, text):
    rows = spark.createDataFrame([(0, "ATG"), (1, text), (2, "TAAACGTGC"), (3, None)], "k int, s string").coalesce(1)
    got = {r.k: r.p for r in rows.select("k", translate_codons("s").alias("p")).collect()}
    known = {"atgGCCTAANNNAC": "MA*X", "": "", "AC": "", "ACGTTé" * 3: "TX" * 3, "ACG\nTTACC\rGATT": "TLD", "AC\U0001f600TTA": "XL", None: None}
    assert got == {0: "M", 1: known[text], 2: "*TC", 3: None}


def test_one_plan_reads_each_text_once(spark):
    seqs = spark.createDataFrame([("s", "CCATGATGCCCNAAATTTCATGGGCCC")], "seq_id string, residues string")
    parts = spark.createDataFrame([("s", "a", 1, 3, 20), ("s", "a", 1, 3, 20), ("s", "a", 1, 23, 27), ("s", "z", 1, 90, 99)], "seq_id string, parent_id string, strand int, start_pos long, end_pos long")
    tiles = to_tiles(seqs, 8)
    assert [(r.parent_id, r.coding) for r in coding_sequences(parts, tiles, width=8).collect()] == [("a", "ATGATGCCCNAAATTTCAGGCCC")]
    assert [tuple(pieces(parts.limit(0), tiles, 8).columns)] == [("seq_id", "parent_id", "strand", "start_pos", "end_pos", "tile_no", "piece")]


def test_named_files_are_written_by_several_tasks(spark, tmp_path):
    from strandweave.plans.source_queries import named_files
    from strandweave.sources.reports import read_named_set

    rows = spark.range(40).repartition(4).select(F.when(F.col("id") % 2 == 0, "1_TOOLA_some_db.gff").otherwise("12_TOOLB_other.db.gff").alias("name"), F.concat_ws("\t", F.lit("c"), F.lit("T"), F.lit("exon"), F.col("id").cast("string"), F.lit("99"), F.lit("."), F.lit("+"), F.lit("."), F.lit("ID=x")).alias("value"))
    named_files(rows, str(tmp_path / "set"))
    assert len(list((tmp_path / "set").glob("*/*.gff"))) > 2
    got = read_named_set(spark, f"{tmp_path}/set/*/*.gff").select("step", "tool", "db", "start_pos").collect()
    assert sorted(tuple(r) for r in got) == sorted((1, "TOOLA", "some_db", i) if i % 2 == 0 else (12, "TOOLB", "other.db", i) for i in range(40))


def test_frames_of_hits_read_tiles_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    seqs = spark.createDataFrame([(str(k), "ATGAAATAACCC") for k in range(6)], "seq_id string, residues string")
    tiles = to_tiles(seqs, 8, 2)
    tiles = tiles.mapInArrow(counted, tiles.schema)
    lengths = seqs.select("seq_id", F.length("residues").cast("long").alias("length"))
    hits = spark.createDataFrame([("3", 1, 4), ("3", 1, 4), ("none", 1, 4)], "seq_id string, strand int, h_start long")
    assert [tuple(r) for r in T.orfs_from_hits(tiles, lengths, hits, 8).collect()] == [("3", 1, 4, 1, 9, "MK*")]
    assert reads.value == 12


@pytest.mark.parametrize("seed", range(2))
def test_evidence_is_paired_or_ranked_alike(spark, monkeypatch, seed):
    r = random.Random(seed)
    spans = lambda n, longest: [(a, a + r.randint(0, longest)) for a in (r.randint(1, 300) for _ in range(n))]
    exons = [("c", 1, f"m{i % 8}" if i else None, *x) for i, x in enumerate(spans(50, 60))]
    evidence = [("c", 1, r.choice((f"v{i}", f"v{i % 9}", None)), r.choice(("p", None)), r.choice(("db1", "db2", None)), *x) for i, x in enumerate(spans(60, 120))]
    ours = spark.createDataFrame(exons, "seq_id string, strand int, parent_id string, start_pos long, end_pos long")
    theirs = spark.createDataFrame(evidence, "seq_id string, strand int, evidence_id string, category string, db string, start_pos long, end_pos long")
    asked, ranks = [], G._ranked_summary
    monkeypatch.setattr(G, "_ranked_summary", lambda *x: asked.append(1) or ranks(*x))
    paired = G.evidence_summary(ours, theirs, crowded=1e9)
    assert not asked
    ranked = G.evidence_summary(ours, theirs, crowded=0)
    assert asked
    assert {tuple(x) for x in paired.collect()} == {tuple(x) for x in ranked.collect()} != set()
    assert paired.dtypes == ranked.dtypes


def test_comparisons_of_a_range_join(spark):
    rows = spark.createDataFrame([("c", 1, 5), ("c", 7, 9), ("c", 25_000, 25_001), ("d", 1, 2)], "seq_id string, start_pos long, end_pos long")
    assert I.comparisons(rows, rows, ["seq_id"]) == 6 and I.comparisons(rows, rows.limit(0), ["seq_id"]) == 0


def test_derived_rows_and_genes_are_dealt_by_the_number_of_lines(spark, monkeypatch):
    from strandweave.plans import QUERIES, fixtures

    data = "/root/testdata/sf0.001"
    plain = {tuple(r) for r in QUERIES["a15_exons_to_genes"](spark, data).collect()}
    monkeypatch.setattr(fixtures, "ROWS", 500)
    most = lambda df: df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    for name in ("fx_exons", "fx_cds", "fx_evidence"):
        assert most(fixtures.table(spark, data, name)) < 800
    rows = QUERIES["a15_exons_to_genes"](spark, data)
    assert {tuple(r) for r in rows.collect()} == plain
    assert most(rows.where("type = 'gene'")) < 300 and most(rows.where("type = 'exon'")) < 800


def test_alignments_of_a_crowded_hit_are_looked_up_in_few_steps(monkeypatch):
    """Alignments that begin together on the query and lie beside each other on the subject: none may follow another."""
    steps, last = [], T._Slab._last
    monkeypatch.setattr(T._Slab, "_last", lambda *x: steps.append(1) or last(*x))
    n = 3000
    facing = T._Facing([1] * n, list(range(50, 50 + n)), list(range(0, 30 * n, 30)), 10, 10_000)
    assert all(facing.nearest(k % 60, 20_000, 90_000) is None for k in (0, 1)) and len(steps) < 10
    assert facing.nearest(55, 20_000, 120) == 3
    for k in (3, 2, 1, 0):
        assert facing.nearest(55, 20_000, 120) == k
        facing.drop(k)
    assert facing.nearest(55, 20_000, 120) is None and len(steps) < 60


@pytest.mark.parametrize("few", [0, 3, 8])
def test_nearest_alignment_is_the_least_of_all(monkeypatch, few):
    monkeypatch.setattr(T._Facing, "FEW", few)
    r = random.Random(few)
    for _ in range(60):
        n, wide, t_gap, g_gap = r.randint(1, 60), r.choice((20, 200)), r.choice((-3, 1, 10)), r.choice((1, 2, 30, 1000))
        rows = [(a, a + r.randint(-2, 30), r.randint(-wide, wide)) for a in (r.randint(0, 60) for _ in range(n))]
        rows[0] = (float("nan"), *rows[0][1:])
        facing, free = T._Facing(*(list(x) for x in zip(*rows, strict=True)), t_gap, g_gap), set(range(n))
        for _ in range(2 * n):
            q0, q1, a0 = r.randint(0, 80), r.randint(0, 120), r.randint(-wide, 2 * wide)
            fits = [(abs(q0 - e), a0 - y, k) for k, (s, e, y) in enumerate(rows) if k in free and s < q0 and e < q1 and q0 - e > -t_gap and 0 < a0 - y < g_gap]
            found = facing.nearest(q0, q1, a0)
            assert found == (min(fits)[2] if fits else None)
            if found is not None and r.random() < 0.7:
                free.discard(found)
                facing.drop(found)


@pytest.mark.parametrize("near", [0, 3, 1000])
def test_windows_of_a_cluster_meet_their_neighbours_only(monkeypatch, near):
    from types import SimpleNamespace

    import numpy as np

    from tests.test_folds import brute_windows

    monkeypatch.setattr(T, "NEAR", near)
    monkeypatch.setattr(T, "BLOCK", 7)
    r = random.Random(near)
    for _ in range(40):
        wide = r.choice((30, 300, 3000))
        rows = sorted((a, a + r.randint(0, 40)) for a in (r.randint(1, wide) for _ in range(60)))
        # The first window spans them all, so that they are one cluster.
        windows = [SimpleNamespace(seq_id="c", window_id=k, g_start=a, g_end=b, start_pos=a - r.randint(0, 30) if k else -99, end_pos=b + r.randint(0, 30) if k else 4000) for k, (a, b) in enumerate(rows)]
        kept, bounds = T._kept_windows({c: np.array([getattr(w, c) for w in windows]) for c in ("start_pos", "end_pos", "g_start", "g_end")}, 0.9)
        assert {("c", k, int(a), int(b)) for k, a, b in zip(kept, bounds["start_pos"], bounds["end_pos"], strict=True)} == brute_windows(windows)


def test_clusters_read_their_exons_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = [("c", 1, "b", 1, 10), ("c", 1, "a", 10, 20), ("c", 1, "a", 40, 50), ("c", 1, "d", 50, 60), ("c", -1, "e", 1, 99), ("c", None, "f", 1, 99), (None, 1, "g", 1, 99), ("c", 1, None, 5, 6)]
    exons = spark.createDataFrame(rows, "seq_id string, strand int, parent_id string, start_pos long, end_pos long")
    found = T.cluster_transcripts(exons.mapInArrow(counted, exons.schema)).collect()
    assert {tuple(r) for r in found} == {("b", "a"), ("a", "a"), ("d", "a"), ("e", "e"), ("f", "f"), ("g", "g"), (None, None)}
    assert reads.value == len(rows)


def test_repairs_ask_for_few_bases_and_once(spark, monkeypatch):
    rng, asked = random.Random(7), []
    residues = "".join(rng.choice("ACGT") for _ in range(9000))
    tiles = to_tiles(spark.createDataFrame([("c", residues)], "seq_id string, residues string"), 512)
    lengths = spark.createDataFrame([("c", 9000)], "seq_id string, length long")
    parts = spark.createDataFrame([("c", f"m{i}", 1 - 2 * (i % 2), a, b) for i in range(40) for a, b in ((1000, 1099), (8000, 8100))], "seq_id string, parent_id string, strand int, start_pos long, end_pos long")
    monkeypatch.setattr(G, "pieces", lambda features, *rest: asked.append(features) or pieces(features, *rest))
    found = G.repair_start_stop(parts, tiles, lengths, width=512).collect()
    assert len(found) == 40 and len({tuple(r)[1:] for r in found}) == 2
    # A codon at either end and a search from it, on both strands, not 40 genes of 7101 bases.
    bases = sum(f.agg(F.sum(F.col("end_pos") - F.col("start_pos") + 1)).first()[0] for f in asked)
    assert 2000 < bases < 2 * (6 + 2 * 620)


@pytest.mark.parametrize("strand", [1, -1])
def test_repairs_know_codons_of_several_parts(spark, strand):
    rng = random.Random(8)
    residues = "".join(rng.choice("ACGT") for _ in range(400))
    models = {}
    for i in range(150):
        at, models[f"m{i}"] = rng.randrange(1, 380), []
        for _ in range(rng.randrange(1, 6)):
            at, end = at + rng.randrange(1, 9), at + rng.randrange(0, 9)
            models[f"m{i}"].append((min(at, end), max(at, end)))
            at = max(at, end)
    rows = [("c", m, strand, a, b) for m, spans in models.items() for a, b in spans]
    tiles = to_tiles(spark.createDataFrame([("c", residues)], "seq_id string, residues string"), 16)
    parts = spark.createDataFrame(rows, "seq_id string, parent_id string, strand int, start_pos long, end_pos long")
    found = G.repair_start_stop(parts, tiles, spark.createDataFrame([("c", 400)], "seq_id string, length long"), reach=90, width=16).collect()
    shifts = {r.parent_id: (r.start_shift, r.stop_shift) for r in found}
    turn = str.maketrans("ACGT", "TGCA")
    for m, spans in models.items():
        coding = "".join(residues[a - 1 : b] for a, b in sorted(set(spans)))
        coding = coding[::-1].translate(turn) if strand == -1 else coding
        assert (m in shifts) == bool(coding)
        whole = len(coding) // 3 * 3
        if coding[:3] == "ATG":
            assert shifts[m][0] is None
        if whole and coding[whole - 3 : whole] in ("TAA", "TAG", "TGA"):
            assert shifts[m][1] is None
        elif coding:
            axis, end = (residues, max(b for _, b in spans)) if strand == 1 else (residues[::-1].translate(turn), 401 - min(a for a, _ in spans))
            stops = [k for k in range(3, 91, 3) if axis[end + k - 3 : end + k] in ("TAA", "TAG", "TGA")]
            assert shifts[m][1] == (stops[0] if stops else None)


def test_rescue_reads_parts_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(len(batch))
            yield batch

    rows = [("c", "t", 1, "exon", 1, 100), ("c", "t", 1, "exon", 101, 150), ("c", "t", 1, "exon", 140, 145), ("c", "t", 1, "exon", 300, 400), ("c", "u", -1, "polypeptide", 5, 9), ("c", "u", -1, "polypeptide", 5, 9), ("c", "v", -1, "exon", 10, 90), ("c", "w", 1, "exon", 1, 9)]
    schema = "seq_id string, parent_id string, strand int, type string, start_pos long, end_pos long"
    parts = spark.createDataFrame(rows, schema).coalesce(1).mapInPandas(counted, schema)
    rescued = spark.createDataFrame([("t", "m"), ("v", "k"), ("w", "none")], "parent_id string, model_id string")
    model_parts = spark.createDataFrame([("m", 50, 120), ("m", 310, 350), ("k", 20, 30)], "model_id string, start_pos long, end_pos long")
    got = sorted(tuple(r)[1:] for r in T.take_over_cds(parts, rescued, model_parts).collect())
    want = [("t", 1, "five_prime_UTR", 1, 49, "m"), ("t", 1, "polypeptide", 50, 150, "m"), ("t", 1, "polypeptide", 300, 350, "m"), ("t", 1, "three_prime_UTR", 351, 400, "m")]
    want += [("u", -1, "polypeptide", 5, 9, None)] * 2 + [("v", -1, "five_prime_UTR", 31, 90, "k"), ("v", -1, "polypeptide", 20, 30, "k"), ("v", -1, "three_prime_UTR", 10, 19, "k")]
    assert got == want and reads.value == len(rows)


def test_chains_are_searched_behind_their_first_junction(spark):
    rng = random.Random(9)
    schema, rows = "seq_id string, parent_id string, start_pos long, end_pos long", []
    for i in range(60):
        at = rng.randrange(1, 6)
        for _ in range(rng.randrange(1, 7)):
            rows.append(("c", f"t{i}", at, at + rng.randrange(0, 3)))
            at += rng.randrange(0, 5)
    exons = spark.createDataFrame(rows, schema)
    chains, models = T.junction_chains(exons, ["seq_id", "parent_id"]), T.junction_chains(exons.withColumn("file_order", F.lit(1).cast("long")).withColumnRenamed("parent_id", "model_id"), ["seq_id", "model_id", "file_order"])
    plain = {}
    for name in {r[1] for r in rows}:
        own = sorted(r[2:] for r in rows if r[1] == name)
        links = sorted((a, f"{b}_{c}") for (a, b), (c, _) in zip(own, own[1:]))
        if links:
            plain[name] = f"_{'_'.join(text for _, text in links)}_"
    got = sorted(tuple(r) for r in T.contained_chains(chains, models).select("parent_id", "model_id").collect())
    assert got == sorted((t, m) for t, chain in plain.items() for m, wanted in plain.items() if wanted in chain)

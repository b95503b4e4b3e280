"""K-mer counts and reading frames on tiles against plain versions."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandweave.operators import frames, kmers
from strandweave.operators import intervals as I
from strandweave.operators import masking as M
from strandweave.operators import transcripts as T
from strandweave.operators.masking import to_tiles

COMPLEMENT = str.maketrans("ACGTacgt", "TGCAtgca")


def sequences(seed: int) -> dict[str, str]:
    rng = random.Random(seed)
    dna = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    found = {f"s{i}": dna(rng.choice([0, 1, 2, 5, 30, 400])) for i in range(20)}
    # One letter for long, unknown bases, lower case, letters for several bases, a repeat, open frames, many ATGs.
    found |= {"poly": dna(50) + "A" * 900 + dna(50), "unknown": dna(40) + "N" * 70 + dna(40), "lower": dna(60).lower() + dna(60), "odd": "ACRYACGT" * 9, "repeat": dna(37) * 12, "open": "GCC" * 150, "starts": "ATG" * 40 + "TAA" + "CAT" * 40}
    return found


def seq_table(spark, seqs):
    return spark.createDataFrame(list(seqs.items()), "seq_id string, residues string").repartition(3)


def brute_kmers(seqs, k, strand):
    mers = [(s, i, x[i : i + k]) for s, x in seqs.items() for i in range(len(x) - k + 1)]
    n = Counter(m for _, _, m in mers)
    out = [(s, i, "+", m, n[m]) for s, i, m in mers] if "f" in strand else []
    if "p" in strand:
        out += [(s, i, "-", r, n[r]) for s, i, m in mers if n[r := m.translate(COMPLEMENT)[::-1]]]
    return sorted(out)


@pytest.mark.parametrize(("k", "strand", "width"), [(6, "fp", 64), (17, "f", 50), (17, "p", 1000), (1, "fp", 16), (31, "fp", 100)])
def test_kmers_equal_a_count_of_all(spark, k, strand, width):
    seqs = sequences(k)
    got = kmers.kmer_counts(to_tiles(seq_table(spark, seqs), width, k - 1), k, strand).collect()
    assert sorted(map(tuple, got)) == brute_kmers(seqs, k, strand)


@pytest.mark.parametrize("hot", [0.0, 1e9])
def test_hot_minimizers_are_counted_by_rows_alike(spark, monkeypatch, hot):
    monkeypatch.setattr(kmers, "HOT", hot)
    monkeypatch.setattr(kmers, "CHUNK", 100)
    seqs = sequences(4)
    got = kmers.kmer_counts(to_tiles(seq_table(spark, seqs), 80, 10), 11, "fp").collect()
    assert sorted(map(tuple, got)) == brute_kmers(seqs, 11, "fp")


def test_kmers_of_empty_tables_and_wrong_sizes(spark):
    tiles = to_tiles(seq_table(spark, {"a": "ACGT"}), 8, 5)
    assert kmers.kmer_counts(tiles, 6).collect() == [] and kmers.kmer_counts(tiles.limit(0), 6).collect() == []
    for k, strand in ((0, "f"), (32, "f"), (6, "x")):
        with pytest.raises(ValueError, match=r"k is from 1|strand is"):
            kmers.kmer_counts(tiles, k, strand)


def test_minimizers_are_those_of_both_strands():
    rng = np.random.default_rng(1)
    data = np.frombuffer(b"ACGT", np.uint8)[rng.integers(0, 4, 500)]
    other = np.frombuffer(data.tobytes().decode().translate(COMPLEMENT)[::-1].encode(), np.uint8)
    bounds = np.array([0, 500])
    assert (kmers._places(data, bounds, 17)[1] == kmers._places(other, bounds, 17)[1][::-1]).all()
    mers = kmers._joined(kmers._CODE[data], 17)
    assert (kmers._complement(kmers._joined(kmers._CODE[other], 17), 17)[::-1] == mers).all()


def brute_spans(seqs):
    out = set()
    for s, x in seqs.items():
        for strand, text in ((1, x.upper()), (-1, x.translate(COMPLEMENT)[::-1].upper())):
            for frame in range(3):
                places = list(range(frame, len(text) - 2, 3))
                stops = [p + 1 for p in places if text[p : p + 3] in T.STOPS]
                atgs = [p + 1 for p in places if text[p : p + 3] == "ATG"]
                fence = frame + max((len(text) - frame) // 3, 0) * 3 + 1
                around = [frame - 2, *stops, fence]
                for a, b in zip(around[:-1], around[1:], strict=True):
                    out.add((s, len(text), strand, frame, a, b, b != fence, min((g for g in atgs if a < g < b), default=None)))
    return out


@pytest.mark.parametrize("width", [16, 21, 64, 1000])
def test_spans_between_stops_equal_plain_ones(spark, width):
    seqs = sequences(7)
    table = seq_table(spark, seqs)
    tiles, lengths = to_tiles(table, width, 2), table.select("seq_id", F.length("residues").cast("long").alias("length"))
    got = [tuple(r) for r in frames.open_spans(tiles, lengths).select("seq_id", "length", "strand", "frame", "before", "next", "stops", "atg").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_spans(seqs)


@pytest.mark.parametrize("mode", [0, 1, 2, 3])
def test_frames_equal_plain_ones(spark, mode):
    seqs = sequences(8)
    table = seq_table(spark, seqs)
    tiles, lengths = to_tiles(table, 50, 2), table.select("seq_id", F.length("residues").cast("long").alias("length"))
    want = set()
    for s, n, strand, frame, before, behind, _, atg in brute_spans(seqs):
        first, last = atg if mode % 2 else before + 3, behind - 1
        if first is None or not 9 <= last - first + 1 <= 300:
            continue
        text = seqs[s].upper() if strand == 1 else seqs[s].translate(COMPLEMENT)[::-1].upper()
        start, end = (first, last) if strand == 1 else (n - last + 1, n - first + 1)
        want.add((s, strand, frame, start, end, text[first - 1 : last]))
    got = T.scan_orfs(tiles, lengths, 9, 300, mode, width=50).collect()
    assert len(got) == len(want) and {tuple(r)[:5] for r in got} == {w[:5] for w in want}
    if mode > 1:
        assert {tuple(r) for r in got} == want
    else:
        assert all(len(r.orf) * 3 == r.end_pos - r.start_pos + 1 for r in got)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_short_kmers_are_looked_up_without_a_shuffle(spark):
    seqs = {s: x for s, x in sequences(8).items() if set(x) <= set("ACGT")}
    found = kmers.kmer_counts(to_tiles(seq_table(spark, seqs).coalesce(1).localCheckpoint(), 64, 5), 6, "fp")
    assert "Exchange" not in plan_of(found)
    assert sorted(map(tuple, found.collect())) == brute_kmers(seqs, 6, "fp")


@pytest.mark.parametrize("k", [3, 6, 11])
def test_kmer_track_of_tiles_is_the_track_of_all_places(spark, k):
    seqs = sequences(k)
    table = seq_table(spark, seqs)
    tiles, lengths = to_tiles(table, 70, k - 1), table.select("seq_id", F.length("residues").cast("long").alias("length"))
    want = M.kmer_track(kmers.kmer_counts(tiles, k, "fp").where("n >= 2"), lengths, k)
    assert sorted(map(tuple, M.kmer_track_of_tiles(tiles, k, 2).collect())) == sorted(map(tuple, want.collect()))


def test_buckets_follow_the_number_of_kmers(spark, monkeypatch):
    monkeypatch.setattr(kmers, "BUCKET", 64)
    seen = []
    monkeypatch.setattr(kmers, "_stretches", lambda k, buckets, hot, of=kmers._stretches: seen.append(buckets) or of(k, buckets, hot))
    seqs = sequences(5)
    got = kmers.kmer_counts(to_tiles(seq_table(spark, seqs), 80, 10), 11, "fp").collect()
    assert sorted(map(tuple, got)) == brute_kmers(seqs, 11, "fp")
    assert seen[0] >= len(brute_kmers({s: x for s, x in seqs.items() if set(x) <= set("ACGT")}, 11, "f")) // 64


def test_kmer_regions_are_merged_before_the_shuffle(spark):
    rng = random.Random(2)
    rows = sorted({(f"s{rng.randrange(3)}", rng.randrange(900)) for _ in range(700)})
    rows += rng.sample(rows, 200)
    found = spark.createDataFrame([(s, p, "+", "x", 9) for s, p in rows], kmers.FOUND)
    want = I.merge_intervals(found.where("pos > 0").select("seq_id", (F.col("pos") + 1).alias("start_pos"), (F.col("pos") + 4).alias("end_pos")), ["seq_id"])
    got = M.kmer_regions(found, 6, 4)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sum(b.num_rows for b in kmers.place_runs(iter([pa.RecordBatch.from_pylist([{"seq_id": "a", "start_pos": p, "end_pos": p + 3} for p in range(50)])]))) == 1

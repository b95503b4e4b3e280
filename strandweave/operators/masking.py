"""Sequences as tiles: cutting, extraction across tiles, masking, and counts of k-mers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.functions.sequence import mask_residues, revcomp

from .intervals import TILE as STRETCH
from .intervals import islands, longest_gap, merge_intervals
from .kmers import kmer_counts, place_runs

TILE = 65_536


def to_tiles(seqs: DataFrame, width: int = TILE, overlap: int = 0) -> DataFrame:
    """(seq_id, tile_no, tile_start, residues) of ``seqs(seq_id, residues)``; tiles share ``overlap`` bases with the next."""
    n = F.greatest(F.lit(1), F.ceil(F.length("residues") / width)).cast("int")
    rows = seqs.select("seq_id", "residues", F.explode(F.sequence(F.lit(0), n - 1)).alias("tile_no"))
    start = F.col("tile_no") * width + 1
    return rows.select("seq_id", "tile_no", start.cast("long").alias("tile_start"), F.substring("residues", start, F.lit(width + overlap)).alias("residues"))


def extract_subseq(features: DataFrame, tiles: DataFrame, key: Sequence[str], width: int = TILE) -> DataFrame:
    """(key, part): bases start_pos to end_pos of each feature, once each; features on unknown sequences drop out.

    A feature inside one tile is cut from it by a plain join; only those that cross tiles are put together by a group.
    """
    first, last = F.floor((F.col("start_pos") - 1) / width), F.floor((F.col("end_pos") - 1) / width)
    named = list(dict.fromkeys([*key, "seq_id", "start_pos", "end_pos"]))
    wanted = features.select(*named, first.alias("__first"), last.alias("__last")).distinct()
    source = tiles.select("seq_id", F.col("tile_no").cast("long").alias("tile_no"), "tile_start", "residues")
    begin = F.greatest("start_pos", "tile_start")
    size = F.least(F.col("end_pos"), F.col("tile_start") + width - 1) - begin + 1
    piece = F.substring("residues", (begin - F.col("tile_start") + 1).cast("int"), size.cast("int"))
    inside = wanted.where("__first = __last").withColumn("tile_no", F.col("__first")).join(source, ["seq_id", "tile_no"])
    inside = inside.select(*key, "start_pos", "end_pos", piece.alias("part"))
    across = wanted.where("__first < __last").withColumn("tile_no", F.explode(F.sequence("__first", "__last"))).join(source, ["seq_id", "tile_no"])
    pieces = across.groupBy(*named).agg(F.sort_array(F.collect_list(F.struct("tile_no", piece.alias("piece")))).alias("pieces"))
    return inside.unionAll(pieces.select(*key, "start_pos", "end_pos", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("part")))


def pieces(features: DataFrame, tiles: DataFrame, width: int = TILE) -> DataFrame:
    """``features(seq_id, start_pos, end_pos, …)`` with ``tile_no`` and ``piece``: a row for each tile that one has bases in."""
    first, last = F.floor((F.col("start_pos") - 1) / width), F.floor((F.col("end_pos") - 1) / width)
    source = tiles.select("seq_id", F.col("tile_no").cast("long").alias("tile_no"), "tile_start", "residues")
    rows = features.where(first <= last).withColumn("tile_no", F.explode(F.sequence(first, last))).join(source, ["seq_id", "tile_no"])
    begin = F.greatest("start_pos", "tile_start")
    size = F.least(F.col("end_pos"), F.col("tile_start") + width - 1) - begin + 1
    return rows.select(*features.columns, "tile_no", F.substring("residues", (begin - F.col("tile_start") + 1).cast("int"), size.cast("int")).alias("piece"))


def coding_sequences(parts: DataFrame, tiles: DataFrame, model: str = "parent_id", width: int = TILE) -> DataFrame:
    """(model, coding): the parts of each model in order, reverse-complemented as a whole on the minus strand."""
    found = pieces(parts.select("seq_id", model, "strand", "start_pos", "end_pos"), tiles, width)
    rows = found.groupBy("seq_id", model, "strand").agg(F.sort_array(F.collect_set(F.struct("start_pos", "end_pos", "tile_no", "piece"))).alias("parts"))
    whole: Column = F.array_join(F.transform("parts", lambda p: p["piece"]), "")
    return rows.select("seq_id", model, "strand", F.when(F.col("strand") == -1, revcomp(whole)).otherwise(whole).alias("coding"))


def mask_tiles(tiles: DataFrame, regions: DataFrame, mode: str = "letter", letter: str = "N", width: int = TILE) -> DataFrame:
    """``tiles`` with the bases of ``regions(seq_id, start_pos, end_pos)`` masked; regions may overlap and cross tiles."""
    merged = merge_intervals(regions, ["seq_id"])
    first, last = F.floor((F.col("start_pos") - 1) / width), F.floor((F.col("end_pos") - 1) / width)
    cut = merged.select("seq_id", "start_pos", "end_pos", F.explode(F.sequence(first, last)).alias("tile_no"))
    base = F.col("tile_no") * width
    local = F.struct(F.greatest(F.col("start_pos") - base, F.lit(1)).alias("start"), F.least(F.col("end_pos") - base, F.lit(width)).alias("end"))
    lists = cut.groupBy("seq_id", F.col("tile_no").cast("int").alias("tile_no")).agg(F.sort_array(F.collect_list(local)).alias("regions"))
    rows = tiles.join(lists, ["seq_id", "tile_no"], "left")
    inside = F.filter("regions", lambda r: r["start"] <= F.length("residues"))
    clipped = F.transform(inside, lambda r: F.struct(r["start"].alias("start"), F.least(r["end"], F.length("residues").cast("long")).alias("end")))
    masked = F.when(F.col("regions").isNull(), F.col("residues")).otherwise(mask_residues(F.col("residues"), clipped, mode, letter))
    return rows.select("seq_id", "tile_no", "tile_start", masked.alias("residues"))


def mask_stats(before: DataFrame, after: DataFrame, regions: DataFrame, letter: str = "N") -> DataFrame:
    """Per sequence: length, bases masked before, newly masked, all masked, percent, and the longest clean run of regions."""
    count = lambda df, name: df.groupBy("seq_id").agg(F.sum(F.length("residues")).alias("length"), F.sum(F.regexp_count("residues", F.lit(letter))).alias(name))
    both = count(before, "already").join(count(after, "total").drop("length"), "seq_id")
    gaps = longest_gap(merge_intervals(regions, ["seq_id"]), both.select("seq_id", "length"), ["seq_id"])
    rows = both.join(gaps, "seq_id")
    return rows.select("seq_id", "length", "already", (F.col("total") - F.col("already")).alias("newly"), "total", F.round(F.col("total") * 100 / F.col("length"), 2).alias("percent"), F.col("longest_gap").alias("longest_clean"))


def usable(stats: DataFrame, least_run: int = 500) -> DataFrame:
    """Sequences that aren't wholly masked and have a clean run longer than ``least_run``."""
    return stats.where((F.col("percent") < 100) & (F.col("longest_clean") > least_run))


def kmer_regions(kmers: DataFrame, threshold: int = 6, k: int = 17) -> DataFrame:
    """Merged regions of the plus-strand k-mers that occur ``threshold`` times or more; place 0 doesn't count."""
    often = kmers.where((F.col("strand") == "+") & (F.col("n") >= threshold) & (F.col("pos") > 0))
    regions = often.select("seq_id", (F.col("pos") + 1).cast("long").alias("start_pos"), (F.col("pos") + k).cast("long").alias("end_pos"))
    # What lies together already is merged before the shuffle, which the steps of ``islands`` share.
    runs = regions.mapInArrow(place_runs, "seq_id string, start_pos long, end_pos long, n long").repartition(F.col("seq_id"), F.floor(F.col("start_pos") / STRETCH))
    merged = islands(runs, ["seq_id"], 1).groupBy("seq_id", F.col("island_start").alias("start_pos"))
    return merged.agg(F.max("end_pos").alias("end_pos"), F.sum("n").alias("n"))


def kmer_track_of_tiles(tiles: DataFrame, k: int = 17, least: int = 1, default: float = -0.1) -> DataFrame:
    """``kmer_track`` of all places of the tiles (as for ``kmer_counts``), where k-mers under ``least`` count as none.

    Counts come with their places, so that no table of places is joined with them.
    """
    counts = kmer_counts(tiles, k, "fp", everywhere=True)
    return counts.select("seq_id", "strand", "pos", F.when(F.col("n") >= least, F.round(F.log10("n"), 5)).otherwise(F.lit(default)).alias("value"))


def kmer_track(kmers: DataFrame, lengths: DataFrame, k: int = 17, default: float = -0.1, strands: Sequence[str] = ("+", "-")) -> DataFrame:
    """(seq_id, strand, pos, value): log10 of the count at each place from 0 to length - k, ``default`` where there is none."""
    places = lengths.where(F.col("length") >= k).select("seq_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - k)).alias("pos"))
    places = places.select("seq_id", "pos", F.explode(F.array(*map(F.lit, strands))).alias("strand"))
    found = places.join(kmers.select("seq_id", "strand", "pos", "n"), ["seq_id", "strand", "pos"], "left")
    return found.select("seq_id", "strand", "pos", F.coalesce(F.round(F.log10("n"), 5), F.lit(default)).alias("value"))

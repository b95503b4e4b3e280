"""Operators on alignment hits (hsps: one row a local alignment; a hit is all of them for one query and subject)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandweave.functions.sequence import gap_blocks
from strandweave.functions.text import feature_name, hsp_pct

from .intervals import merge_intervals, numbered

HIT = ("query_id", "hit_id")


def ratio(n: Column, of: Column, digits: int = 4) -> Column:
    """``n / of`` for whole numbers, halves rounded up exactly."""
    return F.floor((n * (2 * 10**digits) + of) / (of * 2)) / 10**digits


def matches(hsps: DataFrame) -> DataFrame:
    """A match for each query, hit and strand: first start, last end, number of alignments."""
    return hsps.groupBy(*HIT, "strand").agg(F.min("q_start").alias("start_pos"), F.max("q_end").alias("end_pos"), F.count("*").alias("n_hsps"))


def hit_stats(hsps: DataFrame) -> DataFrame:
    """Coverage of the hit and identity of a query and hit, over both strands."""
    sums = hsps.groupBy(*HIT).agg(F.max("h_end").alias("e"), F.min("h_start").alias("s"), F.first("hit_len").alias("hit_len"), F.sum("n_identical").alias("same"), F.sum("align_len").alias("len"))
    return sums.select(*HIT, ((F.col("e") - F.col("s") + 1) / F.col("hit_len")).alias("coverage"), (F.col("same") / F.col("len")).alias("identity"))


def passing_hits(hsps: DataFrame, coverage: float = 0.85, identity: float = 0.9, keep_all: bool = False) -> DataFrame:
    """Hits over both thresholds, or all of them with a flag."""
    stats = hit_stats(hsps).withColumn("passes", (F.col("coverage") >= coverage) & (F.col("identity") >= identity))
    return stats if keep_all else stats.where("passes")


def hits_to_matches(hsps: DataFrame, coverage: float = 0.85, identity: float = 0.9, source: str = "TOOL") -> DataFrame:
    """match rows of the hits that pass, and a match_part row for each of their alignments, with names and parents.

    Parts are numbered from the query's start on the plus strand and from its end on the minus strand.
    """
    good = passing_hits(hsps, coverage, identity).select(*HIT, F.round("coverage", 4).alias("coverage"), F.round("identity", 4).alias("identity"))
    match = numbered(matches(hsps).join(good, list(HIT)), ["query_id"], ["hit_id", "strand"])
    match = match.withColumn("name", feature_name(F.lit(source), F.col("start_pos"), F.col("end_pos"), "Match", F.col("number")))
    parts = hsps.join(match.select(*HIT, "strand", F.col("name").alias("parent")), [*HIT, "strand"])
    parts = numbered(parts, [*HIT, "strand"], [F.col("q_start") * F.col("strand"), F.col("q_end") * F.col("strand"), F.desc("bit_score"), "h_start"])
    part_name = F.concat_ws("_", "parent", F.lit("Part"), F.lpad(F.col("number").cast("string"), 4, "0"))
    columns = ["query_id", "type", "start_pos", "end_pos", "strand", "name", "parent", "coverage", "identity"]
    rows = match.withColumns({"type": F.lit("match"), "parent": F.lit(None).cast("string")}).select(*columns)
    of_parts = parts.select("query_id", F.lit("match_part").alias("type"), F.col("q_start").alias("start_pos"), F.col("q_end").alias("end_pos"), "strand", part_name.alias("name"), "parent", F.lit(None).cast("double").alias("coverage"), hsp_pct(F.col("n_identical"), F.col("align_len")).alias("identity"))
    return rows.unionByName(of_parts.select(*columns))


def merged_regions(hsps: DataFrame) -> DataFrame:
    """The stretches of each query that any alignment covers."""
    return merge_intervals(hsps.select("query_id", F.col("q_start").alias("start_pos"), F.col("q_end").alias("end_pos")), ["query_id"])


def hit_list(hsps: DataFrame, coverage: float, identity: float) -> DataFrame:
    """Accessions of the hits that pass, once each."""
    return passing_hits(hsps, coverage, identity).select("hit_id").distinct()


def best_hsp(hsps: DataFrame) -> DataFrame:
    """The alignment with the highest score of each hit; the first on the query among equals."""
    order = W.partitionBy(*HIT).orderBy(F.desc("bit_score"), "q_start", "q_end", "h_start", "strand", "align_len", "n_identical")
    return hsps.withColumn("__k", F.row_number().over(order)).where("__k = 1").drop("__k")


def best_hits(hsps: DataFrame, coverage: float = 0.8, positive: float = 0.8, at_start: bool = True) -> DataFrame:
    """Best alignments that span enough of the hit with enough positives, and begin at position 1 of both sequences.

    ``coverage`` is the span on the hit by its length, ``positive`` the share of positives in the whole alignment.
    ``at_start=False`` lets alignments begin anywhere.
    """
    found = best_hsp(hsps).withColumns({"coverage": (F.col("h_end") - F.col("h_start") + 1) / F.col("hit_len"), "positive": F.col("n_positive") / F.col("align_len"), "similar": F.col("n_identical") / F.col("align_len")})
    found = found.where((F.col("coverage") >= coverage) & (F.col("positive") >= positive))
    return found.where("h_start = 1 and q_start = 1") if at_start else found


def top_hits(hsps: DataFrame, n: int = 10) -> DataFrame:
    """``hsps`` of the first ``n`` hits of each query in the order of the report (column ``ordinal``), with ``hit_rank``."""
    first = hsps.groupBy(*HIT).agg(F.min("ordinal").alias("__first"))
    ranked = first.withColumn("hit_rank", F.row_number().over(W.partitionBy("query_id").orderBy("__first", "hit_id"))).where(F.col("hit_rank") <= n)
    return hsps.join(ranked.drop("__first"), list(HIT))


def model_hit_stats(hsps: DataFrame, n: int = 10) -> DataFrame:
    """Mean percent identity and coverages (percent) of the first ``n`` hits of each query."""
    rows = top_hits(hsps, n).groupBy(*HIT, "hit_rank")
    found = rows.agg(F.sum("align_len").alias("len"), F.first("hit_len").alias("hit_len"), F.first("query_len").alias("query_len"), F.avg(F.col("n_identical") * 100 / F.col("align_len")).alias("identity"))
    return found.select(*HIT, "hit_rank", F.round("identity", 4).alias("identity"), F.round(F.col("len") * 100 / F.col("hit_len"), 4).alias("hit_cov"), F.round(F.col("len") * 100 / F.col("query_len"), 4).alias("query_cov"))


def scored_figures(stats: DataFrame, hit_policy: str = "last_of_top10") -> DataFrame:
    """(query_id, best_hit, identity, hit_cov, query_cov): the figures that a model's score is made of, and its first hit.

    ``hit_policy``: figures of the last of the ranked hits, or of the ``first``.
    """
    if hit_policy not in ("last_of_top10", "first"):
        raise ValueError("hit_policy is last_of_top10 or first")
    figures = F.struct("identity", "hit_cov", "query_cov")
    chosen = F.max_by(figures, "hit_rank") if hit_policy == "last_of_top10" else F.min_by(figures, "hit_rank")
    rows = stats.groupBy("query_id").agg(F.min_by("hit_id", "hit_rank").alias("best_hit"), chosen.alias("f"))
    return rows.select("query_id", "best_hit", "f.identity", "f.hit_cov", "f.query_cov")


def hit_class(stats: DataFrame) -> DataFrame:
    """What the hits say of each query: over_identity (any hit has 35 %), over_cov (hit 70 % and query 60 %); without the
    latter ``pseudo`` (a hit covered by 50 to 70 %) or ``fragment`` (below 50 %)."""
    flags = stats.groupBy("query_id").agg(
        F.bool_or(F.col("identity") >= 35).alias("over_identity"), F.bool_or((F.col("hit_cov") >= 70) & (F.col("query_cov") >= 60)).alias("over_cov"),
        F.bool_or(F.col("hit_cov").between(50, 70)).alias("half"), F.bool_or(F.col("hit_cov") < 50).alias("low"),
    )
    kind = F.when(F.col("over_cov"), "complete").when(F.col("half"), "pseudo").when(F.col("low"), "fragment").otherwise("none")
    return flags.select("query_id", "over_identity", "over_cov", kind.alias("class"))


def chain_figures(hsps: DataFrame) -> DataFrame:
    """Identity and coverage of a chain of alignments, neither above 1."""
    sums = hsps.groupBy(*HIT, "strand").agg(F.sum("align_len").alias("len"), F.sum(F.floor(F.col("align_len") * F.col("n_identical") / F.col("align_len"))).alias("same"), F.first("query_len").alias("query_len"))
    return sums.select(*HIT, "strand", F.least(F.lit(1.0), F.col("len") / F.col("query_len")).alias("coverage"), F.least(F.lit(1.0), F.col("same") / F.col("len")).alias("identity"))


def mapped_figures(hsps: DataFrame) -> DataFrame:
    """Identity and query coverage of a mapped transcript: parts that overlap their neighbour count once; four digits."""
    sums = adjacent_overlap(hsps).groupBy(*HIT, "strand").agg(F.sum("n_identical").alias("same"), F.sum("align_len").alias("len"), F.sum(F.col("q_end") - F.col("q_start") + 1 - F.col("shared")).alias("covered"), F.first("query_len").alias("query_len"))
    return sums.select(*HIT, "strand", ratio(F.col("same"), F.col("len")).alias("identity"), ratio(F.col("covered"), F.col("query_len")).alias("coverage"))


def drop_matching(models: DataFrame, hits: DataFrame, pattern: str, key: str) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) models: rejected if any of its hits' descriptions matches the pattern."""
    bad = hits.where(F.col("hit_description").rlike(pattern)).select(key).distinct()
    return models.join(bad, key, "left_anti"), models.join(bad, key, "left_semi")


def alignment_report(best: DataFrame, max_gap: int = 9) -> DataFrame:
    """(query_id, hit_id, report): header, query, middle and subject line of best alignments, as one text.

    ``best`` comes from ``best_hits`` and has the aligned strings ``q_aln``, ``midline`` and ``h_aln``. The header counts
    the gaps of ``max_gap`` letters or more on either side, if there are any.
    """
    percent = lambda name, c: F.concat(F.lit(f" | {name}: "), F.format_string("%.2f", F.round(F.col(c) * 100, 2)), F.lit("%"))
    gaps = lambda name, c: F.when(gap_blocks(c, max_gap) > 0, F.concat(F.lit(f" | {name} gap(s) over threshold (> {max_gap}aa): "), gap_blocks(c, max_gap).cast("string"))).otherwise("")
    head = F.concat(F.lit(">"), "query_id", F.lit(" | "), "hit_id", percent("Coverage", "coverage"), percent("Identity", "similar"), percent("Positive", "positive"), gaps("Query", "q_aln"), gaps("Subject", "h_aln"))
    lines = F.concat(head, F.lit("\nQuery: "), "q_aln", F.lit("\nAlign: "), "midline", F.lit("\nSbjct: "), "h_aln", F.lit("\n\n"))
    return best.select("query_id", "hit_id", lines.alias("report"))


def superseded(raw: DataFrame, refined: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``raw`` whose keys no row of ``refined`` has."""
    return raw.join(refined.select(*keys).distinct(), list(keys), "left_anti")


def distinct_alignments(hsps: DataFrame) -> DataFrame:
    """Alignments of a query, hit and strand with the same coordinates once; the one with the least identity stays."""
    keys = [*HIT, "strand", "q_start", "q_end", "h_start", "h_end"]
    return hsps.groupBy(*keys, "query_len").agg(F.min("n_identical").alias("n_identical"), F.min("align_len").alias("align_len"))


def adjacent_overlap(hsps: DataFrame) -> DataFrame:
    """``hsps`` with ``shared``: the query bases that an alignment has in common with the next one of its hit and strand."""
    order = W.partitionBy(*HIT, "strand").orderBy("q_start", "q_end")
    return hsps.withColumn("shared", F.coalesce(F.greatest(F.lit(0), F.col("q_end") - F.lead("q_start").over(order) + 1), F.lit(0)))

"""Queries on alignment hits and functional annotation."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandweave.functions import lookups as L
from strandweave.operators import functional as A
from strandweave.operators import hits as H

from .registry import query


@query("f1_matches", "SELECT query_id, hit_id, strand, min(q_start) AS start_pos, max(q_end) AS end_pos, count(*) AS n_hsps FROM fx_hsps GROUP BY ALL")
def f1(t):
    return H.matches(t.fx_hsps)


STATS = "st AS (SELECT query_id, hit_id, (max(h_end) - min(h_start) + 1) / min(hit_len) AS coverage, sum(n_identical) / sum(align_len) AS identity FROM fx_hsps GROUP BY ALL)"


@query("f2_hit_stats", f"WITH {STATS} SELECT query_id, hit_id, round(coverage, 6) AS coverage, round(identity, 6) AS identity FROM st")
def f2(t):
    return H.hit_stats(t.fx_hsps).select("query_id", "hit_id", F.round("coverage", 6).alias("coverage"), F.round("identity", 6).alias("identity"))


@query("d3_hit_thresholds", f"WITH {STATS} SELECT query_id, hit_id, coverage >= 0.5 AND identity >= 0.75 AS passes FROM st")
def d3(t):
    return H.passing_hits(t.fx_hsps, 0.5, 0.75, keep_all=True).select("query_id", "hit_id", "passes")


BEST = """b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id, hit_id ORDER BY bit_score DESC, q_start, q_end, h_start, strand, align_len, n_identical) AS k FROM fx_hsps) WHERE k = 1)"""


@query("g10_best_hsp", f"WITH {BEST} SELECT query_id, hit_id, bit_score, q_start, h_start FROM b")
def g10(t):
    return H.best_hsp(t.fx_hsps).select("query_id", "hit_id", "bit_score", "q_start", "h_start")


#: Alignments moved to the start of both sequences, but for some, so that the rule on starts has something to decide.
_MOVED = """mv AS (SELECT * REPLACE (CASE WHEN bit_score % 4 < 3 THEN 1 ELSE q_start END AS q_start, CASE WHEN bit_score % 5 < 4 THEN 1 ELSE h_start END AS h_start,
CASE WHEN bit_score % 5 < 4 THEN h_end - h_start + 1 ELSE h_end END AS h_end) FROM fx_hsps)"""


def moved(t):
    away = F.col("bit_score") % 5 >= 4
    return t.fx_hsps.withColumns({
        "q_start": F.when(F.col("bit_score") % 4 < 3, 1).otherwise(F.col("q_start")), "h_end": F.when(away, F.col("h_end")).otherwise(F.col("h_end") - F.col("h_start") + 1), "h_start": F.when(away, F.col("h_start")).otherwise(1),
    })


_RULE = "(h_end - h_start + 1) / hit_len >= {0} AND n_positive / align_len >= {1} AND h_start = 1 AND q_start = 1"


@query("d4_best_hsp_rule", f"WITH {_MOVED}, {BEST.replace('fx_hsps', 'mv')} SELECT query_id, hit_id, bit_score FROM b WHERE {_RULE.format(0.15, 0.8)}")
def d4(t):
    return H.best_hits(moved(t), 0.15, 0.8).select("query_id", "hit_id", "bit_score")


@query("d5_match_coverage", "SELECT query_id, hit_id, q_start, q_end FROM fx_hsps WHERE nullif(query_len - 800 * (bit_score % 2), 0) IS NULL OR align_len / query_len >= 0.2")
def d5(t):
    length = F.col("query_len") - F.col("bit_score") % 2 * 800
    from strandweave.operators.transcripts import covers_enough

    return t.fx_hsps.where(covers_enough(F.col("align_len"), length, 0.2)).select("query_id", "hit_id", "q_start", "q_end")


TOP = """r AS (SELECT query_id, hit_id, row_number() OVER (PARTITION BY query_id ORDER BY min(ordinal), hit_id) AS hit_rank FROM fx_hsps GROUP BY query_id, hit_id),
t10 AS (SELECT h.*, hit_rank FROM fx_hsps h JOIN r USING (query_id, hit_id) WHERE hit_rank <= 10)"""
MODEL_STATS = f"""{TOP}, ms AS (SELECT query_id, hit_id, hit_rank::INT AS hit_rank, round(avg(n_identical * 100 / align_len), 4) AS identity,
round(sum(align_len) * 100 / min(hit_len), 4) AS hit_cov, round(sum(align_len) * 100 / min(query_len), 4) AS query_cov FROM t10 GROUP BY query_id, hit_id, hit_rank)"""


@query("g9_top_hits", f"WITH {TOP} SELECT query_id, hit_id, hit_rank::INT AS hit_rank, count(*) AS n FROM t10 GROUP BY ALL")
def g9(t):
    return H.top_hits(t.fx_hsps).groupBy("query_id", "hit_id", "hit_rank").agg(F.count("*").alias("n"))


@query("f3_model_hit_stats", f"WITH {MODEL_STATS} SELECT * FROM ms")
def f3(t):
    return H.model_hit_stats(t.fx_hsps)


@query(
    "f3_hit_policy",
    f"""WITH {MODEL_STATS}, l AS (SELECT query_id, arg_max(identity, hit_rank) AS identity, arg_max(hit_cov, hit_rank) AS hit_cov, arg_max(query_cov, hit_rank) AS query_cov, arg_min(hit_id, hit_rank) AS best_hit FROM ms GROUP BY query_id)
    SELECT 'last_of_top10' AS policy, query_id, best_hit, identity, hit_cov, query_cov FROM l UNION ALL SELECT 'first', query_id, hit_id, identity, hit_cov, query_cov FROM ms WHERE hit_rank = 1""",
)
def f3_policy(t):
    stats = H.model_hit_stats(t.fx_hsps)
    of = lambda policy: H.scored_figures(stats, policy).select(F.lit(policy).alias("policy"), "*")
    return of("last_of_top10").unionByName(of("first"))


@query(
    "f4_hit_class",
    f"""WITH {MODEL_STATS} SELECT query_id, bool_or(identity >= 35) AS over_identity, bool_or(hit_cov >= 70 AND query_cov >= 60) AS over_cov,
    CASE WHEN bool_or(hit_cov >= 70 AND query_cov >= 60) THEN 'complete' WHEN bool_or(hit_cov BETWEEN 50 AND 70) THEN 'pseudo' WHEN bool_or(hit_cov < 50) THEN 'fragment' ELSE 'none' END AS class
    FROM ms GROUP BY query_id""",
)
def f4(t):
    return H.hit_class(H.model_hit_stats(t.fx_hsps))


@query(
    "f5_mapped_figures",
    """WITH s AS (SELECT *, coalesce(greatest(0, q_end - lead(q_start) OVER (PARTITION BY query_id, hit_id, strand ORDER BY q_start, q_end) + 1), 0) AS shared FROM fx_hsps)
    SELECT query_id, hit_id, strand, floor((sum(n_identical) * 20000 + sum(align_len)) / (sum(align_len) * 2)) / 10000 AS identity, floor((sum(q_end - q_start + 1 - shared) * 20000 + min(query_len)) / (min(query_len) * 2)) / 10000 AS coverage FROM s GROUP BY ALL""",
)
def f5(t):
    return H.mapped_figures(t.fx_hsps)


@query(
    "f6_chain_figures",
    """SELECT query_id, hit_id, strand, round(least(1.0, sum(align_len)::DOUBLE / min(query_len)), 6) AS coverage, round(least(1.0, sum(floor(align_len * n_identical / align_len)) / sum(align_len)), 6) AS identity FROM fx_hsps GROUP BY ALL""",
)
def f6(t):
    return H.chain_figures(t.fx_hsps).select("query_id", "hit_id", "strand", F.round("coverage", 6).alias("coverage"), F.round("identity", 6).alias("identity"))


@query(
    "n15_hits_to_matches",
    f"""WITH {STATS}, good AS (SELECT query_id, hit_id, round(coverage, 4) AS coverage, round(identity, 4) AS identity FROM st WHERE coverage >= 0.5 AND identity >= 0.75),
    m AS (SELECT query_id, hit_id, strand, min(q_start) AS start_pos, max(q_end) AS end_pos FROM fx_hsps GROUP BY ALL),
    n AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY hit_id, strand) AS num FROM m JOIN good USING (query_id, hit_id)),
    named AS (SELECT *, concat_ws('_', 'TOOL', start_pos::VARCHAR, end_pos::VARCHAR, 'Match', lpad(num::VARCHAR, 4, '0')) AS name FROM n),
    p AS (SELECT h.*, name AS parent, row_number() OVER (PARTITION BY query_id, hit_id, strand ORDER BY q_start * strand, q_end * strand, bit_score DESC, h_start) AS num FROM fx_hsps h JOIN (SELECT query_id, hit_id, strand, name FROM named) USING (query_id, hit_id, strand))
    SELECT query_id, 'match' AS type, start_pos, end_pos, strand, name, NULL::VARCHAR AS parent, coverage, identity FROM named
    UNION ALL SELECT query_id, 'match_part', q_start, q_end, strand, concat_ws('_', parent, 'Part', lpad(num::VARCHAR, 4, '0')), parent, NULL, round(n_identical * 100 / align_len, 2) FROM p""",
)
def n15(t):
    return H.hits_to_matches(t.fx_hsps, 0.5, 0.75)


@query(
    "n35_merged_regions",
    """WITH a AS (SELECT query_id, q_start, q_end, max(q_end) OVER (PARTITION BY query_id ORDER BY q_start, q_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM fx_hsps),
    b AS (SELECT *, sum(CASE WHEN before IS NULL OR q_start > before + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY query_id ORDER BY q_start, q_end ROWS UNBOUNDED PRECEDING) AS island FROM a)
    SELECT query_id, min(q_start) AS start_pos, max(q_end) AS end_pos, count(*) AS n FROM b GROUP BY query_id, island""",
)
def n35(t):
    return H.merged_regions(t.fx_hsps)


@query("b4_hit_list", f"WITH {STATS} SELECT DISTINCT hit_id FROM st WHERE coverage >= 0.5 AND identity >= 0.75")
def b4(t):
    return H.hit_list(t.fx_hsps, 0.5, 0.75)


@query("n16_best_hits", f"WITH {_MOVED}, {BEST.replace('fx_hsps', 'mv')} SELECT query_id, hit_id, bit_score, round((h_end - h_start + 1) / hit_len, 6) AS coverage, round(n_positive / align_len, 6) AS positive, round(n_identical / align_len, 6) AS similar FROM b WHERE {_RULE.format(0.1, 0.7)}")
def n16(t):
    rounded = (F.round(c, 6).alias(c) for c in ("coverage", "positive", "similar"))
    return H.best_hits(moved(t), 0.1, 0.7).select("query_id", "hit_id", "bit_score", *rounded)


#: Aligned strings of a few letters that stand for those of a report, with gaps of different lengths.
_ALIGNED = """al AS (SELECT *, concat(left(hit_description, 6), repeat('-', CAST(bit_score % 12 AS INT)), right(hit_description, 5)) AS q_aln, concat(repeat('|', 6), repeat(' ', CAST(bit_score % 12 AS INT)), repeat('+', 5)) AS midline,
concat(query_id, repeat('-', CAST(align_len % 11 AS INT)), hit_id) AS h_aln FROM b)"""


@query(
    "b7_alignment_report",
    f"""WITH {_MOVED}, {BEST.replace('fx_hsps', 'mv')}, {_ALIGNED} SELECT query_id, hit_id, concat('>', query_id, ' | ', hit_id, ' | Coverage: ', printf('%.2f', round((h_end - h_start + 1) / hit_len * 100, 2)), '% | Identity: ', printf('%.2f', round(n_identical / align_len * 100, 2)), '% | Positive: ', printf('%.2f', round(n_positive / align_len * 100, 2)), '%',
    CASE WHEN len(regexp_extract_all(q_aln, '[^A-Za-z0-9_]{{9,}}')) > 0 THEN concat(' | Query gap(s) over threshold (> 9aa): ', len(regexp_extract_all(q_aln, '[^A-Za-z0-9_]{{9,}}'))::VARCHAR) ELSE '' END,
    CASE WHEN len(regexp_extract_all(h_aln, '[^A-Za-z0-9_]{{9,}}')) > 0 THEN concat(' | Subject gap(s) over threshold (> 9aa): ', len(regexp_extract_all(h_aln, '[^A-Za-z0-9_]{{9,}}'))::VARCHAR) ELSE '' END,
    chr(10), 'Query: ', q_aln, chr(10), 'Align: ', midline, chr(10), 'Sbjct: ', h_aln, chr(10), chr(10)) AS report FROM al WHERE {_RULE.format(0.1, 0.7)}""",
)
def b7(t):
    best = H.best_hits(moved(t), 0.1, 0.7)
    gap = lambda c, m, letter: F.repeat(F.lit(letter), (F.col(c) % m).cast("int"))
    best = best.withColumns({
        "q_aln": F.concat(F.substring("hit_description", 1, 6), gap("bit_score", 12, "-"), F.right("hit_description", F.lit(5))),
        "midline": F.concat(F.lit("||||||"), gap("bit_score", 12, " "), F.lit("+++++")), "h_aln": F.concat("query_id", gap("align_len", 11, "-"), "hit_id"),
    })
    return H.alignment_report(best)


_TRANSPOSON = "(?i)green|misty"


@query("n10_exclude_transposase_like", f"SELECT query_id, bool_or(regexp_matches(hit_description, '{_TRANSPOSON}') AND n_identical % 10 = 0) AS rejected FROM fx_hsps GROUP BY query_id")
def n10(t):
    kept, rejected = H.drop_matching(t.fx_hsps.select("query_id").distinct(), t.fx_hsps.where("n_identical % 10 = 0"), _TRANSPOSON, "query_id")
    return kept.withColumn("rejected", F.lit(False)).unionByName(rejected.withColumn("rejected", F.lit(True)))


@query("i5_partitions", "SELECT parent_id, CASE WHEN max(end_pos - start_pos) > 120 THEN 'rejected' ELSE 'conserved' END AS part FROM fx_exons GROUP BY parent_id")
def i5(t):
    longest = t.fx_exons.groupBy("parent_id").agg(F.max(F.col("end_pos") - F.col("start_pos")).alias("n"))
    from strandweave.operators.models import partitions

    rejected, conserved = partitions(longest, F.col("n") > 120)
    return rejected.select("parent_id", F.lit("rejected").alias("part")).unionByName(conserved.select("parent_id", F.lit("conserved").alias("part")))


#: The description of the strongest alignment of a query and step stands for a step's search result.
_STEP_HITS = f"""w AS (SELECT query_id, strand, hit_description, align_len, hit_len, n_identical, bit_score, bit_score % 3 AS s, row_number() OVER (PARTITION BY query_id, bit_score % 3 ORDER BY bit_score DESC, q_start, hit_description, h_start, strand, align_len, n_identical) AS k FROM fx_hsps),
best AS (SELECT query_id, s, CASE WHEN align_len % 4 = 0 THEN concat('predicted ', hit_description) WHEN align_len % 4 = 1 THEN concat('Gypsy ', hit_description) ELSE hit_description END AS d, least(100, 600 * align_len / hit_len) AS cov, 100 * n_identical / align_len - bit_score % 50 AS ident FROM w WHERE k = 1)"""


def step_hits(t):
    from pyspark.sql import Window as W

    order = W.partitionBy("query_id", "s").orderBy(F.desc("bit_score"), "q_start", "hit_description", "h_start", "strand", "align_len", "n_identical")
    rows = t.fx_hsps.withColumn("s", F.col("bit_score") % 3).withColumn("k", F.row_number().over(order)).where("k = 1")
    text = F.when(F.col("align_len") % 4 == 0, F.concat(F.lit("predicted "), "hit_description")).when(F.col("align_len") % 4 == 1, F.concat(F.lit("Gypsy "), "hit_description")).otherwise(F.col("hit_description"))
    return rows.select("query_id", "s", text.alias("description"), F.least(F.lit(100.0), F.col("align_len") * 600 / F.col("hit_len")).alias("coverage"), (F.col("n_identical") * 100 / F.col("align_len") - F.col("bit_score") % 50).alias("identity"))


@query(
    "n17_annotation_cascade",
    f"""WITH {_STEP_HITS}, h AS (SELECT *, regexp_matches(regexp_replace(d, '^[^-]*-', ''), '(?i){"|".join(L.HYPOTHETICAL)}') AS hypo, regexp_matches(d, '(?i){"|".join(L.TE_LIKE)}') AS te FROM best),
    c AS (SELECT query_id, 1 AS step, 'known_function' AS class, d FROM h WHERE s = 0 AND cov > 80 AND ident > 80 AND NOT hypo
    UNION ALL SELECT query_id, 2, 'putative_function', d FROM h WHERE s = 1 AND cov > 50 AND ident > 45 AND NOT hypo
    UNION ALL SELECT query_id, 3, 'domain_containing_protein', string_agg(DISTINCT hit_id, ',' ORDER BY hit_id) FROM fx_hsps WHERE bit_score % 97 = 0 GROUP BY query_id
    UNION ALL SELECT query_id, 4, 'expressed_sequence', d FROM h WHERE s = 2 AND cov > 50 AND ident > 45
    UNION ALL SELECT query_id, 5, 'conserved_unknown_function', d FROM h WHERE s = 1 AND cov > 50 AND ident > 45
    UNION ALL SELECT query_id, 6, 'Warning - Possible Transposable Element', d FROM h WHERE s = 0 AND cov > 40 AND ident > 35 AND te),
    f AS (SELECT query_id, arg_min(class, step) AS class, arg_min(d, step) AS d FROM c GROUP BY query_id)
    SELECT DISTINCT x.query_id, coalesce(f.class, 'hypothetical_protein') AS class, f.d AS description FROM fx_hsps x LEFT JOIN f ON f.query_id = x.query_id""",
)
def n17(t):
    hits = step_hits(t)
    of = lambda s: hits.where(F.col("s") == s).drop("s").withColumnRenamed("query_id", "protein_id")
    found = t.fx_hsps.where("bit_score % 97 = 0").select(F.col("query_id").alias("protein_id"), F.col("hit_id").alias("name"), F.col("hit_id").alias("place")).distinct()
    domains = A.joined_domains(found, "protein_id").withColumnRenamed("domains", "description")
    proteins = t.fx_hsps.select(F.col("query_id").alias("protein_id")).distinct()
    return A.standard_cascade(proteins, {"known": of(0), "putative": of(1), "domains": domains, "expressed": of(2), "transposable": of(0)}).select(F.col("protein_id").alias("query_id"), "class", "description")


@query(
    "n18_orf_annotation",
    f"""WITH {_STEP_HITS} SELECT DISTINCT x.query_id, coalesce(d, 'No_biological_evidence') AS note FROM fx_hsps x LEFT JOIN (SELECT * FROM best WHERE s = 0 AND ident > 40 AND cov > 5) b ON b.query_id = x.query_id""",
)
def n18(t):
    hits = step_hits(t).where("s = 0").withColumnRenamed("query_id", "protein_id")
    return A.orf_annotation(t.fx_hsps.select(F.col("query_id").alias("protein_id")).distinct(), hits).select(F.col("protein_id").alias("query_id"), "note")


@query("d9_no_evidence", f"WITH {_STEP_HITS} SELECT DISTINCT query_id FROM best WHERE s = 0 AND ident > 40 AND cov > 5")
def d9(t):
    hits = step_hits(t).where("s = 0").withColumnRenamed("query_id", "protein_id")
    noted = A.orf_annotation(t.fx_hsps.select(F.col("query_id").alias("protein_id")).distinct(), hits)
    return A.with_evidence(noted).select(F.col("protein_id").alias("query_id"))


@query("f14_joined_domains", "SELECT query_id, string_agg(DISTINCT hit_id, ',' ORDER BY hit_id) AS domains FROM fx_hsps WHERE strand = 1 GROUP BY query_id")
def f14(t):
    rows = t.fx_hsps.where("strand = 1").select("query_id", F.col("hit_id").alias("name"), F.col("hit_id").alias("place")).distinct()
    return A.joined_domains(rows, "query_id")


@query("f15_counts_per_tool", "SELECT hit_id, strand, count(*) AS n FROM fx_hsps GROUP BY hit_id, strand")
def f15(t):
    return t.fx_hsps.groupBy("hit_id", "strand").agg(F.count("*").alias("n"))


@query("g11_first_hit", f"WITH {TOP} SELECT query_id, hit_id, bit_score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY bit_score DESC, hit_id, q_start, q_end, h_start) AS k FROM t10 WHERE hit_rank = 1) WHERE k = 1 AND n_identical / align_len >= 0.7")
def g11(t):
    first = H.best_hsp(H.top_hits(t.fx_hsps, 1))
    return first.where(F.col("n_identical") / F.col("align_len") >= 0.7).select("query_id", "hit_id", "bit_score")

"""Queries of range joins, windows over intervals, orders and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandweave.functions.lookups import SUBFEATURE_RANK, looked_up
from strandweave.operators import intervals as I

from .registry import query


def genes(t):
    return t.fx_exons.groupBy("seq_id", "parent_id", "strand", "file_level").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"))


GENES = "g AS (SELECT seq_id, parent_id, strand, file_level, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM fx_exons GROUP BY ALL)"


@query(
    "e1_overlap_evidence",
    f"""WITH {GENES} SELECT g.parent_id, v.evidence_id, v.start_pos AS evidence_start, v.end_pos AS evidence_end FROM g JOIN fx_evidence v
    ON g.seq_id = v.seq_id AND g.strand = v.strand AND g.start_pos < v.end_pos AND g.end_pos > v.start_pos""",
)
def e1(t):
    pairs = I.overlap_join(genes(t), t.fx_evidence, ["seq_id", "strand"])
    return pairs.select("parent_id", F.col("r_evidence_id").alias("evidence_id"), F.col("r_start_pos").alias("evidence_start"), F.col("r_end_pos").alias("evidence_end"))


@query(
    "e2_exon_overlap",
    """SELECT DISTINCT x.parent_id, v.evidence_id FROM fx_exons x JOIN fx_evidence v
    ON x.seq_id = v.seq_id AND x.strand = v.strand AND x.start_pos < v.end_pos AND x.end_pos > v.start_pos""",
)
def e2(t):
    return I.overlap_join(t.fx_exons, t.fx_evidence, ["seq_id", "strand"]).select("parent_id", F.col("r_evidence_id").alias("evidence_id")).distinct()


@query(
    "e3_child_parent",
    f"""WITH {GENES} SELECT x.feature_id, x.parent_id, g.start_pos AS parent_start, g.end_pos AS parent_end, g.parent_id IS NULL AS orphan
    FROM fx_exons x LEFT JOIN (SELECT * FROM g WHERE file_level <> 3) g ON x.seq_id = g.seq_id AND x.parent_id = g.parent_id""",
)
def e3(t):
    parents = genes(t).where("file_level <> 3").select("seq_id", "parent_id", F.col("start_pos").alias("parent_start"), F.col("end_pos").alias("parent_end"))
    return t.fx_exons.join(parents, ["seq_id", "parent_id"], "left").select("feature_id", "parent_id", "parent_start", "parent_end", F.col("parent_start").isNull().alias("orphan"))


@query(
    "e4_overlap_pairs",
    """SELECT DISTINCT a.parent_id AS a, b.parent_id AS b FROM fx_exons a JOIN fx_exons b
    ON a.seq_id = b.seq_id AND a.strand = b.strand AND a.start_pos <= b.end_pos AND a.end_pos >= b.start_pos AND a.parent_id < b.parent_id""",
)
def e4(t):
    pairs = I.overlap_join(t.fx_exons, t.fx_exons, ["seq_id", "strand"], strict=False)
    return pairs.where("parent_id < r_parent_id").select(F.col("parent_id").alias("a"), F.col("r_parent_id").alias("b")).distinct()


@query(
    "e5_overlapping_models",
    f"""WITH {GENES} SELECT a.parent_id AS seed, b.parent_id AS other, b.file_level FROM g a JOIN g b
    ON a.seq_id = b.seq_id AND a.start_pos < b.end_pos AND a.end_pos > b.start_pos AND a.parent_id <> b.parent_id AND b.file_level >= a.file_level""",
)
def e5(t):
    pairs = I.overlap_join(genes(t), genes(t), ["seq_id"]).where("parent_id <> r_parent_id and r_file_level >= file_level")
    return pairs.select(F.col("parent_id").alias("seed"), F.col("r_parent_id").alias("other"), F.col("r_file_level").alias("file_level"))


@query(
    "e6_tolerance_join",
    f"""WITH {GENES} SELECT g.parent_id, v.evidence_id, v.start_pos, g.start_pos - v.start_pos AS apart FROM g JOIN fx_evidence v
    ON g.seq_id = v.seq_id AND g.strand = v.strand AND abs(g.start_pos - v.start_pos) <= 21 AND (g.start_pos - v.start_pos) % 3 = 0""",
)
def e6(t):
    pairs = I.band_join(genes(t), t.fx_evidence, ["seq_id", "strand"], "start_pos", 21, 3)
    return pairs.select("parent_id", F.col("r_evidence_id").alias("evidence_id"), F.col("r_start_pos").alias("start_pos"), (F.col("start_pos") - F.col("r_start_pos")).alias("apart"))


_LEAD = "lead(start_pos) OVER (PARTITION BY {by} ORDER BY start_pos, end_pos)"
INTRONS = "i AS (SELECT * FROM (SELECT seq_id, strand, parent_id, end_pos AS donor_end, " + _LEAD.format(by="seq_id, strand, parent_id") + " AS acceptor_start FROM fx_exons) WHERE acceptor_start IS NOT NULL)"
EV_INTRONS = "v AS (SELECT * FROM (SELECT seq_id, strand, evidence_id, end_pos AS donor_end, " + _LEAD.format(by="seq_id, strand, evidence_id") + " AS acceptor_start FROM fx_evidence) WHERE acceptor_start IS NOT NULL)"


@query(
    "e7_intron_match",
    f"""WITH {INTRONS}, {EV_INTRONS} SELECT parent_id, donor_end, acceptor_start, (seq_id, strand, donor_end % 200, acceptor_start % 3) IN (SELECT (seq_id, strand, donor_end % 200, acceptor_start % 3) FROM v) AS valid FROM i""",
)
def e7(t):
    cut = lambda df: df.select("seq_id", "strand", (F.col("donor_end") % 200).alias("d"), (F.col("acceptor_start") % 3).alias("a"))
    found = cut(I.introns(t.fx_evidence, ["seq_id", "strand", "evidence_id"])).distinct().withColumn("hit", F.lit(True))
    own = I.introns(t.fx_exons, ["seq_id", "strand", "parent_id"]).withColumns({"d": F.col("donor_end") % 200, "a": F.col("acceptor_start") % 3})
    return own.join(found, ["seq_id", "strand", "d", "a"], "left").select("parent_id", "donor_end", "acceptor_start", F.coalesce("hit", F.lit(False)).alias("valid"))


@query("e9_lookup_join", "SELECT x.l_orderkey, x.l_linenumber, x.l_partkey, coalesce(p.p_name, 'unknown') AS description FROM lineitem x LEFT JOIN (SELECT * FROM part WHERE p_partkey % 3 <> 0) p ON p_partkey = l_partkey")
def e9(t):
    names = t.part.where("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    from strandweave.operators.features import look_up

    rows = look_up(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), names.withColumnRenamed("p_name", "description"), "l_partkey", {"description": "unknown"})
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "description")


@query("e10_subset_bank", "SELECT seq_id, residues FROM fx_sequences WHERE seq_id IN (SELECT concat('seq', CAST(l_orderkey AS VARCHAR)) FROM lineitem WHERE l_returnflag = 'R')")
def e10(t):
    hits = t.lineitem.where("l_returnflag = 'R'").select(F.concat(F.lit("seq"), F.col("l_orderkey").cast("string")).alias("seq_id"))
    from strandweave.operators.features import subset_bank

    return subset_bank(t.fx_sequences, hits).select("seq_id", "residues")


@query("g1_numbering", "SELECT feature_id, lpad(row_number() OVER (PARTITION BY seq_id, strand ORDER BY start_pos, end_pos, feature_id)::VARCHAR, 5, '0') AS number FROM fx_exons")
def g1(t):
    return I.numbered(t.fx_exons, ["seq_id", "strand"], ["start_pos", "end_pos", "feature_id"], place=F.col("start_pos"), width=4096).select("feature_id", F.lpad(F.col("number").cast("string"), 5, "0").alias("number"))


@query(
    "g2_exon_subtype",
    """SELECT feature_id, CASE WHEN n = 1 THEN 'Single' WHEN k = 1 THEN CASE WHEN strand = 1 THEN 'Initial' ELSE 'Terminal' END
    WHEN k = n THEN CASE WHEN strand = 1 THEN 'Terminal' ELSE 'Initial' END ELSE 'Internal' END AS subtype
    FROM (SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY start_pos, feature_id) AS k, count(*) OVER (PARTITION BY parent_id) AS n FROM fx_exons)""",
)
def g2(t):
    from strandweave.operators.features import exon_subtype

    return exon_subtype(t.fx_exons, ["parent_id"], ["start_pos", "feature_id"]).select("feature_id", "subtype")


def _islands_sql(table: str, keys: str, reach: int) -> str:
    return f"""a AS (SELECT *, max(end_pos) OVER (PARTITION BY {keys} ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM {table}),
    b AS (SELECT *, sum(CASE WHEN before IS NULL OR start_pos > before + {reach} THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY start_pos, end_pos ROWS UNBOUNDED PRECEDING) AS island FROM a)"""


@query("g4_merge_regions", f"WITH {_islands_sql('fx_exons', 'seq_id', 1)} SELECT seq_id, min(start_pos) AS start_pos, max(end_pos) AS end_pos, count(*) AS n FROM b GROUP BY seq_id, island")
def g4(t):
    return I.merge_intervals(t.fx_exons, ["seq_id"])


@query("g5_cluster_intervals", f"WITH {_islands_sql('fx_exons', 'seq_id, strand', 0)} SELECT seq_id, strand, min(start_pos) AS cluster_start, max(end_pos) AS cluster_end, count(DISTINCT parent_id) AS genes FROM b GROUP BY seq_id, strand, island")
def g5(t):
    clusters = I.cluster_intervals(t.fx_exons, ["seq_id", "strand"])
    return clusters.groupBy("seq_id", "strand", "cluster_start").agg(F.max("end_pos").alias("cluster_end"), F.count_distinct("parent_id").alias("genes"))


@query("g6_introns", f"WITH {INTRONS} SELECT parent_id, donor_end, acceptor_start, acceptor_start - donor_end - 1 AS intron_len FROM i")
def g6(t):
    return I.introns(t.fx_exons, ["seq_id", "strand", "parent_id"]).select("parent_id", "donor_end", "acceptor_start", "intron_len")


@query(
    "g7_cumulative_offset",
    """SELECT parent_id, feature_id, coalesce(sum(end_pos - start_pos + 1) OVER (PARTITION BY parent_id ORDER BY start_pos * strand, end_pos * strand
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM fx_exons""",
)
def g7(t):
    return I.cumulative_offset(t.fx_exons, ["parent_id"]).select("parent_id", "feature_id", "offset")


@query(
    "g8_adjacent_overlap",
    """SELECT query_id, hit_id, strand, q_start, q_end, h_start, coalesce(greatest(0, q_end - lead(q_start) OVER (PARTITION BY query_id, hit_id, strand ORDER BY q_start, q_end) + 1), 0)::BIGINT AS shared
    FROM (SELECT DISTINCT query_id, hit_id, strand, q_start, q_end, min(h_start) AS h_start FROM fx_hsps GROUP BY ALL)""",
)
def g8(t):
    from strandweave.operators.hits import adjacent_overlap

    rows = t.fx_hsps.groupBy("query_id", "hit_id", "strand", "q_start", "q_end").agg(F.min("h_start").alias("h_start"))
    return adjacent_overlap(rows)


@query(
    "g13_kinship_groups",
    """SELECT feature_id, last_value(CASE WHEN file_level = 0 THEN feature_id END IGNORE NULLS) OVER (PARTITION BY seq_id ORDER BY start_pos, feature_id ROWS UNBOUNDED PRECEDING) AS master FROM fx_exons""",
)
def g13(t):
    from strandweave.operators.features import kinship_groups

    return kinship_groups(t.fx_exons.withColumn("parent", F.when(F.col("file_level") != 0, F.lit("any"))), ["seq_id"], ["start_pos", "feature_id"], "parent", "feature_id", 4096).select("feature_id", F.col("master"))


@query(
    "g14_drop_identical",
    """SELECT query_id, hit_id, strand, q_start, q_end, h_start, h_end, query_len, min(n_identical) AS n_identical, min(align_len) AS align_len FROM fx_hsps GROUP BY ALL""",
)
def g14(t):
    from strandweave.operators.hits import distinct_alignments

    return distinct_alignments(t.fx_hsps)


@query(
    "g15_longest_clean_run",
    f"""WITH {_islands_sql("fx_cds", "seq_id", 1)}, m AS (SELECT seq_id, min(start_pos) AS s, max(end_pos) AS e FROM b GROUP BY seq_id, island),
    k AS (SELECT seq_id, s - coalesce(lag(e) OVER (PARTITION BY seq_id ORDER BY s), 0) - 1 AS gap, e FROM m),
    n AS (SELECT seq_id, max(gap) AS gap, max(e) AS e FROM k GROUP BY seq_id)
    SELECT x.seq_id, CASE WHEN gap IS NULL THEN length(residues)::BIGINT ELSE greatest(gap, length(residues) - e) END AS longest_gap FROM fx_sequences x LEFT JOIN n ON n.seq_id = x.seq_id""",
)
def g15(t):
    lengths = t.fx_sequences.select("seq_id", F.length("residues").cast("long").alias("length"))
    return I.longest_gap(I.merge_intervals(t.fx_cds, ["seq_id"]), lengths, ["seq_id"])


@query("g16_merge_segments", f"WITH {_islands_sql('fx_exons', 'seq_id, parent_id', 1)} SELECT seq_id, parent_id, min(start_pos) AS start_pos, max(end_pos) AS end_pos, count(*) AS n FROM b GROUP BY seq_id, parent_id, island")
def g16(t):
    return I.merge_intervals(t.fx_exons, ["seq_id", "parent_id"])


@query(
    "g17_chunk_tiling",
    """WITH s AS (SELECT doc_id, length(text) AS n FROM documents), c AS (SELECT doc_id, n, unnest(range(1, CASE WHEN n > 1000 THEN (n - 1000) // 800 + 3 ELSE 2 END)) AS chunk_no FROM s)
    SELECT doc_id, chunk_no::INT AS chunk_no, 1 + (chunk_no - 1) * 800 AS chunk_start, least(n, (chunk_no - 1) * 800 + 1000) AS chunk_end FROM c""",
)
def g17(t):
    return I.tiles_of(t.documents.select("doc_id", F.length("text").cast("long").alias("length")), 1000, 200).select("doc_id", "chunk_no", "chunk_start", "chunk_end")


@query("h1_sorted_features", "SELECT seq_id, feature_id, row_number() OVER (PARTITION BY seq_id ORDER BY start_pos, end_pos, feature_id) AS place FROM fx_exons")
def h1(t):
    return I.numbered(t.fx_exons, ["seq_id"], ["start_pos", "end_pos", "feature_id"], "place", F.col("start_pos"), 4096).select("seq_id", "feature_id", F.col("place").cast("long").alias("place"))


@query("h2_strand_order", "SELECT parent_id, feature_id, row_number() OVER (PARTITION BY parent_id ORDER BY start_pos * strand, feature_id) AS place FROM fx_exons")
def h2(t):
    return I.numbered(t.fx_exons, ["parent_id"], [F.col("start_pos") * F.col("strand"), "feature_id"], "place").select("parent_id", "feature_id", F.col("place").cast("long").alias("place"))


_SUB = ["exon", "five_prime_UTR", "three_prime_UTR", "polypeptide"]


@query(
    "h3_subfeature_order",
    f"""WITH k AS (SELECT *, ({_SUB!r})[1 + (start_pos + strand + 1) % 4] AS type FROM fx_exons)
    SELECT feature_id, type, (CASE WHEN strand = -1 AND type = 'five_prime_UTR' THEN 7 WHEN strand = -1 AND type = 'three_prime_UTR' THEN 5
    ELSE CASE type WHEN 'exon' THEN 4 WHEN 'five_prime_UTR' THEN 5 WHEN 'polypeptide' THEN 6 ELSE 7 END END)::INT AS rank FROM k""",
)
def h3(t):
    from strandweave.operators.features import subfeature_rank

    kind = F.element_at(F.lit(_SUB), ((F.col("start_pos") + F.col("strand") + 1) % 4 + 1).cast("int"))
    return t.fx_exons.withColumn("type", kind).select("feature_id", "type", subfeature_rank(F.col("type"), F.col("strand")).alias("rank"))


@query("h4_select_order_limit", "SELECT task_id, seq_id, real_time FROM fx_task_runs WHERE status = 11 ORDER BY real_time DESC, task_id LIMIT 50")
def h4(t):
    from strandweave.operators.runs import select_rows

    return select_rows(t.fx_task_runs, ["task_id", "seq_id", "real_time"], {"status": 11}, [F.desc("real_time"), "task_id"], 50)


@query("i1_union_levels", "SELECT file_level, feature_id, start_pos FROM fx_exons WHERE file_level < 2 UNION ALL SELECT 9 AS file_level, evidence_id AS feature_id, start_pos FROM fx_evidence")
def i1(t):
    manual = t.fx_exons.where("file_level < 2").select("file_level", "feature_id", "start_pos")
    return manual.unionByName(t.fx_evidence.select(F.lit(9).alias("file_level"), F.col("evidence_id").alias("feature_id"), "start_pos"))


@query("i3_distinct_ids", "SELECT DISTINCT seq_id, parent_id FROM fx_exons")
def i3(t):
    return t.fx_exons.select("seq_id", "parent_id").distinct()


@query(
    "i4_singletons",
    """SELECT DISTINCT parent_id FROM fx_exons EXCEPT SELECT a.parent_id FROM fx_exons a JOIN fx_exons b
    ON a.seq_id = b.seq_id AND a.strand = b.strand AND a.start_pos <= b.end_pos AND a.end_pos >= b.start_pos AND a.parent_id <> b.parent_id""",
)
def i4(t):
    pairs = I.overlap_join(t.fx_exons, t.fx_exons, ["seq_id", "strand"], strict=False).where("parent_id <> r_parent_id").select("parent_id")
    return t.fx_exons.select("parent_id").distinct().join(pairs, "parent_id", "left_anti")

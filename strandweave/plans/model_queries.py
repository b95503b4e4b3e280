"""Queries on sequences as tiles and on gene models."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandweave.functions import lookups as L
from strandweave.operators import features as X
from strandweave.operators import intervals as I
from strandweave.operators import masking as M
from strandweave.operators import models as G
from strandweave.operators.graph import written

from .expression_queries import sql_protein, sql_revcomp
from .fixtures import shares
from .interval_queries import GENES, _islands_sql, genes
from .registry import query

#: Tiles of 256 bases, so that features of the small test sequences cross them.
W = 256


def tiles(t):
    return M.to_tiles(t.fx_sequences, W)


_PART = "substring(residues, CAST(start_pos AS INT), CAST(end_pos - start_pos + 1 AS INT))"


@query("e11_extract_subseq", f"SELECT DISTINCT c.parent_id, c.start_pos, c.end_pos, {_PART} AS part FROM fx_cds c JOIN fx_sequences s ON s.seq_id = c.seq_id")
def e11(t):
    return M.extract_subseq(t.fx_cds, tiles(t), ["parent_id"], W)


CODING = f"""d AS (SELECT DISTINCT seq_id, parent_id, strand, start_pos, end_pos FROM fx_cds),
k AS (SELECT c.seq_id, parent_id, c.strand, string_agg({_PART}, '' ORDER BY start_pos, end_pos) AS plus FROM d c JOIN fx_sequences s ON s.seq_id = c.seq_id GROUP BY ALL),
coding AS (SELECT seq_id, parent_id, strand, CASE WHEN strand = -1 THEN {sql_revcomp('plus')} ELSE plus END AS coding FROM k)"""


@query("f13_coding_sequences", f"WITH {CODING} SELECT parent_id, coding FROM coding")
def f13(t):
    return M.coding_sequences(t.fx_cds, tiles(t), width=W).select("parent_id", "coding")


@query(
    "n14_extract_and_translate",
    f"""WITH {CODING}, p AS (SELECT *, {sql_protein("coding")} AS protein FROM coding)
    SELECT parent_id, coding, protein, CASE WHEN contains(coding, 'N') OR contains(substring(protein, 1, length(protein) - 1), '*') THEN 'rejected' ELSE 'conserved' END AS status FROM p""",
)
def n14(t):
    from strandweave.functions.sequence import has_n, is_premature, translate_codons

    rows = M.coding_sequences(t.fx_cds, tiles(t), width=W).withColumn("protein", translate_codons("coding"))
    return rows.select("parent_id", "coding", "protein", F.when(has_n("coding") | is_premature("protein"), "rejected").otherwise("conserved").alias("status"))


@query("f17_status_counts", f"WITH {CODING} SELECT CASE WHEN contains(coding, 'N') THEN 'rejected' ELSE 'conserved' END AS status, count(*) AS n FROM coding GROUP BY 1")
def f17(t):
    rows = M.coding_sequences(t.fx_cds, tiles(t), width=W)
    return rows.groupBy(F.when(F.contains("coding", F.lit("N")), "rejected").otherwise("conserved").alias("status")).agg(F.count("*").alias("n"))


MERGED = f"{_islands_sql('fx_cds', 'seq_id', 1)}, m AS (SELECT seq_id, min(start_pos) AS s, max(end_pos) AS e FROM b GROUP BY seq_id, island)"
MASKED = f"""{MERGED}, x AS (SELECT seq_id, s, e, coalesce(lag(e) OVER (PARTITION BY seq_id ORDER BY s), 0) AS pe FROM m),
y AS (SELECT q.seq_id, residues, string_agg(concat(substring(residues, CAST(pe + 1 AS INT), CAST(s - pe - 1 AS INT)), repeat('N', CAST(e - s + 1 AS INT))), '' ORDER BY s) AS head, max(e) AS e, max(s - pe - 1) AS gap FROM fx_sequences q JOIN x ON x.seq_id = q.seq_id GROUP BY q.seq_id, residues),
masked AS (SELECT q.seq_id, q.residues AS before, CASE WHEN y.head IS NULL THEN q.residues ELSE concat(y.head, substring(q.residues, CAST(y.e + 1 AS INT))) END AS after, CASE WHEN y.head IS NULL THEN length(q.residues)::BIGINT ELSE greatest(gap, length(q.residues) - y.e) END AS longest_clean FROM fx_sequences q LEFT JOIN y ON y.seq_id = q.seq_id)"""


@query("n12_mask_sequences", f"WITH {MASKED} SELECT seq_id, after AS masked FROM masked")
def n12(t):
    rows = M.mask_tiles(tiles(t), t.fx_cds, width=W)
    whole = rows.groupBy("seq_id").agg(F.sort_array(F.collect_list(F.struct("tile_no", "residues"))).alias("p"))
    return whole.select("seq_id", F.array_join(F.transform("p", lambda p: p["residues"]), "").alias("masked"))


_N = "length({0}) - length(replace({0}, 'N', ''))"
STATS = f"""{MASKED}, stats AS (SELECT seq_id, length(before)::BIGINT AS length, ({_N.format('before')})::BIGINT AS already, ({_N.format('after')} - ({_N.format('before')}))::BIGINT AS newly,
({_N.format('after')})::BIGINT AS total, round(({_N.format('after')}) * 100 / length(before), 2) AS percent, longest_clean FROM masked)"""


def stats(t):
    return M.mask_stats(tiles(t), M.mask_tiles(tiles(t), t.fx_cds, width=W), t.fx_cds)


@query("f7_mask_stats", f"WITH {STATS} SELECT * FROM stats")
def f7(t):
    return stats(t)


@query("d12_usable_masked", f"WITH {STATS} SELECT seq_id FROM stats WHERE percent < 100 AND longest_clean > 500")
def d12(t):
    return M.usable(stats(t)).select("seq_id")


@query("b5_masking_regions", f"WITH {MERGED} SELECT seq_id, concat(s::VARCHAR, chr(9), e::VARCHAR) AS line FROM m")
def b5(t):
    merged = I.merge_intervals(t.fx_cds, ["seq_id"])
    return merged.select("seq_id", F.concat_ws("\t", F.col("start_pos").cast("string"), F.col("end_pos").cast("string")).alias("line"))


KMERS = """km AS (SELECT seq_id, i - 1 AS pos, substring(residues, CAST(i AS INT), 6) AS mer FROM (SELECT seq_id, residues, unnest(range(1, length(residues) - 4)) AS i FROM fx_sequences)),
kn AS (SELECT seq_id, pos, mer, n FROM km JOIN (SELECT mer, count(*) AS n FROM km GROUP BY mer) USING (mer))"""


def kmers(t, strand="f"):
    return M.kmer_counts(M.to_tiles(t.fx_sequences, W, 5), 6, strand)


_BOTH_STRANDS = f"""{KMERS}, rc AS (SELECT seq_id, pos, {sql_revcomp("mer")} AS mer FROM km), kb AS (SELECT seq_id, pos, '+' AS strand, mer, n FROM kn
UNION ALL SELECT seq_id, pos, '-', mer, n FROM rc JOIN (SELECT mer, count(*) AS n FROM km GROUP BY mer) USING (mer))"""


@query("f8_kmer_counts", f"WITH {KMERS} SELECT seq_id, pos, mer, n FROM kn")
def f8(t):
    return kmers(t).select("seq_id", "pos", "mer", "n")


@query("f8_kmer_counts_of_both_strands", f"WITH {_BOTH_STRANDS} SELECT seq_id, strand, count(*) AS places, sum(n)::BIGINT AS total, max(n) AS most FROM kb GROUP BY seq_id, strand")
def f8_both(t):
    return kmers(t, "fp").groupBy("seq_id", "strand").agg(F.count("*").alias("places"), F.sum("n").alias("total"), F.max("n").alias("most"))


@query("d11_frequent_kmers", f"WITH {KMERS} SELECT seq_id, pos, n FROM kn WHERE n >= 280 AND pos > 0")
def d11(t):
    return kmers(t).where("n >= 280 and pos > 0").select("seq_id", "pos", "n")


@query(
    "n13_kmer_mask_regions",
    f"""WITH {KMERS}, o AS (SELECT seq_id, pos + 1 AS start_pos, pos + 6 AS end_pos FROM kn WHERE n >= 280 AND pos > 0), {_islands_sql("o", "seq_id", 1)}
    SELECT seq_id, min(start_pos) AS start_pos, max(end_pos) AS end_pos, count(*) AS n FROM b GROUP BY seq_id, island""",
)
def n13(t):
    return M.kmer_regions(kmers(t), 280, 6)


@query("b6_kmer_track", f"WITH {_BOTH_STRANDS}, al AS (SELECT seq_id, pos, unnest(['+', '-']) AS strand FROM km) SELECT al.seq_id, al.strand, al.pos, CASE WHEN n >= 280 THEN round(log10(n), 5) ELSE -0.1::DOUBLE END AS value FROM al LEFT JOIN kb ON kb.seq_id = al.seq_id AND kb.pos = al.pos AND kb.strand = al.strand")
def b6(t):
    return M.kmer_track_of_tiles(M.to_tiles(t.fx_sequences, W, 5), 6, 280)


PAIRS = """pairs AS (SELECT DISTINCT x.parent_id, v.evidence_id, v.category, v.db FROM fx_exons x JOIN fx_evidence v
ON x.seq_id = v.seq_id AND x.strand = v.strand AND x.start_pos < v.end_pos AND x.end_pos > v.start_pos)"""


@query("f10_evidence_summary", f"WITH {PAIRS} SELECT parent_id, count(DISTINCT evidence_id) AS n_features, count(DISTINCT (category, db)) AS n_sources FROM pairs GROUP BY parent_id")
def f10(t):
    return G.evidence_summary(t.fx_exons, t.fx_evidence)


@query("f11_expressed", f"WITH {PAIRS} SELECT x.parent_id, bool_or(coalesce(db = 'db1', FALSE)) AS expressed FROM fx_exons x LEFT JOIN pairs p ON p.parent_id = x.parent_id GROUP BY x.parent_id")
def f11(t):
    return G.expressed(t.fx_exons, t.fx_evidence, ["db1"])


@query(
    "n4_filter_by_evidence",
    f"""WITH {PAIRS}, c AS (SELECT parent_id, count(DISTINCT evidence_id) AS n_features, count(DISTINCT (category, db)) AS n_sources FROM pairs GROUP BY parent_id)
    SELECT model_id, m.start_pos, n_features, n_sources FROM fx_models m JOIN c ON c.parent_id = model_id WHERE identity >= 35""",
)
def n4(t):
    return G.filter_by_evidence(t.fx_models, t.fx_exons, t.fx_evidence, t.fx_models.select("model_id", "identity")).select("model_id", "start_pos", "n_features", "n_sources")


@query("d16_without_evidence", f"WITH {PAIRS} SELECT model_id FROM fx_models WHERE model_id NOT IN (SELECT parent_id FROM pairs) OR identity < 35")
def d16(t):
    kept = G.filter_by_evidence(t.fx_models, t.fx_exons, t.fx_evidence, t.fx_models.select("model_id", "identity"))
    return t.fx_models.join(kept, "model_id", "left_anti").select("model_id")


SCORED = f"""scored AS (SELECT *, CAST(2 * hit_coverage + CASE WHEN hit_coverage > 100 THEN {L.HIT_OVER_100} ELSE 0 END
+ CASE WHEN query_coverage > 100 THEN {L.QUERY_OVER_100} WHEN query_coverage <= 70 THEN -{L.QUERY_BELOW_70} ELSE query_coverage END + identity
+ (start_pos % (n_exons + 2)) * 100 / (n_exons + 1) + CASE WHEN start_pos % (n_exons + 2) = n_exons + 1 THEN {L.ALL_VALID} ELSE 0 END
- CASE WHEN identity % 5 = 0 THEN {L.PARTIAL} ELSE 0 END - CASE WHEN identity % 7 = 0 THEN {L.WRONG_SPLICE} ELSE 0 END + CASE WHEN file_level = 0 THEN {L.CURATED} ELSE 0 END AS DOUBLE) AS score FROM fx_models)"""


def scored(t):
    figures = t.fx_models.withColumns({"n_sites": F.col("n_exons") + 1, "n_valid": F.col("start_pos") % (F.col("n_exons") + 2), "partially_sequenced": F.col("identity") % 5 == 0, "wrong_splice": F.col("identity") % 7 == 0})
    return G.score(figures)


@query("n2_score_models", f"WITH {SCORED} SELECT model_id, round(score, 4) AS score FROM scored")
def n2(t):
    return scored(t).select("model_id", F.round("score", 4).alias("score"))


@query("f12_validation_score", "SELECT model_id, round((start_pos % (n_exons + 2)) * 100 / (n_exons + 1) + CASE WHEN start_pos % (n_exons + 2) = n_exons + 1 THEN 200 ELSE 0 END, 4) AS score FROM fx_models")
def f12(t):
    return t.fx_models.select("model_id", F.round(G.validation_score(F.col("start_pos") % (F.col("n_exons") + 2), F.col("n_exons") + 1), 4).alias("score"))


@query("h5_models_by_coverage", "SELECT seq_id, model_id, row_number() OVER (PARTITION BY seq_id ORDER BY hit_coverage DESC, file_level, start_pos, end_pos, model_id)::INT AS place FROM fx_models")
def h5(t):
    return G.top_of_locus(t.fx_models, ["seq_id"]).select("seq_id", "model_id", "place")


#: A locus is a list of its models in order; each round takes the first model's winner and what that overlaps out of the list.
_OVER = "x.start_pos < {0}.end_pos AND x.end_pos > {0}.start_pos"


@query(
    "n1_select_gene_models",
    f"""WITH RECURSIVE {SCORED}, {_islands_sql("scored", "seq_id", 0)},
    ranked AS (SELECT seq_id, island, struct_pack(model_id := model_id, file_level := file_level, start_pos := start_pos, end_pos := end_pos, score := score,
      by_score := row_number() OVER (PARTITION BY seq_id ORDER BY score DESC, hit_coverage DESC, file_level, start_pos, end_pos, model_id),
      by_coverage := row_number() OVER (PARTITION BY seq_id ORDER BY hit_coverage DESC, file_level, start_pos, end_pos, model_id),
      place := row_number() OVER (PARTITION BY seq_id ORDER BY file_level, start_pos, end_pos, model_id)) AS m FROM b),
    r AS (SELECT seq_id, island, list(m ORDER BY m.place) AS alive, list(m ORDER BY m.place)[0] AS winner FROM ranked GROUP BY seq_id, island
    UNION ALL SELECT seq_id, island, list_filter(alive, lambda x: NOT ({_OVER.format("winner")}) AND x.place <> winner.place AND x.place <> seed.place) AS alive, winner
    FROM (SELECT *, CASE WHEN best.score > 0 THEN best ELSE list_filter(near, lambda x: x.by_coverage = list_min(list_transform(near, lambda y: y.by_coverage)))[1] END AS winner
    FROM (SELECT *, list_filter(near, lambda x: x.by_score = list_min(list_transform(near, lambda y: y.by_score)))[1] AS best
    FROM (SELECT seq_id, island, alive, alive[1] AS seed, list_filter(alive, lambda x: ({_OVER.format("alive[1]")}) OR x.place = alive[1].place) AS near FROM r WHERE len(alive) > 0))))
    SELECT seq_id, winner.model_id, winner.file_level::INT AS file_level, winner.start_pos, winner.end_pos, winner.score FROM r WHERE winner IS NOT NULL""",
)
def n1(t):
    return G.select_models(scored(t))


VALID = f"""{GENES}, pv AS (SELECT * FROM fx_evidence WHERE category = 'proteicEvidences'),
sa AS (SELECT DISTINCT g.parent_id FROM g JOIN pv v ON g.seq_id = v.seq_id AND g.strand = v.strand AND abs(g.start_pos - v.start_pos) <= 21 AND (g.start_pos - v.start_pos) % 3 = 0),
sb AS (SELECT DISTINCT g.parent_id FROM g JOIN pv v ON g.seq_id = v.seq_id AND g.strand = v.strand AND abs(g.end_pos - v.end_pos) <= 21 AND (g.end_pos - v.end_pos) % 3 = 0),
i AS (SELECT * FROM (SELECT seq_id, strand, parent_id, end_pos AS d, lead(start_pos) OVER (PARTITION BY seq_id, strand, parent_id ORDER BY start_pos, end_pos) AS a FROM fx_exons) WHERE a IS NOT NULL),
v AS (SELECT DISTINCT seq_id, strand, d, a FROM (SELECT seq_id, strand, end_pos AS d, lead(start_pos) OVER (PARTITION BY seq_id, strand, evidence_id ORDER BY start_pos, end_pos) AS a FROM fx_evidence) WHERE a IS NOT NULL),
sp AS (SELECT parent_id, count(*) AS n, count(v.d) AS ok FROM i LEFT JOIN v ON i.seq_id = v.seq_id AND i.strand = v.strand AND i.d = v.d AND i.a = v.a GROUP BY parent_id),
r AS (SELECT g.parent_id, (sa.parent_id IS NOT NULL)::INT AS a, (sb.parent_id IS NOT NULL)::INT AS b, coalesce(n, 0) AS n, coalesce(ok, 0) AS ok FROM g LEFT JOIN sa ON sa.parent_id = g.parent_id LEFT JOIN sb ON sb.parent_id = g.parent_id LEFT JOIN sp ON sp.parent_id = g.parent_id),
val AS (SELECT parent_id, n + 2 AS n_sites, (a + b + ok)::BIGINT AS n_valid, concat_ws(',', CASE WHEN a = 0 THEN 'start' END, CASE WHEN b = 0 THEN 'end' END, CASE WHEN ok < n THEN 'splice' END) AS warnings FROM r)"""


@query("n8_validate_models", f"WITH {VALID} SELECT *, CASE WHEN warnings <> '' THEN 'Low Confidence' WHEN n_sites % 2 = 0 THEN 'Medium Confidence' ELSE 'High Confidence' END AS trust FROM val")
def n8(t):
    rows = G.validate(genes(t), t.fx_exons, t.fx_evidence)
    return rows.withColumn("trust", G.trust(F.col("warnings"), F.col("n_sites") % 2 == 0))


_SIDES = "left_ AS (SELECT c.*, substring(residues, CAST(donor_end + 1 AS INT), 2) AS l, substring(residues, CAST(acceptor_start - 2 AS INT), 2) AS r FROM gaps c JOIN fx_sequences s ON s.seq_id = c.seq_id)"
SITES = f"""dd AS (SELECT seq_id, parent_id, strand, end_pos AS donor_end, lead(start_pos) OVER (PARTITION BY seq_id, parent_id, strand ORDER BY start_pos, end_pos) AS acceptor_start FROM fx_cds),
gaps AS (SELECT DISTINCT *, acceptor_start - donor_end - 1 AS intron_len FROM dd WHERE acceptor_start - donor_end - 1 >= 0), {_SIDES},
ss AS (SELECT *, CASE WHEN strand = -1 THEN {sql_revcomp('r')} ELSE l END AS donor, CASE WHEN strand = -1 THEN {sql_revcomp('l')} ELSE r END AS acceptor FROM left_),
sites AS (SELECT *, CASE WHEN regexp_matches(donor, '^G[T|C]$') AND acceptor = 'AG' THEN 'good' WHEN contains(donor, 'N') OR contains(acceptor, 'N') THEN 'partially_sequenced' ELSE 'wrong_splice' END AS site FROM ss)"""


@query("g6_splice_sites", f"WITH {SITES} SELECT parent_id, donor_end, acceptor_start, donor, acceptor, site FROM sites")
def g6_sites(t):
    return G.splice_sites(t.fx_cds, tiles(t), width=W).select("parent_id", "donor_end", "acceptor_start", "donor", "acceptor", "site")


@query(
    "n7_annotate_structure",
    f"""WITH {CODING}, {SITES}, p AS (SELECT *, {sql_protein("coding")} AS protein FROM coding),
    w AS (SELECT parent_id, count(*) FILTER (site = 'wrong_splice') AS wrong, count(*) FILTER (site = 'wrong_splice' AND intron_len <= 10) AS small, count(*) FILTER (site = 'partially_sequenced') AS unsure FROM sites GROUP BY parent_id),
    z AS (SELECT p.*, len(regexp_extract_all(substring(protein, 1, length(protein) - 1), '[*#+]'))::INT AS internal_stops, coalesce(wrong, 0) AS wrong, coalesce(small, 0) AS small, coalesce(unsure, 0) AS unsure FROM p LEFT JOIN w ON w.parent_id = p.parent_id)
    SELECT seq_id, parent_id, internal_stops, contains(coding, 'N') OR unsure > 0 AS partially_sequenced, wrong > 0 AS wrong_splice, protein NOT LIKE 'M%' AS no_methionine, internal_stops > 0 OR small > 0 AS pseudogene FROM z""",
)
def n7(t):
    return G.annotate_structure(t.fx_cds, tiles(t), width=W)


@query(
    "f23_tag_map",
    """WITH k AS (SELECT parent_id, concat('tag', file_level::VARCHAR) AS tag, list_sort(list_distinct(list((start_pos % 3)::VARCHAR))) AS v FROM (SELECT * REPLACE ((start_pos % 2)::INT AS file_level) FROM fx_exons) GROUP BY ALL)
    SELECT parent_id, string_agg(concat(tag, '=', array_to_string(v, ',')), ';' ORDER BY tag) AS tags FROM k GROUP BY parent_id""",
)
def f23(t):
    from strandweave.functions.text import render_attributes

    tags = t.fx_exons.select("parent_id", F.concat(F.lit("tag"), (F.col("start_pos") % 2).cast("string")).alias("tag"), (F.col("start_pos") % 3).cast("string").alias("value"))
    return G.tag_map(tags).select("parent_id", render_attributes(F.col("tags")).alias("tags"))


def predictions(t):
    """Exons of odd genes as match and match_part, of even ones as gene and exon."""
    g = genes(t).withColumns({"type": F.when(F.col("strand") == -1, "match").otherwise("gene"), "id": F.col("parent_id"), "parent": F.lit(None).cast("string")})
    x = t.fx_exons.withColumns({"type": F.when(F.col("strand") == -1, "match_part").otherwise("exon"), "id": F.col("feature_id"), "parent": F.col("parent_id")})
    columns = ["seq_id", "type", "id", "parent", "start_pos", "end_pos", "strand"]
    return g.select(*columns).unionByName(x.select(*columns))


@query(
    "n3_build_cds",
    f"""WITH {GENES} SELECT seq_id, 'gene' AS type, parent_id AS id, NULL::VARCHAR AS parent, start_pos, end_pos, strand FROM g
    UNION ALL SELECT seq_id, 'mRNA', concat(parent_id, '_mRNA'), parent_id, start_pos, end_pos, strand FROM g WHERE strand = -1
    UNION ALL SELECT seq_id, 'exon', CASE WHEN strand = -1 THEN concat(feature_id, '_exon') ELSE feature_id END, CASE WHEN strand = -1 THEN concat(parent_id, '_mRNA') ELSE parent_id END, start_pos, end_pos, strand FROM fx_exons
    UNION ALL SELECT seq_id, 'polypeptide', concat(feature_id, '_poly'), concat(parent_id, '_mRNA'), start_pos, end_pos, strand FROM fx_exons WHERE strand = -1""",
)
def n3(t):
    return G.build_cds(predictions(t))


@query(
    "n11_annotated_models",
    f"""WITH {GENES}, w AS (SELECT model_id FROM fx_models WHERE hit_coverage > 60), f AS (SELECT seq_id, parent_id AS model_id, 'exon' AS type, start_pos, end_pos, strand FROM fx_exons UNION ALL SELECT seq_id, parent_id, 'mRNA', start_pos, end_pos, strand FROM g WHERE file_level = 0),
    k AS (SELECT f.* FROM f JOIN w USING (model_id)), made AS (SELECT seq_id, model_id, 'mRNA' AS type, min(start_pos) AS start_pos, max(end_pos) AS end_pos, strand FROM k GROUP BY seq_id, model_id, strand HAVING NOT bool_or(type = 'mRNA')),
    u AS (SELECT * FROM k UNION ALL SELECT * FROM made)
    SELECT seq_id, model_id, type, start_pos, end_pos, strand, 'GENEMODEL' AS source, 'TOOL' AS original_source, CASE WHEN type = 'mRNA' THEN concat('score=', (SELECT identity::VARCHAR FROM fx_models m WHERE m.model_id = u.model_id)) END AS tag_text FROM u""",
)
def n11(t):
    columns = ["seq_id", "model_id", "type", "start_pos", "end_pos", "strand"]
    rows = t.fx_exons.select("seq_id", F.col("parent_id").alias("model_id"), F.lit("exon").alias("type"), "start_pos", "end_pos", "strand")
    rows = rows.unionByName(genes(t).where("file_level = 0").select("seq_id", F.col("parent_id").alias("model_id"), F.lit("mRNA").alias("type"), "start_pos", "end_pos", "strand")).withColumn("source", F.lit("TOOL"))
    tags = t.fx_models.select("model_id", F.concat(F.lit("score="), F.col("identity").cast("string")).alias("tag_text"))
    return G.annotated_models(t.fx_models.where("hit_coverage > 60"), rows, tags).select(*columns, "source", "original_source", "tag_text")


@query("f16_boundaries", "SELECT parent_id, CASE WHEN start_pos % 2 = 0 THEN 'exon' ELSE 'UTR' END AS type, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM fx_exons GROUP BY ALL")
def f16(t):
    return X.feature_boundaries(t.fx_exons.withColumn("type", F.when(F.col("start_pos") % 2 == 0, "exon").otherwise("UTR")), ["parent_id"])


@query(
    "f24_segments",
    """WITH k AS (SELECT *, CASE WHEN start_pos % 3 = 0 THEN 'C' WHEN start_pos % 3 = 1 THEN '5' END AS c FROM fx_exons)
    SELECT parent_id, strand, CASE WHEN strand = -1 THEN string_agg(concat(start_pos::VARCHAR, '-', end_pos::VARCHAR, c), ' ' ORDER BY start_pos DESC, end_pos DESC, c DESC) ELSE string_agg(concat(start_pos::VARCHAR, '-', end_pos::VARCHAR, c), ' ' ORDER BY start_pos, end_pos, c) END AS segments
    FROM k WHERE c IS NOT NULL GROUP BY parent_id, strand""",
)
def f24(t):
    kind = F.when(F.col("start_pos") % 3 == 0, "CDS").when(F.col("start_pos") % 3 == 1, "five_prime_UTR").otherwise("other")
    rows = X.segments(t.fx_exons.withColumn("type", kind), ["parent_id"], {"CDS": "C", "five_prime_UTR": "5"})
    return rows.select("parent_id", "strand", F.array_join(F.transform("segments", lambda s: F.concat(s["start_pos"].cast("string"), F.lit("-"), s["end_pos"].cast("string"), s["class"])), " ").alias("segments"))


#: Sequences and models on the axis of their strand; codons upstream and downstream are lists from the model's ends on.
REPAIRED = f"""{CODING}, ends AS (SELECT seq_id, parent_id, strand, min(start_pos) AS low, max(end_pos) AS high, arg_min(end_pos - start_pos + 1, start_pos * strand) AS first_len FROM d GROUP BY ALL),
ax AS (SELECT e.seq_id, e.parent_id, e.strand, low, high, length(residues) AS n, upper(CASE WHEN e.strand <> -1 THEN residues ELSE {sql_revcomp("residues")} END) AS s,
  CASE WHEN e.strand <> -1 THEN low ELSE length(residues) - high + 1 END AS a, CASE WHEN e.strand <> -1 THEN high ELSE length(residues) - low + 1 END AS b,
  (CASE WHEN first_len - 12 <= 6 THEN greatest(0, first_len - 6) ELSE 12 END) // 3 * 3 AS inside, {sql_protein("coding")} AS protein
  FROM ends e JOIN fx_sequences q ON q.seq_id = e.seq_id JOIN coding c ON c.parent_id = e.parent_id AND c.seq_id = e.seq_id),
cd AS (SELECT *, protein LIKE 'M%' AS has_start, protein LIKE '%*' AS has_stop,
  list_transform(range(0, (least(600, a - 1) + inside) // 3 + 1), lambda k: substring(s, CAST(a + inside - 3 * k AS INT), 3)) AS ups,
  list_transform(range(0, least(600, n - b) // 3), lambda k: substring(s, CAST(b + 1 + 3 * k AS INT), 3)) AS downs FROM ax),
wh AS (SELECT *, list_position(ups, 'ATG') AS atg, list_min(list_filter([list_position(ups, 'TAA'), list_position(ups, 'TAG'), list_position(ups, 'TGA')], lambda x: x > 0)) AS bar,
  list_min(list_filter([list_position(downs, 'TAA'), list_position(downs, 'TAG'), list_position(downs, 'TGA')], lambda x: x > 0)) AS stop FROM cd),
sh AS (SELECT *, CASE WHEN NOT has_start AND atg > 0 AND (bar IS NULL OR atg < bar) THEN (atg - 1) * 3 - inside END AS start_shift, CASE WHEN NOT has_stop THEN stop * 3 END AS stop_shift,
  (NOT has_start AND len(list_filter(ups[1:least(CASE WHEN atg > 0 THEN atg ELSE len(ups) END, coalesce(bar, len(ups)))], lambda c: contains(c, 'N'))) > 0)
  OR (NOT has_stop AND len(list_filter(downs[1:coalesce(stop, len(downs))], lambda c: contains(c, 'N'))) > 0) AS unsure FROM wh),
repaired AS (SELECT parent_id, strand, (CASE WHEN strand <> -1 THEN low - coalesce(start_shift, 0) ELSE low - coalesce(stop_shift, 0) END)::BIGINT AS start_pos,
  (CASE WHEN strand <> -1 THEN high + coalesce(stop_shift, 0) ELSE high + coalesce(start_shift, 0) END)::BIGINT AS end_pos, start_shift::BIGINT AS start_shift, stop_shift::BIGINT AS stop_shift, unsure FROM sh)"""


def repaired(t, parts=None):
    lengths = t.fx_sequences.select("seq_id", F.length("residues").cast("long").alias("length"))
    return G.repair_start_stop(t.fx_cds if parts is None else parts, tiles(t), lengths, width=W)


@query("n6_repair_start_stop", f"WITH {REPAIRED} SELECT * FROM repaired")
def n6(t):
    return repaired(t)


@query(
    "n6_apply_repairs",
    f"""WITH {REPAIRED}, ft AS (SELECT parent_id, NULL::VARCHAR AS transcript_id, 'gene' AS type, low - 30 AS start_pos, high + 30 AS end_pos FROM ends
    UNION ALL SELECT parent_id, concat(parent_id, '_t'), 'mRNA', low - 30, high + 30 FROM ends UNION ALL SELECT parent_id, concat(parent_id, '_t'), 'polypeptide', start_pos, end_pos FROM d
    UNION ALL SELECT parent_id, concat(parent_id, '_t'), 'intron', low, high FROM ends),
    kx AS (SELECT ft.*, row_number() OVER w AS k, count(*) OVER (PARTITION BY ft.parent_id, transcript_id, type) AS n FROM ft WINDOW w AS (PARTITION BY ft.parent_id, transcript_id, type ORDER BY start_pos, end_pos))
    SELECT kx.parent_id, transcript_id, type, CASE WHEN type <> 'intron' AND k = 1 AND CASE WHEN strand <> -1 THEN start_shift ELSE stop_shift END IS NOT NULL THEN r.start_pos ELSE kx.start_pos END AS start_pos,
    CASE WHEN type <> 'intron' AND k = n AND CASE WHEN strand <> -1 THEN stop_shift ELSE start_shift END IS NOT NULL THEN r.end_pos ELSE kx.end_pos END AS end_pos FROM kx LEFT JOIN repaired r ON r.parent_id = kx.parent_id""",
)
def n6_apply(t):
    # A row for each model with its distinct parts, written once for the repairs and the features; these are made of it in
    # as many tasks as the lines ask for, since a model has several.
    models = t.fx_cds.groupBy("seq_id", "parent_id", "strand").agg(F.sort_array(F.collect_set(F.struct("start_pos", "end_pos"))).alias("parts"))
    models = written(models, "models")
    row = lambda kind, start, end, own=True: F.struct((F.concat("parent_id", F.lit("_t")) if own else F.lit(None).cast("string")).alias("transcript_id"), F.lit(kind).alias("type"), start.alias("start_pos"), end.alias("end_pos"))
    low, high = F.array_min(F.transform("parts", lambda p: p["start_pos"])), F.array_max(F.transform("parts", lambda p: p["end_pos"]))
    whole = F.array(row("gene", low - 30, high + 30, False), row("mRNA", low - 30, high + 30), row("intron", low, high))
    features = models.repartition(shares(t.lineitem), "parent_id").select("parent_id", F.inline(F.concat(whole, F.transform("parts", lambda p: row("polypeptide", p["start_pos"], p["end_pos"])))))
    return G.apply_repairs(features, repaired(t, models.select("seq_id", "parent_id", "strand", F.inline("parts"))))

"""Queries on transcripts, chunks, annotations of features, hints and run reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandweave.functions import lookups as L
from strandweave.functions import text as T
from strandweave.operators import features as X
from strandweave.operators import functional as A
from strandweave.operators import intervals as I
from strandweave.operators import runs as R
from strandweave.operators import stitching as C
from strandweave.operators import transcripts as S
from strandweave.operators.graph import written
from strandweave.operators.masking import to_tiles

from .expression_queries import _sql_so, sql_protein, sql_revcomp
from .interval_queries import GENES, _islands_sql, genes
from .registry import query

#: Tiles are narrow, so that features of the short test sequences cross them.
WIDTH = 100

FIGURES = """u AS (SELECT DISTINCT query_id, hit_id, strand, q_start, q_end, h_start, h_end, first_value(n_identical) OVER w AS n_identical, first_value(align_len) OVER v AS align_len, query_len FROM fx_hsps
WINDOW w AS (PARTITION BY query_id, hit_id, strand, q_start, q_end, h_start, h_end ORDER BY n_identical), v AS (PARTITION BY query_id, hit_id, strand, q_start, q_end, h_start, h_end ORDER BY align_len)),
s AS (SELECT *, coalesce(greatest(0, q_end - lead(q_start) OVER (PARTITION BY query_id, hit_id, strand ORDER BY q_start, q_end) + 1), 0) AS shared FROM u),
f AS (SELECT query_id, hit_id, strand, floor((sum(n_identical) * 20000 + sum(align_len)) / (sum(align_len) * 2)) / 10000 AS identity, floor((sum(q_end - q_start + 1 - shared) * 20000 + min(query_len)) / (min(query_len) * 2)) / 10000 AS coverage FROM s GROUP BY ALL),
good AS (SELECT * FROM f WHERE identity >= 0.75 AND coverage >= 0.25)"""


def single_hsps(t):
    """One alignment for each set of coordinates."""
    from strandweave.operators.hits import distinct_alignments

    return distinct_alignments(t.fx_hsps)


@query(
    "n27_map_transcripts",
    f"""WITH {FIGURES}, k AS (SELECT concat_ws('_', query_id, hit_id, strand::VARCHAR) AS id, h_start, h_end, identity, coverage FROM u JOIN good USING (query_id, hit_id, strand))
    SELECT id, 'mRNA' AS type, min(h_start) AS start_pos, max(h_end) AS end_pos, identity, coverage, count(*) AS n_exons FROM k GROUP BY id, identity, coverage
    UNION ALL SELECT id, 'exon', h_start, h_end, NULL, NULL, NULL FROM k""",
)
def n27(t):
    return S.map_transcripts(single_hsps(t), 0.75, 0.25)


@query("d14_mapped_keep", f"WITH {FIGURES} SELECT query_id, hit_id, strand FROM good")
def d14(t):
    from strandweave.operators.hits import mapped_figures

    return mapped_figures(single_hsps(t)).where("identity >= 0.75 and coverage >= 0.25").select("query_id", "hit_id", "strand")


OFFSETS = """o AS (SELECT *, coalesce(sum(end_pos - start_pos + 1) OVER (PARTITION BY parent_id ORDER BY start_pos * strand, end_pos * strand ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off, end_pos - start_pos + 1 AS size FROM fx_exons),
orf AS (SELECT parent_id, min(start_pos) % 60 + 1 AS orf_start, sum(end_pos - start_pos + 1)::BIGINT - max(end_pos) % 40 AS orf_end FROM fx_exons WHERE file_level <> 2 GROUP BY parent_id)"""


def orfs(t):
    rows = t.fx_exons.where("file_level <> 2").groupBy("parent_id")
    return rows.agg((F.min("start_pos") % 60 + 1).alias("orf_start"), (F.sum(F.col("end_pos") - F.col("start_pos") + 1) - F.max("end_pos") % 40).alias("orf_end"))


@query(
    "n21_split_utr_cds",
    f"""WITH {OFFSETS}, p AS (SELECT o.*, orf_start - 1 - off AS a, orf_end - off AS b FROM o JOIN orf USING (parent_id)),
    x AS (SELECT parent_id, seq_id, strand, start_pos, end_pos, 'five_prime_UTR' AS type, 0 AS f, least(a, size) AS u FROM p
    UNION ALL SELECT parent_id, seq_id, strand, start_pos, end_pos, 'polypeptide', greatest(a, 0), least(b, size) FROM p
    UNION ALL SELECT parent_id, seq_id, strand, start_pos, end_pos, 'three_prime_UTR', greatest(b, 0), size FROM p)
    SELECT parent_id, seq_id, strand, type, CASE WHEN strand <> -1 THEN start_pos + f ELSE end_pos - u + 1 END AS start_pos, CASE WHEN strand <> -1 THEN start_pos + u - 1 ELSE end_pos - f END AS end_pos FROM x WHERE f < u""",
)
def n21(t):
    return S.split_utr_cds(t.fx_exons, orfs(t))


@query("e17_orf_exons", "SELECT x.parent_id, x.feature_id FROM fx_exons x WHERE x.file_level <> 2")
def e17(t):
    return t.fx_exons.join(orfs(t), "parent_id").select("parent_id", "feature_id")


#: Islands of exons, and each transcript with its own name as label.
_LINKS = """il AS (SELECT DISTINCT parent_id, concat_ws(':', seq_id, strand::VARCHAR, island::VARCHAR) AS isle FROM (SELECT *, sum(CASE WHEN before IS NULL OR start_pos > before THEN 1 ELSE 0 END) OVER (PARTITION BY seq_id, strand ORDER BY start_pos, end_pos ROWS UNBOUNDED PRECEDING) AS island
FROM (SELECT *, max(end_pos) OVER (PARTITION BY seq_id, strand ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM fx_exons))),
n0 AS (SELECT DISTINCT parent_id, parent_id AS label FROM fx_exons)"""


#: Each round gives a transcript the least label on its islands; the last one is the first that changes no label.
@query(
    "n28_cluster_transcripts",
    f"""WITH RECURSIVE {_LINKS}, r AS (SELECT parent_id, label, true AS changed FROM n0
    UNION ALL SELECT parent_id, least(label, near) AS label, bool_or(near < label) OVER () AS changed
    FROM (SELECT il.parent_id, any_value(x.label) AS label, min(m.label) AS near FROM il JOIN r AS x ON x.parent_id = il.parent_id AND x.changed
    JOIN (SELECT isle, min(label) AS label FROM il JOIN r USING (parent_id) GROUP BY isle) m ON m.isle = il.isle GROUP BY il.parent_id))
    SELECT parent_id, label AS cluster FROM r WHERE NOT changed""",
)
def n28(t):
    return S.cluster_transcripts(t.fx_exons)


_FIGS = """fg AS (SELECT parent_id, concat('c', (min(start_pos) // 2000)::VARCHAR, seq_id) AS cluster, CASE WHEN min(start_pos) % 3 = 0 THEN '5''partial' ELSE 'complete' END AS status,
min(end_pos) % 100 AS coverage, count(*) AS exons, concat('CAT0', (min(start_pos) % 6)::VARCHAR) AS category FROM fx_exons GROUP BY parent_id, seq_id)"""


def figures(t):
    rows = t.fx_exons.groupBy("parent_id", "seq_id").agg(F.min("start_pos").alias("s"), F.min("end_pos").alias("e"), F.count("*").alias("exons"))
    return rows.select("parent_id", F.concat(F.lit("c"), F.floor(F.col("s") / 2000).cast("string"), "seq_id").alias("cluster"), F.when(F.col("s") % 3 == 0, "5'partial").otherwise("complete").alias("status"), (F.col("e") % 100).alias("coverage"), "exons", F.concat(F.lit("CAT0"), (F.col("s") % 6).cast("string")).alias("category"))


_RANK = " ".join(f"WHEN '{k}' THEN {v}" for k, v in L.CATEGORY_RANK.items())


@query(
    "n29_representatives",
    f"""WITH {_FIGS}, r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY coverage DESC, exons DESC, CASE category {_RANK} ELSE 0 END DESC, parent_id) AS k FROM fg WHERE status = 'complete')
    SELECT cluster, parent_id, coverage, exons FROM r WHERE k = 1""",
)
def n29(t):
    f = figures(t)
    return S.representatives(f.select("parent_id", "cluster"), f.drop("cluster"), ["coverage", "exons", "category"]).select("cluster", "parent_id", "coverage", "exons")


@query("g12_representative_order", f"WITH {_FIGS} SELECT cluster, arg_min(parent_id, (-CASE category {_RANK} ELSE 0 END, -coverage, parent_id)) AS parent_id FROM fg GROUP BY cluster")
def g12(t):
    f = figures(t)
    return S.representatives(f.select("parent_id", "cluster"), f.drop("cluster"), ["category", "coverage"], complete_only=False).select("cluster", "parent_id")


@query("d15_complete_candidates", f"WITH {_FIGS} SELECT parent_id FROM fg WHERE status = 'complete'")
def d15(t):
    return figures(t).where("status = 'complete'").select("parent_id")


@query("e18_three_way_join", f"WITH {_FIGS}, {OFFSETS} SELECT parent_id, status, coverage, orf_start, orf_end, start_pos FROM fg JOIN orf USING (parent_id) JOIN (SELECT parent_id, min(start_pos) AS start_pos FROM fx_exons WHERE file_level > 0 GROUP BY parent_id) USING (parent_id)")
def e18(t):
    mapped = t.fx_exons.where("file_level > 0").groupBy("parent_id").agg(F.min("start_pos").alias("start_pos"))
    return S.transcript_figures(mapped, orfs(t), figures(t)).select("parent_id", "status", "coverage", "orf_start", "orf_end", "start_pos")


CHAINS = """l AS (SELECT seq_id, parent_id, file_level, start_pos, concat(end_pos::VARCHAR, '_', lead(start_pos) OVER (PARTITION BY seq_id, parent_id ORDER BY start_pos, end_pos)::VARCHAR) AS j, lead(start_pos) OVER (PARTITION BY seq_id, parent_id ORDER BY start_pos, end_pos) AS nx FROM fx_exons),
ch AS (SELECT seq_id, parent_id, concat('_', string_agg(j, '_' ORDER BY start_pos, j), '_') AS chain FROM l WHERE nx IS NOT NULL GROUP BY seq_id, parent_id)"""


def transcripts(t):
    """A row for each gene, with its exons in order; written, since chains, models and exons are all made of it."""
    rows = t.fx_exons.groupBy("seq_id", "parent_id", "strand").agg(F.sort_array(F.collect_list(F.struct("start_pos", "end_pos"))).alias("exons"))
    return written(rows, "transcripts")


def shifted(rows):
    """Ab-initio models: the genes without their first exon."""
    return rows.select("seq_id", F.concat(F.lit("a"), "parent_id").alias("model_id"), F.substring("parent_id", F.lit(2), F.lit(20)).cast("long").alias("file_order"), F.slice("exons", F.lit(2), F.size("exons")).alias("exons"))


RESCUED = """n AS (SELECT *, row_number() OVER (PARTITION BY seq_id, parent_id ORDER BY start_pos, end_pos) AS k, lead(start_pos) OVER (PARTITION BY seq_id, parent_id ORDER BY start_pos, end_pos) AS nx FROM fx_exons),
    ch AS (SELECT seq_id, parent_id, concat('_', string_agg(concat(end_pos::VARCHAR, '_', nx::VARCHAR), '_' ORDER BY start_pos, concat(end_pos::VARCHAR, '_', nx::VARCHAR)), '_') AS chain FROM n WHERE nx IS NOT NULL GROUP BY seq_id, parent_id),
    ab AS (SELECT seq_id, concat('a', parent_id) AS model_id, CAST(substring(parent_id, 2) AS BIGINT) AS ord, concat('_', string_agg(concat(end_pos::VARCHAR, '_', nx::VARCHAR), '_' ORDER BY start_pos, concat(end_pos::VARCHAR, '_', nx::VARCHAR)), '_') AS wanted FROM n WHERE nx IS NOT NULL AND k > 1 GROUP BY seq_id, parent_id),
    res AS (SELECT parent_id, arg_min(model_id, ord) AS model_id FROM ch JOIN ab ON ch.seq_id = ab.seq_id AND contains(chain, wanted) GROUP BY parent_id)"""


@query("n23_rescue_by_junctions", f"WITH {RESCUED} SELECT parent_id, model_id FROM res")
def n23(t):
    return rescued(transcripts(t))


def rescued(rows):
    return S.rescue_by_junctions(S.chained(rows.select("seq_id", "parent_id", "exons")), S.chained(shifted(rows)))


#: The models' coding parts: the genes' exons but the first.
MODEL_PARTS = f"""{RESCUED}, mp AS (SELECT concat('a', parent_id) AS model_id, start_pos, end_pos FROM n WHERE k > 1)"""


def model_parts(rows):
    return shifted(rows).select("model_id", F.inline("exons"))


@query(
    "n23_take_over_cds",
    f"""WITH {MODEL_PARTS}, sp AS (SELECT model_id, min(start_pos) AS low, max(end_pos) AS high FROM mp GROUP BY model_id),
    ex AS (SELECT x.*, res.model_id FROM fx_exons x JOIN res ON res.parent_id = x.parent_id), {_islands_sql("ex", "seq_id, parent_id, strand", 1)},
    m AS (SELECT seq_id, parent_id, strand, model_id, min(start_pos) AS s, max(end_pos) AS e FROM b GROUP BY seq_id, parent_id, strand, model_id, island),
    pc AS (SELECT seq_id, parent_id, strand, CASE WHEN strand <> -1 THEN 'five_prime_UTR' ELSE 'three_prime_UTR' END AS type, s AS start_pos, least(e, low - 1) AS end_pos, model_id FROM m JOIN sp USING (model_id)
    UNION ALL SELECT seq_id, parent_id, strand, 'polypeptide', greatest(s, low), least(e, high), model_id FROM m JOIN sp USING (model_id)
    UNION ALL SELECT seq_id, parent_id, strand, CASE WHEN strand <> -1 THEN 'three_prime_UTR' ELSE 'five_prime_UTR' END, greatest(s, high + 1), e, model_id FROM m JOIN sp USING (model_id))
    SELECT * FROM pc WHERE start_pos <= end_pos
    UNION ALL SELECT x.seq_id, x.parent_id, x.strand, 'exon', x.start_pos, x.end_pos, NULL FROM fx_exons x LEFT JOIN res ON res.parent_id = x.parent_id WHERE res.parent_id IS NULL""",
)
def n23_cds(t):
    rows = transcripts(t)
    # Dealt as rows of whole transcripts, so that their exons needn't be for the join.
    exons = rows.repartition("parent_id").select("seq_id", "parent_id", "strand", F.lit("exon").alias("type"), F.inline("exons"))
    return S.take_over_cds(exons, rescued(rows), model_parts(rows))


@query(
    "n23_rescued_figures",
    f"""WITH {MODEL_PARTS}, g AS (SELECT parent_id, CASE WHEN min(start_pos) % 3 = 0 THEN '5''partial' ELSE 'complete' END AS status, min(end_pos) % 100 AS aa_length FROM fx_exons GROUP BY parent_id),
    bs AS (SELECT parent_id, sum(end_pos - start_pos + 1) AS bases FROM res JOIN mp USING (model_id) GROUP BY parent_id)
    SELECT g.parent_id, CASE WHEN bases IS NULL THEN status ELSE 'complete' END AS status, (CASE WHEN bases IS NULL THEN aa_length ELSE bases // 3 - 1 END)::BIGINT AS aa_length FROM g LEFT JOIN bs ON bs.parent_id = g.parent_id""",
)
def n23_figures(t):
    rows = transcripts(t)
    start, end = F.array_min(F.transform("exons", lambda x: x["start_pos"])), F.array_min(F.transform("exons", lambda x: x["end_pos"]))
    given = rows.select("parent_id", F.when(start % 3 == 0, "5'partial").otherwise("complete").alias("status"), (end % 100).alias("aa_length"))
    return S.rescued_figures(given, rescued(rows), model_parts(rows))


@query(
    "e8_chain_containment",
    """WITH n AS (SELECT *, row_number() OVER (PARTITION BY seq_id, parent_id ORDER BY start_pos, end_pos) AS k, lead(start_pos) OVER (PARTITION BY seq_id, parent_id ORDER BY start_pos, end_pos) AS nx FROM fx_exons),
    ch AS (SELECT seq_id, parent_id, concat('_', string_agg(concat(end_pos::VARCHAR, '_', nx::VARCHAR), '_' ORDER BY start_pos, concat(end_pos::VARCHAR, '_', nx::VARCHAR)), '_') AS chain FROM n WHERE nx IS NOT NULL GROUP BY seq_id, parent_id),
    ab AS (SELECT seq_id, concat('a', parent_id) AS model_id, concat('_', string_agg(concat(end_pos::VARCHAR, '_', nx::VARCHAR), '_' ORDER BY start_pos, concat(end_pos::VARCHAR, '_', nx::VARCHAR)), '_') AS wanted FROM n WHERE nx IS NOT NULL AND k > 1 GROUP BY seq_id, parent_id)
    SELECT parent_id, model_id FROM ch JOIN ab ON ch.seq_id = ab.seq_id AND contains(chain, wanted)""",
)
def e8(t):
    rows = transcripts(t)
    return S.contained_chains(S.chained(rows.select("seq_id", "parent_id", "exons")), S.chained(shifted(rows))).select("parent_id", "model_id")


def codon_tiles(t):
    """Tiles that share two bases with the next one, and the sequences' lengths."""
    return to_tiles(t.fx_sequences, WIDTH, 2), t.fx_sequences.select("seq_id", F.length("residues").cast("long").alias("length"))


_BOTH = f"SELECT seq_id, length(residues) AS n, 1 AS strand, upper(residues) AS s FROM fx_sequences UNION ALL SELECT seq_id, length(residues), -1, upper({sql_revcomp('residues')}) FROM fx_sequences"


SPANS20 = f"""bo AS ({_BOTH}), fr AS (SELECT *, unnest([0, 1, 2]) AS frame FROM bo), co AS (SELECT seq_id, n, strand, frame, s, (n - frame) // 3 AS m, i, substring(s, CAST(frame + i * 3 + 1 AS INT), 3) AS c FROM (SELECT *, unnest(range(0, (n - frame) // 3)) AS i FROM fr)),
fe AS (SELECT seq_id, n, s, strand, frame, i FROM co WHERE c IN ('TAA', 'TAG', 'TGA') UNION ALL SELECT DISTINCT seq_id, n, s, strand, frame, -1 FROM co UNION ALL SELECT DISTINCT seq_id, n, s, strand, frame, m FROM co),
sp AS (SELECT *, lead(i) OVER (PARTITION BY seq_id, strand, frame ORDER BY i) AS nx FROM fe), gg AS (SELECT seq_id, strand, frame, i FROM co WHERE c = 'ATG'),
ab AS (SELECT *, frame + (i + 1) * 3 + 1 AS a, frame + nx * 3 AS b FROM sp WHERE nx IS NOT NULL),
st AS (SELECT sp.seq_id, sp.n, sp.s, sp.strand, sp.frame, frame_start AS a, sp.frame + nx * 3 AS b FROM (SELECT sp.*, (SELECT min(i) FROM gg WHERE gg.seq_id = sp.seq_id AND gg.strand = sp.strand AND gg.frame = sp.frame AND gg.i > sp.i AND gg.i < sp.nx) * 3 + sp.frame + 1 AS frame_start FROM sp WHERE nx IS NOT NULL) sp WHERE frame_start IS NOT NULL)"""
_PLUS20 = "seq_id, strand, frame, (CASE WHEN strand = 1 THEN a ELSE n - b + 1 END)::BIGINT AS start_pos, (CASE WHEN strand = 1 THEN b ELSE n - a + 1 END)::BIGINT AS end_pos"


@query("n20_scan_orfs", f"WITH {SPANS20} SELECT {_PLUS20}, substring(s, CAST(a AS INT), CAST(b - a + 1 AS INT)) AS orf FROM ab WHERE b - a + 1 BETWEEN 90 AND 1000000")
def n20(t):
    return S.scan_orfs(*codon_tiles(t), 90, width=WIDTH)


@query("n20_orfs_from_start_codons", f"WITH {SPANS20}, x AS (SELECT {_PLUS20}, substring(s, CAST(a AS INT), CAST(b - a + 1 AS INT)) AS s FROM st WHERE strand = 1 AND b - a + 1 BETWEEN 60 AND 600) SELECT seq_id, strand, frame, start_pos, end_pos, {sql_protein('s')} AS orf FROM x")
def n20_starts(t):
    return S.scan_orfs(*codon_tiles(t), 60, 600, mode=1, reverse=False, width=WIDTH)


HITS19 = "h AS (SELECT DISTINCT seq_id, strand, start_pos AS h_start FROM fx_cds)"
FOUND19 = f"""{HITS19}, j AS (SELECT h.*, CASE WHEN strand = -1 THEN upper({sql_revcomp("residues")}) ELSE upper(residues) END AS s, (h_start - 1) % 3 AS frame, (h_start - 1) // 3 AS ats FROM h JOIN fx_sequences q ON q.seq_id = h.seq_id),
pr AS (SELECT * REPLACE (substring(s, CAST(frame + 1 AS INT)) AS s) FROM j), p AS (SELECT *, {sql_protein("s")} AS p FROM pr),
z AS (SELECT *, substring(p, 1, CAST(ats AS INT)) AS bf, substring(p, CAST(ats + 1 AS INT)) AS bh FROM p),
y AS (SELECT *, CASE WHEN contains(bf, '*') THEN length(bf) - instr(reverse(bf), '*') + 1 ELSE 0 END AS fr, instr(bh, '*') AS down FROM z),
x AS (SELECT *, substring(bf, CAST(fr + 1 AS INT)) AS up FROM y), w AS (SELECT *, fr + CASE WHEN contains(up, 'M') THEN instr(up, 'M') - 1 ELSE 0 END AS first, CASE WHEN down > 0 THEN ats + down ELSE length(p) END AS stop FROM x),
found AS (SELECT seq_id, strand, h_start, frame + first * 3 + 1 AS start_pos, frame + stop * 3 AS end_pos, substring(p, CAST(first + 1 AS INT), CAST(stop - first AS INT)) AS protein FROM w WHERE stop > first)"""


def hit_frames(t):
    hits = t.fx_cds.select("seq_id", "strand", F.col("start_pos").alias("h_start")).distinct()
    return S.orfs_from_hits(*codon_tiles(t), hits, WIDTH)


@query("n19_orfs_from_hits", f"WITH {FOUND19} SELECT seq_id, strand, h_start, start_pos::BIGINT AS start_pos, end_pos::BIGINT AS end_pos, protein FROM found")
def n19(t):
    return hit_frames(t)


@query("d13_orf_keep", f"WITH {FOUND19} SELECT seq_id, strand, h_start FROM found WHERE start_pos < end_pos AND 60 + h_start % 41 >= 80 AND length(protein) - (protein LIKE '%*')::INT >= 20 AND NOT contains(substring(protein, 1, length(protein) - 1), '*')")
def d13(t):
    frames = hit_frames(t).withColumn("identity", (F.col("h_start") % 41 + 60) / 100)
    return S.keep_orfs(frames, 0.8, 20).select("seq_id", "strand", "h_start")


@query(
    "a13_orf_headers",
    f"""WITH {FOUND19} SELECT seq_id, h_start, start_pos::BIGINT AS start_pos, end_pos::BIGINT AS end_pos, strand FROM found""",
)
def a13(t):
    from strandweave.sources.reports import parse_orf_headers

    rows = hit_frames(t)
    a, b = F.col("start_pos").cast("string"), F.col("end_pos").cast("string")
    header = F.when(F.col("strand") == -1, F.concat(F.lit("x ["), b, F.lit(" - "), a, F.lit("] (REVERSE SENSE)"))).otherwise(F.concat(F.lit("x ["), a, F.lit(" - "), b, F.lit("]")))
    return parse_orf_headers(rows.select("seq_id", "h_start", header.alias("header"))).select("seq_id", "h_start", "start_pos", "end_pos", "strand")


#: UTR and polypeptide pieces of the genes, as by ``split_utr_cds``.
PIECES = f"""{OFFSETS}, pz AS (SELECT o.*, orf_start - 1 - off AS a, orf_end - off AS b FROM o JOIN orf USING (parent_id)),
xz AS (SELECT parent_id, seq_id, strand, start_pos, end_pos, 'five_prime_UTR' AS type, 0 AS f, least(a, size) AS u FROM pz UNION ALL SELECT parent_id, seq_id, strand, start_pos, end_pos, 'polypeptide', greatest(a, 0), least(b, size) FROM pz
UNION ALL SELECT parent_id, seq_id, strand, start_pos, end_pos, 'three_prime_UTR', greatest(b, 0), size FROM pz),
pieces AS (SELECT seq_id, parent_id, strand, type, CASE WHEN strand <> -1 THEN start_pos + f ELSE end_pos - u + 1 END AS start_pos, CASE WHEN strand <> -1 THEN start_pos + u - 1 ELSE end_pos - f END AS end_pos FROM xz WHERE f < u)"""


@query(
    "n30_expand_gene_features",
    f"""WITH {PIECES}, g AS (SELECT seq_id, parent_id, strand, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM pieces GROUP BY ALL),
    gn AS (SELECT *, lpad((row_number() OVER (PARTITION BY seq_id ORDER BY start_pos, end_pos, parent_id))::VARCHAR, 4, '0') AS num FROM g), ge AS (SELECT *, concat_ws('_', 'TOOL', start_pos, end_pos, 'gene', num) AS gene FROM gn),
    w AS (SELECT *, max(end_pos) OVER (PARTITION BY parent_id ORDER BY start_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM pieces),
    isl AS (SELECT *, sum(CASE WHEN before IS NULL OR start_pos > before + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY parent_id ORDER BY start_pos ROWS UNBOUNDED PRECEDING) AS island FROM w),
    ty AS (SELECT seq_id, parent_id, strand, 'exon' AS type, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM isl GROUP BY seq_id, parent_id, strand, island UNION ALL SELECT seq_id, parent_id, strand, type, start_pos, end_pos FROM pieces),
    nu AS (SELECT ty.*, num, concat(ty.seq_id, '_', gene, '_mRNA_0001') AS mrna, lpad((row_number() OVER (PARTITION BY ty.parent_id, type ORDER BY ty.start_pos, ty.end_pos))::VARCHAR, 4, '0') AS k FROM ty JOIN ge USING (parent_id)),
    al AS (SELECT seq_id, strand, start_pos, end_pos, 'gene' AS type, gene AS name, NULL::VARCHAR AS parent, NULL::VARCHAR AS derives_from FROM ge UNION ALL SELECT seq_id, strand, start_pos, end_pos, 'mRNA', concat(gene, '_mRNA_0001'), concat(seq_id, '_', gene), NULL FROM ge
    UNION ALL SELECT seq_id, strand, start_pos, end_pos, type, concat_ws('_', 'TOOL', start_pos, end_pos, 'gene', num, 'mRNA_0001', type, k), CASE WHEN type <> 'polypeptide' THEN mrna END, CASE WHEN type = 'polypeptide' THEN mrna END FROM nu)
    SELECT seq_id, strand, start_pos, end_pos, type, name, concat(seq_id, '_', name) AS id, parent, derives_from, 'TOOL' AS source FROM al""",
)
def n30(t):
    return X.expand_gene_features(S.split_utr_cds(t.fx_exons, orfs(t)), "TOOL")


@query(
    "g3_utr_aware_subtypes",
    f"""WITH {PIECES}, f AS (SELECT parent_id, strand, type, start_pos, end_pos FROM pieces WHERE type = 'polypeptide' OR parent_id NOT LIKE '%7' UNION ALL SELECT parent_id, strand, 'exon', start_pos, end_pos FROM fx_exons WHERE file_level <> 2
    UNION ALL SELECT parent_id, strand, 'mRNA', min(start_pos), max(end_pos) FROM fx_exons WHERE file_level <> 2 GROUP BY parent_id, strand),
    bd AS (SELECT parent_id, min(start_pos) FILTER (type = 'mRNA') AS ms, max(end_pos) FILTER (type = 'mRNA') AS me, coalesce(max(end_pos) FILTER (type = CASE WHEN strand <> -1 THEN 'five_prime_UTR' ELSE 'three_prime_UTR' END), -99) AS l,
    coalesce(min(start_pos) FILTER (type = CASE WHEN strand <> -1 THEN 'three_prime_UTR' ELSE 'five_prime_UTR' END), -99) AS r FROM f GROUP BY parent_id),
    v AS (SELECT f.*, ms, me, l, r, CASE WHEN type = 'exon' OR (l = -99 AND r = -99) THEN start_pos = ms OR (type = 'exon' AND (l <> -99 OR r <> -99) AND start_pos = l) ELSE start_pos = ms OR (l <> -99 AND start_pos = l + 1) END AS one,
    CASE WHEN type = 'exon' OR (l = -99 AND r = -99) THEN end_pos = me OR (type = 'exon' AND (l <> -99 OR r <> -99) AND end_pos = r) ELSE end_pos = me OR (r <> -99 AND end_pos = r - 1) END AS two FROM f JOIN bd USING (parent_id)),
    z AS (SELECT *, type = 'exon' AND (l <> -99 OR r <> -99) AS deep FROM v WHERE type IN ('exon', 'polypeptide')),
    y AS (SELECT *, CASE WHEN deep THEN start_pos = ms OR (l <> -99 AND start_pos <= l AND end_pos > l) ELSE one END AS low, CASE WHEN deep THEN end_pos = me OR (r <> -99 AND start_pos < r AND end_pos >= r) ELSE two END AS high FROM z)
    SELECT parent_id, type, start_pos, end_pos, CASE WHEN one AND two THEN 'Single' WHEN deep AND ((l <> -99 AND end_pos <= l) OR (r <> -99 AND start_pos >= r)) THEN 'External'
    WHEN low THEN CASE WHEN strand = -1 THEN 'Terminal' ELSE 'Initial' END WHEN high THEN CASE WHEN strand = -1 THEN 'Initial' ELSE 'Terminal' END ELSE 'Internal' END AS subtype FROM y""",
)
def g3(t):
    pieces = S.split_utr_cds(t.fx_exons, orfs(t)).where("type = 'polypeptide' or parent_id not like '%7'").select("parent_id", "strand", "type", "start_pos", "end_pos")
    exons = t.fx_exons.where("file_level <> 2").select("parent_id", "strand", F.lit("exon").alias("type"), "start_pos", "end_pos")
    mrna = exons.groupBy("parent_id", "strand").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")).withColumn("type", F.lit("mRNA"))
    rows = X.utr_subtype(pieces.unionByName(exons).unionByName(mrna), ["parent_id"])
    return rows.where("type in ('exon', 'polypeptide')").select("parent_id", "type", "start_pos", "end_pos", "subtype")


def coding_pieces(t):
    """UTRs and coding parts of the models on fx_sequences: up to 8 bases before and 20 behind the coding region."""
    parts = t.fx_cds.repartition("parent_id").distinct()
    sums = parts.groupBy("parent_id").agg((F.min("start_pos") % 9 + 1).alias("orf_start"), (F.sum(F.col("end_pos") - F.col("start_pos") + 1) - F.max("end_pos") % 21).alias("orf_end"))
    return S.split_utr_cds(parts, sums)


#: Spliced texts with up to 60 bases of the genome on either side; codons are lists from the start upwards and from the last one on.
@query(
    "n22_extend_cds",
    f"""WITH d AS (SELECT DISTINCT * FROM fx_cds), orf AS (SELECT parent_id, min(start_pos) % 9 + 1 AS os, (sum(end_pos - start_pos + 1) - max(end_pos) % 21)::BIGINT AS oe FROM d GROUP BY parent_id),
    o AS (SELECT *, end_pos - start_pos + 1 AS size, coalesce(sum(end_pos - start_pos + 1) OVER (PARTITION BY parent_id ORDER BY start_pos * strand, end_pos * strand ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM d),
    q AS (SELECT o.*, os - 1 - off AS x, oe - off AS y FROM o JOIN orf USING (parent_id)),
    pp AS (SELECT *, 'five_prime_UTR' AS type, 0 AS f, least(x, size) AS u FROM q UNION ALL SELECT *, 'polypeptide', greatest(x, 0), least(y, size) FROM q UNION ALL SELECT *, 'three_prime_UTR', greatest(y, 0), size FROM q),
    pc AS (SELECT seq_id, parent_id, strand, type, CASE WHEN strand <> -1 THEN start_pos + f ELSE end_pos - u + 1 END AS start_pos, CASE WHEN strand <> -1 THEN start_pos + u - 1 ELSE end_pos - f END AS end_pos FROM pp WHERE f < u),
    fg AS (SELECT seq_id, parent_id, strand, sum(CASE WHEN type = 'five_prime_UTR' THEN end_pos - start_pos + 1 ELSE 0 END)::BIGINT AS utr, sum(CASE WHEN type = 'polypeptide' THEN end_pos - start_pos + 1 ELSE 0 END)::BIGINT AS coding_len, min(start_pos) AS low, max(end_pos) AS high FROM pc GROUP BY ALL),
    {_islands_sql("pc", "seq_id, parent_id, strand", 1)},
    ex AS (SELECT seq_id, parent_id, strand, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM b GROUP BY seq_id, parent_id, strand, island),
    eo AS (SELECT *, coalesce(sum(end_pos - start_pos + 1) OVER (PARTITION BY seq_id, parent_id, strand ORDER BY start_pos * strand ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS off FROM ex),
    sp AS (SELECT e.seq_id, e.parent_id, e.strand, string_agg(substring(residues, CAST(start_pos AS INT), CAST(end_pos - start_pos + 1 AS INT)), '' ORDER BY start_pos) AS plus, max(off) AS last_off, any_value(residues) AS residues FROM eo e JOIN fx_sequences s ON s.seq_id = e.seq_id GROUP BY ALL),
    fl AS (SELECT sp.*, utr, coding_len, substring(residues, CAST(greatest(1, low - 60) AS INT), CAST(low - greatest(1, low - 60) AS INT)) AS l, substring(residues, CAST(high + 1 AS INT), 60) AS r FROM sp JOIN fg USING (seq_id, parent_id, strand) WHERE coding_len >= 3),
    tx AS (SELECT seq_id, parent_id, strand, utr, coding_len, last_off, length(CASE WHEN strand <> -1 THEN l ELSE r END) AS f, upper(CASE WHEN strand <> -1 THEN concat(l, plus, r) ELSE {sql_revcomp("concat(l, plus, r)")} END) AS text FROM fl),
    cd AS (SELECT *, f + utr AS p, list_transform(range(0, (f + utr) // 3 + 1), lambda k: struct_pack(pos := f + utr - 3 * k, c := substring(text, CAST(f + utr - 3 * k + 1 AS INT), 3))) AS ups,
      list_transform(range(0, (length(text) - (f + utr + coding_len // 3 * 3 - 3) - 3) // 3 + 1), lambda k: struct_pack(pos := f + utr + coding_len // 3 * 3 - 3 + 3 * k, c := substring(text, CAST(f + utr + coding_len // 3 * 3 - 3 + 3 * k + 1 AS INT), 3))) AS downs FROM tx),
    br AS (SELECT *, list_filter(ups, lambda z: z.c IN ('TAA', 'TAG', 'TGA') OR (NOT regexp_full_match(z.c, '[ACGT]{{3}}') AND z.pos <= f + 2))[1].pos AS bar,
      list_filter(downs, lambda z: z.c IN ('TAA', 'TAG', 'TGA') OR (NOT regexp_full_match(z.c, '[ACGT]{{3}}') AND z.pos >= f + last_off))[1].pos AS dbar FROM cd),
    wk AS (SELECT *, coalesce(list_filter(ups, lambda z: z.c = 'ATG' AND (bar IS NULL OR z.pos > bar))[-1].pos, bar + 3, ups[-1].pos) AS walked, coalesce(dbar, downs[-1].pos) + 3 AS e FROM br),
    md AS (SELECT *, unnest([0, 1, 2]) AS mode FROM wk), fd AS (SELECT *, CASE WHEN (mode = 2 AND utr > 2) OR (mode = 1 AND ups[1].c = 'ATG') THEN p ELSE walked END AS s FROM md),
    ct AS (SELECT eo.seq_id, eo.parent_id, eo.strand, mode, start_pos, end_pos, f + off AS a0, CASE WHEN off = 0 THEN least(f + off, s) ELSE f + off END AS a,
      CASE WHEN off = last_off THEN greatest(f + off + end_pos - start_pos + 1, e) ELSE f + off + end_pos - start_pos + 1 END AS b, s, e FROM eo JOIN fd USING (seq_id, parent_id, strand)),
    nw AS (SELECT *, 'five_prime_UTR' AS type, a AS x, least(b, s) AS y FROM ct UNION ALL SELECT *, 'polypeptide', greatest(a, s), least(b, e) FROM ct UNION ALL SELECT *, 'three_prime_UTR', greatest(a, e), b FROM ct)
    SELECT seq_id, parent_id, strand, type, (CASE WHEN strand <> -1 THEN start_pos + x - a0 ELSE end_pos - (y - a0) + 1 END)::BIGINT AS start_pos, (CASE WHEN strand <> -1 THEN start_pos + y - a0 - 1 ELSE end_pos - (x - a0) END)::BIGINT AS end_pos, mode FROM nw WHERE x < y""",
)
def n22(t):
    tiles, lengths = codon_tiles(t)
    return S.extend_cds(coding_pieces(t), tiles, lengths, 60, (0, 1, 2), width=WIDTH)


@query(
    "n31_split_sequences",
    """WITH c AS (SELECT seq_id, residues, unnest(range(0, CASE WHEN length(residues) > 300 THEN (length(residues) - 300) // 250 + 2 ELSE 1 END)) AS k FROM fx_sequences)
    SELECT seq_id, (k + 1)::INT AS chunk_no, k * 250 + 1 AS chunk_start, least(length(residues), k * 250 + 300)::BIGINT AS chunk_end, substring(residues, CAST(k * 250 + 1 AS INT), 300) AS residues FROM c""",
)
def n31(t):
    return C.split_sequences(*codon_tiles(t), 300, 50, width=WIDTH)


def chunked(t):
    """Genes in chunks of 5000 bases that overlap by 2000: each chunk has those that lie wholly inside it."""
    ends = t.fx_exons.groupBy("seq_id").agg(F.max("end_pos").alias("length"))
    chunks = I.tiles_of(ends, 5000, 2000)
    rows = C.in_chunks(genes(t), chunks, 5000, 2000)
    features = rows.select("seq_id", "chunk_no", F.col("parent_id").alias("feature_id"), F.lit(None).cast("string").alias("master"), "start_pos", "end_pos")
    return features, chunks


CHUNKED = f"""{GENES}, en AS (SELECT seq_id, max(end_pos) AS n FROM fx_exons GROUP BY seq_id),
ck AS (SELECT seq_id, (k + 1)::INT AS chunk_no, k * 3000 + 1 AS chunk_start, least(n, k * 3000 + 5000) AS chunk_end FROM (SELECT seq_id, n, unnest(range(0, CASE WHEN n > 5000 THEN (n - 5000) // 3000 + 2 ELSE 1 END)) AS k FROM en)),
ft AS (SELECT g.seq_id, chunk_no, parent_id AS feature_id, start_pos, end_pos, chunk_start, chunk_end FROM g JOIN ck ON ck.seq_id = g.seq_id AND start_pos >= chunk_start AND end_pos <= chunk_end),
ar AS (SELECT ft.*, nx.chunk_start AS next_start FROM ft LEFT JOIN ck nx ON nx.seq_id = ft.seq_id AND nx.chunk_no = ft.chunk_no + 1)"""


@query(
    "n32_stitch_chunks",
    f"""WITH {CHUNKED} SELECT seq_id, chunk_no, feature_id, start_pos, end_pos FROM ar a WHERE (chunk_no = 1 OR start_pos <> chunk_start) AND (next_start IS NULL OR start_pos <= next_start OR (end_pos <> chunk_end
    AND NOT EXISTS (SELECT 1 FROM ft n WHERE n.seq_id = a.seq_id AND n.chunk_no = a.chunk_no + 1 AND n.start_pos = a.start_pos AND n.end_pos >= a.end_pos)))""",
)
def n32(t):
    features, chunks = chunked(t)
    return C.stitch(features, chunks).select("seq_id", "chunk_no", "feature_id", "start_pos", "end_pos")


@query(
    "e15_adjacent_chunks",
    f"""WITH {CHUNKED} SELECT seq_id, chunk_no, feature_id FROM ft a WHERE NOT EXISTS (SELECT 1 FROM ft n WHERE n.seq_id = a.seq_id AND n.chunk_no = a.chunk_no + 1 AND n.start_pos = a.start_pos AND n.end_pos >= a.end_pos)""",
)
def e15(t):
    features, _ = chunked(t)
    later = features.select(F.col("seq_id"), (F.col("chunk_no") - 1).alias("chunk_no"), "start_pos", F.col("end_pos").alias("n_end")).groupBy("seq_id", "chunk_no", "start_pos").agg(F.max("n_end").alias("n_end"))
    return features.join(later, ["seq_id", "chunk_no", "start_pos"], "left").where("n_end is null or n_end < end_pos").select("seq_id", "chunk_no", "feature_id")


@query(
    "n33_prediction_hints",
    """WITH d AS (SELECT *, lead(start_pos) OVER (PARTITION BY seq_id, strand, evidence_id ORDER BY start_pos, end_pos) AS nx, CASE WHEN category = 'proteicEvidences' THEN 'P' ELSE 'W' END AS src FROM fx_evidence)
    SELECT seq_id, CASE WHEN src = 'P' THEN 'CDSpart' ELSE 'ep' END AS type, start_pos, end_pos, strand, count(*) AS score, concat('src=', src, ';mult=', count(*)::VARCHAR, ';') AS note FROM d GROUP BY seq_id, strand, start_pos, end_pos, src
    UNION ALL SELECT seq_id, 'intron', end_pos, nx, strand, 0, concat('grp=', evidence_id, ';pri=4;src=', src, ';') FROM d WHERE nx IS NOT NULL""",
)
def n33(t):
    protein = F.col("category") == "proteicEvidences"
    of = lambda rows, kind: S.prediction_hints(rows, kind, ["seq_id", "strand", "evidence_id"], "evidence_id")
    return of(t.fx_evidence.where(protein), "protein").unionByName(of(t.fx_evidence.where(~protein), "RNAseq"))


@query("f9_hint_multiplicity", "SELECT seq_id, start_pos, end_pos, strand, count(*) AS n FROM fx_evidence GROUP BY ALL")
def f9(t):
    return S.multiplicity(t.fx_evidence)


DOMAINS = "dom AS (SELECT DISTINCT parent_id, concat('d', parent_id) AS domain_id, 1 + file_level * 10 AS aa_start, 30 + file_level * 12 AS aa_end FROM fx_exons)"


@query(
    "n34_lift_domains",
    f"""WITH {OFFSETS}, {DOMAINS}, r AS (SELECT dom.parent_id, domain_id, seq_id, strand, start_pos, end_pos, greatest(3 * (aa_start - 1), off) - off AS f, least(3 * aa_end, off + size) - off AS u FROM dom JOIN o USING (parent_id))
    SELECT parent_id, domain_id, seq_id, strand, CASE WHEN strand = 1 THEN start_pos + f ELSE end_pos - u + 1 END AS start_pos, CASE WHEN strand = 1 THEN start_pos + u - 1 ELSE end_pos - f END AS end_pos FROM r WHERE f < u""",
)
def n34(t):
    domains = t.fx_exons.select("parent_id", F.concat(F.lit("d"), "parent_id").alias("domain_id"), (F.col("file_level") * 10 + 1).alias("aa_start"), (F.col("file_level") * 12 + 30).alias("aa_end")).distinct()
    return A.lift_domains(domains, t.fx_exons.select("parent_id", "seq_id", "strand", "start_pos", "end_pos"))


@query("e13_protein_lift", f"WITH {OFFSETS}, {DOMAINS} SELECT parent_id, count(*) AS pieces FROM dom JOIN o USING (parent_id) WHERE greatest(3 * (aa_start - 1), off) < least(3 * aa_end, off + size) GROUP BY parent_id")
def e13(t):
    return n34(t).groupBy("parent_id").agg(F.count("*").alias("pieces"))


def attributed(t):
    attributes = F.create_map(F.lit("ID"), F.array("feature_id"), F.lit("Parent"), F.array("parent_id"), F.lit("Name"), F.array(F.concat(F.lit("exon_"), "feature_id")), F.lit("Ontology_term"), F.array(F.lit("SO:0000147")))
    return t.fx_exons.withColumns({"type": F.when(F.col("file_level") == 3, "gene").otherwise("exon"), "attributes": attributes})


@query("n36_virtual_polypeptides", "SELECT feature_id, 'polypeptide' AS type, concat('Derives_from=', parent_id, ';ID=', replace(feature_id, 'exon', 'polypeptide'), ';Name=polypeptide_', feature_id) AS attributes FROM fx_exons WHERE file_level <> 3")
def n36(t):
    return X.virtual_polypeptides(attributed(t)).select("feature_id", "type", T.render_attributes(F.col("attributes")).alias("attributes"))


@query("e12_attach_annotations", "SELECT feature_id, concat(CASE WHEN file_level = 1 THEN 'ID=new;' ELSE concat('ID=', feature_id, ';') END, 'Name=exon_', feature_id, CASE WHEN file_level = 1 THEN ';Note=x' ELSE '' END, ';Ontology_term=SO:0000147;Parent=', parent_id) AS attributes FROM fx_exons")
def e12(t):
    rows = attributed(t)
    added = t.fx_exons.where("file_level = 1").select("feature_id", F.create_map(F.lit("ID"), F.array(F.lit("new")), F.lit("Note"), F.array(F.lit("x"))).alias("added"))
    return X.attach_annotations(rows, added, "feature_id").select("feature_id", T.render_attributes(F.col("attributes")).alias("attributes"))


@query(
    "n37_classify_ontology",
    f"""WITH k AS (SELECT feature_id, CASE WHEN n = 1 THEN 'Single' WHEN k = 1 THEN CASE WHEN strand = 1 THEN 'Initial' ELSE 'Terminal' END WHEN k = n THEN CASE WHEN strand = 1 THEN 'Terminal' ELSE 'Initial' END ELSE 'Internal' END AS subtype
    FROM (SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY start_pos, feature_id) AS k, count(*) OVER (PARTITION BY parent_id) AS n FROM fx_exons))
    SELECT feature_id, subtype, {_sql_so("'exon'", "subtype")} AS so_term FROM k""",
)
def n37(t):
    return X.classify_ontology(t.fx_exons, ["parent_id"], ["start_pos", "feature_id"]).select("feature_id", "subtype", "so_term")


@query("e16_superseded_sets", "SELECT query_id, hit_id, q_start FROM fx_hsps h WHERE strand = 1 AND NOT EXISTS (SELECT 1 FROM fx_hsps r WHERE r.strand = -1 AND r.query_id = h.query_id AND r.hit_id = h.hit_id)")
def e16(t):
    from strandweave.operators.hits import superseded

    return superseded(t.fx_hsps.where("strand = 1"), t.fx_hsps.where("strand = -1"), ["query_id", "hit_id"]).select("query_id", "hit_id", "q_start")


@query("e19_replace_by_id", "SELECT parent_id, feature_id, start_pos FROM fx_exons WHERE parent_id NOT IN (SELECT parent_id FROM fx_exons WHERE file_level = 1) UNION ALL SELECT parent_id, concat(feature_id, '_new'), start_pos + 1 FROM fx_exons WHERE file_level = 1")
def e19(t):
    old = t.fx_exons.select("parent_id", "feature_id", "start_pos")
    new = t.fx_exons.where("file_level = 1").select("parent_id", F.concat("feature_id", F.lit("_new")).alias("feature_id"), (F.col("start_pos") + 1).alias("start_pos"))
    return X.replace_by_id(old, new, "parent_id")


@query("n25_clip_windows", """WITH c AS (SELECT query_id, hit_id, strand, min(q_start) AS q_start, max(q_end) AS q_end, min(h_start) * 20 AS g_start, max(h_end) * 20 AS g_end, count(*) AS n FROM fx_hsps GROUP BY ALL)
SELECT query_id, hit_id, strand, greatest(1, g_start - CASE WHEN q_start - 1 <= 0 THEN 0 WHEN n = 1 AND q_start - 1 < 10 THEN 1000 ELSE 10000 END) AS w_start,
least(25000, g_end + CASE WHEN 800 - q_end <= 0 THEN 0 WHEN n = 1 AND 800 - q_end < 10 THEN 1000 ELSE 10000 END) AS w_end FROM c""")
def n25(t):
    rows = t.fx_hsps.groupBy("query_id", "hit_id", "strand").agg(F.min("q_start").alias("q_start"), F.max("q_end").alias("q_end"), (F.min("h_start") * 20).alias("g_start"), (F.max("h_end") * 20).alias("g_end"), F.count("*").alias("n_hsps"), F.first("query_len").alias("query_len"))
    return S.clip_windows(rows.withColumn("g_len", F.lit(25000).cast("long"))).select("query_id", "hit_id", "strand", "w_start", "w_end")


#: The state of a hit: what is free, in order, the chain that grows, and one that was closed in this round.
_FITS = "list_sort(list_transform(list_filter(free, lambda x: {0}), lambda x: struct_pack(d := abs({1}), s := {2}, x := x)))[1]"


@query(
    "n24_chain_hsps",
    f"""WITH RECURSIVE pl AS (SELECT query_id, hit_id, strand, query_len, q_start AS qs, q_end AS qe, CASE WHEN strand <> -1 THEN h_start ELSE -h_end END AS a, CASE WHEN strand <> -1 THEN h_end ELSE -h_start END AS b, align_len, n_identical,
      row_number() OVER (PARTITION BY query_id, hit_id, strand ORDER BY bit_score DESC, q_start, q_end, h_start, h_end) AS place FROM fx_hsps),
    st AS (SELECT query_id, hit_id, strand, any_value(query_len) AS query_len, list(struct_pack(place := place, qs := qs, qe := qe, a := a, b := b, size := align_len, same := n_identical) ORDER BY place) AS free FROM pl GROUP BY ALL),
    r AS (SELECT *, CASE WHEN FALSE THEN struct_pack(q0 := free[1].qs, q1 := free[1].qe, a0 := free[1].a, a1 := free[1].b, n := 1, size := free[1].size, same := free[1].same) END AS cur,
      CASE WHEN FALSE THEN struct_pack(q0 := free[1].qs, q1 := free[1].qe, a0 := free[1].a, a1 := free[1].b, n := 1, size := free[1].size, same := free[1].same) END AS closed, -1 AS chain FROM st
    UNION ALL SELECT query_id, hit_id, strand, query_len,
      CASE WHEN cur IS NULL THEN free[2:] ELSE list_filter(free, lambda x: coalesce(x.place <> bf.x.place, TRUE) AND coalesce(x.place <> bh.x.place, TRUE)) END AS free,
      CASE WHEN cur IS NULL THEN struct_pack(q0 := free[1].qs, q1 := free[1].qe, a0 := free[1].a, a1 := free[1].b, n := 1, size := free[1].size, same := free[1].same)
        WHEN bf IS NOT NULL OR bh IS NOT NULL THEN struct_pack(q0 := coalesce(bf.x.qs, cur.q0), q1 := coalesce(bh.x.qe, cur.q1), a0 := coalesce(bf.x.a, cur.a0), a1 := coalesce(bh.x.b, cur.a1),
          n := cur.n + (bf IS NOT NULL)::INT + (bh IS NOT NULL)::INT, size := cur.size + coalesce(bf.x.size, 0) + coalesce(bh.x.size, 0), same := cur.same + coalesce(bf.x.same, 0) + coalesce(bh.x.same, 0)) END AS cur,
      CASE WHEN cur IS NOT NULL AND bf IS NULL AND bh IS NULL THEN cur END AS closed, chain + (cur IS NULL)::INT AS chain
    FROM (SELECT *, CASE WHEN cur IS NOT NULL THEN {_FITS.format("x.qs < cur.q0 AND x.qe < cur.q1 AND cur.q0 - x.qe > -10 AND cur.a0 - x.b > 0 AND cur.a0 - x.b < 10000", "cur.q0 - x.qe", "cur.a0 - x.b")} END AS bf,
      CASE WHEN cur IS NOT NULL THEN {_FITS.format("x.qe > cur.q1 AND x.qs > cur.q0 AND x.qs - cur.q1 > -10 AND x.a - cur.a1 > 0 AND x.a - cur.a1 < 10000", "x.qs - cur.q1", "x.a - cur.a1")} END AS bh
      FROM r WHERE len(free) > 0 OR cur IS NOT NULL)),
    ch AS (SELECT query_id, hit_id, strand::INT AS strand, chain::INT AS chain, closed.q0::BIGINT AS q_start, closed.q1::BIGINT AS q_end, (CASE WHEN strand <> -1 THEN closed.a0 ELSE -closed.a1 END)::BIGINT AS h_start, (CASE WHEN strand <> -1 THEN closed.a1 ELSE -closed.a0 END)::BIGINT AS h_end,
      closed.n::INT AS n_hsps, least(1::DOUBLE, closed.size / query_len) AS coverage, closed.same / closed.size AS identity FROM r WHERE closed IS NOT NULL),
    lv AS (SELECT * FROM ch QUALIFY coverage >= 0.3::DOUBLE - 0.05::DOUBLE * greatest(0, ceil((0.3::DOUBLE - max(coverage) OVER (PARTITION BY query_id)) / 0.05::DOUBLE - 1e-9::DOUBLE)) - 1e-9::DOUBLE)
    SELECT * FROM lv QUALIFY identity >= max(identity) OVER (PARTITION BY query_id) - 0.05::DOUBLE""",
)
def n24(t):
    return S.chain_hsps(t.fx_hsps, coverage=0.3)


#: A cluster's windows are a list that is gone through by place; ``seen`` are those whose alignments begin before this one's ends.
@query(
    "n26_dedupe_windows",
    f"""WITH RECURSIVE wi AS (SELECT seq_id, feature_id AS window_id, start_pos - end_pos % 4 * 50 AS start_pos, end_pos + start_pos % 4 * 50 AS end_pos, start_pos AS g_start, end_pos AS g_end FROM fx_exons), {_islands_sql("wi", "seq_id", 0)},
    cl AS (SELECT seq_id, island, list(struct_pack(g_start := g_start, g_end := g_end, window_id := window_id, start_pos := start_pos, end_pos := end_pos, place := place) ORDER BY place) AS ws
      FROM (SELECT *, row_number() OVER (PARTITION BY seq_id, island ORDER BY g_start, g_end, window_id) AS place FROM b) GROUP BY ALL),
    r AS (SELECT seq_id, island, ws, 1::BIGINT AS i, []::BIGINT[] AS gone, ws[0] AS kept FROM cl
    UNION ALL SELECT seq_id, island, ws, i + 1 AS i,
      CASE WHEN list_contains(gone, i) THEN gone ELSE list_distinct(list_concat(gone, list_transform(list_filter(seen, lambda x: x.place <> i AND x.g_end >= w.g_start
        AND ((w.end_pos - w.start_pos + 1) + (x.end_pos - x.start_pos + 1) - abs(w.start_pos - x.start_pos) - abs(w.end_pos - x.end_pos)) / 2 >= 0.9::DOUBLE * (x.end_pos - x.start_pos + 1)), lambda x: x.place))) END AS gone,
      CASE WHEN NOT list_contains(gone, i) THEN struct_pack(g_start := w.g_start, g_end := w.g_end, window_id := w.window_id, start_pos := coalesce(list_filter(seen, lambda x: x.place <> i AND x.g_end < w.g_start)[-1].g_end + 1, w.start_pos),
        end_pos := CASE WHEN len(seen) < len(ws) THEN ws[len(seen) + 1].g_start - 1 ELSE w.end_pos END, place := i) END AS kept
    FROM (SELECT *, ws[i] AS w, list_filter(ws, lambda x: x.g_start <= ws[i].g_end) AS seen FROM r WHERE i <= len(ws)))
    SELECT seq_id, kept.window_id, kept.start_pos, kept.end_pos FROM r WHERE kept IS NOT NULL""",
)
def n26(t):
    return S.dedupe_windows(windows(t))


def windows(t):
    """Windows of up to 150 bases around the exons."""
    left, right = F.col("end_pos") % 4 * 50, F.col("start_pos") % 4 * 50
    return t.fx_exons.select("seq_id", F.col("feature_id").alias("window_id"), (F.col("start_pos") - left).alias("start_pos"), (F.col("end_pos") + right).alias("end_pos"), F.col("start_pos").alias("g_start"), F.col("end_pos").alias("g_end"))


@query("f18_status_counts", "SELECT status, count(*) AS n FROM fx_task_runs GROUP BY status")
def f18(t):
    return R.status_counts(t.fx_task_runs)


READY = """cx AS (SELECT DISTINCT seq_id, chunk_no FROM fx_task_runs UNION ALL SELECT DISTINCT seq_id, 99 FROM fx_task_runs WHERE seq_id LIKE '%1'),
b AS (SELECT seq_id, chunk_no, bool_and(status BETWEEN 10 AND 12) AS done, list(DISTINCT status) AS seen FROM fx_task_runs GROUP BY ALL),
j AS (SELECT cx.seq_id, coalesce(done, FALSE) AS done, seen FROM cx LEFT JOIN b ON b.seq_id = cx.seq_id AND b.chunk_no = cx.chunk_no),
ready AS (SELECT seq_id, count(*) AS chunks, count(*) FILTER (done) AS finished, array_to_string(list_sort(list_distinct(flatten(list(seen) FILTER (seen IS NOT NULL)))), ',') AS statuses FROM j GROUP BY seq_id)"""


@query("f19_readiness", f"WITH {READY} SELECT *, chunks = finished AS ready FROM ready")
def f19(t):
    chunks = t.fx_task_runs.select("seq_id", "chunk_no").distinct()
    chunks = chunks.unionByName(chunks.where("seq_id like '%1'").select("seq_id", F.lit(99).cast("long").alias("chunk_no")).distinct())
    return R.readiness(t.fx_task_runs, chunks)


@query("e14_chunk_readiness", "SELECT seq_id, count(DISTINCT chunk_no) AS chunks, count(*) AS runs FROM fx_task_runs WHERE status = 10 GROUP BY seq_id")
def e14(t):
    chunks = t.fx_task_runs.select("seq_id", "chunk_no").distinct()
    return R.chunk_counts(chunks, t.fx_task_runs.where("status = 10"))


@query("f20_timings", "SELECT kind, min(real_time) AS least, max(real_time) AS most, round(avg(real_time), 4) AS mean, round(sum(real_time), 2) AS total, count(*) AS n FROM fx_task_runs GROUP BY kind")
def f20(t):
    return R.timings(t.fx_task_runs).select("kind", "least", "most", F.round("mean", 4).alias("mean"), F.round("total", 2).alias("total"), "n")


@query("f21_run_totals", "SELECT seq_id, round(sum(real_time), 2) AS total, count(*) AS n FROM fx_task_runs GROUP BY seq_id")
def f21(t):
    return R.totals(t.fx_task_runs).select("seq_id", F.round("real_time", 2).alias("total"), "n")


@query("n38_run_report", f"WITH {READY} SELECT seq_id, chunks, finished, statuses, total, runs FROM ready JOIN (SELECT seq_id, round(sum(real_time), 2) AS total, count(*) AS runs FROM fx_task_runs GROUP BY seq_id) USING (seq_id)")
def n38(t):
    return R.report(t.fx_task_runs, f19(t))

"""Queries of report formats: lines are made from the given tables, parsed, and compared with what they were made of."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandweave.functions import lookups as L
from strandweave.functions import text as T
from strandweave.operators import features as X
from strandweave.sources import reports as P
from strandweave.sources import sinks as B

from .expression_queries import sql_map
from .interval_queries import GENES
from .registry import query


def gff_lines(t):
    line = F.concat_ws("\t", "seq_id", F.lit("TOOL"), F.when(F.col("file_level") == 3, "region").otherwise("exon"), F.col("start_pos").cast("string"), F.col("end_pos").cast("string"), F.when(F.col("file_level") == 1, ".").otherwise("2.5"), F.when(F.col("strand") == 1, "+").otherwise("-"), F.lit("."), F.concat(F.lit("ID="), "feature_id", F.lit(";Parent="), "parent_id", F.lit(";Note=a,b")))
    rows = t.fx_exons.select(line.alias("value"))
    return rows.unionByName(rows.select(F.concat(F.lit("# "), "value").alias("value"))).unionByName(rows.limit(3).select(F.lit(" ").alias("value")))


_GFF = """SELECT feature_id, parent_id, seq_id, CASE WHEN file_level = 3 THEN 'region' ELSE 'exon' END AS type, start_pos, end_pos, CASE WHEN file_level = 1 THEN NULL ELSE 2.5::DOUBLE END AS score, strand, 'a|b' AS note FROM fx_exons"""


@query("a1_read_gff3", _GFF)
def a1(t):
    return P.parse_gff3(gff_lines(t)).select("feature_id", "parent_id", "seq_id", "type", "start_pos", "end_pos", "score", "strand", F.array_join(F.col("attributes")["Note"], "|").alias("note"))


@query(
    "a2_parse_attributes",
    """SELECT feature_id, (CASE WHEN file_level = 0 THEN 2 ELSE 3 END)::INT AS n, parent_id AS parent, CASE WHEN file_level > 0 THEN (start_pos % 4 + 1)::INT END AS notes, CASE WHEN file_level > 0 THEN concat('n', CASE WHEN start_pos % 4 = 0 THEN end_pos::VARCHAR ELSE (start_pos % 4)::VARCHAR END) END AS last_note FROM fx_exons""",
)
def a2(t):
    notes = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col("start_pos") % 4), lambda k: F.concat(F.lit("n"), F.when(k == 0, F.col("end_pos")).otherwise(k).cast("string"))), ",")
    text = F.concat(F.lit("ID="), "feature_id", F.lit("; Parent="), "parent_id", F.when(F.col("file_level") > 0, F.concat(F.lit(";Note="), notes)).otherwise(""), F.lit(";;flag"))
    rows = t.fx_exons.select("feature_id", T.parse_attributes(text).alias("a"))
    note = F.col("a")["Note"]
    return rows.select("feature_id", F.size("a").alias("n"), F.col("a")["Parent"][0].alias("parent"), F.when(note.isNotNull(), F.size(note)).alias("notes"), F.element_at(note, -1).alias("last_note"))


@query("a6_read_kmer_counts", "SELECT CASE WHEN strand = 1 THEN '+' ELSE '-' END AS strand, start_pos AS pos, end_pos % 11 AS n, feature_id AS mer FROM fx_exons")
def a6(t):
    line = F.concat_ws("\t", F.concat(F.when(F.col("strand") == 1, "+").otherwise("-"), F.col("start_pos").cast("string")), (F.col("end_pos") % 11).cast("string"), "feature_id")
    return P.parse_kmer_counts(t.fx_exons.select(line.alias("value")))


_CODES = [*L.AMINO_NAMES, "Zzz"]


@query(
    "a7_read_trna",
    f"""WITH k AS (SELECT *, ({_CODES!r})[1 + start_pos % {len(_CODES)}] AS code FROM fx_exons)
    SELECT feature_id AS seq_id, 'tRNA' AS type, start_pos, end_pos, strand, 2.5::DOUBLE AS score, concat(CASE WHEN strand = -1 THEN '(Reverse) ' ELSE '' END, {sql_map(L.AMINO_NAMES, "code", "code")}) AS note,
    CASE WHEN file_level = 0 THEN 'Unknow anticodon' ELSE 'TGC' END AS anticodon, CASE WHEN file_level = 1 THEN start_pos + 3 END AS intron_start, CASE WHEN file_level = 1 THEN start_pos + 9 END AS intron_end FROM k""",
)
def a7(t):
    s, e = F.col("start_pos").cast("string"), F.col("end_pos").cast("string")
    minus = F.col("strand") == -1
    code = F.element_at(F.lit(_CODES), (F.col("start_pos") % len(_CODES) + 1).cast("int"))
    inner = lambda d: F.when(F.col("file_level") == 1, (F.col("start_pos") + d).cast("string")).otherwise("0")
    line = F.concat_ws(" ", "feature_id", F.lit("1"), F.when(minus, e).otherwise(s), F.when(minus, s).otherwise(e), code, F.when(F.col("file_level") == 0, "???").otherwise("TGC"), inner(9), inner(3), F.lit("2.5"))
    return P.parse_trna(t.fx_exons.select(line.alias("value")))


@query(
    "n5_vulgar_to_parts",
    """WITH v AS (SELECT parent_id, start_pos AS s, end_pos - start_pos + 1 AS n, feature_id FROM fx_exons WHERE strand = 1)
    SELECT feature_id, 1::INT AS part, s AS q_start, s + n - 1 AS q_end, s + 11 AS start_pos, s + 2 * n + 13 AS end_pos FROM v
    UNION ALL SELECT feature_id, 2, s + n, s + 2 * n, s + 2 * n + 114, s + 3 * n + 114 FROM v""",
)
def n5(t):
    n = (F.col("end_pos") - F.col("start_pos") + 1).cast("string")
    s = F.col("start_pos")
    text = lambda c: c.cast("string")
    # One part of two aligned blocks around a gap of three, a split codon, an intron and the codon's rest with a block.
    half = F.concat(F.lit(" M "), n, F.lit(" "), n)
    ops = F.concat(F.lit("M 0 3 G 0 "), n, half, F.lit(" 5 0 2 I 0 96 3 0 2 M 1 1 G 0 0"), half)
    line = F.concat_ws(" ", F.lit("vulgar: q"), text(s - 1), F.lit("9999"), F.lit("+ t"), text(s + 10), F.lit("99999"), F.lit("+ 77"), ops)
    return P.parse_vulgar(t.fx_exons.where("strand = 1").select("feature_id", line.alias("value")), ["feature_id"]).select("feature_id", "part", "q_start", "q_end", "start_pos", "end_pos")


@query("a12_vulgar_minus", "SELECT feature_id, 1::INT AS part, -1 AS strand, 1::BIGINT AS q_start, 12::BIGINT AS q_end, start_pos - 11 AS start_pos, start_pos AS end_pos FROM fx_exons UNION ALL SELECT feature_id, 2, -1, 11, 20, start_pos - 121, start_pos - 110 FROM fx_exons")
def a12(t):
    line = F.concat(F.lit("vulgar: q 0 20 + t "), F.col("start_pos").cast("string"), F.lit(" 0 - 5 M 10 10 S 2 2 5 0 2 I 0 94 3 0 2 S 0 2 M 8 10"))
    parts = P.parse_vulgar(t.fx_exons.select("feature_id", line.alias("value")), ["feature_id"])
    return parts.select("feature_id", "part", "strand", F.when(F.col("part") == 2, 11).otherwise(F.col("q_start")).cast("long").alias("q_start"), F.col("q_end"), "start_pos", "end_pos")


_TYPES = ["transcript", "CDS", "gene", "exon"]


@query("a14_normalize_predictions", f"SELECT feature_id, {sql_map(L.TYPE_NAMES, 'type', 'type')} AS type FROM (SELECT feature_id, ({_TYPES!r})[1 + file_level] AS type FROM fx_exons) WHERE type <> 'gene'")
def a14(t):
    rows = t.fx_exons.withColumn("type", F.element_at(F.lit(_TYPES), F.col("file_level") + 1))
    return X.rename_and_drop(rows, L.TYPE_NAMES, ["gene"]).select("feature_id", "type")


_SITES = f"{GENES}, st AS (SELECT *, CASE WHEN file_level > 0 THEN CASE WHEN strand = 1 THEN start_pos - 30 ELSE end_pos + 30 END END AS promoter, CASE WHEN file_level > 1 THEN CASE WHEN strand = 1 THEN end_pos + 40 ELSE start_pos - 40 END END AS poly_a FROM g)"


@query(
    "a15_exons_to_genes",
    f"""WITH {_SITES} SELECT seq_id, parent_id AS gene_id, strand, 'gene' AS type, start_pos, end_pos FROM g UNION ALL SELECT seq_id, parent_id, strand, 'mRNA', start_pos, end_pos FROM g
    UNION ALL SELECT seq_id, parent_id, strand, 'exon', start_pos, end_pos FROM fx_exons UNION ALL SELECT seq_id, parent_id, strand, 'polypeptide', start_pos, end_pos FROM fx_exons
    UNION ALL SELECT seq_id, parent_id, strand, 'five_prime_UTR', CASE WHEN strand = 1 THEN promoter ELSE end_pos + 1 END, CASE WHEN strand = 1 THEN start_pos - 1 ELSE promoter END FROM st WHERE promoter IS NOT NULL
    UNION ALL SELECT seq_id, parent_id, strand, 'three_prime_UTR', CASE WHEN strand = 1 THEN end_pos + 1 ELSE poly_a END, CASE WHEN strand = 1 THEN poly_a ELSE start_pos - 1 END FROM st WHERE poly_a IS NOT NULL""",
)
def a15(t):
    plus, gene = F.col("strand") == 1, W.partitionBy("parent_id")
    exons = t.dealt("fx_exons", "parent_id").withColumns({"first": F.min("start_pos").over(gene), "last": F.max("end_pos").over(gene)})
    promoter = F.when(F.col("file_level") > 0, F.when(plus, F.col("first") - 30).otherwise(F.col("last") + 30))
    poly_a = F.when(F.col("file_level") > 1, F.when(plus, F.col("last") + 40).otherwise(F.col("first") - 40))
    return P.exons_to_genes(exons.select("seq_id", F.col("parent_id").alias("gene_id"), "strand", "start_pos", "end_pos", promoter.alias("promoter"), poly_a.alias("poly_a")))


@query("a16_read_markers", f"SELECT feature_id, start_pos FROM ({_GFF}) WHERE type <> 'region'")
def a16(t):
    return P.parse_gff3(gff_lines(t)).where("type <> 'region'").select("feature_id", "start_pos")


@query(
    "a17_repeats_to_features",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'repeat_region' AS type, coalesce(p_name, 'unknown') AS note, CASE WHEN p_size IS NOT NULL THEN round((l_suppkey % 9 + 1) * 100 / (p_size * 10), 2) END AS coverage
    FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_partkey % 4 <> 0) ON p_partkey = l_partkey""",
)
def a17(t):
    library = t.part.where("p_partkey % 4 <> 0").select(F.col("p_partkey").alias("repeat_id"), F.col("p_name").alias("description"), (F.col("p_size") * 10).alias("repeat_len"))
    hits = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_partkey").alias("repeat_id"), F.lit(1).alias("r_start"), (F.col("l_suppkey") % 9 + 1).alias("r_end"))
    return P.repeats_to_features(hits, library).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "type", "note", "coverage")


@query(
    "a18_tandem_repeats",
    """SELECT seq_id, 'tandem_repeat' AS type, start_pos, end_pos, feature_id AS motif, length(feature_id)::INT AS motif_size, floor(((end_pos - start_pos + 1) * 20 + length(feature_id)) / (2 * length(feature_id))) / 10 AS copies,
    CASE WHEN k < 10000 THEN lpad(k::VARCHAR, 4, '0') ELSE k::VARCHAR END AS number FROM (SELECT *, row_number() OVER (PARTITION BY seq_id ORDER BY start_pos, end_pos, feature_id) AS k FROM fx_exons)""",
)
def a18(t):
    return P.tandem_repeats(t.fx_exons.select("seq_id", "start_pos", "end_pos", F.col("feature_id").alias("motif")))


@query(
    "a19_nested_repeats",
    """WITH r AS (SELECT parent_id, strand, list(start_pos ORDER BY start_pos, end_pos) AS loc, list(end_pos ORDER BY start_pos, end_pos) AS rng, count(*) AS n FROM fx_exons GROUP BY parent_id, strand),
    k AS (SELECT *, unnest(range(1, n + 1)) AS i FROM r WHERE n % 5 <> 4)
    SELECT parent_id AS repeat_id, strand, i::INT AS fragment, CASE WHEN strand = -1 THEN loc[n + 1 - i] ELSE loc[i] END AS location, rng[i] AS "range" FROM k""",
)
def a19(t):
    both = F.sort_array(F.collect_list(F.struct("start_pos", "end_pos")))
    rows = t.fx_exons.groupBy("parent_id", "strand").agg(both.alias("x"), F.count("*").alias("n"))
    ranges = F.transform("x", lambda p: p["end_pos"])
    rows = rows.select(F.col("parent_id").alias("repeat_id"), "strand", F.transform("x", lambda p: p["start_pos"]).alias("locations"), F.when(F.col("n") % 5 == 4, F.slice(ranges, 1, 1)).otherwise(ranges).alias("ranges"))
    return X.explode_nested_repeats(rows.where("size(locations) > 0"))


@query("b1_gff3_lines", "SELECT feature_id, concat_ws(chr(9), seq_id, 'TOOL', 'exon', start_pos::VARCHAR, end_pos::VARCHAR, '.', CASE WHEN strand = 1 THEN '+' ELSE '-' END, '.', concat('ID=', feature_id, ';Parent=', parent_id)) AS line FROM fx_exons")
def b1(t):
    rows = t.fx_exons.select("seq_id", F.lit("TOOL").alias("source"), F.lit("exon").alias("type"), "start_pos", "end_pos", F.lit(None).cast("double").alias("score"), "strand", F.lit(None).cast("int").alias("phase"), F.create_map(F.lit("Parent"), F.array("parent_id"), F.lit("ID"), F.array("feature_id")).alias("attributes"))
    return B.gff3_lines(rows).select(F.regexp_extract("line", "ID=([^;]*)", 1).alias("feature_id"), "line")


@query(
    "n9_embl_table",
    """WITH k AS (SELECT *, CASE WHEN file_level = 0 THEN 'other' WHEN file_level = 1 THEN 'exon' ELSE 'polypeptide' END AS type, CASE WHEN file_level = 2 THEN '3' ELSE '' END AS color FROM fx_exons WHERE file_level > 0),
    s AS (SELECT seq_id, CASE WHEN type = 'exon' THEN feature_id ELSE parent_id END AS key, CASE WHEN type = 'exon' THEN 'misc_feature' ELSE 'CDS' END AS type, strand, color, string_agg(concat(start_pos::VARCHAR, '..', end_pos::VARCHAR), ',' ORDER BY start_pos, end_pos) AS i, count(*) AS n FROM k GROUP BY ALL)
    SELECT seq_id, key, type, CASE WHEN strand = -1 THEN concat('complement(', CASE WHEN n > 1 THEN concat('join(', i, ')') ELSE i END, ')') ELSE CASE WHEN n > 1 THEN concat('join(', i, ')') ELSE i END END AS location, color FROM s""",
)
def n9(t):
    profile = t.fx_exons.sparkSession.createDataFrame([("exon", "misc_feature", False), ("polypeptide", "CDS", True)], "type string, embl_type string, joined boolean")
    kind = F.when(F.col("file_level") == 0, "other").when(F.col("file_level") == 1, "exon").otherwise("polypeptide")
    color = T.embl_color([F.concat("type", F.col("file_level").cast("string")), F.col("type")], {"polypeptide2": "3"})
    return B.embl_table(t.fx_exons.withColumn("type", kind), profile, color)


@query("b3_embl_types", "SELECT CASE WHEN file_level = 1 THEN 'misc_feature' ELSE 'CDS' END AS type, count(DISTINCT CASE WHEN file_level = 1 THEN feature_id ELSE parent_id END) AS n FROM fx_exons WHERE file_level > 0 GROUP BY 1")
def b3(t):
    return n9(t).groupBy("type").agg(F.count("*").alias("n"))


@query(
    "b3_embl_qualifiers",
    """SELECT feature_id, CASE WHEN file_level = 3 THEN concat('id=', feature_id) ELSE concat('id=', feature_id, ' / ', CASE WHEN file_level = 2 THEN 'function=' ELSE 'note=Similar_to: ' END, parent_id, ' / note=Other_annotation: x',
    ' / note=Ontology_term: SO:0000147 / note=Pathways_annotations: a,b / ', CASE WHEN start_pos % 2 = 0 THEN 'pseudogene=unknown' ELSE 'note=Checked' END, ' / note=Structure_warnings: start end') END AS qualifiers FROM fx_exons""",
)
def b3_qualifiers(t):
    pairs = (("ID", ["feature_id"]), ("Name", ["feature_id"]), ("Note", ["parent_id", F.lit("x")]), ("Ontology_term", [F.lit("SO:0000147")]), ("Parent", ["parent_id"]), ("pathways_annotations", [F.lit("a"), F.lit("b")]), ("status", [F.when(F.col("start_pos") % 2 == 0, "pseudo").otherwise("checked")]), ("structure_warnings", [F.lit("start"), F.lit("end")]))
    attributes = F.create_map(*(x for k, v in pairs for x in (F.lit(k), F.array(*v))))
    found = B.embl_qualifiers(attributes, F.when(F.col("file_level") == 2, "tRNA").otherwise("mRNA"), F.col("file_level") == 3)
    return t.fx_exons.select("feature_id", F.array_join(F.transform(found, lambda q: F.concat(q["name"], F.lit("="), q["value"])), " / ").alias("qualifiers"))


@query("i2_union_repeats", "SELECT 'a' AS origin, seq_id, start_pos, end_pos FROM fx_exons WHERE file_level = 0 UNION ALL SELECT 'b', seq_id, start_pos, end_pos FROM fx_evidence")
def i2(t):
    a = t.fx_exons.where("file_level = 0").select(F.lit("a").alias("origin"), "seq_id", "start_pos", "end_pos")
    return a.unionByName(t.fx_evidence.select(F.lit("b").alias("origin"), "seq_id", "start_pos", "end_pos"))


def saved(lines, name: str) -> str:
    """Lines written to the shared folder as text files."""
    import uuid

    from strandweave.operators.graph import shared_folder

    path = f"{shared_folder(lines.sparkSession)}/{name}-{uuid.uuid4().hex}"
    lines.select("value").write.text(path)
    return path


#: Records of an XML file on average, if there are more than eight such files.
PER_FILE = 250_000


def saved_xml(records, root: str, files: int = 8, value="value") -> str:
    """XML records written to the shared folder, one document a file: the reader takes only the first of a file.

    There are ``files`` of them, more where these would have over ``PER_FILE`` records each; a task writes one. ``value``
    is the text of a record by the columns of ``records``. It is made behind the shuffle and written as gzip, so that
    markup is neither shuffled nor kept whole; a file is read by one task anyway.
    """
    import uuid

    from strandweave.operators.graph import shared_folder, without_shuffle_files

    spark = records.sparkSession
    path = f"{shared_folder(spark)}/{root}-{uuid.uuid4().hex}"
    with without_shuffle_files(spark):
        files = max(files, -(-records.count() // PER_FILE))
        rows = records.withColumns({"part": F.pmod(F.xxhash64(*records.columns), F.lit(files)).cast("int"), "place": F.lit(1)})
        ends = spark.range(files).select(F.col("id").cast("int").alias("part"), F.explode(F.array(F.lit(0), F.lit(2))).alias("place"))
        rows = rows.unionByName(ends, allowMissingColumns=True).repartitionById(files, "part").sortWithinPartitions("part", "place")
        line = F.when(F.col("place") == 0, f"<{root}>").when(F.col("place") == 2, f"</{root}>").otherwise(F.col(value) if isinstance(value, str) else value)
        rows.select("part", line.alias("value")).write.partitionBy("part").option("compression", "gzip").text(path)
    return path


@query("a3_read_fasta", "SELECT seq_id, 'a note' AS description, residues FROM fx_sequences")
def a3(t):
    rows = t.fx_sequences.select(F.concat(F.lit(">lcl|"), "seq_id", F.lit(" a note\n"), F.regexp_replace("residues", "(.{60})", "$1\n")).alias("value"))
    return P.read_fasta(rows.sparkSession, saved(rows, "fasta"))


@query("a3_fasta_tiles", "SELECT seq_id, k::INT AS tile_no, k * 256 + 1 AS tile_start, substring(residues, CAST(k * 256 + 1 AS INT), 256) AS residues FROM (SELECT seq_id, residues, unnest(range(0, 4)) AS k FROM fx_sequences)")
def a3_tiles(t):
    rows = t.fx_sequences.select(F.concat(F.lit(">"), "seq_id", F.lit("\n"), F.regexp_replace("residues", "(.{60})", "$1\n")).alias("value"))
    return P.read_fasta_tiles(rows.sparkSession, saved(rows, "fasta"), 256)


@query(
    "a4_read_search_xml",
    """SELECT query_id, query_len, hit_id, hit_len, strand, q_start, q_end, h_start, h_end, align_len, 2::BIGINT AS gaps, align_len - 2 AS hit_len_aligned, n_identical FROM fx_hsps""",
)
def a4(t):
    tag = lambda name, value: F.concat(F.lit(f"<{name}>"), value.cast("string"), F.lit(f"</{name}>"))
    c = F.col
    minus = c("strand") == -1
    hsp = F.concat(
        tag("Hsp_query-from", F.when(minus, c("q_end")).otherwise(c("q_start"))), tag("Hsp_query-to", F.when(minus, c("q_start")).otherwise(c("q_end"))), tag("Hsp_hit-from", c("h_start")), tag("Hsp_hit-to", c("h_end")),
        tag("Hsp_hit-frame", c("strand")), tag("Hsp_identity", c("n_identical")), tag("Hsp_align-len", c("align_len")), F.lit("<Hsp_hseq>AC--GT</Hsp_hseq>"),
    )
    hit = F.concat(tag("Hit_accession", c("hit_id")), tag("Hit_len", c("hit_len")), F.lit("<Hit_hsps><Hsp>"), hsp, F.lit("</Hsp></Hit_hsps>"))
    line = F.concat(F.lit("<Iteration>"), tag("Iteration_query-def", c("query_id")), tag("Iteration_query-len", c("query_len")), F.lit("<Iteration_hits><Hit>"), hit, F.lit("</Hit></Iteration_hits></Iteration>"))
    rows = t.fx_hsps.select("query_id", "query_len", "hit_id", "hit_len", "strand", "q_start", "q_end", "h_start", "h_end", "align_len", "n_identical")
    return P.read_search_xml(rows.sparkSession, saved_xml(rows, "report", value=line)).select("query_id", "query_len", "hit_id", "hit_len", "strand", "q_start", "q_end", "h_start", "h_end", "align_len", "gaps", "hit_len_aligned", "n_identical")


@query("a5_read_domain_table", "SELECT p_partkey::VARCHAR AS target, concat('D', (p_size)::VARCHAR) AS domain_id, 0.5::DOUBLE AS evalue, concat(p_name, ' x') AS description FROM part")
def a5(t):
    line = F.concat_ws("  ", F.col("p_partkey").cast("string"), F.concat(F.lit("D"), F.col("p_size").cast("string")), F.lit("q - 0.5 6 7 8 9 10 11 12 13 14 15 16 17 18"), F.concat("p_name", F.lit(" x")))
    rows = t.part.select(line.alias("value"))
    return P.read_domain_table(rows.sparkSession, saved(rows, "domains")).select("target", "domain_id", "evalue", "description")


@query("a8_read_ncrna_table", "SELECT feature_id AS name, seq_id, start_pos, end_pos, strand, (start_pos % 100 / 4)::DOUBLE AS score, concat('RF', file_level::VARCHAR) AS accession, concat('like ', parent_id, ' and more') AS description FROM fx_exons")
def a8(t):
    minus = F.col("strand") == -1
    s, e = F.col("start_pos").cast("string"), F.col("end_pos").cast("string")
    line = F.concat_ws(
        "  ", "feature_id", F.concat(F.lit("RF"), F.col("file_level").cast("string")), "seq_id", F.lit("- cm 1 9"), F.when(minus, e).otherwise(s), F.when(minus, s).otherwise(e), F.when(minus, "-").otherwise("+"),
        F.lit("no 1 0.5 0.0"), (F.col("start_pos") % 100 / 4).cast("string"), F.lit("1e-3 !"), F.concat(F.lit("like "), "parent_id", F.lit(" and more")),
    )
    rows = t.fx_exons.select(line.alias("value"))
    return P.read_ncrna_table(rows.sparkSession, saved(rows, "ncrna")).select("name", "seq_id", "start_pos", "end_pos", "strand", "score", "accession", "description")


@query("a9_read_rrna_gff", "SELECT seq_id, start_pos, end_pos, strand, feature_id AS note FROM fx_exons")
def a9(t):
    line = F.concat_ws("\t", "seq_id", F.lit("T"), F.lit("rRNA"), F.col("start_pos").cast("string"), F.col("end_pos").cast("string"), F.lit("1.5"), F.when(F.col("strand") == -1, "-").otherwise("+"), F.lit("."), "feature_id")
    rows = t.fx_exons.select(line.alias("value"))
    return P.read_rrna_gff(rows.sparkSession, saved(rows, "rrna")).select("seq_id", "start_pos", "end_pos", "strand", F.col("attributes")["Note"][0].alias("note"))


@query("a10_read_domains_tsv", "SELECT p_name AS protein_id, 'Pfam' AS tool, concat('PF', p_size::VARCHAR) AS domain_id, 1::BIGINT AS aa_start, p_size::BIGINT + 1 AS aa_end FROM part")
def a10(t):
    key = F.concat(F.lit("s"), F.col("p_partkey").cast("string"))
    line = F.concat_ws("\t", key, F.lit("crc"), F.lit("9"), F.lit("Pfam"), F.concat(F.lit("PF"), F.col("p_size").cast("string"), F.lit(";")), F.lit("n"), F.lit("1"), (F.col("p_size") + 1).cast("string"), F.lit("0.1"))
    rows = t.part.select(line.alias("value"))
    names = t.part.select(key.alias("short_id"), F.col("p_name").alias("protein_id"))
    return P.read_domains_tsv(rows.sparkSession, saved(rows, "tsv"), names).select("protein_id", "tool", "domain_id", "aa_start", "aa_end")


@query("a11_read_domains_xml", "SELECT p_name AS protein_id, concat('S', p_size::VARCHAR) AS signature, p_size::BIGINT AS aa_start, p_size::BIGINT + 9 AS aa_end, CASE WHEN p_partkey % 2 = 0 THEN 0.25::DOUBLE ELSE 0.5::DOUBLE END AS evalue FROM part")
def a11(t):
    size = F.col("p_size").cast("string")
    own = F.when(F.col("p_partkey") % 2 == 0, ' evalue="0.25"').otherwise("")
    line = F.concat(F.lit('<protein><xref id="'), "p_name", F.lit('"/><matches><match evalue="0.5"><signature ac="S'), size, F.lit('"/><locations><location start="'), size, F.lit('" end="'), (F.col("p_size") + 9).cast("string"), F.lit('"'), own, F.lit("/></locations></match></matches></protein>"))
    rows = t.part.select("p_partkey", "p_name", "p_size")
    return P.read_domains_xml(rows.sparkSession, saved_xml(rows, "matches", value=line)).select("protein_id", "signature", "aa_start", "aa_end", "evalue")


@query("a21_read_run_tables", "SELECT task_id, kind AS name, status, chunk_no::DOUBLE AS real_time FROM fx_task_runs")
def a21(t):
    line = F.concat(F.lit('<program id="'), F.col("task_id").cast("string"), F.lit('" name="'), "kind", F.lit('"><status>'), F.col("status").cast("string"), F.lit("</status><real_time>"), F.col("chunk_no").cast("string"), F.lit("</real_time></program>"))
    rows = t.fx_task_runs.select("task_id", "kind", "status", "chunk_no")
    return P.read_run_tables(rows.sparkSession, saved_xml(rows, "unit", value=line)).select("task_id", "name", "status", "real_time")


@query(
    "a22_spliced_alignments",
    """WITH k AS (SELECT seq_id, seq_no, residues, 10 + seq_no % 20 AS n1, 15 + seq_no % 30 AS n2, seq_no % 1000 + 1 AS s, 40 + seq_no % 90 AS gap FROM fx_sequences), p AS (SELECT *, substring(residues, 41, CAST(n2 AS INT)) AS b FROM k)
    SELECT seq_id AS transcript_id, 1::INT AS exon, 1::BIGINT AS q_start, n1 AS q_end, s AS g_start, s + n1 - 1 AS g_end, n1::INT AS match_len FROM p
    UNION ALL SELECT seq_id, 2, n1 + 1, n1 + n2 - 1, s + n1 + gap, s + n1 + gap + n2 - 1, (length(replace(b, 'A', '')) - CASE WHEN left(b, 1) = 'A' THEN 0 ELSE 1 END)::INT FROM p""",
)
def a22(t):
    """Two exons of each sequence: the first one alike, in the second one the query lacks a letter and has G for each A."""
    n1, n2 = F.col("seq_no") % 20 + 10, F.col("seq_no") % 30 + 15
    piece = lambda at, n: F.substring(F.col("residues"), F.lit(at), n.cast("int"))
    second = piece(41, n2)
    query = F.concat(piece(1, n1), F.lit("...."), F.lit("-"), F.substring(F.translate(second, "A", "G"), F.lit(2), n2.cast("int")))
    rows = t.fx_sequences.select(F.col("seq_id").alias("transcript_id"), F.lit(1).cast("long").alias("q_start"), (F.col("seq_no") % 1000 + 1).alias("t_start"), query.alias("query"), F.concat(piece(1, n1), F.lit("...."), second).alias("subject"), F.array(F.col("seq_no") % 90 + 40).alias("introns"))
    return P.parse_spliced_alignments(rows).select("transcript_id", "exon", "q_start", "q_end", "g_start", "g_end", "match_len")


@query(
    "a20_named_set",
    """SELECT CASE WHEN file_level = 0 THEN 1 ELSE 12 END AS step, CASE WHEN file_level = 0 THEN 'TOOLA' ELSE 'TOOLB' END AS tool, CASE WHEN file_level = 0 THEN 'some_db' ELSE 'other.db' END AS db, feature_id, start_pos FROM fx_exons WHERE file_level < 2""",
)
def a20(t):
    import uuid

    from strandweave.operators.graph import shared_folder

    folder = f"{shared_folder(t.fx_exons.sparkSession)}/named-{uuid.uuid4().hex}"
    line = F.concat_ws("\t", "seq_id", F.lit("T"), F.lit("exon"), F.col("start_pos").cast("string"), F.col("end_pos").cast("string"), F.lit("."), F.when(F.col("strand") == -1, "-").otherwise("+"), F.lit("."), F.concat(F.lit("ID="), "feature_id"))
    name = F.when(F.col("file_level") == 0, "1_TOOLA_some_db.gff").otherwise("12_TOOLB_other.db.gff")
    named_files(t.fx_exons.where("file_level < 2").select(name.alias("name"), line.alias("value")), folder)
    return P.read_named_set(t.fx_exons.sparkSession, f"{folder}/*/*.gff").select("step", "tool", "db", F.col("attributes")["ID"][0].alias("feature_id"), "start_pos")


def named_files(lines, folder: str) -> None:
    """``lines(name, value)`` as text files of these names, as a tool would have written them.

    Each task writes its own file of a name, into a folder of its own, so that no name is the work of one task.
    """
    spark = lines.sparkSession
    written = f"{folder}/written"
    lines.write.partitionBy("name").text(written)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(written).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for k, part in enumerate(fs.globStatus(path(f"{written}/name=*/part-*"))):
        fs.mkdirs(path(f"{folder}/{k:05d}"))
        fs.rename(part.getPath(), path(f"{folder}/{k:05d}/{part.getPath().getParent().getName().removeprefix('name=')}"))

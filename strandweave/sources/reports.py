"""Report files as tables. ``read_*`` take a path that Spark can read; ``parse_*`` take lines that are rows already.

Lines keep their file and their order in it (``ordinal``: where the file's block starts, then the row inside it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandweave.functions import text as T
from strandweave.operators.intervals import latest



def lines(spark: SparkSession, path: str, separator: str | None = None) -> DataFrame:
    reader = spark.read if separator is None else spark.read.option("lineSep", separator)
    rows = reader.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__block"))
    # Ids grow inside a partition, and a partition holds whole blocks in order.
    return rows.withColumn("ordinal", F.monotonically_increasing_id())


def _fields(rows: DataFrame, pattern: str, limit: int = -1) -> DataFrame:
    return rows.withColumn("f", F.split("value", pattern, limit))


def _number(text: Column, kind: str) -> Column:
    return F.when(text != ".", text).try_cast(kind)


def parse_gff3(rows: DataFrame) -> DataFrame:
    """Features of GFF3 lines (column ``value``); comments and blank lines are skipped, other columns stay."""
    good = _fields(rows.where(~F.startswith(F.trim("value"), F.lit("#")) & (F.trim("value") != "")), "\t").where(F.size("f") >= 9)
    f = lambda k: F.col("f")[k]
    features = good.withColumns({
        "seq_id": f(0), "source": f(1), "type": f(2), "start_pos": f(3).try_cast("long"), "end_pos": f(4).try_cast("long"), "score": _number(f(5), "double"),
        "strand": F.when(f(6) == "-", -1).when(f(6) == "+", 1), "phase": _number(f(7), "int"), "attributes": T.parse_attributes(f(8)),
    })
    first = lambda key: F.try_element_at(F.try_element_at("attributes", F.lit(key)), F.lit(1))
    return features.withColumns({"feature_id": first("ID"), "parent_id": F.coalesce(first("Derives_from"), first("Parent"))}).drop("f", "value")


def read_gff3(spark: SparkSession, path: str) -> DataFrame:
    return parse_gff3(lines(spark, path).drop("__block"))


def read_markers(spark: SparkSession, path: str) -> DataFrame:
    """GFF3 without its region rows."""
    return read_gff3(spark, path).where("type <> 'region'")


def read_rrna_gff(spark: SparkSession, path: str) -> DataFrame:
    """Version 1 files: the ninth field is a name, which becomes the note."""
    good = _fields(lines(spark, path).where("value not like '#%' and trim(value) <> ''"), "\t").where(F.size("f") >= 8)
    f = lambda k: F.col("f")[k]
    return good.select(f(0).alias("seq_id"), F.lit("rRNA").alias("type"), f(3).cast("long").alias("start_pos"), f(4).cast("long").alias("end_pos"), _number(f(5), "double").alias("score"), F.when(f(6) == "-", -1).otherwise(1).alias("strand"), F.create_map(F.lit("Note"), F.array(F.coalesce(F.try_element_at("f", F.lit(9)), F.lit("")))).alias("attributes"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(seq_id, description, residues) of files whose records fit into a row; long sequences: ``read_fasta_tiles``."""
    records = lines(spark, path, "\n>").where("trim(value) <> ''").withColumn("value", F.regexp_replace("value", "^>", ""))
    header = F.substring_index("value", "\n", 1)
    body = F.regexp_replace(F.substring("value", F.length(header) + 1, F.length("value")), r"\s", "")
    return records.select(T.clean_seq_name(header).alias("seq_id"), F.trim(F.regexp_replace(header, r"^\S*", "")).alias("description"), body.alias("residues"))


def read_fasta_tiles(spark: SparkSession, path: str, width: int = 65_536) -> DataFrame:
    """(seq_id, tile_no, tile_start, residues): lines find their header and their offset, then meet by tile.

    No record has to fit into a row, and no file into a task: header and offset are carried from block to block of a file
    by a table with a row for each block (the bases in it, and its last header).
    """
    rows = lines(spark, path).where("trim(value) <> ''")
    header = F.when(F.startswith("value", F.lit(">")), T.clean_seq_name(F.col("value")))
    rows = rows.withColumns({"header": header, "value": F.trim("value")}).withColumn("size", F.when(F.col("header").isNull(), F.length("value")).otherwise(0))
    blocks = rows.groupBy("file", "__block").agg(F.sum("size").alias("bases"))
    blocks = blocks.select("file", "__block", F.coalesce(F.sum("bases").over(W.partitionBy("file").orderBy("__block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    inside = F.coalesce(F.sum("size").over(W.partitionBy("file", "__block").orderBy("ordinal").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("inside", inside).join(blocks, ["file", "__block"]).withColumn("before", F.col("ahead") + F.col("inside"))
    opens = F.when(F.col("header").isNotNull(), F.struct(F.col("header").alias("seq_id"), F.col("before").alias("base")))
    rows = latest(rows, ["file"], opens, ["ordinal"], F.col("__block"), "record").where("header is null and record is not null")
    rows = rows.select("value", F.col("record.seq_id").alias("seq_id"), (F.col("before") - F.col("record.base")).alias("at"))
    first, last = F.floor(F.col("at") / width), F.floor((F.col("at") + F.length("value") - 1) / width)
    cut = rows.withColumn("tile_no", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("at"), F.col("tile_no") * width)
    end = F.least(F.col("at") + F.length("value"), (F.col("tile_no") + 1) * width)
    piece = F.substring("value", (begin - F.col("at") + 1).cast("int"), (end - begin).cast("int"))
    tiles = cut.groupBy("seq_id", "tile_no").agg(F.sort_array(F.collect_list(F.struct("at", piece.alias("piece")))).alias("p"))
    return tiles.select("seq_id", F.col("tile_no").cast("int").alias("tile_no"), (F.col("tile_no") * width + 1).alias("tile_start"), F.array_join(F.transform("p", lambda p: p["piece"]), "").alias("residues"))


_HSP = "struct<`Hsp_bit-score`:double,Hsp_evalue:double,`Hsp_query-from`:bigint,`Hsp_query-to`:bigint,`Hsp_hit-from`:bigint,`Hsp_hit-to`:bigint,`Hsp_query-frame`:int,`Hsp_hit-frame`:int,Hsp_identity:bigint,Hsp_positive:bigint,`Hsp_align-len`:bigint,Hsp_qseq:string,Hsp_hseq:string>"
_ITERATION = f"`Iteration_query-def` string, `Iteration_query-len` bigint, Iteration_hits struct<Hit:array<struct<Hit_accession:string,Hit_def:string,Hit_len:bigint,Hit_hsps:struct<Hsp:array<{_HSP}>>>>>"


def read_search_xml(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of a search report: ends in order, strand from the hit's frame or else the query's, gaps of the hit."""
    rows = spark.read.schema(_ITERATION).option("rowTag", "Iteration").xml(path)
    hits = rows.select(F.col("`Iteration_query-def`").alias("query_id"), F.col("`Iteration_query-len`").alias("query_len"), F.explode("Iteration_hits.Hit").alias("h"))
    hsps = hits.select("query_id", "query_len", F.col("h.Hit_accession").alias("hit_id"), F.col("h.Hit_def").alias("hit_description"), F.col("h.Hit_len").alias("hit_len"), F.posexplode("h.Hit_hsps.Hsp").alias("hsp_no", "p"))
    p = lambda name: F.col(f"p.`Hsp_{name}`")
    frame = F.coalesce(F.nullif(p("hit-frame"), F.lit(0)), p("query-frame"), F.lit(1))
    gaps = F.length(F.regexp_replace(p("hseq"), "[^-]", ""))
    return hsps.select(
        "query_id", "query_len", "hit_id", "hit_len", "hit_description", (F.col("hsp_no") + 1).alias("hsp_no"), F.when(frame < 0, -1).otherwise(1).alias("strand"),
        F.least(p("query-from"), p("query-to")).alias("q_start"), F.greatest(p("query-from"), p("query-to")).alias("q_end"),
        F.least(p("hit-from"), p("hit-to")).alias("h_start"), F.greatest(p("hit-from"), p("hit-to")).alias("h_end"), p("align-len").alias("align_len"), gaps.cast("long").alias("gaps"),
        (p("align-len") - gaps).alias("hit_len_aligned"), p("identity").alias("n_identical"), p("positive").alias("n_positive"), p("evalue").alias("evalue"), p("bit-score").alias("bit_score"),
        T.hsp_pct(p("identity"), p("align-len")).alias("percent_identity"), p("qseq").alias("q_aln"), p("hseq").alias("h_aln"),
    )


def read_domain_table(spark: SparkSession, path: str) -> DataFrame:
    """Domain hits of a blank-separated table with a free description in the nineteenth field."""
    f = lambda k: F.col("f")[k]
    good = _fields(lines(spark, path).where("value not like '#%' and trim(value) <> ''"), r"\s+", 19)
    return good.select(f(0).alias("target"), f(1).alias("domain_id"), f(2).alias("query_id"), f(4).cast("double").alias("evalue"), T.clean_description(f(18)).alias("description"))


def parse_kmer_counts(rows: DataFrame) -> DataFrame:
    """(strand, pos, n, mer) of lines ``+5<TAB>9<TAB>mer``."""
    good = _fields(rows, "\t")
    sign = lambda k: F.regexp_extract(F.col("f")[0], r"^([+-])(\d+)$", k)
    return good.select(*(c for c in rows.columns if c != "value"), sign(1).alias("strand"), sign(2).try_cast("long").alias("pos"), F.col("f")[1].try_cast("long").alias("n"), F.try_element_at("f", F.lit(3)).alias("mer"))


def read_kmer_counts(spark: SparkSession, path: str) -> DataFrame:
    return parse_kmer_counts(lines(spark, path).select("value", "file"))


def parse_trna(rows: DataFrame) -> DataFrame:
    """tRNA features: reversed ends mean the minus strand, row by row; an intron only if both its ends are given."""
    good = _fields(rows.where(F.col("value").rlike(r"^\S+\s+\d+\s+\d+")), r"\s+")
    f = lambda k: F.col("f")[k]
    a, b, x, y = (f(k).cast("long") for k in (2, 3, 6, 7))
    amino = T.amino_name(f(4))
    note = F.concat(F.when(a > b, "(Reverse) ").otherwise(""), amino)
    intron = (x != 0) & (y != 0)
    return good.select(
        f(0).alias("seq_id"), F.lit("tRNA").alias("type"), F.least(a, b).alias("start_pos"), F.greatest(a, b).alias("end_pos"), F.when(a > b, -1).otherwise(1).alias("strand"),
        f(8).cast("double").alias("score"), note.alias("note"), F.when(f(5) == "???", "Unknow anticodon").otherwise(f(5)).alias("anticodon"),
        F.when(intron, F.least(x, y)).alias("intron_start"), F.when(intron, F.greatest(x, y)).alias("intron_end"),
    )


def read_trna_table(spark: SparkSession, path: str) -> DataFrame:
    return parse_trna(lines(spark, path))


def read_ncrna_table(spark: SparkSession, path: str) -> DataFrame:
    """ncRNA features of a table with 18 blank-separated fields."""
    f = lambda k: F.col("f")[k]
    rows = lines(spark, path).where("value not like '#%' and trim(value) <> ''").withColumn("value", F.regexp_replace("value", " +", " "))
    a, b = f(7).cast("long"), f(8).cast("long")
    return _fields(rows, " ", 18).select(f(2).alias("seq_id"), F.lit("ncRNA").alias("type"), F.least(a, b).alias("start_pos"), F.greatest(a, b).alias("end_pos"), F.when(f(9) == "-", -1).otherwise(1).alias("strand"), f(14).cast("double").alias("score"), f(15).cast("double").alias("evalue"), f(0).alias("name"), f(1).alias("accession"), f(17).alias("description"))


def read_domains_tsv(spark: SparkSession, path: str, id_map: DataFrame) -> DataFrame:
    """Protein domains of a tabular report, with the proteins' real names from ``id_map(short_id, protein_id)``."""
    f = lambda k: F.regexp_replace(F.col("f")[k], "[;,]", "")
    rows = _fields(lines(spark, path).where("trim(value) <> ''"), "\t")
    return rows.select(f(0).alias("short_id"), f(3).alias("tool"), f(4).alias("domain_id"), f(5).alias("name"), f(6).cast("long").alias("aa_start"), f(7).cast("long").alias("aa_end"), f(8).try_cast("double").alias("evalue")).join(id_map, "short_id")


_LOCATION = "struct<_start:bigint,_end:bigint,_evalue:double>"
_SIGNATURE = "struct<_ac:string,_name:string,entry:struct<_ac:string,_desc:string,`go-xref`:array<struct<_id:string,_category:string,_name:string>>,`pathway-xref`:array<struct<_id:string,_db:string>>>>"
_MATCH = f"struct<_evalue:double,signature:{_SIGNATURE},locations:struct<location:array<{_LOCATION}>>>"
_PROTEIN = f"xref array<struct<_id:string>>, matches struct<match:array<{_MATCH}>>"


def read_domains_xml(spark: SparkSession, path: str) -> DataFrame:
    """Protein domains of an XML report: a row for each name of the protein, match and location; an e-value at the
    location wins over that of the match."""
    rows = spark.read.schema(_PROTEIN).option("rowTag", "protein").xml(path)
    m = rows.select(F.explode("xref._id").alias("protein_id"), "matches").select("protein_id", F.explode("matches.match").alias("m"))
    m = m.select("protein_id", "m", F.explode("m.locations.location").alias("l"))
    entry = lambda name: F.col(f"m.signature.entry.{name}")
    return m.select("protein_id", F.col("m.signature._ac").alias("signature"), F.col("m.signature._name").alias("name"), entry("_ac").alias("entry"), entry("_desc").alias("description"), F.col("m.signature.entry.`go-xref`._id").alias("go"), F.col("m.signature.entry.`pathway-xref`._id").alias("pathways"), F.col("l._start").alias("aa_start"), F.col("l._end").alias("aa_end"), F.coalesce("l._evalue", "m._evalue").alias("evalue"))


def parse_vulgar(rows: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """match_part rows of ``vulgar:`` lines.

    Only M makes a part; an M behind a G extends the part before it; the bases of an S count to the parts on both sides.
    Starts are 0-based: one is added to the start on the plus strand, to the end on the minus strand.
    """
    keep = keep or []
    head = r"^vulgar: (\S+) (\d+) (\d+) (\S) (\S+) (\d+) (\d+) (\S) (-?\d+) (.*)$"
    g = lambda k: F.regexp_extract("value", head, k)
    rows = rows.where(F.col("value").rlike(head)).select(*keep, g(1).alias("query_id"), g(2).cast("long").alias("q0"), g(4).alias("q_strand"), g(5).alias("target_id"), g(6).cast("long").alias("t0"), g(8).alias("t_strand"), g(9).cast("long").alias("score"), g(10).alias("ops"), F.monotonically_increasing_id().alias("__line"))
    steps = F.regexp_extract_all("ops", F.lit(r"([MCGN53ISF] \d+ \d+)"), F.lit(1))
    s = rows.select("*", F.posexplode(steps).alias("k", "step")).drop("ops")
    part = F.split("step", " ")
    s = s.withColumns({"op": part[0], "q": part[1].cast("long"), "t": part[2].cast("long")}).drop("step")
    order = W.partitionBy("__line").orderBy("k")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    s = s.withColumns({"qo": F.coalesce(F.sum("q").over(before), F.lit(0)), "to": F.coalesce(F.sum("t").over(before), F.lit(0)), "last": F.lag("op").over(order), "next": F.lead("op").over(order), "lq": F.lag("q").over(order), "lt": F.lag("t").over(order), "nq": F.lead("q").over(order), "nt": F.lead("t").over(order)})
    m = s.where("op = 'M'").withColumn("new", (F.coalesce("last", F.lit("")) != "G").cast("int"))
    m = m.withColumn("part", F.sum("new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    split_before, split_after = F.col("last") == "S", F.col("next") == "S"
    ends = {
        "qa": F.col("qo") - F.when(split_before, F.col("lq")).otherwise(0), "qb": F.col("qo") + F.col("q") + F.when(split_after, F.col("nq")).otherwise(0),
        "ta": F.col("to") - F.when(split_before, F.col("lt")).otherwise(0), "tb": F.col("to") + F.col("t") + F.when(split_after, F.col("nt")).otherwise(0),
    }
    parts = m.withColumns(ends).groupBy(*keep, "__line", "query_id", "target_id", "q0", "t0", "q_strand", "t_strand", "score", "part").agg(*(f(c).alias(c) for f, c in ((F.min, "qa"), (F.max, "qb"), (F.min, "ta"), (F.max, "tb"))))

    def axis(zero: str, strand: str, a: str, b: str) -> tuple[Column, Column]:
        minus = F.col(strand) == "-"
        return F.when(minus, F.col(zero) - F.col(b) + 1).otherwise(F.col(zero) + F.col(a) + 1), F.when(minus, F.col(zero) - F.col(a)).otherwise(F.col(zero) + F.col(b))

    q, t = axis("q0", "q_strand", "qa", "qb"), axis("t0", "t_strand", "ta", "tb")
    return parts.select(*keep, "query_id", "target_id", F.col("part").cast("int").alias("part"), F.when(F.col("t_strand") == "-", -1).otherwise(1).alias("strand"), "score", q[0].alias("q_start"), q[1].alias("q_end"), t[0].alias("start_pos"), t[1].alias("end_pos"))


def read_vulgar(spark: SparkSession, path: str) -> DataFrame:
    return parse_vulgar(lines(spark, path).select("value"))


def parse_orf_headers(rows: DataFrame) -> DataFrame:
    """Coordinates and strand from a ``header`` that has ``[a - b]`` and perhaps ``REVERSE SENSE``."""
    at = lambda k: F.regexp_extract("header", r"\[(\d+) - (\d+)\]", k).try_cast("long")
    return rows.withColumns({"start_pos": F.least(at(1), at(2)), "end_pos": F.greatest(at(1), at(2)), "strand": F.when(F.contains("header", F.lit("REVERSE SENSE")), -1).otherwise(1)}).drop("header")


def exons_to_genes(exons: DataFrame) -> DataFrame:
    """gene, mRNA, exon and polypeptide rows of exon-level predictions, and UTRs up to a promoter or polyA site.

    ``exons(seq_id, gene_id, strand, start_pos, end_pos, promoter, poly_a)``; sites are positions or null. Genes are
    grouped where they are if ``exons`` is partitioned by gene, so that its number of partitions bounds a task.
    """
    by = ["seq_id", "gene_id", "strand"]
    bounds = exons.groupBy(*by).agg(F.min("start_pos").alias("first"), F.max("end_pos").alias("last"), F.first("promoter").alias("promoter"), F.first("poly_a").alias("poly_a"))
    plus = F.col("strand") != -1
    row = lambda kind, a, b: F.struct(F.lit(kind).alias("type"), F.col(a).alias("start_pos") if isinstance(a, str) else a.alias("start_pos"), F.col(b).alias("end_pos") if isinstance(b, str) else b.alias("end_pos"))
    utr = lambda kind, site, low: row(kind, F.when(low, F.col(site)).otherwise(F.col("last") + 1), F.when(low, F.col("first") - 1).otherwise(F.col(site)))
    of_gene = F.array(row("gene", "first", "last"), row("mRNA", "first", "last"), utr("five_prime_UTR", "promoter", plus), utr("three_prime_UTR", "poly_a", ~plus))
    rows = bounds.select(*by, F.inline(of_gene)).where("type in ('gene', 'mRNA') or start_pos <= end_pos")
    of_exon = F.explode(F.array(F.lit("exon"), F.lit("polypeptide"))).alias("type")
    return rows.unionByName(exons.select(*by, of_exon, "start_pos", "end_pos"))


def read_named_set(spark: SparkSession, path: str) -> DataFrame:
    """GFF3 features with step, tool and databank from file names ``step_tool_databank.ext``; other names are an error."""
    name = F.regexp_extract("file", r"([^/]+)$", 1)
    part = lambda k: F.regexp_extract(name, r"^(\d+)_([^_]+)_(.+)\.[^.]+$", k)
    known = F.when(part(1) != "", part(1)).otherwise(F.raise_error(F.concat(F.lit("not step_tool_databank: "), name)))
    return read_gff3(spark, path).withColumns({"step": known.cast("int"), "tool": part(2), "db": part(3)})


def read_run_tables(spark: SparkSession, path: str) -> DataFrame:
    """Task records: (task_id, name, status, real_time, cpu_time)."""
    schema = "_id bigint, _name string, status int, real_time double, cpu_time double"
    return spark.read.schema(schema).option("rowTag", "program").xml(path).withColumnsRenamed({"_id": "task_id", "_name": "name"})


def parse_spliced_alignments(rows: DataFrame) -> DataFrame:
    """Exons of alignments ``(transcript_id, q_start, t_start, query, subject, introns array<long>)``: introns are runs
    of dots in both strings; their real lengths are in ``introns``. Identity is that of the exon's columns."""
    blocks = F.arrays_zip(F.split("query", r"\.+").alias("q"), F.split("subject", r"\.+").alias("s"))
    e = rows.select("transcript_id", "q_start", "t_start", "introns", F.posexplode(blocks).alias("k", "b"))
    letters = lambda c: F.length(F.regexp_replace(c, "[^A-Za-z]", ""))
    e = e.withColumns({"q_len": letters(F.col("b.q")), "t_len": letters(F.col("b.s")), "aln_len": F.length("b.q")})
    from strandweave.functions.sequence import matched_letters

    e = e.withColumn("match_len", matched_letters(F.col("b.q"), F.col("b.s")))
    before = W.partitionBy("transcript_id").orderBy("k").rowsBetween(W.unboundedPreceding, -1)
    skipped = F.aggregate(F.slice("introns", F.lit(1), F.col("k")), F.lit(0).cast("long"), lambda a, x: a + x)
    q0, t0 = F.coalesce(F.sum("q_len").over(before), F.lit(0)), F.coalesce(F.sum("t_len").over(before), F.lit(0))
    q_start, g_start = F.col("q_start") + q0, F.col("t_start") + t0 + skipped
    return e.select("transcript_id", (F.col("k") + 1).alias("exon"), q_start.alias("q_start"), (q_start + F.col("q_len") - 1).alias("q_end"), g_start.alias("g_start"), (g_start + F.col("t_len") - 1).alias("g_end"), F.col("aln_len").alias("aln_len"), "match_len", F.round(F.col("match_len") / F.col("aln_len"), 4).alias("identity"))


def repeats_to_features(repeats: DataFrame, library: DataFrame) -> DataFrame:
    """repeat_region rows with the repeat's length and description, and how much of it a hit covers (percent)."""
    rows = repeats.join(library, "repeat_id", "left")
    return rows.withColumns({"type": F.lit("repeat_region"), "note": F.coalesce("description", F.lit("unknown")), "coverage": F.when(F.col("repeat_len") > 0, F.round((F.col("r_end") - F.col("r_start") + 1) * 100 / F.col("repeat_len"), 2))}).drop("description")


def tandem_repeats(rows: DataFrame) -> DataFrame:
    """tandem_repeat rows, numbered along each sequence: motif, its size and the number of copies."""
    number = F.row_number().over(W.partitionBy("seq_id").orderBy("start_pos", "end_pos", "motif"))
    copies = F.round((F.col("end_pos") - F.col("start_pos") + 1) / F.length("motif"), 1)
    return rows.select("seq_id", F.lit("tandem_repeat").alias("type"), "start_pos", "end_pos", "motif", F.length("motif").alias("motif_size"), copies.alias("copies"), T.four_digits(number).alias("number"))



"""Report files written by hand, with results computed by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strandweave.sources import reports, sinks


def write(path, text):
    path.write_text(text)
    return str(path)


def test_gff3(spark, tmp_path):
    text = "##gff-version 3\n\nchr1\tTOOL\tgene\t101\t400\t.\t+\t.\tID=g1;Name=g1\nchr1\tTOOL\tmRNA\t101\t400\t.\t+\t.\tID=m1;Parent=g1;pseudogene=No methionine,Internal stop\nchr1\tTOOL\tpolypeptide\t101\t200\t1.5\t-\t0\tID=p1;Derives_from=m1;Parent=x\n"
    rows = {r.feature_id: r for r in reports.read_gff3(spark, write(tmp_path / "a.gff3", text)).collect()}
    assert set(rows) == {"g1", "m1", "p1"}
    assert (rows["g1"].score, rows["g1"].strand, rows["g1"].phase, rows["g1"].parent_id) == (None, 1, None, None)
    assert rows["m1"].attributes["pseudogene"] == ["No methionine", "Internal stop"]
    assert (rows["p1"].parent_id, rows["p1"].strand, rows["p1"].score, rows["p1"].phase) == ("m1", -1, 1.5, 0)


def test_named_set(spark, tmp_path):
    line = "chr1\tT\texon\t1\t9\t.\t+\t.\tID=e\n"
    write(tmp_path / "12_TOOL_some_db.gff", line)
    row = reports.read_named_set(spark, str(tmp_path)).first()
    assert (row.step, row.tool, row.db) == (12, "TOOL", "some_db")
    write(tmp_path / "nothing.gff", line)
    with pytest.raises(Exception, match="not step_tool_databank"):
        reports.read_named_set(spark, str(tmp_path)).collect()


def test_fasta(spark, tmp_path):
    path = write(tmp_path / "a.fa", ">lcl|seq*1 some text\nACGT\nAC\n>gnl|db|x_\nGGG\n>\nA\n")
    assert sorted(tuple(r) for r in reports.read_fasta(spark, path).collect()) == [("seq_1", "some text", "ACGTAC"), ("unknownId", "", "A"), ("x", "", "GGG")]
    tiles = sorted(tuple(r) for r in reports.read_fasta_tiles(spark, path, 4).collect())
    assert tiles == [("seq_1", 0, 1, "ACGT"), ("seq_1", 1, 5, "AC"), ("unknownId", 0, 1, "A"), ("x", 0, 1, "GGG")]


def test_a_long_record_is_read_by_all_splits_of_its_file(spark, tmp_path):
    bases = "".join("ACGT"[(i * i + i // 7) % 4] for i in range(60_000))
    wrapped = "\n".join(bases[i : i + 60] for i in range(0, len(bases), 60))
    path = write(tmp_path / "long.fa", f">first\nACGT\n\n>long one\n{wrapped}\n>last\nGG\nTT\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        assert reports.lines(spark, path).rdd.getNumPartitions() > 5
        tiles = sorted(tuple(r) for r in reports.read_fasta_tiles(spark, path, 1000).collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tiles == sorted([("first", 0, 1, "ACGT"), ("last", 0, 1, "GGTT"), *(("long", k, 1000 * k + 1, bases[1000 * k : 1000 * k + 1000]) for k in range(60))])


def test_search_xml(spark, tmp_path):
    text = """<BlastOutput><BlastOutput_iterations><Iteration><Iteration_query-def>q1</Iteration_query-def><Iteration_hits>
<Hit><Hit_accession>h1</Hit_accession><Hit_len>100</Hit_len><Hit_def>some def</Hit_def><Hit_hsps>
<Hsp><Hsp_bit-score>50</Hsp_bit-score><Hsp_evalue>1e-9</Hsp_evalue><Hsp_query-from>30</Hsp_query-from><Hsp_query-to>1</Hsp_query-to>
<Hsp_hit-from>1</Hsp_hit-from><Hsp_hit-to>28</Hsp_hit-to><Hsp_hit-frame>-1</Hsp_hit-frame><Hsp_identity>27</Hsp_identity>
<Hsp_positive>27</Hsp_positive><Hsp_align-len>30</Hsp_align-len><Hsp_hseq>ACGT--ACGT</Hsp_hseq></Hsp></Hit_hsps></Hit>
</Iteration_hits></Iteration></BlastOutput_iterations></BlastOutput>"""
    row = reports.read_search_xml(spark, write(tmp_path / "a.xml", text)).first()
    assert (row.query_id, row.hit_id, row.strand, row.q_start, row.q_end, row.gaps, row.hit_len_aligned, row.percent_identity) == ("q1", "h1", -1, 1, 30, 2, 28, 90.0)


def test_domain_xml(spark, tmp_path):
    text = """<matches><protein><xref id="p1"/><xref id="p2"/><matches><match evalue="0.1"><signature ac="S1" name="sig"><entry ac="E1" desc="d"><go-xref id="GO:1" category="c" name="n"/></entry></signature>
<locations><location start="5" end="20" evalue="0.01"/><location start="30" end="40"/></locations></match></matches></protein></matches>"""
    rows = sorted((r.protein_id, r.aa_start, r.aa_end, r.evalue, r.go) for r in reports.read_domains_xml(spark, write(tmp_path / "d.xml", text)).collect())
    assert rows == [("p1", 5, 20, 0.01, ["GO:1"]), ("p1", 30, 40, 0.1, ["GO:1"]), ("p2", 5, 20, 0.01, ["GO:1"]), ("p2", 30, 40, 0.1, ["GO:1"])]


def test_vulgar(spark, tmp_path):
    text = "vulgar: q 0 20 + t 100 220 + 99 M 10 10 5 0 2 I 0 96 3 0 2 M 10 10\nvulgar: r 0 20 + t 220 100 - 99 M 10 10 5 0 2 I 0 96 3 0 2 M 10 10\n"
    rows = sorted((r.query_id, r.part, r.strand, r.q_start, r.q_end, r.start_pos, r.end_pos) for r in reports.read_vulgar(spark, write(tmp_path / "v.txt", text)).collect())
    assert rows == [("q", 1, 1, 1, 10, 101, 110), ("q", 2, 1, 11, 20, 211, 220), ("r", 1, -1, 1, 10, 211, 220), ("r", 2, -1, 11, 20, 101, 110)]


def test_kmer_counts(spark, tmp_path):
    from strandweave.operators.masking import kmer_regions

    rows = reports.read_kmer_counts(spark, write(tmp_path / "k.txt", "+0\t9\n+5\t9\n+7\t3\n-9\t9\n"))
    plus = rows.where("strand = '+'").selectExpr("'s' AS seq_id", "pos", "n")
    assert [(r.start_pos, r.end_pos) for r in kmer_regions(plus, 6).collect()] == [(6, 22)]


def test_trna(spark, tmp_path):
    rows = reports.read_trna_table(spark, write(tmp_path / "t.txt", "Name Begin\ns 1 50 10 Ala TGC 0 0 70.1\ns 2 60 90 Xyz ??? 70 75 60.0\n")).collect()
    first, second = sorted(rows, key=lambda r: r.start_pos)
    assert (first.start_pos, first.end_pos, first.strand, first.note, first.intron_start) == (10, 50, -1, "(Reverse) Alanine", None)
    assert (second.strand, second.note, second.anticodon, second.intron_start, second.intron_end) == (1, "Xyz", "Unknow anticodon", 70, 75)


def test_other_tables(spark, tmp_path):
    domain = "# comment\nPF1 ACC q1 - 1e-5 3 4 5 6 7 8 9 10 11 12 13 14 15 a free/text here\n"
    row = reports.read_domain_table(spark, write(tmp_path / "d.tbl", domain)).first()
    assert (row.target, row.query_id, row.evalue, row.description) == ("PF1", "q1", 1e-5, "a free text here")
    ncrna = "#x\nname  acc seq1 - cm 1 9 200 100 - no 1 0.5 0.0 33.3 1e-3 ! some description\n"
    row = reports.read_ncrna_table(spark, write(tmp_path / "n.tbl", ncrna)).first()
    assert (row.seq_id, row.start_pos, row.end_pos, row.strand, row.score, row.description) == ("seq1", 100, 200, -1, 33.3, "some description")
    rrna = reports.read_rrna_gff(spark, write(tmp_path / "r.gff", "##gff\nseq\tT\trRNA\t5\t90\t12.5\t-\t.\t18s_rRNA\n")).first()
    assert (rrna.start_pos, rrna.end_pos, rrna.strand, rrna.attributes) == (5, 90, -1, {"Note": ["18s_rRNA"]})
    names = spark.createDataFrame([("s1", "protein one")], "short_id string, protein_id string")
    tsv = reports.read_domains_tsv(spark, write(tmp_path / "i.tsv", "s1\tcrc\t100\tPfam\tPF1;\tname, x\t3\t40\t1e-4\tT\n"), names).first()
    assert (tsv.protein_id, tsv.tool, tsv.domain_id, tsv.name, tsv.aa_start, tsv.aa_end) == ("protein one", "Pfam", "PF1", "name x", 3, 40)
    runs = reports.read_run_tables(spark, write(tmp_path / "p.xml", '<unit><program id="3" name="x"><status>10</status><real_time>1.5</real_time><cpu_time>1.0</cpu_time></program></unit>')).first()
    assert (runs.task_id, runs.name, runs.status, runs.real_time) == (3, "x", 10, 1.5)
    markers = reports.read_markers(spark, write(tmp_path / "m.gff", "s\tT\tregion\t1\t9\t.\t.\t.\tID=r\ns\tT\tmicrosatellite\t2\t8\t.\t+\t.\tID=m\n"))
    assert [r.feature_id for r in markers.collect()] == ["m"]


def test_spliced_alignment(spark):
    rows = spark.createDataFrame([("t", 1, 101, "ACGT....AC-T", "ACCT....ACGT", [50])], "transcript_id string, q_start long, t_start long, query string, subject string, introns array<long>")
    got = [(r.exon, r.q_start, r.q_end, r.g_start, r.g_end, r.match_len, r.identity) for r in reports.parse_spliced_alignments(rows).orderBy("exon").collect()]
    assert got == [(1, 1, 4, 101, 104, 3, 0.75), (2, 5, 7, 155, 158, 3, 0.75)]


def test_gff3_round_trip(spark, tmp_path):
    text = "chr1\tTOOL\tgene\t101\t400\t.\t+\t.\tID=g1;Note=a,b\nchr2\tTOOL\texon\t5\t9\t2.5\t-\t1\tID=e1;Parent=g1\n"
    features = reports.read_gff3(spark, write(tmp_path / "a.gff3", text))
    sinks.write_gff3(features, spark.createDataFrame([("chr1", 1000), ("chr2", 50)], "seq_id string, length long"), str(tmp_path / "out"))
    columns = ["type", "start_pos", "end_pos", "score", "strand", "phase", "attributes", "feature_id", "parent_id"]
    again = reports.read_gff3(spark, str(tmp_path / "out"))
    assert again.where("type = 'region'").count() == 2
    as_set = lambda df: {str([r[c] for c in columns]) for r in df.collect()}
    assert as_set(again.where("type <> 'region'")) == as_set(features)


def test_a_long_sequence_is_written_by_several_tasks_in_order(spark, tmp_path):
    features = spark.range(4000).select(F.when(F.col("id") < 3990, "chr1").otherwise("chr2").alias("seq_id"), F.lit("T").alias("source"), F.lit("exon").alias("type"), (F.col("id") * 7919 % 100_003 + 1).alias("start_pos"), (F.col("id") * 7919 % 100_003 + 9).alias("end_pos"), F.lit(None).cast("double").alias("score"), F.lit(1).alias("strand"), F.lit(None).cast("int").alias("phase"), F.create_map(F.lit("ID"), F.array(F.col("id").cast("string"))).alias("attributes"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_gff3(features, spark.createDataFrame([("chr1", 200_000), ("chr2", 200_000)], "seq_id string, length long"), str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = sinks.gff3_files(spark, str(tmp_path / "out")).orderBy("seq_id", "nth").collect()
    assert sum(r.seq_id == "chr1" for r in files) > 1
    for name, n in (("chr1", 3990), ("chr2", 10)):
        text = "".join(open(r.file.removeprefix("file:")).read() for r in files if r.seq_id == name).splitlines()
        starts = [int(line.split("\t")[3]) for line in text]
        assert len(text) == n + 1 and "\tregion\t" in text[0] and starts[1:] == sorted(starts[1:])


def test_plain_sinks(spark, tmp_path):
    sinks.write_fasta(spark.createDataFrame([("s", "ACGTACGTA")], "seq_id string, residues string"), str(tmp_path / "f"), 4)
    assert [tuple(r) for r in reports.read_fasta(spark, str(tmp_path / "f")).collect()] == [("s", "", "ACGTACGTA")]
    sinks.write_regions(spark.createDataFrame([(1, 9)], "start_pos long, end_pos long"), str(tmp_path / "r"))
    assert spark.read.text(str(tmp_path / "r")).first()[0] == "1\t9"
    sinks.write_list(spark.createDataFrame([("h",)], "hit_id string"), "hit_id", str(tmp_path / "l"))
    assert spark.read.text(str(tmp_path / "l")).first()[0] == "h"


def test_xml_files_follow_the_number_of_records(spark, monkeypatch):
    from strandweave.plans import source_queries as Q

    monkeypatch.setattr(Q, "PER_FILE", 10)
    records = spark.range(300).select(F.concat(F.lit("<r>"), F.col("id").cast("string"), F.lit("</r>")).alias("value"))
    lines = spark.read.text(Q.saved_xml(records, "all")).select("part", "value").collect()
    assert len({r.part for r in lines}) == 30
    assert sum(r.value.startswith("<r>") for r in lines) == 300 and sum(r.value == "<all>" for r in lines) == 30


def test_xml_text_is_not_kept_whole(spark):
    from pathlib import Path

    from strandweave.plans import source_queries as Q

    text = F.concat(F.lit("<r><first_name>"), F.col("id").cast("string"), F.lit("</first_name><second_name>none</second_name></r>"))
    for rows, options in ((spark.range(5000).select(text.alias("value")), {}), (spark.range(5000), {"value": text})):
        path = Q.saved_xml(rows, "all", **options)
        files = list(Path(path.removeprefix("file:")).glob("part=*/part-*"))
        found = [r.value for r in spark.read.text(path).collect()]
        assert sorted(r for r in found if r.startswith("<r>")) == sorted(f"<r><first_name>{i}</first_name><second_name>none</second_name></r>" for i in range(5000))
        assert len(files) == 8 and 4 * sum(f.stat().st_size for f in files) < sum(map(len, found))
        assert spark.read.schema("first_name int").option("rowTag", "r").xml(path).agg(F.sum("first_name")).first()[0] == sum(range(5000))

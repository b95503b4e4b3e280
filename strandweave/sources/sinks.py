"""Feature and sequence tables as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandweave.functions.sequence import wrap_sequence
from strandweave.functions.text import render_attributes


def gff3_lines(features: DataFrame) -> DataFrame:
    """(seq_id, start_pos, line) of a feature table."""
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    strand = F.when(F.col("strand") == 1, "+").when(F.col("strand") == -1, "-").otherwise(".")
    line = F.concat_ws("\t", "seq_id", "source", "type", F.col("start_pos").cast("string"), F.col("end_pos").cast("string"), dot("score"), strand, dot("phase"), render_attributes(F.col("attributes")))
    return features.select("seq_id", "start_pos", line.alias("line"))


def region_lines(sequences: DataFrame, note: str) -> DataFrame:
    """A header line for each row of ``sequences(seq_id, length)``."""
    tail = F.concat(F.lit("ID="), "seq_id", F.lit(f";Note={note}"))
    line = F.concat_ws("\t", "seq_id", F.lit("."), F.lit("region"), F.lit("1"), F.col("length").cast("string"), F.lit("."), F.lit("."), F.lit("."), tail)
    return sequences.select("seq_id", F.lit(0).cast("long").alias("start_pos"), line.alias("line"))


def write_gff3(features: DataFrame, sequences: DataFrame, path: str, note: str = "annotation") -> None:
    """One folder a sequence, with its region line and then its features by start in one file or several.

    Rows are dealt by ranges of (seq_id, start_pos, line), so that a long sequence is the work of several tasks. Files of a
    folder follow each other by name; ``gff3_files`` lists them.
    """
    rows = region_lines(sequences, note).unionByName(gff3_lines(features))
    rows = rows.repartitionByRange("seq_id", "start_pos", "line").sortWithinPartitions("seq_id", "start_pos", "line")
    rows.select("seq_id", F.col("line").alias("value")).write.partitionBy("seq_id").text(path)


def gff3_files(spark: SparkSession, path: str) -> DataFrame:
    """(seq_id, nth, file): the files of ``write_gff3`` in the order in which they make up each sequence's sorted GFF3."""
    found = spark.read.text(path).select("seq_id", F.col("_metadata.file_path").alias("file")).distinct()
    return found.select(F.col("seq_id").cast("string").alias("seq_id"), F.row_number().over(W.partitionBy("seq_id").orderBy("file")).alias("nth"), "file")


def write_fasta(seqs: DataFrame, path: str, width: int = 60) -> None:
    seqs.select(F.concat(F.lit(">"), "seq_id", F.lit("\n"), wrap_sequence("residues", width)).alias("value")).write.text(path)


def write_regions(regions: DataFrame, path: str) -> None:
    """Start and end of each region, separated by a tab."""
    regions.select("start_pos", "end_pos").write.option("sep", "\t").csv(path)


def write_list(values: DataFrame, column: str, path: str) -> None:
    values.select(F.col(column).cast("string").alias("value")).write.text(path)


#: Shares of a shuffle partition in which feature tables are grouped, so that a task holds less at a time.
SHARES = 8


def embl_table(features: DataFrame, profile: DataFrame, colors: Column) -> DataFrame:
    """Feature-table rows by ``profile(type, embl_type, joined)``: other types are left out.

    Rows of a joined type meet in one location of their parent; the minus strand is a complement.
    """
    rows = features.join(profile, "type").withColumn("color", colors)
    key = F.when(F.col("joined"), F.col("parent_id")).otherwise(F.col("feature_id"))
    # Hardly any rows meet before the shuffle; they are dealt as they are, to several smaller groups of keys a partition.
    rows = rows.select("seq_id", "embl_type", "strand", key.alias("key"), "color", "start_pos", "end_pos").repartition(SHARES * int(features.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key")
    parts = rows.groupBy("seq_id", "embl_type", "strand", "key", "color").agg(F.sort_array(F.collect_list(F.struct("start_pos", "end_pos"))).alias("parts"))
    spans = F.transform("parts", lambda p: F.concat(p["start_pos"].cast("string"), F.lit(".."), p["end_pos"].cast("string")))
    inner = F.when(F.size("parts") > 1, F.concat(F.lit("join("), F.array_join(spans, ","), F.lit(")"))).otherwise(spans[0])
    return parts.select("seq_id", "key", F.col("embl_type").alias("type"), F.when(F.col("strand") == -1, F.concat(F.lit("complement("), inner, F.lit(")"))).otherwise(inner).alias("location"), "color")


#: How tags of a feature are worded in a feature table.
SIMILAR, OTHER, WARNINGS, FILES = "Similar_to: ", "Other_annotation: ", "Structure_warnings: ", ("blastp_file", "fasta_file")


def embl_qualifiers(attributes: Column, kind: Column, remove_details: Column) -> Column:
    """Qualifiers (structs name, value) of a feature's attributes (map of arrays), by tag.

    Where details are removed only the id is left. Else the first Note is what the feature is similar to (the function of
    a tRNA), a status of ``pseudo`` makes a pseudogene, files keep their names, and other tags that begin with a small
    letter, and the ontology term, become notes. Tags such as Parent and Name are no qualifiers.
    """
    qualifier = lambda name, value: F.struct(F.lit(name).alias("name") if isinstance(name, str) else name.alias("name"), value.alias("value"))
    capital = lambda c: F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, F.lit(2), F.length(c)))

    def of(e: Column) -> Column:
        k, v = e["key"], e["value"]
        first = F.when(kind == "tRNA", qualifier("function", v[0])).otherwise(qualifier("note", F.concat(F.lit(SIMILAR), v[0])))
        others = F.transform(F.slice(v, F.lit(2), F.size(v)), lambda x: qualifier("note", F.concat(F.lit(OTHER), x)))
        status = F.transform(v, lambda x: F.when(x == "pseudo", qualifier("pseudogene", F.lit("unknown"))).otherwise(qualifier("note", capital(x))))
        none = F.lit([]).cast("array<struct<name string, value string>>")
        return (
            F.when(k == "ID", F.array(qualifier("id", v[0]))).when(remove_details, none)
            .when(k == "Note", F.concat(F.array(first), others)).when(k.isin(*FILES), F.array(qualifier(k, v[0]))).when(k == "status", status)
            .when(k == "structure_warnings", F.array(qualifier("note", F.concat(F.lit(WARNINGS), F.array_join(v, " ")))))
            .when(k.rlike("^[a-z]") | (k == "Ontology_term"), F.array(qualifier("note", F.concat(capital(k), F.lit(": "), F.array_join(v, ","))))).otherwise(none)
        )

    return F.flatten(F.transform(F.array_sort(F.map_entries(attributes)), of))

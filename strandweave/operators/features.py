"""Operators on tables of features: subtypes, kinship, orders, ontology terms, renaming and copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandweave.functions import text as T
from strandweave.functions.lookups import SUBFEATURE_RANK, looked_up

from .intervals import TILE, latest, merge_intervals, numbered


def exon_subtype(exons: DataFrame, transcript: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``exons`` with ``subtype``: Single, or Initial, Internal and Terminal in the direction of the strand."""
    by = W.partitionBy(*transcript)
    first, last = F.row_number().over(by.orderBy(*order)) == 1, F.row_number().over(by.orderBy(*order)) == F.count("*").over(by)
    plus = F.col("strand") != -1
    initial, terminal = (first & plus) | (last & ~plus), (last & plus) | (first & ~plus)
    return exons.withColumn("subtype", F.when(first & last, "Single").when(initial, "Initial").when(terminal, "Terminal").otherwise("Internal"))


def utr_subtype(features: DataFrame, gene: Sequence[str]) -> DataFrame:
    """``features`` with ``subtype`` of exon, CDS and polypeptide rows (else null) against the gene's mRNA and UTRs.

    Without UTRs: Single, Initial, Internal and Terminal by the mRNA's ends. With UTRs an exon that lies inside one is
    External, and exons and coding parts at the inner border of a UTR are its first or last ones. Initial and Terminal
    follow the strand. A gene may have several UTR pieces; their outer bounds count.
    """
    bound = lambda agg, c, kind: agg(F.when(kind, F.col(c)))
    kind, plus = F.col("type"), F.col("strand") != -1
    left = (plus & (kind == "five_prime_UTR")) | (~plus & (kind == "three_prime_UTR"))
    right = (~plus & (kind == "five_prime_UTR")) | (plus & (kind == "three_prime_UTR"))
    bounds = features.groupBy(*gene).agg(
        bound(F.min, "start_pos", kind == "mRNA").alias("__s"), bound(F.max, "end_pos", kind == "mRNA").alias("__e"),
        bound(F.max, "end_pos", left).alias("__l"), bound(F.min, "start_pos", right).alias("__r"),
    )
    rows = features.join(bounds, list(gene))
    yes = lambda c: F.coalesce(c, F.lit(False))
    start, end = F.col("start_pos"), F.col("end_pos")
    at_s, at_e = yes(start == F.col("__s")), yes(end == F.col("__e"))
    by_side = lambda first, last: F.when(first, F.when(plus, "Initial").otherwise("Terminal")).when(last, F.when(plus, "Terminal").otherwise("Initial")).otherwise("Internal")
    plain = F.when(at_s & at_e, "Single").otherwise(by_side(at_s, at_e))
    exon = (
        F.when((at_s | yes(start == F.col("__l"))) & (at_e | yes(end == F.col("__r"))), "Single")
        .when(yes(end <= F.col("__l")) | yes(start >= F.col("__r")), "External")
        .otherwise(by_side(at_s | yes((start <= F.col("__l")) & (end > F.col("__l"))), at_e | yes((start < F.col("__r")) & (end >= F.col("__r")))))
    )
    first, last = at_s | yes(start == F.col("__l") + 1), at_e | yes(end == F.col("__r") - 1)
    coding = F.when(first & last, "Single").otherwise(by_side(first, last))
    none = F.col("__l").isNull() & F.col("__r").isNull()
    subtype = F.when(none & kind.isin("exon", "CDS", "polypeptide"), plain).when(kind == "exon", exon).when(kind.isin("CDS", "polypeptide"), coding)
    return rows.withColumn("subtype", subtype).drop("__s", "__e", "__l", "__r")


def kinship_groups(rows: DataFrame, files: Sequence[str], order: Sequence[str], parent: str, feature: str, width: int = TILE) -> DataFrame:
    """``rows`` with ``master``: in the order of a file, a row without a parent opens a group that the rows behind it join.

    ``order`` begins with a number, whose stretches of ``width`` are gone through side by side. Only for tables without
    usable parent ids; an equi-join on ids is cheaper and doesn't need an order.
    """
    opens = F.when(F.col(parent).isNull(), F.col(feature))
    return latest(rows, files, opens, order, F.floor(F.col(order[0]) / width), "master")


def subfeature_rank(kind: Column, strand: Column) -> Column:
    """Where a sub-feature stands inside its gene; the 5' end comes first on either strand's reading direction of a file."""
    swapped = F.when((strand == -1) & (kind == "five_prime_UTR"), "three_prime_UTR").when((strand == -1) & (kind == "three_prime_UTR"), "five_prime_UTR").otherwise(kind)
    return looked_up(SUBFEATURE_RANK, swapped, F.lit(99))


def classify_ontology(exons: DataFrame, transcript: Sequence[str], order: Sequence[str], kind: str = "exon") -> DataFrame:
    """``exons`` with their subtype and the ontology term of type and subtype."""
    return exon_subtype(exons, transcript, order).withColumn("so_term", T.so_term(F.lit(kind), F.col("subtype")))


def virtual_polypeptides(exons: DataFrame) -> DataFrame:
    """A polypeptide for each exon: Parent becomes Derives_from, exon in ID and Name becomes polypeptide."""
    renamed = F.transform_keys("attributes", lambda k, v: F.when(k == "Parent", "Derives_from").otherwise(k))
    kept = F.map_filter(renamed, lambda k, v: ~k.isin("exon", "Ontology_term"))
    changed = F.transform_values(kept, lambda k, v: F.when(k.isin("ID", "Name"), F.transform(v, lambda x: F.regexp_replace(x, "exon", "polypeptide"))).otherwise(v))
    return exons.where("type = 'exon'").withColumn("type", F.lit("polypeptide")).withColumn("attributes", changed)


def rename_and_drop(features: DataFrame, names: dict, dropped: Sequence[str]) -> DataFrame:
    """Types by their new names, without those that are dropped."""
    return features.where(~F.col("type").isin(*dropped)).withColumn("type", T.rename_types(F.col("type"), names))


def feature_boundaries(features: DataFrame, gene: Sequence[str]) -> DataFrame:
    """First start and last end by gene and type."""
    return features.groupBy(*gene, "type").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"))


def segments(features: DataFrame, transcript: Sequence[str], classes: dict) -> DataFrame:
    """A row a transcript with its class-coded segments in the direction of its strand."""
    coded = features.withColumn("class", looked_up(classes, F.col("type"))).where("class is not null")
    rows = coded.groupBy(*transcript, "strand").agg(F.sort_array(F.collect_list(F.struct("start_pos", "end_pos", "class"))).alias("segments"))
    return rows.withColumn("segments", F.when(F.col("strand") == -1, F.reverse("segments")).otherwise(F.col("segments")))


def expand_gene_features(parts: DataFrame, source: str) -> DataFrame:
    """gene, mRNA, exon and typed rows of transcripts: (seq_id, strand, start_pos, end_pos, type, name, id, parent, derives_from, source).

    ``parts(seq_id, parent_id, strand, type, start_pos, end_pos)`` are UTR and polypeptide pieces (or plain ``exon``
    rows); pieces that touch make one exon. Genes are numbered along each sequence, exons and parts of each type along
    their transcript. Polypeptides derive from the mRNA, other parts have it as parent.
    """
    by = ["seq_id", "parent_id", "strand"]
    bounds = parts.groupBy(*by).agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"))
    bounds = numbered(bounds, ["seq_id"], ["start_pos", "end_pos", "parent_id"], place=F.col("start_pos"))
    bounds = bounds.withColumn("number", T.four_digits(F.col("number")))
    none = F.lit(None).cast("string")
    at = [F.col("start_pos").cast("string"), F.col("end_pos").cast("string")]
    gene = bounds.withColumn("gene", F.concat_ws("_", F.lit(source), *at, F.lit("gene"), "number"))
    mrna_of = F.concat("seq_id", F.lit("_"), "gene", F.lit("_mRNA_0001"))
    columns = ["seq_id", "strand", "start_pos", "end_pos"]
    row = lambda df, kind, name, parent, derived=none: df.select(*columns, kind.alias("type"), name.alias("name"), F.concat_ws("_", "seq_id", name).alias("id"), parent.alias("parent"), derived.alias("derives_from"))
    rows = row(gene, F.lit("gene"), F.col("gene"), none).unionByName(row(gene, F.lit("mRNA"), F.concat("gene", F.lit("_mRNA_0001")), F.concat_ws("_", "seq_id", "gene")))
    of_gene = gene.select(*by, mrna_of.alias("mrna"), "number")
    exons = merge_intervals(parts, by).drop("n").withColumn("type", F.lit("exon"))
    pieces = parts.where("type <> 'exon'").select(*by, "start_pos", "end_pos", "type")
    typed = exons.select(*by, "start_pos", "end_pos", "type").unionByName(pieces).join(of_gene, by)
    k = T.four_digits(F.row_number().over(W.partitionBy(*by, "type").orderBy("start_pos", "end_pos")))
    name = F.concat_ws("_", F.lit(source), *at, F.lit("gene"), "number", F.lit("mRNA_0001"), "type", k)
    poly = F.col("type") == "polypeptide"
    typed = typed.withColumn("name", name)
    rows = rows.unionByName(row(typed, F.col("type"), F.col("name"), F.when(~poly, F.col("mrna")), F.when(poly, F.col("mrna"))))
    return rows.withColumn("source", F.lit(source))


def look_up(rows: DataFrame, library: DataFrame, key: str, defaults: dict) -> DataFrame:
    """``rows`` with the columns of ``library(key, …)``, one row a key, named in ``defaults``; those where it has none."""
    joined = rows.join(library.select(key, *defaults), key, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def subset_bank(sequences: DataFrame, hits: DataFrame, key: str = "seq_id") -> DataFrame:
    """The sequences that the hits name."""
    return sequences.join(hits.select(key).distinct(), key, "left_semi")


def attach_annotations(features: DataFrame, annotations: DataFrame, key: str) -> DataFrame:
    """Attributes of ``annotations(key, added)`` replace those of the same name; features without any stay as they are."""
    joined = features.join(annotations, key, "left")
    kept = F.map_filter("attributes", lambda k, v: ~F.coalesce(F.map_contains_key("added", k), F.lit(False)))
    return joined.withColumn("attributes", F.when(F.col("added").isNull(), F.col("attributes")).otherwise(F.map_concat(kept, "added"))).drop("added")


def replace_by_id(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` instead of all old rows with the same key; the other old rows stay."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def explode_nested_repeats(rows: DataFrame) -> DataFrame:
    """Fragments of ``rows(repeat_id, strand, locations, ranges)``; rows whose lists differ in length are dropped.

    The i-th location goes with the i-th range, on the minus strand from the other end.
    """
    fine = rows.where(F.size("locations") == F.size("ranges"))
    ordered = F.when(F.col("strand") == -1, F.reverse("locations")).otherwise(F.col("locations"))
    parts = fine.select("repeat_id", "strand", F.posexplode(F.arrays_zip(ordered.alias("location"), F.col("ranges").alias("range"))).alias("k", "part"))
    return parts.select("repeat_id", "strand", (F.col("k") + 1).alias("fragment"), F.col("part.location").alias("location"), F.col("part.range").alias("range"))

"""Functional annotation of proteins from search results, and domains on the genome."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.functions.lookups import ANNOTATION_STEPS
from strandweave.functions.text import is_hypothetical, is_te_like

from .intervals import cumulative_offset

NO_EVIDENCE, HYPOTHETICAL_PROTEIN = "No_biological_evidence", "hypothetical_protein"


@dataclass(frozen=True)
class Step:
    """A search of a cascade: hits(protein_id, description, coverage, identity) in percent, one a protein, and what passes."""

    name: str
    hits: DataFrame
    coverage: float | None = None
    identity: float | None = None
    hypothetical: bool = True
    te_only: bool = False

    def passing(self) -> DataFrame:
        rows = self.hits
        for column, bound in (("coverage", self.coverage), ("identity", self.identity)):
            if bound is not None:
                rows = rows.where(F.col(column) > bound)
        if not self.hypothetical:
            rows = rows.where(~is_hypothetical(F.col("description")))
        return rows.where(is_te_like(F.col("description"))) if self.te_only else rows


def annotation_cascade(proteins: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """(protein_id, class, description): the first step that has a passing hit; one aggregation over all steps' hits."""
    tagged = [s.passing().select("protein_id", F.lit(k).alias("step"), F.lit(s.name).alias("class"), "description") for k, s in enumerate(steps)]
    first = reduce(DataFrame.unionByName, tagged).groupBy("protein_id").agg(F.min_by(F.struct("class", "description"), F.struct("step", "description")).alias("first"))
    joined = proteins.join(first, "protein_id", "left")
    return joined.select("protein_id", F.coalesce("first.class", F.lit(HYPOTHETICAL_PROTEIN)).alias("class"), F.col("first.description").alias("description"))


def standard_steps(searches: Mapping[str, DataFrame]) -> list[Step]:
    """The steps of the standard cascade for the searches that were done.

    ``searches``: hits (protein_id, description, coverage, identity), one a protein, by search: ``known`` and ``putative``
    (protein banks), ``expressed`` (transcripts), ``transposable``, and ``domains``, whose hits need no coverage or identity.
    """
    return [Step(name, searches[search], coverage, identity, hypothetical, te_only) for name, search, identity, coverage, hypothetical, te_only in ANNOTATION_STEPS if search in searches]


def standard_cascade(proteins: DataFrame, searches: Mapping[str, DataFrame]) -> DataFrame:
    """``annotation_cascade`` with the standard steps and bounds."""
    return annotation_cascade(proteins, standard_steps(searches))


def orf_annotation(proteins: DataFrame, hits: DataFrame, identity: float = 40, coverage: float = 5) -> DataFrame:
    """(protein_id, note): the hit's description if it passes, else a note that nothing is known."""
    good = hits.where((F.col("identity") > identity) & (F.col("coverage") > coverage)).select("protein_id", "description")
    return proteins.join(good, "protein_id", "left").select("protein_id", F.coalesce("description", F.lit(NO_EVIDENCE)).alias("note"))


def with_evidence(noted: DataFrame) -> DataFrame:
    return noted.where(F.col("note") != NO_EVIDENCE)


def joined_domains(domains: DataFrame, key: str) -> DataFrame:
    """(key, domains): names of ``domains(key, name, place)`` in the order of their place."""
    rows = domains.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("place", "name"))).alias("all"))
    return rows.select(key, F.array_join(F.transform("all", lambda d: d["name"]), ",").alias("domains"))


def lift_domains(domains: DataFrame, parts: DataFrame, model: str = "parent_id") -> DataFrame:
    """Genomic pieces of protein domains.

    ``domains(model, domain_id, aa_start, aa_end)`` lie on proteins, ``parts(model, seq_id, strand, start_pos, end_pos)``
    are the coding parts. Base offsets along the coding sequence tell where each part meets the domain.
    """
    offsets = cumulative_offset(parts, [model])
    rows = domains.join(offsets, model)
    first, last = F.greatest(3 * (F.col("aa_start") - 1), F.col("offset")), F.least(3 * F.col("aa_end"), F.col("offset") + F.col("end_pos") - F.col("start_pos") + 1)
    rows = rows.withColumns({"from": first - F.col("offset"), "upto": last - F.col("offset")}).where("from < upto")
    start: Column = F.when(F.col("strand") == 1, F.col("start_pos") + F.col("from")).otherwise(F.col("end_pos") - F.col("upto") + 1)
    end: Column = F.when(F.col("strand") == 1, F.col("start_pos") + F.col("upto") - 1).otherwise(F.col("end_pos") - F.col("from"))
    return rows.select(model, "domain_id", "seq_id", "strand", start.alias("start_pos"), end.alias("end_pos"))

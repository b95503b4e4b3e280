"""Long sequences as chunks, and the features of chunks as those of whole sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.functions.text import lift

from .intervals import tiles_of
from .masking import TILE, extract_subseq


def split_sequences(tiles: DataFrame, lengths: DataFrame, longest: int, overlap: int, shortest: int = 0, width: int = TILE) -> DataFrame:
    """Chunks with their residues, of sequences of ``lengths(seq_id, length)`` that have ``shortest`` bases or more.

    Residues are read from the ``tiles`` of ``width`` bases that a chunk meets; no row ever holds a whole sequence.
    """
    chunks = tiles_of(lengths.where(F.col("length") >= shortest), longest, overlap).select("seq_id", "chunk_no", F.col("chunk_start").alias("start_pos"), F.col("chunk_end").alias("end_pos"))
    found = extract_subseq(chunks, tiles, ["seq_id", "chunk_no"], width)
    return found.select("seq_id", "chunk_no", F.col("start_pos").alias("chunk_start"), F.col("end_pos").alias("chunk_end"), F.col("part").alias("residues"))


def in_chunks(features: DataFrame, chunks: DataFrame, longest: int, overlap: int) -> DataFrame:
    """``features`` with ``chunk_no``, ``chunk_start`` and ``chunk_end`` of each chunk that they lie wholly inside.

    ``chunks`` are those of ``tiles_of`` with the same bounds: the numbers of a feature's chunks follow from its ends, so
    that the join is on (seq_id, chunk_no).
    """
    step = longest - overlap
    first = F.greatest(F.lit(1).cast("long"), F.ceil((F.col("end_pos") - longest) / step) + 1)
    rows = features.withColumns({"__first": first, "__last": F.floor((F.col("start_pos") - 1) / step) + 1}).where("__first <= __last")
    rows = rows.withColumn("chunk_no", F.explode(F.sequence(F.col("__first").cast("int"), F.col("__last").cast("int")))).drop("__first", "__last")
    found = rows.join(chunks.select("seq_id", "chunk_no", "chunk_start", "chunk_end"), ["seq_id", "chunk_no"])
    return found.where("start_pos >= chunk_start and end_pos <= chunk_end")


def to_global(features: DataFrame, chunks: DataFrame) -> DataFrame:
    """Feature positions on the whole sequence; ``region`` rows drop out."""
    rows = features.where("type <> 'region'").join(chunks.select("seq_id", "chunk_no", "chunk_start"), ["seq_id", "chunk_no"])
    return rows.withColumns({"start_pos": lift(F.col("start_pos"), F.col("chunk_start")), "end_pos": lift(F.col("end_pos"), F.col("chunk_start"))}).drop("chunk_start")


def stitch(features: DataFrame, chunks: DataFrame) -> DataFrame:
    """Features of overlapping chunks, each once.

    ``features(seq_id, chunk_no, feature_id, master, start_pos, end_pos)`` are on the whole sequence's axis; only masters
    (rows without ``master``) are tested and their children follow. A master goes if it begins at a later chunk's first
    base, or, in the overlap with the next chunk, if it ends at its chunk's last base or the next chunk has one with
    the same start that is as long or longer.
    """
    border = chunks.select("seq_id", (F.col("chunk_no") - 1).alias("chunk_no"), F.col("chunk_start").alias("next_start"))
    around = chunks.select("seq_id", "chunk_no", "chunk_start", "chunk_end").join(border, ["seq_id", "chunk_no"], "left")
    masters = features.where("master is null").join(around, ["seq_id", "chunk_no"])
    masters = masters.where((F.col("chunk_no") == 1) | (F.col("start_pos") != F.col("chunk_start")))
    behind = F.col("next_start").isNull() | (F.col("start_pos") <= F.col("next_start"))
    sure, unsure = masters.where(behind), masters.where(~behind & (F.col("end_pos") != F.col("chunk_end")))
    later = features.where("master is null").select("seq_id", (F.col("chunk_no") - 1).alias("n_chunk"), F.col("start_pos").alias("n_start"), F.col("end_pos").alias("n_end")).withColumnRenamed("seq_id", "n_seq")
    same = (F.col("seq_id") == F.col("n_seq")) & (F.col("chunk_no") == F.col("n_chunk")) & (F.col("start_pos") == F.col("n_start")) & (F.col("n_end") >= F.col("end_pos"))
    kept = sure.select("seq_id", "chunk_no", "feature_id").unionByName(unsure.join(later, same, "left_anti").select("seq_id", "chunk_no", "feature_id"))
    own = F.coalesce("master", "feature_id")
    return features.withColumn("__own", own).join(kept.withColumnRenamed("feature_id", "__own"), ["seq_id", "chunk_no", "__own"], "left_semi").drop("__own")

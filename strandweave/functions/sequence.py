"""Sequence functions as column expressions. Coordinates are 1-based and inclusive."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .lookups import BASES, NUCLEIC_ALPHABET, PROTEIC_ALPHABET, STANDARD_CODE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def revcomp(seq: Column | str) -> Column:
    """Reverse complement of A, C, G and T; other letters stay."""
    return F.reverse(F.translate(_col(seq), "ACGTacgt", "TGCAtgca"))


def revcomp_iupac(seq: Column | str) -> Column:
    """Reverse complement of the upper-case ambiguity code; U is paired with A."""
    return F.reverse(F.translate(_col(seq), "ATGCURYMKSWHBVDN", "TACGAYRKMSWDVBHN"))


_PLACE = np.full(256, 4, np.uint8)
for _letters in (BASES, BASES.lower()):
    _PLACE[np.frombuffer(_letters.encode(), np.uint8)] = range(4)
#: The letter of each codon's number (base 5; 4 for a letter that is no base).
_LETTERS = np.full(125, ord("X"), np.uint8)
_LETTERS[[a * 25 + b * 5 + c for a in range(4) for b in range(4) for c in range(4)]] = np.frombuffer(STANDARD_CODE.encode(), np.uint8)


def _letter(codon: str) -> str:
    return chr(_LETTERS[_PLACE[list(codon.encode())] @ (25, 5, 1)]) if codon.isascii() else "X"


@F.arrow_udf(StringType())
def _protein(texts: pa.Array) -> pa.Array:
    """Letters of the standard code for the whole codons of each text, all texts of a batch at once."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    if ((data[ends[0] : ends[-1]] > 127) | (data[ends[0] : ends[-1]] == 10) | (data[ends[0] : ends[-1]] == 13)).any():
        # Other letters take several bytes, and a codon doesn't go over the end of a line.
        codons = lambda text: re.findall("[^\n\r\x85\u2028\u2029]{3}", text)
        return pa.array([None if x is None else "".join(map(_letter, codons(x))) for x in texts.to_pylist()], pa.string())
    sizes = np.diff(ends) // 3
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    at = np.repeat(ends[:-1] - 3 * bounds[:-1], sizes) + 3 * np.arange(bounds[-1])
    codes = _PLACE[data]
    letters = _LETTERS[codes[at] * np.uint8(25) + codes[at + 1] * np.uint8(5) + codes[at + 2]]
    proteins = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(letters)])
    return pc.if_else(texts.is_valid(), proteins, pa.scalar(None, pa.large_string())).cast(pa.string())


def translate_codons(seq: Column | str, partial: str = "drop") -> Column:
    """Protein of frame 0, X for a codon with another letter. A rest of one or two bases is dropped, an ``X``, or an error (``fail``)."""
    seq = _col(seq)
    protein = _protein(F.upper(seq))
    rest = F.length(seq) % 3
    if partial == "X":
        return F.concat(protein, F.when(rest > 0, "X").otherwise(""))
    if partial == "fail":
        return F.when(rest == 0, protein).otherwise(F.raise_error(F.lit("length is no multiple of 3")))
    return protein


def first_codon(text: Column, *wanted: str) -> Column:
    """The number (from 1) of the first whole codon of ``text`` that is one of ``wanted``, or null."""
    upto = F.length(F.regexp_extract(text, f"(?s)^(?:...)*?(?:{'|'.join(wanted)})", 0))
    return F.nullif(F.floor(upto / 3), F.lit(0).cast("long"))


def subseq(seq: Column | str, start: Column | str, end: Column | str, strand: Column | None = None) -> Column:
    """Bases from start to end; reverse-complemented where strand is -1."""
    part = F.substring(_col(seq), _col(start), _col(end) - _col(start) + 1)
    return part if strand is None else F.when(strand == -1, revcomp(part)).otherwise(part)


def codon_at(seq: Column | str, pos: Column, strand: Column) -> Column:
    """The codon that begins at pos; on the minus strand the three bases that end there, reverse-complemented."""
    return F.upper(F.when(strand == -1, revcomp(F.substring(_col(seq), pos - 2, F.lit(3)))).otherwise(F.substring(_col(seq), pos, F.lit(3))))


def aa_length(protein: Column | str) -> Column:
    """Amino acids without a final stop."""
    p = _col(protein)
    return F.length(p) - F.when(F.endswith(p, F.lit("*")), 1).otherwise(0)


def orf_status(protein: Column | str) -> Column:
    """complete, 5'partial (no M first), 3'partial (no stop last) or 5'3'partial."""
    p = _col(protein)
    first, last = F.startswith(p, F.lit("M")), F.endswith(p, F.lit("*"))
    return F.when(first & last, "complete").when(last, "5'partial").when(first, "3'partial").otherwise("5'3'partial")


def is_premature(protein: Column | str) -> Column:
    """Whether a stop stands before the last letter."""
    p = _col(protein)
    return F.instr(F.substring(p, F.lit(1), F.length(p) - 1), "*") > 0


def internal_stop_count(protein: Column | str) -> Column:
    p = _col(protein)
    return F.regexp_count(F.substring(p, F.lit(1), F.length(p) - 1), F.lit("[*#+]"))


def has_n(seq: Column | str) -> Column:
    return F.contains(F.upper(_col(seq)), F.lit("N"))


def valid_alphabet(seq: Column | str, kind: str = "nucleic") -> Column:
    letters = NUCLEIC_ALPHABET if kind == "nucleic" else PROTEIC_ALPHABET
    return _col(seq).rlike(f"^(?i)[{letters}]*$")


def splice_site_class(donor: Column, acceptor: Column) -> Column:
    """good, partially_sequenced (an N in either site) or wrong_splice."""
    good = donor.rlike("^G[T|C]$") & (acceptor == "AG")
    return F.when(good, "good").when(donor.contains("N") | acceptor.contains("N"), "partially_sequenced").otherwise("wrong_splice")


def gap_blocks(alignment: Column | str, min_len: int = 9) -> Column:
    """Runs of ``min_len`` or more characters that aren't word characters."""
    return F.regexp_count(_col(alignment), F.lit(f"\\W{{{min_len},}}"))


def matched_letters(a: Column, b: Column) -> Column:
    """Places at which two aligned strings have the same letter."""
    same = F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x == y) & x.rlike("[A-Za-z]")), lambda x: x)
    return F.size(same)


def wrap_sequence(seq: Column | str, width: int = 80) -> Column:
    """Lines of ``width`` letters, without a line feed at the end."""
    return F.regexp_replace(F.regexp_replace(_col(seq), f"(.{{{width}}})", "$1\n"), "\n$", "")


def mask_residues(seq: Column, regions: Column, mode: str = "letter", letter: str = "N") -> Column:
    """``seq`` with the bases of ``regions`` (array of structs start, end: merged, in order, inside the sequence) masked."""
    begin = F.struct(F.lit(0).cast("long").alias("done"), F.lit("").alias("text"))

    def masked(r: Column) -> Column:
        part = F.substring(seq, r["start"].cast("int"), (r["end"] - r["start"] + 1).cast("int"))
        return F.lower(part) if mode == "lower" else F.repeat(F.lit(letter), F.length(part))

    def step(acc: Column, r: Column) -> Column:
        clean = F.substring(seq, (acc["done"] + 1).cast("int"), (r["start"] - acc["done"] - 1).cast("int"))
        return F.struct(r["end"].cast("long").alias("done"), F.concat(acc["text"], clean, masked(r)).alias("text"))

    return F.aggregate(regions, begin, step, lambda acc: F.concat(acc["text"], F.substring(seq, (acc["done"] + 1).cast("int"), F.length(seq))))

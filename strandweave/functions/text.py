"""Names, descriptions and other texts of features as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lookups import AMINO_NAMES, DATABANK_PREFIX, HEADER_TOKEN, HYPOTHETICAL, NOT_IN_NAMES, SO_DEFAULT, SO_SUBTYPES, SO_TERMS, TE_CODES, TE_DEFAULT, TE_KEYWORDS, TE_LIKE, literal_map, looked_up


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_description(text: Column | str) -> Column:
    """Only word characters, hyphens, brackets and bars; single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(_col(text), r"[^A-Za-z0-9_\-()|]", " "), " +", " "))


def clean_seq_name(header: Column | str) -> Column:
    """First token without a databank prefix; other than plain characters become ``_``; unknownId if nothing stays."""
    token = F.regexp_extract(_col(header), HEADER_TOKEN, 1)
    inner = F.regexp_extract(token, DATABANK_PREFIX, 1)
    token = F.when(inner != "", inner).otherwise(token)
    token = F.regexp_replace(F.regexp_replace(token, NOT_IN_NAMES, "_"), r"_+$", "")
    return F.when(token == "", "unknownId").otherwise(token)


def so_term(kind: Column, subtype: Column | None = None) -> Column:
    """Sequence Ontology term of a type, or of a type and a subtype (whose name holds internal, initial and so on)."""
    if subtype is None:
        return looked_up(SO_TERMS, kind, F.lit(SO_DEFAULT))
    by_type = F.lit(SO_DEFAULT)
    for name, terms in SO_SUBTYPES.items():
        by_part = F.lit(terms[""])
        for part, term in reversed(terms.items()):
            if part:
                by_part = F.when(F.contains(F.lower(subtype), F.lit(part)), term).otherwise(by_part)
        by_type = F.when(kind == name, by_part).otherwise(by_type)
    return F.when(subtype.isNull(), looked_up(SO_TERMS, kind, F.lit(SO_DEFAULT))).otherwise(by_type)


def feature_name(source: Column, start: Column, end: Column, kind: Column | str, number: Column) -> Column:
    """source_start_end_kind_number, the number with four digits."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.concat_ws("_", source, start.cast("string"), end.cast("string"), kind, four_digits(number))


def feature_id(seq_id: Column, name: Column) -> Column:
    return F.concat_ws("_", seq_id, name)


def four_digits(number: Column) -> Column:
    """At least four digits; longer numbers aren't cut."""
    text = number.cast("string")
    return F.when(F.length(text) < 4, F.lpad(text, 4, "0")).otherwise(text)


def amino_name(code: Column) -> Column:
    return looked_up(AMINO_NAMES, code, code)


def te_class(identifier: Column, description: Column) -> Column:
    """The code in the id decides; else the first keyword that the description has."""
    code = F.regexp_extract(identifier, f"({'|'.join(TE_CODES)})", 1)
    text = F.lower(description)
    by_word = reduce(lambda found, kw: found.when(F.contains(text, F.lit(kw[0])), kw[1]), TE_KEYWORDS[1:], F.when(F.contains(text, F.lit(TE_KEYWORDS[0][0])), TE_KEYWORDS[0][1]))
    return F.coalesce(F.when(code != "", F.try_element_at(literal_map(TE_CODES), code)), by_word, F.lit(TE_DEFAULT))


def go_terms(text: Column) -> Column:
    """Terms of the three ontologies, as a struct of arrays."""
    pick = lambda name: F.regexp_extract_all(text, F.lit(name + r": (.+?\))"), F.lit(1))
    return F.struct(pick("Molecular Function").alias("molecular_function"), pick("Biological Process").alias("biological_process"), pick("Cellular Component").alias("cellular_component"))


def query_coords(name: Column) -> Column:
    """Start and end that a protein's name holds."""
    pattern = r"_(\d+)_(\d+)"
    return F.struct(*(F.nullif(F.regexp_extract(name, pattern, k), F.lit("")).cast("long").alias(f) for k, f in ((1, "start"), (2, "end"))))


def normalize_interval(a: Column, b: Column) -> Column:
    """Ends in order, and strand -1 where they weren't."""
    return F.struct(F.least(a, b).alias("start"), F.greatest(a, b).alias("end"), F.when(a > b, -1).otherwise(1).alias("strand"))


def lift(position: Column, offset: Column) -> Column:
    """A position inside a chunk that begins at ``offset`` as one of the whole sequence."""
    return position + offset - 1


def hsp_pct(n: Column, align_len: Column) -> Column:
    return F.round(n * 100 / align_len, 2)


def is_hypothetical(description: Column) -> Column:
    """Whether the text after the first hyphen (or all of it) says that nothing is known."""
    return F.regexp_replace(description, "^[^-]*-", "").rlike("(?i)" + "|".join(HYPOTHETICAL))


def is_te_like(description: Column) -> Column:
    return description.rlike("(?i)" + "|".join(TE_LIKE))


def embl_color(keys: list[Column], colors: dict) -> Column:
    """The colour of the first key that has one."""
    return F.coalesce(*(F.try_element_at(literal_map(colors), k) for k in keys), F.lit(""))


def rename_types(kind: Column, names: dict) -> Column:
    return looked_up(names, kind, kind)


def parse_attributes(text: Column) -> Column:
    """key=value[,value] pairs between semicolons, as a map of arrays."""
    pairs = F.filter(F.transform(F.split(text, ";"), lambda p: F.trim(p)), lambda p: F.contains(p, F.lit("=")))
    entries = F.transform(pairs, lambda p: F.struct(F.split(p, "=", 2)[0].alias("key"), F.split(F.split(p, "=", 2)[1], ",").alias("value")))
    first = F.transform(F.array_distinct(F.transform(entries, lambda e: e["key"])), lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1))
    return F.map_from_entries(first)


def render_attributes(attributes: Column) -> Column:
    """The reverse of ``parse_attributes``, keys in order."""
    entries = F.array_sort(F.map_entries(attributes))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.array_join(e["value"], ","))), ";")

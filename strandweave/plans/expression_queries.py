"""Queries of the scalar functions and predicates, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandweave.functions import lookups as L
from strandweave.functions import sequence as S
from strandweave.functions import text as T

from .registry import query

ALNUM_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def sql_map(values: dict, key: str, default: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in values.items())
    return f"CASE {key} {cases} ELSE {default} END"


def sql_revcomp(seq: str) -> str:
    return f"reverse(translate({seq}, 'ACGTacgt', 'TGCAtgca'))"


def sql_amino(codon: str) -> str:
    place = [f"(instr('{L.BASES}', substring({codon}, {k}, 1)) - 1)" for k in (1, 2, 3)]
    return f"CASE WHEN length({codon}) = 3 AND least({', '.join(place)}) >= 0 THEN substring('{L.STANDARD_CODE}', {place[0]} * 16 + {place[1]} * 4 + {place[2]} + 1, 1) ELSE 'X' END"


def sql_protein(seq: str) -> str:
    codon = f"upper(substring({seq}, i * 3 + 1, 3))"
    return f"array_to_string(list_transform(range(0, length({seq}) // 3), lambda i: {sql_amino(codon)}), '')"


PROTEINS = f"p AS (SELECT seq_no, seq_id, substring({sql_protein('residues')}, 1 + CAST(seq_no % 40 AS INT), 1 + CAST(seq_no % 60 AS INT)) AS protein FROM fx_sequences)"


def proteins(t):
    """Pieces of translated sequences, from 1 to 60 letters."""
    piece = F.substring(S.translate_codons("residues"), (F.col("seq_no") % 40 + 1).cast("int"), (F.col("seq_no") % 60 + 1).cast("int"))
    return t.fx_sequences.select("seq_no", "seq_id", piece.alias("protein"))


@query("c1_revcomp", f"SELECT seq_id, {sql_revcomp('residues')} AS revcomp FROM fx_sequences")
def c1(t):
    return t.fx_sequences.select("seq_id", S.revcomp("residues").alias("revcomp"))


@query("c2_revcomp_iupac", "SELECT seq_id, reverse(translate(translate(residues, 'AC', 'RY'), 'ATGCURYMKSWHBVDN', 'TACGAYRKMSWDVBHN')) AS revcomp FROM fx_sequences")
def c2(t):
    return t.fx_sequences.select("seq_id", S.revcomp_iupac(F.translate("residues", "AC", "RY")).alias("revcomp"))


@query("c3_translate_codons", f"SELECT seq_id, concat({sql_protein('residues')}, CASE WHEN length(residues) % 3 > 0 THEN 'X' ELSE '' END) AS protein FROM fx_sequences")
def c3(t):
    return t.fx_sequences.select("seq_id", S.translate_codons("residues", "X").alias("protein"))


_CUT = "substring(residues, 1 + CAST(seq_no % 100 AS INT), 51)"


@query("c4_subseq", f"SELECT seq_id, CASE WHEN seq_no % 2 = 0 THEN {_CUT} ELSE {sql_revcomp(_CUT)} END AS part FROM fx_sequences")
def c4(t):
    start = (F.col("seq_no") % 100 + 1).cast("int")
    return t.fx_sequences.select("seq_id", S.subseq("residues", start, start + 50, F.when(F.col("seq_no") % 2 == 0, 1).otherwise(-1)).alias("part"))


@query(
    "c5_codon_at",
    f"""SELECT seq_id, upper(CASE WHEN seq_no % 2 = 0 THEN substring(residues, 200 + CAST(seq_no % 90 AS INT), 3)
    ELSE {sql_revcomp("substring(residues, 198 + CAST(seq_no % 90 AS INT), 3)")} END) AS codon FROM fx_sequences""",
)
def c5(t):
    return t.fx_sequences.select("seq_id", S.codon_at("residues", (F.col("seq_no") % 90 + 200).cast("int"), F.when(F.col("seq_no") % 2 == 0, 1).otherwise(-1)).alias("codon"))


@query(
    "c6_orf_status",
    f"""WITH {PROTEINS} SELECT seq_id, (length(protein) - CASE WHEN protein LIKE '%*' THEN 1 ELSE 0 END)::INT AS aa_len,
    CASE WHEN protein LIKE 'M%*' THEN 'complete' WHEN protein LIKE '%*' THEN '5''partial' WHEN protein LIKE 'M%' THEN '3''partial' ELSE '5''3''partial' END AS status,
    instr(substring(protein, 1, length(protein) - 1), '*') > 0 AS premature FROM p""",
)
def c6(t):
    return proteins(t).select("seq_id", S.aa_length("protein").alias("aa_len"), S.orf_status("protein").alias("status"), S.is_premature("protein").alias("premature"))


@query("c7_internal_stop_count", f"WITH {PROTEINS} SELECT seq_id, len(regexp_extract_all(substring(protein, 1, length(protein) - 1), '[*#+]'))::INT AS stops FROM p")
def c7(t):
    return proteins(t).select("seq_id", S.internal_stop_count("protein").alias("stops"))


@query("c8_has_n", "SELECT seq_id, contains(upper(residues), 'N') AS has_n FROM fx_sequences")
def c8(t):
    return t.fx_sequences.select("seq_id", S.has_n("residues").alias("has_n"))


@query("c9_clean_description", r"SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^A-Za-z0-9_\-()|]', ' ', 'g'), ' +', ' ', 'g')) AS clean FROM documents")
def c9(t):
    return t.documents.select("doc_id", T.clean_description("text").alias("clean"))


_HEADERS = "SELECT doc_id, concat(CASE doc_id % 4 WHEN 0 THEN '>lcl|' WHEN 1 THEN '>gnl|db|' WHEN 2 THEN '>' ELSE '> ' END, text) AS header FROM documents"


@query(
    "c10_clean_seq_name",
    f"""WITH h AS ({_HEADERS}), a AS (SELECT doc_id, regexp_extract(header, '{L.HEADER_TOKEN}', 1) AS token FROM h),
    b AS (SELECT doc_id, token, regexp_extract(token, '{L.DATABANK_PREFIX}', 1) AS i FROM a),
    c AS (SELECT doc_id, regexp_replace(regexp_replace(CASE WHEN i <> '' THEN i ELSE token END, '{L.NOT_IN_NAMES}', '_', 'g'), '_+$', '') AS n FROM b)
    SELECT doc_id, CASE WHEN n = '' THEN 'unknownId' ELSE n END AS name FROM c""",
)
def c10(t):
    kind = F.col("doc_id") % 4
    header = F.concat(F.when(kind == 0, ">lcl|").when(kind == 1, ">gnl|db|").when(kind == 2, ">").otherwise("> "), "text")
    return t.documents.select("doc_id", T.clean_seq_name(header).alias("name"))


@query(
    "c11_valid_alphabet",
    f"""SELECT seq_id, regexp_full_match(residues, '(?i)[{L.NUCLEIC_ALPHABET}]*') AS nucleic, regexp_full_match({sql_protein("residues")}, '(?i)[{L.PROTEIC_ALPHABET}]*') AS proteic,
    regexp_full_match(concat(residues, 'J'), '(?i)[{L.NUCLEIC_ALPHABET}]*') AS spoiled FROM fx_sequences""",
)
def c11(t):
    protein = S.translate_codons("residues")
    return t.fx_sequences.select("seq_id", S.valid_alphabet("residues").alias("nucleic"), S.valid_alphabet(protein, "proteic").alias("proteic"), S.valid_alphabet(F.concat("residues", F.lit("J"))).alias("spoiled"))


_KINDS = list(L.SO_TERMS) + list(L.SO_SUBTYPES) + ["other"]
_SUBTYPES = ["Initial", "Internal", "Terminal", "External", "Single"]


def _sql_so(kind: str, subtype: str) -> str:
    out = ""
    for name, terms in L.SO_SUBTYPES.items():
        parts = " ".join(f"WHEN contains(lower({subtype}), '{p}') THEN '{v}'" for p, v in terms.items() if p)
        out += f" WHEN {kind} = '{name}' THEN CASE {parts} ELSE '{terms['']}' END"
    return f"CASE WHEN {subtype} IS NULL THEN {sql_map(L.SO_TERMS, kind, repr(L.SO_DEFAULT))}{out} ELSE '{L.SO_DEFAULT}' END"


@query(
    "c12_so_term",
    f"""WITH k AS (SELECT p_partkey, ({_KINDS!r})[1 + p_partkey % {len(_KINDS)}] AS kind, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE ({_SUBTYPES!r})[1 + p_partkey % 5] END AS subtype FROM part)
    SELECT p_partkey, kind, subtype, {_sql_so("kind", "subtype")} AS so_term FROM k""",
)
def c12(t):
    pick = lambda names: F.element_at(F.lit(names), (F.col("p_partkey") % len(names) + 1).cast("int"))
    k = t.part.select("p_partkey", pick(_KINDS).alias("kind"), F.when(F.col("p_partkey") % 3 != 0, pick(_SUBTYPES)).alias("subtype"))
    return k.withColumn("so_term", T.so_term(F.col("kind"), F.col("subtype")))


@query(
    "c13_feature_name",
    """WITH n AS (SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY start_pos, feature_id) AS num FROM fx_exons),
    m AS (SELECT *, concat_ws('_', 'TOOL', start_pos::VARCHAR, end_pos::VARCHAR, 'exon', lpad(num::VARCHAR, 4, '0')) AS name FROM n)
    SELECT seq_id, feature_id, name, concat_ws('_', seq_id, name) AS id FROM m""",
)
def c13(t):
    from strandweave.operators.intervals import numbered

    named = numbered(t.fx_exons, ["parent_id"], ["start_pos", "feature_id"]).withColumn("name", T.feature_name(F.lit("TOOL"), F.col("start_pos"), F.col("end_pos"), "exon", F.col("number")))
    return named.select("seq_id", "feature_id", "name", T.feature_id(F.col("seq_id"), F.col("name")).alias("id"))


_CODES = [*L.AMINO_NAMES, "Xxx"]


@query("c14_amino_name", f"WITH k AS (SELECT p_partkey, ({_CODES!r})[1 + p_partkey % {len(_CODES)}] AS code FROM part) SELECT p_partkey, {sql_map(L.AMINO_NAMES, 'code', 'code')} AS name FROM k")
def c14(t):
    code = F.element_at(F.lit(_CODES), (F.col("p_partkey") % len(_CODES) + 1).cast("int"))
    return t.part.select("p_partkey", T.amino_name(code).alias("name"))


_WORDS = [k for k, _ in L.TE_KEYWORDS] + ["none"]
_TE_IDS = f"SELECT p_partkey, p_name, concat(CASE WHEN p_partkey % 2 = 0 THEN ({list(L.TE_CODES)!r})[1 + p_partkey % {len(L.TE_CODES)}] ELSE 'abc' END, '_', p_partkey::VARCHAR) AS id, concat(p_name, ' ', ({_WORDS!r})[1 + p_partkey % {len(_WORDS)}]) AS d FROM part"
_TE_BY_WORD = " ".join(f"WHEN contains(lower(d), '{k}') THEN '{v}'" for k, v in L.TE_KEYWORDS)


@query(
    "c15_te_class",
    f"""WITH k AS ({_TE_IDS}), c AS (SELECT *, regexp_extract(id, '({"|".join(L.TE_CODES)})', 1) AS code FROM k)
    SELECT p_partkey, {sql_map(L.TE_CODES, "code", f"CASE {_TE_BY_WORD} ELSE '{L.TE_DEFAULT}' END")} AS te_class FROM c""",
)
def c15(t):
    key = F.col("p_partkey")
    pick = lambda names: F.element_at(F.lit(names), (key % len(names) + 1).cast("int"))
    identifier = F.concat(F.when(key % 2 == 0, pick(list(L.TE_CODES))).otherwise("abc"), F.lit("_"), key.cast("string"))
    return t.part.select("p_partkey", T.te_class(identifier, F.concat_ws(" ", "p_name", pick(_WORDS))).alias("te_class"))


@query("c16_normalize_interval", "SELECT query_id, hit_id, least(q_start, h_end) AS s, greatest(q_start, h_end) AS e, CASE WHEN q_start > h_end THEN -1 ELSE 1 END AS strand FROM fx_hsps")
def c16(t):
    i = T.normalize_interval(F.col("q_start"), F.col("h_end"))
    return t.fx_hsps.select("query_id", "hit_id", i["start"].alias("s"), i["end"].alias("e"), i["strand"].alias("strand"))


@query("c17_gap_blocks", r"SELECT seq_id, len(regexp_extract_all(replace(translate(residues, 'AC', '--'), 'GT', '---------'), '[^A-Za-z0-9_]{9,}'))::INT AS blocks FROM fx_sequences")
def c17(t):
    return t.fx_sequences.select("seq_id", S.gap_blocks(F.replace(F.translate("residues", "AC", "--"), F.lit("GT"), F.lit("-" * 9))).alias("blocks"))


_GO = "concat('Molecular Function: ', p_name, ' (GO:1), Biological Process: ', p_name, ' (GO:2), Molecular Function: x (GO:3)')"


@query(
    "c18_go_terms",
    rf"""SELECT p_partkey, array_to_string(regexp_extract_all({_GO}, 'Molecular Function: (.+?\))', 1), '|') AS mf, array_to_string(regexp_extract_all({_GO}, 'Biological Process: (.+?\))', 1), '|') AS bp,
    len(regexp_extract_all({_GO}, 'Cellular Component: (.+?\))', 1))::INT AS cc FROM part""",
)
def c18(t):
    text = F.concat(F.lit("Molecular Function: "), "p_name", F.lit(" (GO:1), Biological Process: "), "p_name", F.lit(" (GO:2), Molecular Function: x (GO:3)"))
    go = T.go_terms(text)
    return t.part.select("p_partkey", F.array_join(go["molecular_function"], "|").alias("mf"), F.array_join(go["biological_process"], "|").alias("bp"), F.size(go["cellular_component"]).alias("cc"))


@query("c19_query_coords", "SELECT feature_id, start_pos AS s, end_pos AS e FROM fx_exons")
def c19(t):
    name = F.concat_ws("_", "parent_id", F.col("start_pos").cast("string"), F.col("end_pos").cast("string"))
    at = T.query_coords(name)
    return t.fx_exons.select("feature_id", at["start"].alias("s"), at["end"].alias("e"))


@query("c20_lift", "SELECT feature_id, start_pos + file_level * 50000 - 1 AS s, end_pos + file_level * 50000 - 1 AS e FROM fx_exons")
def c20(t):
    offset = F.col("file_level") * 50000
    return t.fx_exons.select("feature_id", T.lift(F.col("start_pos"), offset).alias("s"), T.lift(F.col("end_pos"), offset).alias("e"))


@query("c21_hsp_pct", "SELECT query_id, hit_id, bit_score, round(n_identical * 100 / align_len, 2) AS identity, align_len - n_identical % 7 AS hit_aligned FROM fx_hsps")
def c21(t):
    return t.fx_hsps.select("query_id", "hit_id", "bit_score", T.hsp_pct(F.col("n_identical"), F.col("align_len")).alias("identity"), (F.col("align_len") - F.col("n_identical") % 7).alias("hit_aligned"))


@query(
    "c22_splice_site_class",
    """WITH s AS (SELECT seq_id, seq_no, substring(residues, 95 + CAST(seq_no % 9 AS INT), 2) AS d, CASE WHEN seq_no % 3 = 0 THEN 'AG' ELSE substring(residues, 301, 2) END AS a FROM fx_sequences)
    SELECT seq_id, CASE WHEN regexp_matches(d, '^G[T|C]$') AND a = 'AG' THEN 'good' WHEN contains(d, 'N') OR contains(a, 'N') THEN 'partially_sequenced' ELSE 'wrong_splice' END AS site FROM s""",
)
def c22(t):
    donor = F.substring("residues", (F.col("seq_no") % 9 + 95).cast("int"), F.lit(2))
    acceptor = F.when(F.col("seq_no") % 3 == 0, "AG").otherwise(F.substring("residues", 301, 2))
    return t.fx_sequences.select("seq_id", S.splice_site_class(donor, acceptor).alias("site"))


COLORS = {"TOOL_db1_mRNA": "3", "db0": "5", "mRNA": "7"}


@query(
    "c23_embl_color",
    f"""SELECT evidence_id, start_pos, coalesce({sql_map(COLORS, "concat('TOOL_', db, '_mRNA')", "NULL")}, {sql_map(COLORS, "db", "NULL")}, {sql_map(COLORS, "category", "NULL")}, '') AS color FROM fx_evidence""",
)
def c23(t):
    return t.fx_evidence.select("evidence_id", "start_pos", T.embl_color([F.concat(F.lit("TOOL_"), "db", F.lit("_mRNA")), F.col("db"), F.col("category")], COLORS).alias("color"))


_MASKED = {"letter": "repeat('N', 21)", "lower": "lower(substring(residues, CAST(201 + seq_no % 50 AS INT), 21))"}


def _mask_sql(mode: str) -> str:
    return f"concat(substring(residues, 1, 10), {"repeat('N', 20)" if mode == 'letter' else 'lower(substring(residues, 11, 20))'}, substring(residues, 31, CAST(170 + seq_no % 50 AS INT)), {_MASKED[mode]}, substring(residues, CAST(222 + seq_no % 50 AS INT)))"


@query("c24_mask_residues", f"SELECT seq_id, {_mask_sql('letter')} AS by_letter, {_mask_sql('lower')} AS by_case FROM fx_sequences")
def c24(t):
    region = lambda a, b: F.struct(a.cast("long").alias("start"), b.cast("long").alias("end"))
    regions = F.array(region(F.lit(11), F.lit(30)), region(F.col("seq_no") % 50 + 201, F.col("seq_no") % 50 + 221))
    return t.fx_sequences.select("seq_id", S.mask_residues(F.col("residues"), regions).alias("by_letter"), S.mask_residues(F.col("residues"), regions, "lower").alias("by_case"))


_TYPES = ["transcript", "CDS", "gene", "exon"]


@query("c25_rename_types", f"WITH k AS (SELECT feature_id, ({_TYPES!r})[1 + file_level] AS type FROM fx_exons) SELECT feature_id, {sql_map(L.TYPE_NAMES, 'type', 'type')} AS type FROM k")
def c25(t):
    kind = F.element_at(F.lit(_TYPES), F.col("file_level") + 1)
    return t.fx_exons.select("feature_id", T.rename_types(kind, L.TYPE_NAMES).alias("type"))


@query("d1_keep_types", f"SELECT feature_id FROM fx_exons WHERE ({_TYPES!r})[1 + file_level] IN ('gene', 'exon')")
def d1(t):
    return t.fx_exons.where(F.element_at(F.lit(_TYPES), F.col("file_level") + 1).isin("gene", "exon")).select("feature_id")


@query("d2_hsp_identity", "SELECT query_id, hit_id, q_start, q_end, bit_score FROM fx_hsps WHERE n_identical >= 0.8 * align_len")
def d2(t):
    return t.fx_hsps.where(F.col("n_identical") * 10 >= F.col("align_len") * 8).select("query_id", "hit_id", "q_start", "q_end", "bit_score")


_LIKE = f"(?i){'|'.join(L.HYPOTHETICAL)}|green"


@query("d6_not_hypothetical", "SELECT p_partkey, p_name FROM part WHERE NOT regexp_matches(regexp_replace(CASE WHEN p_partkey % 5 = 0 THEN concat('Predicted - ', p_name) WHEN p_partkey % 5 = 1 THEN concat('sp-Uncharacterized ', p_name) ELSE p_name END, '^[^-]*-', ''), '(?i)hypothetical|uncharacterized|predicted')")
def d6(t):
    key = F.col("p_partkey") % 5
    text = F.when(key == 0, F.concat(F.lit("Predicted - "), "p_name")).when(key == 1, F.concat(F.lit("sp-Uncharacterized "), "p_name")).otherwise(F.col("p_name"))
    return t.part.where(~T.is_hypothetical(text)).select("p_partkey", "p_name")


@query("d7_te_like", f"SELECT p_partkey FROM part WHERE regexp_matches(concat(p_name, CASE WHEN p_partkey % 7 = 0 THEN ' Gypsy element' ELSE '' END), '(?i){'|'.join(L.TE_LIKE)}')")
def d7(t):
    return t.part.where(T.is_te_like(F.concat("p_name", F.when(F.col("p_partkey") % 7 == 0, " Gypsy element").otherwise("")))).select("p_partkey")


@query("d8_rejected_tags", "SELECT parent_id, feature_id, file_level IN (1, 3) AS rejected FROM fx_exons")
def d8(t):
    tags = F.element_at(F.lit([["expressed"], ["pseudogene"], ["ID", "Name"], ["partially_sequenced", "ID"]]), F.col("file_level") + 1)
    return t.fx_exons.select("parent_id", "feature_id", F.arrays_overlap(tags, F.lit(["pseudogene", "partially_sequenced"])).alias("rejected"))


@query("d10_drop_regions", "SELECT feature_id FROM fx_exons WHERE CASE WHEN file_level = 3 THEN 'region' ELSE 'exon' END <> 'region'")
def d10(t):
    return t.fx_exons.where(F.when(F.col("file_level") == 3, "region").otherwise("exon") != "region").select("feature_id")


@query("d17_length_gate", "SELECT doc_id, length(text)::INT AS n, length(text) BETWEEN 2000 AND 1000000 AS accepted FROM documents")
def d17(t):
    n = F.length("text")
    return t.documents.select("doc_id", n.alias("n"), n.between(2000, 1_000_000).alias("accepted"))


@query("d18_drop_types", f"SELECT feature_id FROM fx_exons WHERE ({_TYPES!r})[1 + file_level] NOT IN ('transcript', 'CDS')")
def d18(t):
    return t.fx_exons.where(~F.element_at(F.lit(_TYPES), F.col("file_level") + 1).isin("transcript", "CDS")).select("feature_id")


@query("b2_wrap_fasta", "SELECT seq_id, concat('>', seq_id, chr(10), regexp_replace(regexp_replace(residues, '(.{60})', '\\1' || chr(10), 'g'), chr(10) || '$', '')) AS fasta FROM fx_sequences")
def b2(t):
    return t.fx_sequences.select("seq_id", F.concat(F.lit(">"), "seq_id", F.lit("\n"), S.wrap_sequence("residues", 60)).alias("fasta"))


@query("f22_matched_letters", "SELECT seq_id, len(list_filter(range(1, 513), lambda i: substring(residues, i, 1) = substring(residues, i + 512, 1)))::INT AS matches FROM fx_sequences")
def f22(t):
    return t.fx_sequences.select("seq_id", S.matched_letters(F.substring("residues", 1, 512), F.substring("residues", 513, 512)).alias("matches"))

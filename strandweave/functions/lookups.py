"""Fixed lookups of genome annotation."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# These must equal the ones that results are compared with.
BASES = "TCAG"
#: Amino acids of the standard code, codons in the order of BASES.
STANDARD_CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
NUCLEIC_ALPHABET = "ACGTURYSWKMBDHVN"
PROTEIC_ALPHABET = "ABCDEFGHIKLMNPQRSTVWXYZ*"
#: First token of a header, its databank prefix, and what a name may not hold.
HEADER_TOKEN = r"^>?\s*(\S*)"
DATABANK_PREFIX = r"^(?:gi|lcl|bbs|bbm|gim|gb|emb|pir|sp|ref|dbj|prf|pdb|tp[ged]|tr|gpp|nat|gnl\|[^|]+)\|([^|\s]+)"
NOT_IN_NAMES = r"[^A-Za-z0-9_#.\-,=]"
AMINO_NAMES = {
    "Ala": "Alanine", "Arg": "Arginine", "Asn": "Asparagine", "Asp": "Aspartate", "Cys": "Cysteine", "Glu": "Glutamate", "Gln": "Glutamine",
    "Gly": "Glycine", "His": "Histidine", "Ile": "Isoleucine", "Leu": "Leucine", "Lys": "Lysine", "Met": "Methionine", "Phe": "Phenylalanine",
    "Pro": "Proline", "Pyl": "Pyrrolysine", "Sec": "Selenocysteine", "Ser": "Serine", "Thr": "Threonine", "Trp": "Tryptophan", "Tyr": "Tyrosine",
    "Val": "Valine", "Undet": "Unknown amino acid",
}
SO_TERMS = {
    "gene": "SO:0000704", "mRNA": "SO:0000234", "start_codon": "SO:0000318", "stop_codon": "SO:0000319", "five_prime_UTR": "SO:0000204",
    "three_prime_UTR": "SO:0000205", "acceptor": "SO:0000164", "donor": "SO:0000163", "transcription_start_site": "SO:0000315",
    "transcription_end_site": "SO:0000616", "insertion_site": "SO:0000366", "deletion_junction": "SO:0000687", "ncRNA": "SO:0000655",
    "tRNA": "SO:0000253", "rRNA": "SO:0000252", "ORF": "SO:0000236", "repeat_region": "SO:0000657", "nested_repeat": "SO:0001649",
    "repeat_fragment": "SO:0001050",
}
#: Terms of a type with a subtype: those of the subtypes by name, and the one of any other subtype.
SO_SUBTYPES = {
    "exon": {"external": "SO:0000198", "internal": "SO:0000004", "initial": "SO:0000200", "terminal": "SO:0000202", "": "SO:0000147"},
    "CDS": {"internal": "SO:0001215", "initial": "SO:0000196", "terminal": "SO:0000197", "": "SO:0000316"},
    "polypeptide": {"internal": "SO:0001215", "initial": "SO:0000196", "terminal": "SO:0000197", "": "SO:0000104"},
    "intron": {"internal": "SO:0000191", "initial": "SO:0000190", "terminal": "SO:0000192", "": "SO:0000188"},
}
SO_DEFAULT = "SO:0000001"
TE_CODES = {
    "RLC": "LTR_Copia", "RLG": "LTR_Gypsy", "RLB": "LTR_Bel-Pao", "RLR": "LTR_Retrovirus", "RLE": "LTR_ERV", "RLX": "LTR", "RYD": "DIRS_DIRS",
    "RYN": "DIRS_Ngaro", "RYV": "DIRS_VIPER", "RYX": "DIRS", "RPP": "PLE_Penelope", "RIR": "LINE_R2", "RIT": "LINE_RTE", "RIJ": "LINE_Jockey",
    "RIL": "LINE_L1", "RII": "LINE_I", "RIX": "LINE", "RST": "SINE_tRNA", "RSL": "SINE_7SL", "RSS": "SINE_5S", "RSX": "SINE", "RXX": "Class_I",
    "DTT": "TIR_Tc1-Mariner", "DTA": "TIR_hAT", "DTM": "TIR_Mutator", "DTE": "TIR_Merlin", "DTR": "TIR_Transib", "DTP": "TIR_P", "DTB": "TIR_PiggyBac",
    "DTH": "TIR_Harbinger", "DTC": "TIR_CACTA", "DTX": "TIR", "DYC": "Crypton", "DHH": "Helitron", "DMM": "Maverick", "DXX": "Class_II",
}
#: Keywords of descriptions, in order: superfamilies, then orders, then groups.
TE_KEYWORDS = (
    ("gypsy", "LTR_Gypsy"), ("copia", "LTR_Copia"), ("cacta", "TIR_CACTA"), ("athila", "LTR_Gypsy"), ("mutator", "TIR_Mutator"), ("harbinger", "TIR_Harbinger"),
    ("ltr", "LTR"), ("dirs", "DIRS"), ("ple", "PLE"), ("line", "LINE"), ("sine", "SINE"), ("tir", "TIR"), ("crypton", "Crypton"),
    ("helitron", "Helitron"), ("maverick", "Maverick"), ("mite", "MITE"), ("lite", "LITE"), ("trim", "TRIM"), ("lard", "LARD"),
)
TE_DEFAULT = "Unknown"
HYPOTHETICAL = ("hypothetical", "uncharacterized", "predicted")
TE_LIKE = ("transposase", "transposable", "transposon", "retrotransposon", "LINE", "SINE", "Copia", "Gypsy", "Mariner")
TRANSPOSASE_LIKE = ("transposase", "transposable", "transposon", "retrotransposon")
#: Steps of the standard annotation cascade: class, search, least identity and coverage in percent (to be passed), whether
#: hypothetical-like descriptions count, whether only those like transposable elements do. Step 5 has the results of step 2.
ANNOTATION_STEPS = (
    ("known_function", "known", 80, 80, False, False),
    ("putative_function", "putative", 45, 50, False, False),
    ("domain_containing_protein", "domains", None, None, True, False),
    ("expressed_sequence", "expressed", 45, 50, True, False),
    ("conserved_unknown_function", "putative", 45, 50, True, False),
    ("Warning - Possible Transposable Element", "transposable", 35, 40, True, True),
)
TYPE_NAMES = {"transcript": "mRNA", "CDS": "polypeptide"}
#: Score of a gene model: bonuses and penalties.
HIT_OVER_100, QUERY_OVER_100, ALL_VALID, CURATED, QUERY_BELOW_70, PARTIAL, WRONG_SPLICE = 100, 100, 200, 50, 100, 50, 50
CATEGORY_RANK = {"CAT00": 4, "CAT01": 3, "CAT02": 2, "CAT03": 1}
#: Rank of sub-features of a gene on the plus strand; the two UTRs change places on the minus strand.
SUBFEATURE_RANK = {"gene": 1, "mRNA": 2, "intron": 3, "exon": 4, "five_prime_UTR": 5, "CDS": 6, "polypeptide": 6, "three_prime_UTR": 7}


def literal_map(values: dict) -> Column:
    return F.create_map(*(F.lit(x) for x in chain.from_iterable(values.items())))


def looked_up(values: dict, key: Column, default: Column | None = None) -> Column:
    found = F.try_element_at(literal_map(values), key)
    return found if default is None else F.coalesce(found, default)

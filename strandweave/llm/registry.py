"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from . import conversation_trie, decontaminate, jaccard_join, lm_scoring, mixing, periodic_runs, quality_classifier, quality_rules, secret_scan, sharding, substring_dedup, suffix_dedup, token_counts

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_secret_scan": secret_scan.op4_secret_scan,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_quality_classifier": quality_classifier.op6_quality_classifier,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_ngram_jaccard_join": jaccard_join.op8_ngram_jaccard_join,
    "op9_mixing": mixing.op9_mixing,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
    "op11_lm_scoring": lm_scoring.op11_lm_scoring,
    "op12_conversation_trie": conversation_trie.op12_conversation_trie,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}
SQL: dict[str, str] = {"op1_sharding": sharding.SQL, "op9_mixing": mixing.SQL, "op12_conversation_trie": conversation_trie.SQL}

"""Queries of this subpackage and their SQL (DuckDB) where SQL can express them."""

from __future__ import annotations

from shoplens.llm import (
    chat_format,
    collocations,
    decontaminate,
    hard_negatives,
    jaccard_join,
    language_id,
    license_scan,
    packing,
    quality_rules,
    simhash,
    suffix_dedup,
    token_counts,
    vector_search,
)

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_rotated_bit_search": vector_search.op2_rotated_bit_search,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_benchmark_decontamination": decontaminate.op4_benchmark_decontamination,
    "op5_simhash_near_dedup": simhash.op5_simhash_near_dedup,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_suffix_array_dedup": suffix_dedup.op8_suffix_array_dedup,
    "op9_chat_formatting": chat_format.op9_chat_formatting,
    "op10_license_scan": license_scan.op10_license_scan,
    "op11_collocations": collocations.op11_collocations,
    "op12_jaccard_join": jaccard_join.op12_jaccard_join,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

ORACLE_SQL = {
    "op2_rotated_bit_search": vector_search.ORACLE,
    "op4_benchmark_decontamination": decontaminate.ORACLE,
    "op9_chat_formatting": chat_format.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op13_hard_negatives": hard_negatives.ORACLE,
}

"""Queries of the numbered operators and the SQL that some of them can be held against."""

from __future__ import annotations

from tallyspark.llm import (
    exact_dedup,
    html_extraction,
    line_dedup,
    mixing,
    packing,
    phrases,
    quality_rules,
    simhash_dedup,
    suffix_tree,
    token_alignment,
    token_counts,
    toxicity,
    warc,
)

QUERIES = {
    "op1_source_mixing": mixing.op1_source_mixing,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_line_dedup": line_dedup.op3_line_dedup,
    "op4_token_counts": token_counts.op4_token_counts,
    "op5_simhash_dedup": simhash_dedup.op5_simhash_dedup,
    "op6_warc": warc.op6_warc,
    "op7_suffix_tree": suffix_tree.op7_suffix_tree,
    "op8_packing": packing.op8_packing,
    "op9_html_extraction": html_extraction.op9_html_extraction,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_token_alignment": token_alignment.op11_token_alignment,
    "op12_phrase_mining": phrases.op12_phrase_mining,
    "op13_toxicity": toxicity.op13_toxicity,
}

ORACLE = {
    "op2_quality_rules": quality_rules.ORACLE_SQL,
    "op10_exact_dedup": exact_dedup.ORACLE_SQL,
    "op12_phrase_mining": phrases.ORACLE_SQL,
}

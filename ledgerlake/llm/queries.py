"""The registered queries of this package, and the statements that check them."""

from __future__ import annotations

from ledgerlake.llm import (
    op1_token_counts,
    op2_line_dedup,
    op3_near_dedup,
    op4_decontamination,
    op5_suffix_dedup,
    op6_best_fit_packing,
    op7_private_data,
    op8_vector_search,
    op9_html_extraction,
    op10_toxicity,
    op11_quality_rules,
    op12_lexical_search,
    op13_importance_resampling,
)

QUERIES = {
    "op1_token_counts": op1_token_counts.query,
    "op2_line_dedup": op2_line_dedup.query,
    "op3_near_dedup": op3_near_dedup.query,
    "op4_decontamination": op4_decontamination.query,
    "op5_suffix_dedup": op5_suffix_dedup.query,
    "op6_best_fit_packing": op6_best_fit_packing.query,
    "op7_private_data": op7_private_data.query,
    "op8_vector_search": op8_vector_search.query,
    "op9_html_extraction": op9_html_extraction.query,
    "op10_toxicity": op10_toxicity.query,
    "op11_quality_rules": op11_quality_rules.query,
    "op12_lexical_search": op12_lexical_search.query,
    "op13_importance_resampling": op13_importance_resampling.query,
}
ORACLES: dict[str, str] = {
    "op3_near_dedup": op3_near_dedup.ORACLE,
    "op4_decontamination": op4_decontamination.ORACLE,
    "op8_vector_search": op8_vector_search.ORACLE,
    "op11_quality_rules": op11_quality_rules.ORACLE,
    "op12_lexical_search": op12_lexical_search.ORACLE,
    "op13_importance_resampling": op13_importance_resampling.ORACLE,
}

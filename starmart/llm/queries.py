"""The queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from starmart.llm import (
    fingerprints,
    html_extract,
    lm_scoring,
    minhash,
    packing,
    passages,
    quality_classifier,
    quality_rules,
    ranked_search,
    secret_scans,
    sentence_pieces,
    url_filters,
    vector_codes,
)

QUERIES = {
    "op1_url_filters": url_filters.op1_url_filters,
    "op2_minhash_dedup": minhash.op2_minhash_dedup,
    "op3_fingerprints": fingerprints.op3_fingerprints,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_secret_scans": secret_scans.op5_secret_scans,
    "op6_quality_classifier": quality_classifier.op6_quality_classifier,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_substring_dedup": passages.op8_substring_dedup,
    "op9_sentence_pieces": sentence_pieces.op9_sentence_pieces,
    "op10_html_extraction": html_extract.op10_html_extraction,
    "op11_lm_scoring": lm_scoring.op11_lm_scoring,
    "op12_ranked_search": ranked_search.op12_ranked_search,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}

ORACLES = {
    "op1_url_filters": url_filters.ORACLE,
    "op4_quality_rules": quality_rules.ORACLE,
    "op12_ranked_search": ranked_search.ORACLE,
    "op13_vector_codes": vector_codes.ORACLE,
}

"""The registered queries of this subpackage, and SQL where it can express their rows."""

from __future__ import annotations

from . import collocations, exact_dedup, filter_audit, html_text, jaccard, language, licenses, packing, quality, sentencepieces, token_counts, topk, toxicity

QUERIES = {
    "op1_exact_dedup": exact_dedup.query,
    "op2_packing": packing.query,
    "op3_token_counts": token_counts.query,
    "op4_language_id": language.query,
    "op5_html_text": html_text.query,
    "op6_top_k": topk.query,
    "op7_license_scan": licenses.query,
    "op8_sentencepiece": sentencepieces.query,
    "op9_ngram_jaccard": jaccard.query,
    "op10_toxicity": toxicity.query,
    "op11_collocations": collocations.query,
    "op12_filter_audit": filter_audit.query,
    "op13_quality": quality.query,
}

ORACLES = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op6_top_k": topk.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
}

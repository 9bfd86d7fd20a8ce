"""The queries of this subpackage and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

from . import bpe, ctw, decontam, fim, fingerprints, html_text, language, near_dup, secrets, token_counts, token_files, topk

QUERIES = {
    "op1_token_files": token_files.query,
    "op2_near_duplicates": near_dup.query,
    "op3_secret_scan": secrets.query,
    "op4_byte_bpe": bpe.query,
    "op5_ctw_scores": ctw.query,
    "op6_html_text": html_text.query,
    "op7_decontamination": decontam.query,
    "op8_language_id": language.query,
    "op9_token_counts": token_counts.query,
    "op10_fingerprints": fingerprints.query,
    "op11_top_k": topk.query,
    "op12_fill_in_middle": fim.query,
}

ORACLES = {"op3_secret_scan": secrets.oracle(), "op7_decontamination": decontam.ORACLE, "op11_top_k": topk.ORACLE, "op12_fill_in_middle": fim.ORACLE}

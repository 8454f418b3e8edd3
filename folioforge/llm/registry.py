"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from folioforge.llm import decontam, fertility, kneser_ney, language_id, license_scan, line_dedup, ngram_join, packing, secret_scan, substring_dedup

QUERIES = {
    "op1_license_scan": license_scan.op1_license_scan,
    "op2_decontamination": decontam.op2_decontamination,
    "op3_lm_scoring": kneser_ney.op3_lm_scoring,
    "op4_ngram_join": ngram_join.op4_ngram_join,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_packing": packing.op6_packing,
    "op7_quality_rules": fertility.op7_quality_rules,
    "op8_language_id": language_id.op8_language_id,
    "op9_substring_dedup": substring_dedup.op9_substring_dedup,
    "op10_secret_scan": secret_scan.op10_secret_scan,
}
SQL = {
    "op1_license_scan": license_scan.SQL,
    "op5_line_dedup": line_dedup.SQL,
    "op10_secret_scan": secret_scan.SQL,
}

"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from sitefold.llm import decontamination, html_extraction, line_dedup, lm_scoring, mixing, near_dedup, periodic_runs, personal_data, quality_rules, secret_scans, token_counts, vector_codes, warc

QUERIES = {
    "op1_token_counts": token_counts.op1,
    "op2_lm_scoring": lm_scoring.op2,
    "op3_line_dedup": line_dedup.op3,
    "op4_decontamination": decontamination.op4,
    "op5_quality_rules": quality_rules.op5,
    "op6_near_dedup": near_dedup.op6,
    "op7_secret_scans": secret_scans.op7,
    "op8_source_mixing": mixing.op8,
    "op9_warc": warc.op9,
    "op10_html_extraction": html_extraction.op10,
    "op11_vector_codes": vector_codes.op11,
    "op12_personal_data": personal_data.op12,
    "op13_periodic_runs": periodic_runs.op13,
}

#: Those that SQL can express; the others are tested against brute force in tests/llm.
SQL = {
    "op5_quality_rules": quality_rules.SQL,
    "op6_near_dedup": near_dedup.SQL,
    "op8_source_mixing": mixing.SQL,
    "op9_warc": warc.SQL,
    "op11_vector_codes": vector_codes.SQL,
}

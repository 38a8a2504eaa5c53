"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import (
    collocation, decontaminate, exact_dedup, html_extract, lm_score, merkle, minhash, packing, quality_rules, suffix_dedup, token_output, toxicity,
    url_filter,
)

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_html_extract": html_extract.op2_html_extract,
    "op3_lm_score": lm_score.op3_lm_score,
    "op4_url_filter": url_filter.op4_url_filter,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_token_output": token_output.op8_token_output,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_minhash": minhash.op10_minhash,
    "op11_merkle": merkle.op11_merkle,
    "op12_quality_rules": quality_rules.op12_quality_rules,
    "op13_collocation": collocation.op13_collocation,
}

ORACLE = {
    "op4_url_filter": url_filter.ORACLE_SQL,
    "op9_exact_dedup": exact_dedup.ORACLE_SQL,
    "op10_minhash": minhash.ORACLE_SQL,
    "op11_merkle": merkle.ORACLE_SQL,
    "op13_collocation": collocation.ORACLE_SQL,
}

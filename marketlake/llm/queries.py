"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from . import (bpe, fill_middle, host_rules, line_dedup, packing, pii, quality, resampling, secrets, simhash, suffix_dedup, topk,
               toxicity)

QUERIES = {
    "op1_bpe_round_trip": bpe.op1,
    "op2_pii_surrogates": pii.op2,
    "op3_host_rules": host_rules.op3,
    "op4_toxicity": toxicity.op4,
    "op5_secret_scan": secrets.op5,
    "op6_suffix_dedup": suffix_dedup.op6,
    "op7_quality_qda": quality.op7,
    "op8_topk_search": topk.op8,
    "op9_simhash": simhash.op9,
    "op10_packing": packing.op10,
    "op11_fill_in_middle": fill_middle.op11,
    "op12_line_dedup": line_dedup.op12,
    "op13_importance_resampling": resampling.op13,
}

ORACLE = {
    "op3_host_rules": host_rules.ORACLE_SQL,
    "op5_secret_scan": secrets.ORACLE_SQL,
    "op8_topk_search": topk.ORACLE_SQL,
    "op11_fill_in_middle": fill_middle.ORACLE_SQL,
    "op12_line_dedup": line_dedup.ORACLE_SQL,
    "op13_importance_resampling": resampling.ORACLE_SQL,
}

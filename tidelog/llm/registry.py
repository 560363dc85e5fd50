"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from tidelog.llm import (byte_bpe, filter_audit, jaccard_join, language_id, licenses, line_dedup, order_minhash,
                         packing, preferences, pseudonyms, source_divergence, source_mix, topk_search)

QUERIES = {
    "op2_preference_format": preferences.op2_preference_format,
    "op7_license_scan": licenses.op7_license_scan,
    "op1_partenum_join": jaccard_join.op1_partenum_join,
    "op4_order_minhash": order_minhash.op4_order_minhash,
    "op5_feistel_pseudonyms": pseudonyms.op5_feistel_pseudonyms,
    "op6_byte_bpe": byte_bpe.op6_byte_bpe,
    "op8_impact_topk": topk_search.op8_impact_topk,
    "op10_language_id": language_id.op10_language_id,
    "op9_pattern_packing": packing.op9_pattern_packing,
    "op3_line_windows": line_dedup.op3_line_windows,
    "op11_source_mix": source_mix.op11_source_mix,
    "op12_source_divergence": source_divergence.op12_source_divergence,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}

ORACLES = {
    "op2_preference_format": preferences.ORACLE,
    "op7_license_scan": licenses.ORACLE,
    "op1_partenum_join": jaccard_join.ORACLE,
    "op8_impact_topk": topk_search.ORACLE,
    "op3_line_windows": line_dedup.ORACLE,
    "op12_source_divergence": source_divergence.ORACLE,
    "op13_filter_audit": filter_audit.ORACLE,
}

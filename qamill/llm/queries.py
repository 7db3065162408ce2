"""The registered queries of this subpackage, one per operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from qamill.llm import chat, collocations, decontaminate, line_dedup, multi_index, near_dedup, passages, pieces, quality, resampling, secret_scan, token_store, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": near_dedup.op1_minhash_near_dedup,
    "op2_warc_transactions": warc.op2_warc_transactions,
    "op3_token_efficiency_secrets": secret_scan.op3_token_efficiency_secrets,
    "op4_line_set_join": line_dedup.op4_line_set_join,
    "op5_suffix_array_pieces": pieces.op5_suffix_array_pieces,
    "op6_risk_controlled_quality": quality.op6_risk_controlled_quality,
    "op7_compact_window_passages": passages.op7_compact_window_passages,
    "op8_typed_chat_format": chat.op8_typed_chat_format,
    "op9_winnowing_decontamination": decontaminate.op9_winnowing_decontamination,
    "op10_context_mixing_ids": token_store.op10_context_mixing_ids,
    "op11_stripes_collocations": collocations.op11_stripes_collocations,
    "op12_inverted_multi_index": multi_index.op12_inverted_multi_index,
    "op13_importance_resampling": resampling.op13_importance_resampling,
    "pipeline": corpus_pipeline.run,
}

# Operators 1, 3, 4, 5, 7, 10, 12, 13 and the pipeline are tested against brute force.
ORACLES: dict[str, str] = {
    "op2_warc_transactions": warc.ORACLE,
    "op6_risk_controlled_quality": quality.ORACLE,
    "op8_typed_chat_format": chat.ORACLE,
    "op9_winnowing_decontamination": decontaminate.ORACLE,
    "op11_stripes_collocations": collocations.ORACLE,
}

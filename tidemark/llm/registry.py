"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import chain_dedup, decontaminate, divergence, kneser_ney, language_id, line_dedup, media_chunks, mixing, parity_join, ppm_score, secrets, simhash, spelling

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op10_chain_dedup": chain_dedup.op10_chain_dedup,
    "op1_language_id": language_id.op1_language_id,
    "op6_media_chunks": media_chunks.op6_media_chunks,
    "op8_secrets": secrets.op8_secrets,
    "op9_parity_join": parity_join.op9_parity_join,
    "op2_lm_score": ppm_score.op2_lm_score,
    "op3_quality": kneser_ney.op3_quality,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op7_source_mix": mixing.op7_source_mix,
    "op11_divergence": divergence.op11_divergence,
    "op12_spelling": spelling.op12_spelling,
    "op13_simhash": simhash.op13_simhash,
}
ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": line_dedup.OP4_SQL,
    "op5_decontaminate": decontaminate.OP5_SQL,
    "op9_parity_join": parity_join.OP9_SQL,
    "op11_divergence": divergence.OP11_SQL,
    "op12_spelling": spelling.OP12_SQL,
}

"""The queries of this folder, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from loomrank.llm import (
    chat_format,
    decontaminate,
    line_dedup,
    lm_scoring,
    mixing,
    quality_rules,
    sharding,
    simhash_dedup,
    substring_dedup,
    token_records,
)

QUERIES = {
    "op1_simhash_near_dedup": simhash_dedup.op1_simhash_near_dedup,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_sharding": sharding.op3_sharding,
    "op4_lm_scoring": lm_scoring.op4_lm_scoring,
    "op5_chat_format": chat_format.op5_chat_format,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_quality_rules": quality_rules.op7_quality_rules,
    "op8_token_records": token_records.op8_token_records,
    "op9_mixing": mixing.op9_mixing,
    "op10_decontamination": decontaminate.op10_decontamination,
}

ORACLE_SQL = {
    "op2_substring_dedup": substring_dedup.SQL,
    "op5_chat_format": chat_format.SQL,
    "op7_quality_rules": quality_rules.SQL,
    "op4_lm_scoring": lm_scoring.SQL,
    "op6_line_dedup": line_dedup.SQL,
    "op9_mixing": mixing.SQL,
}

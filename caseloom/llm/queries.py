"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from caseloom.llm import decontaminate, language, mixing, quality, sharding, simhash, substring, suffix, tokenfile, toxicity

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_token_binary": tokenfile.op2_token_binary,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_language_id": language.op4_language_id,
    "op5_mixing": mixing.op5_mixing,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_sharding": sharding.op7_sharding,
    "op8_suffix_array": suffix.op8_suffix_array,
    "op9_decontamination": decontaminate.op9_decontamination,
    "op10_substring": substring.op10_substring,
}

ORACLE_SQL = {
    "op8_suffix_array": suffix.OP8_SQL,
    "op9_decontamination": decontaminate.OP9_SQL,
    "op10_substring": substring.OP10_SQL,
}

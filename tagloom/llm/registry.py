"""Queries of the operators of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from tagloom.llm import (
    bpe, chat, decontaminate, hard_negatives, jaccard_join, language_id, periodic_runs, pii, quality,
    rule_ensemble, sharding, token_output, toxicity,
)

QUERIES = {
    "op10_tool_calls": chat.op10_tool_calls,
    "op3_token_output": token_output.op3_token_output,
    "op4_toxicity": toxicity.op4_toxicity,
    "op1_jaccard_join": jaccard_join.op1_jaccard_join,
    "op8_pii": pii.op8_pii,
    "op6_sharding": sharding.op6_sharding,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op2_quality": quality.op2_quality,
    "op5_language_id": language_id.op5_language_id,
    "op9_bpe": bpe.op9_bpe,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_rule_ensemble": rule_ensemble.op13_rule_ensemble,
}

ORACLE: dict[str, str] = {
    "op10_tool_calls": chat.ORACLE_SQL,
    "op1_jaccard_join": jaccard_join.ORACLE_SQL,
    "op7_decontaminate": decontaminate.ORACLE_SQL,
    "op2_quality": quality.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
}

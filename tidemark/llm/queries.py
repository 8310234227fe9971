"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline

from . import bitpack, chat, decontaminate, hard_negatives, language_id, merkle, near_dedup, oracles, packing, quality_classifier, quality_rules, secrets, simhash, toxicity

QUERIES = {
    "op1_packing": packing.query,
    "op2_language_id": language_id.query,
    "op3_quality_classifier": quality_classifier.query,
    "op4_toxicity": toxicity.query,
    "op5_secrets": secrets.query,
    "op6_chat": chat.query,
    "op7_decontamination": decontaminate.query,
    "op8_token_files": bitpack.query,
    "op9_near_dedup": near_dedup.query,
    "op10_quality_rules": quality_rules.query,
    "op11_merkle_manifest": merkle.query,
    "op12_simhash": simhash.query,
    "op13_hard_negatives": hard_negatives.query,
    "pipeline": corpus_pipeline.run,
}

#: Only where SQL can express the result; the others are tested in tests/llm.
ORACLE_SQL = oracles.ORACLE_SQL

"""Queries of the text operators, and their SQL."""

from __future__ import annotations

import corpus_pipeline
from talweg.llm import byte_bpe, chat_format, fingerprints, jaccard_join, line_dedup, lm_score, packing, quality_rules, toxicity, warc_zip

QUERIES = {
    "op1_chat_format": chat_format.query,
    "op2_lm_score": lm_score.query,
    "op3_jaccard_join": jaccard_join.query,
    "op4_quality_rules": quality_rules.query,
    "op5_warc_zip": warc_zip.query,
    "op6_fingerprints": fingerprints.query,
    "op7_packing": packing.query,
    "op8_byte_bpe": byte_bpe.query,
    "op9_line_dedup": line_dedup.query,
    "op10_toxicity": toxicity.query,
    "pipeline": corpus_pipeline.run,
}
ORACLE_SQL = {
    "op1_chat_format": chat_format.sql(),
    "op2_lm_score": lm_score.sql(),
    "op4_quality_rules": quality_rules.sql(),
    "op5_warc_zip": warc_zip.sql(),
    "op9_line_dedup": line_dedup.sql(),
}

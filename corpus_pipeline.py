"""A training-corpus pipeline: five operators in a row over the documents table.

Each stage takes (spark, docs, sf_dir), where docs is what its predecessor kept, and returns a DataFrame; all but the last
return the columns of documents. SQL can't express the first stage, so ORACLE_SQL is None and the tests hold run()
against a plain version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talweg.llm import _common, jaccard_join, line_dedup, packing, quality_rules, toxicity

STAGES = [
    ("toxicity", toxicity.stage),
    ("quality_rules", quality_rules.stage),
    ("line_dedup", line_dedup.stage),
    ("jaccard_join", jaccard_join.stage),
    ("packing", packing.stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = _common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Every query over the driver's tables, over odd rows and over empty tables."""

import pytest
from oracle import compare

from talweg.llm import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, sf, name):
    compare(registry.QUERIES[name], registry.ORACLE_SQL[name], spark, sf)


DOCUMENTS = ("op2_lm_score", "op3_jaccard_join", "op4_quality_rules", "op6_fingerprints", "op8_byte_bpe", "op9_line_dedup", "op10_toxicity")


@pytest.mark.parametrize("name", DOCUMENTS)
def test_one_row_per_odd_document(spark, odd_dir, name):
    from conftest import ODD

    rows = registry.QUERIES[name](spark, odd_dir).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i, _, _ in ODD)


@pytest.mark.parametrize("name", ("op1_chat_format", "op5_warc_zip", "op7_packing", "pipeline"))
def test_odd_rows(spark, odd_dir, name):
    assert registry.QUERIES[name](spark, odd_dir).count() > 0


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert registry.QUERIES[name](spark, empty_dir).collect() == []

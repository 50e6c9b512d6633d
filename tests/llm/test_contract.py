"""What holds for all registered queries of the document operators."""

from __future__ import annotations

from pathlib import Path

import pytest

from adsettle.llm import queries

FOLDER = "/root/testdata/sf0.001"
TESTS = Path(__file__).parent

#: Queries that SQL can't express, and where each one's proof is: a brute-force version, an exact round trip or
#: held-out accuracy.
PROVEN = {
    "op1_quality_rules": "test_documents",
    "op2_extraction": "test_templates",
    "op3_byte_bpe": "test_bpe",
    "op5_quality_classifier": "test_documents",
    "op6_licenses": "test_documents",
    "op7_personal_data": "test_pii",
    "op8_decontamination": "test_documents",
    "op9_language": "test_documents",
    "op10_simhash": "test_near_duplicates",
    "op11_periodic_runs": "test_periodic",
    "op13_shards": "test_shards",
    "pipeline": "test_documents",
}


def test_every_query_has_proof():
    assert set(queries.queries()) == set(queries.oracle_sql()) | set(PROVEN)
    assert all((TESTS / f"{name}.py").exists() for name in PROVEN.values())


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - {"pipeline"}))
def test_nothing_is_crossed(spark, name):
    df = queries.queries()[name](spark, FOLDER)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in text for x in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"))

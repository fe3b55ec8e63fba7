"""Every registered query against its SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

PLANS, SQL = entry.queries(), entry.oracle_sql()

# Queries that run vectorised Python functions on the executors; all others stay in the JVM.
PYTHON = {
    "q_score_multimodal", "q_transfer", "op2_sentencepiece", "op3_toxicity", "op5_token_shards", "op6_packing",
    "op7_nearest_neighbours", "op8_suffix_dedup", "op9_minhash_dedup", "op11_hard_negatives",
    "op13_conversation_trie", "pipeline",
}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query(spark, sf_dir, con, name):
    df = PLANS[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in plan
    if name not in PYTHON:
        for bad in ("Python", "InPandas", "InArrow", "ArrowEval"):
            assert bad not in plan
    if name in SQL:
        assert compare(df, con, SQL[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["section", "item", "n", "note"]


def test_every_query_has_a_plan():
    assert len(PLANS) >= 126 and set(SQL) <= set(PLANS)

"""t1 smoke + t2 oracle: every registered query vs its DuckDB SQL at sf0.01."""

import pytest

from __spark_entry__ import entry
from popflow.plans.registry import ORACLE, QUERIES
from tests.conftest import SF01
from tools.oracle_check import compare, duck_connect


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF01)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["player", "total_score", "bonus_hits"]
    rows = df.collect()
    assert len(rows) == 5
    scores = [r.total_score for r in rows]
    assert scores == sorted(scores, reverse=True)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, SF01, QUERIES, ORACLE) == []

"""Driver contract: entry runs; every oracle query equals its Spark query."""

from __future__ import annotations

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from compare import TABLES, norm  # noqa: E402

SF = "/root/testdata/sf0.001"
NO_ORACLE = {"train_gbt", "topk_importance", "batch_score"}  # a model's scores; their facts are checked by other queries


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["actor_account_id", "last_session_timestamp"]


def test_registry():
    from sessionsmith.plans.catalog import QUERIES

    assert set(QUERIES) - set(oracle_sql()) == NO_ORACLE
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(oracle_sql())))
def test_oracle(spark, con, name):
    got = queries()[name](spark, SF).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert norm(got) == norm(want)

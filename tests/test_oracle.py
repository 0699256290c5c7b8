"""Every query against its SQL at the smallest scale."""

import pytest

import compare
from __spark_entry__ import entry, oracle_sql, queries

ROOT = "/root/testdata/sf0.001"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def db():
    return compare.connect(ROOT)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, db, name):
    spark_names, spark_rows = compare.spark_rows(QUERIES[name](spark, ROOT))
    duck_names, duck_rows, inexact = compare.duck_rows(db, ORACLES[name])
    assert not inexact, "the SQL should return plain numbers"
    assert spark_names == duck_names
    assert spark_rows == duck_rows


def test_every_trade_query_has_sql():
    assert {q for q in set(QUERIES) - set(ORACLES) if not q.startswith("op")} <= {"pipeline"}
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() == 7

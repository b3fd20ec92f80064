"""Every registered query against its independent DuckDB SQL (sf0.001)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from wayfare.testing import frames_equal

from wayfare.plans import ORACLE, QUERIES

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF001).toArrow()
    exp = duck.sql(E.oracle_sql()[name]).to_arrow_table()
    ok, why = frames_equal(got, exp)
    assert ok, why


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["n_pairs", "sum_delay", "avg_delay"]
    assert rows[0]["n_pairs"] == 221


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "binary": "BLOB"}


@pytest.mark.parametrize("name", NAMES)
def test_query_schema_matches_oracle(spark, duck, name):
    got = dict(E.queries()[name](spark, SF001).dtypes)
    rel = duck.sql(E.oracle_sql()[name])
    exp = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in got.items()} == exp

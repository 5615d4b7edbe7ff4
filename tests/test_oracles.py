"""Every registered query that has an SQL form against it, at sf0.001, and the
driver contract itself. (The training-text queries are tested in ``tests/llm``.)"""

import pytest

import __spark_entry__ as entry

from .conftest import SF001
from .oracle_check import compare, duck

NAMES = sorted(set(entry._QUERIES) & set(entry.oracle_sql()))


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 58 and df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ok, msg = compare(rows, df.columns, res.fetchall(), [d[0] for d in res.description])
    assert ok, msg

"""Catalog and SQL agree on the smallest tables, cell by cell."""
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SMALL
from tools.compare import canonical, connect, difference

TEXTS = oracle_sql()
SLOW = {"s_model_roundtrip"}  # covered by test_models


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_text_has_a_query():
    assert set(TEXTS) <= set(queries())


def test_entry_runs(spark):
    assert entry(spark).count() == 24


@pytest.mark.parametrize("name", sorted(set(TEXTS) - SLOW))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, SMALL)
    result = duck.execute(TEXTS[name])
    theirs = canonical([d[0] for d in result.description], result.fetchall())
    assert difference(canonical(df.columns, df.collect()), theirs) is None

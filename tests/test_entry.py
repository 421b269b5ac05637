"""The driver contract: entry() runs, every query has a stable schema, and
every query with an oracle equals it on the smallest test scale."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_check import _arrow, compare, duck


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["shipping_country", "total_revenue", "order_count", "avg_order_value"]


def test_oracles_belong_to_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    stable = E.queries()[name](spark, SF_SMALL).toArrow()
    oracle = E.oracle_sql().get(name)
    if oracle is None:
        assert stable.num_rows > 0
        return
    otable = _arrow(con.execute(oracle))
    types = lambda t: {f.name: str(f.type) for f in t.schema}
    assert types(stable) == types(otable)
    ok, msg = compare(name, stable.to_pandas(date_as_object=True), otable.to_pandas(date_as_object=True))
    assert ok, msg

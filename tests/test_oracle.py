"""Every registered query against its DuckDB oracle on the smallest input (sf0.001),
plus the entry-point contract."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import compare

SF = "/root/testdata/sf0.001"
KEYS = sorted(E.queries())


def test_contract(spark):
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    df = E.entry(spark)
    assert df.columns == ["age_buy", "sex", "ppp", "bpp", "prem"]
    assert df.count() > 0


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    assert res[0] in ("OK", "NO_ORACLE"), res

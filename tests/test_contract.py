"""Every contract query against its DuckDB oracle on sf0.001 (the driver checks sf0.01 the same way)."""

import pytest

import __spark_entry__ as E
from dayfold.plans import contract, oracle
from conftest import SF_SMALL
from helpers import canon, spark_rows

QUERIES = dict(contract.QUERIES)
ORACLE = oracle.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cur = duck.execute(ORACLE[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert spark_rows(df) == canon(cur.fetchall(), cols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() > 0


EXPECTED_SF0001 = {  # FIXTURES.md: DuckDB counts, facts bounded to the report day
    "fraud_passport": 17, "fraud_contract": 29, "fraud_travel": 4, "fraud_amount_probing_replay": 2,
    "scd2_merge": 202,
}


@pytest.mark.parametrize("name,n", sorted(EXPECTED_SF0001.items()))
def test_published_counts(spark, name, n):
    assert QUERIES[name](spark, SF_SMALL).count() == n

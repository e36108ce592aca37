"""Each query against its DuckDB oracle on the smallest driver tables."""
import pytest

from __spark_entry__ import oracle_sql, queries
from bankflow.plans.oracle import ORACLE
from bankflow.plans.queries import QUERIES
from tools.check_oracle import digest

KEYS = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", KEYS)
def test_query_matches_oracle(spark, duck, name):
    from tests.conftest import SF_SMALL

    df = queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    rows = entry(spark).collect()
    assert len(rows) == 3
    assert {r["account_type"] for r in rows} == {"SAVINGS", "CHECKING", "CREDIT"}

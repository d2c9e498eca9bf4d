"""Every catalogue query with an oracle against DuckDB at sf0.01, compared
like the driver: sorted column names, row count, order-insensitive hash."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.01"

import __spark_entry__ as E  # noqa: E402
from check_oracle import digest, duck, table_rows  # noqa: E402

from loomstat.plans import QUERIES as CATALOGUE  # noqa: E402

ORACLE = {k: v for k, v in E.oracle_sql().items() if k in CATALOGUE}
QUERIES = {k: v for k, v in E.queries().items() if k in CATALOGUE}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_contract_shapes():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 100


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["month", "n", "month_start"] and df.count() > 0


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    a, ac = table_rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLE[key])
    b, bc = table_rows([c[0] for c in res.description], res.fetchall())
    assert ac == bc
    assert len(a) == len(b)
    assert digest(a) == digest(b)


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_queries_without_oracle(spark, key):
    rows = QUERIES[key](spark, SF).collect()
    assert rows
    got = {c: [r[c] for r in rows] for c in rows[0].__fields__}
    assert all(any(v is not None for v in x) for x in got.values())
    if "prediction" in got:  # one prediction for each test row, of a known label
        assert set(got["prediction"]) <= set(range(10)) and None not in got["label"]
    for c in ("p_value", "accuracy", "precision", "recall", "f1", "mean_accuracy"):
        assert all(0 <= v <= 1 for v in got.get(c, ()) if v is not None)

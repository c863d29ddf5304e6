"""Every registered query against its DuckDB oracle on sf0.001 (the driver
does the same at sf0.01; ``python tests/oracle_check.py`` runs that)."""
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_check  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from perfwatch.plans import queries as catalogue  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return oracle_check.duck(SF)


def test_every_query_has_oracle_sql():
    assert set(catalogue.queries()) <= set(SQL) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "overall_health_score" in df.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(SQL[name])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert oracle_check.type_mismatches(df.dtypes, res.description) == []
    assert len(srows) == len(drows)
    assert oracle_check.canon(srows, scols) == oracle_check.canon(drows, dcols)

"""Every registered query against its DuckDB SQL on the shared tables.

Uses sf0.001 by default (CONTRAIL_ORACLE_SF overrides); queries without SQL
(forest, sample) are run for a non-empty, stable schema only.
"""

import os

import pytest

import __spark_entry__ as E
from oracle_compare import duck, kind, rows_of

SF = os.environ.get("CONTRAIL_ORACLE_SF", "/root/testdata/sf0.001")
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    got = sdf.toPandas()
    if name not in ORACLE:
        assert len(got) > 0
        return
    want = con.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert {c: kind(got[c]) for c in got.columns if kind(got[c]) != "empty" and kind(want[c]) != "empty"} == \
        {c: kind(want[c]) for c in got.columns if kind(got[c]) != "empty" and kind(want[c]) != "empty"}
    assert rows_of(got) == rows_of(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["flight_phase", "count"]

"""Every registered query against its DuckDB statement (the driver's check, on sf0.001)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402
from conftest import SF_SMALL  # noqa: E402
from flowruns.plans import catalog  # noqa: E402

NAMES = sorted(catalog.build())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 170
    assert df.columns[:3] == ["DEVICE_ID", "START_TIMESTAMP", "END_TIMESTAMP"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_output_types_are_the_declared_ones(spark):
    from flowruns import schema as S
    from flowruns.operators.summary import summarize_runs
    from flowruns.sources.readers import readings

    want = [(f.name, f.dataType.simpleString()) for f in S.RUNS_SCHEMA.fields]
    got = [(f.name, f.dataType.simpleString()) for f in summarize_runs(readings(spark, SF_SMALL)).schema.fields]
    assert got == want
    shown = [(f.name, f.dataType.simpleString()) for f in E.entry(spark).schema.fields]
    assert shown == want  # rounding for the comparison keeps doubles as doubles

"""Every registered query with SQL gives DuckDB's rows."""

import math
import sys
from collections import Counter

import duckdb
import pytest

from quernstone.plans import registry
from quernstone.session import TABLES

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v) if isinstance(v, float) else str(v)


def counted(rows, columns):
    at = [columns.index(c) for c in sorted(columns)]
    return Counter(tuple(cell(r[i]) for i in at) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_duckdb(spark, sf_dir, duck, name):
    df, want = QUERIES[name](spark, sf_dir), duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert counted(map(tuple, df.collect()), df.columns) == counted(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_training_data_operators(monkeypatch):
    import __spark_entry__ as entry

    monkeypatch.setitem(sys.modules, "quernstone.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    names = entry.queries()
    assert "worklist" in names and "pipeline" not in names


def test_filters_and_columns_reach_the_scan(spark, sf_dir, capsys):
    QUERIES["flt_between_unit"](spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(l_quantity" in plan and "l_extendedprice" not in plan


def test_latest_is_an_aggregate_and_no_sort(spark, sf_dir, capsys):
    QUERIES["win_latest_distinct_on"](spark, sf_dir).explain()
    plan = capsys.readouterr().out
    assert "Window" not in plan and "partial_max_by" in plan

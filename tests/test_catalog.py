"""Every registered query of the engine against its SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from tickforge.plans import catalog
from tickforge.plans.adapters import duck_sql

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


def equal(df, want):
    assert sorted(df.columns) == sorted(want.columns)
    names = sorted(df.columns)
    at = [want.columns.index(n) for n in names]
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_equals_sql(spark, duck, name):
    equal(catalog.QUERIES[name](spark, SF), duck.sql(catalog.ORACLE[name]))


@pytest.mark.parametrize(("name", "sql", "limits"), [("occupancy_caps", catalog.caps_sql, (2, 5)), ("occupancy_exclusion", catalog.exclusion_sql, (2, 5)), ("heatmap_faults", catalog.faults_sql, (-60, 60, 40, 2)), ("region_budget", catalog.budget_sql, (1000,)), ("replay_graph_players", catalog.graph_sql, (3,))])
def test_limits_that_the_small_tables_pass(spark, duck, name, sql, limits):
    df = catalog.QUERIES[name](spark, SF, *limits)
    assert df.limit(1).count()
    equal(df, duck.sql(duck_sql(sql(*limits))))


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)

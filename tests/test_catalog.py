"""Every query of the catalog against its SQL on the smallest tables, and plans without Python."""

import glob
import os

import duckdb
import pytest

from corvane.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


def rows_of(names, rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, con, name):
    got = catalog.queries()[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(f"select {', '.join(chr(34) + c + chr(34) for c in cols)} from ({catalog.oracle_sql()[name]})").fetchall()
    assert rows_of(cols, got.select(*cols).collect()) == rows_of(cols, want)


@pytest.mark.parametrize("name", ["path_features", "select_variants", "fallback_plan", "quality_report", "neighbor_context", "merge_normalize", "visual_manifest"])
def test_native_plans(spark, name):
    plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan and "CartesianProduct" not in plan


def test_listed_queries_have_functions():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())

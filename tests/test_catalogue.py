"""Every query of the library against its SQL, on the smallest tables of the driver."""

import os

import duckdb
import pandas as pd
import pytest

from terrace.plans import catalogue, collect, review, supervision

assert collect and review and supervision

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in catalogue.TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(df: pd.DataFrame) -> tuple[list[str], list[str]]:
    columns = sorted(df.columns)

    def one(v):
        if v is None or v is pd.NA or v is pd.NaT or v != v:
            return None
        return v if isinstance(v, bool) else round(float(v), 4) if isinstance(v, (int, float)) else str(v)

    return columns, sorted(str([one(v) for v in r]) for r in df[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_its_sql(spark, con, name):
    assert rows(catalogue.QUERIES[name](spark, SF).toPandas()) == rows(con.sql(catalogue.ORACLES[name]).df())


def test_rankings_have_one_total(spark):
    totals = {n: catalogue.QUERIES[n](spark, SF).toPandas().repeat_count.sum() for n in ("hits_by_column", "hits_by_file", "hits_by_file_column")}
    assert len(set(totals.values())) == 1


def test_section_text(spark):
    out = catalogue.QUERIES["html_section_text"](spark, SF).toPandas()
    assert out.text.str.len().gt(0).all() and not out.text.str.contains("<p>|&amp;", regex=True).any()


def test_plans_stay_in_the_engine(spark):
    """No Python in the plans of queries that built-in expressions state, and narrow reads."""
    for name in ("hits_by_column", "ordered_distinct_fold", "tiered_match", "validation_summary", "best_attempt", "multi_hop"):
        plan = catalogue.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan, name
    plan = catalogue.QUERIES["resume_remaining"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint>" in plan

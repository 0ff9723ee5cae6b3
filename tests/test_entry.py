"""Driver contract, every registered query against its DuckDB oracle (sf0.001),
and properties of the grid on the demo views."""

import os

import pytest
from conftest import SMOKE_DIR
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lookback.catalog import F0, QUERIES, YEARS, _views
from lookback.oracle import ORACLE_SQL
from lookback.plans.grid import feature_grid_long
from lookback.sources.codebook import read_codebook

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="no driver test data")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "bene_id" and df.columns[-1] == "rfrnc_yr"
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


def test_all_queries_match_oracle(spark):
    from oracle_compare import compare
    res = compare(spark, SMOKE_DIR)
    bad = {k: v for k, v in res.items() if not v.get("hash_match") or v["rows"] != v["oracle_rows"]}
    assert not bad, bad


@pytest.fixture(scope="module")
def demo(spark):
    return _views(spark, SMOKE_DIR)


def _grid(spark, demo, book):
    ev, en = demo
    return feature_grid_long(ev, en, read_codebook(spark, book), YEARS, F0)


def _met(df):
    return {(r.bene_id, r.rfrnc_yr) for r in df.where(F.col("status").isin(1, 3)).collect()}


def _cov(df):
    return {(r.bene_id, r.rfrnc_yr) for r in df.where(F.col("status").isin(2, 3)).collect()}


def test_grid_properties(spark, demo):
    base = {"ref_period": 1, "icd9": ["Brand#1"], "icd10": ["Brand#2"]}
    g = _grid(spark, demo, {"a": base})
    _, en = demo
    assert g.count() == en.count()                                   # one row per spine row
    assert {r.status for r in g.select("status").distinct().collect()} <= {0, 1, 2, 3}
    # first date never moves later as the reference year grows
    rows = sorted((r.bene_id, r.rfrnc_yr, r.ever) for r in g.where(F.col("ever").isNotNull()).collect())
    for (b1, y1, e1), (b2, y2, e2) in zip(rows, rows[1:]):
        if b1 == b2 and y2 > y1:
            assert e2 <= e1
    # rules nest: primary within first_two within all (no exclusions)
    met = {rule: _met(_grid(spark, demo, {"a": dict(base, claims_criteria=rule)}))
           for rule in ("primary", "first_two", "all")}
    assert met["primary"] <= met["first_two"] <= met["all"]
    # a longer look-back never loses a met rule, and never turns coverage on
    longer = _grid(spark, demo, {"a": dict(base, ref_period=3)})
    assert met["all"] <= _met(longer)
    assert _cov(longer) <= _cov(g)

"""Plan checks: on every registered query (sf0.001) no cartesian product, nested-loop
join, Python UDF or collected group; on year-partitioned files the number of
scans that the final plans really run."""

import os

import pytest
from conftest import SMOKE_DIR
from pyspark.sql import functions as F

from lookback.catalog import QUERIES
from lookback.operators.met import met
from lookback.plans.grid import feature_grid
from lookback.plans.pair import condition_feature
from lookback.sources.codebook import read_codebook
from lookback.sources.demo import EXCL_CODEBOOK, demo_enrolment, demo_event_codes
from lookback.sources.yearly import read_partitioned

pytestmark = pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="no driver test data")

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "collect_list")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_are_scalable(spark):
    for name, q in QUERIES.items():
        plan = _plan(q(spark, SMOKE_DIR))
        for word in FORBIDDEN:
            assert word not in plan, (name, word)


def test_grid_scans_prune_columns(spark):
    plan = _plan(QUERIES["q_matrix_all"](spark, SMOKE_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int>" in plan
    assert "o_totalprice" not in plan


@pytest.mark.parametrize("name", ["q_scan_year", "q_scan_window", "q_union_years", "q_hits_all", "q_met_all", "q_met_excl"])
def test_year_range_reaches_the_scan(spark, name):
    plan = _plan(QUERIES[name](spark, SMOKE_DIR))
    for line in plan.splitlines():
        if "FileScan" in line and "o_orderdate" in line:
            assert "GreaterThanOrEqual(o_orderdate" in line and "LessThan(o_orderdate" in line


def _scans(df):
    """Folder names of the file scans of the final plan, subqueries included, each run once."""
    df.collect()
    found = []

    def walk(p):
        kind = p.getClass().getSimpleName()
        if kind in ("ReusedExchangeExec", "ReusedSubqueryExec"):
            return
        if kind == "AdaptiveSparkPlanExec":
            walk(p.executedPlan())
            return
        if kind.endswith("QueryStageExec"):
            walk(p.plan())
            return
        if kind == "FileSourceScanExec":
            found.append(p.relation().location().rootPaths().head().getName())
        for children in (p.children(), p.subqueries()):
            it = children.iterator()
            while it.hasNext():
                walk(it.next())
    walk(df._jdf.queryExecution().executedPlan())
    return sorted(found)


@pytest.fixture(scope="module")
def yearly(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("yearly"))
    ev, en = demo_event_codes(spark, SMOKE_DIR), demo_enrolment(spark, SMOKE_DIR)
    for name, df in (("plain_adm", ev), ("plain_bene", en),
                     ("null_adm", ev.withColumn("bene_id", F.when(F.col("bene_id") % 5 != 0, F.col("bene_id"))))):
        df.repartition("file_year").write.partitionBy("file_year").parquet(f"{root}/{name}")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield {k: read_partitioned(spark, f"{root}/{k}") for k in ("plain_adm", "null_adm", "plain_bene")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.mark.parametrize("adm", ["plain_adm", "null_adm"])
@pytest.mark.parametrize("scope", ["oldest_year", "window"])
def test_one_event_scan_per_pair(spark, yearly, adm, scope):
    ev, en = yearly[adm], yearly["plain_bene"]
    excl = read_codebook(spark, EXCL_CODEBOOK)
    plain = read_codebook(spark, {"a": {"ref_period": 2, "icd9": ["Brand#1"], "icd10": []}})
    assert _scans(met(ev, excl, "x1", 1999, 1995, scope)) == [adm]
    assert _scans(met(ev, plain, "a", 1999, 1995, scope)) == [adm]
    assert _scans(condition_feature(ev, en, excl, "x1", 1999, 1995, scope)) == [adm, "plain_bene", "plain_bene"]
    assert _scans(condition_feature(ev, en, plain, "a", 1999, 1995, scope)) == [adm, "plain_bene", "plain_bene"]


@pytest.mark.parametrize("adm", ["plain_adm", "null_adm"])
def test_grid_scans_events_once(spark, yearly, adm):
    grid = feature_grid(yearly[adm], yearly["plain_bene"], read_codebook(spark, EXCL_CODEBOOK), [1998, 1999], 1995)
    assert _scans(grid) == [adm, "plain_bene", "plain_bene"]

"""Co-bucketed merge: no exchange, the rows of the merge chain; counts that jobs observe while they write."""

import json

import pytest
from fixtures import MICRO_ADM, MICRO_BENE, MICRO_BOOK, MICRO_EXPECTED

from lookback.plans.buckets import bucket_count, merge_bucketed, write_bucketed
from lookback.plans.jobs import condition_year_job, merge_year_job
from lookback.plans.matrix import merge_chain
from lookback.schemas import ENROLMENT, EVENTS


@pytest.fixture
def tables(spark):
    """Names of tables that are dropped afterwards."""
    made = []
    yield made
    for t in made:
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def _exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _pair(spark, c, rows):
    return spark.createDataFrame([(b, 2003, s, None) for b, s in rows], f"bene_id string, rfrnc_yr int, {c} int, {c}_ever date")


@pytest.fixture
def no_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_no_exchange_and_the_rows_of_the_chain(spark, tables, no_broadcast):
    rows = {"P": [(f"b{i}", i % 4) for i in range(200)] + [("b7", 3), ("b7", 3), (None, 1)],
            "Q": [(f"b{i}", None if i % 9 == 0 else i % 3) for i in range(5, 230)] + [(None, 2)],
            "R": [(f"b{i}", 1) for i in range(0, 220, 2)] + [("b7", 0), ("b7", 0)]}
    frames = {c: _pair(spark, c, r) for c, r in rows.items()}
    for c, df in frames.items():
        tables.append(write_bucketed(df, f"lb_merge_{c}", 4))
        assert bucket_count(spark, f"lb_merge_{c}") == 4
    merged = merge_bucketed([(c, spark.table(f"lb_merge_{c}")) for c in rows], 2003)
    assert _exchanges(merged) == 0
    want = merge_chain(list(frames.items()), 2003)
    assert merged.columns == want.columns
    assert sorted(map(str, merged.collect())) == sorted(map(str, want.collect()))
    assert sum(r.bene_id == "b7" for r in merged.collect()) == 3  # as often as in the first table
    assert _exchanges(merge_bucketed(list(frames.items()), 2003)) > 0  # any frames, but then with a shuffle


def test_conflicting_duplicates_raise(spark, tables):
    a, b = _pair(spark, "P", [("b1", 0)]), _pair(spark, "Q", [("b1", 0), ("b1", 2)])
    with pytest.raises(Exception, match="different rows of Q for id b1"):
        merge_bucketed([("P", a), ("Q", b)], 2003).collect()


def _inputs(spark, root):
    for y in range(2000, 2004):
        spark.createDataFrame([(b, d, arr) for b, d, fy, arr in MICRO_ADM if fy == y], EVENTS).write.parquet(f"{root}/adm_{y}.parquet")
        spark.createDataFrame([(b, yy, h) for b, yy, h in MICRO_BENE if yy == y], ENROLMENT).write.parquet(f"{root}/bene_{y}.parquet")
    with open(f"{root}/ccw.json", "w") as f:
        json.dump(MICRO_BOOK, f)
    return dict(ccw_json=f"{root}/ccw.json", dw_bene_prefix=f"{root}/bene", dw_adm_prefix=f"{root}/adm", first_year=2000)


def test_jobs_on_tables(spark, tmp_dir, tables):
    kw = _inputs(spark, tmp_dir)
    for c in MICRO_BOOK:
        tables.append(condition_year_job(spark, 2003, c, output_prefix="lb_job", output_format="table", buckets=3, **kw))
    out = merge_year_job(spark, 2003, "lb_job", "lb_job_matrix", kw["ccw_json"], output_format="table")
    tables.append(out)
    assert out == "lb_job_matrix_2003" and bucket_count(spark, out) == 3
    got = spark.table(out).collect()
    assert out.counts == {"rows": len(got)} and len(got) == len(MICRO_EXPECTED)
    for r in got:
        for c in MICRO_BOOK:
            assert (r[c], r[f"{c}_ever"]) == MICRO_EXPECTED[r.bene_id][c]
    tables.append(condition_year_job(spark, 2003, "P", output_prefix="lb_job", output_format="table", buckets=5, **kw))
    with pytest.raises(ValueError, match="one number of buckets"):
        merge_year_job(spark, 2003, "lb_job", "lb_job_matrix", kw["ccw_json"], output_format="table")


def test_counts_come_out_of_the_write(spark, tmp_dir):
    from lookback.operators.stats import pair_step_counts
    from lookback.sources.codebook import read_codebook
    from lookback.sources.yearly import read_years

    kw = _inputs(spark, tmp_dir)
    events, enrol = read_years(spark, f"{tmp_dir}/adm", range(2000, 2004)), read_years(spark, f"{tmp_dir}/bene", range(2000, 2004))
    book = read_codebook(spark, MICRO_BOOK)
    for c in MICRO_BOOK:
        out = condition_year_job(spark, 2003, c, output_prefix=f"{tmp_dir}/prev", **kw)
        want = {r.step: r.n_rows for r in pair_step_counts(events, enrol, book, c, 2003, 2000).collect()}
        assert out.counts == want, c
    merged = merge_year_job(spark, 2003, f"{tmp_dir}/prev", f"{tmp_dir}/out", kw["ccw_json"])
    assert merged.counts == {"rows": spark.read.parquet(merged).count()}


def test_counts_of_an_empty_year(spark, tmp_dir):
    kw = _inputs(spark, tmp_dir)
    spark.createDataFrame([], ENROLMENT).write.mode("overwrite").parquet(f"{tmp_dir}/bene_2003.parquet")
    out = condition_year_job(spark, 2003, "A", output_prefix=f"{tmp_dir}/prev", **kw)
    assert out.counts["spine"] == 0 and spark.read.parquet(out).count() == 0

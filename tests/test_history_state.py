"""History as a mergeable state: equal to the full grid, one year's files scanned, runs of a year repeatable."""

import json

import pytest
from fixtures import MICRO_ADM, MICRO_BENE, MICRO_BOOK, MICRO_EXPECTED, frames
from pyspark.sql import functions as F
from test_plans import SMOKE_DIR, _scans

from lookback.plans.grid import feature_grid, feature_grid_long
from lookback.plans.jobs import all_years_job, state_year_job
from lookback.plans.state import merge_facts, state_grid, state_grid_long, state_years, update_state, year_facts
from lookback.schemas import ENROLMENT, EVENTS
from lookback.sources.codebook import read_codebook
from lookback.sources.demo import DEMO_CODEBOOK, demo_enrolment, demo_event_codes, wide_codebook
from lookback.sources.yearly import read_partitioned

YEARS = list(range(1995, 2000))


def _rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))


def _year(df, *years):
    return df.where(F.col("file_year").isin(list(years)))


@pytest.fixture(scope="module")
def demo(spark, tmp_path_factory):
    """Year-partitioned files, some ids NULL, some enrolment rows twice."""
    root = str(tmp_path_factory.mktemp("state"))
    ev, en = demo_event_codes(spark, SMOKE_DIR), demo_enrolment(spark, SMOKE_DIR)
    hole = F.when(F.col("bene_id") % 7 != 0, F.col("bene_id"))
    ev = ev.withColumn("bene_id", hole)
    en = en.withColumn("bene_id", hole)
    en = en.unionByName(en.where("bene_id % 5 = 0"))
    for name, df in (("adm", ev), ("bene", en)):
        df.repartition("file_year").write.partitionBy("file_year").parquet(f"{root}/{name}")
    return read_partitioned(spark, f"{root}/adm"), read_partitioned(spark, f"{root}/bene")


@pytest.mark.parametrize("scope", ["oldest_year", "window"])
@pytest.mark.parametrize("book", [DEMO_CODEBOOK, wide_codebook(9)])
def test_old_state_and_a_new_year_equal_the_grid(spark, demo, tmp_dir, scope, book):
    ev, en = demo
    cb = read_codebook(spark, book, exclusion_codes="all")
    update_state(spark, tmp_dir, _year(ev, 1995, 1996, 1997, 1998), _year(en, 1995, 1996, 1997, 1998), cb, YEARS[:4], 1995)
    update_state(spark, tmp_dir, _year(ev, 1999), _year(en, 1999), cb, 1999, 1995)
    assert state_years(spark, tmp_dir) == YEARS
    for years in ([1999], [1995, 1996], YEARS):
        want = feature_grid(ev, en, cb, years, 1995, scope)
        assert _rows(state_grid(spark, tmp_dir, en, cb, years, 1995, scope)) == _rows(want), years
    assert _rows(state_grid_long(spark, tmp_dir, en, cb, [1999], 1995, scope)) == _rows(feature_grid_long(ev, en, cb, [1999], 1995, scope))


def test_year_by_year_and_again(spark, demo, tmp_dir):
    ev, en = demo
    cb = read_codebook(spark, DEMO_CODEBOOK)
    for y in YEARS:
        update_state(spark, tmp_dir, _year(ev, y), _year(en, y), cb, y, 1995)
    want = _rows(feature_grid(ev, en, cb, YEARS, 1995))
    first = {part: _rows(spark.read.parquet(f"{tmp_dir}/{part}")) for part in ("facts", "first")}
    for y in (1999, 1996):  # the newest year, and one whose first dates later years carry
        update_state(spark, tmp_dir, _year(ev, y), _year(en, y), cb, y, 1995)
        assert {part: _rows(spark.read.parquet(f"{tmp_dir}/{part}")) for part in first} == first
    assert _rows(state_grid(spark, tmp_dir, en, cb, YEARS, 1995)) == want
    # A corrected file of an old year changes the first dates of later years without their events.
    less = _year(ev, 1996).where("adm_id % 2 = 0")
    update_state(spark, tmp_dir, less, _year(en, 1996), cb, 1996, 1995)
    fixed = _year(ev, 1995, 1997, 1998, 1999).unionByName(less)
    assert _rows(state_grid(spark, tmp_dir, en, cb, [1999], 1995)) == _rows(feature_grid(fixed, en, cb, [1999], 1995))


def test_only_the_new_year_is_scanned(spark, demo, tmp_dir):
    ev, en = demo
    cb = read_codebook(spark, DEMO_CODEBOOK)
    update_state(spark, tmp_dir, _year(ev, *YEARS[:4]), _year(en, *YEARS[:4]), cb, YEARS[:4], 1995)
    facts = year_facts(_year(ev, 1999), _year(en, 1999), cb, [1999])
    assert _scans(facts) == ["adm", "bene"]
    for line in facts._jdf.queryExecution().executedPlan().toString().splitlines():
        if "FileScan" in line:
            assert "PartitionFilters: [isnotnull(file_year" in line and "1999" in line
    update_state(spark, tmp_dir, _year(ev, 1999), _year(en, 1999), cb, 1999, 1995)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # No event file: the window's facts and the first dates of one year (for the guards too), the spine.
        assert set(_scans(state_grid(spark, tmp_dir, en, cb, [1999], 1995))) == {"bene", "facts", "first"}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_deliveries_of_one_year_merge(spark, demo, tmp_dir):
    ev, en = demo
    cb = read_codebook(spark, DEMO_CODEBOOK)
    a, b = _year(ev, 1995).where("adm_id % 3 = 0"), _year(ev, 1995).where("adm_id % 3 != 0")
    whole = year_facts(_year(ev, 1995), _year(en, 1995), cb, [1995])
    parts = merge_facts([year_facts(a, _year(en, 1995), cb, [1995]), year_facts(b, _year(en, 1995).limit(0), cb, [1995])])
    assert _rows(parts.select(*whole.columns)) == _rows(whole)
    update_state(spark, tmp_dir, a, _year(en, 1995), cb, 1995, 1995)
    update_state(spark, tmp_dir, b, _year(en, 1995).limit(0), cb, 1995, 1995, mode="add")
    assert _rows(state_grid(spark, tmp_dir, en, cb, [1995], 1995)) == _rows(feature_grid(ev, en, cb, [1995], 1995))


def test_wrong_uses_raise(spark, demo, tmp_dir):
    ev, en = demo
    cb = read_codebook(spark, DEMO_CODEBOOK)
    with pytest.raises(ValueError, match="needs all years"):
        update_state(spark, tmp_dir, ev, en, cb, 1996, 1995)
    update_state(spark, tmp_dir, _year(ev, 1995), _year(en, 1995), cb, 1995, 1995)
    other = read_codebook(spark, {**DEMO_CODEBOOK, "c1": {**DEMO_CODEBOOK["c1"], "icd9": ["Brand#8"]}})
    with pytest.raises(ValueError, match="another codebook"):
        update_state(spark, tmp_dir, _year(ev, 1996), _year(en, 1996), other, 1996, 1995)
    with pytest.raises(ValueError, match="doesn't hold"):
        state_grid(spark, tmp_dir, en, cb, [1996], 1995)
    with pytest.raises(ValueError, match="run of years"):
        update_state(spark, tmp_dir, ev, en, cb, [1996, 1998], 1995)


def test_state_job_equals_the_whole_job(spark, tmp_dir):
    for y in range(2000, 2004):
        adm = [(b, d, arr) for b, d, fy, arr in MICRO_ADM if fy == y]
        bene = [(b, yy, h) for b, yy, h in MICRO_BENE if yy == y]
        spark.createDataFrame(adm, EVENTS).write.parquet(f"{tmp_dir}/adm_{y}.parquet")
        spark.createDataFrame(bene, ENROLMENT).write.parquet(f"{tmp_dir}/bene_{y}.parquet")
    with open(f"{tmp_dir}/ccw.json", "w") as f:
        json.dump(MICRO_BOOK, f)
    kw = dict(ccw_json=f"{tmp_dir}/ccw.json", dw_bene_prefix=f"{tmp_dir}/bene", dw_adm_prefix=f"{tmp_dir}/adm", first_year=2000)
    for y in range(2000, 2004):
        state_year_job(spark, y, state_path=f"{tmp_dir}/state", output_path=f"{tmp_dir}/steps", **kw)
    all_years_job(spark, range(2000, 2004), output_path=f"{tmp_dir}/whole", **kw)
    steps, whole = spark.read.parquet(f"{tmp_dir}/steps"), spark.read.parquet(f"{tmp_dir}/whole")
    assert _rows(steps) == _rows(whole.select(*steps.columns)) and steps.count() > 0
    for r in steps.where("rfrnc_yr = 2003").collect():
        for c in MICRO_BOOK:
            assert (r[c], r[f"{c}_ever"]) == MICRO_EXPECTED[r.bene_id][c]


def test_fixture_frames_are_accepted(spark, tmp_dir):
    ev, en = frames(spark, MICRO_ADM, MICRO_BENE)
    cb = read_codebook(spark, MICRO_BOOK)
    update_state(spark, tmp_dir, ev, en, cb, range(2000, 2004), 2000)
    assert _rows(state_grid(spark, tmp_dir, en, cb, [2003], 2000)) == _rows(feature_grid(ev, en, cb, [2003], 2000))

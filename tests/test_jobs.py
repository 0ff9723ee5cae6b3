"""The job entry points on yearly files written from the micro-fixture."""

import json

from fixtures import MICRO_ADM, MICRO_BENE, MICRO_BOOK, MICRO_EXPECTED
from pyspark.sql import functions as F

from lookback.plans.jobs import all_years_job, condition_year_job, merge_year_job
from lookback.schemas import ENROLMENT, EVENTS


def _write_inputs(spark, root):
    for y in range(2000, 2004):
        adm = [(b, d, arr) for b, d, fy, arr in MICRO_ADM if fy == y]
        bene = [(b, yy, h) for b, yy, h in MICRO_BENE if yy == y]
        spark.createDataFrame(adm, EVENTS).write.parquet(f"{root}/adm_{y}.parquet")
        spark.createDataFrame(bene, ENROLMENT).write.parquet(f"{root}/bene_{y}.parquet")
    with open(f"{root}/ccw.json", "w") as f:
        json.dump(MICRO_BOOK, f)


def test_jobs_on_yearly_files(spark, tmp_dir):
    _write_inputs(spark, tmp_dir)
    kw = dict(ccw_json=f"{tmp_dir}/ccw.json", dw_bene_prefix=f"{tmp_dir}/bene",
              dw_adm_prefix=f"{tmp_dir}/adm", first_year=2000)
    for c in MICRO_BOOK:
        condition_year_job(spark, 2003, c, output_prefix=f"{tmp_dir}/prev", **kw)
    path = merge_year_job(spark, 2003, f"{tmp_dir}/prev", f"{tmp_dir}/out", f"{tmp_dir}/ccw.json")
    merged = spark.read.parquet(path)
    assert merged.columns == ["bene_id", "X", "X_ever", "F", "F_ever", "P", "P_ever", "A", "A_ever",
                              "rfrnc_yr"]
    for r in merged.collect():
        for c in MICRO_BOOK:
            assert (r[c], r[f"{c}_ever"]) == MICRO_EXPECTED[r.bene_id][c]
    whole = all_years_job(spark, [2002, 2003], output_path=f"{tmp_dir}/all", **kw)
    back = spark.read.parquet(f"{tmp_dir}/all").where(F.col("rfrnc_yr") == 2003)
    key = ["bene_id"] + [x for c in MICRO_BOOK for x in (c, f"{c}_ever")]
    assert sorted(map(tuple, back.select(*key).collect())) == sorted(map(tuple, merged.select(*key).collect()))
    assert whole.where(F.col("rfrnc_yr") == 2002).count() == 2

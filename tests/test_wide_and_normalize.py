"""More than 62 conditions (several mask columns) and code normalisation."""

import datetime as dt
import os

import pytest
from conftest import SMOKE_DIR
from fixtures import frames, rows_of
from pyspark.sql import functions as F

from lookback.catalog import F0, _views
from lookback.plans.grid import feature_grid_long
from lookback.plans.pair import condition_feature
from lookback.sources.codebook import read_codebook
from lookback.sources.demo import wide_codebook


@pytest.mark.skipif(not os.path.isdir(SMOKE_DIR), reason="no driver test data")
def test_seventy_conditions_match_pairs(spark):
    ev, en = _views(spark, SMOKE_DIR)
    cb = read_codebook(spark, wide_codebook(70))
    grid = feature_grid_long(ev, en, cb, [1999], F0).cache()
    for cond in ["k01", "k62", "k63", "k64", "k70"]:
        got = rows_of(tuple(r) for r in grid.where(F.col("condition") == cond)
                      .select("bene_id", "rfrnc_yr", "status", "ever").collect())
        want = rows_of(tuple(r) for r in condition_feature(ev, en, cb, cond, 1999, F0).collect())
        assert got == want, cond
    grid.unpersist()


def test_normalised_codes_match_dotted_and_lower_case(spark):
    adm = [("b1", dt.date(2003, 1, 1), 2003, ["i21.01"]), ("b2", dt.date(2003, 1, 1), 2003, ["I2101"]),
           ("b3", dt.date(2003, 1, 1), 2003, ["I21.02"])]
    bene = [("b1", 2003, 0), ("b2", 2003, 0), ("b3", 2003, 0)]
    ev, en = frames(spark, adm, bene)
    book = {"A": {"ref_period": 1, "icd9": [], "icd10": ["I21.01"]}}
    plain = read_codebook(spark, book)
    norm = read_codebook(spark, book, normalize=True)
    assert {r.bene_id: r.A for r in condition_feature(ev, en, plain, "A", 2003, 2000).collect()} == \
        {"b1": 2, "b2": 2, "b3": 2}
    assert {r.bene_id: r.A for r in condition_feature(ev, en, norm, "A", 2003, 2000).collect()} == \
        {"b1": 3, "b2": 3, "b3": 2}
    assert {r.bene_id: r.status for r in feature_grid_long(ev, en, norm, [2003], 2000).collect()} == \
        {"b1": 3, "b2": 3, "b3": 2}

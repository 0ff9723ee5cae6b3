import datetime as dt

import pytest
from fixtures import MICRO_ADM, MICRO_BENE, MICRO_BOOK, frames
from pyspark.sql import functions as F

from lookback.functions.codes import code_at, overlaps, status_code
from lookback.operators.matching import match_codes, unnest_codes
from lookback.operators.stats import (event_stats, member_count, member_flag, observe_counts,
                                      peek, step_counts, unique_count)
from lookback.plans.matrix import merge_chain
from lookback.plans.pair import condition_feature
from lookback.sources.codebook import read_codebook
from lookback.sources.sinks import read_features, write_features


@pytest.fixture(scope="module")
def micro(spark):
    ev, en = frames(spark, MICRO_ADM, MICRO_BENE)
    return ev, en, read_codebook(spark, MICRO_BOOK)


def test_status_code_table_and_null(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (1, 1), (0, None), (1, None)],
                               "m int, c int")
    assert [r.s for r in df.select(status_code("m", "c").alias("s")).collect()] == [0, 1, 2, 3, 3, 3]


def test_overlaps_and_code_at(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,), (["c", None],), (["a", None],)],
                               "d array<string>")
    got = [r.o for r in df.select(overlaps("d", ["a", "x"]).alias("o")).collect()]
    assert got == [True, False, None, None, True]
    assert df.where(overlaps("d", ["a"])).count() == 2
    got = [(r.p1, r.p3) for r in df.select(code_at("d", 1).alias("p1"), code_at("d", 3).alias("p3")).collect()]
    assert got == [("a", None), (None, None), (None, None), ("c", None), ("a", None)]


def test_unnest_keeps_null_elements_drops_null_and_empty(micro, spark):
    ev = spark.createDataFrame([("b", dt.date(2000, 1, 1), 2000, ["x", None]),
                                ("c", dt.date(2000, 1, 1), 2000, None),
                                ("d", dt.date(2000, 1, 1), 2000, [])],
                               "bene_id string, admission_date date, file_year int, diagnoses array<string>")
    assert [(r.pos, r.code) for r in unnest_codes(ev).collect()] == [(0, "x"), (1, None)]


def test_rules_nest_primary_first_two_all(micro):
    ev, _, cb = micro
    sets = {rule: {tuple(r) for r in match_codes(ev, cb, "P", criteria=rule).collect()}
            for rule in ("primary", "first_two", "all")}
    assert sets["primary"] <= sets["first_two"] <= sets["all"]
    assert len(sets["primary"]) < len(sets["first_two"]) < len(sets["all"])


def test_event_stats_and_counts(micro, spark):
    ev, en, cb = micro
    st = {r.bene_id: (r.min_adm_date, r.max_adm_date, r.n)
          for r in event_stats(ev, cb, "P", [2002, 2003]).collect()}
    assert st == {"b2": (dt.date(2002, 5, 5),) * 2 + (1,), "b3": (dt.date(2003, 7, 7),) * 2 + (1,),
                  "b7": (dt.date(2003, 9, 9),) * 2 + (1,)}
    ids = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "bene_id string")
    assert unique_count(ids).first().n_unique == 3
    flag = {r.bene_id: r.flag for r in member_flag(ids.distinct(), spark.createDataFrame(
        [(None,), ("b",)], "bene_id string")).collect()}
    assert flag == {"a": 0, None: 1, "b": 1}
    assert member_count(ids, spark.createDataFrame([("a",)], "bene_id string")).first().n == 2
    df, obs = observe_counts(ids, "ids")
    df.collect()
    assert obs.get["rows"] == 4
    sc = {r.step: (r.n_rows, r.n_cols) for r in step_counts([("ids", ids), ("ev", ev)]).collect()}
    assert sc == {"ids": (4, 1), "ev": (9, 4)}


def test_peek_is_deterministic(micro):
    ev, _, _ = micro
    a = [tuple(r) for r in peek(ev.select("bene_id", "file_year"), 3, seed=7).collect()]
    b = [tuple(r) for r in peek(ev.select("bene_id", "file_year"), 3, seed=7).collect()]
    assert a == b and len(a) == 3
    assert [r.bene_id for r in peek(ev, 2, order_by=["bene_id"]).collect()] == ["b1", "b2"]
    with pytest.raises(ValueError):
        peek(ev, 1)


def test_merge_chain_equals_inner_join_chain(micro):
    ev, en, cb = micro
    frames_ = [(c, condition_feature(ev, en, cb, c, 2003, 2000)) for c in cb.names]
    m = merge_chain(frames_, 2003)
    chain = frames_[0][1].select("bene_id", "A", "A_ever")
    for c, df in frames_[1:]:
        chain = df.select("bene_id", c, f"{c}_ever").join(chain, "bene_id", "inner")
    chain = chain.withColumn("rfrnc_yr", F.lit(2003))
    assert m.columns == chain.columns
    assert sorted(map(tuple, m.collect()), key=repr) == sorted(map(tuple, chain.collect()), key=repr)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "arrow"])
def test_sinks_round_trip(micro, tmp_dir, fmt, spark):
    ev, en, cb = micro
    df = condition_feature(ev, en, cb, "A", 2003, 2000).withColumnRenamed("A", "A_status")
    path = f"{tmp_dir}/out_{fmt}"
    write_features(df, path, fmt=fmt, partition_by=("rfrnc_yr",) if fmt != "arrow" else ())
    back = read_features(spark, path, fmt=fmt, schema=df.schema if fmt == "csv" else None)
    got = sorted((r.bene_id, int(r.A_status), r.A_ever, int(r.rfrnc_yr)) for r in back.collect())
    want = sorted((r.bene_id, r.A_status, r.A_ever, r.rfrnc_yr) for r in df.collect())
    assert got == want
    if fmt == "arrow":  # a rewrite with fewer partitions replaces every earlier file
        write_features(df.repartition(6), path, fmt=fmt)
        write_features(df.coalesce(1), path, fmt=fmt)
        assert read_features(spark, path, fmt=fmt).count() == df.count()

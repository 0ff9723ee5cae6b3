"""Edge cases: duplicates and NULLs in merges, sinks and their modes, types that differ by year,
empty inputs, NULL ids in exclusion sets, hot codes and hot ids."""

import datetime as dt
import itertools
import os

import pytest
from fixtures import ADM_SCHEMA, MICRO_BENE, MICRO_BOOK, frames
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookback.operators.met import met
from lookback.operators.stats import unique_count
from lookback.plans.grid import feature_grid, feature_grid_long
from lookback.plans.jobs import condition_year_job, merge_year_job
from lookback.plans.matrix import feature_matrix, merge_chain
from lookback.plans.pair import condition_feature
from lookback.schemas import EVENTS
from lookback.sources.code_text import parse_code_text
from lookback.sources.codebook import read_codebook
from lookback.sources.jdbc import jdbc_reader
from lookback.sources.sinks import feature_schema, read_features, write_features
from lookback.sources.yearly import read_years

D = dt.date
COND = "bene_id string, {0} int, {0}_ever date"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_merge_raises_on_conflicting_rows(spark):
    a = spark.createDataFrame([("b1", 0, None), ("b1", 3, None)], COND.format("A"))
    b = spark.createDataFrame([("b1", 2, None)], COND.format("B"))
    with pytest.raises(Exception, match="different rows of A for id b1"):
        merge_chain([("A", a), ("B", b)], 2003).collect()
    dates = spark.createDataFrame([("b1", 0, D(2003, 1, 1)), ("b1", 0, None)], COND.format("A"))
    with pytest.raises(Exception, match="different rows of A"):
        merge_chain([("A", dates), ("B", b)], 2003).collect()


def test_merge_keeps_equal_duplicates_and_null_status(spark):
    a = spark.createDataFrame([("b1", 1, None), ("b1", 1, None), ("b2", None, None), (None, 1, None)], COND.format("A"))
    b = spark.createDataFrame([("b1", 2, D(2003, 1, 1)), ("b2", 0, None), ("b3", 0, None)], COND.format("B"))
    got = _rows(merge_chain([("A", a), ("B", b)], 2003))
    assert got == [("b1", 2, D(2003, 1, 1), 1, None, 2003)] * 2 + [("b2", 0, None, None, None, 2003)]


def test_fractional_months_break_coverage(spark):
    ev = spark.createDataFrame([("b1", D(2003, 3, 1), 2003, ["410.01"])], ADM_SCHEMA)
    for kind, months in (("double", 0.5), ("decimal(4,2)", 0.5)):
        en = spark.createDataFrame([("b1", 2003, months)], "bene_id string, year int, hmo_mo double").withColumn(
            "hmo_mo", F.col("hmo_mo").cast(kind)).withColumn("file_year", F.col("year"))
        book = read_codebook(spark, {"A": MICRO_BOOK["A"]})
        pair = condition_feature(ev, en, book, "A", 2003, 2000).first()["A"]
        grid = feature_grid(ev, en, book, [2003], 2000).first()["A"]
        assert pair == grid == 1


def test_matrix_takes_the_year_of_the_file(spark):
    ev = spark.createDataFrame([("b1", D(2003, 3, 1), 2003, ["410.01"])], ADM_SCHEMA)
    en = spark.createDataFrame([("b1", 2002, 0, 2003)], "bene_id string, year int, hmo_mo int, file_year int")
    book = read_codebook(spark, {"A": MICRO_BOOK["A"]})
    assert feature_matrix(ev, en, book, [2003], 2000).first()["rfrnc_yr"] == 2003
    pair = condition_feature(ev, en, book, "A", 2003, 2000)
    assert pair.first()["rfrnc_yr"] == 2002
    assert merge_chain([("A", pair)], 2003).first()["rfrnc_yr"] == 2003
    assert feature_grid_long(ev, en, book, [2003], 2000).first()["rfrnc_yr"] == 2002


def test_null_id_in_the_exclusion_set(spark):
    adm = [("b4", D(2003, 1, 1), 2003, ["331.0"]), (None, D(2001, 1, 1), 2001, ["S06.1"]), (None, D(2003, 1, 1), 2003, ["331.0"])]
    ev, en = frames(spark, adm, [("b4", 2003, 0), (None, 2003, 0)])
    book = read_codebook(spark, {"X": MICRO_BOOK["X"]})
    assert met(ev, book, "X", 2003, 2000).count() == 0
    assert {r["X"] for r in feature_grid(ev, en, book, [2003], 2000).collect()} == {2}
    # without it the NULL id meets the rule
    ev2, _ = frames(spark, [adm[0], adm[2]], [("b4", 2003, 0)])
    assert {r.bene_id for r in met(ev2, book, "X", 2003, 2000).collect()} == {"b4", None}
    assert {r["X"] for r in feature_grid(ev2, en, book, [2003], 2000).collect()} == {3}


def test_unique_count_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], "bene_id string")
    assert unique_count(empty).first().n_unique == 0
    assert unique_count(spark.createDataFrame([(None,)], "bene_id string")).first().n_unique == 1


def test_code_text_strips_all_white_space(spark):
    df = spark.createDataFrame([("\xa0410.01\x1f, I21 A1　,\xa0 , \x85x﻿",)], "text string")
    got = [r.code for r in parse_code_text(df).orderBy("code_pos").collect()]
    assert got == [x.strip() for x in "\xa0410.01\x1f, I21 A1　,\xa0 , \x85x﻿".split(",") if x.strip()]


def test_csv_keeps_ids_and_types(spark, tmp_dir):
    df = spark.createDataFrame([("00123", 2003, 1, None)], "bene_id string, rfrnc_yr int, A int, A_ever date")
    write_features(df, f"{tmp_dir}/x", fmt="csv", partition_by=())
    back = read_features(spark, f"{tmp_dir}/x", fmt="csv", schema=df.schema)
    assert back.schema["A_ever"].dataType == T.DateType() and _rows(back) == [("00123", 2003, 1, None)]
    assert read_features(spark, f"{tmp_dir}/x", fmt="csv").first()["bene_id"] == "00123"
    assert feature_schema(["A"]).fieldNames() == ["bene_id", "A", "A_ever", "rfrnc_yr"]


def test_csv_jobs_keep_leading_zeros(spark, tmp_dir):
    import json
    spark.createDataFrame([("007", D(2003, 1, 1), ["410.01"])], EVENTS).write.parquet(f"{tmp_dir}/adm_2003.parquet")
    spark.createDataFrame([("007", 2003, 0)], "bene_id string, year int, hmo_mo int").write.parquet(f"{tmp_dir}/bene_2003.parquet")
    book = {"A": MICRO_BOOK["A"], "P": dict(MICRO_BOOK["P"], ref_period=1)}
    with open(f"{tmp_dir}/ccw.json", "w") as f:
        json.dump(book, f)
    for c in book:
        condition_year_job(spark, 2003, c, f"{tmp_dir}/ccw.json", f"{tmp_dir}/bene", f"{tmp_dir}/adm", f"{tmp_dir}/prev", "csv", 2003)
    path = merge_year_job(spark, 2003, f"{tmp_dir}/prev", f"{tmp_dir}/out", f"{tmp_dir}/ccw.json", "csv")
    row = read_features(spark, path, fmt="csv").first()
    assert (row["bene_id"], row["A"], row["A_ever"], row["P"]) == ("007", "3", "2003-01-01", "2")


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_arrow_modes(spark, tmp_dir, scheme):
    path = f"{scheme}{tmp_dir}/out"
    one = spark.createDataFrame([("a", 1)], "id string, n int")
    two = spark.createDataFrame([("b", 2)], "id string, n int")
    write_features(one, path, fmt="arrow", mode="append")
    write_features(two, path, fmt="arrow", mode="append")
    assert _rows(read_features(spark, path, fmt="arrow")) == [("a", 1), ("b", 2)]
    with pytest.raises(ValueError):
        write_features(one, path, fmt="arrow", mode="error")
    write_features(one, path, fmt="arrow", mode="ignore")
    with pytest.raises(ValueError):
        write_features(one, path, fmt="arrow", partition_by=("n",))
    with pytest.raises(ValueError):
        write_features(one, path, fmt="arrow", mode="upsert")
    bad = spark.range(4).select(F.when(F.col("id") == 3, F.raise_error(F.lit("no"))).otherwise("x").alias("id"), F.lit(1).alias("n"))
    with pytest.raises(Exception, match="no"):
        write_features(bad, path, fmt="arrow", mode="overwrite")
    assert _rows(read_features(spark, path, fmt="arrow")) == [("a", 1), ("b", 2)]  # the old output is still there
    assert not [x for x in os.listdir(f"{tmp_dir}/out") if x.startswith("_run")]
    write_features(two.repartition(3), path, fmt="arrow", mode="overwrite")
    assert _rows(read_features(spark, path, fmt="arrow")) == [("b", 2)]


def test_parquet_output_has_few_files_per_year(spark, tmp_dir):
    df = spark.range(1000).select(F.col("id").cast("string").alias("bene_id"), (F.col("id") % 5).cast("int").alias("rfrnc_yr"))
    write_features(df.repartition(8), f"{tmp_dir}/p")
    for year in range(5):
        assert len([x for x in os.listdir(f"{tmp_dir}/p/rfrnc_yr={year}") if x.endswith(".parquet")]) == 1


@pytest.mark.parametrize("order", list(itertools.permutations(["int", "bigint", "double"])))
def test_yearly_files_may_differ_in_types(spark, tmp_dir, order):
    for year, kind in zip((2001, 2002, 2003), order):
        (spark.createDataFrame([("b1", year, year - 2000)], "bene_id string, year int, hmo_mo int")
         .withColumn("hmo_mo", F.col("hmo_mo").cast(kind)).write.parquet(f"{tmp_dir}/bene_{year}.parquet"))
    df = read_years(spark, f"{tmp_dir}/bene", [2001, 2002, 2003])
    assert df.schema["hmo_mo"].dataType == T.DoubleType()
    assert sorted((r.file_year, r.hmo_mo) for r in df.collect()) == [(2001, 1.0), (2002, 2.0), (2003, 3.0)]
    fixed = read_years(spark, f"{tmp_dir}/bene", [2001, 2002, 2003], T.StructType([
        T.StructField("bene_id", T.StringType()), T.StructField("year", T.IntegerType()), T.StructField("hmo_mo", T.LongType())]))
    assert sorted((r.file_year, r.hmo_mo) for r in fixed.collect()) == [(2001, 1), (2002, 2), (2003, 3)]


def test_jdbc_read_can_be_split():
    class Reader(dict):
        def format(self, name):
            return self

        def option(self, k, v):
            self[k] = v
            return self

    class Session:
        @property
        def read(self):
            return Reader()

    got = jdbc_reader(Session(), "jdbc:x", "SELECT id FROM t", partition_column="id", lower_bound=0, upper_bound=100, num_partitions=8)
    assert got["dbtable"] == "(SELECT id FROM t) q" and "query" not in got
    assert (got["partitionColumn"], got["lowerBound"], got["upperBound"], got["numPartitions"]) == ("id", "0", "100", "8")
    with pytest.raises(ValueError):
        jdbc_reader(Session(), "jdbc:x", "SELECT 1", partition_column="id")


def test_shuffled_code_table_and_a_hot_code(spark):
    """Half of all rows carry one code; the shuffle join gives what the broadcast gives."""
    adm = [(f"b{i % 50}", D(2003, 1, 1 + i % 28), 2003, ["410.01" if i % 2 else f"V{i}", "250.00"]) for i in range(2000)]
    ev, en = frames(spark, adm, [(f"b{i}", 2003, i % 3) for i in range(50)])
    small = read_codebook(spark, MICRO_BOOK)
    large = read_codebook(spark, MICRO_BOOK, broadcast_bytes=0)
    assert small.n_bytes > 0
    for c in MICRO_BOOK:
        assert _rows(condition_feature(ev, en, small, c, 2003, 2000)) == _rows(condition_feature(ev, en, large, c, 2003, 2000))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = feature_grid(ev, en, large, [2003], 2000)
        assert "BroadcastHashJoin [code" not in df._jdf.queryExecution().executedPlan().toString()
        assert _rows(df) == _rows(feature_grid(ev, en, small, [2003], 2000))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_hot_repeated_enrolment_row(spark):
    """A third of the enrolment rows repeat one (id, year): each gets its row, with equal features."""
    bene = [(f"b{i}", 2003, 0) for i in range(200)] + [("b7", 2003, 0)] * 100
    ev, en = frames(spark, [("b7", D(2003, 9, 9), 2003, ["250.00"])], bene)
    book = read_codebook(spark, MICRO_BOOK)
    got = [r for r in feature_grid(ev, en, book, [2003], 2000).collect() if r.bene_id == "b7"]
    assert len(got) == 101 and {(r["P"], r["P_ever"]) for r in got} == {(3, D(2003, 9, 9))}
    assert feature_grid(ev, en, book, [2003], 2000).count() == 300


def test_first_two_on_arrays_reads_two_elements(spark):
    from lookback.operators.matching import match_codes
    ev, _ = frames(spark, [("a", D(2003, 1, 1), 2003, ["x", "250.00"]), ("b", D(2003, 1, 1), 2003, ["x", "y", "250.00"]),
                           ("c", D(2003, 1, 1), 2003, None), ("d", D(2003, 1, 1), 2003, ["250.00"])], MICRO_BENE)
    book = read_codebook(spark, MICRO_BOOK)
    df = match_codes(ev, book, "F")
    assert {r.bene_id for r in df.collect()} == {"a", "d"}
    assert {r.bene_id for r in match_codes(ev, book, "P").collect()} == {"d"}
    assert "posexplode(diagnoses" not in df._jdf.queryExecution().toString()

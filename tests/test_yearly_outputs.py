"""Yearly outputs are replaced year by year; yearly inputs may differ in columns and types."""

import datetime as dt
import itertools
import json
from decimal import Decimal

import pytest
from fixtures import MICRO_ADM, MICRO_BENE, MICRO_BOOK
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookback.plans.jobs import all_years_job
from lookback.schemas import ENROLMENT, EVENTS
from lookback.sources.sinks import feature_schema, read_features, write_features
from lookback.sources.yearly import common_schema, read_years

SCHEMA = "bene_id string, A int, A_ever date, rfrnc_yr int"


def _matrix(spark, *rows):
    return spark.createDataFrame([(b, a, dt.date(2000, 1, 1), y) for b, a, y in rows], SCHEMA)


def _back(spark, path, fmt):
    schema = feature_schema(["A"]) if fmt == "csv" else None
    df = spark.read.schema(schema).option("header", True).csv(path) if fmt == "csv" else read_features(spark, path)
    return sorted((r.bene_id, r.A, r.rfrnc_yr) for r in df.collect())


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_a_year_replaces_only_itself(spark, tmp_dir, fmt):
    path = f"{tmp_dir}/m"
    write_features(_matrix(spark, ("a", 0, 2015), ("b", 1, 2015)), path, fmt)
    write_features(_matrix(spark, ("a", 2, 2016)), path, fmt)
    assert _back(spark, path, fmt) == [("a", 0, 2015), ("a", 2, 2016), ("b", 1, 2015)]
    write_features(_matrix(spark, ("c", 3, 2015)), path, fmt)
    assert _back(spark, path, fmt) == [("a", 2, 2016), ("c", 3, 2015)]
    # a job that fails on its way leaves both years as they were
    bad = _matrix(spark, ("x", 9, 2015), ("y", 9, 2016)).withColumn(
        "A", F.when(F.col("bene_id") == "y", F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("A")))
    with pytest.raises(Exception, match="stop"):
        write_features(bad, path, fmt)
    assert _back(spark, path, fmt) == [("a", 2, 2016), ("c", 3, 2015)]
    # a year asked for that has no rows any more loses its old ones; "all" replaces everything
    write_features(_matrix(spark, ("d", 1, 2017)), path, fmt, replace=[2016, 2017, 2018])
    assert _back(spark, path, fmt) == [("c", 3, 2015), ("d", 1, 2017)]
    write_features(_matrix(spark).limit(0), path, fmt, replace=[2017])
    assert _back(spark, path, fmt) == [("c", 3, 2015)]
    write_features(_matrix(spark, ("e", 0, 2020)), path, fmt, replace="all")
    assert _back(spark, path, fmt) == [("e", 0, 2020)]


def _inputs(spark, root):
    for y in range(2000, 2004):
        spark.createDataFrame([(b, d, arr) for b, d, fy, arr in MICRO_ADM if fy == y], EVENTS).write.parquet(f"{root}/adm_{y}.parquet")
        spark.createDataFrame([(b, yy, h) for b, yy, h in MICRO_BENE if yy == y], ENROLMENT).write.parquet(f"{root}/bene_{y}.parquet")
    with open(f"{root}/ccw.json", "w") as f:
        json.dump(MICRO_BOOK, f)
    return dict(ccw_json=f"{root}/ccw.json", dw_bene_prefix=f"{root}/bene", dw_adm_prefix=f"{root}/adm", first_year=2000)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_the_whole_job_for_one_year_keeps_the_others(spark, tmp_dir, fmt):
    kw = _inputs(spark, tmp_dir)
    out = f"{tmp_dir}/{fmt}"
    all_years_job(spark, [2002, 2003], output_path=out, output_format=fmt, **kw)

    def rows():
        df = spark.read.option("header", True).csv(out) if fmt == "csv" else spark.read.parquet(out)
        return sorted(map(str, df.collect()))

    both = rows()
    all_years_job(spark, [2003], output_path=out, output_format=fmt, **kw)
    assert rows() == both and len({r.split("rfrnc_yr=")[1] for r in both}) == 2


def _files(spark, root, name, per_year):
    for y, (rows, schema) in per_year.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{root}/{name}_{y}.parquet")
    return f"{root}/{name}"


def test_columns_of_all_years_in_any_order(spark, tmp_dir):
    prefix = _files(spark, tmp_dir, "bene", {
        2000: ([("a", 2000)], "bene_id string, year int"),
        2001: ([("b", 2001, 5)], "bene_id string, year int, hmo_mo int"),
        2002: ([(7, "c", 2002)], "HMO_MO int, bene_id string, year int")})
    for years in itertools.permutations([2000, 2001, 2002]):
        df = read_years(spark, prefix, years)
        assert df.columns == ["bene_id", "year", "hmo_mo", "file_year"]
        assert sorted(map(tuple, df.collect())) == [("a", 2000, None, 2000), ("b", 2001, 5, 2001), ("c", 2002, 7, 2002)]


def test_no_id_is_widened_to_a_double(spark, tmp_dir):
    prefix = _files(spark, tmp_dir, "ids", {2000: ([(9007199254740993,)], "bene_id bigint"), 2001: ([(1.0,)], "bene_id double")})
    for years in ([2000, 2001], [2001, 2000]):
        with pytest.raises(ValueError, match="bene_id"):
            read_years(spark, prefix, years)
    # asked for, the cast is the caller's; integer ids of different widths have a common type
    given = read_years(spark, prefix, [2000, 2001], T.StructType([T.StructField("bene_id", T.DecimalType(20, 0))]))
    assert sorted(r.bene_id for r in given.collect()) == [Decimal(1), Decimal(9007199254740993)]
    prefix = _files(spark, tmp_dir, "wide", {2000: ([(1,)], "bene_id int"), 2001: ([(1 << 60,)], "bene_id bigint")})
    assert sorted(r.bene_id for r in read_years(spark, prefix, [2001, 2000]).collect()) == [1, 1 << 60]


def test_values_that_a_double_cannot_hold_raise(spark, tmp_dir):
    prefix = _files(spark, tmp_dir, "mo", {2000: ([("a", 12), ("n", None)], "bene_id string, hmo_mo bigint"),
                                           2001: ([("b", 0.5)], "bene_id string, hmo_mo double")})
    assert sorted((r.bene_id, r.hmo_mo) for r in read_years(spark, prefix, [2001, 2000]).collect()) == [("a", 12.0), ("b", 0.5), ("n", None)]
    prefix = _files(spark, tmp_dir, "mo2", {2000: ([("a", (1 << 53) + 1)], "bene_id string, hmo_mo bigint"),
                                            2001: ([("b", 0.5)], "bene_id string, hmo_mo double")})
    df = read_years(spark, prefix, [2000, 2001])
    assert df.where("file_year = 2001").count() == 1
    with pytest.raises(Exception, match="a double can't hold"):
        df.collect()


def test_lattice_of_types():
    s = lambda kind: T.StructType([T.StructField("x", kind)])
    dec = T.DecimalType
    for a, b, want in [(T.ByteType(), T.LongType(), T.LongType()), (T.FloatType(), T.IntegerType(), T.DoubleType()),
                       (dec(10, 2), T.IntegerType(), dec(12, 2)), (dec(10, 2), dec(8, 4), dec(12, 4)), (T.NullType(), T.StringType(), T.StringType()),
                       (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()),
                       (T.ArrayType(T.IntegerType(), False), T.ArrayType(T.LongType()), T.ArrayType(T.LongType(), True))]:
        for x, y in ((a, b), (b, a)):
            assert common_schema({2000: s(x), 2001: s(y)})["x"].dataType == want
    for a, b in [(T.StringType(), T.LongType()), (dec(38, 0), dec(38, 10)), (T.ArrayType(T.LongType()), T.ArrayType(T.DoubleType())),
                 (T.TimestampType(), T.TimestampNTZType())]:
        with pytest.raises(ValueError, match="'x'"):
            common_schema({2000: s(a), 2001: s(b)})
    # the common type of three years doesn't depend on which two are seen first
    kinds = [T.IntegerType(), dec(10, 2), T.LongType()]
    assert {common_schema(dict(zip((2000, 2001, 2002), map(s, p))))["x"].dataType for p in itertools.permutations(kinds)} == {dec(21, 2)}


def test_jobs_check_their_inputs(spark, tmp_dir):
    kw = _inputs(spark, tmp_dir)
    spark.createDataFrame([("a", "text", 1)], "bene_id string, year string, hmo_mo int").write.mode("overwrite").parquet(f"{tmp_dir}/bene_2003.parquet")
    with pytest.raises(ValueError, match="'year'"):
        all_years_job(spark, [2003], output_path=f"{tmp_dir}/x", **kw)

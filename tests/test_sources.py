import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lookback.schemas import ENROLMENT, EVENTS, check_schema
from lookback.sources.code_text import parse_code_text
from lookback.sources.codebook import read_codebook
from lookback.sources.jdbc import jdbc_reader, overlap_query
from lookback.sources.yearly import (history_years, read_partitioned, read_year, read_years,
                                     union_years, window_years, year_paths)


def test_year_lists():
    assert window_years(2003, 3, 2000) == [2003, 2002, 2001]
    assert window_years(2001, 3, 2000) == [2001, 2000]
    assert history_years(2002, 2000) == [2000, 2001, 2002]
    with pytest.raises(ValueError):
        window_years(1999, 2, 2000)
    with pytest.raises(ValueError):
        window_years(2003, 0, 2000)
    assert year_paths("/d/adm", [2001]) == ["/d/adm_2001.parquet"]


def test_read_years_adds_file_year_from_path(spark, tmp_dir):
    rows = [("b1", dt.date(2004, 1, 1), ["x"])]  # the date's year is not the file's
    for y in (2001, 2002, 2003):
        spark.createDataFrame(rows, EVENTS).write.parquet(f"{tmp_dir}/adm_{y}.parquet")
    df = read_years(spark, f"{tmp_dir}/adm", [2003, 2001], schema=EVENTS)
    assert sorted(r.file_year for r in df.collect()) == [2001, 2003]
    assert read_year(spark, f"{tmp_dir}/adm", 2002).select("file_year").first()[0] == 2002
    u = union_years([read_year(spark, f"{tmp_dir}/adm", y) for y in (2001, 2001)])
    assert u.count() == 2  # UNION ALL keeps duplicates
    with pytest.raises(Exception):
        read_years(spark, f"{tmp_dir}/adm", [1999]).count()  # missing year file is an error


def test_read_partitioned_prunes(spark, tmp_dir):
    df = spark.createDataFrame([("b1", 2001, 0, 2001), ("b2", 2002, 1, 2002)],
                               "bene_id string, year int, hmo_mo int, file_year int")
    df.write.partitionBy("file_year").parquet(f"{tmp_dir}/bene")
    got = read_partitioned(spark, f"{tmp_dir}/bene", [2002])
    assert [r.bene_id for r in got.collect()] == ["b2"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "file_year" in plan


def test_check_schema(spark):
    ev = spark.createDataFrame([("b", dt.date(2000, 1, 1), ["a"])], EVENTS)
    assert check_schema(ev, "events") is ev
    assert check_schema(ev, EVENTS) is ev
    with pytest.raises(ValueError):
        check_schema(ev.drop("diagnoses"), "events")
    long = ev.select("bene_id", "admission_date", F.posexplode("diagnoses").alias("pos", "code"))
    assert check_schema(long, "events") is long
    with pytest.raises(ValueError):
        check_schema(long.drop("code"), "events")
    en = spark.createDataFrame([("b", 2000, 1)], ENROLMENT)
    check_schema(en, "enrolment")
    with pytest.raises(ValueError):
        check_schema(en.withColumn("year", F.lit("x")), "enrolment")


def test_codebook_order_defaults_and_file(spark, tmp_dir):
    book = {"zz": {"ref_period": 2, "icd9": ["1", "2"], "icd10": ["2"]},
            "aa": {"ref_period": 1, "claims_criteria": "primary", "icd9": [], "icd10": ["3"]}}
    path = f"{tmp_dir}/ccw.json"
    with open(path, "w") as f:
        json.dump(book, f, indent=2)
    cb = read_codebook(spark, path)
    assert cb.names == ["zz", "aa"]                       # key order kept
    assert cb.spec("zz").criteria == "all"                # default rule
    assert cb.spec("zz").n_include == 2                   # duplicate code counted once
    assert sorted(r.code for r in cb.include_codes("zz").collect()) == ["1", "2"]
    assert cb.select(["aa"]).names == ["aa"]
    norm = read_codebook(spark, {"n": {"ref_period": 1, "icd9": ["410.01"], "icd10": ["i21.a1"]}},
                         normalize=True)
    assert sorted(r.code for r in norm.codes.collect()) == ["41001", "I21A1"]
    # two codebook files under one path would double every condition
    import os
    os.makedirs(f"{tmp_dir}/books")
    for i in range(2):
        with open(f"{tmp_dir}/books/ccw{i}.json", "w") as f:
            json.dump(book, f)
    with pytest.raises(ValueError):
        read_codebook(spark, f"{tmp_dir}/books")


def test_parse_code_text(spark):
    text = "\n410.01, 410.11,410.21 ,\n I21.A1,\t, I22.9   \n"
    df = spark.createDataFrame([("ami", "icd9", text)], "condition string, version string, text string")
    got = [(r.code_pos, r.code) for r in parse_code_text(df).orderBy("code_pos").collect()]
    assert got == [(0, "410.01"), (1, "410.11"), (2, "410.21"), (3, "I21.A1"), (5, "I22.9")]
    assert parse_code_text(df).columns == ["condition", "version", "code_pos", "code"]


def test_jdbc_options_only(spark):
    q = overlap_query("claims.events", "bene_id", "diagnoses", ["331.0", "O'1"], limit=10)
    assert q == ("SELECT bene_id, diagnoses FROM claims.events WHERE diagnoses && "
                 "ARRAY['331.0','O''1'] LIMIT 10")
    with pytest.raises(ValueError):
        overlap_query("t", "i", "a", [])
    reader = jdbc_reader(spark, "jdbc:postgresql://db.invalid:5432/x", q, user="u", password="p")
    assert reader is not None  # nothing is opened until load()


def test_file_year_filter_skips_files(spark, tmp_dir):
    rows = [("b1", dt.date(2004, 1, 1), ["x"])]
    for y in (2001, 2002, 2003):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.parquet(f"{tmp_dir}/adm_{y}.parquet")
    df = read_years(spark, f"{tmp_dir}/adm", [2001, 2002, 2003]).where(F.col("file_year") == 2002)
    assert df.count() == 1
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scans = []

    def walk(p):
        if "Scan" in p.nodeName() and p.metrics().contains("numFiles"):
            scans.append(p.metrics().apply("numFiles").value())
        it = p.children().iterator()
        while it.hasNext():
            walk(it.next())
    walk(plan)
    assert scans == [1]  # the other years' files are never opened

"""Hand-worked micro-fixture (reference year 2003, first year 2000) and helpers."""

from __future__ import annotations

import datetime as dt

import pandas as pd

from lookback.oracle import PX

D = dt.date

# The micro-fixture codebook.
MICRO_BOOK = {
    "A": {"ref_period": 1, "icd9": ["410.01"], "icd10": ["I21.01"]},
    "P": {"ref_period": 2, "claims_criteria": "primary", "icd9": ["250.00"], "icd10": []},
    "F": {"ref_period": 2, "claims_criteria": "first_two", "icd9": ["250.00"], "icd10": []},
    "X": {"ref_period": 3, "icd9": ["331.0"], "icd10": [],
          "icd9_exclusion": ["431.1"], "icd10_exclusion": ["S06.1", "S06.2"]},
}

MICRO_ADM = [
    ("b1", D(2003, 3, 1), 2003, ["V58.0", "410.01"]),
    ("b2", D(2002, 5, 5), 2002, ["410.01", "250.00"]),
    ("b3", D(2003, 7, 7), 2003, ["V1", "V2", "250.00"]),
    ("b4", D(2003, 1, 1), 2003, ["331.0"]),
    ("b4", D(2001, 1, 1), 2001, ["S06.2"]),
    ("b5", D(2003, 1, 1), 2003, ["331.0", "S06.1"]),
    ("b6", D(2003, 2, 2), 2003, None),
    ("b6", D(2000, 2, 2), 2000, []),
    ("b7", D(2003, 9, 9), 2003, ["250.00"]),
]

MICRO_BENE = [
    ("b1", 2003, 0), ("b2", 2003, 0), ("b2", 2002, 5), ("b3", 2003, 0), ("b3", 2002, None),
    ("b4", 2003, 0), ("b5", 2003, 12), ("b6", 2003, None), ("b7", 2003, 0),
]

# Expected (status, first date) per id and condition in 2003, exclusion scope oldest_year.
MICRO_EXPECTED = {
    "b1": {"A": (3, D(2003, 3, 1)), "P": (2, None), "F": (2, None), "X": (2, None)},
    "b2": {"A": (2, D(2002, 5, 5)), "P": (0, D(2002, 5, 5)), "F": (1, D(2002, 5, 5)), "X": (0, None)},
    "b3": {"A": (2, None), "P": (2, D(2003, 7, 7)), "F": (2, D(2003, 7, 7)), "X": (2, None)},
    "b4": {"A": (2, None), "P": (2, None), "F": (2, None), "X": (2, D(2003, 1, 1))},
    "b5": {"A": (0, None), "P": (0, None), "F": (0, None), "X": (1, D(2003, 1, 1))},
    "b6": {"A": (0, None), "P": (0, None), "F": (0, None), "X": (0, None)},
    "b7": {"A": (2, None), "P": (3, D(2003, 9, 9)), "F": (3, D(2003, 9, 9)), "X": (2, None)},
}

ADM_SCHEMA = "bene_id string, admission_date date, file_year int, diagnoses array<string>"
BENE_SCHEMA = "bene_id string, year int, hmo_mo int"


def frames(spark, adm_rows, bene_rows):
    ev = spark.createDataFrame(adm_rows, ADM_SCHEMA)
    en = spark.createDataFrame(bene_rows, BENE_SCHEMA).withColumn("file_year", spark_col("year"))
    return ev, en


def spark_col(name):
    from pyspark.sql import functions as F
    return F.col(name)


def duck(adm_rows, bene_rows):
    """A DuckDB connection with tables adm, bene and view px over the rows."""
    import duckdb
    con = duckdb.connect()
    adm = pd.DataFrame(adm_rows, columns=["bene_id", "admission_date", "file_year", "diagnoses"])
    bene = pd.DataFrame(bene_rows, columns=["bene_id", "year", "hmo_mo"])
    con.register("adm_pd", adm)
    con.register("bene_pd", bene)
    con.execute("CREATE TABLE adm AS SELECT row_number() OVER () AS adm_id, "
                "CAST(bene_id AS VARCHAR) AS bene_id, "
                "CAST(admission_date AS DATE) AS admission_date, CAST(file_year AS INT) AS file_year, "
                "CAST(diagnoses AS VARCHAR[]) AS diagnoses FROM adm_pd")
    con.execute("CREATE TABLE bene AS SELECT CAST(bene_id AS VARCHAR) AS bene_id, "
                "CAST(year AS INT) AS year, CAST(hmo_mo AS INT) AS hmo_mo FROM bene_pd")
    body = PX.split(" AS (", 1)[1].rsplit(")", 1)[0]
    con.execute("CREATE VIEW px AS " + body)
    return con


def rows_of(df_or_rows):
    out = []
    for r in df_or_rows:
        out.append(tuple(None if (isinstance(v, float) and v != v) else v for v in r))
    return sorted(out, key=repr)

"""Merge of per-condition tables that are stored co-bucketed.

``write_bucketed`` saves a per-condition table in the session's warehouse, in as many
buckets by id as its fellows and sorted in each.  ``merge_bucketed`` then joins them bucket
against bucket: no table is shuffled, each task reads the same bucket of all
tables, and the merge of one year costs its scans and local sorts.

Rules are those of ``matrix.merge_chain``: ids present in every table, NULL ids never
match, a repeated id gives as many rows as the first table has of it, different
values of one id raise.  A bucket is one task, so the layout is for tables as the
jobs write them, a few rows per id; for an id with a large share of all
rows use ``merge_chain``, whose join is split by AQE.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lookback.plans.grid import _ident
from lookback.plans.matrix import _matrix_select


def write_bucketed(df: DataFrame, table: str, buckets: int | None = None, mode: str = "overwrite") -> str:
    """Save ``df`` as a table bucketed and sorted by ``bene_id``; returns the table's name.

    ``buckets`` is the number of shuffle partitions by default; tables to be merged need the same.
    """
    n = int(buckets or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, "bene_id").write.mode(mode).format("parquet")
     .bucketBy(n, "bene_id").sortBy("bene_id").saveAsTable(table))
    return table


def bucket_count(spark: SparkSession, table: str) -> int:
    """The table's number of buckets by ``bene_id`` (0 if it isn't bucketed so)."""
    facts = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if facts.get("Bucket Columns", "").strip("[]").replace("`", "") != "bene_id":
        return 0
    return int(facts["Num Buckets"])


def merge_bucketed(frames: Sequence[tuple[str, DataFrame]], ref_year: int) -> DataFrame:
    """The matrix of one year from tables ``(bene_id, {c}, {c}_ever)``, by sort-merge joins on the id.

    Any frames give the right rows; those of equally bucketed tables are joined without an exchange.
    """
    if not frames:
        raise ValueError("no condition tables to merge")
    merged = frames[0][1].select("bene_id").where(F.col("bene_id").isNotNull())
    for name, df in frames:
        merged = merged.join(_one_per_id(name, df).hint("merge"), "bene_id")
    return merged.withColumn("rfrnc_yr", F.lit(int(ref_year))).select(*_matrix_select([n for n, _ in frames]))


def _one_per_id(name: str, df: DataFrame) -> DataFrame:
    """One row per id; different values of one id raise."""
    value = F.struct(F.col(_ident(name)).cast("int").alias("status"), F.col(_ident(f"{name}_ever")).alias("ever"))
    one = df.where(F.col("bene_id").isNotNull()).groupBy("bene_id").agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    error = F.raise_error(F.concat(F.lit(f"merge: different rows of {name} for id "), F.col("bene_id").cast("string")))
    status = F.when(F.col("_lo").eqNullSafe(F.col("_hi")), F.col("_hi.status")).otherwise(error.cast("int"))
    return one.select("bene_id", status.alias(name), F.col("_hi.ever").alias(f"{name}_ever"))

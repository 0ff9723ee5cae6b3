"""Feature sinks and their read-back.

* Parquet: ``partitionBy("rfrnc_yr")`` by default, one folder per year; rows are
  rebalanced on the partition columns first, so a year is a few files of good
  size, not one file per task, and AQE splits a big year.  Overwriting replaces the
  years that are written and no other.
* CSV: header, NULL as an empty field, dates as ``yyyy-MM-dd``.
* Arrow IPC ("feather"): Spark has no Arrow file writer; ``arrow_source.py`` is one, as a
  data source whose job commits by one rename.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookback.sources.arrow_source import read_folder, write_folder

FORMATS = ("parquet", "csv", "arrow")
MODES = ("overwrite", "append", "error", "errorifexists", "ignore")


def feature_schema(names: Sequence[str], id_type: T.DataType | None = None,
                   date_type: T.DataType | None = None) -> T.StructType:
    """Schema of per-pair tables and of the matrix: what a CSV, which has no types, is read with."""
    fields = [T.StructField("bene_id", id_type or T.StringType())]
    for c in names:
        fields += [T.StructField(c, T.IntegerType()), T.StructField(f"{c}_ever", date_type or T.DateType())]
    return T.StructType(fields + [T.StructField("rfrnc_yr", T.IntegerType())])


def write_features(df: DataFrame, path: str, fmt: str = "parquet",
                   partition_by: Sequence[str] | None = None, mode: str = "overwrite",
                   replace: Iterable[int] | str | None = None) -> None:
    """Write ``df``; ``partition_by`` is ``("rfrnc_yr",)`` by default (none for Arrow, which can't be partitioned).

    ``overwrite`` of a partitioned output replaces the partitions that ``df`` has rows of and leaves all others as
    they are, so a year is run again without touching the rest.  ``replace`` names values of the first partition
    column that are replaced even if ``df`` has no row of them (their old rows go); ``"all"`` replaces the whole
    output.  Partitions are put in place when the job has succeeded: a failed one leaves the old ones.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if fmt in ("arrow", "feather"):
        if partition_by:
            raise ValueError("Arrow output can't be partitioned by columns")
        write_folder(df, qualified(df.sparkSession, path), mode)
        return
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}, got {fmt!r}")
    columns = ("rfrnc_yr",) if partition_by is None else tuple(partition_by)
    each = bool(columns) and mode == "overwrite" and replace != "all"
    named = sorted({int(v) for v in replace}) if each and replace is not None else []
    seen = None
    if named:
        seen = Observation()
        # As many values as there are partitions; observed while the rows are written, without a job of its own.
        df = df.observe(seen, F.collect_set(F.col(columns[0]).cast("long")).alias("values"), F.count(F.lit(1)).alias("rows"))
    if columns:
        df = df.hint("rebalance", *[F.col(c) for c in columns])
    w = df.write.mode(mode)
    if columns:
        w = w.partitionBy(*columns)
    if each:
        w = w.option("partitionOverwriteMode", "dynamic")
    if fmt == "parquet":
        w.parquet(path)
    else:
        (w.option("header", True).option("nullValue", "")
         .option("emptyValue", "").option("dateFormat", "yyyy-MM-dd")
         .option("timestampFormat", "yyyy-MM-dd HH:mm:ss")
         .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    if seen is not None:
        held = set(seen.get.get("values") or [])
        for value in named:
            if value not in held:
                _drop_partition(df.sparkSession, path, columns[0], value)


def _drop_partition(spark: SparkSession, path: str, column: str, value: int) -> None:
    """Remove the folder of one partition value, if there is one."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}={value}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with scheme and authority, as Hadoop's configuration resolves it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def read_features(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: T.StructType | None = None) -> DataFrame:
    """Read features back.  A CSV has no types: it is read with ``schema`` (:func:`feature_schema`), or as text.

    Of an Arrow folder only the columns of ``schema`` are decoded.
    """
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "csv":
        r = spark.read.option("header", True).option("nullValue", "").option("enforceSchema", False)
        return r.schema(schema).csv(path) if schema is not None else r.csv(path)
    if fmt in ("arrow", "feather"):
        return read_folder(spark, qualified(spark, path), schema)
    raise ValueError(f"fmt must be one of {FORMATS}, got {fmt!r}")

"""The two original job entry points as functions, plus the whole grid at once.

* ``condition_year_job`` - features of one condition and reference year, written to
  ``{output_prefix}_{condition}_{year}`` (the per-pair job);
* ``merge_year_job`` - the wide matrix of one year from the per-condition outputs
  written before (the merge job);
* ``all_years_job`` - every condition and year from one plan, the matrix written
  partitioned by ``rfrnc_yr`` (what the job graph produced, without 459 + 17
  processes).

Parameters keep the original names; ``output_format`` is ``parquet``, ``csv`` or
``feather`` (Arrow IPC), each output a Spark output folder; or ``table``, a table of the
session's warehouse named like the folder, bucketed by id, so that the merge joins
the tables of a year without a shuffle.

* ``state_year_job`` - the matrix of one year from that year's files and the state
  that the years before have left (``plans/state.py``).

The two per-year jobs return where they wrote, with ``counts`` of their steps that were observed
while the output was written.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookback.plans.buckets import bucket_count, merge_bucketed, write_bucketed
from lookback.plans.grid import oldest_window
from lookback.plans.matrix import feature_matrix, matrix_of_grid, merge_chain
from lookback.plans.pair import condition_feature
from lookback.plans.state import state_grid, update_state
from lookback.schemas import check_schema
from lookback.sources.codebook import read_codebook
from lookback.sources.sinks import feature_schema, read_features, write_features
from lookback.sources.yearly import history_years, read_years, window_years

_FMT = {"parquet": "parquet", "csv": "csv", "feather": "arrow", "arrow": "arrow", "table": "table"}


class Output(str):
    """Where a job wrote; ``counts`` has the rows of its steps."""

    counts: dict[str, int]

    def __new__(cls, path: str, counts: dict[str, int]) -> "Output":
        out = super().__new__(cls, path)
        out.counts = counts
        return out


def _fmt(output_format: str) -> str:
    try:
        return _FMT[output_format]
    except KeyError:
        raise ValueError(f"output_format must be one of {sorted(_FMT)}, got {output_format!r}") from None


def _pair_schema(condition: str, id_type: T.DataType | None, date_type: T.DataType | None) -> T.StructType:
    """Columns of a per-pair table in their written order."""
    by_name = {f.name: f for f in feature_schema([condition], id_type, date_type)}
    return T.StructType([by_name[c] for c in ("bene_id", "rfrnc_yr", condition, f"{condition}_ever")])


def condition_year_job(spark: SparkSession, year: int, condition: str, ccw_json: str,
                       dw_bene_prefix: str, dw_adm_prefix: str, output_prefix: str,
                       output_format: str = "parquet", first_year: int = 2000,
                       exclusion_scope: str = "oldest_year", buckets: int | None = None) -> Output:
    """Features of one condition in one reference year; returns the output path.

    Its ``counts``: rows of the spine, ids that meet the rule, with coverage and with a first date.
    """
    book = read_codebook(spark, ccw_json)
    # events: the whole history (first date); enrolment: the look-back window,
    # which holds the reference year itself (spine and coverage)
    events = check_schema(read_years(spark, dw_adm_prefix, history_years(year, first_year)), "events")
    enrol = check_schema(read_years(spark, dw_bene_prefix,
                                    window_years(year, book.spec(condition).ref_period, first_year)), "enrolment")
    watch = Observation()
    df = condition_feature(events, enrol, book, condition, year, first_year, exclusion_scope, watch=watch)
    rows = Observation()
    df = df.observe(rows, F.count(F.lit(1)).alias("spine"))
    path = f"{output_prefix}_{condition}_{year}"
    _write(df, path, _fmt(output_format), buckets)
    return Output(path, {"spine": rows.get["spine"], **watch.get})


def _write(df: DataFrame, path: str, fmt: str, buckets: int | None) -> None:
    if fmt == "table":
        write_bucketed(df, path, buckets)
    else:
        write_features(df, path, fmt=fmt, partition_by=())


def merge_year_job(spark: SparkSession, year: int, input_prefix: str, output_prefix: str,
                   ccw_json: str, output_format: str = "parquet", id_type: T.DataType | None = None,
                   date_type: T.DataType | None = None) -> Output:
    """Merge the per-condition outputs of one year into the matrix; returns the path.

    CSV inputs have no types: ids are read as ``id_type`` (text by default, so that
    leading zeros stay) and first dates as ``date_type`` (dates by default).
    Tables are merged bucket against bucket; they must have the same number of buckets.
    Its ``counts``: rows of the matrix.
    """
    book = read_codebook(spark, ccw_json)
    fmt = _fmt(output_format)
    names = {c: f"{input_prefix}_{c}_{year}" for c in book.names}
    buckets = None
    if fmt == "table":
        found = {bucket_count(spark, t) for t in names.values()}
        if len(found) != 1 or 0 in found:
            raise ValueError(f"tables to merge need one number of buckets by bene_id, found {sorted(found)}")
        buckets = found.pop()
        merged = merge_bucketed([(c, spark.table(t)) for c, t in names.items()], year)
    else:
        frames = [(c, read_features(spark, t, fmt=fmt, schema=_pair_schema(c, id_type, date_type) if fmt == "csv" else None))
                  for c, t in names.items()]
        merged = merge_chain(frames, year)
    rows = Observation()
    path = f"{output_prefix}_{year}"
    merged = merged.observe(rows, F.count(F.lit(1)).alias("rows"))
    if fmt == "table":  # already dealt by bucket: written as it is
        (merged.write.mode("overwrite").format("parquet").bucketBy(buckets, "bene_id").sortBy("bene_id").saveAsTable(path))
    else:
        write_features(merged, path, fmt=fmt, partition_by=())
    return Output(path, dict(rows.get))


def all_years_job(spark: SparkSession, years: Iterable[int], ccw_json: str,
                  dw_bene_prefix: str, dw_adm_prefix: str, output_path: str,
                  output_format: str = "parquet", first_year: int = 2000,
                  exclusion_scope: str = "oldest_year") -> DataFrame:
    """The matrix of every year in one plan, written partitioned by ``rfrnc_yr``.

    Years that an existing Parquet or CSV output has besides ``years`` are left as they are.
    """
    years = sorted({int(y) for y in years})
    book = read_codebook(spark, ccw_json)
    events = check_schema(read_years(spark, dw_adm_prefix, history_years(years[-1], first_year)), "events")
    # enrolment: from the oldest window of the first year asked for
    enrol = check_schema(read_years(spark, dw_bene_prefix, history_years(years[-1], oldest_window(book, years, first_year))), "enrolment")
    matrix = feature_matrix(events, enrol, book, years, first_year, exclusion_scope)
    _write_years(matrix, output_path, _fmt(output_format), years)
    return matrix


def _write_years(matrix: DataFrame, path: str, fmt: str, years: list[int]) -> None:
    if fmt == "table":
        raise ValueError("the matrix of several years is written as parquet, csv or feather")
    if fmt == "arrow":
        write_features(matrix, path, fmt=fmt, partition_by=())
    else:
        write_features(matrix, path, fmt=fmt, partition_by=("rfrnc_yr",), replace=years)


def state_year_job(spark: SparkSession, year: int, ccw_json: str, dw_bene_prefix: str, dw_adm_prefix: str,
                   state_path: str, output_path: str, output_format: str = "parquet", first_year: int = 2000,
                   exclusion_scope: str = "oldest_year") -> DataFrame:
    """The matrix of one year from its own two files and the state, which then holds that year too.

    Run for the years in order from ``first_year``; running one again replaces it, in the state and in the output.
    """
    year = int(year)
    book = read_codebook(spark, ccw_json)
    events = read_years(spark, dw_adm_prefix, [year])
    enrol = read_years(spark, dw_bene_prefix, [year])
    update_state(spark, state_path, events, enrol, book, year, first_year)
    grid = state_grid(spark, state_path, enrol, book, [year], first_year, exclusion_scope, rfrnc_yr="file_year")
    matrix = matrix_of_grid(grid, book.names)
    _write_years(matrix, output_path, _fmt(output_format), [year])
    return matrix

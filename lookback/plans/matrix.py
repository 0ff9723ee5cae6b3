"""Wide feature matrix.

One row per enrolment row and reference year, two columns per condition.
Column order follows the original merge: ``bene_id``, then the conditions in
*reverse* codebook order (``{c}``, ``{c}_ever``), then ``rfrnc_yr``.  Rows with a
NULL id are dropped, as an inner join on the id would.

The matrix comes straight out of the single-pass grid, already wide, so no
join chain is run.  ``merge_chain`` keeps the per-condition-table entry point:
it unions the tables and pivots them with one aggregation on the id instead of
``n - 1`` joins, then joins the pivot to the rows of the first table.  An id
that repeats d times gives d rows (the join chain would give d^n, every pair
within the group); AQE's skew join splits such a repeated id.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookback.plans.grid import _ident, feature_grid
from lookback.sources.codebook import Codebook


def matrix_columns(names: Sequence[str]) -> list[str]:
    cols = ["bene_id"]
    for c in reversed(list(names)):
        cols += [c, f"{c}_ever"]
    return cols + ["rfrnc_yr"]


def _matrix_select(names: Sequence[str]) -> list:
    return [F.col(_ident(c)) for c in matrix_columns(names)]


def feature_matrix(events: DataFrame, enrol: DataFrame, codebook: Codebook, years,
                   first_year: int, exclusion_scope: str = "oldest_year") -> DataFrame:
    """The matrix of every year in ``years`` (one merge job per year, in one plan).

    ``rfrnc_yr`` is the year of the file, whatever the rows' ``year`` column says.
    """
    wide = feature_grid(events, enrol, codebook, years, first_year, exclusion_scope, rfrnc_yr="file_year")
    return matrix_of_grid(wide, codebook.names)


def matrix_of_grid(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    """The grid's rows with an id, in the matrix's column order."""
    return wide.where(F.col("bene_id").isNotNull()).select(*_matrix_select(names))


def merge_chain(frames: Sequence[tuple[str, DataFrame]], ref_year: int) -> DataFrame:
    """Merge per-condition tables ``(bene_id, {c}, {c}_ever)`` into the matrix.

    Only ids present in every table are kept (inner-join semantics), with a NULL
    status too; NULL ids never match.  ``rfrnc_yr`` is the given year.  An id that
    repeats in a table must repeat the same values: different ones raise an error,
    as no one of them could be chosen rightly.
    """
    if not frames:
        raise ValueError("no condition tables to merge")
    names = [name for name, _ in frames]
    parts = [df.select("bene_id", F.lit(i).alias("_cidx"),
                       F.col(_ident(name)).cast("int").alias("_status"),
                       F.col(_ident(f"{name}_ever")).alias("_ever"))
             for i, (name, df) in enumerate(frames)]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    value = F.struct(F.col("_status").alias("status"), F.col("_ever").alias("ever"))
    aggs = [f(F.when(F.col("_cidx") == i, value)).alias(f"_{end}{i}")
            for i in range(len(names)) for f, end in ((F.min, "lo"), (F.max, "hi"))]
    wide = long.where(F.col("bene_id").isNotNull()).groupBy("bene_id").agg(*aggs)
    present = functools.reduce(lambda a, b: a & b, [F.col(f"_hi{i}").isNotNull() for i in range(len(names))])
    picked = [F.col("bene_id")]
    for i, name in enumerate(names):
        same = F.col(f"_lo{i}").eqNullSafe(F.col(f"_hi{i}"))
        error = F.raise_error(F.concat(F.lit(f"merge: different rows of {name} for id "), F.col("bene_id").cast("string")))
        picked += [F.when(same, F.col(f"_hi{i}.status")).otherwise(error.cast("int")).alias(name),
                   F.col(f"_hi{i}.ever").alias(f"{name}_ever")]
    wide = wide.where(present).select(*picked)
    first_rows = frames[0][1].select("bene_id").where(F.col("bene_id").isNotNull())
    out = first_rows.join(wide, "bene_id", "inner")
    return out.withColumn("rfrnc_yr", F.lit(int(ref_year))).select(*_matrix_select(names))

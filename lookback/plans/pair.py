"""One (condition, reference year) feature table.

spine (enrolment rows of the reference year's file, duplicates kept)
  LEFT JOIN met   on a NULL-safe id match, NULL -> 0
  LEFT JOIN cov   on a NULL-safe id match (no fill: a missing flag gives status 3)
  LEFT JOIN ever  on a plain id match (a NULL id never gets a date)
The three sides are one aggregation per id over one scan of the events
(``operators/per_id.py``), so the spine is joined (and shuffled) once.
Output ``bene_id, rfrnc_yr, {condition}, {condition}_ever``.

``ever_scope="window"`` is the exploratory form: the first date inside the look-back
window only, joined NULL-safe like the other two.

A hot id is reduced map-side; the spine is the only side that can repeat an id,
and AQE splits a skewed spine partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lookback.functions.codes import fill_zero, status_code
from lookback.operators.per_id import cov_flag, met_flag, per_id
from lookback.sources.codebook import Codebook


def spine(enrol: DataFrame, ref_year: int) -> DataFrame:
    """Every enrolment row of the reference year's file: ``bene_id, rfrnc_yr``."""
    return (enrol.where(F.col("file_year") == int(ref_year))
            .select("bene_id", F.col("year").cast("int").alias("rfrnc_yr")))


def left_join_on_id(left: DataFrame, right: DataFrame, null_safe: bool,
                    col: str = "bene_id") -> DataFrame:
    """Left join on the id, matching NULL to NULL when ``null_safe``."""
    if not null_safe:
        return left.join(right, col, "left")
    r = right.withColumnRenamed(col, "_rid")
    return left.join(r, left[col].eqNullSafe(r["_rid"]), "left").drop("_rid")


def condition_parts(events: DataFrame, enrol: DataFrame, codebook: Codebook, condition: str,
                    ref_year: int, first_year: int, exclusion_scope: str = "oldest_year",
                    ever_scope: str = "history", watch: Observation | None = None) -> DataFrame:
    """Spine with the intermediate flags: ``bene_id, rfrnc_yr, met, cov, status, ever``.

    The per-id table (a NULL id is one group, as in SQL) is joined to the spine
    once, NULL-safe.  A NULL id has no first date in the history scope.

    ``watch`` is filled by the action that runs the frame: how many ids meet the
    rule (``met``), have enrolment rows in the window (``cov``) and a first date (``ever``).
    """
    table = per_id(events, codebook, condition, ref_year, first_year, exclusion_scope,
                   ever_scope=ever_scope, enrol=enrol)
    ever = F.col("ever") if ever_scope == "window" else F.when(F.col("bene_id").isNotNull(), F.col("ever"))
    sides = cov_flag(met_flag(table)).select("bene_id", "met", "cov", ever.alias("ever"))
    if watch is not None:
        sides = sides.observe(watch, F.count(F.when(F.col("met") == 1, 1)).alias("met"),
                              F.count("cov").alias("cov"), F.count("ever").alias("ever"))
    df = left_join_on_id(spine(enrol, ref_year), sides, null_safe=True)
    df = df.withColumn("met", fill_zero("met")).withColumn("status", status_code("met", "cov"))
    return df.select("bene_id", "rfrnc_yr", "met", "cov", "status", "ever")


def condition_feature(events: DataFrame, enrol: DataFrame, codebook: Codebook, condition: str,
                      ref_year: int, first_year: int, exclusion_scope: str = "oldest_year",
                      ever_scope: str = "history", watch: Observation | None = None) -> DataFrame:
    """``bene_id, rfrnc_yr, {condition}, {condition}_ever`` for one reference year."""
    parts = condition_parts(events, enrol, codebook, condition, ref_year, first_year,
                            exclusion_scope, ever_scope, watch)
    return parts.select("bene_id", "rfrnc_yr", F.col("status").alias(condition),
                        F.col("ever").alias(f"{condition}_ever"))

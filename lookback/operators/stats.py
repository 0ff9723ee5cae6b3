"""Statistics, membership, diagnostics and peeks.

Everything is an aggregate or a join; nothing is collected to the driver
except the one-row metric of an ``Observation``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lookback.operators.matching import code_hits
from lookback.operators.per_id import met_flag, per_id
from lookback.sources.codebook import Codebook
from lookback.sources.yearly import in_years


def event_stats(events: DataFrame, codebook: Codebook, condition: str,
                years: Iterable[int]) -> DataFrame:
    """Per id: first and last matching admission date and the number of
    distinct (id, date, code) matches per file: ``bene_id, min_adm_date,
    max_adm_date, n``.  A NULL id forms its own group, as in SQL."""
    hits = code_hits(events.where(in_years(list(years))), codebook, condition, "include",
                     keep=["bene_id", "admission_date", "file_year"])
    per_file = hits.select("bene_id", "admission_date", "file_year", "code").distinct()
    return per_file.groupBy("bene_id").agg(
        F.min("admission_date").alias("min_adm_date"),
        F.max("admission_date").alias("max_adm_date"),
        F.count("code").alias("n"))


def unique_ids(df: DataFrame, col: str = "bene_id") -> DataFrame:
    return df.select(col).distinct()


def unique_count(df: DataFrame, col: str = "bene_id") -> DataFrame:
    """Number of unique values, a NULL counting as one value: ``n_unique``."""
    return df.agg((F.count_distinct(col) + F.coalesce(F.max(F.col(col).isNull().cast("int")), F.lit(0)))
                  .cast("long").alias("n_unique"))


def member_flag(df: DataFrame, other: DataFrame, col: str = "bene_id",
                flag: str = "flag") -> DataFrame:
    """``df`` plus ``flag`` = 1 when its id occurs in ``other`` (NULL matches NULL)."""
    ids = other.select(F.col(col).alias("_mid")).distinct().withColumn("_hit", F.lit(1))
    out = df.join(ids, df[col].eqNullSafe(ids["_mid"]), "left")
    return out.withColumn(flag, F.coalesce("_hit", F.lit(0)).cast("int")).drop("_mid", "_hit")


def member_count(df: DataFrame, other: DataFrame, col: str = "bene_id") -> DataFrame:
    """Rows of ``df`` whose id occurs in ``other`` (NULL matches NULL): ``n``."""
    ids = other.select(F.col(col).alias("_mid")).distinct()
    hits = df.join(ids, df[col].eqNullSafe(ids["_mid"]), "left_semi")
    return hits.agg(F.count(F.lit(1)).alias("n"))


def observe_counts(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whatever action runs ``df`` next."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def step_counts(steps: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``step, n_rows, n_cols`` for named frames that have nothing in common (one aggregate each)."""
    parts = [df.agg(F.lit(name).alias("step"), F.count(F.lit(1)).alias("n_rows"),
                    F.lit(len(df.columns)).alias("n_cols")) for name, df in steps]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pair_step_counts(events: DataFrame, enrol: DataFrame, codebook: Codebook, condition: str,
                     ref_year: int, first_year: int, exclusion_scope: str = "oldest_year") -> DataFrame:
    """``step, n_rows, n_cols`` of the steps of a pair (spine, met, cov, ever), from one run.

    All four counts are sums over the one table per id that the pair is built from.
    """
    table = met_flag(per_id(events, codebook, condition, ref_year, first_year, exclusion_scope,
                            ever_scope="history", enrol=enrol, spine=True), unused=("hmo",))
    counts = table.agg(
        F.coalesce(F.sum("n_spine"), F.lit(0)).alias("spine"),
        F.count(F.when(F.col("met") == 1, 1)).alias("met"),
        F.count(F.when(F.col("enrolled") == 1, 1)).alias("cov"),
        F.count(F.when(F.col("ever").isNotNull() & F.col("bene_id").isNotNull(), 1)).alias("ever"))
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(step).alias("step"), F.col(step).alias("n_rows"), F.lit(2).alias("n_cols"))
        for step in ("spine", "met", "cov", "ever")])))


def peek(df: DataFrame, n: int, order_by: Sequence[str] | None = None,
         seed: int | None = None) -> DataFrame:
    """``n`` rows: the first by ``order_by``, or a seeded pseudo-random choice.

    Both forms plan as a per-partition top-n followed by a merge of the
    partitions' candidates (no global sort), and both are deterministic, so a
    retried task gives the same rows.
    """
    if seed is not None:
        key = F.xxhash64(F.lit(int(seed)), *[F.col(c) for c in df.columns])
        return df.orderBy(key, *[F.col(c) for c in (order_by or [])]).limit(n)
    if not order_by:
        raise ValueError("peek needs order_by or seed for a reproducible choice")
    return df.orderBy(*order_by).limit(n)

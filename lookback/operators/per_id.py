"""One table per entity from one scan of the events.

Everything that a (condition, reference year) pair needs to know about an entity
is an aggregate over its rows, so the event rows with include and exclude
codes and the enrolment rows are unioned *before* one ``groupBy("bene_id")``:

* ``hit``      1 with an include hit passing the position rule in a window file;
* ``exc``      1 with an exclusion hit in a file of the exclusion scope;
* ``ever``     first date of an include hit (position and exclusions don't matter);
* ``hmo``, ``enrolled``  HMO months of the window files and whether there is a row;
* ``n_spine``  enrolment rows of the reference year's file.

A hot id is reduced map-side.  ``met_flag`` adds the claims flag with the NULL rules
of ``NOT IN``: they need two facts about the whole exclusion set, read by a scalar
subquery from the same table.  The subquery reads every column of it, so Spark
finds equal exchanges in both places and the events are scanned once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookback.functions.codes import coverage_flag, rule_max_pos
from lookback.operators.matching import coded_rows
from lookback.sources.codebook import EXCLUDE, Codebook
from lookback.sources.yearly import history_years, in_years, window_years

SCOPES = ("oldest_year", "window")
EVER_SCOPES = ("history", "window", None)


def exclusion_years(ref_year: int, ref_period: int, first_year: int, scope: str) -> list[int]:
    years = window_years(ref_year, ref_period, first_year)
    if scope == "oldest_year":
        return [min(years)]
    if scope == "window":
        return years
    raise ValueError(f"exclusion_scope must be one of {SCOPES}, got {scope!r}")


def per_id(events: DataFrame, codebook: Codebook, condition: str, ref_year: int, first_year: int,
           exclusion_scope: str = "oldest_year", criteria: str | None = None,
           ever_scope: str | None = None, enrol: DataFrame | None = None, spine: bool = False) -> DataFrame:
    """``bene_id, hit[, exc][, ever][, hmo, enrolled][, n_spine]`` (see the module doc).

    ``exc`` is there when the condition has exclusion codes, ``ever`` with an
    ``ever_scope`` (``history`` or ``window``), the enrolment columns with ``enrol``,
    of which ``n_spine`` only if asked for.
    """
    if ever_scope not in EVER_SCOPES:
        raise ValueError(f"scope must be 'history' or 'window', got {ever_scope!r}")
    spec = codebook.spec(condition)
    window = window_years(ref_year, spec.ref_period, first_year)
    excluded = exclusion_years(ref_year, spec.ref_period, first_year, exclusion_scope)
    scanned = history_years(ref_year, first_year) if ever_scope == "history" else window
    rows = coded_rows(events.where(in_years(scanned)), codebook, condition).select(
        "bene_id", "file_year", "admission_date", "pos", (F.col("kind") == EXCLUDE).alias("is_exc"))

    in_window = in_years(window)
    include = F.col("is_exc") == F.lit(False)
    aggs = [F.max(F.when(include & (F.col("pos") <= rule_max_pos(criteria or spec.criteria)) & in_window, 1)).alias("hit")]
    if spec.n_exclude > 0:
        aggs.append(F.max(F.when(F.col("is_exc") & in_years(excluded), 1)).alias("exc"))
    if ever_scope is not None:
        dated = include if ever_scope == "history" else include & in_window
        aggs.append(F.min(F.when(dated, F.col("admission_date"))).alias("ever"))
    if enrol is not None:
        months = enrol.where(in_years(window)).select("bene_id", "file_year", "hmo_mo")
        rows = (rows.withColumn("hmo_mo", F.lit(None).cast(months.schema["hmo_mo"].dataType)).withColumn("is_enrol", F.lit(0))
                .unionByName(months.withColumn("is_enrol", F.lit(1)), allowMissingColumns=True))
        aggs += [F.sum("hmo_mo").alias("hmo"), F.max("is_enrol").alias("enrolled")]
        if spine:
            aggs.append(F.sum(F.when((F.col("is_enrol") == 1) & (F.col("file_year") == int(ref_year)), 1).otherwise(0)).alias("n_spine"))
    return rows.groupBy("bene_id").agg(*aggs)


def met_flag(table: DataFrame, unused: tuple[str, ...] = ()) -> DataFrame:
    """``table`` with ``met`` (0/1): a hit, and ``bene_id NOT IN`` the exclusion set.

    A NULL id in the exclusion set means nobody meets the rule; a NULL id itself
    meets it only when the exclusion set is empty.  The rule is one CASE over
    aggregate outputs, so no part of it moves below the aggregation.  ``unused``
    names columns that the caller doesn't read later.
    """
    if "exc" not in table.columns:
        return table.withColumn("met", F.coalesce("hit", F.lit(0)))
    every = F.xxhash64(*[F.col(c) for c in table.columns if c not in unused])
    facts = table.agg(F.struct(
        F.coalesce(F.max("exc"), F.lit(0)).alias("any"),
        F.coalesce(F.max(F.when(F.col("bene_id").isNull(), F.col("exc"))), F.lit(0)).alias("has_null"),
        # reads every column: else this branch is pruned and the exchange isn't shared
        F.count(F.when(every == 0, 1)).alias("read"))).scalar()
    # Ids with nothing to tell go here; the filter also keeps the CASE out of the aggregation, whose
    # functions then stand in the same order in both branches.
    told = [c for c in table.columns if c not in ("bene_id", "hmo") and c not in unused]
    table = table.where(F.greatest(*[F.col(c).isNotNull().cast("int") for c in told]) == 1)
    return table.withColumn("met", F.when(F.col("exc") == 1, 0)
                            .when((facts["has_null"] == 1) | (facts["read"] < 0), 0)
                            .when(F.col("bene_id").isNull() & (facts["any"] == 1), 0)
                            .otherwise(F.coalesce("hit", F.lit(0))))


def cov_flag(table: DataFrame) -> DataFrame:
    """``table`` with ``cov`` (0/1), NULL for an id without an enrolment row in the window."""
    return table.withColumn("cov", F.when(F.col("enrolled") == 1, coverage_flag("hmo")))

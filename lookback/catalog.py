"""Registered queries on the demo views of the driver tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; ``oracle.py`` holds
the equivalent DuckDB SQL under the same key.  Parameters are the demo ones:
reference year 1999, first year 1995, and all years of the orders for the grid.
Each query asks its views for the years it needs, so scans are pruned.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookback.functions.codes import overlaps
from lookback.operators.coverage import coverage
from lookback.operators.first_event import first_event
from lookback.operators.matching import match_codes, unnest_codes
from lookback.operators.met import met
from lookback.operators.stats import (event_stats, member_count, member_flag,
                                      pair_step_counts, peek, unique_count)
from lookback.plans.buckets import merge_bucketed, write_bucketed
from lookback.plans.grid import feature_grid_long
from lookback.plans.matrix import feature_matrix, matrix_columns, matrix_of_grid, merge_chain
from lookback.plans.pair import condition_feature, condition_parts, spine
from lookback.plans.state import state_grid, state_grid_long, update_state
from lookback.sources.code_text import parse_code_text
from lookback.sources.codebook import read_codebook
from lookback.sources.demo import (DEMO_CODEBOOK, EXCL_CODEBOOK, FIRST_YEAR, LAST_YEAR,
                                   REF_YEAR, WORDS_CODEBOOK, demo_admissions,
                                   demo_document_enrolment, demo_documents, demo_enrolment,
                                   demo_event_codes, demo_years, wide_codebook)
from lookback.sources.scratch import scratch_folder
from lookback.sources.sinks import feature_schema, read_features, write_features
from lookback.sources.yearly import history_years, in_years, read_years, union_years, window_years

Y, F0, L = REF_YEAR, FIRST_YEAR, LAST_YEAR
YEARS = list(range(F0, L + 1))
# The code set of the overlap and limit queries.
OVERLAP_CODES = ["worthless", "idiot", "clown", "de"]
# The file years of the hit and statistics queries.
HIT_YEARS = window_years(Y, 3, F0)
HISTORY = history_years(Y, F0)


def _views(spark: SparkSession, sf: str, years=None, enrol_years=None):
    """Long-form events (one row per code with its position) and enrolment."""
    return demo_event_codes(spark, sf, years=years), demo_enrolment(spark, sf, years=enrol_years or years)


def _arrays(spark: SparkSession, sf: str, years=None):
    """Events that hold their codes as an array, and their enrolment."""
    return demo_documents(spark, sf, years), demo_document_enrolment(spark, sf, years)


def _book(spark: SparkSession, which=None, exclusion_codes: str = "compat", normalize: bool = False):
    """A demo codebook; the exclusion mode is named by each query that has exclusions."""
    return read_codebook(spark, which or DEMO_CODEBOOK, exclusion_codes=exclusion_codes, normalize=normalize)


def _event_cols(df: DataFrame) -> DataFrame:
    return df.select("adm_id", "bene_id", "file_year")


def q_scan_year(spark, sf):
    return demo_admissions(spark, sf, [1998]).select("adm_id", "bene_id", "admission_date", "file_year")


def q_scan_window(spark, sf):
    return _event_cols(demo_admissions(spark, sf, window_years(Y, 3, F0)))


def q_union_years(spark, sf):
    return union_years(_event_cols(demo_admissions(spark, sf, [y])) for y in history_years(1997, F0))


def q_codebook(spark, sf):
    ev, _ = _views(spark, sf)
    cb = _book(spark)
    counts = unnest_codes(ev).groupBy("code").agg(F.count(F.lit(1)).alias("n_events"))
    return (cb.codes.join(counts, "code", "left")
            .select("condition", "ref_period", "criteria", "kind", "code",
                    F.coalesce("n_events", F.lit(0)).cast("long").alias("n_events")))


def q_code_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return parse_code_text(docs, "text").select("doc_id", "code_pos", "code")


def q_spine(spark, sf):
    return spine(demo_enrolment(spark, sf, years=[Y]), Y)


def q_unnest(spark, sf):
    ev, _ = _arrays(spark, sf)
    return unnest_codes(ev, keep=["adm_id", "bene_id", "file_year"])


def q_overlap(spark, sf):
    ev, _ = _arrays(spark, sf)
    return (ev.where(overlaps("diagnoses", OVERLAP_CODES))
            .select("adm_id", "bene_id", "file_year", F.size("diagnoses").alias("n_codes")))


def _hits(condition):
    def q(spark, sf):
        ev = demo_event_codes(spark, sf, years=HIT_YEARS)
        return match_codes(ev.where(in_years(HIT_YEARS)), _book(spark), condition)
    return q


def _array_hits(condition):
    def q(spark, sf):
        ev, _ = _arrays(spark, sf, HIT_YEARS)
        return match_codes(ev.where(in_years(HIT_YEARS)), _book(spark, WORDS_CODEBOOK), condition)
    return q


def _met(condition, book=None, scope="oldest_year", exclusion_codes="compat"):
    def q(spark, sf):
        ev = demo_event_codes(spark, sf, years=HIT_YEARS)
        return met(ev, _book(spark, book, exclusion_codes), condition, Y, F0, exclusion_scope=scope)
    return q


def _array_met(condition, scope="oldest_year", exclusion_codes="compat"):
    def q(spark, sf):
        ev, _ = _arrays(spark, sf, HIT_YEARS)
        return met(ev, _book(spark, WORDS_CODEBOOK, exclusion_codes), condition, Y, F0, exclusion_scope=scope)
    return q


def q_ever(spark, sf):
    return first_event(demo_event_codes(spark, sf, years=HISTORY), _book(spark), "c1", Y, F0)


def q_coverage(spark, sf):
    return coverage(demo_enrolment(spark, sf, years=window_years(Y, 2, F0)), Y, 2, F0)


def q_covered_ids(spark, sf):
    return q_coverage(spark, sf).where(F.col("cov") == 1).select("bene_id")


def q_event_stats(spark, sf):
    return event_stats(demo_event_codes(spark, sf, years=HIT_YEARS), _book(spark), "c1", HIT_YEARS)


def q_unique_count(spark, sf):
    return unique_count(_hits("c1")(spark, sf))


def q_unique_count_none(spark, sf):
    """No word of the condition occurs: the count over an empty input is 0."""
    return unique_count(_array_hits("w4")(spark, sf))


def q_member_flag(spark, sf):
    return member_flag(q_spine(spark, sf), q_event_stats(spark, sf))


def q_member_count(spark, sf):
    sp = q_spine(spark, sf)
    a = member_count(q_coverage(spark, sf), sp).select(F.lit(0).alias("k"), "n")
    b = member_count(q_event_stats(spark, sf), sp).select(F.lit(1).alias("k"), "n")
    # two one-row counts side by side: a union and one global aggregate, no join
    return a.unionByName(b).agg(
        F.max(F.when(F.col("k") == 0, F.col("n"))).alias("n_cov_in_spine"),
        F.max(F.when(F.col("k") == 1, F.col("n"))).alias("n_hits_in_spine"))


def q_step_counts(spark, sf):
    ev, en = _views(spark, sf, HISTORY)
    return pair_step_counts(ev, en, _book(spark), "c2", Y, F0)


def q_limit(spark, sf):
    return peek(q_overlap(spark, sf).select("adm_id", "bene_id"), 10, order_by=["adm_id"])


def q_status(spark, sf):
    ev, en = _views(spark, sf, HISTORY)
    return condition_parts(ev, en, _book(spark), "c2", Y, F0).drop("ever")


def _pair(condition, book=None, scope="oldest_year", ever_scope="history", exclusion_codes="compat"):
    def q(spark, sf):
        ev, en = _views(spark, sf, HISTORY if ever_scope == "history" else HIT_YEARS, HIT_YEARS)
        return condition_feature(ev, en, _book(spark, book, exclusion_codes), condition, Y, F0,
                                 exclusion_scope=scope, ever_scope=ever_scope)
    return q


def _array_pair(condition, scope="oldest_year", exclusion_codes="compat", normalize=False):
    def q(spark, sf):
        ev, en = _arrays(spark, sf, HISTORY)
        return condition_feature(ev, en, _book(spark, WORDS_CODEBOOK, exclusion_codes, normalize), condition, Y, F0,
                                 exclusion_scope=scope)
    return q


def _grid(book=None, scope="oldest_year", exclusion_codes="compat"):
    def q(spark, sf):
        ev, en = _views(spark, sf)
        return feature_grid_long(ev, en, _book(spark, book, exclusion_codes), demo_years(spark, sf), F0, exclusion_scope=scope)
    return q


q_grid_status = _grid()


def q_grid_arrays(spark, sf):
    ev, en = _arrays(spark, sf, HISTORY)
    return feature_grid_long(ev, en, _book(spark, WORDS_CODEBOOK, "all"), HISTORY, F0, exclusion_scope="window")


def q_grid_summary(spark, sf):
    return (q_grid_status(spark, sf).groupBy("condition", "rfrnc_yr", "status")
            .agg(F.count(F.lit(1)).alias("n"), F.count("ever").alias("n_ever")))


def _matrix_one_year(book=None):
    def q(spark, sf):
        ev, en = _views(spark, sf, HISTORY)
        return feature_matrix(ev, en, _book(spark, book), [Y], F0)
    return q


def q_matrix_all(spark, sf):
    ev, en = _views(spark, sf)
    return feature_matrix(ev, en, _book(spark), demo_years(spark, sf), F0)


def q_merge_chain(spark, sf):
    ev, en = _views(spark, sf, HISTORY)
    cb = _book(spark)
    frames = [(c, condition_feature(ev, en, cb, c, Y, F0)) for c in cb.names]
    return merge_chain(frames, Y)


def q_merge_bucketed(spark, sf):
    """The per-condition tables are saved co-bucketed in the warehouse and merged bucket against bucket."""
    ev, en = _views(spark, sf, HISTORY)
    cb = _book(spark)
    run = uuid.uuid4().hex[:12]
    names = {c: write_bucketed(condition_feature(ev, en, cb, c, Y, F0), f"lookback_pair_{c}_{Y}_{run}") for c in cb.names}
    return merge_bucketed([(c, spark.table(t)) for c, t in names.items()], Y)


def q_grid_state(spark, sf):
    """The state takes the years before the last in one go, then the last year; the grid comes out of the state."""
    ev, en = _views(spark, sf)
    cb, years = _book(spark), demo_years(spark, sf)
    path = scratch_folder(spark, "state")
    for some in (years[:-1], years[-1:]):
        if some:
            events, enrol = _views(spark, sf, some)
            update_state(spark, path, events, enrol, cb, some, F0)
    return state_grid_long(spark, path, en, cb, years, F0)


def q_matrix_state(spark, sf):
    """The matrix of one year, 27 conditions, out of a state put together year by year."""
    cb = _book(spark, wide_codebook())
    path = scratch_folder(spark, "state")
    for y in HISTORY:
        events, enrol = _views(spark, sf, [y])
        update_state(spark, path, events, enrol, cb, y, F0)
    grid = state_grid(spark, path, demo_enrolment(spark, sf, years=[Y]), cb, [Y], F0, rfrnc_yr="file_year")
    return matrix_of_grid(grid, cb.names)


def q_read_years(spark, sf):
    """Yearly files whose columns differ (no months in the first year, half months after the reference year) read as one table."""
    prefix = scratch_folder(spark, "years") + "/bene"
    for y in demo_years(spark, sf):
        en = demo_enrolment(spark, sf, years=[y]).drop("file_year")
        if y == F0:
            en = en.drop("hmo_mo")
        elif y % 2:
            en = en.withColumn("hmo_mo", F.col("hmo_mo").cast("long"))
        if y > Y:
            en = en.withColumn("half_mo", F.col("hmo_mo") / 2)
        en.write.parquet(f"{prefix}_{y}.parquet")
    return read_years(spark, prefix, reversed(demo_years(spark, sf)))


def _write_years(spark, sf, fmt, steps):
    ev, en = _views(spark, sf, HISTORY)
    path = scratch_folder(spark, f"matrix-{fmt}")
    cb = _book(spark)
    for years in steps:
        write_features(feature_matrix(ev, en, cb, years, F0), path, fmt, replace=years)
    return path, cb


def q_write_years(spark, sf):
    """The matrix written year by year into one output, one year twice, and read back."""
    path, cb = _write_years(spark, sf, "parquet", [[Y - 2, Y - 1], [Y], [Y - 1]])
    return read_features(spark, path).select(*matrix_columns(cb.names))


def q_write_csv(spark, sf):
    path, cb = _write_years(spark, sf, "csv", [[Y - 1], [Y]])
    id_type, date_type = T.LongType(), T.TimestampNTZType()
    schema = feature_schema(list(reversed(cb.names)), id_type, date_type)  # the matrix's own order
    return read_features(spark, path, "csv", schema=schema).select(*matrix_columns(cb.names))


def q_write_arrow(spark, sf):
    path = scratch_folder(spark, "pair-arrow")
    ev, en = _views(spark, sf, HISTORY)
    write_features(condition_feature(ev, en, _book(spark), "c2", Y, F0), path, "arrow")
    return read_features(spark, path, "arrow")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "q_scan_year": q_scan_year,
    "q_scan_window": q_scan_window,
    "q_union_years": q_union_years,
    "q_codebook": q_codebook,
    "q_code_text": q_code_text,
    "q_spine": q_spine,
    "q_unnest": q_unnest,
    "q_overlap": q_overlap,
    "q_hits_all": _hits("c1"),
    "q_hits_primary": _hits("c2"),
    "q_hits_first_two": _hits("c3"),
    "q_met_all": _met("c1"),
    "q_met_primary": _met("c2"),
    "q_met_first_two": _met("c3"),
    "q_met_excl": _met("x1", EXCL_CODEBOOK),
    "q_met_excl_window": _met("x1", EXCL_CODEBOOK, "window"),
    "q_met_excl_all": _met("c3", scope="window", exclusion_codes="all"),
    "q_array_hits_all": _array_hits("w1"),
    "q_array_hits_primary": _array_hits("w2"),
    "q_array_hits_first_two": _array_hits("w3"),
    "q_array_met_primary": _array_met("w2", "window", "all"),
    "q_array_met_first_two": _array_met("w3", "oldest_year", "all"),
    "q_ever": q_ever,
    "q_coverage": q_coverage,
    "q_covered_ids": q_covered_ids,
    "q_event_stats": q_event_stats,
    "q_unique_count": q_unique_count,
    "q_unique_count_none": q_unique_count_none,
    "q_member_flag": q_member_flag,
    "q_member_count": q_member_count,
    "q_step_counts": q_step_counts,
    "q_limit": q_limit,
    "q_status": q_status,
    "q_pair_all": _pair("c1"),
    "q_pair_primary": _pair("c2"),
    "q_pair_first_two": _pair("c3"),
    "q_pair_excl": _pair("x1", EXCL_CODEBOOK),
    "q_pair_excl_window": _pair("x1", EXCL_CODEBOOK, "window"),
    "q_array_pair_all": _array_pair("w1"),
    "q_array_pair_primary": _array_pair("w2", "window", "all"),
    "q_array_pair_first_two": _array_pair("w3", "oldest_year", "all"),
    "q_array_pair_normalized": _array_pair("w2", normalize=True),
    "q_pair_window_ever": _pair("c1", ever_scope="window"),
    "q_grid_status": q_grid_status,
    "q_grid_summary": q_grid_summary,
    "q_grid_window": _grid(scope="window", exclusion_codes="all"),
    "q_grid_arrays": q_grid_arrays,
    "q_grid_k27": _grid(wide_codebook()),
    "q_matrix_year": _matrix_one_year(),
    "q_matrix_all": q_matrix_all,
    "q_matrix_k27": _matrix_one_year(wide_codebook()),
    "q_merge_chain": q_merge_chain,
    "q_merge_bucketed": q_merge_bucketed,
    "q_grid_state": q_grid_state,
    "q_matrix_state": q_matrix_state,
    "q_read_years": q_read_years,
    "q_write_years": q_write_years,
    "q_write_csv": q_write_csv,
    "q_write_arrow": q_write_arrow,
}

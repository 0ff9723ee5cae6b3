"""Longitudinal prior-event features on Spark.

Given yearly event tables (entity, date, ordered code array - or the same in
long form, one row per code with its position), yearly enrolment tables
(entity, year, HMO months) and a codebook of conditions, compute per entity,
condition and reference year a status 0-3 (claims rule met x coverage
sufficient) and the date of the first matching event, as long tables or as the
wide one-row-per-entity-and-year matrix.
"""

from lookback.functions.codes import code_at, overlaps, status_code
from lookback.operators.coverage import coverage
from lookback.operators.first_event import first_event
from lookback.operators.matching import match_codes, unnest_codes
from lookback.operators.met import met
from lookback.operators.stats import (event_stats, member_count, member_flag, observe_counts,
                                      pair_step_counts, peek, step_counts, unique_count, unique_ids)
from lookback.plans.grid import feature_grid, feature_grid_long, stack_conditions
from lookback.plans.jobs import all_years_job, condition_year_job, merge_year_job
from lookback.plans.matrix import feature_matrix, merge_chain
from lookback.plans.pair import condition_feature, condition_parts, spine
from lookback.schemas import check_schema
from lookback.sources.code_text import parse_code_text
from lookback.sources.codebook import Codebook, read_codebook
from lookback.sources.sinks import read_features, write_features
from lookback.sources.yearly import (history_years, read_partitioned, read_year, read_years,
                                     union_years, window_years)

__all__ = [
    "Codebook", "all_years_job", "check_schema", "code_at", "condition_feature",
    "condition_parts", "condition_year_job", "coverage", "event_stats", "feature_grid",
    "feature_grid_long", "feature_matrix", "first_event", "history_years", "match_codes",
    "member_count", "member_flag", "merge_chain", "merge_year_job", "met", "pair_step_counts",
    "observe_counts", "overlaps", "parse_code_text", "peek", "read_codebook", "read_features",
    "read_partitioned", "read_year", "read_years", "spine", "stack_conditions", "status_code",
    "step_counts", "union_years", "unique_count", "unique_ids", "unnest_codes", "window_years",
    "write_features",
]

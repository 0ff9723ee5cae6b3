"""Fee-for-service coverage per entity.

``cov = 1`` when the HMO months of all enrolment rows of the entity in the
look-back window files add up to 0; NULL months are skipped, an all-NULL sum
gives 0, missing years do not count against coverage.  Spark plans the SUM as a
partial aggregate before the shuffle and a final one after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookback.functions.codes import coverage_flag
from lookback.sources.yearly import in_years, window_years


def coverage(enrol: DataFrame, ref_year: int, ref_period: int, first_year: int) -> DataFrame:
    """``bene_id, cov`` over the window files of ``ref_year``."""
    years = window_years(ref_year, ref_period, first_year)
    return (enrol.where(in_years(years))
            .groupBy("bene_id")
            .agg(coverage_flag(F.sum("hmo_mo")).alias("cov")))

"""First matching event on record.

The earliest admission date with an include code at any position, over all
files from ``first_year`` up to the reference year.  Window, position rule and
exclusions do not apply.  Entities with a NULL id get no date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookback.operators.matching import code_hits
from lookback.sources.codebook import Codebook
from lookback.sources.yearly import history_years, in_years, window_years


def first_event(events: DataFrame, codebook: Codebook, condition: str, ref_year: int,
                first_year: int, scope: str = "history", keep_null_id: bool = False) -> DataFrame:
    """``bene_id, ever``; ``scope="window"`` limits it to the look-back window."""
    if scope == "history":
        years = history_years(ref_year, first_year)
    elif scope == "window":
        years = window_years(ref_year, codebook.spec(condition).ref_period, first_year)
    else:
        raise ValueError(f"scope must be 'history' or 'window', got {scope!r}")
    hits = code_hits(events.where(in_years(years)), codebook, condition, "include",
                     keep=["bene_id", "admission_date"])
    if not keep_null_id:
        hits = hits.where(F.col("bene_id").isNotNull())
    return hits.groupBy("bene_id").agg(F.min("admission_date").alias("ever"))

"""Claims rule per entity.

``met`` = the entity has an event in a look-back window file passing the
condition's position rule on its include codes, and is not in the exclusion
set.  Exclusion works like SQL ``NOT IN (subquery)``:

* an exclusion hit anywhere in the array removes the entity (not the event);
* ``exclusion_scope="oldest_year"`` (default) reads only the oldest file of the
  window, as the original jobs did; ``"window"`` reads the whole window;
* a NULL id in the exclusion set means nobody meets the rule; a NULL entity id
  survives only when the exclusion set is empty.

Include and exclusion hits come from one scan and one aggregation per entity
(``operators/per_id.py``): no anti join, no null-aware join, no nested loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookback.operators.per_id import met_flag, per_id
from lookback.sources.codebook import Codebook


def met(events: DataFrame, codebook: Codebook, condition: str, ref_year: int,
        first_year: int, exclusion_scope: str = "oldest_year",
        criteria: str | None = None) -> DataFrame:
    """``bene_id, met`` (met = 1) for entities meeting the claims rule in ``ref_year``."""
    table = per_id(events, codebook, condition, ref_year, first_year, exclusion_scope, criteria)
    return met_flag(table).where(F.col("met") == 1).select("bene_id", "met")

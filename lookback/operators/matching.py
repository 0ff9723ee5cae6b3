"""Code matching on event arrays.

Events are unnested once with their 0-based position and matched against code
rows by an equi-join on the code (broadcast when the code set's counted size
allows).  Position rules are a comparison of the position with the highest
position the rule accepts: ``all`` any, ``primary`` 0, ``first_two`` 0 or 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookback.functions.codes import code_at, rule_max_pos
from lookback.sources.codebook import Codebook, normalize_code

EVENT_KEYS = ["bene_id", "admission_date", "file_year"]


def unnest_codes(events: DataFrame, normalize: bool = False, keep: list[str] | None = None,
                 among: list[str] | None = None) -> DataFrame:
    """One row per array element: ``bene_id, admission_date, file_year, pos, code``.

    NULL and empty arrays give no rows; NULL elements are kept (they match nothing).
    Events already in long form (columns ``pos`` - 0-based position - and
    ``code`` instead of the ``diagnoses`` array) pass through unchanged.

    ``among`` (a list, of constant size) keeps only events that hold one of these codes: an array is
    looked at before it is unnested, a code of the long form where it is read.
    """
    cols = list(keep) if keep is not None else EVENT_KEYS
    if "diagnoses" in events.columns:
        if among is not None:
            plain = (lambda x: normalize_code(x)) if normalize else (lambda x: x)
            events = events.where(F.exists("diagnoses", lambda x: plain(x).isin(among)) if among else F.lit(False))
        out = events.select(*cols, F.posexplode("diagnoses").alias("pos", "code"))
    elif {"pos", "code"} <= set(events.columns):
        if among is not None and not normalize:
            events = events.where(F.col("code").isin(among) if among else F.lit(False))
        out = events.select(*cols, F.col("pos").cast("int").alias("pos"), "code")
    else:
        raise ValueError("events need a 'diagnoses' array or long-form 'pos' and 'code' columns")
    if normalize:
        out = out.withColumn("code", normalize_code(F.col("code")))
    return out


def leading_codes(events: DataFrame, n: int, normalize: bool = False, keep: list[str] | None = None) -> DataFrame:
    """The first ``n`` array elements as rows (``pos`` from 0), without unnesting the rest."""
    cols = list(keep) if keep is not None else EVENT_KEYS
    first = F.array(*[F.struct(F.lit(i).alias("pos"), code_at("diagnoses", i + 1).alias("code")) for i in range(n)])
    out = events.select(*cols, F.inline(first))
    if normalize:
        out = out.withColumn("code", normalize_code(F.col("code")))
    return out


def coded_rows(events: DataFrame, codebook: Codebook, condition: str) -> DataFrame:
    """Unnested rows whose code is in the condition's include or exclude list, with its ``kind``.

    A code in both lists gives two rows.  The code table is sent to the scan when
    its counted bytes allow, else both sides are shuffled on the code (frequent
    ones are split).
    """
    codes = codebook.codes.where(F.col("condition") == condition).select("code", "kind")
    rows = unnest_codes(events, codebook.normalize, among=codebook.constant_codes([condition]))
    return codebook.match(rows, codes)


def code_hits(events: DataFrame, codebook: Codebook, condition: str, kind: str = "include",
              keep: list[str] | None = None) -> DataFrame:
    """Unnested rows whose code is in the condition's include (or exclude) list."""
    codes = (codebook.include_codes(condition) if kind == "include"
             else codebook.exclude_codes(condition)).select("code")
    return codebook.match(unnest_codes(events, codebook.normalize, keep, codebook.constant_codes([condition], (kind,))), codes)


def match_codes(events: DataFrame, codebook: Codebook, condition: str,
                criteria: str | None = None) -> DataFrame:
    """Events passing the claims rule, DISTINCT per file: ``bene_id, admission_date, file_year``.

    ``criteria`` overrides the codebook's rule of the condition.
    """
    rule = criteria or codebook.spec(condition).criteria
    max_pos = rule_max_pos(rule)
    if max_pos < rule_max_pos("all") and "diagnoses" in events.columns:
        # a position rule on an array looks at its first elements only
        codes = codebook.include_codes(condition).select("code")
        hits = codebook.match(leading_codes(events, max_pos + 1, codebook.normalize), codes)
    else:
        hits = code_hits(events, codebook, condition, "include")
        if max_pos < rule_max_pos("all"):
            hits = hits.where(F.col("pos") <= max_pos)
    return hits.select(*EVENT_KEYS).distinct()

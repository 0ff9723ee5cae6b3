"""Column functions.

All are built-in expressions, so they stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Highest 0-based array position a claims rule accepts.
RULE_MAX_POS = {"all": 2_147_483_647, "primary": 0, "first_two": 1}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def overlaps(col, codes: Iterable[str]) -> Column:
    """Array shares at least one element with ``codes`` (array ``&&``), no unnest.

    Each element is looked up in a constant set, however many codes there are.

    NULL elements give NULL when nothing matches, which a filter treats as false.
    """
    codes = [str(c) for c in codes]
    if not codes:
        raise ValueError("codes must not be empty")
    return F.exists(_col(col), lambda x: x.isin(codes))


def code_at(col, position: int) -> Column:
    """1-based array element, NULL when out of range (never raises under ANSI)."""
    if position < 1:
        raise ValueError("positions are 1-based")
    return F.get(_col(col), position - 1)


def rule_max_pos(criteria: str) -> int:
    try:
        return RULE_MAX_POS[criteria]
    except KeyError:
        raise ValueError(f"unknown claims_criteria {criteria!r}") from None


def rule_max_pos_col(criteria_col) -> Column:
    """The rule of a codebook row as the highest 0-based position it accepts."""
    c = _col(criteria_col)
    expr = None
    for name, pos in RULE_MAX_POS.items():
        expr = F.when(c == name, F.lit(pos)) if expr is None else expr.when(c == name, F.lit(pos))
    return expr


def status_code(met, cov) -> Column:
    """Four-valued status from the claims flag and the coverage flag.

    (0,0)->0, (1,0)->1, (0,1)->2, anything else (including a NULL flag)->3.
    """
    m, c = _col(met), _col(cov)
    return (F.when((m == 0) & (c == 0), 0)
            .when((m == 1) & (c == 0), 1)
            .when((m == 0) & (c == 1), 2)
            .otherwise(3).cast("int"))


def coverage_flag(hmo_sum) -> Column:
    """1 when the HMO months of the window add up to 0, else 0 (NULL sum -> 0)."""
    return F.when(_col(hmo_sum) == 0, 1).otherwise(0).cast("int")


def fill_zero(col) -> Column:
    return F.coalesce(_col(col), F.lit(0)).cast("int")

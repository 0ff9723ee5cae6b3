"""All conditions x all reference years in one pass.

Instead of one job per (condition, year) re-reading up to three event files and
every earlier year, the grid is one plan:

1. *facts*: events of the file years ``[first_year, last]`` are unnested once,
   matched against the whole codebook by a broadcast equi-join on the code, and
   unioned with the enrolment rows.  One aggregation per ``(bene_id, file_year)``
   (partial before the shuffle) gives per file year: a bitmask of conditions with
   a rule-passing include hit, a bitmask of conditions with an exclusion hit, the
   first include date per condition, the sum of HMO months and whether the key
   has enrolment rows.  A hot id or code is collapsed map-side here.
2. *windows*: one ``Window.partitionBy("bene_id").orderBy("file_year")`` pass (at
   most one row per id and file year) evaluates range frames: ``bit_or`` of the
   include mask over the last ``p`` years (one frame per distinct look-back
   ``p``), the exclusion mask at the oldest window year (or over the window),
   the HMO sum over the window, and the running minimum of each first date.
3. *NULL guards* of the ``NOT IN`` semantics come from a per-file-year global
   aggregate over the same facts (at most one row per year, broadcast by that
   proven bound); they are always planned, and share the facts' exchange.
4. the per-(id, file year) results are joined back to the enrolment rows of the
   requested years (the spine), so duplicate enrolment rows each get their row: equal
   ones are counted before the join (in the tasks that read them) and made again after
   it, so an id repeated by many copies is no hot key of it.

Output (wide): ``bene_id, rfrnc_yr`` and per condition ``{c}`` (status 0-3) and
``{c}_ever``.  ``feature_grid_long`` stacks it to
``bene_id, rfrnc_yr, condition, status, ever``.

The per-condition expression families (masks, dates, statuses) are written as
Spark SQL expression text over generated column names, so a plan for dozens of
conditions is built with a few JVM calls instead of thousands; codebook codes
never enter that text, they travel as rows of the broadcast code table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lookback.functions.codes import rule_max_pos_col
from lookback.operators.matching import unnest_codes
from lookback.sources.codebook import EXCLUDE, Codebook

# Bits used per LONG mask column (the sign bit is left alone).
MASK_BITS = 62


def _mask_layout(n: int) -> int:
    return (n + MASK_BITS - 1) // MASK_BITS


def _ident(name: str) -> str:
    """A column name quoted for SQL expression text."""
    return "`" + name.replace("`", "``") + "`"


def _bit(i: int) -> int:
    return 1 << (i % MASK_BITS)


def _period_masks(codebook: Codebook) -> dict[int, list[int]]:
    """For each look-back p: per mask column, the bits of conditions with that p."""
    n_masks = _mask_layout(len(codebook.conditions))
    out: dict[int, list[int]] = {}
    for i, spec in enumerate(codebook.conditions):
        masks = out.setdefault(spec.ref_period, [0] * n_masks)
        masks[i // MASK_BITS] |= _bit(i)
    return out


def _indexed_codes(codebook: Codebook) -> DataFrame:
    """Code rows with the condition's index in the codebook and its rule."""
    idx = None
    for i, spec in enumerate(codebook.conditions):
        cond = F.col("condition") == spec.name
        idx = F.when(cond, F.lit(i)) if idx is None else idx.when(cond, F.lit(i))
    codes = codebook.codes.select("code", (F.col("kind") == EXCLUDE).alias("is_exc"),
                                  idx.alias("cidx"), rule_max_pos_col("criteria").alias("max_pos"))
    return codes


def grid_facts(events: DataFrame, enrol: DataFrame, codebook: Codebook, first_year: int,
               last_year: int, enrol_from: int | None = None) -> DataFrame:
    """Step 1: one row per ``(bene_id, file_year)`` seen in the events or the enrolment.

    Enrolment is read from ``enrol_from`` on (default ``first_year``).
    """
    n = len(codebook.conditions)
    has_excl = any(s.n_exclude > 0 for s in codebook.conditions)
    span = F.col("file_year").between(first_year, last_year)

    rows = unnest_codes(events.where(span), codebook.normalize, among=codebook.constant_codes())
    hits = (codebook.match(rows, _indexed_codes(codebook))
            .select("bene_id", "file_year", "admission_date", "pos", "is_exc", "cidx", "max_pos",
                    F.lit(0).alias("is_enrol")))
    date_type = hits.schema["admission_date"].dataType.simpleString()
    months = enrol.schema["hmo_mo"].dataType.simpleString()  # kept: fractions of months count
    hits = hits.withColumn("hmo_mo", F.lit(None).cast(months))
    rows = enrol.where(F.col("file_year").between(enrol_from or first_year, last_year)).selectExpr(
        "bene_id", "file_year", f"CAST(NULL AS {date_type}) AS admission_date",
        "CAST(NULL AS INT) AS pos", "CAST(NULL AS BOOLEAN) AS is_exc", "CAST(NULL AS INT) AS cidx",
        "CAST(NULL AS INT) AS max_pos", "hmo_mo", "1 AS is_enrol")
    both = hits.unionByName(rows)

    inc, exc = "NOT is_exc", "is_exc"
    bit = f"shiftleft(CAST(1 AS BIGINT), cidx % {MASK_BITS})"
    aggs = []
    for k in range(_mask_layout(n)):
        grp = f"cidx div {MASK_BITS} = {k}"
        aggs.append(f"bit_or(CASE WHEN {inc} AND pos <= max_pos AND {grp} THEN {bit} END) AS q{k}")
        if has_excl:
            aggs.append(f"bit_or(CASE WHEN {exc} AND {grp} THEN {bit} END) AS x{k}")
    aggs += [f"min(CASE WHEN {inc} AND cidx = {i} THEN admission_date END) AS d{i}" for i in range(n)]
    aggs += ["sum(hmo_mo) AS hmo", "max(is_enrol) AS enrolled"]
    return both.groupBy("bene_id", "file_year").agg(*[F.expr(a) for a in aggs])


def _null_guards(facts: DataFrame, codebook: Codebook, first_year: int, last_year: int,
                 scope: str) -> DataFrame:
    """Per reference year: which conditions have a non-empty exclusion set
    (``ne{k}``) and which have a NULL id in it (``nn{k}``).  <= one row per year."""
    n_masks = _mask_layout(len(codebook.conditions))
    # ``read`` counts by a hash of all columns: this branch then needs what the other one needs, and
    # both share one exchange, so events and enrolment are read once for both.
    every = F.xxhash64(*[F.col(c) for c in facts.columns])
    per_year = facts.groupBy("file_year").agg(
        F.count(F.when(every == 0, 1)).alias("read"),
        *[F.expr(f"bit_or(x{k}) AS ga{k}") for k in range(n_masks)],
        *[F.expr(f"bit_or(CASE WHEN bene_id IS NULL THEN x{k} END) AS gn{k}") for k in range(n_masks)])
    parts = []
    for p, masks in _period_masks(codebook).items():
        # ref years whose exclusion file is this file year f
        if scope == "window":
            lo = "file_year"
        else:  # the oldest window year is f for ref year f+p-1, or first_year for several
            lo = f"CASE WHEN file_year = {first_year} THEN file_year ELSE file_year + {p - 1} END"
        hi = f"least(file_year + {p - 1}, {last_year})"
        parts.append(per_year.selectExpr(
            f"explode(sequence({lo}, greatest({lo}, {hi}))) AS ref_year", "read",
            *[f"ga{k} & CAST({masks[k]} AS BIGINT) AS ne{k}" for k in range(n_masks)],
            *[f"gn{k} & CAST({masks[k]} AS BIGINT) AS nn{k}" for k in range(n_masks)],
        ).where(F.col("ref_year") <= last_year))
    allp = parts[0]
    for extra in parts[1:]:
        allp = allp.unionByName(extra)
    return allp.groupBy("ref_year").agg(
        F.max("read").alias("read"),
        *[F.expr(f"bit_or(ne{k}) AS ne{k}") for k in range(n_masks)],
        *[F.expr(f"bit_or(nn{k}) AS nn{k}") for k in range(n_masks)])


def _window_columns(codebook: Codebook, first_year: int, scope: str, has_excl: bool) -> list:
    """Step 2: the windowed columns, one frame family per distinct look-back."""
    w = Window.partitionBy("bene_id").orderBy("file_year")
    running = w.rangeBetween(Window.unboundedPreceding, 0)
    n_masks = _mask_layout(len(codebook.conditions))
    cols = []
    for p in sorted({s.ref_period for s in codebook.conditions}):
        frame = w.rangeBetween(-(p - 1), 0)
        cols.append(F.sum("hmo").over(frame).alias(f"hmo_p{p}"))
        for k in range(n_masks):
            cols.append(F.bit_or(f"q{k}").over(frame).alias(f"m{k}_p{p}"))
            if not has_excl:
                continue
            if scope == "window":
                ex = F.bit_or(f"x{k}").over(frame)
            elif p == 1:
                ex = F.bit_or(f"x{k}").over(w.rangeBetween(0, 0))
            else:
                at_start = F.bit_or(f"x{k}").over(w.rangeBetween(-(p - 1), -(p - 1)))
                at_first = F.bit_or(F.expr(f"CASE WHEN file_year = {first_year} THEN x{k} END")) \
                    .over(running)
                ex = F.when(F.col("file_year") - (p - 1) >= first_year, at_start).otherwise(at_first)
            cols.append(ex.alias(f"e{k}_p{p}"))
    for i in range(len(codebook.conditions)):
        cols.append(F.min(f"d{i}").over(running).alias(f"ever{i}"))
    return cols


def _status_exprs(codebook: Codebook, has_excl: bool) -> tuple[list[str], list[str]]:
    """Two projections: before the spine join, per look-back p a combined claims
    mask and a coverage term (a few columns, whatever the number of
    conditions); after it, per condition its status and first date.

    In the grid the claims flag is 0/1 and the coverage flag is never NULL
    (every spine key has its own enrolment row in the window), so the status
    table (0,0)->0, (1,0)->1, (0,1)->2, (1,1)->3 is exactly ``met + 2 * cov``.
    """
    n_masks = _mask_layout(len(codebook.conditions))
    first = ["bene_id AS _rid", "file_year AS _ryear"]
    for p in sorted({s.ref_period for s in codebook.conditions}):
        first.append(f"CASE WHEN hmo_p{p} = 0 THEN 2 ELSE 0 END AS cov2_p{p}")
        for k in range(n_masks):
            mask = f"coalesce(m{k}_p{p}, 0)"
            if has_excl:
                mask += (f" & ~coalesce(e{k}_p{p}, 0) & ~coalesce(nn{k}, 0)"
                         f" & CASE WHEN bene_id IS NULL THEN ~coalesce(ne{k}, 0)"
                         f" WHEN read < 0 THEN 0 ELSE -1 END")
            first.append(f"{mask} AS met{k}_p{p}")
    second = ["bene_id", "rfrnc_yr"]
    for i, spec in enumerate(codebook.conditions):
        k, p = i // MASK_BITS, spec.ref_period
        second.append(f"CAST(shiftright(met{k}_p{p}, {i % MASK_BITS}) & 1 AS INT) + cov2_p{p} "
                      f"AS {_ident(spec.name)}")
        second.append(f"CASE WHEN bene_id IS NULL THEN NULL ELSE ever{i} END AS "
                      f"{_ident(spec.name + '_ever')}")
    return first + [f"ever{i}" for i in range(len(codebook.conditions))], second


def checked_years(years, first_year: int, exclusion_scope: str, rfrnc_yr: str) -> list[int]:
    """The reference years in order; raises where they or the named modes make no grid."""
    if rfrnc_yr not in ("year", "file_year"):
        raise ValueError(f"rfrnc_yr must be 'year' or 'file_year', got {rfrnc_yr!r}")
    if exclusion_scope not in ("oldest_year", "window"):
        raise ValueError(f"exclusion_scope must be 'oldest_year' or 'window', got {exclusion_scope!r}")
    years = sorted({int(y) for y in years})
    if not years:
        raise ValueError("no reference years")
    if years[0] < int(first_year):
        raise ValueError(f"empty look-back window: ref_year={years[0]} is before "
                         f"first_year={first_year}")
    return years


def feature_grid(events: DataFrame, enrol: DataFrame, codebook: Codebook, years,
                 first_year: int, exclusion_scope: str = "oldest_year",
                 rfrnc_yr: str = "year") -> DataFrame:
    """Wide features of every enrolment row of ``years``, all codebook conditions.

    ``rfrnc_yr`` is the row's ``year`` column (as in the per-pair tables) or, with
    ``"file_year"``, the year of its file (as in the merged matrix).
    """
    years = checked_years(years, first_year, exclusion_scope, rfrnc_yr)
    first_year = int(first_year)
    # The windows of the first year asked for are the oldest enrolment needed.
    facts = grid_facts(events, enrol, codebook, first_year, years[-1], oldest_window(codebook, years, first_year))
    return grid_of_facts(facts, enrol, codebook, years, first_year, exclusion_scope, rfrnc_yr)


def oldest_window(codebook: Codebook, years: list[int], first_year: int) -> int:
    """The oldest file year in the window of any of ``years``."""
    return max(first_year, min(years) - max(s.ref_period for s in codebook.conditions) + 1)


def grid_of_facts(facts: DataFrame, enrol: DataFrame, codebook: Codebook, years: list[int], first_year: int,
                  exclusion_scope: str, rfrnc_yr: str) -> DataFrame:
    """Steps 2 to 4 on facts that hold the windows of ``years`` and, for the first dates, what is before them."""
    last_year = max(years)
    has_excl = any(s.n_exclude > 0 for s in codebook.conditions)
    fy = F.col("file_year")
    # Rows with nothing to tell go here; the filter also keeps the window inputs out of the aggregation,
    # whose functions then stand in the same order here and in the guards: they share its exchange.
    told = [F.col(c).isNotNull().cast("int") for c in facts.columns if c not in ("bene_id", "file_year", "hmo", "enrolled")]
    some = facts.where(F.greatest(*told, F.col("enrolled")) == 1)
    win = (some.select("bene_id", "file_year", "enrolled",
                        *_window_columns(codebook, first_year, exclusion_scope, has_excl))
           .where((F.col("enrolled") == 1) & fy.isin(years)))

    if has_excl:
        guards = _null_guards(facts, codebook, first_year, last_year, exclusion_scope)
        win = win.join(F.broadcast(guards), fy == F.col("ref_year"), "left").drop("ref_year")

    first, second = _status_exprs(codebook, has_excl)
    per_key = win.selectExpr(*first)

    # Step 4: one output row per enrolment row of the requested years.  Rows that repeat an id are
    # counted before the join, so an id with millions of them is one row of it, and made again behind it.
    spine = (enrol.where(fy.isin(years)).selectExpr("bene_id", "file_year", f"CAST({rfrnc_yr} AS INT) AS rfrnc_yr")
             .groupBy("bene_id", "file_year", "rfrnc_yr").agg(F.count(F.lit(1)).alias("_copies")))
    joined = spine.join(per_key, spine["bene_id"].eqNullSafe(per_key["_rid"])
                        & (spine["file_year"] == per_key["_ryear"]), "left")
    return repeated(joined.selectExpr(*second, "_copies"), "_copies")


#: Copies that one array of row numbers stands for: it bounds the array, whatever the number of copies.
COPIES = 1000


def repeated(df: DataFrame, times: str) -> DataFrame:
    """Each row ``times`` times, without that column."""
    blocks = df.withColumn("_block", F.explode(F.expr(f"sequence(0L, ({times} - 1) div {COPIES})")))
    copies = F.expr(f"sequence(1, CAST(least({COPIES}L, {times} - _block * {COPIES}) AS INT))")
    return blocks.withColumn("_copy", F.explode(copies)).drop(times, "_block", "_copy")


def feature_grid_long(events: DataFrame, enrol: DataFrame, codebook: Codebook, years,
                      first_year: int, exclusion_scope: str = "oldest_year") -> DataFrame:
    """Long form ``bene_id, rfrnc_yr, condition, status, ever`` of :func:`feature_grid`."""
    wide = feature_grid(events, enrol, codebook, years, first_year, exclusion_scope)
    return stack_conditions(wide, codebook.names)


def stack_conditions(wide: DataFrame, names: list[str]) -> DataFrame:
    """Unpivot ``{c}, {c}_ever`` column pairs to ``condition, status, ever`` rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("condition"), F.col(_ident(c)).alias("status"),
                               F.col(_ident(f"{c}_ever")).alias("ever")) for c in names])
    return (wide.select("bene_id", "rfrnc_yr", F.explode(pairs).alias("s"))
            .select("bene_id", "rfrnc_yr", "s.condition", "s.status", "s.ever"))

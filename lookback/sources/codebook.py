"""Codebook source (O03, O54) and its exclusion-list modes (quirk Q2).

The codebook is a JSON object ``{condition: entry}`` whose key order is the
order of the conditions.  An entry has ``ref_period`` (look-back years),
optional ``claims_criteria`` (``all`` by default, else ``primary`` or
``first_two``), the include lists ``icd9`` and ``icd10`` and optional exclusion
lists ``icd9_exclusion`` and ``icd10_exclusion``.

The file is parsed by Spark (``from_json`` into a map, ``posexplode`` of its
entries keeps key order) into the long ``codes`` table
``(cond_pos, condition, ref_period, criteria, kind, code)`` with ``kind`` in
``include`` / ``exclude``.  Only the per-condition header (a few dozen rows) is
brought to the driver: names, periods and rules are needed to shape plans.
The code rows stay a DataFrame; they are broadcast only when their counted
bytes are under ``broadcast_bytes``, else joined by a shuffle on the code.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lookback.operators.salting import salted_join
from lookback.schemas import CODEBOOK

# The claims rules a codebook may name.
CRITERIA = ("all", "primary", "first_two")
# The kinds of code rows.
INCLUDE, EXCLUDE = "include", "exclude"

# Code tables up to this size are broadcast to the event scan.  Both ways give the same rows.
BROADCAST_BYTES = 64 << 20
# Conditions (or books) of up to so many codes filter arrays before they are unnested: the codes are constants of the plan.
CONSTANT_CODES = 256
# Bytes of a code row besides its texts, as an estimate from above (row header, offsets, hash entry).
ROW_BYTES = 128


@dataclass(frozen=True)
class ConditionSpec:
    name: str
    pos: int
    ref_period: int
    criteria: str
    n_include: int
    n_exclude: int
    n_bytes: int = 0


@dataclass
class Codebook:
    """Parsed codebook: driver-side header plus the ``codes`` DataFrame."""

    codes: DataFrame
    conditions: list[ConditionSpec]
    exclusion_codes: str = "compat"
    normalize: bool = False
    n_bytes: int = 0
    broadcast_bytes: int = BROADCAST_BYTES
    # (condition, kind) -> its codes as they are matched, for conditions of at most CONSTANT_CODES
    constants: dict[tuple[str, str], list[str]] = field(default_factory=dict, repr=False)
    _by_name: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self._by_name = {c.name: c for c in self.conditions}

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.conditions]

    def spec(self, condition: str) -> ConditionSpec:
        try:
            return self._by_name[condition]
        except KeyError:
            raise ValueError(f"unknown condition {condition!r}; codebook has {self.names}") from None

    def select(self, conditions) -> "Codebook":
        """Codebook restricted to ``conditions`` (keeps codebook order)."""
        wanted = set(conditions)
        for c in wanted:
            self.spec(c)
        specs = [c for c in self.conditions if c.name in wanted]
        codes = self.codes.where(F.col("condition").isin(sorted(wanted)))
        return Codebook(codes, specs, self.exclusion_codes, self.normalize, sum(c.n_bytes for c in specs), self.broadcast_bytes,
                        {k: v for k, v in self.constants.items() if k[0] in wanted})

    def constant_codes(self, conditions=None, kinds=(INCLUDE, EXCLUDE)) -> list[str] | None:
        """The codes of ``conditions`` (all by default) as a list, or None if they are more than CONSTANT_CODES."""
        out: set[str] = set()
        for name in self.names if conditions is None else conditions:
            for kind in kinds:
                if (name, kind) not in self.constants:
                    return None
                out.update(self.constants[name, kind])
        return sorted(out) if len(out) <= CONSTANT_CODES else None

    def match(self, rows: DataFrame, codes: DataFrame) -> DataFrame:
        """``rows`` (with a ``code``) joined with ``codes``, rows of this book.

        The codes are sent to the rows if the whole book is small enough, else both are shuffled, hot codes split.
        """
        if self.n_bytes <= self.broadcast_bytes:
            return rows.join(F.broadcast(codes), "code")
        return salted_join(rows, codes, "code")

    def include_codes(self, condition: str) -> DataFrame:
        return self.codes.where((F.col("condition") == condition) & (F.col("kind") == INCLUDE))

    def exclude_codes(self, condition: str) -> DataFrame:
        return self.codes.where((F.col("condition") == condition) & (F.col("kind") == EXCLUDE))


def normalize_code(col: Column) -> Column:
    """Optional code normalisation: drop dots, upper case (off by default)."""
    return F.upper(F.regexp_replace(col, r"\.", ""))


def _empty() -> Column:
    return F.array().cast("array<string>")


def _arr(col: str) -> Column:
    return F.coalesce(F.col(col), _empty())


def _exclusion_list(mode: str) -> Column:
    icd9, icd10 = _arr("e.icd9_exclusion"), _arr("e.icd10_exclusion")
    if mode == "all":
        return F.concat(icd9, icd10)
    if mode != "compat":
        raise ValueError(f"exclusion_codes must be 'compat' or 'all', got {mode!r}")
    # compat: both lists -> every code; only ICD-10 -> its first code only;
    # only ICD-9 -> no exclusion at all.
    return (F.when((F.size(icd9) > 0) & (F.size(icd10) > 0), F.concat(icd9, icd10))
            .when(F.size(icd10) > 0, F.slice(icd10, 1, 1))
            .otherwise(_empty()))


def codebook_frame(spark: SparkSession, source) -> DataFrame:
    """One row ``value`` holding the whole JSON text of the codebook.

    ``source`` is a path (read by Spark as one whole text) or a dict / JSON string.
    """
    if isinstance(source, dict):
        return spark.createDataFrame([(json.dumps(source),)], "value string")
    if isinstance(source, str) and source.lstrip().startswith("{"):
        return spark.createDataFrame([(source,)], "value string")
    return spark.read.text(source, wholetext=True)


def read_codebook(spark: SparkSession, source, exclusion_codes: str = "compat",
                  normalize: bool = False, broadcast_bytes: int = BROADCAST_BYTES) -> Codebook:
    """Parse a codebook into a :class:`Codebook`.

    ``exclusion_codes="compat"`` reproduces how the original jobs built the
    exclusion list (see module doc); ``"all"`` uses both lists in full.
    ``normalize=True`` strips dots and upper-cases codes on both sides.
    """
    raw = codebook_frame(spark, source)
    entries = (raw.select(F.from_json("value", CODEBOOK).alias("m"))
               .select(F.posexplode(F.map_entries("m")).alias("cond_pos", "kv"))
               .select("cond_pos", F.col("kv.key").alias("condition"), F.col("kv.value").alias("e")))
    header = entries.select(
        F.col("cond_pos").cast("int").alias("cond_pos"),
        "condition",
        F.col("e.ref_period").alias("ref_period"),
        F.coalesce(F.col("e.claims_criteria"), F.lit("all")).alias("criteria"),
        F.concat(_arr("e.icd9"), _arr("e.icd10")).alias("include"),
        _exclusion_list(exclusion_codes).alias("exclude"),
    )
    # The header is one row per condition: a bounded, config-sized collect.
    rows = header.select(
        "cond_pos", "condition", "ref_period", "criteria",
        F.size(F.array_distinct(F.filter("include", lambda x: x.isNotNull()))).alias("n_inc"),
        F.size(F.array_distinct(F.filter("exclude", lambda x: x.isNotNull()))).alias("n_exc"),
        F.aggregate(F.concat("include", "exclude"), F.lit(0).cast("long"),
                    lambda a, x: a + ROW_BYTES + F.coalesce(F.octet_length(x), F.lit(0))).alias("n_bytes"),
        *[F.when(F.size("include") + F.size("exclude") <= CONSTANT_CODES, _as_matched(kind, normalize)).alias(f"all_{kind}")
          for kind in (INCLUDE, EXCLUDE)],
    ).orderBy("cond_pos").collect()
    specs = _specs(rows)
    constants = {(r.condition, kind): r[f"all_{kind}"] for r in rows for kind in (INCLUDE, EXCLUDE) if r[f"all_{kind}"] is not None}

    code = F.col("code")
    if normalize:
        code = normalize_code(code)
    inc = header.select("cond_pos", "condition", "ref_period", "criteria",
                        F.lit(INCLUDE).alias("kind"), F.explode("include").alias("code"))
    exc = header.select("cond_pos", "condition", "ref_period", "criteria",
                        F.lit(EXCLUDE).alias("kind"), F.explode("exclude").alias("code"))
    codes = (inc.unionByName(exc)
             .withColumn("code", code)
             .where(F.col("code").isNotNull())
             .distinct())  # position, period and rule follow from the condition
    return Codebook(codes, specs, exclusion_codes, normalize, sum(s.n_bytes for s in specs), broadcast_bytes, constants)


def _as_matched(kind: str, normalize: bool) -> Column:
    """A list of codes as events are compared with it."""
    codes = F.filter(kind, lambda x: x.isNotNull())
    return F.array_distinct(F.transform(codes, normalize_code) if normalize else codes)


def _specs(rows) -> list[ConditionSpec]:
    """The header rows of a codebook, in order, as specs; raises on what no plan can be made of."""
    names = [r.condition for r in rows]
    if len(names) != len(set(names)):
        raise ValueError("codebook source holds a condition more than once "
                         "(several codebook files under one path?)")
    specs = []
    for r in rows:
        if r.ref_period is None or int(r.ref_period) < 1:
            raise ValueError(f"condition {r.condition!r}: ref_period must be a positive integer")
        if r.criteria not in CRITERIA:
            raise ValueError(f"condition {r.condition!r}: unknown claims_criteria {r.criteria!r}")
        specs.append(ConditionSpec(r.condition, int(r.cond_pos), int(r.ref_period),
                                   r.criteria, int(r.n_inc), int(r.n_exc), int(r.n_bytes)))
    if not specs:
        raise ValueError("codebook has no conditions")
    return specs


# The versions that code rows may name.
VERSIONS = ("icd9", "icd10")


def codebook_from_tables(conditions: DataFrame, codes: DataFrame, exclusion_codes: str = "compat",
                         normalize: bool = False, broadcast_bytes: int = BROADCAST_BYTES) -> Codebook:
    """A :class:`Codebook` out of tables, as :func:`read_codebook` makes it of JSON.

    ``conditions``: ``condition, ref_period``, their order ``cond_pos`` and optionally ``claims_criteria``.
    ``codes``: one row for each code, ``condition, version`` (``icd9`` / ``icd10``), ``kind`` (``include`` / ``exclude``),
    ``code`` and ``code_pos``, its place in its list, as ``code_text.parse_code_text`` gives them.  Rows of conditions that
    ``conditions`` doesn't have raise.

    The codes stay a table of any size: they are counted by condition, and only the header, one row
    for each condition, is brought to the driver (with the codes of conditions of at most CONSTANT_CODES).
    """
    if exclusion_codes not in ("compat", "all"):
        raise ValueError(f"exclusion_codes must be 'compat' or 'all', got {exclusion_codes!r}")
    rule = F.coalesce(F.col("claims_criteria"), F.lit("all")) if "claims_criteria" in conditions.columns else F.lit("all")
    header = conditions.select(F.col("cond_pos").cast("int").alias("cond_pos"), "condition",
                               F.col("ref_period").cast("int").alias("ref_period"), rule.alias("criteria"))
    rows = codes.select("condition", "version", "kind", "code", F.col("code_pos").cast("long").alias("code_pos"))
    # A few rows for each condition: which exclusion lists there are, and the first ICD-10 code of each.
    lists = rows.where(F.col("kind") == EXCLUDE).groupBy("condition").agg(
        F.count(F.when(F.col("version") == "icd9", 1)).alias("n9"), F.count(F.when(F.col("version") == "icd10", 1)).alias("n10"),
        F.min(F.when(F.col("version") == "icd10", F.col("code_pos"))).alias("first10"))
    known = header.select("condition", "cond_pos", "ref_period", "criteria")
    named = rows.join(F.broadcast(known.join(lists, "condition", "left")), "condition", "left")
    right = F.col("version").isin(*VERSIONS) & F.col("kind").isin(INCLUDE, EXCLUDE) & F.col("cond_pos").isNotNull()
    kept = F.col("kind") == INCLUDE
    if exclusion_codes == "all":
        kept = kept | (F.col("kind") == EXCLUDE)
    else:  # both lists: every code; ICD-10 alone: its first code; ICD-9 alone: none
        both = (F.col("n9") > 0) & (F.col("n10") > 0)
        first = (F.col("n10") > 0) & (F.col("code_pos") == F.col("first10")) & (F.col("version") == "icd10")
        kept = kept | ((F.col("kind") == EXCLUDE) & (both | first))
    bad = named.where(~F.coalesce(right, F.lit(False))).select("condition", "version", "kind", "code").limit(3).collect()
    if bad:
        raise ValueError(f"codebook: unknown version, kind or condition in {[tuple(r) for r in bad]}")
    named = named.where(kept)
    counted = named.groupBy("condition").agg(
        F.count_distinct(F.when(F.col("kind") == INCLUDE, F.col("code"))).alias("n_inc"),
        F.count_distinct(F.when(F.col("kind") == EXCLUDE, F.col("code"))).alias("n_exc"),
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.lit(ROW_BYTES) + F.coalesce(F.octet_length("code"), F.lit(0))).cast("long").alias("n_bytes"))
    specs = _specs(header.join(counted, "condition", "left").select(
        "cond_pos", "condition", "ref_period", "criteria", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_inc", "n_exc", "n_bytes")]
    ).orderBy("cond_pos").collect())
    code = normalize_code(F.col("code")) if normalize else F.col("code")
    table = (named.withColumn("code", code).where(F.col("code").isNotNull())
             .select("cond_pos", "condition", "ref_period", "criteria", "kind", "code").distinct())
    small = [s.name for s in specs if s.n_include + s.n_exclude <= CONSTANT_CODES]
    constants: dict[tuple[str, str], list[str]] = {(n, kind): [] for n in small for kind in (INCLUDE, EXCLUDE)}
    for r in table.where(F.col("condition").isin(small)).select("condition", "kind", "code").collect() if small else ():
        constants[r.condition, r.kind].append(r.code)  # at most CONSTANT_CODES for each condition
    return Codebook(table, specs, exclusion_codes, normalize, sum(s.n_bytes for s in specs), broadcast_bytes, constants)

"""History as a mergeable state: a new year reads its own files only.

The original read every earlier event file again for each year.  Here what a year's
files say about an entity is kept as tables of one folder:

* ``facts/file_year=Y``: one row per entity of that year's files (``grid.grid_facts``):
  masks of conditions with an include or an exclusion hit, first dates of the year,
  HMO months.  Two deliveries of one year merge by ``bit_or``, ``min`` and ``sum``;
* ``first/file_year=Y``: the first dates over all files up to Y, one row per entity
  seen so far.  It is last year's table and the year's facts, merged by ``min``;
* ``book``: one row with a digest of the codebook and the first year, so that no
  state is carried on with other codes, and the facts' schema; ``years``: the years put in.

A new year scans its own event and enrolment files, its window's facts (three years at
most in the known codebooks) and one table of first dates.  Running a year again gives the same
state: its partitions are replaced, and the first dates of later years are merged
again from facts, without reading events.  A lost executor or a failed job leaves
the partitions that were there.

Entities are keyed by id in every table, a row per id and year, so neither a hot id nor a hot
code reaches a task as raw rows.  A NULL id is an entity, as in the grid.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lookback.plans.grid import checked_years, grid_facts, grid_of_facts, oldest_window, stack_conditions
from lookback.schemas import check_schema
from lookback.sources.codebook import Codebook
from lookback.sources.sinks import write_features
from lookback.sources.yearly import in_years

def _date_columns(codebook: Codebook) -> list[str]:
    return [f"d{i}" for i in range(len(codebook.conditions))]


def book_digest(codebook: Codebook, first_year: int) -> str:
    """A digest of everything that facts depend on: conditions in order, rules, codes, modes, the first year."""
    header = [(c.name, c.ref_period, c.criteria) for c in codebook.conditions]
    row = codebook.codes.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("condition", "kind", "code").cast("decimal(38,0)")).alias("h")).first()
    text = repr((header, codebook.exclusion_codes, codebook.normalize, int(first_year), row["n"], str(row["h"])))
    return f"{len(codebook.conditions)} conditions, digest {_digest(text)}"


def _digest(text: str) -> str:
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest()


def merge_facts(parts: Sequence[DataFrame]) -> DataFrame:
    """Facts of the same entities and file years from several deliveries as one."""
    both = functools.reduce(lambda a, b: a.unionByName(b), parts)
    aggs = []
    for c in both.columns:
        if c in ("bene_id", "file_year"):
            continue
        how = F.sum if c == "hmo" else F.max if c == "enrolled" else F.min if c.startswith("d") else F.bit_or
        aggs.append(how(c).alias(c))
    return both.groupBy("bene_id", "file_year").agg(*aggs)


def _read(spark: SparkSession, path: str, part: str, schema: T.StructType | None = None) -> DataFrame | None:
    """A table of the state, or None before its first write; a ``schema`` also reads one that no row was written to."""
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(f"{path}/{part}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def state_years(spark: SparkSession, path: str) -> list[int]:
    """The file years that a state holds, in order; a year whose files say nothing of anyone is one of them."""
    held = _read(spark, path, "years", T.StructType([T.StructField("year", T.IntegerType())]))
    return [] if held is None else sorted({r["year"] for r in held.select("year").collect()})


def _schemas(spark: SparkSession, path: str, codebook: Codebook, first_year: int, facts: T.StructType | None = None) -> dict[str, T.StructType]:
    """The schemas of a state's tables; raises if it was made with another codebook.  ``facts``: that of a new state."""
    key = book_digest(codebook, first_year)
    held = _read(spark, path, "book")
    if held is None:
        if facts is None:
            raise ValueError(f"no state under {path}")
        spark.createDataFrame([(key, facts.json())], "book string, facts string").coalesce(1).write.parquet(f"{path}/book")
    else:
        rows = held.collect()
        if [r["book"] for r in rows] != [key]:
            raise ValueError(f"the state under {path} was made with another codebook or first year ({[r['book'] for r in rows]}, now {key})")
        facts = T.StructType.fromJson(json.loads(rows[0]["facts"]))
    dates = {"bene_id", "file_year", *_date_columns(codebook)}
    return {"facts": facts, "first": T.StructType([f for f in facts if f.name in dates])}


def year_facts(events: DataFrame, enrol: DataFrame, codebook: Codebook, years: Sequence[int]) -> DataFrame:
    """Facts of ``years`` from their files only."""
    return grid_facts(events, enrol, codebook, min(years), max(years))


def update_state(spark: SparkSession, path: str, events: DataFrame, enrol: DataFrame, codebook: Codebook,
                 years: int | Iterable[int], first_year: int, mode: str = "replace") -> None:
    """Put the files of ``years`` (one year, or a run of years) into the state under ``path``.

    ``replace`` makes the years' facts anew; ``add`` merges a further delivery of the same years into them.
    Years are put in without gaps, from ``first_year`` on.
    """
    if mode not in ("replace", "add"):
        raise ValueError(f"mode must be 'replace' or 'add', got {mode!r}")
    years = sorted({int(y) for y in ([years] if isinstance(years, int) else years)})
    if not years or years != list(range(years[0], years[-1] + 1)):
        raise ValueError(f"years must be a run of years, got {years}")
    check_schema(events, "events")
    check_schema(enrol, "enrolment")
    held = state_years(spark, path)
    if years[0] < first_year or (years[0] > first_year and years[0] - 1 not in held):
        raise ValueError(f"the state holds {held}; {years[0]} needs all years from {first_year} to {years[0] - 1} before it")
    facts = year_facts(events, enrol, codebook, years)
    schemas = _schemas(spark, path, codebook, first_year, facts.schema)
    if mode == "add":
        old = _read(spark, path, "facts", schemas["facts"])
        if old is not None:
            facts = merge_facts([old.where(in_years(years)).select(*facts.columns), facts])
    write_features(facts, f"{path}/facts", partition_by=("file_year",), replace=years)
    # First dates are carried from year to year; those of later years follow from what is kept.
    for year in range(years[0], max([*held, years[-1]]) + 1):
        _carry(spark, path, codebook, year, first_year, schemas)
    marks = spark.createDataFrame([(y, y) for y in years], "year int, file_year int")
    write_features(marks, f"{path}/years", partition_by=("file_year",))


def _carry(spark: SparkSession, path: str, codebook: Codebook, year: int, first_year: int, schemas: dict[str, T.StructType]) -> None:
    """Write the first dates up to ``year``: those up to the year before and the year's own, one row per entity."""
    dates = _date_columns(codebook)
    rows = _read(spark, path, "facts", schemas["facts"]).where(F.col("file_year") == year).select("bene_id", *dates)
    if year > first_year:
        rows = rows.unionByName(_read(spark, path, "first", schemas["first"]).where(F.col("file_year") == year - 1).select("bene_id", *dates))
    merged = rows.groupBy("bene_id").agg(*[F.min(d).alias(d) for d in dates]).withColumn("file_year", F.lit(year))
    write_features(merged, f"{path}/first", partition_by=("file_year",), replace=[year])


def state_facts(spark: SparkSession, path: str, codebook: Codebook, years: Sequence[int], first_year: int,
                schemas: dict[str, T.StructType]) -> DataFrame:
    """The facts that the grid of ``years`` needs: those of its windows, and first dates from before as rows of the year before."""
    lo = oldest_window(codebook, list(years), first_year)
    facts = _read(spark, path, "facts", schemas["facts"]).where(in_years(range(lo, max(years) + 1)))
    if lo > first_year:
        before = _read(spark, path, "first", schemas["first"]).where(F.col("file_year") == lo - 1)
        facts = facts.unionByName(before.withColumn("enrolled", F.lit(0)), allowMissingColumns=True)
    return facts


def state_grid(spark: SparkSession, path: str, enrol: DataFrame, codebook: Codebook, years, first_year: int,
               exclusion_scope: str = "oldest_year", rfrnc_yr: str = "year") -> DataFrame:
    """``grid.feature_grid`` of ``years`` out of the state; ``enrol`` gives the rows (its files of ``years``)."""
    years = checked_years(years, first_year, exclusion_scope, rfrnc_yr)
    missing = sorted(set(years) - set(state_years(spark, path)))
    if missing:
        raise ValueError(f"the state under {path} doesn't hold {missing}")
    facts = state_facts(spark, path, codebook, years, first_year, _schemas(spark, path, codebook, first_year))
    return grid_of_facts(facts, enrol, codebook, years, int(first_year), exclusion_scope, rfrnc_yr)


def state_grid_long(spark: SparkSession, path: str, enrol: DataFrame, codebook: Codebook, years, first_year: int,
                    exclusion_scope: str = "oldest_year") -> DataFrame:
    """Long form ``bene_id, rfrnc_yr, condition, status, ever`` of :func:`state_grid`."""
    return stack_conditions(state_grid(spark, path, enrol, codebook, years, first_year, exclusion_scope), codebook.names)

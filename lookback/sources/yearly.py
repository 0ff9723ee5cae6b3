"""Yearly file sources.

Inputs arrive as one file (or folder) per calendar year, ``{prefix}_{year}.parquet``.
The year of the *file* (not of any date inside it) decides which look-back
window a row falls in, so every reader adds an INT column ``file_year``.

Two layouts are supported:

* path list: ``read_years`` builds the paths of exactly the requested years
  (file-level pruning, as the year list of a job does) and recovers
  ``file_year`` from ``_metadata.file_path``;
* partitioned folder (``.../file_year=2003/part-*.parquet``): ``read_partitioned``
  filters the partition column, which Spark turns into ``PartitionFilters``.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_TEMPLATE = "{prefix}_{year}.parquet"


def window_years(ref_year: int, ref_period: int, first_year: int) -> list[int]:
    """Years of the look-back window, newest first, clipped at ``first_year``.

    ``[ref_year, ref_year-1, ..., ref_year-ref_period+1]`` without years before
    ``first_year``.  An empty window is an error (the job would have nothing to
    read).
    """
    ref_year, ref_period, first_year = int(ref_year), int(ref_period), int(first_year)
    if ref_period < 1:
        raise ValueError(f"ref_period must be >= 1, got {ref_period}")
    years = [ref_year - i for i in range(ref_period) if ref_year - i >= first_year]
    if not years:
        raise ValueError(f"empty look-back window: ref_year={ref_year} is before "
                         f"first_year={first_year}")
    return years


def history_years(ref_year: int, first_year: int) -> list[int]:
    """All years from ``first_year`` up to and including ``ref_year``."""
    ref_year, first_year = int(ref_year), int(first_year)
    years = list(range(first_year, ref_year + 1))
    if not years:
        raise ValueError(f"empty history: ref_year={ref_year} is before first_year={first_year}")
    return years


def year_paths(prefix: str, years: Iterable[int], template: str = DEFAULT_TEMPLATE) -> list[str]:
    """File names of the given years (the templating half of O53)."""
    return [template.format(prefix=prefix, year=int(y)) for y in years]


def _year_pattern(template: str, prefix: str = "") -> str:
    """Regex capturing the year from a scanned path built by ``template``.

    The yearly "file" may be a single file or a folder of part files, so the
    match ends at the end of the path or at a ``/``.
    """
    head, tail = template.split("{year}", 1)
    head = head.replace("{prefix}", prefix.rstrip("/").rsplit("/", 1)[-1])
    lead = "/" if head and "{prefix}" in template.split("{year}", 1)[0] else ""
    return lead + re.escape(head) + r"(\d{4})" + re.escape(tail) + "(?:/|$)"


def file_year_col(template: str = DEFAULT_TEMPLATE, prefix: str = "") -> Column:
    """``file_year`` recovered from the scanned file's path (inverse of O53)."""
    return F.regexp_extract(F.col("_metadata.file_path"), _year_pattern(template, prefix), 1).cast("int")


def read_years(spark: SparkSession, prefix: str, years: Iterable[int],
               schema: T.StructType | None = None,
               template: str = DEFAULT_TEMPLATE, ids: Sequence[str] = ("bene_id",)) -> DataFrame:
    """Scan the yearly Parquet files of ``years`` into one DataFrame + ``file_year``.

    Only the named files are opened; column pruning and filter pushdown still
    apply to each of them.  Rows of different files are kept apart by
    ``file_year`` (UNION ALL semantics: duplicates across files are kept).

    Files may differ in their columns and types.  Without ``schema`` the result has
    the columns of all years, whatever order the years come in (NULL where a year's
    file lacks one), each with the narrowest type that holds the values of every
    year (:func:`common_schema`).  A bigint beside a double becomes a double whose
    values are checked as they are read: one that a double can't hold raises.
    For ``ids`` no such pair is accepted.  With ``schema`` files are cast to it.
    """
    years = [int(y) for y in years]
    if not years:
        raise ValueError("no years to read")
    found = dict(zip(sorted(set(years)), _footers(spark, year_paths(prefix, sorted(set(years)), template))))
    target = schema if schema is not None else common_schema(found, ids)
    # Files of equal types are one scan.
    kinds: list[tuple[T.StructType, list[int]]] = []
    for year in years:
        for known, members in kinds:
            if known == found[year]:
                members.append(year)
                break
        else:
            kinds.append((found[year], [year]))
    parts = []
    for known, members in kinds:
        df = spark.read.schema(known).parquet(*year_paths(prefix, members, template))
        held = {f.name.lower(): f for f in known}
        parts.append(df.select(
            *[_cast(held.get(f.name.lower()), f, checked=schema is None) for f in target],
            file_year_col(template, prefix).alias("file_year")))
    return union_years(parts)


#: Footers read at once: each is a small Spark job of its own.
FOOTERS_AT_ONCE = 16


def _footers(spark: SparkSession, paths: Sequence[str]) -> list[T.StructType]:
    """The schema of each path; their footers are read at the same time."""
    if len(paths) == 1:
        return [spark.read.parquet(paths[0]).schema]
    with ThreadPoolExecutor(min(FOOTERS_AT_ONCE, len(paths))) as pool:
        return list(pool.map(lambda path: spark.read.parquet(path).schema, paths))


# Integer types from narrow to wide with their decimal digits, as the yearly files mix them.
_INTS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
_FLOATS = (T.FloatType(), T.DoubleType())
#: The largest integer up to which a double holds all.
_EXACT = 1 << 53


def _wider(a: T.DataType, b: T.DataType, exact: bool) -> T.DataType | None:
    """The narrowest type that holds both, or None; ``exact`` allows no double for integers or decimals."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _INTS and b in _INTS:
        return max(a, b, key=list(_INTS).index)
    if a in _FLOATS and b in _FLOATS:
        return T.DoubleType()
    numeric = [k in _INTS or k in _FLOATS or isinstance(k, T.DecimalType) for k in (a, b)]
    if all(numeric):
        if a in _FLOATS or b in _FLOATS:
            return None if exact else T.DoubleType()
        whole, scale = 0, 0
        for k in (a, b):
            whole = max(whole, k.precision - k.scale if isinstance(k, T.DecimalType) else _INTS[k])
            scale = max(scale, k.scale if isinstance(k, T.DecimalType) else 0)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if isinstance(a, T.DateType) and isinstance(b, (T.TimestampType, T.TimestampNTZType)):
        return b
    if isinstance(b, T.DateType) and isinstance(a, (T.TimestampType, T.TimestampNTZType)):
        return a
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = _wider(a.elementType, b.elementType, True)  # the elements of an array aren't checked one by one
        return None if element is None else T.ArrayType(element, True)
    return None


def common_schema(schemas: dict[int, T.StructType], ids: Sequence[str] = ()) -> T.StructType:
    """The columns of all years in the order of their first year, each with the narrowest type that holds all of them.

    ``schemas`` are those of the years' files.  Types that have no common one (text beside a number, a double
    beside an integer in a column of ``ids``) raise an error that names the years.
    """
    out: dict[str, T.StructField] = {}
    since: dict[str, int] = {}
    exact = {i.lower() for i in ids}
    for year in sorted(schemas):
        for f in schemas[year]:
            key = f.name.lower()
            if key not in out:
                out[key], since[key] = T.StructField(f.name, f.dataType, True), year
                continue
            kind = _wider(out[key].dataType, f.dataType, key in exact)
            if kind is None:
                raise ValueError(f"column {f.name!r} is {out[key].dataType.simpleString()} from {since[key]} on and "
                                 f"{f.dataType.simpleString()} in {year}; pass the schema to read")
            out[key] = T.StructField(out[key].name, kind, True)
    return T.StructType(list(out.values()))


def _cast(held: T.StructField | None, target: T.StructField, checked: bool) -> Column:
    """A file's column as the target's; ``checked`` raises on integers and decimals that a double can't hold."""
    if held is None:
        return F.lit(None).cast(target.dataType).alias(target.name)
    col = F.col("`" + held.name.replace("`", "``") + "`")
    cast = col.cast(target.dataType)
    if checked and target.dataType == T.DoubleType():
        holds = None
        if held.dataType == T.LongType():
            holds = col.between(-_EXACT, _EXACT)
        elif isinstance(held.dataType, T.DecimalType):
            holds = cast.cast(held.dataType) == col
        if holds is not None:
            error = F.raise_error(F.concat(F.lit(f"column {held.name}: a double can't hold "), col.cast("string")))
            cast = F.when(col.isNull() | holds, cast).otherwise(error.cast("double"))
    return cast.alias(target.name)


def read_year(spark: SparkSession, prefix: str, year: int,
              schema: T.StructType | None = None,
              template: str = DEFAULT_TEMPLATE) -> DataFrame:
    """Scan a single yearly file."""
    return read_years(spark, prefix, [year], schema, template)


def read_partitioned(spark: SparkSession, path: str, years: Iterable[int] | None = None,
                     schema: T.StructType | None = None,
                     partition_col: str = "file_year") -> DataFrame:
    """Scan a dataset partitioned by ``file_year=YYYY`` folders, pruned to ``years``."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    df = reader.parquet(path).withColumn(partition_col, F.col(partition_col).cast("int"))
    if years is not None:
        df = df.where(F.col(partition_col).isin([int(y) for y in years]))
    return df


def in_years(years: Sequence[int], col: str = "file_year") -> Column:
    """Predicate keeping ``years``; a contiguous list becomes a BETWEEN (prunable)."""
    ys = sorted({int(y) for y in years})
    if ys and ys[-1] - ys[0] + 1 == len(ys):
        return F.col(col).between(ys[0], ys[-1])
    return F.col(col).isin(ys)


def union_years(dfs: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL of per-year frames by column name (O36); duplicates are kept."""
    dfs = list(dfs)
    if not dfs:
        raise ValueError("nothing to union")
    return functools.reduce(lambda a, b: a.unionByName(b), dfs)

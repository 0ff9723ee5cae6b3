"""Relational server source.

Builds the reader for a table with a text-array column, pushing the whole query
(including an array-overlap predicate and a row limit) to the server.  Nothing
is opened here until Spark loads it; tests only check the built options, since
no database is reachable from the build environment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession


def overlap_query(table: str, id_col: str, array_col: str, codes: list[str],
                  limit: int | None = None) -> str:
    """Server-side query: rows whose array shares a code with ``codes``.

    Codes are passed as a single array literal, quoted and escaped.
    """
    if not codes:
        raise ValueError("codes must not be empty")
    quoted = ",".join("'" + str(c).replace("'", "''") + "'" for c in codes)
    q = f"SELECT {id_col}, {array_col} FROM {table} WHERE {array_col} && ARRAY[{quoted}]"
    if limit is not None:
        q += f" LIMIT {int(limit)}"
    return q


def jdbc_reader(spark: SparkSession, url: str, query: str, user: str | None = None,
                password: str | None = None, fetchsize: int = 10_000,
                partition_column: str | None = None, lower_bound=None, upper_bound=None,
                num_partitions: int | None = None, **options) -> DataFrameReader:
    """A configured ``format("jdbc")`` reader for ``query`` (call ``.load()``).

    With ``partition_column`` and its bounds the read is split into ``num_partitions`` tasks by ranges
    of that column (rows beyond the bounds and NULLs fall into the outer ranges; none is left out).
    """
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", f"({query}) q")
              .option("fetchsize", str(fetchsize)))
    split = {"partitionColumn": partition_column, "lowerBound": lower_bound,
             "upperBound": upper_bound, "numPartitions": num_partitions}
    if any(v is not None for v in split.values()):
        missing = [k for k, v in split.items() if v is None]
        if missing:
            raise ValueError(f"a split read also needs {missing}")
        options = {**split, **options}
    if user is not None:
        reader = reader.option("user", user)
    if password is not None:
        reader = reader.option("password", password)
    for k, v in options.items():
        reader = reader.option(k, str(v))
    return reader


def hash_predicates(column: str, parts: int, hash_sql: str = "hashtext({})") -> list[str]:
    """``parts`` conditions that split a query's rows by a hash of ``column``, a text id for instance.

    Each row fits exactly one: a value the one of its hash, NULL the first.  ``hash_sql`` is the server's hash function
    to a 32- or 64-bit integer; its sign is dropped by a mask, as the absolute value of the least integer overflows.
    """
    if parts < 1:
        raise ValueError(f"parts must be >= 1, got {parts}")
    h = f"({hash_sql.format(column)} & 2147483647) % {parts}"
    return [f"({h} = {k} OR {column} IS NULL)" if k == 0 else f"({h} = {k} AND {column} IS NOT NULL)" for k in range(parts)]


def read_jdbc_split(spark: SparkSession, url: str, query: str, column: str, parts: int, hash_sql: str = "hashtext({})",
                    fetchsize: int = 10_000, **properties) -> DataFrame:
    """``query`` read by ``parts`` tasks, each with the rows of one of :func:`hash_predicates`.

    For ids that ``partition_column`` of :func:`jdbc_reader` can't take: it splits by numbers, dates and timestamps only.
    """
    return spark.read.jdbc(url, f"({query}) q", predicates=hash_predicates(column, parts, hash_sql),
                           properties={"fetchsize": str(fetchsize), **{k: str(v) for k, v in properties.items()}})


def read_jdbc(spark: SparkSession, url: str, query: str, **kw) -> DataFrame:
    return jdbc_reader(spark, url, query, **kw).load()

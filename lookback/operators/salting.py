"""Equi-join with measured hot keys split over tasks.

A shuffle join sends all rows of a key to one task.  Here the rows of the large side are counted by
key first (summed in the tasks, so a hot key costs the count nothing).  A key that holds more
than its share, one of ``parts`` equal shares of all rows, gets a number of salts; there are at most ``parts`` such
keys, so their list is sent to all tasks whatever the input.  Rows of the large side take
one salt by a hash of their columns, rows of the other side are repeated for each salt of their key.
Nothing is sampled or capped: every row of the large side meets its partners once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT, SALTS = "_lb_salt", "_lb_salts"


def hot_keys(rows: DataFrame, key: str, parts: int) -> DataFrame:
    """``key`` and its number of salts for each key with more than 1/``parts`` of all rows: at most ``parts`` rows."""
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("t")).scalar()
    return (counts.withColumn("_t", total).where(F.col("_n") * parts > F.col("_t"))
            .select(key, F.ceil(F.col("_n") * parts / F.col("_t")).cast("int").alias(SALTS)))


def salted_sides(large: DataFrame, small: DataFrame, key: str, parts: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt: joined on ``key`` and the salt they give the rows of a join on ``key``."""
    hot = F.broadcast(hot_keys(large, key, parts))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in large.columns]), F.col(SALTS)).cast("int")
    left = (large.join(hot, key, "left").withColumn(SALT, F.when(F.col(SALTS).isNull(), 0).otherwise(spread)).drop(SALTS))
    right = (small.join(hot, key, "left")
             .withColumn(SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(SALTS), F.lit(1)) - 1))).drop(SALTS))
    return left, right


def salted_join(large: DataFrame, small: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """Inner join on ``key``; ``parts`` (4 for each shuffle partition by default) is how finely hot keys are split."""
    n = parts or 4 * int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left, right = salted_sides(large, small, key, n)
    return left.join(right, [key, SALT]).drop(SALT)

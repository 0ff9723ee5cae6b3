"""A set of 64-bit keys as a bit map of bounded size, made by Spark and sent to the tasks.

Membership may be wrong for keys that aren't in the set, never for those that are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_code, tidy, written

#: Bits for each key, as long as the map stays under MAX_BITS (2^29 bits are 64 MB).
BITS_PER_KEY = 64
MAX_BITS = 1 << 29
#: Keys that hold 1/HOT of all rows or more are joined apart.
HOT = 1000


def _positions(keys: np.ndarray, bits: int) -> np.ndarray:
    x = keys.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return ((x ^ (x >> np.uint64(32))) & np.uint64(bits - 1)).astype(np.int64)


class BitMap:
    def __init__(self, sent, bits: int) -> None:
        self.sent, self.bits = sent, bits

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Whether each int64 key may be in the set."""
        at = _positions(keys, self.bits)
        return (self.sent.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def bit_map(keys: DataFrame, column: str) -> BitMap:
    """The map of a frame's long column; each task's share is merged by an aggregation over blocks of bits."""
    spark = keys.sparkSession
    ship_code(spark)
    count = keys.count()
    bits = 1 << 18
    while bits < BITS_PER_KEY * count and bits < MAX_BITS:
        bits *= 2

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_positions(b.column(0).to_numpy(zero_copy_only=False), bits), pa.int64())], names=["at"])

    # Position p goes to block p / 32768; the functions count positions from 1 in blocks from 1.
    rows = (keys.select(column).where(F.col(column).isNotNull()).mapInArrow(tidy(place), "at long")
            .groupBy(F.expr("bitmap_bucket_number(at + 1)").alias("block"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at + 1))").alias("bits")).collect())
    full = np.zeros(bits // 8, np.uint8)
    for r in rows:
        a = 4096 * (r["block"] - 1)
        full[a:a + 4096] = np.frombuffer(r["bits"], np.uint8)
    return BitMap(spark.sparkContext.broadcast(full), bits)


def split_rows(rows: DataFrame, held: BitMap, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose xxhash64(id) isn't in the map, rows where it may be): the second share alone needs a join.

    Only the hash of the id goes through Python; the rows, with their texts, stay where they are.
    """
    ship_code(rows.sparkSession)

    @F.pandas_udf("boolean")
    def may_hold(keys: pd.Series) -> pd.Series:
        return pd.Series(held.has(keys.to_numpy(np.int64)))

    mark = may_hold(F.xxhash64(rows[id_col]))
    return rows.where(~mark), rows.where(mark)


def later_places(found: DataFrame, keys: list[str], docs: DataFrame, id_col: str) -> DataFrame:
    """Rows of ``found`` that aren't at the first place of their ``keys`` (in the order of document id, then text).

    ``found`` has the keys, ``doc_id``, ``same`` (a hash of the whole text) and ``again`` (true on a row that its own
    text holds earlier); rows of one text with equal keys are no earlier place of each other but for that.
    The first document of each key is a minimum of ids alone, which is summed up in the tasks.  Only where ids stand on
    several rows the text's hash decides between them.
    """
    groups = written(found.groupBy(*keys).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1"), "places-first")
    # Keys with a large share of the rows are at most HOT ones: they go to all tasks, so that no join deals them.
    rows = groups.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = F.broadcast(groups.where(F.col("n") * HOT >= rows).drop("n"))
    rest = groups.where(F.col("n") * HOT < rows).drop("n")
    held = found.join(hot, keys).unionByName(found.join(hot, keys, "left_anti").join(rest.hint("merge"), keys))
    late = held.where("doc_id != first_id OR again").drop("first_id")
    several = written(docs.groupBy(docs[id_col].alias("doc_id")).agg(F.count("*").alias("n")).where("n > 1 AND doc_id IS NOT NULL").select("doc_id"),
                      "places-ids")
    if several.isEmpty():
        return late
    tied = held.where("doc_id = first_id AND NOT again").join(several, "doc_id", "left_semi")
    least = tied.groupBy(*keys).agg(F.min("same").alias("first_same"))
    return late.unionByName(tied.join(least.hint("merge"), keys).where("same != first_same").drop("first_id", "first_same"))

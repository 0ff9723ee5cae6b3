"""Approximate nearest neighbours by inner product: multi-index hashing over learned rotated binary codes.

Method.  A vector gets one further component so that all have the length of the longest (a query
gets 0), which turns the order by inner product into the order by angle.  Rotations learned by
iterative quantisation on a bounded sample turn a vector into ``BITS`` sign bits, cut into substrings of
eight bits; each substring has an index from its value to the rows.  Codes within Hamming radius r of
a query agree with it, in at least one of m substrings, up to r // m bits, so probing those
values in every index finds every such code.  Codes found are checked whole, and what lies in the
radius is ranked by the inner product of the original vectors in double precision.  A query that finds
fewer than k in a block goes on with a larger radius until it has k or all of the block.

The radius is the distance that held ``RECALL`` of the true neighbours in the sample.

Scale.  Every row is indexed.  Rows are dealt by a hash of their id to blocks, queries to groups, and
each (group, block) cell is one task's work of bounded size; a cell returns k rows for each query, and the
k best of all blocks are merged by query.  Queries are a share of the rows, so the number of cells
grows with the square of the rows, as does any search of that many queries; no cell grows.

Defined cases: vectors that are null, empty, zero, of another length than most, or hold a null or
non-finite component take no part, nor do rows without an id; rows that repeat an id are candidates
each, and one query (the smallest vector); a query is no neighbour of rows with its own id; ties go to
the smaller id; fewer than k candidates: all of them; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship_code, shuffle_partitions, written

BITS = 128
#: Sample for rotations and radius: rows that come to the driver.
SAMPLE = 8000
#: Share of the sample's true neighbours inside the radius.
RECALL = 0.985
#: Rows and queries of a cell at most, on average.
BLOCK_ROWS = 50_000
GROUP_QUERIES = 5_000


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part, whole vectors in their own type."""
    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].alias("v")).where(
        F.col("vec_id").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("v", lambda x: x != 0))
    size = rows.agg(F.mode(F.size("v"), deterministic=True).alias("n")).first()["n"]
    return rows.where(F.size("v") == F.lit(size if size is not None else 0))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


class Coder:
    """Rotations, the common length, and the radius."""

    def __init__(self, sample: np.ndarray, longest: float, k: int, rows: int) -> None:
        self.longest = longest
        x = self.extended(sample)
        d = x.shape[1]
        rng = np.random.default_rng(5)
        rotations = []
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        for _ in range(math.ceil(BITS / d)):
            r = np.linalg.qr(rng.standard_normal((d, d)))[0]
            for _ in range(25):
                v = unit @ r
                u, _, w = np.linalg.svd(np.where(v > 0, 1.0, -1.0).T @ unit)
                r = (u @ w).T
            rotations.append(r)
        self.rotation = np.hstack(rotations)[:, :BITS]
        # The k nearest of all rows are the nearest k * sample / rows of the sample, and four at least.
        near = min(max(4, math.ceil(k * len(sample) / max(1, rows))), len(sample) - 1)
        codes = self.codes(sample)
        found = []
        for i in range(0, len(sample), max(1, len(sample) // 300)):
            s = sample @ sample[i]
            s[i] = -np.inf
            top = np.argpartition(-s, near - 1)[:near] if near >= 1 else []
            query = self.codes(sample[i:i + 1], query=True)
            found += np.bitwise_count(codes[top] ^ query).sum(axis=1).tolist()
        self.radius = int(np.quantile(found, RECALL)) if found else BITS

    def extended(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.longest ** 2 - (x * x).sum(axis=1)))
        return np.hstack([x, more[:, None]])

    def codes(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """One byte for each eight bits."""
        return np.packbits(self.extended(x, query) @ self.rotation > 0, axis=1)


def learn(rows: DataFrame, k: int, sample: int = SAMPLE) -> Coder | None:
    """A coder fitted on the first ``sample`` rows by a hash of the id."""
    stats = rows.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("longest")).first()
    if stats["n"] < 2:
        return None
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toArrow()
    return Coder(matrix(some["v"]), math.sqrt(stats["longest"]), k, stats["n"])


_BYTES = np.arange(256, dtype=np.uint8)


class Index:
    """Substring indexes over the codes of one block."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes, self.n = codes, len(codes)
        self.order = [np.argsort(codes[:, j], kind="stable") for j in range(codes.shape[1])]
        self.cuts = [np.concatenate([[0], np.cumsum(np.bincount(codes[:, j], minlength=256))]) for j in range(codes.shape[1])]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows whose code is within ``radius``: every one, found by probing."""
        m = len(self.order)
        seen = np.zeros(self.n, bool)
        masks = _BYTES[np.bitwise_count(_BYTES) <= radius // m]
        for j in range(m):
            values = (masks ^ code[j]).astype(np.int64)
            starts, ends = self.cuts[j][values], self.cuts[j][values + 1]
            some = ends > starts
            for a, b in zip(starts[some].tolist(), ends[some].tolist()):
                seen[self.order[j][a:b]] = True
        rows = np.flatnonzero(seen)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(axis=1) <= radius]


def search_block(coder: Coder, ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple]:
    """(query_id, vec_id, score) of the k best of the block for each query."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    index = Index(coder.codes(x))
    out: list[tuple] = []
    for qid, q, code in zip(query_ids.tolist(), queries, coder.codes(queries, query=True)):
        others = len(ids) - (np.searchsorted(ids, qid, "right") - np.searchsorted(ids, qid, "left"))
        radius = min(coder.radius, BITS)
        while True:
            rows = index.within(code, radius)
            rows = rows[ids[rows] != qid]
            if len(rows) >= min(k, others) or radius >= BITS:
                break
            radius = min(BITS, radius + 8)
        score = np.add.reduce(x[rows] * q, axis=1)  # row by row, so that equal vectors score equally
        best = np.lexsort((ids[rows], -score))[:k]
        out += [(qid, int(ids[rows[i]]), float(score[i])) for i in best]
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of all rows for each row that ``is_query`` (on ``vec_id``) names."""
    spark = vectors.sparkSession
    ship_code(spark)
    rows = written(usable(vectors, id_col, vec_col), "ann-rows")
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    coder = learn(rows, k)
    schema = "query_id long, vec_id long, score double"
    if coder is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n, asked, tasks = rows.count(), queries.count(), shuffle_partitions(spark)
    blocks = max(math.ceil(n / BLOCK_ROWS), math.ceil(math.sqrt(tasks)))
    groups = max(math.ceil(asked / GROUP_QUERIES), math.ceil(tasks / blocks))
    sent = spark.sparkContext.broadcast(coder)  # rotations: dimensions x BITS numbers
    cell = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    group = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups))
    held = rows.select("vec_id", "v", F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), cell.alias("b"))
    asking = queries.select("vec_id", "v", F.lit(True).alias("asks"), group.alias("g"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"))
    cells = held.unionByName(asking.select("vec_id", "v", "asks", F.col("g").cast("int").alias("g"), F.col("b").cast("long").alias("b")))

    def run(table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy()
        ids, x = table["vec_id"].to_numpy(), matrix(table["v"])
        made = search_block(sent.value, ids[~asks], x[~asks], ids[asks], x[asks], k) if asks.any() and not asks.all() else []
        cols = list(zip(*made)) if made else [(), (), ()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))],
                                    names=["query_id", "vec_id", "score"])

    found = cells.groupBy("g", "b").applyInArrow(run, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

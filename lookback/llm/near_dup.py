"""MinHash near-duplicates: bottom-k sketches, inverted lists, union-sketch estimates, exact Jaccard.

Words are runs of bytes other than white space (0x20, 0x09-0x0D) of the text with A-Z lower-cased.
A document's set holds its distinct ``width``-word shingles (with fewer words: the whole sequence as
one), each as one 64-bit hash; that one hash function also orders the sketch, the ``k`` smallest.
Two documents are linked if the Jaccard similarity of their full sets is at least ``num / den``.

Method.
1. Equal sets become one node (exact copies meet only here, after a map-side reduction).
2. Inverted lists of the retained values: values are ordered by their document frequency, and a
   node enters only the lists of its rarest values.  Two similar sketches share at least ``c`` values
   (five standard deviations and more below the mean; exactly for sets smaller than a sketch), so
   they meet in a list of their ``|sketch| - c + 1`` rarest ones.  A line or passage that many
   documents share is frequent, and so makes no list.
3. Lists with few members give their pairs.  A long list gives the pairs with its hub only, the
   member whose values are the most frequent ones (the likely original of a group of copies).
4. Pairs are filtered by size, then by the estimate from the union sketch, then the full sets decide.
5. A long list isn't done yet: members whose component isn't the hub's may be linked with others.  The
   hub's members are arranged in rings by their exact Jaccard distance from it; that distance is a
   metric, so a link joins only members whose rings differ by at most 1 - num / den.  The open members
   of a ring are compared with the members of those rings block against block, with the full
   sets in memory, and only links that join components are returned.  So no group, however large,
   emits its pairs, and no link is lost but by the sketch bound of step 2 (about 1e-7 for a pair
   exactly on the threshold, far less above it).
6. Components by alternating large-star and small-star steps.

Scale.  The first pass keeps a sketch and a key per document.  Full sets are made in a second pass and
only for documents in candidate pairs, found by a bit map of a fixed largest size, so texts are never
shuffled.  Joins on list values, hubs and keys are plain equi-joins whose hot keys AQE splits;
aggregations reduce before the shuffle.  Each round is written to the shared folder.

Defined cases: null or empty text, or no words: ``n_shingles`` 0, linked with nothing, its own
component; null ids never name a component that has others; repeated ids are separate rows; an empty table gives no
rows; whole texts are shingled, however long; columns besides id and text don't matter, ``keep_one`` keeps them (names
with ``__lb_`` are reserved).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import bit_map, split_rows
from .common import ship_code, short_batches, tidy, written

#: Longest list whose pairs are all tried, as unlinked members per list.
LIST_PAIRS = 16
#: Width of a ring around a hub, as Jaccard distance.
RING = 0.05
#: Shingles of a block of members, on average.
BLOCK_VALUES = 60_000


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a whole text."""
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.int64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    count = len(words) - width + 1
    out = h[:count].copy()
    for i in range(1, width):
        out = _mixed(out) + h[i:count + i]
    return np.unique(_mixed(out + np.uint64(width)).view(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    cuts = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=cuts[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat, pa.int64()))


def _set_key(values: np.ndarray) -> int:
    from xxhash import xxh3_64_intdigest

    return int(np.uint64(xxh3_64_intdigest(values.tobytes())).view(np.int64))


def sketches(docs: DataFrame, width: int, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n, key, sketch`` of every row; ``key`` names the set and is null for an empty one."""
    ship_code(docs.sparkSession)
    short_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t, width) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_set_key(s) if len(s) else None for s in sets], pa.int64()),
                 _lists([s[:k] for s in sets])], names=["doc_id", "n", "key", "sketch"])

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        tidy(run), f"doc_id {kind}, n long, key long, sketch array<long>")


class Linker:
    """The parameters of one run and the steps of the method."""

    def __init__(self, docs: DataFrame, width: int, num: int, den: int, k: int = 48,
                 id_col: str = "doc_id", text_col: str = "text") -> None:
        self.docs, self.width, self.num, self.den, self.k = docs, width, num, den, k
        self.id_col, self.text_col, self.t = id_col, text_col, num / den
        self.spark = docs.sparkSession
        spread = 5.2 * math.sqrt(k * self.t * (1 - self.t))
        #: Values that two similar sketches share at least.
        self.shared = max(1, math.floor(k * self.t - spread))
        self.base = written(sketches(docs, width, k, id_col, text_col), "near-sketches")
        self.nodes = written(self.base.where("key is not null").select("key", "n", "sketch").dropDuplicates(["key"]), "near-nodes")

    def sizes_fit(self, a: str = "n_a", b: str = "n_b"):
        return F.least(a, b) * self.den >= F.greatest(a, b) * self.num

    def prefixes(self) -> DataFrame:
        """Inverted lists (v, id, n, cent) of each node's rarest values; ``cent`` tells how usual its values are."""
        k, t, n = self.k, self.t, F.col("n")
        least = F.when(n >= k, F.lit(self.shared)).otherwise(F.greatest(
            F.lit(1), F.ceil(n * t - 1e-9) - F.greatest(F.lit(0), F.ceil(n / t) - k)))
        values = self.nodes.select(F.col("key").alias("id"), "n", F.explode("sketch").alias("v"))
        counts = values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
        held = (values.join(counts, "v").groupBy("id").agg(
            F.first("n").alias("n"), F.sum(F.log2("df")).alias("cent"), F.sort_array(F.collect_list(F.struct("df", "v"))).alias("held")))
        # Values of one node only come first and make no list.
        size = F.least(n, F.lit(k))
        take = F.greatest(F.lit(0), (size - least + 1) - (size - F.size("held"))).cast("int")
        return (held.select("id", "n", (F.col("cent") / size).alias("cent"), F.explode(F.slice("held", F.lit(1), take)).alias("x"))
                .select(F.col("x.v").alias("v"), "id", "n", "cent"))

    def pairs(self, lists: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(pairs to try, (hub, member) of the long lists); each pair once, of fitting sizes."""
        stats = (lists.groupBy("v").agg(F.count("*").alias("members"), F.max(F.struct("cent", "id", "n")).alias("hub"))
                 .where("members > 1"))
        known = lists.join(stats, "v")
        direct = (known.where(F.col("members") <= LIST_PAIRS).groupBy("v")
                  .agg(F.sort_array(F.collect_list(F.struct("id", "n"))).alias("x"))
                  .select(F.explode(F.expr("flatten(transform(x, (p, i) -> transform(slice(x, i + 2, size(x)),"
                                           " q -> struct(p.id AS a, p.n AS n_a, q.id AS b, q.n AS n_b))))")).alias("p"))
                  .select("p.*").where(self.sizes_fit()).select("a", "b").distinct())
        hubs = (known.where(F.col("members") > LIST_PAIRS).where("id != hub.id")
                .select(F.col("hub.id").alias("a"), F.col("id").alias("b")).distinct())
        return direct, hubs

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose union sketch leaves room for the threshold."""
        a = self.nodes.select(F.col("key").alias("a"), F.col("sketch").alias("s_a"))
        b = self.nodes.select(F.col("key").alias("b"), F.col("sketch").alias("s_b"))
        union = F.slice(F.sort_array(F.array_union("s_a", "s_b")), 1, self.k)
        both = F.size(F.array_intersect(union, F.array_intersect("s_a", "s_b")))
        # With fewer than k values the union sketch is the union, up to what the longer sketch has cut off.
        least = F.when(F.size("union") >= self.k, F.lit(self.shared)).otherwise(
            F.ceil(F.size("union") * F.lit(self.t) - 1e-9))
        return (pairs.join(a, "a").join(b, "b").withColumn("union", union)
                .where(both >= least).select("a", "b"))

    def sets(self, ids: DataFrame) -> DataFrame:
        """(key, values) of the nodes named by ``id``: the full sets, made anew from the texts."""
        wanted = ids.distinct()
        reps = written(self.base.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
                       .join(wanted.withColumnRenamed("id", "key"), "key", "left_semi"), "near-wanted")
        # A row is named by a hash of its id and the key of its set: one row for each wanted set.
        held = bit_map(reps.select(F.xxhash64("doc_id").bitwiseXOR(F.col("key")).alias("at")), "at")
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in batches:
                sets = [shingles(t, width) for t in x.column(0).to_pylist()]
                keys = np.array([_set_key(s) if len(s) else 0 for s in sets], np.int64)
                mine = held.has(x.column(1).to_numpy(zero_copy_only=False) ^ keys)
                take = [i for i in np.flatnonzero(mine).tolist() if len(sets[i])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[take]), pa.array([sets[i].tobytes() for i in take], pa.binary())], names=["key", "values"])

        found = self.docs.select(self.docs[self.text_col], F.xxhash64(self.docs[self.id_col]).alias("at")).mapInArrow(tidy(run), "key long, values binary")
        return written(found.dropDuplicates(["key"]), "near-sets")

    def verified(self, pairs: DataFrame, sets: DataFrame) -> DataFrame:
        """(a, b, n_b, distance, linked) of every pair, by the full sets."""
        num, den = self.num, self.den

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in batches:
                linked, size, far = [], [], []
                for p, q in zip(x.column(2), x.column(3)):
                    a, b = np.frombuffer(p.as_buffer(), np.int64), np.frombuffer(q.as_buffer(), np.int64)
                    both = np.sort(np.concatenate([a, b]))
                    shared = int(np.count_nonzero(both[1:] == both[:-1]))
                    union = len(a) + len(b) - shared
                    linked.append(den * shared >= num * union)
                    far.append(1 - shared / union)
                    size.append(len(b))
                yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), pa.array(size, pa.int64()), pa.array(far, pa.float64()),
                                                  pa.array(linked, pa.bool_())], names=["a", "b", "n_b", "distance", "linked"])

        joined = (pairs.join(sets.select(F.col("key").alias("b"), F.col("values").alias("v_b")), "b")
                  .join(sets.select(F.col("key").alias("a"), F.col("values").alias("v_a")), "a").select("a", "b", "v_a", "v_b"))
        return joined.mapInArrow(tidy(run), "a long, b long, n_b long, distance double, linked boolean")

    def among(self, star: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
        """Links between members of a hub's long lists that are in different components yet."""
        num, den = self.num, self.den
        root = roots.select(F.col("id").alias("b"), F.col("root"))
        hub_root = roots.select(F.col("id").alias("a"), F.col("root").alias("hub_root"))
        members = (star.join(root, "b", "left").join(hub_root, "a", "left")
                   .select(F.col("a").alias("hub"), F.col("b").alias("id"), F.col("n_b").alias("n"),
                           F.coalesce("root", "b").alias("root"), F.coalesce("hub_root", "a").alias("hub_root"),
                           F.floor(F.col("distance") / RING).cast("int").alias("ring"))
                   .withColumn("asks", F.col("root") != F.col("hub_root")))
        members = written(members, "near-members")
        rings = (members.groupBy("hub", "ring").agg(F.sum("n").alias("values"), F.sum(F.when(F.col("asks"), F.col("n"))).alias("open")))
        one = rings.where("open > 0").select("hub", F.col("ring").alias("ring_y"), F.ceil(F.col("open") / BLOCK_VALUES).cast("int").alias("blocks_y"))
        other = rings.select("hub", F.col("ring").alias("ring_x"), F.ceil(F.col("values") / BLOCK_VALUES).cast("int").alias("blocks_x"))
        reach = math.ceil((1 - self.t) / RING + 1e-9) + 1
        cells = written(one.join(other, "hub").where(F.abs(F.col("ring_x") - F.col("ring_y")) <= reach), "near-cells")

        def dealt(rows: DataFrame, mine: str, theirs: str, asks: bool) -> DataFrame:
            block = F.pmod(F.xxhash64("id"), F.col(f"blocks_{mine}")).cast("int").alias(mine)
            return (rows.withColumnRenamed("ring", f"ring_{mine}").join(cells, ["hub", f"ring_{mine}"])
                    .select("hub", "ring_x", "ring_y", block, F.explode(F.sequence(F.lit(0), F.col(f"blocks_{theirs}") - 1)).alias(theirs),
                            "id", "root", F.lit(asks).alias("asks"))
                    .select("hub", "ring_x", "ring_y", "x", "y", "id", "root", "asks"))

        rows = dealt(members, "x", "y", False).unionByName(dealt(members.where("asks"), "y", "x", True))
        rows = rows.join(sets.select(F.col("key").alias("id"), "values"), "id")

        def run(table: pa.Table) -> pa.Table:
            asks, ids, root = table["asks"].to_numpy(), table["id"].to_numpy(), table["root"].to_numpy()
            values = [np.frombuffer(v.as_buffer(), np.int64) for c in table["values"].chunks for v in c]
            made: list[tuple[int, int]] = []
            xs = np.flatnonzero(~asks)
            if len(xs):
                size = np.array([len(values[i]) for i in xs])
                vocab, at = np.unique(np.concatenate([values[i] for i in xs]), return_inverse=True)
                starts = np.concatenate([[0], np.cumsum(size)[:-1]])
                mark = np.zeros(len(vocab) + 1, np.int32)
                joined: set[tuple[int, int]] = set()
                for i in np.flatnonzero(asks).tolist():
                    spot = np.searchsorted(vocab, values[i])
                    spot = spot[vocab[np.minimum(spot, len(vocab) - 1)] == values[i]]
                    mark[spot] = 1
                    shared = np.add.reduceat(mark[at], starts)
                    mark[spot] = 0
                    found = (den * shared >= num * (size + len(values[i]) - shared)) & (root[xs] != root[i])
                    for j in xs[found].tolist():
                        # One link between two components is enough.
                        two = (int(min(root[i], root[j])), int(max(root[i], root[j])))
                        if two not in joined:
                            joined.add(two)
                            made.append((int(ids[i]), int(ids[j])))
            return pa.table({"a": pa.array([m[0] for m in made], pa.int64()), "b": pa.array([m[1] for m in made], pa.int64())})

        return rows.groupBy("hub", "ring_x", "ring_y", "x", "y").applyInArrow(run, "a long, b long")

    def roots(self) -> DataFrame:
        """(id, root) of every linked node."""
        direct, hubs = self.pairs(written(self.prefixes(), "near-lists"))
        direct, hubs = written(self.likely(direct), "near-pairs"), written(hubs, "near-hubs")
        ids = (direct.select(F.explode(F.array("a", "b")).alias("id"))
               .unionByName(hubs.select(F.explode(F.array("a", "b")).alias("id"))))
        sets = self.sets(ids)
        links = written(self.verified(direct, sets).where("linked").select("a", "b"), "near-links")
        star = written(self.verified(hubs, sets), "near-star")
        found = components(links.unionByName(star.where("linked").select("a", "b")), "near-components")
        if star.isEmpty():
            return found
        more = written(self.among(star, found, sets), "near-more")
        if more.isEmpty():
            return found
        return components(found.select(F.col("id").alias("a"), F.col("root").alias("b")).unionByName(more), "near-components")


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38, 0)))")).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, root) of every node that has an edge (a, b): root is the smallest id of its component.

    Alternating large-star and small-star steps; rows per step stay at the number of edges.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), name)
    before = _fingerprint(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (large.join(low, "a").where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
                 .unionByName(low.select("a", F.col("low").alias("b"))).distinct())
        edges = written(small, name)
        now = _fingerprint(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())


def near_duplicates(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, k: int = 48,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable) and ``kept``."""
    run = Linker(docs, width, num, den, k, id_col, text_col)
    roots = run.roots()
    named = (run.base.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("low"))
             .join(roots.withColumnRenamed("id", "key"), "key", "left")
             .select("key", "low", F.coalesce("root", "key").alias("root")))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    by_key = named.join(lowest, "root").select("key", "component_id")
    return (run.base.select("doc_id", "n", "key").join(by_key, "key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates, that of the smallest id.

    Rows without an id can't be told apart and all stay; equal rows with one id count once.
    """
    gone = written(near_duplicates(docs, width, num, den, id_col=id_col, text_col=text_col)
                   .groupBy("doc_id").agg(F.max(F.col("kept").cast("int")).alias("__lb_kept"), F.count("*").alias("__lb_rows"))
                   .where("doc_id is not null and (__lb_kept = 0 or __lb_rows > 1)").withColumnRenamed("doc_id", "__lb_id"), "near-gone")
    held = bit_map(gone.select(F.xxhash64("__lb_id").alias("at")), "at")
    stay, some = split_rows(docs, held, id_col)
    # Sort-merge at every size, as in line dedup; only rows that may go are shuffled.
    judged = (some.join(gone.hint("merge"), some[id_col] == F.col("__lb_id"), "left")
              .where("__lb_kept is null or __lb_kept = 1"))
    if gone.where("__lb_rows > 1").isEmpty():
        return stay.unionByName(judged.select(*docs.columns))
    once = judged.where("__lb_rows > 1").select(*docs.columns).dropDuplicates([id_col, text_col])
    return stay.unionByName(judged.where("__lb_rows is null or __lb_rows = 1").select(*docs.columns)).unionByName(once)

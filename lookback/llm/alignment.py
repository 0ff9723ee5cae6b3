"""Cross-tokenizer alignment by diagonal run skipping, and how often ids of two tokenizers stand for each other.

Method.  Tokens of both encodings are byte ranges of the same bytes, given by their ends.  At tokens i and j the two
end arrays are compared at the current index shift j - i: the first SINGLE tokens one by one, then in probes that double; a
probe that differs is halved until the first difference is met, so a stretch of one-to-one tokens costs a logarithm of probes.  The
irregular group behind it is settled locally: the tokenizer that lags goes on until both end at the same byte, each
step giving a link of two tokens that overlap; its sizes change the shift and probing starts again.

Encoding.  Both tokenizers are taken only where they are proven to encode the parts between single spaces alone as
together (``vocab``), so a part is encoded and aligned once (a part's end is an end of both) and kept with its ids, links and
spelt groups by the worker; others get whole texts.  Long texts go through in slabs of parts.

Corpus counts.  ``links`` writes each document's distinct id pairs with how often they occur.  An id pair's count is the
number of documents that hold it; the highest count of each A id is at most one number for each id of the vocabulary.
Pairs that hold 1/HOT of all rows or more are at most HOT ones: they go to all tasks and are counted there, so no
frequent pair is ever shuffled; the rows of the others meet their counts in an equi-join, none of whose keys has more
than that share of the rows.

Defined cases: null and empty texts, and texts whose joined token bytes differ from a space and the text (for one, those
with U+2581), have no tokens: zeros and ''; rows that repeat an id or text are documents of their own; null ids are
kept; an empty table gives no rows; columns of the input besides id and text don't matter.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_code, short_batches, tidy, written
from .vocab import GAP, open_tokenizer

#: Pairs with this share of all rows, or more, are counted in the tasks.
HOT = 50_000
#: Parts of a slab, and parts and their links that a worker keeps before it starts anew (about 450 bytes a part).
SLAB = 20_000
CACHE_PARTS, CACHE_LINKS = 400_000, 4_000_000
#: Tokens of a stretch that are compared one by one before probes are worth their cost.
SINGLE = 8
#: Rows of a batch of output.
OUT_ROWS = 64

CUT = re.compile(f"(?<=[^{GAP}]) (?=[^{GAP}])")
CLOSED = re.compile(f"[^{GAP}](?:.*[^{GAP}])?", re.DOTALL)


def align(ea: list[int], eb: list[int]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int]], tuple[list[int], list[int]]]:
    """One-to-one stretches (i, j, tokens); irregular groups (i, j, after the last of A, of B); tokens of A and B linked in those.

    ``ea`` and ``eb`` are the increasing ends of both encodings of the same bytes; the last ones are equal.  All is in order.
    """
    runs: list[tuple[int, int, int]] = []
    odd: list[tuple[int, int, int, int]] = []
    la: list[int] = []
    lb: list[int] = []
    n = len(ea)
    ea, eb = [*ea, -1], [*eb, -2]  # differ behind the end
    i = j = 0
    while i < n:
        first, shift = i, j - i
        while ea[i] == eb[j]:
            i += 1
            j += 1
            if i - first == SINGLE:
                w = SINGLE
                while ea[i:i + w] == eb[j:j + w]:
                    i += w
                    j += w
                    w += w
                w >>= 1  # the first difference lies within the last probe
                while w:
                    if ea[i:i + w] == eb[j:j + w]:
                        i += w
                        j += w
                    w >>= 1
                break
        if i > first:
            runs.append((first, first + shift, i - first))
            if i >= n:
                break
        p, q = i, j
        a, b = ea[p], eb[q]
        la.append(p)
        lb.append(q)
        while a != b:
            if a < b:
                p += 1
                a = ea[p]
            else:
                q += 1
                b = eb[q]
            la.append(p)
            lb.append(q)
        odd.append((i, j, p + 1, q + 1))
        i, j = p + 1, q + 1
    return runs, odd, (la, lb)


def links_of(runs: list, odd_links: tuple[list[int], list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Indices of A and of B of all overlapping tokens."""
    la, lb = (np.array(x, np.int64) for x in odd_links)
    if not runs:
        return la, lb
    first = np.array(runs, np.int64)
    size = first[:, 2]
    step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    return (np.concatenate([np.repeat(first[:, 0], size) + step, la]), np.concatenate([np.repeat(first[:, 1], size) + step, lb]))


def starts_of(runs: list, odd: list) -> np.ndarray:
    """Index of the first A token of each group, in order."""
    first = np.array([(i, k) for i, _, k in runs] + [(i, 1) for i, *_ in odd], np.int64)
    return np.sort(np.repeat(first[:, 0] - np.cumsum(first[:, 1]) + first[:, 1], first[:, 1]) + np.arange(int(first[:, 1].sum())))


def spell(runs: list, odd: list, sa: list[str], sb: list[str]) -> list[str]:
    """``a1,a2|b1``, ``a3|b2,b3``: the ids of each group, in order."""
    out: list[str] = []
    r, last = 0, len(runs)
    for i, j, p, q in odd:
        if r < last and runs[r][0] < i:
            x, y, k = runs[r]
            out.extend(map("|".join, zip(sa[x:x + k], sb[y:y + k])))
            r += 1
        out.append((sa[i] if p == i + 1 else ",".join(sa[i:p])) + "|" + (sb[j] if q == j + 1 else ",".join(sb[j:q])))
    if r < last:
        x, y, k = runs[r]
        out.extend(map("|".join, zip(sa[x:x + k], sb[y:y + k])))
    return out


class _Ids:
    """Ids of parts behind each other: part k has ``flat[start[k]:start[k] + size[k]]``."""

    def __init__(self, kind=np.uint32) -> None:
        self.flat, self.start, self.size = np.empty(1 << 16, kind), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int32)
        self.ids = self.parts = 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        """The next parts; ``ids`` are theirs, one after the other."""
        for name, need in (("flat", self.ids + len(ids)), ("start", self.parts + len(sizes)), ("size", self.parts + len(sizes))):
            held = getattr(self, name)
            if need > len(held):
                setattr(self, name, np.resize(held, max(need, 2 * len(held))))
        self.flat[self.ids:self.ids + len(ids)] = ids
        self.size[self.parts:self.parts + len(sizes)] = sizes
        self.start[self.parts:self.parts + len(sizes)] = self.ids + np.cumsum(sizes) - sizes
        self.ids += len(ids)
        self.parts += len(sizes)

    def of(self, parts: np.ndarray) -> np.ndarray:
        """The ids of these parts in order."""
        size = self.size[parts]
        before = np.cumsum(size) - size
        return self.flat[np.repeat(self.start[parts] - before, size) + np.arange(int(size.sum()))]


class Pair:
    """Two tokenizers on the same texts; A gets a space and the text, B the text.  Parts met before are kept with their ids."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = open_tokenizer(a_path), open_tokenizer(b_path)
        self.parted = self.a.cuts_at_spaces and self.b.cuts_at_spaces
        self.names = [[str(i) for i in range(t.size)] for t in (self.a, self.b)]
        self.forget()

    def forget(self) -> None:
        self.kept: dict[str, int] = {}
        self.ids = (_Ids(), _Ids())
        self.links = _Ids(np.int64)  # linked ids (A id << 32 | B id)
        self.groups: list[bytes] = []  # spelt, and their number
        self.n_groups = np.empty(1 << 14, np.int32)
        self.wrong: set[int] = set()  # parts whose bytes don't come back: without links and groups

    def parts(self, text: str) -> list[str]:
        """The text's parts; a space stands between them, and before the first one in what is encoded."""
        return CUT.split(text) if self.parted else [text]

    def _spelt(self, ids: tuple[list[int], list[int]], raw: bytes) -> bool:
        return all(b"".join(map(t.bytes.__getitem__, x)) == raw for t, x in zip((self.a, self.b), ids))

    def _alone(self, part: str) -> None:
        ids = self.a.encode([" " + part])[0], self.b.encode([part])[0]
        made = [(np.array(x, np.uint32), np.array([len(x)])) for x in ids]
        if self._spelt(ids, b" " + part.encode()):
            self._settle(made)
        else:
            self.wrong.add(len(self.kept))
            self._settled(np.empty(0, np.int64), np.zeros(1, np.int64), [b""], np.zeros(1, np.int64))
        for held, x in zip(self.ids, made):
            held.add(*x)
        self.kept[part] = len(self.kept)

    def _settled(self, links: np.ndarray, n_links: np.ndarray, groups: list[bytes], n_groups: np.ndarray) -> None:
        """The next parts' links (one part's after the other's) and groups."""
        self.links.add(links, n_links)
        need = len(self.groups) + len(groups)
        if need > len(self.n_groups):
            self.n_groups = np.resize(self.n_groups, max(need, 2 * len(self.n_groups)))
        self.n_groups[len(self.groups):need] = n_groups
        self.groups += groups

    def _settle(self, made: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Align the next parts, one after the other: their ids and numbers of ids of A and B."""
        (ids_a, sizes), (ids_b, _) = made
        runs, odd, links, spelt = self._aligned(ids_a, ids_b)
        ends = np.cumsum(sizes)
        part = np.searchsorted(ends, links[0], "right")
        order = np.argsort(part, kind="stable")
        cuts = np.searchsorted(starts_of(runs, odd), ends).tolist()  # all groups end where their part does, or before
        before = [0, *cuts[:-1]]
        self._settled((ids_a[links[0]].astype(np.int64) << 32 | ids_b[links[1]].astype(np.int64))[order], np.bincount(part, minlength=len(sizes)),
                      [";".join(spelt[x:y]).encode() for x, y in zip(before, cuts)], np.array(cuts) - before)

    def _aligned(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[list, list, tuple[np.ndarray, np.ndarray], list[str]]:
        """Runs, irregular groups, links (as indices) and spelt groups of ids that spell the same bytes."""
        ea, eb = np.cumsum(self.a.lengths[ids_a]).tolist(), np.cumsum(self.b.lengths[ids_b]).tolist()
        if ea[-1] != eb[-1]:
            raise RuntimeError("parts end at different bytes in a text whose bytes come back")
        runs, odd, links = align(ea, eb)
        na, nb = self.names
        spelt = spell(runs, odd, list(map(na.__getitem__, ids_a.tolist())), list(map(nb.__getitem__, ids_b.tolist())))
        return runs, odd, links_of(runs, links), spelt

    def learn(self, parts: list[str], closed: bool) -> None:
        """Keep the ids of new parts; ``closed`` ones, with no gap at either end, are encoded together."""
        for at in range(0, len(parts), 2000):
            group = parts[at:at + 2000]
            made = self._together(group) if closed else None
            if made is None:  # bytes that don't come back, or open ends: each by itself
                for p in group:
                    self._alone(p)
                continue
            self._settle(made)
            for held, (ids, sizes) in zip(self.ids, made):
                held.add(ids, sizes)
            first = len(self.kept)
            self.kept.update(zip(group, range(first, first + len(group))))

    def _together(self, group: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Ids and numbers of ids of parts that are encoded as one text, if all its bytes come back."""
        text = " ".join(group)
        ids = self.a.encode([" " + text])[0], self.b.encode([text])[0]
        if not self._spelt(ids, b" " + text.encode()):
            return None
        cuts = np.cumsum(list(map(len, group if text.isascii() else map(str.encode, group)))) + np.arange(1, len(group) + 1)
        out = []
        for x, t in zip(ids, (self.a, self.b)):
            x = np.array(x, np.uint32)
            ends = np.cumsum(t.lengths[x])
            to = np.searchsorted(ends, cuts)
            if not np.array_equal(ends[to], cuts):
                raise RuntimeError("a token crosses from one part into the next")
            sizes = to + 1
            sizes[1:] -= sizes[:-1].copy()
            out.append((x, sizes))
        return out

    def _places(self, parts: list[str], first: bool, last: bool) -> list[int]:
        """Where the ids of each part are kept; ``first`` and ``last``: the text starts or ends with these parts."""
        at = list(map(self.kept.get, parts))
        if None in at:
            if len(self.kept) > CACHE_PARTS or self.links.ids > CACHE_LINKS:
                self.forget()
                at = [None] * len(parts)
            kept = self.kept
            new = list(dict.fromkeys([p for p, k in zip(parts, at) if k is None]))
            # Inner parts are closed by the cuts; the first may start with a gap, the last may end with one.
            ends = {p for p in (parts[:1] if first else []) + (parts[-1:] if last else []) if not self.parted or not CLOSED.fullmatch(p)}
            self.learn([p for p in new if p not in ends], True)
            self.learn([p for p in new if p in ends], False)
            at = [kept[p] if k is None else k for p, k in zip(parts, at)]
        return at

    def _slabs(self, text: str) -> Iterator[tuple[list[int], bool]]:
        """Where the text's parts are kept, SLAB of them at a time, and whether their bytes come back."""
        parts = self.parts(text)
        for at in range(0, len(parts), SLAB):
            places = self._places(parts[at:at + SLAB], at == 0, at + SLAB >= len(parts))
            yield places, not self.wrong or self.wrong.isdisjoint(places)

    def slabs(self, text: str) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """Ids of A and B of the text's parts, SLAB of them at a time, and whether their bytes come back."""
        for places, right in self._slabs(text):
            at = np.array(places, np.int64)
            yield (*(held.of(at) for held in self.ids), right)

    def whole(self, text: str) -> bool:
        """Whether the joined bytes of all tokens are a space and the text, if they aren't part by part."""
        slabs = list(self.slabs(text))
        return self._spelt(tuple(np.concatenate([x[side] for x in slabs]).tolist() for side in (0, 1)), b" " + text.encode())

    def document(self, text: str) -> tuple[int, int, int, int, str, np.ndarray, np.ndarray]:
        """n_a, n_b, n_groups, n_links, the groups' SHA-256, and distinct pairs (A id << 32 | B id) with their times."""
        none = (0, 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64))
        if not text:
            return none
        n_a = n_b = n_groups = 0
        digest = hashlib.sha256()
        keys, times = none[5], none[6]
        checked = False
        for places, right in self._slabs(text):
            at = np.array(places, np.int64)
            if right:
                spelt, linked = b";".join(map(self.groups.__getitem__, places)), self.links.of(at)
                n_here = int(self.n_groups[at].sum())
            else:
                ids_a, ids_b = (held.of(at) for held in self.ids)
                if not checked:
                    if not self.whole(text):
                        return none
                    checked = True
                _, _, (la, lb), groups = self._aligned(ids_a, ids_b)
                spelt, n_here = ";".join(groups).encode(), len(groups)
                linked = ids_a[la].astype(np.int64) << 32 | ids_b[lb].astype(np.int64)
            n_a += int(self.ids[0].size[at].sum()) if right else len(ids_a)
            n_b += int(self.ids[1].size[at].sum()) if right else len(ids_b)
            if n_groups:
                digest.update(b";")
            digest.update(spelt)
            n_groups += n_here
            key, n = np.unique(linked, return_counts=True)
            if len(keys):
                both, at = np.unique(np.concatenate([keys, key]), return_inverse=True)
                n = np.bincount(at, np.concatenate([times, n])).astype(np.int64)
                key = both
            keys, times = key, n
        return n_a, n_b, n_groups, int(times.sum()), digest.hexdigest(), keys, times


_pairs: dict = {}


def _pair(a_path: str, b_path: str) -> Pair:
    """The worker's own instance for two files."""
    if (a_path, b_path) not in _pairs:
        _pairs[a_path, b_path] = Pair(a_path, b_path)
    return _pairs[a_path, b_path]


def _lists(rows: list[np.ndarray], kind) -> pa.Array:
    cuts = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(rows) if rows else np.empty(0), kind))


def links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, in a table of the shared folder: ``row`` (unique), its id and counts, and its id pairs.

    ``pairs`` (array of long: A id << 32 | B id) are distinct, ``times`` says how often each is linked.
    """
    spark = docs.sparkSession
    ship_code(spark)
    short_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    frame = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("doc_id"), docs[text_col].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(a_path, b_path)
        for b in batches:
            for at in range(0, b.num_rows, OUT_ROWS):
                part = b.slice(at, OUT_ROWS)
                gc.disable()  # nothing here refers to itself, and what is kept is too much to search again and again
                try:
                    made = list(zip(*[pair.document(t or "") for t in part.column(2).to_pylist()]))
                finally:
                    gc.enable()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *[pa.array(made[k], pa.int64()) for k in range(4)], pa.array(made[4], pa.string()),
                     _lists(made[5], pa.int64()), _lists(made[6], pa.int64())],
                    names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    return written(frame.mapInArrow(tidy(run), f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, "
                                               "groups_sha256 string, pairs array<bigint>, times array<bigint>"), "align-links")


def pair_counts(linked: DataFrame) -> DataFrame:
    """(pair, a, held): the number of documents that hold each id pair, in a table of the shared folder."""
    counted = linked.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("held"))
    return written(counted.select("pair", F.shiftright("pair", 32).alias("a"), "held"), "align-pairs")


def agreement(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each document."""
    spark = docs.sparkSession
    linked = links(docs, a_path, b_path, id_col, text_col)
    counts = pair_counts(linked)
    # At most one row for each id of A's vocabulary, and at most HOT pairs: bounded whatever the input.
    top = counts.groupBy("a").agg(F.max("held").alias("top")).toPandas()
    rows = counts.agg(F.sum("held").alias("n")).first()["n"] or 0
    frequent = counts.where(F.col("held") * HOT >= rows).select("pair", "held").orderBy("pair").toPandas()
    best = np.zeros(int(top["a"].max()) + 1 if len(top) else 1, np.int64)
    best[top["a"].to_numpy(np.int64)] = top["top"].to_numpy(np.int64)
    sent = spark.sparkContext.broadcast((best, frequent["pair"].to_numpy(np.int64), frequent["held"].to_numpy(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, pairs, held = sent.value
        for b in batches:
            lists, n = b.column(1), np.diff(b.column(1).offsets.to_numpy())
            key, times = lists.flatten().to_numpy(), b.column(2).flatten().to_numpy()
            owner = np.repeat(np.arange(b.num_rows), n)
            at = np.minimum(np.searchsorted(pairs, key), max(len(pairs) - 1, 0))
            hot = pairs[at] == key if len(pairs) else np.zeros(len(key), bool)
            here, tops = held[at[hot]], best[key >> 32]
            # np.add.at, not float weights: counts are exact
            total, n_best = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            np.add.at(total, owner[hot], here * times[hot])
            np.add.at(n_best, owner[hot], np.where(here == tops[hot], times[hot], 0))
            cold = ~hot
            cuts = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[cold], minlength=b.num_rows))]).astype(np.int32))
            left = pa.StructArray.from_arrays([pa.array(key[cold]), pa.array(times[cold]), pa.array(tops[cold])], names=["pair", "times", "top"])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_best), pa.array(total), pa.ListArray.from_arrays(cuts, left)],
                                             names=["row", "n_best", "count_sum", "rest"])

    half = written(linked.select("row", "pairs", "times").mapInArrow(
        tidy(run), "row long, n_best long, count_sum long, rest array<struct<pair:bigint,times:bigint,top:bigint>>"), "align-half")
    cold = half.select("row", F.inline("rest")).join(counts.select("pair", "held").hint("merge"), "pair").select(
        "row", F.when(F.col("held") == F.col("top"), F.col("times")).otherwise(0).alias("n_best"),
        (F.col("held") * F.col("times")).alias("count_sum"))
    sums = half.select("row", "n_best", "count_sum").unionByName(cold).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return linked.drop("pairs", "times").join(sums.hint("merge"), "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

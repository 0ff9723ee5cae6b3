"""Passage dedup below the line: repeated runs of at least ``min_words`` words, wherever they start and end.

Method.  A word is a run of other characters than white space.  Every window of ``min_words`` words that
stands, with the bytes between its words, in an earlier place (document, then position) too is a repeat,
and all words of repeated windows are removed.  Two texts that share a window share the smallest
rolling hash of the runs of ``RUN`` words in it (winnowing), so it is enough to count those hashes: windows
whose smallest one stands once can't repeat.  The others are compared by a 128-bit digest of their
bytes (XXH3; a chance of 1e-20 that two of 10^9 windows clash).  Windows in a row with the same smallest run are one
stretch; where all stretches with that run are equal in the whole table, each is compared as one row for all its windows,
since equal windows share their run.  The others, at the ends of passages, are compared window by window, but for copies
of windows of the same text, which are marked as they are.  No pairs are made: a passage that a third of the documents hold is one group for each of its stretches and windows.

Defined cases: an empty table gives no rows; rows with a null id or text and texts under ``min_words`` words stay as they are; rows
with equal id and equal text are one document; a window that overlaps the first one of its kind in the
same text ("w w w ...") is no repeat of it; of the white space on both sides of a removed run the part with a line
break stays, else the one before it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bits import bit_map, later_places, split_rows
from .common import OUT_ROWS, gathered, ship_code, short_batches, tidy, without, written

#: Words of the runs whose hashes are winnowed (fewer, if ``min_words`` is smaller).
RUN = 16
_M1, _M2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)
_B = 0x9E3779B97F4A7C15 | 1
_spaces: list[np.ndarray] = []
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point whether it is white space, and its value in hashes."""
    if not _spaces:
        space = np.zeros(0x110000, bool)
        space[[i for i in range(0x3001) if chr(i).isspace()]] = True
        x = (np.arange(0x110000, dtype=np.uint64) + np.uint64(1)) * _M1
        _spaces[:] = [space, (x ^ (x >> np.uint64(32))) * _M2]
    return _spaces[0], _spaces[1]


def word_bounds(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position of each word and the one after its last, as ``str.split`` has them."""
    space = np.flatnonzero(_tables()[0][points])
    edge = np.empty(len(space) + 2, np.int64)
    edge[0], edge[1:-1], edge[-1] = -1, space, len(points)
    first, end = edge[:-1] + 1, edge[1:]
    held = end > first
    return first[held], end[held]


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of _B and of its inverse modulo 2^64, for at least n positions."""
    if not _powers or len(_powers[0][0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        made = []
        for b in (_B, pow(_B, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        _powers[:] = [(made[0], made[1])]
    return _powers[0]


#: Code points that texts are worked on together by; longer texts are worked on alone.
PACK = 1 << 16


def packs(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """The texts of a column in groups of some PACK code points: (position of the first, texts)."""
    first, held, size = 0, [], 0
    for r, value in enumerate(column):
        held.append(value.as_py())
        size += len(held[-1])
        if size >= PACK:
            yield first, held
            first, held, size = r + 1, [], 0
    if held:
        yield first, held


class Stretches:
    """The windows of some texts, in stretches of neighbours with the same smallest run hash.

    ``of``, ``at``, ``count``, ``low``: for each stretch its text, first window (the word it starts at), number of windows and run
    hash.  ``part`` is a hash of its characters.  ``alone``: its windows can't stand for each other (the text has
    the run in two places).
    """

    def __init__(self, texts: list[str], min_words: int) -> None:
        self.text = "\n".join(texts)  # no word goes over the end of a text
        points = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.intp)
        self.points, self.min_words = points, min_words
        self.first, self.end = first, end = word_bounds(points)
        begins = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
        self.words = np.searchsorted(first, begins)  # the first word of each text
        empty = np.empty(0, np.int64)
        self.of, self.at, self.count, self.low, self.part, self.alone = empty, empty, empty, empty, empty, empty.astype(bool)
        of = np.repeat(np.arange(len(texts)), np.diff(self.words))
        whole = np.flatnonzero(of[:len(of) - min_words + 1] == of[min_words - 1:]) if len(of) >= min_words else empty
        if not len(whole):
            return
        run = min(RUN, min_words)
        up, down = power_tables(len(points))
        x = _tables()[1][points]
        x *= up[:len(points)]
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(x, out=sums[1:])
        starts = first[:len(first) - run + 1]
        h = (sums[end[run - 1:]] - sums[starts]) * down[starts]
        h = (h ^ (h >> np.uint64(29))) * _M1
        h ^= h >> np.uint64(32)
        wide = min_words - run + 1
        low, held = h, 1  # the minimum over ``held`` runs from each one on
        while held < wide:
            step = min(held, wide - held)
            low = np.minimum(low[:-step], low[step:])
            held += step
        low, of = low.view(np.int64)[whole], of[whole]
        turn = np.flatnonzero(np.concatenate([[True], (low[1:] != low[:-1]) | (of[1:] != of[:-1])]))
        self.of, self.at, self.low = of[turn], whole[turn], low[turn]
        self.count = np.diff(np.append(turn, len(whole)))
        a = first[self.at]
        part = (sums[end[self.at + self.count + min_words - 2]] - sums[a]) * down[a]
        self.part = ((part ^ (part >> np.uint64(31))) * _M2).view(np.int64)
        # One run is in at most ``wide`` windows; more in a row hold it in two places.
        self.alone = self.count > wide
        order = np.lexsort((self.low, self.of))
        twice = (self.low[order][1:] == self.low[order][:-1]) & (self.of[order][1:] == self.of[order][:-1])
        self.alone[order[1:][twice]] = True
        self.alone[order[:-1][twice]] = True

    def digests(self, at: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The 128-bit digest of the bytes of ``count`` windows from each of ``at`` on, as two numbers."""
        from xxhash import xxh3_128_digest

        first, end = self.first[at], self.end[at + count + self.min_words - 2]
        raw = self.text.encode("utf-8", "surrogatepass")
        if len(raw) != len(self.points):
            # The first byte of each code point is the one that continues none.
            place = np.append(np.flatnonzero(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80), len(raw))
            first, end = place[first], place[end]
        out = np.frombuffer(b"".join([xxh3_128_digest(raw[x:y]) for x, y in zip(first.tolist(), end.tolist())]), "<i8")
        return out[::2].copy(), out[1::2].copy()


def cut(text: str, at: Sequence[int] | np.ndarray, min_words: int, counts: np.ndarray | None = None) -> tuple[str, int, int]:
    """A text without the words of the windows that start at words ``at`` (``counts`` of them from each on, else one);
    emptied lines and removed words."""
    first, end = word_bounds(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))
    gone = np.zeros(len(first) + 1, np.int32)
    at = np.asarray(at, np.int64)
    np.add.at(gone, at, 1)
    np.add.at(gone, at + (min_words - 1 + np.asarray(1 if counts is None else counts, np.int64)), -1)
    gone = np.cumsum(gone) > 0  # the last is False
    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone]).astype(np.int8)))
    out, done = [], 0
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        left = int(end[a - 1]) if a else 0
        right = int(first[b]) if b < len(first) else len(text)
        before, after = text[left:int(first[a])], text[int(end[b - 1]):right]
        out.append(text[done:left])
        if a and b < len(first):
            out.append(before if "\n" in before or "\n" not in after else after)
        done = right
    out.append(text[done:])
    breaks = np.flatnonzero(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32) == 10)
    line = np.searchsorted(breaks, first)
    emptied = len(np.unique(line)) - len(np.unique(line[~gone[:-1]]))
    return "".join(out), emptied, int(gone.sum())


def windows(docs: DataFrame, min_words: int, id_col: str, text_col: str, same: str) -> DataFrame:
    """(doc_id, same, at, count): the word at which repeated windows of a document start, and how many do from there on."""
    ship_code(docs.sparkSession)
    short_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    frame = docs.select(docs[id_col].alias("doc_id"), docs[same].alias("same"), docs[text_col].alias("text")).where(
        f"doc_id is not null and length(text) >= {2 * min_words - 1}")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in packs(b.column(0)):
                s = Stretches(texts, min_words)
                # A second row with another hash marks the key as one with unequal stretches.
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([s.low, s.low[s.alone]])),
                                                  pa.array(np.concatenate([s.part, ~s.part[s.alone]]))], names=["key", "part"])

    often = written(frame.select("text").mapInArrow(tidy(gathered(hashes)), "key long, part long").groupBy("key")
                    .agg(F.count("*").alias("n"), F.min("part").alias("lo"), F.max("part").alias("hi"))
                    .where("n > 1").selectExpr("key", "lo != hi AS mixed"), "passage-keys")
    held, mixed = bit_map(often, "key"), bit_map(often.where("mixed"), "key")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, texts in packs(b.column(2)):
                s = Stretches(texts, min_words)
                hits = np.flatnonzero(held.has(s.low)) if len(s.low) else s.low
                if not len(hits):
                    continue
                # A stretch is one row, or one for each window where its key has unequal ones.
                rows = np.where(mixed.has(s.low[hits]), s.count[hits], 1)
                row = np.repeat(hits, rows)
                nth = np.arange(len(row)) - np.repeat(np.cumsum(rows) - rows, rows)
                at, count, of = s.at[row] + nth, np.repeat(np.where(rows > 1, 1, s.count[hits]), rows), s.of[row]
                a, z = s.digests(at, count)
                # The first place of each window in its text, and whether a place is far enough behind it to be a copy.
                again = at >= at[_first_of(a, z, of)] + min_words
                # Copies within a text are marked whatever the other texts hold: a run of them is one row.
                copies = np.flatnonzero(again)
                turn = np.flatnonzero(np.concatenate([[len(copies) > 0], (np.diff(at[copies]) != 1) | (of[copies][1:] != of[copies][:-1])]))
                count[copies[turn]] = np.diff(np.append(turn, len(copies)))
                kept = np.sort(np.concatenate([np.flatnonzero(~again), copies[turn]]))
                for i in range(0, len(kept), OUT_ROWS):
                    n = kept[i:i + OUT_ROWS]
                    take = pa.array((of[n] + r).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(take), b.column(1).take(take), pa.array((at[n] - s.words[of[n]]).astype(np.int32)),
                         pa.array(count[n].astype(np.int32)), pa.array(again[n]), pa.array(a[n]), pa.array(z[n])],
                        names=["doc_id", "same", "at", "count", "again", "a", "z"])

    found = written(frame.mapInArrow(tidy(gathered(digests)), f"doc_id {kind}, same long, at int, count int, again boolean, a long, z long"),
                    "passage-windows")
    names = ["doc_id", "same", "at", "count"]
    return later_places(found.where("not again"), ["a", "z"], docs, id_col).select(*names).unionByName(found.where("again").select(*names))


def _first_of(*keys: np.ndarray) -> np.ndarray:
    """For each combination of keys the position of its first occurrence."""
    back = np.arange(len(keys[0]))
    ranked = np.sort(keys[0])
    again = ranked[1:][ranked[1:] == ranked[:-1]]
    if not len(again):
        return back
    # Only rows whose first key stands on several are compared by all keys.
    some = np.flatnonzero(np.isin(keys[0], again))
    keys = tuple(k[some] for k in keys)
    order = np.lexsort(keys)  # stable: equal ones stay in their order
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    back[some[order]] = some[order[np.flatnonzero(new)][np.cumsum(new) - 1]]
    return back


def dedup_passages(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   same: str | None = None) -> DataFrame:
    """All rows and columns of ``docs`` with the stripped text, and ``cut_lines``, ``cut_words`` (long).

    same: a long column that tells rows with one id apart; by default the hash of the text.
    """
    docs = without(docs, ("cut_lines", "cut_words"))
    names = docs.columns
    docs = docs.withColumn("__lb_same", F.xxhash64(docs[text_col]) if same is None else docs[same])
    marks = written(windows(docs, min_words, id_col, text_col, "__lb_same").groupBy("doc_id", "same")
                    .agg(F.collect_set(F.expr("shiftleft(cast(at AS long), 32) | count")).alias("__lb_at"))  # bounded by the document's words
                    .withColumnsRenamed({"doc_id": "__lb_id", "same": "__lb_of"}), "passage-marks")
    held = bit_map(marks.select(F.xxhash64("__lb_id").alias("at")), "at")
    at, last = names.index(text_col), len(names)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            marks = [m.values.to_numpy() if m.is_valid else None for m in b.column(last)]
            made = [(t, 0, 0) if t is None or s is None else cut(t, s >> 32, min_words, s & 0xFFFFFFFF)
                    for t, s in zip(b.column(at).to_pylist(), marks)]
            cols = [pa.array([m[0] for m in made], b.schema.field(at).type) if i == at else b.column(i) for i in range(last)]
            yield pa.RecordBatch.from_arrays(cols + [pa.array([m[i] for m in made], pa.int64()) for i in (1, 2)],
                                             names=names + ["cut_lines", "cut_words"])

    whole, some = split_rows(docs, held, id_col)
    joined = some.join(marks.hint("merge"), (some[id_col] == F.col("__lb_id")) & (some["__lb_same"] == F.col("__lb_of")), "left")
    return whole.select(*names, F.lit(0).cast("long").alias("cut_lines"), F.lit(0).cast("long").alias("cut_words")).unionByName(
        joined.select(*names, "__lb_at").mapInArrow(tidy(run), f"{fields}, cut_lines long, cut_words long"))

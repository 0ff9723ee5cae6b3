"""Line dedup: content-defined chunks of lines, repeated ones removed after byte comparison.

Method.  Each line is hashed; a rolling hash over two line hashes chooses the boundaries of chunks, so
they depend on the lines alone and an insertion before them moves nothing.  A line of at least
``min_words`` words is a chunk by itself.  As a passage seldom starts and ends at boundaries, each pair
of neighbouring lines is a smallest chunk too: it finds the edges that the larger chunks miss.
Chunks whose hash occurs more than once are compared byte by byte (they are grouped by their bytes),
and every occurrence but the first, by (document, line), marks its lines.  A run of marked lines of at
least ``min_words`` words is removed; shorter ones (a licence line, a greeting) stay.

Scale.  The first pass shuffles hashes only, reduced before the shuffle.  Repeated hashes come back
to the tasks as a bit map of a fixed largest size, so only the bytes of chunks that may repeat are
shuffled, and again reduced by groups before; a false positive of the map costs a row, no error.
Only texts with lines to remove are shuffled, in the join with those lines; the others, known by a bit
map of ids, pass through.  A chunk that a third of the documents hold is
one group in a reducible aggregation; its rows meet their first place by a list that goes to all tasks (``bits.later_places``).

Defined cases: an empty table gives no rows; null text stays null, empty text stays empty, nothing is removed; rows with a null id
keep their text and are no one's first occurrence; rows that repeat an id and the whole
text count as one document, rows with one id and different texts as several; lines end at "\\n" and are
compared with all their bytes; input columns called like one that is made are replaced, other columns
are kept (names with ``__lb_`` are reserved).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import passages
from .bits import bit_map, later_places, split_rows
from .common import gathered, ship_code, short_batches, tidy, without, written

#: A boundary follows one of so many pairs of lines on average.
DIVISOR = 4
_B, _M = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Rows that a text's chunks are handed on by.
MOST_ROWS = 2000


def units(text: str, min_words: int) -> tuple[list[str], list[tuple[int, int]]]:
    """The lines of a text and its chunks as (first line, number of lines)."""
    c = Chunks([text], min_words)
    return text.split("\n"), list(zip(c.start.tolist(), c.count.tolist()))


#: White space besides space and line break.
_OTHERS = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]


def word_counts(raw: bytes) -> np.ndarray:
    """The number of words of each line of a text that has no other white space than spaces and line breaks."""
    points = np.frombuffer(raw, np.uint8)
    breaks = points == 10
    gap = breaks | (points == 32)
    word = ~gap
    word[1:] &= gap[:-1]
    return np.diff(np.searchsorted(np.flatnonzero(word), np.concatenate([[0], np.flatnonzero(breaks), [len(points)]])))


class Chunks:
    """The chunks of some texts: ``of`` (the text), ``start``, ``count`` (lines) and ``key`` of each; ``lines`` as bytes."""

    def __init__(self, texts: list[str], min_words: int) -> None:
        from xxhash import xxh3_64_intdigest

        whole = "\n".join(texts)
        raw = whole.encode("utf-8", "surrogatepass")
        self.lines = raw.split(b"\n")
        n = len(self.lines)
        h = np.fromiter(map(xxh3_64_intdigest, self.lines), np.uint64, n)
        counts = np.array([t.count("\n") + 1 for t in texts])
        of = np.repeat(np.arange(len(texts)), counts)
        self.begins = np.cumsum(counts) - counts  # the first line of each text
        last = np.zeros(n, bool)
        last[np.cumsum(counts) - 1] = True
        rolled = (h[:-1] * _B + h[1:])
        rolled = (rolled ^ (rolled >> np.uint64(29))) * _B >> np.uint64(40)
        ends = last.copy()
        ends[:-1] |= rolled % np.uint64(DIVISOR) == 0
        long = word_counts(raw) >= min_words
        if any(c in whole for c in _OTHERS):  # lines of texts where spaces don't tell are split
            spaces = [not any(c in t for c in _OTHERS) for t in texts]
            for i in np.flatnonzero(~np.array(spaces)[of]):
                long[i] = len(self.lines[i].decode("utf-8", "surrogatepass").split()) >= min_words
        # A long line is a chunk by itself; the lines between boundaries are one, and each pair of neighbours.
        begin = long.copy()
        begin[0] = True
        begin[1:] |= ends[:-1] | long[:-1]
        start = np.flatnonzero(begin)
        count = np.diff(np.append(start, n))
        chosen = (count > 2) | long[start]
        pairs = np.flatnonzero(~last)
        at = np.concatenate([start[chosen], pairs])
        size = np.concatenate([count[chosen], np.full(len(pairs), 2)])
        self.at, self.count, self.of = at, size, of[at]
        self.key = chunk_keys(h, np.stack([at, size], axis=1))

    @property
    def start(self) -> np.ndarray:
        return self.at - self.begins[self.of]


def chunk_keys(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A key of each chunk (first line, number of lines), out of the hashes of its lines: chunks of equal lines have equal keys."""
    up, down = passages.power_tables(len(h) + 1)
    sums = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(((h ^ (h >> np.uint64(31))) * _M) * up[:len(h)], out=sums[1:])
    x = (sums[at[:, 0] + at[:, 1]] - sums[at[:, 0]]) * down[at[:, 0]] + at[:, 1].astype(np.uint64)
    x = (x ^ (x >> np.uint64(32))) * _B
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def repeats(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, same, start, count) of every chunk that occurs, byte for byte, in an earlier place too.

    ``same`` is a hash of the whole text: rows with one id and different texts are different documents.
    """
    ship_code(docs.sparkSession)
    short_batches(docs.sparkSession)
    frame = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), F.xxhash64(docs[text_col]).alias("same")).where(
        "doc_id is not null and text is not null and text != ''")

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in passages.packs(b.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(Chunks(texts, min_words).key)], names=["key"])

    often = written(frame.select("text").mapInArrow(tidy(gathered(hashes)), "key long").groupBy("key").agg(F.count("*").alias("n"))
                    .where("n > 1").select("key"), "line-keys")
    held = bit_map(often, "key")
    at_kind = frame.schema["doc_id"].dataType

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r, texts in passages.packs(b.column(1)):
                c = Chunks(texts, min_words)
                hits = np.flatnonzero(held.has(c.key))
                seen: set[tuple[int, bytes]] = set()
                for a in range(0, len(hits), MOST_ROWS):  # the rows of a huge text are handed on in parts
                    some = hits[a:a + MOST_ROWS]
                    raw = [b"\n".join(c.lines[i:i + n]) for i, n in zip(c.at[some].tolist(), c.count[some].tolist())]
                    again = []
                    for x in zip(c.of[some].tolist(), raw):
                        again.append(x in seen)
                        seen.add(x)
                    take = pa.array((c.of[some] + r).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(take), b.column(2).take(take), pa.array(c.start[some].astype(np.int32)),
                         pa.array(c.count[some].astype(np.int32)), pa.array(again, pa.bool_()), pa.array(raw, pa.binary())],
                        names=["doc_id", "same", "start", "count", "again", "raw"])

    found = written(frame.mapInArrow(tidy(gathered(bodies)), f"doc_id {at_kind.simpleString()}, same long, start int, count int, again boolean, raw binary")
                    .withColumn("key", F.xxhash64("raw")), "line-chunks")
    # Grouping by the bytes is the comparison.  As nearly every key then stands for one chunk, the
    # occurrences find their first place by the key alone, and only those of clashing keys by their bytes.
    clash = written(found.groupBy("key", "raw").agg(F.count("*").alias("n")).groupBy("key").agg(F.count("*").alias("chunks"))
                    .where("chunks > 1").select("key"), "line-clashes")
    places = ["doc_id", "same", "start", "count"]
    if clash.isEmpty():
        return later_places(found.drop("raw"), ["key"], docs, id_col).select(*places)
    apart = found.join(clash, "key", "left_anti").drop("raw")
    return (later_places(apart, ["key"], docs, id_col).select(*places)
            .unionByName(later_places(found.join(clash, "key", "left_semi"), ["key", "raw"], docs, id_col).select(*places)))


def strip(text: str, spans: list[tuple[int, int]], min_words: int) -> tuple[str, int, int]:
    """A text without its marked runs of at least ``min_words`` words; lines and words removed."""
    lines = text.split("\n")
    marked = np.zeros(len(lines) + 1, np.int32)
    for start, count in spans:
        if start + count <= len(lines):
            marked[start] += 1
            marked[start + count] -= 1
    inside = np.cumsum(marked)[:-1] > 0
    gone = np.zeros(len(lines), bool)
    words = 0
    i = 0
    while i < len(lines):
        if not inside[i]:
            i += 1
            continue
        j = i
        while j < len(lines) and inside[j]:
            j += 1
        n = sum(len(x.split()) for x in lines[i:j])
        if n >= min_words:
            gone[i:j] = True
            words += n
        i = j
    if not words:
        return text, 0, 0
    return "\n".join(x for x, g in zip(lines, gone) if not g), int(gone.sum()), words


def dedup(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``dedup_lines``, then repeated passages that start or end inside lines; both count as removed."""
    docs = without(docs, ("removed_lines", "removed_words"))
    names = docs.columns
    # The hash of the whole text goes along: rows that become equal only now are still two documents.
    lines = dedup_lines(docs.withColumn("__lb_text", F.xxhash64(docs[text_col])), min_words, id_col, text_col)
    cut = passages.dedup_passages(lines, min_words, id_col, text_col, "__lb_text")
    return cut.select(*names, (F.col("removed_lines") + F.col("cut_lines")).alias("removed_lines"),
                      (F.col("removed_words") + F.col("cut_words")).alias("removed_words"))


def dedup_lines(docs: DataFrame, min_words: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the stripped text, and ``removed_lines``, ``removed_words`` (long)."""
    docs = without(docs, ("removed_lines", "removed_words"))
    marks = (repeats(docs, min_words, id_col, text_col).groupBy("doc_id", "same")
             .agg(F.collect_list(F.struct("start", "count")).alias("__lb_spans"))  # bounded by the document's lines
             .withColumnsRenamed({"doc_id": "__lb_id", "same": "__lb_of"}))
    marks = written(marks, "line-marks")
    held = bit_map(marks.select(F.xxhash64("__lb_id").alias("at")), "at")
    names = docs.columns
    at, last = names.index(text_col), len(names)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [(t, 0, 0) if t is None or not s else strip(t, [(x["start"], x["count"]) for x in s], min_words)
                    for t, s in zip(b.column(at).to_pylist(), b.column(last).to_pylist())]
            cols = [pa.array([m[0] for m in made], b.schema.field(at).type) if i == at else b.column(i) for i in range(last)]
            yield pa.RecordBatch.from_arrays(
                cols + [pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.int64())],
                names=names + ["removed_lines", "removed_words"])

    whole, some = split_rows(docs, held, id_col)
    whole = whole.selectExpr("*", "0L AS removed_lines", "0L AS removed_words")
    # A sort-merge join at every size: the texts with marks are a share of all, never a side to broadcast,
    # and a plan that broadcast the marks of a small input would only hide the shuffle of a large one.
    joined = some.join(marks.hint("merge"), (some[id_col] == F.col("__lb_id")) & (F.xxhash64(some[text_col]) == F.col("__lb_of")),
                       "left").drop("__lb_id", "__lb_of")
    # Written, as what follows reads them more than once.
    stripped = written(joined.mapInArrow(tidy(run), f"{fields}, removed_lines long, removed_words long"), "line-stripped")
    return whole.unionByName(stripped)

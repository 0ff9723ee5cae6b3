"""Spelling variants: words one edit apart, found by PartEnum signatures of their letters, and the form each leads to.

Method.  A word is the multiset of its letters, a binary vector with one place for each letter and occurrence.  One
inserted, deleted or replaced letter changes at most two places.  The letters are dealt to PARTS partitions; whatever
two partitions the changed places lie in, the projections on the others are equal.  So each word is entered once for
each choice of two partitions left out (28 for 8), with a hash of that choice and the projection, and words that are
one edit apart meet in at least one entry: an exact scheme with n1 = 1 and n2 = PARTS, without a missed pair.  The
projection is kept in reading order, as letters outside the changed places keep it too: it holds the multiset, and
parts anagrams before any pair is made.  Pairs come from an equi-join of the entries whose condition verifies them
(an edit distance of exactly one), so no row is made of a pair that only shares an entry.

Forms.  A word's form is its near word with the largest count, if that is at least ``factor`` times its own.  Counts grow
along the way from form to form, so its length is bounded by the logarithm of the largest count, and the root
of all words is found by doubling: the logarithm of that many equi-joins.

Scale.  Texts are read once and give word counts, summed in the task and before the shuffle, so a frequent word is no
hot key.  What follows works on distinct words.  No entry collects its words; a large one is two sides of a sorted join.

Defined cases: null and empty texts have no runs; a null id counts as an empty one in the hash; rows that repeat an id are
counted row by row; ties of counts go to the smallest word by code points; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import UPPER, ship_code, short_batches, tidy, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(UPPER, UPPER.lower())
#: Partitions of the letters, and how many may hold changed places.
PARTS, CHANGED = 8, 2
#: Letters from frequent to rare in the languages of such texts, so that partitions get equal shares.
FREQUENT = "etaoinshrdlcumwfgypbvkjxqz"
LETTERS = FREQUENT + "".join(map(chr, range(0xC0, 0x100)))
#: Distinct words that a task gathers before it hands their counts on; characters searched at once.
GATHERED = 100_000
PIECE = 1 << 20


def runs(text: str) -> Counter:
    """How often each run stands in a text, lower-cased in A-Z."""
    if len(text) <= PIECE:
        found = Counter(RUN.findall(text))
    else:
        found = Counter(m.group() for m in RUN.finditer(text))  # no list of all the words of a huge text
    out: Counter = Counter()
    for run, n in found.items():
        out[run.lower() if run.isascii() else run.translate(LOWER)] += n
    return out


def misspelt(run: str, crc: int, every: int) -> str:
    """The run, without one code point if ``every`` divides its hash."""
    if crc % every:
        return run
    at = crc % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, every: int = 97, min_length: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the runs of whole texts, those that their hash misspells included."""
    ship_code(docs.sparkSession)
    short_batches(docs.sparkSession)
    frame = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("k"), docs[text_col].alias("t")).where("t != ''")

    def out(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seed = zlib.crc32(f"{key}:".encode())
                for word, n in runs(text).items():
                    word = misspelt(word, zlib.crc32(word.encode(), seed), every)
                    if len(word) >= min_length:
                        held[word] += n
                if len(held) >= GATHERED:
                    yield out(held)
                    held = Counter()
        yield out(held)

    return frame.mapInArrow(tidy(run), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def partitions(parts: int = PARTS) -> list[str]:
    """The letters of each partition: dealt forth and back from frequent to rare."""
    out = [""] * parts
    for k, letter in enumerate(LETTERS):
        turn, at = divmod(k, parts)
        out[at if turn % 2 == 0 else parts - 1 - at] += letter
    return out


def entries(words: DataFrame, parts: int = PARTS, changed: int = CHANGED) -> DataFrame:
    """``words`` with ``entry``: a row for each choice of partitions left out."""
    groups = partitions(parts)
    made = [F.xxhash64(F.lit(k), F.translate("word", "".join(groups[p] for p in left), ""))
            for k, left in enumerate(itertools.combinations(range(parts), changed))]
    return words.withColumn("entry", F.explode(F.array(*made)))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): pairs of words that differ by one edit, both ways."""
    rows = entries(words)
    a, b = rows.alias("a"), rows.alias("b")
    pairs = a.join(b.hint("merge"), F.expr("a.entry = b.entry AND a.word < b.word AND levenshtein(a.word, b.word, 1) = 1"))
    once = pairs.select(F.col("a.word").alias("word"), F.col("a.n").alias("n"), F.col("b.word").alias("near"),
                        F.col("b.n").alias("near_n")).distinct()
    return once.select(F.inline(F.expr("array(struct(word, n, near, near_n), struct(near AS word, near_n AS n, word AS near, n AS near_n))")))


def variants(docs: DataFrame, every: int = 97, min_length: int = 5, min_count: int = 3, factor: int = 2,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of each word of ``min_length`` letters that occurs ``min_count`` times."""
    words = written(word_counts(docs, every, min_length, id_col, text_col).where(F.col("n") >= min_count), "spell-words")
    pairs = near_words(words)
    # Strings compare by their bytes in UTF-8, which is the order of their code points.
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"),
                                     F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("best"))
    has = -F.col("best.n") >= factor * F.col("n")
    formed = written(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("best.word")).alias("form"),
        F.when(has, -F.col("best.n")).alias("form_n")), "spell-forms")
    # Each step multiplies the count by ``factor``, so ways have at most this many steps; a round doubles those gone.
    most = formed.agg(F.max("n").alias("n")).first()["n"] or 1
    steps = math.floor(math.log(max(most, 1), factor)) + 1
    way = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        on = way.select(F.col("word").alias("root"), F.col("root").alias("next"))
        way = written(way.join(on.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spell-way")
    return formed.join(way.hint("merge"), "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))

"""Document fingerprints by I-Match: terms of an idf band, hashed over randomised lexicon subsets.

Terms are runs of letters and digits, lower-cased.  The lexicon holds the terms whose share of all
documents lies between ``low`` and ``high``, so an idf band from ln(1/high) to ln(1/low): neither the
words of every text nor misspellings.  Each of ``SUBSETS`` random subsets of the lexicon gives one hash: of
the sorted distinct terms of the document that fall in the subset.  How many terms fall in a subset
depends on its rate; a document uses the rate that leaves a subset about one of its terms or fewer
(its level), and the next sparser one, so texts of similar length meet in a common level and the
share of equal hashes follows the share of common terms, for short and for very long texts alike.

The fingerprint is written ``level:hash.hash....;level:hash....`` with ``-`` for a subset without terms.
The likeness of two fingerprints is 1 if they are equal, else the share of equal hashes among the
subsets of their common levels in which either has terms (0 if there is none).

Scale.  Document frequencies are counted over all texts, per task first.  The lexicon has at most
(mean distinct terms of a document) / ``low`` terms whatever the corpus size, because each of its terms
is in at least ``low`` of all documents; it is sent to the tasks as hashes after a check of that bound.

``edits`` pairs each text with the next by id.  Ids are cut into ranges at quantiles; the first row
of a range is also dealt, as the "next" text, to the range before it, so each task reads its range in
order and needs no other.  Texts are shuffled once, compressed.

Defined cases: null text is empty; a text without terms of the lexicon: the hash of the whole text in
every subset of level 0, and in full, so only equal texts have equal ones; null ids sort first; equal ids are
ordered by text; a single document is its own next; very long texts are read whole; an empty table gives no rows; columns besides id and
text don't matter.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_code, short_batches, shuffle_partitions, tidy, written

SUBSETS = 64
#: The rates of the levels are 4^-level.
LEVELS = 12
#: Most terms a lexicon may have: 8 bytes each in every worker.
MAX_LEXICON = 8_000_000
#: Terms that a task counts before it hands its counts on.
HELD_TERMS = 400_000
TERM = re.compile(r"\w+")


def term_hashes(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the terms of a whole text."""
    from xxhash import xxh3_64_intdigest

    terms = set(TERM.findall((text or "").lower()))
    out = np.fromiter(map(xxh3_64_intdigest, terms), np.uint64, len(terms))
    out.sort()
    return out


def lexicon(docs: DataFrame, low: float = 1 / 5000, high: float = 1 / 20, text_col: str = "text") -> np.ndarray:
    """Sorted hashes of the terms in the band."""
    ship_code(docs.sparkSession)
    short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        held = docs_here = 0
        for b in batches:
            for text in b.column(0).to_pylist():
                parts.append(term_hashes(text))
                held += len(parts[-1])
                docs_here += 1
                if held > 8 * HELD_TERMS:
                    yield _counts(parts, docs_here)
                    parts, held, docs_here = [], 0, 0
        yield _counts(parts, docs_here)

    counts = docs.select(docs[text_col]).mapInArrow(tidy(run), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = written(counts, "terms")
    total = counts.where("term = 0").agg(F.sum("n").alias("n")).first()["n"] or 0
    band = counts.where((F.col("term") != 0) & (F.col("n") >= low * total) & (F.col("n") <= max(1.0, high * total)))
    size = band.count()
    if size > MAX_LEXICON:
        raise ValueError(f"the lexicon has {size} terms, {MAX_LEXICON} may be sent to tasks; raise low")
    return np.sort(band.select("term").toArrow()["term"].to_numpy().view(np.uint64))


def _counts(parts: list[np.ndarray], docs_here: int) -> pa.RecordBatch:
    """(term, documents); term 0 counts the documents."""
    terms, n = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64))
    return pa.RecordBatch.from_arrays([pa.array(np.append(terms[terms != 0].view(np.int64), 0)),
                                       pa.array(np.append(n[terms != 0], docs_here).astype(np.int64))], names=["term", "n"])


#: One odd multiplier per subset: the high bits of multiplier * term are the term's draw in it.
_SEEDS = (np.random.default_rng(17).integers(0, 1 << 63, SUBSETS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def fingerprint(text: str | None, band: np.ndarray) -> str:
    """The fingerprint of a whole text."""
    terms = term_hashes(text)
    if len(band):
        at = np.minimum(np.searchsorted(band, terms), len(band) - 1)
        kept = terms[band[at] == terms]
    else:
        kept = terms[:0]
    if not len(kept):
        whole = hashlib.sha256((text or "").encode("utf-8", "surrogatepass")).hexdigest()
        return "0:" + ".".join([whole[:4]] * SUBSETS) + ";x:" + whole
    level = min(LEVELS, max(0, round(np.log(len(kept)) / np.log(4) + 0.5)))
    # The subset of a level holds the terms whose draw falls under its rate, so that of the next level is
    # part of it.  Terms are distinct and sorted already.
    draws = kept[None, :] * _SEEDS[:, None]
    return ";".join(f"{lv}:{_hashes(kept, draws, lv)}" for lv in (level, level + 1))


def _hashes(kept: np.ndarray, draws: np.ndarray, level: int) -> str:
    """The hash of the terms of each subset of a level, dot by dot."""
    out = ["-"] * SUBSETS
    inside = draws < np.uint64(1 << (64 - 2 * level)) if level else np.ones(draws.shape, bool)
    subset, term = np.nonzero(inside)
    cuts = np.searchsorted(subset, np.arange(SUBSETS + 1)).tolist()
    members = kept[term].tobytes()
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if b > a:
            out[i] = f"{zlib.crc32(members[8 * a:8 * b], i) & 0xFFFF:04x}"
    return ".".join(out)


def likeness(a: str, b: str) -> float:
    """Share of equal hashes in the common levels, 0 to 1."""
    if a == b:
        return 1.0
    one, two = (dict(part.split(":") for part in x.split(";")) for x in (a, b))
    same = used = 0
    for level in one.keys() & two.keys():
        for x, y in zip(one[level].split("."), two[level].split(".")):
            if x != "-" or y != "-":
                used += 1
                same += x == y
    return same / used if used else 0.0


def fingerprints(docs: DataFrame, band: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id`` and ``fingerprint``."""
    ship_code(docs.sparkSession)
    short_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(band)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [fingerprint(t, sent.value) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.string())], names=["doc_id", "fingerprint"])

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        tidy(run), f"doc_id {kind}, fingerprint string")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Rows dealt to ranges of ids: ``part, ahead, doc_id, raw`` (text, zlib), sorted in each task.

    ``ahead`` marks the first row of the following range: the next text of the last row before it.
    """
    spark = docs.sparkSession
    ship_code(spark)
    short_batches(spark)
    ranges = ranges or shuffle_partitions(spark)
    key = F.coalesce(docs[id_col].cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(key.alias("key"), docs[text_col].alias("text"))
    quantiles = [i / ranges for i in range(1, ranges)]
    found = rows.agg(F.percentile_approx("key", quantiles, 10_000).alias("q")).first()["q"] if quantiles else None
    cuts = np.array(sorted(set(found or [])), np.int64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [(t or "").encode() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.searchsorted(cuts, b.column(0).to_numpy()).astype(np.int32)), b.column(0),
                 pa.array([zlib.compress(t, 1) for t in texts], pa.binary()), pa.array([zlib.crc32(t) for t in texts], pa.int64())],
                names=["part", "key", "raw", "tie"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(cuts, b.column(0).to_numpy()).astype(np.int32)), b.column(0)],
                                             names=["part", "key"])

    schema = "part int, key long, raw binary, tie long"
    packed = rows.mapInArrow(tidy(pack), schema).withColumn("ahead", F.lit(False))
    # The first row of each range that has rows: as many as there are ranges.
    lows = {r["part"]: r["key"] for r in rows.select("key").mapInArrow(tidy(places), "part int, key long").groupBy("part")
            .agg(F.min("key").alias("key")).collect()}
    if not lows:
        return packed
    order = sorted(lows)
    before = F.create_map(*[F.lit(x) for i, p in enumerate(order) for x in (p, order[i - 1])])
    firsts = (rows.where(F.col("key").isin(list(lows.values()))).mapInArrow(tidy(pack), schema).groupBy("part")
              .agg(F.min(F.struct("key", "tie", "raw")).alias("x")))
    return packed.unionByName(firsts.select(before[F.col("part")].alias("part"), "x.key", "x.raw", "x.tie", F.lit(True).alias("ahead")))


def edits(docs: DataFrame, band: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its fingerprint, that of its edited text and their likeness; see ``op5`` for the edit."""
    spark = docs.sparkSession
    short_batches(spark)
    rows = with_next(docs, id_col, text_col)
    sent = spark.sparkContext.broadcast(band)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # part, key, text, fingerprint of the row before
        for b in batches:
            out: list[tuple] = []
            for part, ahead, key, raw in zip(*(b.column(i).to_pylist() for i in range(4))):
                text = zlib.decompress(raw).decode()
                mine = fingerprint(text, sent.value)
                if held and held[0] == part:
                    cut = len(held[2]) - len(held[2]) // 2
                    edited = held[2][:cut] + text[:len(held[2]) // 2]
                    theirs = fingerprint(edited, sent.value)
                    out.append((None if held[1] == -(1 << 63) else held[1], len(held[2]),
                                hashlib.sha256(edited.encode()).hexdigest(), held[3], theirs,
                                likeness(held[3], theirs), likeness(held[3], mine)))
                held = None if ahead else (part, key, text, mine)
            cols = list(zip(*out)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()))],
                names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return (rows.repartition("part").sortWithinPartitions("part", "ahead", "key", "tie", "raw")
            .select("part", "ahead", "key", "raw")
            .mapInArrow(tidy(run), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                             "near_edited double, near_next double"))

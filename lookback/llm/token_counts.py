"""Token counts of whole texts; huge ones are encoded in overlapping chunks that are spliced where it is proven right.

Method.  A text of more than ``chunk`` characters is cut; each chunk after the first starts ``overlap`` characters
before the end of the one before it.  Both are encoded with the byte offsets of their tokens.  In the overlap a token
with the same id and the same offsets on both sides is looked for, and the tokens of the left chunk up to it are
continued by those of the right chunk after it.  If there is none, the overlap is doubled, at last to the whole left
chunk, which then is encoded together with the right one: no text is ever counted by guess.

Why this is right.  Byte-pair encoding merges the best pair anywhere, the leftmost of equal ones.  Tokens t1 .. tn are
the encoding of their text if and only if each two neighbours are the encoding of theirs: the first merge that crossed
from one token into the next would be the best one in those two tokens' text as well, as all merges before it, in both
runs, lie inside single tokens and come in the same order; and the other way round.  Neighbours in a chunk's encoding
are such pairs.  With a common token every two neighbours of the spliced row stand next to each other in one of the
two encodings, so the spliced row is the encoding of the whole text.  It doesn't matter that a chunk starts inside a
word, nor that the library puts a space before it: its first tokens are on the left of the common one and go.

The splice is used for models that are known to encode so (``vocab.Pieces.best_pair``); others encode whole texts.

Scale.  One pass without a shuffle; beside its Arrow batch a task holds the encoding of two chunks (of the text so far
only where chunks never meet) and four bytes for each token of the text it is at.

Defined cases: null and empty texts have 0 bytes and 0 tokens; rows that repeat an id are counted row by row; null ids are
kept; an empty table gives no rows; input columns called like one that is made are replaced.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_code, short_batches, tidy, without
from .vocab import open_tokenizer

#: Characters of a chunk of a huge text, and of the first overlap.
CHUNK, OVERLAP = 1 << 16, 128
#: Characters of texts that are handed to the library in one call.
CALL_CHARS = 1 << 18


def _common(left: tuple, right: tuple, shift: int, least: int) -> tuple[int, int] | None:
    """Positions of a token that both encodings have at the same bytes, on the left at ``least`` or after it.

    ``shift`` is the byte of the left one where the right one starts.  Any common token would do; it is the middle one.
    """
    first = max(least, int(np.searchsorted(left[2], shift, "right")))
    _, i, j = np.intersect1d(left[2][first:], right[2] + shift, return_indices=True)
    i += first
    same = (left[0][i] == right[0][j]) & (left[1][i] == right[1][j] + shift) & (left[1][i] < left[2][i])
    found = np.flatnonzero(same)
    if not len(found):
        return None
    k = found[len(found) // 2]
    return int(i[k]), int(j[k])


def splice(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> array:
    """The ids of a text, those of encoding it at once."""
    out = array("I")  # final ids on the left of ``held``
    start, stop, done = 0, min(chunk, len(text)), 0
    held = tokenizer.places(text[:stop])  # of text[start:stop]; its first ``done`` tokens are in ``out``
    while stop < len(text):
        end = min(stop + chunk, len(text))
        back = max(overlap, 1)
        while True:
            begin = max(stop - back, start)
            right = tokenizer.places(text[begin:end])
            if begin == 0:  # nothing stands on the left of it
                held, done = right, 0
                break
            seam = _common(held, right, len(text[start:begin].encode()), done - 1 if start else 0)
            if seam is not None:
                out.extend(held[0][done:seam[0] + 1].tolist())
                start, held, done = begin, right, seam[1] + 1
                break
            if begin == start:  # not even the whole left chunk settles it: from the first character on
                out, start, held, done = array("I"), 0, tokenizer.places(text[:end]), 0
                break
            back *= 2
        stop = end
    out.extend(held[0][done:].tolist())
    return out


def count(tokenizer, texts: list[str], chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Tokens of each text."""
    out = [0] * len(texts)
    group: list[int] = []
    chars = 0

    def settle() -> None:
        for k, ids in zip(group, tokenizer.encode([texts[k] for k in group])):
            out[k] = len(ids)

    for k, text in enumerate(texts):
        if len(text) > chunk and tokenizer.best_pair:
            out[k] = len(splice(tokenizer, text, chunk, overlap))
            continue
        group.append(k)
        chars += len(text)
        if chars >= CALL_CHARS:
            settle()
            group, chars = [], 0
    settle()
    return out


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 4096, text_col: str = "text",
                 chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """All columns of ``docs`` but the text, with ``n_bytes``, ``n_tokens`` (long) and ``over_limit``."""
    spark = docs.sparkSession
    ship_code(spark)
    short_batches(spark)
    made = ("n_bytes", "n_tokens", "over_limit")
    kept = [f for f in without(docs, made).schema if f.name != text_col]
    names = [f.name for f in kept]
    frame = docs.select(*[docs[n] for n in names], F.coalesce(F.octet_length(docs[text_col]), F.lit(0)).cast("long").alias("n_bytes"),
                        F.coalesce(docs[text_col], F.lit("")).alias("__lb_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = open_tokenizer(tokenizer_path)
        last = len(names) + 1
        for b in batches:
            n = count(tokenizer, b.column(last).to_pylist(), chunk, overlap)
            yield pa.RecordBatch.from_arrays([*b.columns[:last], pa.array(n, pa.int64())], names=[*names, "n_bytes", "n_tokens"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    counted = frame.mapInArrow(tidy(run), f"{fields}n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

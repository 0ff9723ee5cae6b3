"""Language identification: script ranges, per-word scores, Viterbi over the words with a switching penalty.

A word is a run of letters.  Its script (by code point ranges of its first letter) narrows the
languages that may have written it to those that use the script in the training texts.  Each letter
of a word scores every candidate with the log-probability of the character trigram around it (word
ends count as a character); a word's score is the sum, cut to ``word_cap`` below its best language.
Viterbi finds the best sequence of languages where each change costs ``penalty``, so a stray word
changes nothing and a passage in another language becomes a span of its own.  The score is the share of all
letters that the language has, times the logistic of its lead; letters of unknown scripts are no language's.

Training counts hashed trigrams of all labelled training texts with Spark, per task first, then
summed; the model has ``BUCKETS`` numbers per language whatever the corpus size, and is sent to
the tasks.  Each document is scored whole, in one pass, without a shuffle.

Defined cases: null text or no letter: ``und``, score 0, no spans; letters of a script that no
training text has: the most frequent language, score 0; no training rows: ``und`` for all; equal
scores: the language that sorts first; rows that repeat an id are judged row by row; an empty table gives no rows; input
columns called like one that is made are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship_code, short_batches, tidy, without

#: Trigram hash buckets per language: the model's size is this times the number of languages.
BUCKETS = 1 << 16
#: Most languages that a model may have (4 bytes per bucket each): a guard on what is sent to tasks.
MAX_LANGUAGES = 400
#: Letters scored together.
CHUNK = 1 << 19

#: First and last code point of scripts.
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x06FF),
    ("arabic", 0x0750, 0x077F), ("syriac", 0x0700, 0x074F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("gurmukhi", 0x0A00, 0x0A7F), ("gujarati", 0x0A80, 0x0AFF), ("tamil", 0x0B80, 0x0BFF), ("telugu", 0x0C00, 0x0C7F),
    ("kannada", 0x0C80, 0x0CFF), ("malayalam", 0x0D00, 0x0D7F), ("thai", 0x0E00, 0x0E7F), ("lao", 0x0E80, 0x0EFF),
    ("tibetan", 0x0F00, 0x0FFF), ("myanmar", 0x1000, 0x109F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF),
    ("hangul", 0xAC00, 0xD7AF), ("ethiopic", 0x1200, 0x137F), ("khmer", 0x1780, 0x17FF), ("mongolian", 0x1800, 0x18AF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("han", 0x20000, 0x2FA1F),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(s for s, _, _ in SCRIPTS)]

_tables: list[tuple[np.ndarray, np.ndarray]] = []


def tables() -> tuple[np.ndarray, np.ndarray]:
    """(lower-case code point of each letter, else 0; script of each code point)."""
    if not _tables:
        lower = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                lower[i] = ord(low) if len(low) == 1 else i
        script = np.zeros(0x110000, np.uint8)
        for name, a, b in SCRIPTS:
            script[a:b + 1] = SCRIPT_NAMES.index(name)
        _tables.append((lower, script))
    return _tables[0]


def letters(text: str | None) -> np.ndarray:
    """Lower-case code points, 0 for all that is no letter, with a 0 before and after."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(len(points) + 2, np.uint32)
    out[1:-1] = tables()[0][points]
    return out


def trigrams(c: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Bucket of the trigram around each letter position."""
    h = c[at - 1] * np.uint32(0x9E3779B1) ^ c[at] * np.uint32(0x85EBCA77) ^ c[at + 1] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    return ((h * np.uint32(0x2C1B3C6D)) >> np.uint32(16)).astype(np.int64) & (BUCKETS - 1)


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray, docs: np.ndarray) -> None:
        self.langs = langs
        total = counts.sum(axis=1, keepdims=True) + 0.5 * counts.shape[1]
        self.logp = np.log((counts + 0.5) / total).astype(np.float32).T.copy()  # bucket x language
        share = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
        self.uses = (share >= 0.001).T  # script x language
        self.common = int(np.argmax(docs)) if len(docs) else 0

    def known(self, points: np.ndarray) -> np.ndarray:
        """Whether any language uses the script of each letter."""
        return self.uses.any(axis=1)[tables()[1][points]]


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts over all given rows with a language; what comes to the driver is bounded by languages x buckets."""
    ship_code(docs.sparkSession)
    short_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        scripts = tables()[1]
        size = BUCKETS + len(SCRIPT_NAMES) + 1
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if lang not in held:
                    held[lang] = np.zeros(size, np.int64)
                n = held[lang]
                c = letters(text)
                at = np.flatnonzero(c)
                n += np.bincount(trigrams(c, at), minlength=size)
                n[BUCKETS:-1] += np.bincount(scripts[c[at]], minlength=len(SCRIPT_NAMES))
                n[-1] += 1
        for lang, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                                             names=["lang", "at", "n"])

    part = docs.select(docs[text_col].alias("text"), docs[lang_col].cast("string").alias("lang")).where(
        "text is not null and lang is not null").mapInArrow(tidy(run), "lang string, at int, n long")
    rows = part.groupBy("lang", "at").agg(F.sum("n").alias("n"))
    table = rows.toArrow()
    langs = sorted(set(table["lang"].to_pylist()))
    if len(langs) > MAX_LANGUAGES:
        raise ValueError(f"{len(langs)} languages; a model may have {MAX_LANGUAGES}")
    full = np.zeros((len(langs), BUCKETS + len(SCRIPT_NAMES) + 1), np.float64)
    index = {x: i for i, x in enumerate(langs)}
    full[np.array([index[x] for x in table["lang"].to_pylist()], np.int64), table["at"].to_numpy()] = table["n"].to_numpy()
    return Model(langs, full[:, :BUCKETS], full[:, BUCKETS:-1], full[:, -1])


def word_scores(model: Model, c: np.ndarray, word_cap: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first position, length, scores by language relative to the best) of each word."""
    at = np.flatnonzero(c)
    if not len(at):
        return at, at, np.zeros((0, len(model.langs)), np.float32)
    begins = np.flatnonzero(c[at - 1] == 0)
    n = np.diff(np.append(begins, len(at)))
    scores = np.concatenate([np.add.reduceat(model.logp[trigrams(c, at[a:b])], begins[i:j] - a, axis=0) for i, j, a, b in _chunks(begins, len(at))])
    may = model.uses[tables()[1][c[at[begins]]]]
    known = may.any(axis=1)
    scores[~may & known[:, None]] = -np.inf
    scores -= scores.max(axis=1, keepdims=True)
    np.maximum(scores, -word_cap, out=scores)
    scores[~known] = 0
    return at[begins], n, scores


def _chunks(begins: np.ndarray, total: int) -> Iterator[tuple[int, int, int, int]]:
    """Runs of whole words of about CHUNK letters: (first word, end word, first letter, end letter)."""
    i = 0
    while i < len(begins):
        j = max(i + 1, int(np.searchsorted(begins, begins[i] + CHUNK)))
        yield i, j, int(begins[i]), int(begins[j]) if j < len(begins) else total
        i = j


def viterbi(scores: list[np.ndarray], penalty: float) -> list[np.ndarray]:
    """Best language of each word of each document; documents advance together, one word a step."""
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(scores)
    todo = []
    for d, s in enumerate(scores):
        if not len(s):
            continue
        base = int(np.argmax(s.sum(axis=0)))
        # If no run of words gains more than half a penalty by any other language, no change ever pays.
        rel = np.cumsum(s - s[:, base:base + 1], axis=0)
        low = np.minimum.accumulate(np.vstack([np.zeros((1, rel.shape[1]), rel.dtype), rel]), axis=0)[:-1]
        if float((rel - low).max()) <= penalty / 2:
            out[d] = np.full(len(s), base)
        else:
            todo.append(d)
    todo.sort(key=lambda d: len(scores[d]))
    for a in range(0, len(todo), 64):
        group = todo[a:a + 64]
        longest, langs = len(scores[group[-1]]), scores[group[0]].shape[1]
        s = np.zeros((longest, len(group), langs), np.float32)
        for g, d in enumerate(group):
            s[:len(scores[d]), g] = scores[d]
        back = np.empty((longest, len(group), langs), np.int16)
        best = np.zeros((len(group), langs))
        own = np.arange(langs, dtype=np.int16)[None, :]
        for w in range(longest):
            if w:
                top = best.argmax(axis=1)
                change = np.take_along_axis(best, top[:, None], axis=1) - penalty
                back[w] = np.where(change > best, top[:, None], own)
                best = np.maximum(best, change)
            best = best + s[w]
        path = np.empty((longest, len(group)), np.int64)
        path[-1] = best.argmax(axis=1)
        rows = np.arange(len(group))
        for w in range(longest - 1, 0, -1):
            path[w - 1] = back[w][rows, path[w]]
        for g, d in enumerate(group):
            out[d] = path[:len(scores[d]), g]
    return out


def label(texts: list[str | None], model: Model, penalty: float, word_cap: float) -> list[tuple[str, float, list[dict]]]:
    """(language, score, spans) of each whole text; spans count code points, without the end."""
    if not model.langs:
        return [("und", 0.0, [])] * len(texts)
    points = [letters(t) for t in texts]
    words = [word_scores(model, c, word_cap) for c in points]
    out = []
    for c, (at, n, scores), path in zip(points, words, viterbi([w[2] for w in words], penalty)):
        if not len(at):
            out.append(("und", 0.0, []))
            continue
        known = model.known(c[at])
        if not known.any():
            lang = model.langs[model.common]
            out.append((lang, 0.0, [{"start": int(at[0]) - 1, "end": int(at[-1] + n[-1]) - 1, "lang": lang}]))
            continue
        held = np.bincount(path, weights=n * known, minlength=len(model.langs))
        top = int(np.argmax(held))
        total = scores.sum(axis=0)
        rest = np.delete(total, top)
        margin = float(total[top] - rest.max()) / np.sqrt(len(at)) if len(rest) else 50.0
        score = float(held[top] / n.sum() / (1 + np.exp(-min(50.0, max(-50.0, margin)))))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(path)) + 1, [len(path)]])
        out.append((model.langs[top], score, [
            {"start": int(at[a]) - 1, "end": int(at[b - 1] + n[b - 1]) - 1, "lang": model.langs[path[a]]}
            for a, b in zip(cuts, cuts[1:])]))
    return out


#: Below this score no language has most of a text's letters, or another one fits the whole of it better.
LEAST_SCORE = 0.5
#: From this score on, a prediction that is not the label's language contradicts the label.
SURE_SCORE = 0.9


def accepted(lang_col: str = "lang") -> Column:
    """Whether language ID accepts a row of ``with_language``: letters, one main language, no sure contradiction of its label."""
    return ((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)
            & (F.col(lang_col).isNull() | (F.col("lang_pred") == F.col(lang_col)) | (F.col("score") < SURE_SCORE)))


def held_out(id_col: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text falls in this part of ``parts``; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % parts == part, F.lit(False))


def identify(docs: DataFrame, model: Model, penalty: float = 14.0, word_cap: float = 8.0, id_col: str = "doc_id",
             text_col: str = "text", spans: bool = True) -> DataFrame:
    """Per row: the id column, ``lang_pred``, ``score`` and ``spans`` (start, end, lang)."""
    frame = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return with_language(frame, model, penalty, word_cap, "text", spans).drop("text")


def with_language(docs: DataFrame, model: Model, penalty: float = 14.0, word_cap: float = 8.0,
                  text_col: str = "text", spans: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` with ``lang_pred``, ``score`` and, if asked for, ``spans``."""
    ship_code(docs.sparkSession)
    short_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS numbers
    docs = without(docs, ("lang_pred", "score", "spans"))
    names, at = docs.columns, docs.columns.index(text_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            texts, size = [], 0
            for t in b.column(at).to_pylist():
                texts.append(t)
                size += len(t or "")
                if size > 2 * CHUNK:
                    made += label(texts, sent.value, penalty, word_cap)
                    texts, size = [], 0
            made += label(texts, sent.value, penalty, word_cap)
            out = [*b.columns, pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())]
            yield pa.RecordBatch.from_arrays(out + ([pa.array([m[2] for m in made], span)] if spans else []),
                                             names=names + ["lang_pred", "score"] + (["spans"] if spans else []))

    more = ", spans array<struct<start: int, end: int, lang: string>>" if spans else ""
    return docs.mapInArrow(tidy(run), f"{fields}, lang_pred string, score double{more}")

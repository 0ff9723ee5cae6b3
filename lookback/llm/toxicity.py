"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

Features are the distinct character n-grams (``SIZES``) of a text's words: runs of letters, lower-cased,
with a mark at both ends, hashed to ``BUCKETS`` buckets.  For each bucket the log-ratio of its smoothed
document frequencies in the two classes (the naive Bayes log-count ratio) scales the feature, and a
logistic regression with L2 penalty is fitted on the scaled features.  A text's margin is the sum over
its distinct n-grams; the score is the logistic function of it.

The classifier is fitted on at most ``per_class`` labelled rows of each class (4,000 by default), the
first ones by a hash of their id; that bound, not the corpus, sets what comes to the driver.  The model
has ``BUCKETS`` numbers.  Every document is scored whole, in one pass, without a shuffle.

Defined cases: null or empty text, or no letters: the score of no features (the intercept); no labelled
rows: score 0 for all; one class only: the share of that class; a document labelled both ways counts
as toxic; labels without a document, null labels and null ids are left out of the fit; long texts are scored whole; of rows that
repeat an id one counts in the fit, and each is scored; an empty table gives no rows; columns besides those named don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_code, short_batches, tidy
from .lang_id import letters

BUCKETS = 1 << 18
SIZES = (3, 4, 5)
#: Letters hashed together.
CHUNK = 1 << 20


def features(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of the n-grams of a whole text."""
    c = letters(text)
    keep = (c[1:] != 0) | (c[:-1] != 0)  # one mark between words is enough
    c = np.concatenate([[0], c[1:][keep]]).astype(np.uint32)
    found = []
    for a in range(0, max(1, len(c)), CHUNK):
        part = c[a:a + CHUNK + max(SIZES) - 1]
        for n in SIZES:
            if len(part) < n:
                continue
            count = len(part) - n + 1
            h = np.full(count, n, np.uint32)
            inner = np.zeros(count, bool)  # a mark may only be the first or the last character
            for i in range(n):
                x = part[i:count + i]
                h = (h ^ x) * np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
                if 0 < i < n - 1:
                    inner |= x == 0
            h = (h * np.uint32(0x2C1B3C6D)) >> np.uint32(14)
            found.append(np.unique(h[~inner]))
    return np.unique(np.concatenate(found)).astype(np.int32) if found else np.empty(0, np.int32)


class Model:
    def __init__(self, weights: np.ndarray, intercept: float) -> None:
        self.weights, self.intercept = weights.astype(np.float32), intercept

    def score(self, text: str | None) -> float:
        margin = self.intercept + float(self.weights[features(text)].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-min(50.0, max(-50.0, margin)))))


def fit(rows: list[np.ndarray], labels: np.ndarray, smoothing: float = 1.0, penalty: float = 1e-3,
        epochs: int = 12, rate: float = 0.05) -> Model:
    """Logistic regression on scaled features by Adagrad over blocks of documents, classes weighted alike."""
    positive = int(labels.sum())
    if not len(rows):
        return Model(np.zeros(BUCKETS), -50.0)
    if positive in (0, len(rows)):
        return Model(np.zeros(BUCKETS), 50.0 if positive else -50.0)
    size = np.array([len(r) for r in rows])
    held = np.zeros((2, BUCKETS))
    for r, y in zip(rows, labels):
        held[y, r] += 1  # a text's buckets are distinct
    ratio = np.log((held[1] + smoothing) / (positive + 2 * smoothing)) - np.log(
        (held[0] + smoothing) / (len(rows) - positive + 2 * smoothing))
    w, b = np.zeros(BUCKETS), 0.0
    grad2, grad2_b = np.full(BUCKETS, 1e-6), 1e-6
    rng = np.random.default_rng(11)
    balance = np.where(labels == 1, len(rows) / (2 * positive), len(rows) / (2 * (len(rows) - positive)))
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), 64):
            part = order[a:a + 64]
            cols = np.concatenate([rows[i] for i in part])
            n = size[part]
            owner = np.repeat(np.arange(len(part)), n)
            x = ratio[cols]
            margin = np.bincount(owner, weights=x * w[cols], minlength=len(part)) + b
            error = (1 / (1 + np.exp(-np.clip(margin, -50, 50))) - labels[part]) * balance[part] / len(part)
            at, back = np.unique(cols, return_inverse=True)
            g = np.bincount(back, weights=x * error[owner]) + penalty * w[at]
            grad2[at] += g * g
            w[at] -= rate * g / np.sqrt(grad2[at])
            gb = error.sum()
            grad2_b += gb * gb
            b -= rate * gb / np.sqrt(grad2_b)
    return Model(w * ratio, float(b))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 4000, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", class_bytes: int = 128 << 20) -> Model:
    """Fit on the first ``per_class`` labelled documents of each class by a hash of the id.

    A document is an id: of rows that repeat one, the text with the smallest hash counts.  Documents are taken in that order as
    long as their features fill at most ``class_bytes`` (the first one always), so what reaches the driver is
    bounded in rows and in bytes.
    """
    ship_code(docs.sparkSession)
    short_batches(docs.sparkSession)
    named = (labels.select(labels[id_col].alias("_id"), labels[label_col].cast("int").alias("_label"))
             .where("_id is not null and _label in (0, 1)").groupBy("_id").agg(F.max("_label").alias("_label")))
    some = [named.where(F.col("_label") == k).orderBy(F.xxhash64(F.col("_id").cast("string")), "_id").limit(per_class) for k in (0, 1)]
    chosen = some[0].unionByName(some[1])  # at most 2 * per_class rows
    texts = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text")).join(F.broadcast(chosen), "_id")
    # One text of each id, by two long numbers that are summed up in the tasks; then the texts themselves.
    most = F.least(F.lit(BUCKETS), 3 * F.coalesce(F.length("_text"), F.lit(0)) + 8) * 4
    one = texts.groupBy("_id", "_label").agg(F.min(F.xxhash64("_text")).alias("_hash"), F.max(most).alias("_bytes"))
    # A window over at most 2 * per_class rows.
    order = Window.partitionBy("_label").orderBy(F.xxhash64(F.col("_id").cast("string")), "_id").rowsBetween(Window.unboundedPreceding, 0)
    within = (one.withColumn("_sum", F.sum("_bytes").over(order)).withColumn("_rank", F.count("*").over(order))
              .where((F.col("_sum") <= class_bytes) | (F.col("_rank") == 1)).select("_id", "_hash"))
    rows = (texts.withColumn("_hash", F.xxhash64("_text")).join(F.broadcast(within), ["_id", "_hash"])
            .select("_id", "_text", "_label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            made = [features(t).tobytes() for t in x.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(2), pa.array(made, pa.binary())], names=["id", "label", "found"])

    kind = labels.schema[id_col].dataType.simpleString()
    # Equal rows of one id are equal features: one of them.
    held = (rows.mapInArrow(tidy(run), f"id {kind}, label int, found binary").groupBy("id", "label").agg(F.min("found").alias("found"))
            .toArrow().sort_by("id"))
    return fit([np.frombuffer(f.as_buffer(), np.int32) for f in held["found"]], held["label"].to_numpy())


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``score`` and ``predicted`` (1 from 0.5 on)."""
    ship_code(docs.sparkSession)
    short_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            made = [sent.value.score(t) for t in x.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([x.column(0), pa.array(made, pa.float64()), pa.array([int(s >= 0.5) for s in made], pa.int32())],
                                             names=["doc_id", "score", "predicted"])

    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        tidy(run), f"doc_id {kind}, score double, predicted int")

"""The corpus pipeline: language ID, line dedup, near-duplicates, mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a frame, which is
written as Parquet and read again as the next one's ``docs``.  All but the last return the columns
of ``documents``.

* language: rows go whose text has no letter (``und``), no main language (a score under 0.5, also by letters of
  scripts that no labelled text has), or surely another language than its label (a score of 0.9 or more); a
  missing language is filled with the one found.
* lines: repeated passages are removed from texts; a text with nothing left (all of it stands in
  earlier documents) goes.  Texts that were empty before are no passage's copy and stay.
* near: of each group of near-duplicates (five words, 0.8) the smallest id stays; then repeated passages that
  start or end inside lines are removed from what stays (before, near-duplicates would be cut to fragments
  that no longer look alike), and a text with nothing left goes.
* mixing: documents are sampled to the raked source, language and topic shares.
* packing: the pieces of what is left, placed in sequences of 2048 tokens.

Defined cases, for every stage: an empty table gives no rows; null and empty texts have no letter, so language ID rejects
them; a null source is a value of its own in mixing; null ids stay (they are no one's copy); rows that repeat an id are judged
as the operators say; ties go to the smallest id.  Columns besides those of ``documents`` are kept up to packing; one called like
a column that an operator makes is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lookback.llm import lang_id, line_dedup, mixing, near_dup, packing, passages
from lookback.llm.common import written
from lookback.llm.queries import MIX_TARGETS, tokenizer_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that language ID accepts, whole; ids repeat only if they do in ``docs`` (then they are judged row by row)."""
    model = lang_id.train(docs)
    return lang_id.with_language(docs, model).where(lang_id.accepted()).select(
        *[F.coalesce("lang", "lang_pred").alias(c) if c == "lang" else F.col(c) for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(line_dedup.dedup_lines(docs).where("removed_lines = 0 or text != ''"), docs)


def _measured(stripped: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with ``n_chars`` of the stripped text."""
    return stripped.select(*[F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
                             for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    one = written(near_dup.keep_one(docs), "near-one")
    return _measured(passages.dedup_passages(one).where("cut_words = 0 or text != ''"), docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, MIX_TARGETS).where("mix_kept").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(docs, tokenizer_path())
    return packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))


STAGES = [("language", language), ("lines", lines), ("near", near), ("mixing", mix), ("packing", pack)]

#: Languages, near-duplicates and token ids can't be expressed in SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``; each result is a table of the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

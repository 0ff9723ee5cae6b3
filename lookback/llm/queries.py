"""The registered queries over the given tables; each gets its rows through its operator."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, ann, fingerprint, html_text, lang_id, line_dedup, mixing, near_dup, packing, spelling,
               token_counts, toxicity, url_rules)

#: The rules of op1: (verdict, host/path).
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]

#: The targets of op10 and the pipeline: temperatures that flatten the shares of source, language and topic.
MIX_TARGETS = {"source": 0.8, "lang": 0.9, "topic": 0.9}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public tokenizer's file: in the folder $LOOKBACK_TOKENIZERS, else that of the installed package."""
    folder = os.environ.get("LOOKBACK_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_rules.judge(table(spark, sf_dir, "pages"), url_rules.rules_frame(spark, URL_RULES), keep=["page_id"])
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=3, num=85, den=100)


def op3_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", lang_id.held_out(F.col("doc_id"), 4, 2))
    model = lang_id.train(docs.where("not held_out and doc_id is not null"))
    found = lang_id.identify(docs, model, spans=False)
    return found.select("doc_id", lang_id.held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return fingerprint.edits(docs, fingerprint.lexicon(docs))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~lang_id.held_out(F.col("doc_id"), 5, 0)))
    return toxicity.score(docs, model).select("doc_id", lang_id.held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "removed_lines", "removed_words")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize(table(spark, sf_dir, "documents"), tokenizer_path())
    items = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(items, 2048)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"), MIX_TARGETS)
    return mixed.select("doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("tokens"),
                        F.round("mix_weight", 6).alias("weight"), F.round("mix_probability", 6).alias("probability"),
                        F.col("mix_kept").alias("kept"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, tokenizer_path("piece_bpe_32k.model"), limit=4096)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.agreement(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_url_rules, op2_near_dup, op3_lang_id, op4_ann, op5_fingerprint, op6_toxicity, op7_line_dedup, op8_packing, op9_html_text,
                                      op10_mixing, op11_token_counts, op12_spelling, op13_alignment)}

"""Packing (exact round trip, tight bins), mixing (SQL, targets), the pipeline and the guard of the entry file."""

import os
import random
import shutil
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest import ROOT, SMOKE_DIR
from llm.helpers import DOCS, doc, prose, random_words, tables
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lookback.llm import mixing, packing, queries
from lookback.llm.oracle import ORACLE_SQL


def check_bins(rows, capacity):
    bins = defaultdict(list)
    for sequence, offset, length in rows:
        bins[sequence].append((offset, length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_token_ids_equal_whole_encoding():
    whole = packing.WordIds(queries.tokenizer_path())
    rng = random.Random(3)
    odd = ["a", "É", "é", "é", "́", " ", "\n", "'s", "'ll", "ſ", "ß", "İ", "Σ", "ς", "1", "²", "½", "٣", "<|endoftext|>", "<|", "###",
           "…", "“", "\x1c", "\x85", "\xa0", " ", "中", "文", "한", "😀", "‍", "﻿", "_", "ª", "Ⅷ", "ﬁ", "ẞ", "Ω", "ά", "​", "ท", "क"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(0, 12))) for _ in range(3000)] + [prose(rng, "fr", 300), "x" * 50000, ""]
    for text, got in zip(texts, whole.batch(texts)):
        assert np.frombuffer(got, "<u4").tolist() == whole.tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)


def test_packing_query_round_trip(spark, tmp_path):
    rng = random.Random(1)
    rows = [doc(i, random_words(rng, rng.choice([1, 5, 50, 300, 900, 5000]))) for i in range(150)]
    rows += [doc(900, None), doc(901, ""), doc(902, "<|endoftext|> a"), doc(903, "a " * 2047), doc(904, "a " * 2048), doc(None, "nobody"),
             doc(5, rows[5][1]), doc(5, rows[5][1])]
    root = tables(spark, str(tmp_path), documents=spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", offset string"))
    out = queries.op8_packing(spark, root).collect()
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    want, total = Counter(), 0
    for d, text, *_ in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        total += len(ids)
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want[d, piece, at, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == want
    bins = check_bins([(r.sequence_id, r.offset, r.length) for r in out], 2048)
    alone = len(packing.best_fit(sorted((k[3] for k in want.elements()), reverse=True), 2048))
    assert -(-total // 2048) <= bins <= alone * 1.01 + 1


@pytest.mark.parametrize("lengths", [[1] * 5000, [1025] * 300, [2048] * 50, [700, 1348] * 400, list(range(1, 2049))])
def test_packing_in_rounds(spark, lengths):
    items = spark.createDataFrame([(i, n, "o") for i, n in enumerate(lengths)], "item long, length long, offset string")
    out = packing.pack(items, 2048, task_items=200)
    assert out.columns == ["item", "length", "sequence_id", "offset"]
    rows = out.collect()
    assert sorted((r.item, r.length) for r in rows) == list(enumerate(lengths))
    bins = check_bins([(r.sequence_id, r.offset, r.length) for r in rows], 2048)
    least = max(-(-sum(lengths) // 2048), sum(n > 1024 for n in lengths))
    assert bins <= least * 1.03 + 2


def test_packing_of_nothing_and_of_bad_lengths(spark, tmp_path):
    root = tables(spark, str(tmp_path), documents=spark.createDataFrame([], DOCS))
    assert queries.op8_packing(spark, root).count() == 0
    for bad in (0, 2049, None):
        with pytest.raises(Exception, match="length"):
            packing.pack(spark.createDataFrame([(1, bad)], "item long, length long")).count()


def test_best_fit_takes_the_fullest_bin():
    assert packing.best_fit([6, 5, 4, 5], 10) == [[0, 2], [1, 3]]
    assert packing.best_fit([7, 6, 3, 2, 4], 10) == [[0, 2], [1, 3], [4]]


EDGE = [doc(900, None, None, None), doc(901, "", "en", None), doc(902, "a | b | c", None, "s"), doc(903, "HO!! HO!!"), doc(904, "### %%% $$$ x"),
        doc(None, "none", "en", "s"), doc(5, "again", "fr", "t"), doc(905, "w " * 40000, "en", "s")]


@pytest.mark.parametrize("given", [False, True])
def test_mixing_matches_sql(spark, tmp_path, given):
    if given and not os.path.isdir(SMOKE_DIR):
        pytest.skip("no driver test data")
    root = SMOKE_DIR
    if not given:
        rng = random.Random(2)
        rows = [doc(i, prose(rng, "en", rng.randint(1, 200)), rng.choice(["en", "fr", "de"]), "hot" if i % 3 else f"s{i % 7}") for i in range(300)]
        root = tables(spark, str(tmp_path), documents=spark.createDataFrame(rows + EDGE, DOCS))
    con = duckdb.connect()
    path = f"{root}/documents.parquet" + ("" if os.path.isfile(f"{root}/documents.parquet") else "/*.parquet")
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    want = con.execute(ORACLE_SQL["op10_mixing"])
    names = [c[0] for c in want.description]
    got = [tuple(r) for r in queries.op10_mixing(spark, root).select(*names).collect()]
    assert sorted(got, key=repr) == sorted(want.fetchall(), key=repr)
    assert not any(x in queries.op10_mixing(spark, root)._jdf.queryExecution().toString() for x in ("Python", "Pandas", "MapInArrow"))


def test_raked_shares_reach_their_targets(spark):
    rng = random.Random(6)
    rows = [doc(i, prose(rng, "en", rng.randint(50, 150)), rng.choice(["en", "fr"]), "hot" if i % 3 else rng.choice("abc")) for i in range(1500)]
    docs = spark.createDataFrame([(*r, "m") for r in rows], DOCS + ", mix_kept string")
    sources = spark.createDataFrame([("hot", 1.0), ("a", 1.0), ("b", 2.0), ("nowhere", 5.0)], "v string, w double")
    out = mixing.mix(docs, {"source": sources, "lang": 0.0, "topic": 1.0}, cycles=20)
    assert out.columns[:6] == ["doc_id", "text", "lang", "source", "n_chars", "mix_topic"]
    shares = {}
    for dim in ("source", "lang"):
        got = out.groupBy(dim).agg(F.sum(F.col("mix_tokens") * F.col("mix_probability")).alias("t")).collect()
        total = sum(r.t for r in got)
        shares |= {r[dim]: r.t / total for r in got}
    for name, want in (("hot", 0.25), ("a", 0.25), ("b", 0.5), ("c", 0.0), ("en", 0.5), ("fr", 0.5)):
        assert abs(shares[name] - want) < 1e-3, (name, shares)
    chosen = out.where("mix_kept").agg(F.sum("mix_tokens").alias("t")).first()["t"]
    hoped = out.agg(F.sum(F.col("mix_tokens") * F.col("mix_probability")).alias("t")).first()["t"]
    assert abs(chosen / hoped - 1) < 0.15
    assert out.agg(F.max("mix_probability")).first()[0] == 1.0


def test_mixing_dealt_by_dimension_is_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([doc(i, "a b c", "en" if i % 2 else "fr", f"s{i % 9}") for i in range(90)], DOCS)
    one = sorted(map(tuple, mixing.mix(docs, queries.MIX_TARGETS).select("doc_id", F.round("mix_weight", 9), "mix_kept").collect()))
    monkeypatch.setattr(mixing, "ONE_TASK_CELLS", 0)
    assert sorted(map(tuple, mixing.mix(docs, queries.MIX_TARGETS).select("doc_id", F.round("mix_weight", 9), "mix_kept").collect())) == one
    assert mixing.mix(docs.limit(0), queries.MIX_TARGETS).count() == 0


def test_pipeline_stages(spark, tmp_path):
    rng = random.Random(4)
    passage = "\n".join(random_words(rng, 20) for _ in range(4))
    base = random_words(rng, 200)
    rows = [doc(i, prose(rng, lang, rng.randint(40, 200)), lang) for i, lang in enumerate(["en", "fr", "de"] * 30)]
    rows += [doc(100 + i, random_words(rng, 60) + "\n" + passage + "\n" + random_words(rng, 60)) for i in range(5)]
    rows += [doc(200, base), doc(201, base + " more"), doc(202, base), doc(300, "12345 !!!"), doc(301, None), doc(302, "Kurz.", None)]
    root = tables(spark, str(tmp_path), documents=spark.createDataFrame(rows, DOCS))
    docs, seen = spark.read.parquet(f"{root}/documents.parquet"), {}
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, root)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        out.write.parquet(f"{root}/{at}")
        docs = spark.read.parquet(f"{root}/{at}")
        seen[name] = {r.doc_id: r for r in docs.collect()} if name != "packing" else docs.collect()
    clean = {r[0] for r in rows} - {300, 301}
    assert set(seen["language"]) == clean and seen["language"][302]["lang"] in ("en", "fr", "de")
    assert set(seen["lines"]) == clean - {202}  # an exact copy: all of it is a repeated passage
    assert passage in seen["lines"][100].text and not any(passage.split("\n")[1] in seen["lines"][100 + i].text for i in range(1, 5))
    assert all(seen["lines"][i].text == rows[i][1] and r.n_chars == len(r.text) for i, r in seen["lines"].items() if i < 90)
    assert set(seen["near"]) == set(seen["lines"]) - {201}
    assert set(seen["mixing"]) < set(seen["near"]) and len(seen["mixing"]) > 20
    assert {r.doc_id for r in seen["packing"]} == set(seen["mixing"])
    check_bins([(r.sequence_id, r.offset, r.length) for r in seen["packing"]], 2048)
    run = corpus_pipeline.run(spark, root).collect()
    key = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[k] for k in key) for r in run) == sorted(tuple(r[k] for k in key) for r in seen["packing"])


def test_pipeline_on_an_empty_table(spark, tmp_path):
    root = tables(spark, str(tmp_path), documents=spark.createDataFrame([], DOCS))
    assert corpus_pipeline.run(spark, root).count() == 0


def test_entry_without_the_operators(tmp_path):
    """The entry file works where the folders of the operators and the pipeline file are gone."""
    for name in ("__spark_entry__.py", "lookback"):
        copy = shutil.copytree if os.path.isdir(f"{ROOT}/{name}") else shutil.copy
        if name == "lookback":
            copy(f"{ROOT}/{name}", tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            copy(f"{ROOT}/{name}", tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'q_matrix_all' in q and not any(k.startswith('op') for k in q); assert set(e.oracle_sql()) == set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_every_operator_is_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names

"""op11: splicing equals whole encoding, at any chunk and overlap; the query against the library, and its edge rows."""

import random

import pytest
from helpers import DOCS, doc, prose, random_words, tables

from lookback.llm import queries
from lookback.llm.queries import tokenizer_path
from lookback.llm.token_counts import count, splice, token_counts
from lookback.llm.vocab import open_tokenizer

#: Bits of texts in which chunks meet late or never: runs without spaces, byte fallback, marks of spaces, specials.
BITS = ["ab", "aab ", "   ", "\n", "é", "😀", "\U00010940", "▁", "xxxx", "the ", "<s>", "\x00", "漢字", "Ünder", "1234", "\t", "</s>", "<0x0A>"]


@pytest.fixture(scope="module")
def model():
    return open_tokenizer(tokenizer_path("piece_bpe_32k.model"))


def test_splices_equal_whole_encoding(model):
    rng = random.Random(11)
    for k in range(1500):
        if k % 3 == 0:
            text = "".join(rng.choice(BITS) for _ in range(rng.randint(0, 150)))
        elif k % 3 == 1:
            text = rng.choice(BITS) * rng.randint(1, 120)
        else:
            text = prose(rng, rng.choice(["en", "fr", "de"]), rng.randint(1, 80))
        chunk, overlap = rng.choice([2, 5, 17, 60]), rng.choice([1, 2, 8])
        assert list(splice(model, text, chunk, overlap)) == model.model.encode(text), (text, chunk, overlap)


def test_widening_to_the_whole_text(model):
    # Runs of one letter meet at no token before the last chunk is encoded from the start.
    for n in (97, 500, 1003):
        assert list(splice(model, "x" * n, 50, 3)) == model.model.encode("x" * n)


def test_long_text_in_chunks(model):
    rng = random.Random(3)
    text = random_words(rng, 40_000)
    assert len(text) > 3 * (1 << 16)
    assert count(model, [text, "", "a"]) == [len(model.model.encode(text)), 0, len(model.model.encode("a"))]


def test_query_against_the_library(spark, tmp_dir, model):
    rng = random.Random(7)
    rows = [doc(1, None), doc(2, ""), doc(3, " "), doc(4, "a▁b <s> x</s>"), doc(4, "again"), doc(None, "no id"),
            doc(5, prose(rng, "en", 6000)), doc(6, "é😀\x00\U00010940"), doc(7, random_words(rng, 30_000))]
    sf = tables(spark, tmp_dir, documents=spark.createDataFrame(rows, DOCS))
    got = queries.QUERIES["op11_token_counts"](spark, sf)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}
    want = []
    for r in rows:
        n = len(model.model.encode(r[1] or ""))
        want.append((r[0], len((r[1] or "").encode()), n, n > 4096))
    key = lambda x: (x[0] is None, x)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert any(w[3] for w in want)


def test_words_file_clashing_columns_and_empty_table(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    words = open_tokenizer(path)
    docs = spark.createDataFrame([(1, "one <|endoftext|> two", 99)], "doc_id long, text string, N_TOKENS int")
    r = token_counts(docs, path).collect()
    assert [(x.doc_id, x.n_tokens) for x in r] == [(1, len(words.model.encode("one <|endoftext|> two", add_special_tokens=False).ids))]
    assert r[0].n_tokens > 3  # the special token's string is ordinary text
    assert token_counts(docs.limit(0), path).count() == 0

"""What Python workers keep between tasks: bounded, and gone when another operator's tasks run."""

import gc
import random

import numpy as np
import pytest
import regex

from lookback.llm import common, packing, queries


def _held():
    return [o for o in gc.get_objects() if isinstance(o, packing.WordIds)]


def test_another_operators_task_drops_tokenizers_and_words():
    gc.collect()
    before = len(_held())
    first = packing.word_ids(queries.tokenizer_path())
    assert first.batch(["some words"])
    assert packing.word_ids(queries.tokenizer_path()) is first
    list(common.tidy(lambda batches: batches)(iter([])))
    del first
    gc.collect()
    assert len(_held()) == before


def test_packings_own_tasks_keep_them():
    first = packing.word_ids(queries.tokenizer_path())
    list(common.tidy(lambda batches: batches, packing.OWNER)(iter([])))
    assert packing.word_ids(queries.tokenizer_path()) is first
    common.drop_others(None)


def test_words_and_pieces_share_one_bounded_cache(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 500)
    ids = packing.WordIds(queries.tokenizer_path())
    for a in range(0, 4000, 100):  # each word is two pieces
        texts = [f"w{chr(97 + i % 26)}q{'x' * (i // 26 % 30)}{'z' * (i // 780)},; again" for i in range(a, a + 100)]
        for text, got in zip(texts, ids.batch(texts)):
            assert np.frombuffer(got, "<u4").tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids, text
        assert sum(len(x) for x in vars(ids).values() if isinstance(x, dict)) <= 500 + 300


def test_a_piece_is_held_once_whatever_stands_beside_it():
    ids = packing.WordIds(queries.tokenizer_path())
    assert len(ids.batch(["alpha, (alpha) alpha... it's alpha!", "", "Alpha\nit"])) == 3
    assert set(ids.words) == {"alpha", ",", "(", ")", "...", "it", "'s", "!"}


@pytest.mark.parametrize("block", [1, 7, 1 << 19])
def test_blocks_of_texts_split_as_the_file_does(monkeypatch, block):
    monkeypatch.setattr(packing, "BLOCK", block)
    ids = packing.WordIds(queries.tokenizer_path())
    rng = random.Random(9)
    some = ["'", "'", "s", "t", "re", "VE", "ll", "L", "m", "d", "e", "\u00e9", "\u00c9", "1", "\u00b2", "\u00bd", ",", ".", "_", " ", " ", "\n", "\t", "\u4e2d", "\uac00", "\u20ac"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(0, 14))) for _ in range(1500)] + ["", "'", "'l", "x'r", ""]
    for text, got in zip(texts, ids.batch(texts)):
        assert np.frombuffer(got, "<u4").tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)
        at, pieces = packing.split_pieces(text.lower())
        assert pieces.to_pylist() == regex.findall(packing.SPLIT, text.lower())
        assert at.tolist() == [m.start() for m in regex.finditer(packing.SPLIT, text.lower())]

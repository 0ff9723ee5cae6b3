"""Passages that start or end inside lines, against a brute force over all windows of 50 words."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from llm.helpers import DOCS, random_words, tables

from lookback.llm import line_dedup, passages, queries


def windows_brute(rows, n=50):
    """For each row the flags of its words: does it stand in a window that an earlier place has too?"""
    places, flags = defaultdict(list), []
    for r, (d, t) in enumerate(rows):
        words = list(re.finditer(r"\S+", t or ""))
        flags.append([False] * len(words))
        if d is not None:
            for i in range(len(words) - n + 1):
                places[t[words[i].start():words[i + n - 1].end()]].append(((d, t, i), r))
    for held in places.values():
        low = min((d, i) for (d, _, i), _ in held)
        for (d, _, i), r in held:
            if d != low[0] or i >= low[1] + n:
                flags[r][i:i + n] = [True] * n
    return flags


def pasted(rng):
    """Texts of one line or more with passages of 50 to 59 words inside lines, or across line ends."""
    short, long = random_words(rng, 47), random_words(rng, 120)
    passage = random_words(rng, 52)
    across = "\n".join(random_words(rng, k) for k in (17, 21, 15))
    rows = []
    for i in range(60):
        words = random_words(rng, rng.randint(10, 90))
        for p, every in ((passage, 3), (across, 4), (short, 2), (long, 7)):
            if i % every == 0:
                words += " " + p + " " + random_words(rng, rng.randint(1, 30))
        rows.append((i, words + "\n" + random_words(rng, 8)))
    half = long.split(" ")
    rows += [(100, "x " + " ".join(half[20:75]) + " y"), (101, "x " + " ".join(half[:49]) + " y"), (102, passage), (103, "w " * 180),
             (104, None), (105, ""), (None, "a " + passage + " b"), (106, random_words(rng, 5) + "\xa0" + passage + " " + "é ü")]
    return rows, passage, across, short


def test_passages_against_brute_force(spark):
    rows, passage, across, short = pasted(random.Random(8))
    df = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, cut_words string")
    out = passages.dedup_passages(df)
    assert out.columns == ["doc_id", "text", "cut_lines", "cut_words"]
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    for (d, t), flags in zip(rows, windows_brute(rows)):
        kept = [w for w, gone in zip((t or "").split(), flags) if not gone]
        assert (got[d].text or "").split() == kept and got[d].cut_words == sum(flags), d
        if not any(flags):
            assert got[d].text == t
    assert {d for d, r in got.items() if passage in (r.text or "")} == {0, None}
    assert {d for d, r in got.items() if across in (r.text or "")} == {0}
    assert {d for d, r in got.items() if short in (r.text or "")} == {i for i in range(0, 60, 2)}
    assert got[102].text == "" and got[102].cut_lines == 1 and got[101].cut_words == 0


def test_line_query_removes_passages_inside_lines(spark, tmp_path):
    rows, passage, across, _ = pasted(random.Random(9))
    frame = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], DOCS)
    out = queries.op7_line_dedup(spark, tables(spark, str(tmp_path), documents=frame))
    assert out.columns == ["doc_id", "text", "removed_lines", "removed_words"]
    got = {r.doc_id: r for r in out.collect()}
    assert {d for d, r in got.items() if passage in (r.text or "")} == {0, None}
    assert {d for d, r in got.items() if across in (r.text or "")} == {0}
    assert all(got[d].removed_words == len((t or "").split()) - len((got[d].text or "").split()) for d, t in rows)


def test_cut_keeps_line_breaks():
    p = " ".join(f"p{i}" for i in range(50))
    for text, want, lines in ((f"a {p} b", "a b", 0), (f"a\n{p}\nb", "a\nb", 1), (f"a {p}\nb", "a\nb", 0), (f"a\n{p} b", "a\nb", 0), (p, "", 1),
                              (f"{p} b", "b", 0), (f"a {p}\n", "a", 0)):
        at = text[:text.index(p)].count(" ") + text[:text.index(p)].count("\n")
        assert passages.cut(text, [at], 50) == (want, lines, 50), text


def test_one_id_on_two_texts(spark):
    """Spans of one row say nothing of the other row's lines; a row twice is no copy of itself."""
    rng = random.Random(3)
    passage = "\n".join(random_words(rng, 20) for _ in range(3))
    clean = "\n".join(random_words(rng, 25) for _ in range(4))
    rows = [(1, passage + "\nend"), (5, passage + "\nmore"), (5, clean), (7, clean + "\nx"), (7, clean + "\nx"), (8, passage), (8, passage + "\nz")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted([(1, passage + "\nend"), (5, "more"), (5, clean), (7, "x"), (7, "x"), (8, ""), (8, "z")])
    assert sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(df).collect()) == want
    assert sorted((r.doc_id, r.text) for r in line_dedup.dedup(df).collect()) == want


def test_windows_are_compared_in_stretches(spark, monkeypatch):
    """Equal stretches of windows are one row, unequal ones a row a window, copies within a text a row a run: as each window alone."""
    rng = random.Random(11)
    shared, other = random_words(rng, 400), random_words(rng, 300)
    rows = [(1, shared), (2, random_words(rng, 30) + " " + shared + " " + random_words(rng, 30)), (3, shared), (4, " ".join(shared.split()[100:260])),
            (5, other + " é \U0001f600 " + other), (6, "w " * 300), (7, "a b  c\t" * 120 + other), (8, "w " * 90), (8, other), (9, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    later = passages.later_places
    monkeypatch.setattr(passages, "later_places", lambda found, *rest: seen.append(found.count()) or later(found, *rest))
    got = sorted(map(tuple, passages.dedup_passages(df).collect()), key=repr)
    assert got == sorted(_window_by_window(rows), key=repr)
    held = sum(max(0, len(t.split()) - 49) for _, t in rows if t)
    assert seen[0] < held / 2


def _window_by_window(rows, n=50):
    first, own, out = {}, {}, []
    places = []
    for d, t in rows:
        at = [(m.start(), m.end()) for m in re.finditer(r"\S+", t or "")]
        for i in range(len(at) - n + 1):
            w = t[at[i][0]:at[i + n - 1][1]]
            places.append((d, t, i, w))
            first[w] = min(first.get(w, d), d)
            own.setdefault((d, t, w), i)
    marks = {}
    for d, t, i, w in places:
        if d != first[w] or i >= own[d, t, w] + n:
            marks.setdefault((d, t), []).append(i)
    for d, t in rows:
        out.append((d, *(passages.cut(t, marks[d, t], n) if (d, t) in marks else (t, 0, 0))))
    return out


@pytest.mark.parametrize("min_words", [1, 3])
def test_long_lines_are_those_with_enough_words_whatever_the_white_space(min_words):
    rng = random.Random(6)
    some = ["a", "\u00e9", " ", "  ", "\n", "\t", "\xa0", "\x85", "\u4e2d", "w w", "\U0001f600"]
    texts = ["".join(rng.choice(some) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    plain = [t for t in texts if not re.search(r"[^\S \n]", t)]
    for t in plain:
        assert line_dedup.word_counts(t.encode()).tolist() == [len(x.split()) for x in t.split("\n")], ascii(t)
    for some in (texts, plain):
        chunks = line_dedup.Chunks(some, min_words)
        alone = set(zip(chunks.of.tolist(), chunks.start.tolist(), chunks.count.tolist()))
        long = {(i, j, 1) for i, t in enumerate(some) for j, x in enumerate(t.split("\n")) if len(x.split()) >= min_words}
        assert long and long <= alone


def test_first_places_go_by_all_keys():
    rng = random.Random(8)
    for most in (3, 1 << 40):
        rows = [(rng.randint(0, most), rng.randint(0, 1), rng.randint(0, 1)) for _ in range(200)]
        got = passages._first_of(*(np.array(k, np.int64) for k in zip(*rows)))
        assert got.tolist() == [rows.index(r) for r in rows]

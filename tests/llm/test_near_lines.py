"""Near-duplicates and line dedup against brute force, with large groups."""

import random
from collections import defaultdict

import pytest
from llm.helpers import DOCS, doc, random_words, tables

from lookback.llm import line_dedup, near_dup, queries


def sets_of(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    width = min(width, len(words))
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, num, den):
    """component of each row position: smallest id reachable."""
    sets = [sets_of(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and find(i) != find(j):
                both = len(a & b)
                if den * both >= num * (len(a) + len(b) - both):
                    parent[find(i)] = find(j)
    low = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)].append(d)
    return [(d, len(sets[i]), min(low[find(i)], default=None)) for i, (d, _) in enumerate(rows)]


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = random_words(rng, 1)
    return " ".join(words)


def family(rng, size, most, words=120):
    base = random_words(rng, words)
    return [edited(rng, base, rng.randint(0, most)) for _ in range(size)]


@pytest.mark.parametrize("width,num", [(3, 85), (5, 80)])
def test_large_graded_groups(spark, width, num):
    """Groups far over LIST_PAIRS whose members reach each other only by way of others."""
    rng = random.Random(width)
    texts = family(rng, 90, 9) + family(rng, 60, 14, 60) + [random_words(rng, rng.randint(1, 200)) for _ in range(40)]
    texts += [texts[0]] * 30 + [random_words(rng, 40) + " " + texts[5] for _ in range(5)]
    chain = random_words(rng, 100)
    for _ in range(25):  # each is a near-duplicate of the one before
        chain = edited(rng, chain, 2)
        texts.append(chain)
    shared = random_words(rng, 60)  # a passage that unrelated texts share
    texts += [shared + " " + random_words(rng, 120) for _ in range(40)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in near_dup.near_duplicates(df, width, num, 100).collect())
    assert got == sorted(brute(rows, width, num, 100))


def test_edge_rows(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "A"), (6, "a b"), (7, "a  b"), (8, "a b c"), (9, "é b c"), (9, "É b c"),
            (10, "x y z " * 2000), (11, "X y z " * 2000), (None, "a b c"), (None, None), (12, "a\xa0b"), (4, "a"), (13, "a b c")]
    full = [(d, t, "en", "s", 1, "k") for d, t in rows]
    root = tables(spark, str(tmp_path), documents=spark.createDataFrame(full, DOCS + ", key string"))
    out = queries.op2_near_dup(spark, root).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=repr)
    assert got == sorted(brute(rows, 3, 85, 100), key=repr)
    assert all(r.kept == (r.doc_id == r.component_id) for r in out)
    empty = spark.createDataFrame([], DOCS)
    assert near_dup.near_duplicates(empty).count() == 0


def test_keep_one(spark):
    rng = random.Random(2)
    base = random_words(rng, 200)
    rows = [(5, base, 1), (3, edited(rng, base, 1), 2), (9, base, 3), (9, base, 3), (7, random_words(rng, 50), 4), (8, "", 5), (2, None, 6),
            (None, base, 7), (4, "one", 8), (4, "one", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept int")
    got = sorted(((r.doc_id, r.kept) for r in near_dup.keep_one(df).collect()), key=repr)
    assert got == sorted([(3, 2), (7, 4), (8, 5), (2, 6), (None, 7), (4, 8)], key=repr)


def lines_brute(rows, min_words):
    first, count, found = {}, defaultdict(int), []
    for d, t in rows:
        if d is None or not t:
            continue
        lines, chunks = line_dedup.units(t, min_words)
        for start, n in chunks:
            raw = "\n".join(lines[start:start + n])
            count[raw] += 1
            first[raw] = min(first.get(raw, (d, start)), (d, start))
            found.append((d, start, n, raw))
    spans = defaultdict(list)
    for d, start, n, raw in found:
        if count[raw] > 1 and first[raw] != (d, start):
            spans[d].append((start, n))
    return [(d, *(line_dedup.strip(t, spans[d], min_words) if t and d in spans else (t, 0, 0))) for d, t in rows]


def test_lines_against_brute_force(spark):
    rng = random.Random(6)
    passage = [random_words(rng, rng.randint(5, 30)) for _ in range(6)]
    long = random_words(rng, 70)
    licence = ["Some rights reserved.", "Version two."]
    rows = []
    for i in range(120):
        lines = [random_words(rng, rng.randint(1, 25)) for _ in range(rng.randint(1, 12))]
        if i % 3 == 0:
            at = rng.randrange(len(lines) + 1)
            lines[at:at] = passage
        if i % 4 == 0:
            lines.insert(rng.randrange(len(lines) + 1), long)
        if i % 2:
            lines += licence
        rows.append((i, "\n".join(lines)))
    rows += [(200 + i, rows[1][1]) for i in range(3)] + [(300, None), (301, ""), (302, "\n\n\n"), (303, "\n".join(["w " * 60] * 3)), (None, long)]
    df = spark.createDataFrame([(d, t, 9) for d, t in rows], "doc_id long, text string, removed_words int")
    out = line_dedup.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "removed_lines", "removed_words"]
    got = {r.doc_id: (r.text, r.removed_lines, r.removed_words) for r in out.collect()}
    want = {d: (t, n, w) for d, t, n, w in lines_brute(rows, 50)}
    assert got == want
    for i in (i for i in range(6, 120, 3) if i % 4):  # the whole passage goes, but for its first place; nothing else does
        assert not any(p in (got[i][0] or "").split("\n") for p in passage)
        assert all(x in got[i][0].split("\n") for x in rows[i][1].split("\n") if x not in passage + licence and x != long)
    assert all(p in got[0][0].split("\n") for p in passage + [long])
    # a short repeated run stays, unless it borders on a passage that goes
    assert all(got[i][0].endswith("Some rights reserved.\nVersion two.") for i in range(1, 120, 2) if i % 3)
    assert got[303][1] == 2 and got[None][1] == 0


def _rules(texts, min_words=50):
    """The line stage by its rules in words, from texts alone: which lines go from which text (no code of the stage).

    A run of lines that stands in an earlier place too, two lines or a line of at least ``min_words`` words, is marked;
    marked runs of at least ``min_words`` words go.  Chunks of more lines mark nothing that their pairs don't.
    """
    places = {}
    for d, t in sorted((d, t) for d, t in texts if d is not None and t):
        lines = t.split("\n")
        for n in (1, 2):
            for i in range(len(lines) - n + 1):
                if n == 2 or len(lines[i].split()) >= min_words:
                    places.setdefault((n, *lines[i:i + n]), []).append((d, i))
    gone = {}
    for (n, *_), held in places.items():
        for d, i in held[1:]:
            gone.setdefault(d, set()).update(range(i, i + n))
    out = {}
    for d, t in texts:
        lines, marked, kept, run = (t or "").split("\n"), gone.get(d, set()), [], []
        for i, x in enumerate([*lines, None]):
            if x is not None and i in marked:
                run.append(x)
                continue
            if sum(len(y.split()) for y in run) < min_words:
                kept += run
            run = []
            if x is not None:
                kept.append(x)
        out[d] = None if t is None else "\n".join(kept)
    return out


def test_lines_against_the_rules_alone(spark):
    rng = random.Random(16)
    pool = [random_words(rng, rng.randint(1, 40)) for _ in range(40)] + [random_words(rng, 60), ""]
    rows = []
    for i in range(150):
        lines = []
        for _ in range(rng.randint(0, 6)):
            a = rng.randrange(len(pool) - 5)
            lines += pool[a:a + rng.randint(1, 5)] if rng.random() < .5 else [random_words(rng, rng.randint(0, 30))]
        rows.append((i, "\n".join(lines)))
    rows += [(200, None), (201, ""), (202, rows[3][1]), (203, "\n".join([pool[-2]] * 4))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(df).collect()} == _rules(rows)


def test_lines_of_an_empty_table(spark, tmp_path):
    root = tables(spark, str(tmp_path), documents=spark.createDataFrame([], DOCS))
    assert queries.op7_line_dedup(spark, root).count() == 0


def test_line_chunks_resist_shifts():
    rng = random.Random(1)
    lines = [random_words(rng, 6) for _ in range(200)]
    chunks = {tuple(lines[a:a + n]) for a, n in line_dedup.units("\n".join(lines), 50)[1] if n > 2}
    moved = ["new line"] + lines
    again = {tuple(moved[a:a + n]) for a, n in line_dedup.units("\n".join(moved), 50)[1] if n > 2}
    assert len(chunks) > 20 and len(chunks - again) <= 1


def test_bit_map_never_misses(spark):
    from lookback.llm.bits import bit_map
    import numpy as np
    keys = np.array([0, 1, -1, 2 ** 62, -2 ** 63] + list(range(1000, 60000, 7)), np.int64)
    held = bit_map(spark.createDataFrame([(int(k),) for k in keys], "key long"), "key")
    assert held.has(keys).all()
    others = np.arange(10 ** 9, 10 ** 9 + 20000, dtype=np.int64)
    assert held.has(others).mean() < 0.05
    none = bit_map(spark.createDataFrame([], "key long"), "key")
    assert not none.has(keys).any()

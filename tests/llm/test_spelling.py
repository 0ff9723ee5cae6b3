"""op12 against brute force over all pairs of words; signatures lose no pair; edge rows."""

import random
import re
import zlib
from collections import Counter

from helpers import DOCS, doc, tables

from lookback.llm import queries, spelling


def one_edit(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    n = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def _docs(seed: int, docs: int):
    """Texts over few words and their misspellings, so that near words, ties and long ways occur."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(4, 8))) for _ in range(60)] + ["Straße", "ÉCOLE", "École", "naïve"]
    words = list(base)
    for w in base * 3:
        i = rng.randrange(len(w))
        words.append(rng.choice([w[:i] + w[i + 1:], w[:i] + "x" + w[i:], w[:i] + "z" + w[i + 1:], w + "x", w + "xx"]))
    rows = []
    for i in range(docs):
        text = " ".join(rng.choice(words[:1 + int(rng.random() ** 3 * len(words))]) for _ in range(rng.randint(0, 120)))
        rows.append(doc(rng.choice([None, i, i]), rng.choice([text, text.upper(), text + "×÷5", None if rng.random() < .1 else text])))
    return rows


def test_query_against_brute_force(spark, tmp_dir):
    longest = 0
    for seed in (1, 2):
        rows = _docs(seed, 250)
        sf = tables(spark, f"{tmp_dir}/{seed}", documents=spark.createDataFrame(rows, DOCS))
        got = queries.QUERIES["op12_spelling"](spark, sf)
        assert dict(got.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
        got = got.collect()
        want = brute(rows)
        assert len(got) == len(want) and {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
        longest = max(longest, sum(f is not None and f != root for _, f, root, *_ in want))
    assert longest  # some ways have more than one step


def test_entries_lose_no_pair(spark):
    rng = random.Random(4)
    letters = "abetzéüß×"
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(5, 7))) for _ in range(400)}
    words |= {w[:i] + w[i + 1:] for w in list(words)[:150] for i in (0, 3) if len(w) > 5}
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = {(r.word, r.near) for r in spelling.near_words(frame).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_partitions_hold_each_letter_once():
    parts = spelling.partitions()
    assert len(parts) == 8 and sorted("".join(parts)) == sorted(set(spelling.LETTERS)) and len(spelling.LETTERS) == 90


def test_empty_table_clashing_columns_and_repeats(spark):
    docs = spark.createDataFrame([(1, "planets planets", "a"), (1, "planets", "b")], "doc_id long, text string, word string")
    assert [(r.word, r.n, r.n_near, r.form, r.root) for r in spelling.variants(docs, every=10**9).collect()] == [("planets", 3, 0, None, "planets")]
    assert spelling.variants(docs.limit(0)).count() == 0


def test_long_text_is_searched_whole():
    text = "alpha Beta " * (spelling.PIECE // 8)
    assert spelling.runs(text) == Counter({"alpha": spelling.PIECE // 8, "beta": spelling.PIECE // 8})

"""Small fixtures for the operators, and the registered queries on folders of tiny tables."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the and of that with this from have they which would there their about other people time water first sound".split(),
    "fr": "le une des que dans pour avec est être où très même après aussi leur français était fait tout année".split(),
    "de": "der und die nicht ein für mit über auch nach wird sich größer können straße zwischen gegen jahr haben schön".split(),
}


def prose(rng: random.Random, lang: str, words: int) -> str:
    return " ".join(rng.choice(WORDS[lang]) for _ in range(words))


def random_words(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7))) for _ in range(words))


def doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text))


def tables(spark, root: str, **frames) -> str:
    """Write frames as tables of a folder that the registered queries read."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}.parquet")
    return root

"""The pipeline's language stage: what language ID rejects goes, clean documents stay."""

import random
import sys
from pathlib import Path

from llm.helpers import DOCS, doc, prose

sys.path.insert(0, str(Path(__file__).parents[2]))
import corpus_pipeline  # noqa: E402


def test_language_stage_rejects_by_score_and_label(spark):
    rng = random.Random(12)
    clean = [doc(i, prose(rng, lang, rng.randint(20, 150)), lang) for i, lang in enumerate(["en", "fr", "de"] * 40)]
    greek = "αυτό είναι ένα κείμενο " * 10
    bad = [doc(500, prose(rng, "fr", 80), "en"), doc(501, prose(rng, "de", 80), "fr"), doc(502, greek, None), doc(503, greek + " the", None),
           doc(504, "123 ...", "en"), doc(505, None, "en"),
           doc(506, " ".join(prose(rng, x, 60) for x in ("en", "fr", "de")), None)]
    filled = [doc(600, prose(rng, "de", 30), None), doc(601, prose(rng, "en", 60) + " αυτό", "en")]
    out = {r.doc_id: r for r in corpus_pipeline.language(spark, spark.createDataFrame(clean + bad + filled, DOCS), "").collect()}
    assert set(out) == {r[0] for r in clean + filled}
    assert out[600].lang == "de" and all(tuple(out[r[0]]) == r for r in clean)


def test_one_language_stays(spark):
    rows = [doc(i, prose(random.Random(i), "en", 30), "en") for i in range(5)]
    assert corpus_pipeline.language(spark, spark.createDataFrame(rows, DOCS), "").count() == 5

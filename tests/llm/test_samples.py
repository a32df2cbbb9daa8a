"""The training samples stay within their bounds, and lose no class, however often an id or a row repeats."""

import random

from regioncast.llm import langid, toxicity
from regioncast.llm.common import narrowed, small_batches

MANY = 30_000


def test_language_sample_with_repeated_ids(spark):
    small_batches(spark)
    rnd = random.Random(1)
    rows = [(7, f"xx zq {i} qz", "xx") for i in range(MANY)]  # one id, all texts different
    rows += [(8, "always the same text", "yy")] * 3000  # one row, repeated
    rows += [(100 + i, " ".join(rnd.choice(["the", "and", "of"]) for _ in range(30)), "en") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    own = narrowed(docs, doc_id="long", text="binary", lang="string")
    classes, windows, labels = langid.training_windows(own, 1, 1)
    assert classes == ["en", "xx", "yy"]
    counts = [int((labels == k).sum()) for k in range(3)]
    assert counts == [langid.TRAIN_DOCS, langid.TRAIN_DOCS, 1]
    assert len(windows) <= 3 * langid.TRAIN_DOCS * langid.TRAIN_WINDOWS


def test_any_window_of_a_long_text_may_be_learned_from(spark):
    small_batches(spark)
    rows = [(i, "".join(chr(97 + (i + k) % 26) * langid.WINDOW for k in range(20)), "en") for i in range(60)]
    own = narrowed(spark.createDataFrame(rows, "doc_id long, text string, lang string"), doc_id="long", text="binary", lang="string")
    _, windows, _ = langid.training_windows(own, 1, 1)
    assert len(windows) <= 60 * langid.TRAIN_WINDOWS
    places = set()
    for w in windows:
        for _, text, _ in rows:
            at = text.encode().find(w.tobytes())
            if at >= 0:
                places.add(at // langid.WINDOW)
    assert len(places) == 20


def test_toxicity_sample_with_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_TOXIC", 50)
    monkeypatch.setattr(toxicity, "TRAIN_CLEAN", 80)
    rows = [(7, f"one of many texts {i}") for i in range(MANY)] + [(8, "the same again")] * 500 + [(100 + i, f"clean {i}") for i in range(300)]
    labels = [(7, 1), (7, 1), (8, 1)] + [(100 + i, 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = toxicity._sample(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), 1, 1).groupBy("toxic").count().collect()
    assert {r.toxic: r["count"] for r in got} == {1: 50, 0: 80}

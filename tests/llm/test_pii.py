"""Personal data: patterns against plain regular expressions, messages against enumeration, damaged mentions, hard rows."""

import itertools
import random
import re

import numpy as np
import pytest

from regioncast.llm import pii
from regioncast.llm.queries import op11_skip_chain_pii
from tests.llm.helpers import HARD, SF, documents, sf_rows

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(digits):
    values = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
    return sum(v // 10 + v % 10 for v in values) % 10 == 0


def plain_spans(text):
    def holds(kind, s):
        digits = re.sub("[^0-9]", "", s)
        return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in s.split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and plain_luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]()

    return {k: [m.span() for m in re.finditer(p, text) if holds(k, m.group())] for k, p in PATTERNS.items()}


@pytest.fixture(scope="module")
def weights(spark):
    return pii.learn(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_patterns_equal_plain_search():
    rnd = random.Random(1)
    hits = 0
    for _ in range(30_000):
        text = "".join(rnd.choice("a1234.@@ -+()_%\n52.") for _ in range(rnd.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text)
        hits += any(pii.base_spans(text).values())
    assert hits > 500
    assert pii.base_spans("x 4845168114407329 4845-1681-1440-7329, 1.2.3.256 001.2.3.4")["card"] == []


def test_long_texts_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+" * 300_000, "a@" * 150_000, "+1" + " " * 300_000, "(at)" * 50_000):
        pii.find_spans([text, text + " 9@a.bc"], pii.Weights())


def test_messages_are_exact_on_a_tree():
    rng = np.random.default_rng(4)
    unary, edges = rng.normal(size=(6, 5)), np.array([[0, 1], [1, 2], [1, 3], [3, 4]])
    coupling = rng.uniform(0, 2, size=(4, 5))
    total = np.zeros((6, 5))
    for labels in itertools.product(range(5), repeat=6):
        p = np.exp(sum(unary[i, y] for i, y in enumerate(labels)) + sum(c[labels[i]] for (i, j), c in zip(edges, coupling) if labels[i] == labels[j]))
        for i, y in enumerate(labels):
            total[i, y] += p
    assert np.allclose(pii.marginals(unary, edges, coupling), total / total.sum(axis=1, keepdims=True), atol=1e-3)


def test_damaged_mentions_follow_their_twin(weights):
    def found(text):
        (base, spans), = pii.find_spans([text], weights)
        assert base == plain_spans(text)
        return [text[a:b] for k, a, b in spans if (a, b) not in base[k]]

    assert found("mail 92@mail2.example.com then 92(at)mail2.example.com or 93@mail7") == ["92(at)mail2.example.com"]
    assert found("call +1 (487) 555-7209 or (487) 555-7209 or 14875557209, not (123) 456-7890 nor 2021-05-06") == ["(487) 555-7209", "14875557209"]
    assert found("4845168114407329, 4845.1681.1440.7329 but 9807915762804490") == ["4845.1681.1440.7329"]
    assert found("188.54.39.104 is 188-54-39-104 and 188[.]54[.]39[.]104; 2.0.1 17") == ["188-54-39-104", "188[.]54[.]39[.]104"]
    alone = "92(at)mail2.example.com (487) 555-7209 4845.1681.1440.7329 188-54-39-104"
    assert found(alone) == [] and found(alone + " but 1.2.3.4 and 10@other.example.org") == []
    # equal damage at a distance stands or falls together
    assert found("4845168114407329 " + "words " * 300 + "4845/1681/1440/7329 " * 3) == ["4845/1681/1440/7329 4845/1681/1440/7329 4845/1681/1440/7329"]


def test_hard_rows(spark, weights):
    rows = HARD + [(20, "x 1@a.b"), (None, "1@a.b é 1@a.b"), (None, "1@a.b é 1@a.b"), (21, "1.2.3.4 " * 20_000)]
    got = pii.personal_data(documents(spark, rows), weights).collect()
    want = sorted(((d, [(k, a, b) for k, s in plain_spans(t or "").items() for a, b in s]) for d, t in rows), key=repr)
    assert sorted(((r.doc_id, [tuple(s) for s in r.base]) for r in got), key=repr) == want
    assert all(set(r.base) <= set(r.spans) for r in got)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pii.personal_data(none).collect() == []


def test_no_mentions_to_learn_from(spark):
    rows = [(1, "no such thing"), (2, "version 2.0 of 17")]
    assert [(r.base, r.spans) for r in pii.personal_data(documents(spark, rows)).collect()] == [([], [])] * 2


def test_sample_is_bounded_and_whole_query(spark, monkeypatch):
    monkeypatch.setattr(pii, "TRAIN_SPANS", 50)
    taken = []
    fit = pii.fit
    monkeypatch.setattr(pii, "fit", lambda spans, words: taken.append((len(spans), len(words))) or fit(spans, words))
    rows = [(5, f"+1 (499) 555-{i % 9000 + 1000} is no {i}") for i in range(3000)]
    pii.learn(spark.createDataFrame(rows, "doc_id long, text string"))
    assert taken[0][0] == 50 and taken[0][1] <= pii.TRAIN_WORDS
    got = {r.doc_id: r for r in op11_skip_chain_pii(spark, SF).collect()}
    for doc_id, text in sf_rows():
        base = plain_spans(text or "")
        assert [got[doc_id][f"n_{k}"] for k in PATTERNS] == [len(base[k]) for k in PATTERNS]
        assert {f"{k}:{a}:{b}" for k, s in base.items() for a, b in s} <= set(got[doc_id].spans.split(","))

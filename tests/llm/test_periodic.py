"""Periodic runs against a plain scan of every period."""

import hashlib
import random
import re
import zlib

import numpy as np

from regioncast.llm.periodic import branching_squares, periodic_runs, runs_of_documents, suffix_array
from regioncast.llm.queries import op12_periodic_runs
from tests.llm.helpers import HARD, documents, sf_rows


def brute(words, least=12):
    """Every maximal stretch of every period, tried one by one; of equal stretches the smallest period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                found.setdefault((start, i + q), q)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def rearranged(words, doc_id):
    n, h = len(words), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    a = (h // 10) % n
    p = 1 + (n - a) // (3 + (h // 10) % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_suffix_array_is_sorted():
    s = np.random.default_rng(3).integers(0, 3, 500)
    sa, isa = suffix_array(s)
    assert [s[i:].tolist() for i in sa] == sorted(s[i:].tolist() for i in range(500))
    assert (sa[isa] == np.arange(500)).all()


def test_squares_are_all_that_branch():
    rnd = random.Random(2)
    for _ in range(200):
        s = [rnd.randrange(2) for _ in range(rnd.randint(0, 30))]
        want = [(i + 2 * d, d) for d in range(1, len(s)) for i in range(len(s) - 2 * d + 1)
                if s[i:i + d] == s[i + d:i + 2 * d] and (i + 2 * d == len(s) or s[i + d] != s[i + 2 * d])]
        assert [tuple(x) for x in branching_squares(np.array(s, dtype=np.int64)).tolist()] == sorted(want)


def test_runs_of_random_documents():
    rnd = random.Random(5)
    for _ in range(600):
        least, docs = rnd.choice([2, 4, 5, 12]), []
        for _ in range(rnd.randint(1, 4)):
            n, k = rnd.randint(0, 60), rnd.choice([1, 2, 3, 5])
            words = [rnd.randrange(k) for _ in range(n)]
            docs.append(rearranged(words, rnd.randint(0, 40)))
        assert runs_of_documents([np.array(d, dtype=np.int64) for d in docs], least) == [brute(d, least) for d in docs]


def test_one_word_and_nested_periods():
    assert runs_of_documents([np.zeros(50_000, dtype=np.int64)]) == [[(0, 50_000, 1)]]
    period = [1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 2]
    got = runs_of_documents([np.array(period * 3)])[0]
    assert got == brute(period * 3) and (0, 39, 13) in got and (13, 12, 1) in got


def check(rows, want_rows, plant):
    by_id = {}
    for doc_id, text in want_rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        words = rearranged(words, doc_id) if plant else words
        found = brute(words) if len(words) < 3000 else None
        by_id.setdefault((doc_id, len(words)), []).append((words, found))
    for r in rows:
        words, found = by_id[(r.doc_id, r.n_words)].pop()
        if found is None:
            continue
        assert [tuple(x) for x in r.runs] == found
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        assert r.collapsed == " ".join(w for i, w in enumerate(words) if i not in gone)
    assert not any(by_id.values())


def test_hard_rows(spark):
    rows = HARD + [(10_000 + i, "a b c d e f g h i j k l m n o p q r s t") for i in range(40)] + [(None, "z " * 30), (None, "z " * 30)]
    got = periodic_runs(documents(spark, rows), plant=True).collect()
    check(got, rows, True)
    tie = next(r for r in periodic_runs(documents(spark, rows)).collect() if r.doc_id == 7)
    assert [tuple(x) for x in tie.runs] == [(0, 12_000, 1)] and tie.collapsed == "tie"
    assert periodic_runs(documents(spark, [])).collect() == []


def test_whole_table(spark):
    rows = sf_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(periodic_runs(docs, plant=True).collect(), rows, True)


def test_query_digests(spark):
    row = {r.doc_id: r for r in op12_periodic_runs(spark, "/root/testdata/sf0.001").collect()}
    for doc_id, text in sf_rows():
        words = rearranged(re.findall(r"[^\x20\x09-\x0D]+", text or ""), doc_id)
        found, r = brute(words), row[doc_id]
        assert r.n_runs == len(found)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert (r.start, r.length, r.period, r.exponent_milli) == ((*best, 1000 * best[1] // best[2]) if best else (None,) * 4)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in found).encode()).hexdigest()

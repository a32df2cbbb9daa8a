"""Benchmark decontamination (1) against plain scans."""

import re

import numpy as np

from regioncast.llm import decontaminate as dc
from regioncast.llm.fm_index import FMIndex, suffix_ranks
from tests.llm.helpers import HARD, documents, sf_rows


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(docs, items, width=13):
    phrases = {}
    for item_id, text in items:
        w = words(text)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            phrases.setdefault(tuple(w[k:k + width]), set()).add(item_id)
    sizes = {len(p) for p in phrases}
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                p = tuple(w[k:k + n])
                if p in phrases:
                    hit.update(range(k, k + n))
                    ids |= phrases[p]
        out.append((doc_id, len(w), len(hit), sorted(i for i in ids if i is not None)))
    return out


def test_fm_index_counts_and_locates():
    rng = np.random.default_rng(5)
    for n, top in ((40, 2), (600, 3), (600, 60)):
        runs = [np.append(rng.integers(1, top + 1, rng.integers(1, 30)), 0) for _ in range(n // 20)]
        runs.append(runs[0])
        s = np.concatenate(runs).astype(np.uint32)
        assert sorted(suffix_ranks(s).tolist()) == list(range(len(s)))
        index = FMIndex(s)
        phrases, sizes = np.zeros((80, 5), dtype=np.uint32), rng.integers(1, 6, 80)
        for k in range(80):
            at = rng.integers(0, len(s) - 5)
            p = s[at:at + sizes[k]].copy()
            p[p == 0] = top + 5 if k % 2 else 1
            phrases[k, 5 - sizes[k]:] = p
        low, high = index.search(phrases, sizes)
        for k in range(80):
            p = phrases[k, 5 - sizes[k]:]
            want = [i for i in range(len(s) - len(p) + 1) if (s[i:i + len(p)] == p).all()]
            assert sorted(index.locate(np.arange(low[k], max(low[k], high[k]))).tolist()) == want


def _got(df):
    return sorted(((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_hit, r["items"]) for r in df.collect()), key=repr)


def _want(docs, items):
    return sorted(((d is None, d or 0, n, h, i) for d, n, h, i in brute(docs, items)), key=repr)


def test_hard_cases_and_blocks(spark):
    docs, items = sf_rows()[:60], sf_rows("benchmark", "item_id, text")
    items = [*items, items[0], (900, None), (901, "..."), (902, "one"), (None, "two words"), (903, items[1][1])]
    docs = [*docs, *HARD, (5000, "Two WORDS!" + items[1][1]), (5001, " ".join(items[2][1].split()[:12])), (5002, items[0][1] * 50)]
    table = documents(spark, docs)
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = _want(docs, items)
    assert _got(dc.contamination(table, bench)) == want
    assert _got(dc.contamination(table, bench, block_bytes=1500)) == want
    assert _got(dc.contamination(table, bench.limit(0))) == _want(docs, [])
    assert dc.contamination(table.limit(0), bench).collect() == []


def test_removal_spans_take_the_passage_out(spark):
    item = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10 k11 l12 m13 n14"
    text = "Before, ÜÇ " + item.upper() + "! and after"
    row = dc.contamination(documents(spark, [(1, text)]), spark.createDataFrame([(1, item)], "item_id long, text string")).first()
    assert dc.without_spans(text.encode(), row.removed).decode() == "Before, ÜÇ ! and after"

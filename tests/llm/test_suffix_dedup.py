"""Repeated byte windows (9) against a dictionary of all windows."""

import hashlib

import numpy as np

from regioncast.llm import queries
from regioncast.llm import suffix_dedup as sd
from tests.llm.helpers import HARD, SF, documents, sf_rows


def brute(rows, width=50):
    first = {}
    key = lambda d: float("inf") if d is None else d
    data = [(d, (t or "").encode()) for d, t in rows]
    for d, t in data:
        for i in range(len(t) - width + 1):
            w = t[i:i + width]
            first[w] = min(first.get(w, float("inf")), key(d))
    out = []
    for d, t in data:
        gone = np.zeros(len(t) + 1, dtype=bool)
        for i in range(len(t) - width + 1):
            if first[t[i:i + width]] < key(d):
                gone[i:i + width] = True
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone]).astype(int)) == 1).sum())
        out.append((d, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _digest(df):
    return sorted(((r.doc_id, r.n_bytes, sum(b - a for a, b in zip(r.removed[::2], r.removed[1::2])), len(r.removed) // 2,
                    hashlib.sha256(bytes(r.kept)).hexdigest()) for r in df.collect()), key=repr)


def test_op9_whole_table(spark):
    got = queries.op9_radix_suffix_dedup(spark, SF).collect()
    want = brute(sf_rows())
    assert sorted(map(tuple, got), key=repr) == want
    assert sum(r[2] for r in want) > 0


def _hard():
    rng = np.random.default_rng(6)
    passage = "the same passage of well over fifty bytes in every text, ünï, " * 2
    rows = [*HARD, (30, "ab" * 300), (31, "ab" * 200 + "c"), (32, "z" * 49), (33, "z" * 50), (34, "z" * 50), (35, "z" * 51), (36, passage)]
    rows += [(40 + i, "".join(map(chr, rng.integers(97, 99, 300))) + passage[: 40 + i] + str(i)) for i in range(40)]
    return rows


def test_hard_cases(spark):
    rows = _hard()
    docs = documents(spark, rows)
    want = brute(rows)
    assert _digest(sd.repeated_spans(docs)) == want
    assert _digest(sd.repeated_spans(docs, hot=1)) == want  # every anchor's windows are dealt one by one
    assert sd.repeated_spans(docs.limit(0)).collect() == []


def test_many_blocks_and_widths(spark, monkeypatch):
    rows = sf_rows()[:80] + _hard()[:20]
    docs = documents(spark, rows).repartition(9)
    for width in (16, 33):
        assert _digest(sd.repeated_spans(docs, width=width)) == brute(rows, width)


def test_radix_passes_equal_sorting():
    rng = np.random.default_rng(7)
    data = np.concatenate([rng.integers(97, 99, 3000).astype(np.uint8), np.zeros(60, dtype=np.uint8)])
    at, doc = np.arange(2900), rng.integers(0, 50, 2900)
    for width in (3, 8, 11, 17):
        least = {}
        for a, d in zip(at.tolist(), doc.tolist()):
            w = data[a:a + width].tobytes()
            least[w] = min(d, least.get(w, d))
        want = [least[data[a:a + width].tobytes()] < d for a, d in zip(at.tolist(), doc.tolist())]
        assert sd.radix_pass(data, at, doc, width).tolist() == want

"""SimHash near-duplicates (10) against a loop over all pairs."""

import re
from collections import Counter

import numpy as np
from xxhash import xxh64_intdigest

from regioncast.llm import queries, simhash
from tests.llm.helpers import HARD, SF, documents, sf_rows


def brute_fingerprint(text, width=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids, max_bits=4):
    up = list(range(len(fps)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(fps)):
        if ids[i] is not None:
            least[root(i)] = min(least.get(root(i), ids[i]), ids[i])
    return [least.get(root(i)) for i in range(len(fps))]


def _check(rows, texts):
    ids = [d for d, _ in texts]
    fps = [brute_fingerprint(t) for _, t in texts]
    comp = brute_components(fps, ids)
    want = Counter((d, f"{f:016x}", c) for d, f, c in zip(ids, fps, comp))
    assert Counter((r.doc_id, r.fingerprint if "fingerprint" in r else f"{r.fp % (1 << 64):016x}", r.component_id) for r in rows) == want


def test_op10_whole_table(spark):
    _check(queries.op10_simhash_pivots(spark, SF).collect(), sf_rows())


def test_hard_cases(spark):
    docs = documents(spark, HARD)
    _check(simhash.near_duplicates(docs).collect(), HARD)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    kept = simhash.first_of_each_group(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, i) for i in (1, 4, 7, 8, 9, 10, 11)] + [(True, 0)]
    assert simhash.first_of_each_group(docs.limit(0)).collect() == []


def _clustered(rng, n):
    """Fingerprints in tight clusters, chains and noise."""
    out = set(rng.integers(0, 1 << 64, n, dtype=np.uint64).tolist())
    for c in rng.integers(0, 1 << 64, 3, dtype=np.uint64).tolist():
        for _ in range(n):
            out.add(c ^ sum(1 << int(b) for b in rng.integers(0, 64, 3)))
        x = c
        for _ in range(30):
            x ^= sum(1 << int(b) for b in rng.integers(0, 64, 4))
            out.add(x)
    return sorted(out)


def test_group_links_and_table_links(spark):
    fps = _clustered(np.random.default_rng(3), 150)
    want = brute_components(fps, fps)
    ids = [f - (1 << 64) if f >> 63 else f for f in fps]
    table = spark.createDataFrame([(i,) for i in ids], "fp long")
    for group in (simhash.GROUP, 40):  # 40: large groups meet in pairs of slices
        links = simhash.fingerprint_links(table, group=group)
        roots = {r.node: r.root for r in simhash.connected_components(links).collect()}
        parts = {}
        for f, i, w in zip(fps, ids, want):
            parts.setdefault(roots.get(i, i), set()).add(w)
        assert all(len(p) == 1 for p in parts.values()) and len(parts) == len(set(want))


def test_pivot_bound_discards_no_link():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, 4, replace=False)) for _ in a], dtype=np.uint64)
    refs = simhash._pivots(16)
    assert (np.abs(simhash.pivot_table(a, refs) - simhash.pivot_table(a ^ flips, refs)) <= 4).all()

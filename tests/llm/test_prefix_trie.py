"""Prefix trie and tree contraction against plain loops."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from regioncast.llm.prefix_trie import prefix_trie, subtree_totals
from tests.llm.helpers import SF, sf_rows

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def brute(rows, family=100, shares=6):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), digest(role or "", text or ""), (role or "", text or "")))
    own = {c: [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    convs = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % shares
        convs[c] = tuple(own.get(c - (abs(c) % family) * (1 if c >= 0 else -1), [])[:h] + turns[h:])
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[convs[c][:d]].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in kids[k]) or 1
        saved[k] = sum(saved[x] for x in kids[k]) + ((len(members[k]) - 1) * len(k[-1][1]) if k else 0)
    out = []
    for k, m in members.items():
        ends = ",".join(str(c) for c in m if len(convs[c]) == len(k))
        out.append((m[0], len(k), members[k[:-1]][0] if k else None, len(m), len(kids[k]), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    for extra in ("id", "depth", "x1", "part", "kids", "ends"):
        df = df.withColumn(extra, df.role)
    got = prefix_trie(df)
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 60, 400])
def test_subtree_totals_of_random_trees(spark, n):
    rnd = random.Random(n)
    # a long chain, a star and random branches
    parent = {0: None} | {i: (i - 1 if i < n // 2 else 0 if i < n // 2 + n // 8 else rnd.randrange(i)) for i in range(1, n)}
    names = {i: rnd.getrandbits(62) - (1 << 61) for i in parent}
    value = {i: rnd.randint(-5, 100) for i in parent}
    kids = defaultdict(int)
    for p in parent.values():
        kids[p] += 1
    total = dict(value)
    for i in range(n - 1, 0, -1):
        total[parent[i]] += total[i]
    rows = [(names[i], None if p is None else names[p], kids[i], value[i], 1) for i, p in parent.items()]
    got = subtree_totals(spark.createDataFrame(rows, "id long, parent long, n_children long, v long, one long"), ("v", "one")).collect()
    assert sorted((r.id, r.v) for r in got) == sorted((names[i], total[i]) for i in parent)
    assert max(r.one for r in got) == n


def test_given_table(spark):
    rows = sf_rows("conversations", "conv_id, turn, role, text")
    assert found(spark, rows) == brute(rows)


def test_hard_rows(spark):
    rnd = random.Random(7)
    rows = [(None, 0, "user", "nobody"), (5, None, None, None), (5, 1, "user", None), (5, 1, "user", None), (5, 1, "a", "tie"), (5, 1, "b", "tie"),
            (-3, 0, "user", "x" * 100_000), (104, 0, "user", "only one turn"), (7, 2**40, "é", "🎉" * 3)]
    rows += [(c, t, rnd.choice(["user", "bot", None]), rnd.choice(["hi", "yes", "no", None])) for c in range(100, 260) for t in range(rnd.randint(1, 7))]
    rows += [(300 + c, t, "user", "same") for c in range(150) for t in range(4)]  # equal conversations
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []


def test_a_third_of_the_rows_in_one_conversation(spark):
    rnd = random.Random(9)
    rows = [(77, t // 3, "user", rnd.choice(["a", "b"])) for t in range(400)]
    rows += [(77, 500, "user", "again")] * 60
    rows += [(c, t, "user", rnd.choice(["a", "b"])) for c in range(200, 330) for t in range(rnd.randint(1, 8))]
    assert found(spark, rows) == brute(rows)

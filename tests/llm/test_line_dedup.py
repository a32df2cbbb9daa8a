"""Line deduplication (8) against a loop over all chunks."""

import hashlib

from regioncast.llm import line_dedup as ld
from regioncast.llm import queries
from tests.llm.helpers import HARD, SF, documents, sf_rows


def brute(rows):
    key = lambda d: float("inf") if d is None else d
    first, count = {}, {}
    for d, t in rows:
        lines, parts = ld.chunks((t or "").encode())
        for a, b in parts:
            body = ld.comparable(lines[a:b])
            if body is not None:
                first[body] = min(first.get(body, float("inf")), key(d))
                count[body] = count.get(body, 0) + 1
    out = []
    for d, t in rows:
        lines, parts = ld.chunks((t or "").encode())
        kept, gone, seen = b"", 0, set()
        for a, b in parts:
            body = ld.comparable(lines[a:b])
            if body is not None and count[body] > 1 and (first[body] < key(d) or body in seen):
                gone += b - a
                continue
            seen.add(body)
            kept += b"\n".join(lines[a:b]) + (b"\n" if b < len(lines) else b"")
        out.append((d, len(lines), gone, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_op8_whole_table(spark):
    got = queries.op8_line_chunks(spark, SF).collect()
    want = brute(sf_rows())
    assert sorted(map(tuple, got), key=repr) == want and sum(r[2] for r in want) > 0


def test_boundaries_resist_shifts():
    lines = [f"line {i * 7919 % 1000} of the text" for i in range(200)]
    text = lambda x: "\n".join(x).encode()
    a, b = ld.chunks(text(lines)), ld.chunks(text(["new", "other", "third", *lines]))
    bodies = lambda c: {b"\n".join(c[0][x:y]) for x, y in c[1]}
    assert len(bodies(a) - bodies(b)) <= 2
    assert all(y - x >= 2 for x, y in a[1][:-1]) and a[1][-1][1] == 200


def test_blank_lines_between_paragraphs_change_nothing(spark):
    """Copies of passages lose the same paragraphs, most of them, whether blank lines stand between these or not."""
    rows = []
    for i in range(30):
        passage = [f"paragraph {j} of passage {i}: {hashlib.sha256(f'{i} {j}'.encode()).hexdigest()}" for j in range(20)]
        rows += [(i, [f"only {i} a {j}" for j in range(3)] + passage), (100 + i, [f"only {i} b {j}" for j in range(4)] + passage + [f"end {i}", f"more {i}"])]
    left = []
    for gap in ("\n", "\n\n"):
        got = ld.without_repeated_chunks(documents(spark, [(d, gap.join(lines)) for d, lines in rows])).collect()
        left.append({r.doc_id: [x for x in r.text.split("\n") if x.strip()] for r in got})
    assert left[0] == left[1]
    assert all(left[0][d] == lines for d, lines in rows if d < 100)
    copies = [sum(x.startswith("paragraph") for x in left[0][d]) for d, _ in rows if d >= 100]
    assert sum(copies) < 0.3 * 20 * len(copies)  # a chunk at either end of a passage holds a neighbour


def _hard():
    block = "\n".join(f"shared line {i * i % 97}" for i in range(40))
    rows = [*HARD, (20, block), (21, "head\nmore\n" + block + "\ntail"), (22, block + "\n" + block), (23, "a\nb\na\nb\na\nb"), (24, "a\nb\na\nb\na\nb"),
            (25, "\n\n\n\n"), (26, "\n\n\n\n"), (None, block)]
    return rows


def test_hard_cases(spark):
    rows = _hard()
    got = ld.without_repeated_chunks(documents(spark, rows))
    assert got.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    out = sorted(((r.doc_id, r.n_lines, r.n_removed, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in got.collect()), key=repr)
    assert out == brute(rows)
    assert got.where("doc_id = 1").first().text is None
    assert ld.without_repeated_chunks(documents(spark, rows).limit(0)).collect() == []


def test_shared_hash_is_told_apart_by_bytes():
    text = b"a\nb"
    assert ld.kept_text(text, [{"ord": 0, "first": False, "body": b"x\ny"}]) == (text, 2, 0)
    assert ld.kept_text(text, [{"ord": 0, "first": False, "body": b"a\nb"}]) == (b"", 2, 2)

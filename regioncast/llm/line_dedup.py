"""Line deduplication by content-defined chunks of lines.

A text's lines (split at \\n) that hold a word are hashed, and a rolling hash runs over each such line and the one before it.  A chunk ends after
a line whose rolling hash is a local minimum (smaller than the one before, not larger than the next), so boundaries depend on nearby
lines only and stay in place when lines are added elsewhere; every chunk but a text's last has two lines with words or more.  Blank lines have
no part in this: they belong to the chunk before them, a text's first ones to its first chunk.

Chunks with two lines or more that hold a word are compared over the whole corpus, from the first such line to the last: they are grouped by hash and bytes (the bytes are
the byte comparison), pre-aggregated before the shuffle.  Of each repeated chunk the first occurrence stays: in the smallest doc_id, there the earliest.
All others are removed with their line ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regioncast.llm.common import narrowed, slices, small_batches, stored, whole_row

_MIX = np.uint64(0x9E3779B97F4A7C15)


def chunk_ends(lines: list[bytes]) -> list[int]:
    """Number of lines up to each chunk's end."""
    from xxhash import xxh64_intdigest as digest

    worded = [i for i, x in enumerate(lines) if x.strip()]
    h = np.fromiter((digest(lines[i]) for i in worded), dtype=np.uint64, count=len(worded))
    roll = h.copy()
    roll[1:] += h[:-1] * _MIX
    roll = (roll ^ (roll >> np.uint64(29))) * _MIX
    roll ^= roll >> np.uint64(32)
    low = (roll[1:-1] < roll[:-2]) & (roll[1:-1] <= roll[2:])
    return [*(worded[k + 2] for k in np.flatnonzero(low).tolist()), len(lines)]


def chunks(text: bytes | None) -> tuple[list[bytes], list[tuple[int, int]]]:
    """The text's lines, and its chunks as ranges of lines.  An empty text has no lines."""
    if not text:
        return [], []
    lines = text.split(b"\n")
    ends = chunk_ends(lines)
    return lines, list(zip([0, *ends[:-1]], ends))


def comparable(lines: list[bytes]) -> bytes | None:
    """What is compared of a chunk: its lines without blank ones at either end and the last line end; None unless two lines hold a word."""
    worded = [i for i, x in enumerate(lines) if x.strip()]
    if len(worded) < 2:
        return None
    return b"\n".join(lines[worded[0]:worded[-1] + 1])


def _chunk_rows(docs: DataFrame, with_body: bool) -> DataFrame:
    """A row for each comparable chunk: (doc_id, text_key, ord, h) or (doc_id, h, body)."""
    from xxhash import xxh64_intdigest as digest

    names = ["doc_id", "h", "body"] if with_body else ["doc_id", "text_key", "ord", "h"]
    kinds = [pa.int64(), pa.int64(), pa.binary()] if with_body else [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    sql = "doc_id long, h long, body binary" if with_body else "doc_id long, text_key long, ord int, h long"

    def cut(batches):
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text_key", "text"))):
                lines, parts = chunks(text)
                for k, (a, b) in enumerate(parts):
                    body = comparable(lines[a:b])
                    if body is not None:
                        h = digest(body)
                        h = h - (1 << 64) if h >> 63 else h
                        rows.append((doc_id, h, body) if with_body else (doc_id, key, k, h))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*rows), kinds)], names=names)

    return docs.mapInArrow(cut, sql)


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, drops): the repeated chunks of each document that has some.

    drops lists struct(ord, first, body): first is true if this document holds the first occurrence; body is only set where
    different chunks share a hash, and then only the chunk with these bytes is meant.
    """
    own = narrowed(docs, doc_id="long", text="binary").withColumn("text_key", F.xxhash64("text"))
    marks = stored(_chunk_rows(own, with_body=False), "marks")
    classes = _chunk_rows(own, with_body=True).groupBy("h", "body").agg(F.count("*").alias("n"), F.min("doc_id").alias("least"))
    # A row for each chunk hash; bodies are kept only where chunks repeat, for the case that others share their hash.
    classes = stored(classes.select("h", "n", "least", F.when(F.col("n") > 1, F.col("body")).alias("body")), "chunks")
    kinds = classes.groupBy("h").agg(F.count("*").alias("kinds"), F.max("n").alias("n"), F.min("least").alias("least"))
    decided = stored(kinds.where("n > 1").select("h", "least", "kinds"), "repeated")
    plain = decided.where("kinds = 1").select("h", "least", F.lit(None).cast("binary").alias("body"))
    shared = classes.where("n > 1").join(decided.where("kinds > 1").select("h"), "h").select("h", "least", "body")
    hits = marks.join(plain, "h").unionByName(marks.join(shared, "h"))
    first = F.col("doc_id").eqNullSafe(F.col("least"))
    return hits.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("ord", first.alias("first"), "body")).alias("drops"))


def kept_text(text: bytes | None, drops: list[dict]) -> tuple[bytes | None, int, int]:
    """The text without the chunks that go, its number of lines, and the number of lines removed."""
    lines, parts = chunks(text)
    if not drops:
        return text, len(lines), 0
    by_ord: dict[int, list[dict]] = {}
    for d in drops:
        by_ord.setdefault(d["ord"], []).append(d)
    out, removed, seen = [], 0, set()
    for k, (a, b) in enumerate(parts):
        body = comparable(lines[a:b]) if k in by_ord else None
        meant = [d for d in by_ord.get(k, []) if d["body"] is None or d["body"] == body]
        if meant and (not meant[0]["first"] or body in seen):
            removed += b - a
            continue
        if meant:
            seen.add(body)
        out.append(b"\n".join(lines[a:b]) + (b"\n" if b < len(lines) else b""))
    return b"".join(out), len(lines), removed


def without_repeated_chunks(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, text without its repeated chunks, then n_lines and n_removed (lines of the text before).

    Null texts stay null; empty texts have no lines; blank lines and single lines are never compared; rows with the same doc_id are one
    document: each keeps its own first occurrence; null doc_ids count as larger than any other, and texts that only
    such rows share keep their chunks; columns of ``docs`` named like an added one, in any case, are replaced, others may have any names; no
    rows give no rows.
    """
    small_batches(docs.sparkSession)
    added = ("n_lines", "n_removed")
    kept = [f for f in docs.schema.fields if f.name.lower() not in added]
    rest = T.StructType([f for f in kept if f.name.lower() != "text"])
    # The drops grow with the corpus: they are never broadcast, whatever their size here.
    drops = stored(repeated_chunks(docs), "drops").hint("merge")
    keyed = docs.select(whole_row(docs, "text", *added), docs["text"].cast("string").alias("text"), docs["doc_id"].cast("long").alias("id"),
                        F.xxhash64(docs["text"].cast("binary")).alias("own"))
    found = keyed.join(drops, (keyed["own"] == drops["text_key"]) & keyed["id"].eqNullSafe(drops["doc_id"]), "left")
    out = T.StructType([T.StructField("row", rest), T.StructField("text", T.StringType()), *(T.StructField(n, T.LongType()) for n in added)])

    def cut(batches):
        for batch in slices(batches, "text"):
            rows = [kept_text(t, d or []) for t, d in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("drops").to_pylist())]
            texts, lines, gone = zip(*rows)
            text = pa.array([None if t is None else t.decode("utf-8", "replace") for t in texts], type=pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), text, pa.array(lines, type=pa.int64()), pa.array(gone, type=pa.int64())],
                                             names=["row", "text", *added])

    cleaned = found.select("row", "text", "drops").mapInArrow(cut, out)
    columns = [F.col("text").alias(f.name) if f.name.lower() == "text" else F.col("row")[f.name].alias(f.name) for f in kept]
    return cleaned.select(*columns, *added)

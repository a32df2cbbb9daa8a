"""Statistics of whole texts, used by the quality rules and the quality classifier."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from regioncast.llm.common import narrowed, slices, small_batches

STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_digits", "n_adjacent", "n_distinct")

_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_INNER = bytes(range(0x80, 0xC0))  # later bytes of a character
_WINDOW = 5


def repeated_words(words: list[bytes], codes: np.ndarray) -> int:
    """Words covered by a five-word window that occurs twice or more.  ``codes`` are the words' hashes: windows whose
    hashes are unique can't repeat, the others are compared word by word."""
    n = len(words) - _WINDOW + 1
    if n < 2:
        return 0
    mixed = np.zeros(n, dtype=np.uint64)
    for k in range(_WINDOW):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[k:k + n]
    order = np.argsort(mixed)
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return 0
    again = np.zeros(n, dtype=bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    at = np.flatnonzero(again).tolist()
    counts = Counter(tuple(words[i:i + _WINDOW]) for i in at)
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    hit = np.array([i for i in at if counts[tuple(words[i:i + _WINDOW])] > 1], dtype=np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + _WINDOW, -1)
    return int((np.cumsum(cover)[:-1] > 0).sum())


def text_stats(text: bytes | None) -> tuple[int, ...]:
    """`STATS` of a text; all 0 for null."""
    text = text or b""
    words = text.split()  # bytes: split at ASCII white space
    codes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    lines = [x for x in text.split(b"\n") if x.strip()]
    gone = lambda chars: len(text) - len(text.translate(None, chars))
    return (
        len(words), len(text.translate(None, _SPACE + _INNER)), gone(b"#*$%&|<>"), len(lines), len(lines) - len(set(lines)),
        repeated_words(words, codes), gone(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), gone(b"0123456789"),
        int((codes[1:] == codes[:-1]).sum()), len(set(words)),
    )


def document_stats(docs: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, ``keep`` as strings, `STATS`) for every row; null texts have zeros; other columns are ignored."""
    small_batches(docs.sparkSession)

    def compute(batches):
        for batch in slices(batches, "text"):
            rows = np.array([text_stats(t) for t in batch.column("text").to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", *keep)] + [pa.array(rows[:, k]) for k in range(len(STATS))], names=["doc_id", *keep, *STATS])

    schema = ", ".join(["doc_id long", *(f"{c} string" for c in keep), *(f"{s} long" for s in STATS)])
    return narrowed(docs, doc_id="long", **{c: "string" for c in keep}, text="binary").mapInArrow(compute, schema)

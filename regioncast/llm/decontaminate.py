"""Benchmark decontamination with an FM-index per training shard.

A shard is a bounded run of a partition's documents.  Its words are written as symbols of the
benchmark's vocabulary; a word outside of it can't be part of a test phrase, so it ends a run,
and runs shorter than the shortest phrase are left out of the index.  All test phrases are
searched backwards at once; occurrences are located by sampled places and merged into
removal spans.  Documents are not shuffled.  The benchmark goes to the workers in blocks of
at most about `BLOCK_BYTES` of text, one pass over the documents per block.
"""

from __future__ import annotations

import math
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regioncast.llm.common import narrowed, slices, small_batches, stored, whole_row
from regioncast.llm.fm_index import SEPARATOR, FMIndex

#: Text of the benchmark that is searched in one pass.
BLOCK_BYTES = 32 << 20
#: Text bytes of a shard.
SHARD_BYTES = 24 << 20

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Every byte outside of words becomes a blank; bytes of characters beyond ASCII are word bytes.
_BLANKED = bytes(c if _WORD.match(bytes([c])) else 32 for c in bytes(range(256)).lower())


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_BLANKED).split() if text else []


class Phrases:
    """Distinct test phrases of a block of items: windows of ``width`` words, or a shorter item as a whole."""

    def __init__(self, items: list[tuple], width: int):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple, set] = {}
        for item_id, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for k in range(max(1, len(words) - width + 1) if words else 0):
                found.setdefault(tuple(words[k:k + width]), set()).add(item_id)
        self.sizes = np.array([len(p) for p in found], dtype=np.int64)
        self.symbols = np.zeros((len(found), width), dtype=np.uint32)
        for k, p in enumerate(found):
            self.symbols[k, width - len(p):] = p
        self.items = [sorted(i for i in ids if i is not None) for ids in found.values()]
        self.shortest = int(self.sizes.min()) if len(found) else 0

    def runs(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of the runs that can hold a phrase, each with a separator after it, and the word number of each symbol."""
        seen = np.fromiter(map(self.vocabulary.get, words, repeat(SEPARATOR)), dtype=np.uint32, count=len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], seen != SEPARATOR, [0]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.shortest
        starts, ends = starts[long], ends[long]
        sizes = ends - starts + 1
        at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        symbols = np.append(seen, np.uint32(SEPARATOR))[at]
        symbols[np.cumsum(sizes) - 1] = SEPARATOR
        return symbols, at


def shard_hits(texts: list, phrases: Phrases) -> tuple[list[int], dict[int, tuple[list, set]]]:
    """Word count of each text, and for texts with occurrences their word spans [start, end) and item ids."""
    counts, symbols, place, owner = [], [], [], []
    for k, text in enumerate(texts):
        words = words_of(text)
        counts.append(len(words))
        if len(words) >= phrases.shortest > 0:
            s, at = phrases.runs(words)
            if len(s):
                symbols.append(s)
                place.append(at)
                owner.append(np.full(len(s), k))
    if not symbols:
        return counts, {}
    sequence, place, owner = np.concatenate(symbols), np.concatenate(place), np.concatenate(owner)
    index = FMIndex(sequence)
    low, high = index.search(phrases.symbols, phrases.sizes)
    many = np.maximum(high - low, 0)
    phrase = np.repeat(np.arange(len(many)), many)
    rows = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
    at = index.locate(rows)
    cover = np.zeros(len(sequence) + 1, dtype=np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + phrases.sizes[phrase], -1)
    hit = np.flatnonzero(np.cumsum(cover)[:-1] > 0)
    hits: dict[int, tuple[list, set]] = {}
    new = np.concatenate([[True], (place[hit][1:] != place[hit][:-1] + 1) | (owner[hit][1:] != owner[hit][:-1])]) if len(hit) else []
    begins = np.flatnonzero(new)
    for a, b in zip(begins, np.append(begins[1:], len(hit))):
        hits.setdefault(int(owner[hit[a]]), ([], set()))[0].append((int(place[hit[a]]), int(place[hit[b - 1]]) + 1))
    for k, p in {(int(o), int(p)) for o, p in zip(owner[at], phrase)}:
        hits[k][1].update(phrases.items[p])
    return counts, hits


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order, those that touch or overlap joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def byte_spans(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as spans of the text's bytes, from the first word's start to the last one's end."""
    bounds = [m.span() for m in _WORD.finditer(text.lower())]
    return [(bounds[a][0], bounds[b - 1][1]) for a, b in spans]


_STATE = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("text", pa.binary()), ("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.int64()))])
_STATE_SQL = "doc_id long, text_key long, text binary, n_words long, spans array<long>, items array<long>"
_RESULT = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())), ("removed", pa.list_(pa.int64()))])
_RESULT_SQL = "doc_id long, text_key long, n_words long, n_hit long, items array<long>, removed array<long>"


def _passed(state: DataFrame, phrases: Phrases, last: bool) -> DataFrame:
    """One block's pass: its hits are added to each row's spans and items."""
    sent = state.sparkSession.sparkContext.broadcast(phrases)

    def mark(batches):
        known, held, size = sent.value, [], 0

        def flush():
            table = pa.Table.from_batches(held).to_pydict()
            counts, hits = shard_hits(table["text"], known)
            rows = []
            for k, (doc_id, key, text) in enumerate(zip(table["doc_id"], table["text_key"], table["text"])):
                flat, items = table["spans"][k], set(table["items"][k])
                spans = list(zip(flat[::2], flat[1::2]))
                if k in hits:
                    spans, items = merged(spans + hits[k][0]), items | hits[k][1]
                if last:
                    cut = [x for s in (byte_spans(text, spans) if spans else []) for x in s]
                    rows.append((doc_id, key, counts[k], sum(b - a for a, b in spans), sorted(items), cut))
                else:
                    rows.append((doc_id, key, text, counts[k], [x for s in spans for x in s], sorted(items)))
            schema = _RESULT if last else _STATE
            return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in slices(batches, "text"):
            held.append(batch)
            size += batch.column("text").nbytes
            if size >= SHARD_BYTES:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    return state.mapInArrow(mark, _RESULT_SQL if last else _STATE_SQL)


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = 13, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, items, removed) for every row of ``docs``.

    text_key is a hash of the text, n_hit counts words inside any occurrence of a test phrase, items are the sorted ids of items with an
    occurring phrase, removed holds the merged spans as byte offsets (start, end, start, end ...) of the text.  Null,
    empty and wordless texts have no words; items with null text have no phrase; an item with a null id marks words but is not
    listed; rows that share an id are judged one by one; extra columns are ignored; an empty benchmark hits nothing.
    """
    small_batches(docs.sparkSession)
    items = narrowed(benchmark, item_id="long", text="binary").where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    state = narrowed(docs, doc_id="long", text="binary").select("doc_id", F.xxhash64("text").alias("text_key"), "text").withColumns({
        "n_words": F.lit(0).cast("long"), "spans": F.array().cast("array<long>"), "items": F.array().cast("array<long>")})
    for k in range(blocks):
        block = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k)
        state = _passed(state, Phrases([(r.item_id, bytes(r.text)) for r in block.toLocalIterator()], width), k == blocks - 1)
    return state


def is_contaminated(n_hit="n_hit", n_words="n_words") -> F.Column:
    """At least one word in twenty is inside an occurrence."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = 13) -> DataFrame:
    """All columns of the documents that are not contaminated; these stay as they are.

    Rows are judged as by `contamination`: null, empty and wordless texts are never contaminated, an empty benchmark contaminates nothing,
    of equal rows all stay or go, a text of any length is judged whole.  Columns may have any names; no rows give no rows.
    """
    bad = contamination(docs, benchmark, width).where(is_contaminated()).select("doc_id", "text_key").distinct()
    keyed = docs.select(whole_row(docs), docs["doc_id"].cast("long").alias("id"), F.xxhash64(docs["text"].cast("binary")).alias("key"))
    bad = stored(bad, "contaminated")
    same = (keyed["key"] == bad["text_key"]) & keyed["id"].eqNullSafe(bad["doc_id"])
    return keyed.join(bad, same, "left_anti").select("row.*")


def without_spans(text: bytes, removed: list[int]) -> bytes:
    """The text without its removal spans."""
    keep, at = [], 0
    for a, b in zip(removed[::2], removed[1::2]):
        keep.append(text[at:a])
        at = b
    return b"".join([*keep, text[at:]])

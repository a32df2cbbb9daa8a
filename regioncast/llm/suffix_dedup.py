"""Exact repeated byte windows, by depth-limited radix sort of suffixes.

A window is the first `width` bytes of a suffix.  It is removed from a document if it also starts in a document with
a smaller doc_id, so the suffixes must be ordered through `width` bytes only, and groups of equal
suffixes are exactly the repeated windows.

1. Documents are gathered into blocks (rows of a stored table, never split or shuffled by key).
2. First pass, over the whole corpus.  Equal windows have the same leftmost smallest `GRAM`-byte piece (their anchor), so each
   window is dealt by its anchor.  A block sends the fingerprint of each distinct anchor once; anchors of a
   single document are settled, for none of their windows repeats.
3. Blocks send the distinct byte segments around the anchors that are left; a segment holds the windows of one anchor.  Copies
   within a block were merged by then, whatever their number.  An anchor with more than `HOT` different surroundings sends its windows one by one,
   dealt by their own bytes, so that no anchor meets in one task.
4. In each bucket the suffixes are ordered by most-significant-digit passes of eight bytes.  After each pass, groups whose members all
   come from the same smallest document are settled.  What is equal after `width` bytes is a repeated window.
5. One bit per window goes back to its block, which removes the covered bytes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regioncast.llm.common import joined_bytes, narrowed, slices, small_batches, stored

GRAM = 16
#: Text bytes of a block (a longer document is a block of its own), and of the corpus for each bucket.
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 8 << 20
#: Different surroundings of an anchor beyond which its windows are dealt one by one.
HOT = 4096
_CHUNK = 1 << 16
_NO_ID = np.iinfo(np.int64).max


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place of ``data`` on, as unsigned numbers; no copy.  The last seven places have none."""
    return np.ndarray(shape=(max(0, len(data) - 7),), dtype="<u8", buffer=data, strides=(1,))


def _slide(x: np.ndarray, width: int, least) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = least(x[:-size], x[size:])
        size *= 2
    return least(x[:len(x) - (width - size)], x[width - size:]) if size < width else x


def anchors(data: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Places whose `GRAM` bytes have the smallest hash of some window of a document (ties included), ascending."""
    reach, n = width - GRAM + 1, len(data)
    inside = np.zeros(n + 1, dtype=np.int32)  # starts of windows that lie in one document
    long = np.diff(offsets) >= width
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - width + 1, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int32).astype(bool)
    found = []
    for at in range(0, n, _CHUNK):
        low, high = max(0, at - reach + 1), min(n, at + _CHUNK + reach + GRAM)
        if high - low < width:
            continue
        h = data[low:high].astype(np.uint32) + np.uint32(1)
        size, factor = 1, 0x9E3779B1
        while size < GRAM:
            h = h[:-size] * np.uint32(factor) + h[size:]
            size, factor = size * 2, factor * factor & 0xFFFFFFFF
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        h *= np.uint32(0xC2B2AE35)
        h |= np.uint32(1)
        least = _slide(h, reach, np.minimum)
        least *= inside[low:low + len(least)]
        edge = np.zeros(reach - 1, dtype=np.uint32)
        top = _slide(np.concatenate([edge, least, edge]), reach, np.maximum)[:len(h)]
        place = np.flatnonzero(top == h) + low
        found.append(place[(place >= at) & (place < at + _CHUNK)])
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Block:
    """A block's windows by anchor: anchor i has the windows that start from low[i] to high[i]."""

    def __init__(self, doc_ids: list, offsets: np.ndarray, data: np.ndarray, width: int):
        self.ids = np.array([_NO_ID if d is None else d for d in doc_ids], dtype=np.int64)
        self.offsets, self.data, self.width = offsets, data, width
        place = anchors(data, offsets, width)
        words = words_at(data)
        # Sixteen bytes are two words: the fingerprint depends on exactly these.
        self.prints = _mixed(words[place] * np.uint64(0x9E3779B97F4A7C15) + _mixed(words[place + 8]))
        self.doc = np.searchsorted(offsets, place, side="right") - 1
        reach, n = width - GRAM + 1, len(place)
        # The leftmost smallest piece of a window: nothing before it is as small, nothing behind it smaller.
        key = self._order_key(place)
        low, high = np.maximum(place - reach + 1, offsets[self.doc]), np.minimum(place, offsets[self.doc + 1] - width)
        todo, k = np.arange(n), 1
        while len(todo):
            todo = todo[todo >= k]
            todo = todo[place[todo] - place[todo - k] < reach]
            stop = key[todo - k] <= key[todo]
            low[todo[stop]] = np.maximum(low[todo[stop]], place[todo[stop] - k] + 1)
            todo, k = todo[~stop], k + 1
        todo, k = np.arange(n), 1
        while len(todo):
            todo = todo[todo + k < n]
            todo = todo[place[todo + k] - place[todo] < reach]
            stop = key[todo + k] < key[todo]
            high[todo[stop]] = np.minimum(high[todo[stop]], place[todo[stop] + k] - reach)
            todo, k = todo[~stop], k + 1
        used = low <= high
        self.low, self.high, self.doc, self.prints = low[used], high[used], self.doc[used], self.prints[used]

    def _order_key(self, place: np.ndarray) -> np.ndarray:
        """The hash that chose the anchors, at the anchors."""
        h = [self.data[place + i].astype(np.uint32) + np.uint32(1) for i in range(GRAM)]
        factor = 0x9E3779B1
        while len(h) > 1:
            h = [a * np.uint32(factor) + b for a, b in zip(h[::2], h[1::2])]
            factor = factor * factor & 0xFFFFFFFF
        h = h[0]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        h ^= h >> np.uint32(13)
        h *= np.uint32(0xC2B2AE35)
        return h | np.uint32(1)

    def fingerprints(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct fingerprints (ascending), the index of each anchor's one, and a byte for each: 128 if it is in several documents,
        plus the number of its different surroundings (127 at most)."""
        order = np.argsort(self.prints, kind="stable")
        p, d = self.prints[order], self.doc[order]
        new = np.concatenate([[True], p[1:] != p[:-1]]) if len(p) else np.zeros(0, dtype=bool)
        index = np.empty(len(p), dtype=np.int64)
        index[order] = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        if not len(starts):
            return p, index, np.zeros(0, dtype=np.uint8)
        several = np.maximum.reduceat(self.ids[d], starts) != np.minimum.reduceat(self.ids[d], starts)
        near = np.concatenate([[0], self.prints, [0]]).astype(np.uint64)
        around = _mixed(near[:-2] * np.uint64(3) + near[2:] + (self.high - self.low).astype(np.uint64))[order]
        both = np.lexsort((around, index[order]))
        fresh = new[both] | np.concatenate([[True], around[both][1:] != around[both][:-1]])
        kinds = np.add.reduceat(fresh.astype(np.int64), starts)
        return p[new], index, (np.minimum(kinds, 127) + 128 * several).astype(np.uint8)

    def segments(self, verdict: np.ndarray, buckets: int):
        """Distinct segments of the anchors that are left: for each bucket the list of their numbers; and for each occurrence
        (number, first window, windows, document).  verdict per anchor: 0 settled, 1 by anchor, 2 window by window."""
        raw, width = self.data.tobytes(), self.width
        known: dict[bytes, int] = {}
        least: list[int] = []
        deal: list[int] = []
        number, first, count, doc = [], [], [], []
        where = bucket_of(self.prints, buckets).tolist()
        rows = np.flatnonzero(verdict)
        lows, highs, docs = self.low[rows].tolist(), self.high[rows].tolist(), self.doc[rows].tolist()
        ids = self.ids.tolist()
        for i, v, a, b, d in zip(rows.tolist(), verdict[rows].tolist(), lows, highs, docs):
            for s, e in ((a, b),) if v == 1 else ((w, w) for w in range(a, b + 1)):
                part = raw[s:e + width]
                k = known.get(part)
                if k is None:
                    k = known[part] = len(least)
                    least.append(ids[d])
                    deal.append(where[i] if v == 1 else zlib_bucket(part, buckets))
                elif ids[d] < least[k]:
                    least[k] = ids[d]
                number.append(k)
                first.append(s)
                count.append(e - s + 1)
                doc.append(d)
        deal_at = np.array(deal, dtype=np.int64)
        by = np.argsort(deal_at, kind="stable")
        cuts = np.flatnonzero(np.diff(deal_at[by])) + 1
        groups = {int(deal_at[g[0]]): g for g in np.split(by, cuts) if len(g)}
        return list(known), np.array(least, dtype=np.int64), groups, tuple(np.array(x, dtype=np.int64) for x in (number, first, count, doc))


def bucket_of(prints: np.ndarray, buckets: int) -> np.ndarray:
    return ((prints >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def zlib_bucket(part: bytes, buckets: int) -> int:
    import zlib

    return zlib.crc32(part) % buckets


def repeated_windows(parts: list[bytes], least: np.ndarray, width: int) -> list[np.ndarray]:
    """For each segment, whether each of its windows starts in a document smaller than ``least`` of the segment.

    ``parts`` are the segments of a bucket, of any blocks; a segment of n + width - 1 bytes has n windows.
    """
    known: dict[bytes, int] = {}
    kind = np.array([known.setdefault(p, len(known)) for p in parts], dtype=np.int64)
    lowest = np.full(len(known), _NO_ID, dtype=np.int64)
    np.minimum.at(lowest, kind, least)
    sizes = np.array([len(p) for p in known], dtype=np.int64)
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join(known) + bytes(8), dtype=np.uint8)
    windows = sizes - width + 1
    owner = np.repeat(np.arange(len(sizes)), windows)
    at = np.repeat(begins - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    smaller = radix_pass(data, at, lowest[owner], width)
    ends = np.cumsum(windows)
    out = []
    for k, own in zip(kind.tolist(), least.tolist()):
        if lowest[k] < own:
            out.append(np.ones(windows[k], dtype=bool))
        else:
            out.append(smaller[ends[k] - windows[k]:ends[k]])
    return out


def radix_pass(data: np.ndarray, at: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """For each suffix (its place and its smallest document), whether an equal one has a smaller document.

    Most-significant-digit passes of eight bytes; only groups that still hold different documents go on.
    """
    words, result = words_at(data), np.zeros(len(at), dtype=bool)
    left, group = np.arange(len(at)), np.zeros(len(at), dtype=np.int64)
    for depth in range(0, width, 8):
        digit = words[at[left] + depth].byteswap()
        if width - depth < 8:
            digit >>= np.uint64(8 * (8 - (width - depth)))
        order = np.argsort(digit, kind="stable") if depth == 0 else np.lexsort((digit, group))
        left, group, digit = left[order], group[order], digit[order]
        new = np.concatenate([[True], (digit[1:] != digit[:-1]) | (group[1:] != group[:-1])]) if len(left) else np.zeros(0, dtype=bool)
        starts = np.flatnonzero(new)
        if not len(starts):
            break
        d = doc[left]
        low = np.minimum.reduceat(d, starts)
        mixed = np.maximum.reduceat(d, starts) != low
        group = np.cumsum(new) - 1
        keep = mixed[group]
        left, group = left[keep], group[keep]
        if depth + 8 >= width:
            result[left] = doc[left] > low[group]
    return result


def _blocks(docs: DataFrame) -> DataFrame:
    """Rows (block, doc_ids, offsets, data): documents gathered into blocks, their bytes compressed."""

    def gather(batches):
        task, squeeze = TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=3)
        held, size, number = [], 0, 0

        def flush():
            t = pa.Table.from_batches(held).combine_chunks()
            data, off = joined_bytes(t["text"].combine_chunks())
            cols = [[task + number], [t["doc_id"].to_pylist()], [off.tolist()], [squeeze.compress(data.tobytes())]]
            kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds)], names=["block", "doc_ids", "offsets", "data"])

        for batch in slices(batches, "text", BLOCK_BYTES // 4):
            if held and size + batch.column("text").nbytes > BLOCK_BYTES:
                yield flush()
                held, size, number = [], 0, number + 1
            held.append(batch)
            size += batch.column("text").nbytes
        if held:
            yield flush()

    return stored(narrowed(docs, doc_id="long", text="binary").mapInArrow(gather, "block long, doc_ids array<long>, offsets array<long>, data binary"), "blocks")


def _opened(row: dict, width: int) -> Block:
    raw = zstandard.ZstdDecompressor().decompress(row["data"]) if row["data"] else b""
    return Block(row["doc_ids"], np.array(row["offsets"], dtype=np.int64), np.frombuffer(raw, dtype=np.uint8), width)


def _rows(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _record(names: list[str], kinds: list, rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(zip(*rows) if rows else [[]] * len(names), kinds)], names=names)


_SENT = "bucket int, block long, body binary"
_SENT_KINDS = [pa.int32(), pa.int64(), pa.binary()]


def _pack(*arrays: np.ndarray) -> bytes:
    body = b"".join(a.tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(body)


def _unpack(body: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(body)


def repeated_spans(docs: DataFrame, width: int = 50, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, removed, kept) for every row: removed holds the maximal runs of removed bytes (start, end, start, end ...),
    kept the remaining bytes.

    A byte is removed if a ``width``-byte string over it also starts in a document with a smaller doc_id.  Null texts are empty;
    texts shorter than ``width`` keep all bytes; rows with the same doc_id never remove each other's bytes; a null doc_id is
    larger than any other; extra columns are ignored; no rows give no rows.
    """
    if not GRAM <= width <= 255 - GRAM:
        raise ValueError(f"width must be from {GRAM} to {255 - GRAM}")
    spark = docs.sparkSession
    small_batches(spark)
    blocks = _blocks(docs)
    total = blocks.agg(F.sum(F.element_at("offsets", -1))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / BUCKET_BYTES))

    def send_prints(batches):
        for row in _rows(batches):
            block = _opened(row, width)
            prints, _, info = block.fingerprints()
            deal = bucket_of(prints, buckets)
            order = np.argsort(deal, kind="stable")
            cuts = np.flatnonzero(np.diff(deal[order])) + 1
            out = []
            for g in np.split(order, cuts):
                if len(g):  # ascending fingerprints; the bucket tells the rest of their bits
                    own = prints[g]
                    out.append((int(deal[g[0]]), row["block"], own.astype("<u4").tobytes() + (own >> np.uint64(32)).astype(np.uint8).tobytes() + info[g].tobytes()))
            if out:
                yield _record(["bucket", "block", "body"], _SENT_KINDS, out)

    def settle(key, sent):
        bodies = [np.frombuffer(b, dtype=np.uint8) for b in sent["body"].to_pylist()]
        sizes = [len(b) // 6 for b in bodies]
        prints = np.concatenate([b[:4 * n].view("<u4").astype(np.uint64) | (b[4 * n:5 * n].astype(np.uint64) << np.uint64(32)) for b, n in zip(bodies, sizes)])
        info = np.concatenate([b[5 * n:] for b, n in zip(bodies, sizes)])
        order = np.argsort(prints, kind="stable")
        p = prints[order]
        starts = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        many = np.diff(np.append(starts, len(p)))
        several = (many > 1) | (np.maximum.reduceat(info[order], starts) >= 128)
        kinds = np.add.reduceat((info[order] & 127).astype(np.int64), starts)
        verdict = np.empty(len(p), dtype=np.uint8)
        verdict[order] = np.repeat(several.astype(np.uint8) + (several & (kinds > hot)), many)
        cuts = np.cumsum(sizes)[:-1]
        rows = [(key[0].as_py(), b, _pack(v)) for b, v in zip(sent["block"].to_pylist(), np.split(verdict, cuts))]
        return pa.Table.from_batches([_record(["bucket", "block", "body"], _SENT_KINDS, rows)])

    def verdicts(block: Block, answers: list | None) -> np.ndarray:
        prints, index, _ = block.fingerprints()
        deal, out = bucket_of(prints, buckets), np.zeros(len(prints), dtype=np.uint8)
        for a in answers or []:
            out[np.flatnonzero(deal == a["bucket"])] = np.frombuffer(_unpack(a["body"]), dtype=np.uint8)
        return out[index]

    def send_segments(batches):
        for row in _rows(batches):
            if not row["answers"]:
                continue
            block = _opened(row, width)
            parts, least, groups, _ = block.segments(verdicts(block, row["answers"]), buckets)
            out = []
            for bucket, g in groups.items():
                own = [parts[k] for k in g.tolist()]
                sizes = np.array([len(p) for p in own], dtype=np.uint8)
                out.append((bucket, row["block"], _pack(np.array([len(g)], dtype="<i8"), least[g].astype("<i8"), sizes, np.frombuffer(b"".join(own), dtype=np.uint8))))
            if out:
                yield _record(["bucket", "block", "body"], _SENT_KINDS, out)

    def compare(key, sent):
        parts: list[bytes] = []
        least, counts = [], []
        for body in sent["body"].to_pylist():
            body = _unpack(body)
            n = int.from_bytes(body[:8], "little")
            least.append(np.frombuffer(body, dtype="<i8", count=n, offset=8))
            sizes = np.frombuffer(body, dtype=np.uint8, count=n, offset=8 + 8 * n)
            ends = (8 + 9 * n + np.cumsum(sizes.astype(np.int64))).tolist()
            parts += [body[a:b] for a, b in zip([8 + 9 * n, *ends[:-1]], ends)]
            counts.append(n)
        bits = repeated_windows(parts, np.concatenate(least), width)
        rows, at = [], 0
        for block, n in zip(sent["block"].to_pylist(), counts):
            rows.append((key[0].as_py(), block, _pack(np.packbits(np.concatenate(bits[at:at + n])))))
            at += n
        return pa.Table.from_batches([_record(["bucket", "block", "body"], _SENT_KINDS, rows)])

    def cut(batches):
        for row in _rows(batches):
            block = _opened(row, width)
            n = len(block.data)
            cover = np.zeros(n + 1, dtype=np.int32)
            if row["found"]:
                parts, least, groups, (number, first, count, doc) = block.segments(verdicts(block, row["answers"]), buckets)
                windows = np.array([len(p) - width + 1 for p in parts], dtype=np.int64)
                begins = np.cumsum(windows) - windows
                smaller = np.zeros(windows.sum(), dtype=bool)
                for f in row["found"]:
                    g = groups[f["bucket"]]
                    own = windows[g]
                    to = np.repeat(begins[g] - (np.cumsum(own) - own), own) + np.arange(own.sum())
                    smaller[to] = np.unpackbits(np.frombuffer(_unpack(f["body"]), dtype=np.uint8), count=int(own.sum())).astype(bool)
                step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                gone = smaller[np.repeat(begins[number], count) + step] | np.repeat(block.ids[doc] > least[number], count)
                start = (np.repeat(first, count) + step)[gone]
                np.add.at(cover, start, 1)
                np.add.at(cover, start + width, -1)
            removed = np.cumsum(cover[:-1]) > 0
            rows, raw = [], block.data
            for doc_id, a, b in zip(row["doc_ids"], row["offsets"][:-1], row["offsets"][1:]):
                own = removed[a:b]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], own, [0]]).astype(np.int8)))
                rows.append((doc_id, b - a, edges.tolist(), raw[a:b][~own].tobytes()))
            yield _record(["doc_id", "n_bytes", "removed", "kept"], [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()], rows)

    def by_block(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("block").agg(F.collect_list(F.struct("bucket", "body")).alias(name))

    settled = stored(blocks.mapInArrow(send_prints, _SENT).groupBy("bucket").applyInArrow(settle, _SENT), "settled")
    answered = blocks.join(by_block(settled, "answers"), "block", "left")
    found = stored(answered.mapInArrow(send_segments, _SENT).groupBy("bucket").applyInArrow(compare, _SENT), "found")
    final = blocks.join(by_block(settled, "answers"), "block", "left").join(by_block(found, "found"), "block", "left")
    return final.mapInArrow(cut, "doc_id long, n_bytes long, removed array<long>, kept binary")

"""Token ids in wavelet-matrix files.

One file per shard: a wavelet matrix keeps one bit-plane per bit of an id, most
significant first.  Each plane is stored with its zeros count and rank samples
as a zstd section of its own, so a reader opens only what it needs.  Access,
counting (rank) and occurrence lookup (select) work on the planes; nothing else is
stored but the documents' ids and token offsets.

Layout of a file (little-endian): magic `WVM1`, uint32 number of bits, uint64 tokens,
uint64 documents, then uint64 byte lengths of the sections, then the sections: document
ids (int64), document offsets (int64, one more than documents), validity of the
ids (uint8), and for each plane its words (uint64) followed by its rank samples
(uint32: ones before each block of 512 bits).
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regioncast.llm.common import narrowed, slices, small_batches, stored
from regioncast.llm.tokens import Encoder, little_endian

#: Tokens in a shard at most (a single longer document is a shard of its own).
SHARD_TOKENS = 1 << 18
BLOCK = 512


class Plane:
    """A bit vector with rank samples."""

    def __init__(self, bits: int, words: np.ndarray, samples: np.ndarray):
        self.bits, self.words, self.samples = bits, words, samples

    @classmethod
    def of(cls, flags: np.ndarray) -> "Plane":
        packed = np.packbits(flags, bitorder="little")
        words = np.zeros(-(-len(flags) // BLOCK) * (BLOCK // 64) + 1, dtype="<u8")
        words.view(np.uint8)[:len(packed)] = packed
        ones = np.bitwise_count(words[:-1]).reshape(-1, BLOCK // 64).sum(axis=1, dtype=np.uint32)
        return cls(len(flags), words, np.concatenate([[0], np.cumsum(ones)]).astype("<u4"))

    def flags(self) -> np.ndarray:
        return np.unpackbits(self.words.view(np.uint8), count=self.bits, bitorder="little").view(bool)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        block, word = at // BLOCK, at >> 6
        got = self.samples[block].astype(np.int64)
        for k in range(BLOCK // 64):
            w = block * (BLOCK // 64) + k
            got += np.where(w < word, np.bitwise_count(self.words[np.minimum(w, len(self.words) - 1)]), 0)
        part = self.words[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return got + np.bitwise_count(part)

    def select(self, bit: int, nth: np.ndarray) -> np.ndarray:
        """Position of the nth (from 0) one or zero, by binary search over rank."""
        low, high = np.zeros(len(nth), dtype=np.int64), np.full(len(nth), self.bits, dtype=np.int64)
        while np.any(low < high):
            mid = (low + high) // 2
            ones = self.rank(mid + 1)
            more = (ones if bit else mid + 1 - ones) <= nth
            low, high = np.where(more & (low < high), mid + 1, low), np.where(more, high, mid)
        return low


class WaveletMatrix:
    """Sequence of unsigned ids with access, rank, select and range counting."""

    def __init__(self, size: int, bits: int, planes: list[Plane], zeros: list[int]):
        self.size, self.bits, self.planes, self.zeros = size, bits, planes, zeros

    @classmethod
    def build(cls, ids: np.ndarray) -> "WaveletMatrix":
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        row = ids.astype(np.uint16) if bits <= 16 else ids.astype(np.uint32)
        planes, zeros = [], []
        for shift in range(bits - 1, -1, -1):
            ones = (row & row.dtype.type(1 << shift)) != 0
            planes.append(Plane.of(ones))
            low = np.flatnonzero(~ones)
            zeros.append(len(low))
            row = np.concatenate([row.take(low), row.take(np.flatnonzero(ones))])
        return cls(len(ids), bits, planes, zeros)

    def all(self) -> np.ndarray:
        """Every id in order: the planes merged from the least significant one up."""
        row = np.zeros(self.size, dtype=np.uint16 if self.bits <= 16 else np.uint32)
        for shift, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            ones = plane.flags()
            up = np.empty_like(row)
            up[np.flatnonzero(~ones)] = row[:zeros]
            up[np.flatnonzero(ones)] = row[zeros:] | row.dtype.type(1 << shift)
            row = up
        return row.astype(np.uint32)

    def access(self, at: np.ndarray) -> np.ndarray:
        at, got = np.asarray(at, dtype=np.int64), np.zeros(len(at), dtype=np.uint32)
        for plane, zeros in zip(self.planes, self.zeros):
            bit, ones = plane.get(at).astype(bool), plane.rank(at)
            got = (got << np.uint32(1)) | bit
            at = np.where(bit, zeros + ones, at - ones)
        return got

    def ranks(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before the position given with it."""
        low, high = np.zeros(len(at), dtype=np.int64), np.asarray(at, dtype=np.int64)
        for k, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            bit = (symbols >> (self.bits - 1 - k) & 1).astype(bool)
            a, b = plane.rank(low), plane.rank(high)
            low, high = np.where(bit, zeros + a, low - a), np.where(bit, zeros + b, high - b)
        return np.where(symbols >> self.bits == 0, high - low, 0)

    def _down(self, symbol: int, at: np.ndarray) -> np.ndarray:
        for k, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            ones = plane.rank(at)
            at = zeros + ones if symbol >> (self.bits - 1 - k) & 1 else at - ones
        return at

    def count(self, symbol: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of an id in positions start to end."""
        if symbol >> self.bits:
            return 0
        low, high = self._down(symbol, np.array([start, self.size if end is None else end], dtype=np.int64))
        return int(high - low)

    def occurrences(self, symbol: int) -> np.ndarray:
        """Positions of an id, ascending."""
        if symbol >> self.bits or not self.size:
            return np.zeros(0, dtype=np.int64)
        low, high = self._down(symbol, np.array([0, self.size], dtype=np.int64))
        at = np.arange(low, high)
        for k in range(self.bits - 1, -1, -1):
            bit = symbol >> (self.bits - 1 - k) & 1
            at = self.planes[k].select(bit, at - self.zeros[k] if bit else at)
        return at


def write_shard(doc_ids: list, offsets: np.ndarray, ids: np.ndarray) -> bytes:
    """The file of one shard."""
    matrix, squeeze = WaveletMatrix.build(ids), zstandard.ZstdCompressor(level=1)
    valid = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    heads = [np.array([d or 0 for d in doc_ids], dtype="<i8"), np.asarray(offsets, dtype="<i8"), valid]
    sections = [squeeze.compress(h.tobytes()) for h in heads]
    sections += [squeeze.compress(p.words.tobytes() + p.samples.tobytes()) for p in matrix.planes]
    sizes = [len(s) for s in sections]
    return b"".join([b"WVM1", struct.pack("<IQQ", matrix.bits, len(ids), len(doc_ids)), struct.pack(f"<{len(sizes)}Q", *sizes), *sections])


def read_shard(data: bytes) -> tuple[list, np.ndarray, WaveletMatrix]:
    """Document ids, their token offsets and the wavelet matrix of a shard's file."""
    if data[:4] != b"WVM1":
        raise ValueError("not a wavelet-matrix file")
    bits, size, docs = struct.unpack_from("<IQQ", data, 4)
    sizes = struct.unpack_from(f"<{bits + 3}Q", data, 24)
    ends = 24 + 8 * (bits + 3) + np.cumsum((0, *sizes))
    expand = zstandard.ZstdDecompressor()
    part = [expand.decompress(data[a:b]) for a, b in zip(ends[:-1], ends[1:])]
    valid = np.frombuffer(part[2], dtype=np.uint8)
    doc_ids = [int(d) if ok else None for d, ok in zip(np.frombuffer(part[0], dtype="<i8"), valid)]
    words = -(-size // BLOCK) * (BLOCK // 64) + 1
    planes = [Plane(size, np.frombuffer(p, dtype="<u8", count=words), np.frombuffer(p, dtype="<u4", offset=8 * words)) for p in part[3:]]
    zeros = [size - int(p.samples[-1]) for p in planes]
    return doc_ids, np.frombuffer(part[1], dtype="<i8"), WaveletMatrix(size, bits, planes, zeros)


def write_token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Encode every whole text, append ``end_id``, and write shards in ascending doc_id order.

    Returns the written table (part, shard, first_token, n_docs, n_tokens, file): shards are numbered within
    a part, parts hold ascending doc_id ranges, ``first_token`` counts the part's tokens before the shard.
    Null texts are empty (their end id remains); null doc_ids come first; rows with the same doc_id are kept, ordered
    by their texts' hash; extra columns are ignored; no rows give no shards.
    """
    small_batches(docs.sparkSession)
    schema = "part int, shard int, first_token long, n_docs long, n_tokens long, file binary"

    def encode(batches):
        encoder, part = Encoder.at(tokenizer_path), TaskContext.get().partitionId()
        end = little_endian(np.array([end_id]))
        shard, before = 0, 0
        doc_ids: list = []
        ids: list[bytes] = []
        held = 0

        def flush():
            flat = np.frombuffer(b"".join(ids), dtype="<u4")
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])])
            cols = [[part], [shard], [before], [len(doc_ids)], [len(flat)], [write_shard(doc_ids, offsets, flat)]]
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, kinds)], names=["part", "shard", "first_token", "n_docs", "n_tokens", "file"])

        for batch in slices(batches, "text", 6 << 20):
            for doc_id, text_ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                own = text_ids + end
                if doc_ids and held + len(own) // 4 > shard_tokens:
                    yield flush()
                    shard, before, doc_ids, ids, held = shard + 1, before + held, [], [], 0
                doc_ids.append(doc_id)
                ids.append(own)
                held += len(own) // 4
        if doc_ids:
            yield flush()

    ordered = narrowed(docs, doc_id="long", text="string").repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    return stored(ordered.mapInArrow(encode, schema), "tokens")


def read_token_files(shards: DataFrame) -> DataFrame:
    """Read the shards back: (doc_id, start, n_tokens, ids), ids as little-endian unsigned 32-bit.

    ``start`` counts the ids of all documents before; parts' totals are summed first, so only one row a part is ordered.
    """
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    begins = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("begin"))

    def decode(batches):
        for batch in batches:
            for base, data in zip(batch.column("base").to_pylist(), batch.column("file").to_pylist()):
                doc_ids, off, matrix = read_shard(data)
                ids, off = little_endian(matrix.all()), off.astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc_ids, type=pa.int64()), pa.array(base + off[:-1]), pa.array(np.diff(off)),
                    pa.array([ids[4 * a:4 * b] for a, b in zip(off[:-1], off[1:])], type=pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    based = shards.join(begins, "part").select((F.col("first_token") + F.col("begin")).alias("base"), "file")
    return based.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")

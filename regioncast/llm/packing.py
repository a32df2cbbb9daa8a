"""Best-fit packing of token documents into fixed-size training sequences.

`cut_documents` tokenizes whole texts and cuts only those that are longer than a
sequence; `pack_pieces` places pieces by best-fit decreasing.  A segment tree
over the remaining capacities finds the tightest open sequence in
logarithmic time per piece.

Pieces are dealt by a hash of their key and of their place in the table into groups of about `GROUP_PIECES`, or
`GROUP_BYTES` of token ids if that is less, so that no id, source, id range or length class meets in one task; each group is
packed by itself and can leave a sequence or two part-filled, which is far
below one in a thousand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regioncast.llm.common import groups_for, narrowed, slices, small_batches, stored
from regioncast.llm.tokens import Encoder, little_endian

#: Pieces that one task packs.
GROUP_PIECES = 60_000
#: Token ids, as bytes, that one task packs.
GROUP_BYTES = 16 << 20


class CapacityTree:
    """Open sequences by remaining capacity (0 to ``capacity``), as a segment tree over capacities.

    Each node counts the open sequences under it, so the tightest one that still
    holds a piece is found by one climb and one descent.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list] = [[] for _ in range(self.leaves)]

    def add(self, room: int, what) -> None:
        self.open[room].append(what)
        node, count = room + self.leaves, self.count
        while node:
            count[node] += 1
            node >>= 1

    def take(self, need: int):
        """Remove and return (room, what) of the smallest room >= need; None if there is none."""
        node, count = need + self.leaves, self.count
        if not count[node]:
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1  # nothing at or above `need` under this node's parent's right half
            if node == 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not count[node]:
                    node += 1
        room = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece.  Lengths are 0 to ``capacity``, in descending order."""
    seq, off = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    full = int(np.searchsorted(-lengths, -capacity, side="right"))
    seq[:full] = np.arange(full)
    tree, made = CapacityTree(capacity), full
    for i, n in enumerate(lengths[full:].tolist(), full):
        got = tree.take(n)
        if got is None:
            room, number, made = capacity, made, made + 1
        else:
            room, number = got
        seq[i], off[i] = number, capacity - room
        if room > n:
            tree.add(room - n, number)
    return seq, off


def cut_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids): each document's token ids, then ``end_id``, cut into pieces.

    Only documents longer than ``capacity`` are cut; all their pieces but the first are full.
    ``ids`` holds little-endian unsigned 32-bit ids.  Null and empty texts are the end id alone;
    rows with a null or repeated doc_id are documents like any other; extra columns are ignored.
    """
    small_batches(docs.sparkSession)

    def cut(batches):
        encoder, end = Encoder.at(tokenizer_path), little_endian(np.array([end_id]))
        for batch in slices(batches, "text"):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text"))):
                own = ids + end
                size = len(own) // 4
                pieces = -(-size // capacity)
                first = size - (pieces - 1) * capacity
                for p in range(pieces):
                    start, stop = (0 if p == 0 else first + (p - 1) * capacity), first + p * capacity
                    rows.append((doc_id, p, start, stop - start, own[4 * start:4 * stop]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))],
                names=["doc_id", "piece", "start", "length", "ids"])

    return narrowed(docs, doc_id="long", text="string").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids binary")


def pack_pieces(pieces: DataFrame, capacity: int = 2048, group_pieces: int = GROUP_PIECES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``pieces`` (doc_id, piece, length and any further columns, such as their ids) with sequence_id and offset added.

    Every sequence holds its pieces without gaps from offset 0 on.  Sequence ids are
    unique, not consecutive.  An empty input gives no rows.  Ties are ordered by doc_id, piece.  Repeated and null doc_ids are pieces
    like any other, and are spread over all groups.
    """
    # Row groups of the size of a group, and compressed well: ids are the bulk of what a task holds and of the disk.
    kept = stored(pieces.withColumn("place", F.monotonically_increasing_id()), "pieces",
                  **{"compression": "zstd", "parquet.block.size": str(group_bytes)})
    rows, tokens = kept.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    groups = max(groups_for(rows, group_pieces), groups_for(4 * tokens, group_bytes))
    schema = T.StructType([*pieces.schema.fields, *(T.StructField(n, T.LongType()) for n in ("sequence_id", "offset"))])

    def pack(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        rows = pa.Table.from_batches(parts)
        order = pc.sort_indices(rows, sort_keys=[("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("place", "ascending")]).to_numpy()
        seq, off = np.empty(len(order), dtype=np.int64), np.empty(len(order), dtype=np.int64)
        seq[order], off[order] = best_fit_decreasing(rows["length"].to_numpy()[order], capacity)
        seq += TaskContext.get().partitionId() << 32
        at = 0
        for b in parts:  # as they came: the ids are not copied
            to = at + b.num_rows
            columns = [c for c, name in zip(b.columns, b.schema.names) if name != "place"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(seq[at:to]), pa.array(off[at:to])], names=schema.names)
            at = to

    return kept.repartition(groups, F.xxhash64("doc_id", "piece", "place")).mapInArrow(pack, schema)


def packed(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids, sequence_id, offset, ids_crc32): all documents' tokens, cut into pieces and packed.

    A training sequence is the ``ids`` of one sequence_id's pieces by offset.  Null and empty texts are the end id alone, a text of any
    length is cut whole, rows with a null or repeated doc_id are documents like any other, extra columns are ignored, no rows give no rows.
    """
    return pack_pieces(cut_documents(docs, tokenizer_path, capacity, end_id), capacity).withColumn("ids_crc32", F.crc32("ids"))

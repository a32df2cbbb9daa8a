"""SimHash near-duplicates found through pivot distance tables.

A document's fingerprint is the bitwise majority of its word shingles'
64-bit hashes.  Distinct fingerprints that share enough equal blocks meet
(of `BLOCKS` blocks, two fingerprints with at most d different bits agree on at least
BLOCKS - d, so dealing each fingerprint by every choice of BLOCKS - d blocks misses no
pair).  A table of Hamming distances to reference fingerprints
(pivots) is computed for those that meet: by the triangle inequality a pair
whose distances to any pivot differ by more than d can't be a link, and only
the survivors are verified bit by bit.  The pivots alone can't take the dealing's
place: distances to a random pivot lie within a few bits of 32, so each one leaves over
half of all pairs.

Links are only needed up to reachability.  Fingerprints that differ inside one block of
d bits are links without a comparison, so a group is first joined by those, and
only fingerprints of different parts are compared.  Copies never multiply: everything here works on distinct
fingerprints.  Groups over `GROUP` fingerprints are dealt in pairs of slices, so no task holds more than two slices.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regioncast.llm.common import narrowed, slices, small_batches, stored, whole_row
from regioncast.llm.components import connected_components

BLOCKS = 6
PIVOTS = 16
#: Fingerprints of a group that are compared as one slice.
GROUP = 1024
SEED = 42


def shingle_hashes(text: bytes, width: int) -> list[int]:
    """XXH64 of each shingle of ``width`` words; of all words if there are fewer; none without a word."""
    from xxhash import xxh64_intdigest as digest

    words = text.lower().split()  # bytes: A-Z only, split at ASCII white space
    if len(words) <= width:
        return [digest(b" ".join(words), SEED)] if words else []
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    starts = (ends - np.fromiter(map(len, words), dtype=np.int64, count=len(words)) - 1)[:len(words) - width + 1].tolist()
    view = memoryview(line)
    return [digest(view[a:b], SEED) for a, b in zip(starts, (ends[width - 1:] - 1).tolist())]


def fingerprint(text: bytes, width: int) -> int:
    """Bitwise majority of the shingle hashes: a bit is set if it is in over half of them; 0 without a word."""
    total = np.zeros(64, dtype=np.int64)
    hashes = np.array(shingle_hashes(text, width), dtype="<u8")
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, shingle_words: int = 4) -> DataFrame:
    """(doc_id, text_key, fp): the whole text's 64-bit fingerprint as a signed long; null and wordless texts have 0."""
    small_batches(docs.sparkSession)

    def compute(batches):
        for batch in slices(batches, "text"):
            fps = np.array([fingerprint(x or b"", shingle_words) for x in batch.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(fps.view(np.int64))], names=["doc_id", "text_key", "fp"])

    keyed = narrowed(docs, doc_id="long", text="binary").withColumn("text_key", F.xxhash64("text"))
    return keyed.mapInArrow(compute, "doc_id long, text_key long, fp long")


def _block_masks(blocks: int, shared: int) -> list[int]:
    """Bit masks of every choice of ``shared`` of the ``blocks`` blocks."""
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    return [sum(block[k] for k in chosen) for chosen in combinations(range(blocks), shared)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivot_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distance of each fingerprint to each pivot."""
    return np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)


def _pivots(count: int) -> np.ndarray:
    return np.random.default_rng(64).integers(0, 1 << 64, size=count, dtype=np.uint64)


class _Parts:
    """Disjoint sets of positions."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            higher = self.up[self.up]
            if np.array_equal(higher, self.up):
                return self.up
            self.up = higher

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Union of each pair (a, b); repeated hooking of larger roots under smaller ones."""
        while len(a):
            roots = self.roots()
            ra, rb = roots[a], roots[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))


def group_links(fps: np.ndarray, max_bits: int, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star links (smallest member, member) of the parts that links of at most ``max_bits`` bits form.

    ``fps`` are distinct and ascending.
    """
    n, parts = len(fps), _Parts(len(fps))
    if max_bits:
        step = np.uint64((1 << max_bits) - 1)
        for shift in range(0, 64, max_bits):  # fingerprints equal but for one run of max_bits bits
            rest = fps & ~(step << np.uint64(shift))
            order = np.argsort(rest, kind="stable")
            same = np.flatnonzero(rest[order][1:] == rest[order][:-1])
            parts.join(order[same], order[same + 1])
    table = pivot_table(fps, pivots)
    order = np.argsort(table[:, 0], kind="stable")
    first = table[order, 0]
    until = np.searchsorted(first, first + max_bits, side="right")
    roots = parts.roots()
    for i in range(n):
        near = order[i + 1:until[i]]  # the first pivot's distances differ by max_bits at most
        near = near[roots[near] != roots[order[i]]]
        if not len(near):
            continue
        near = near[(np.abs(table[near] - table[order[i]]) <= max_bits).all(axis=1)]
        near = near[np.bitwise_count(fps[near] ^ fps[order[i]]) <= max_bits]
        if len(near):
            parts.join(np.full(len(near), order[i]), near)
            roots = parts.roots()
    at = np.flatnonzero(roots != np.arange(n))
    return fps[roots[at]], fps[at]


def fingerprint_links(fps: DataFrame, max_bits: int = 4, blocks: int = BLOCKS, pivots: int = PIVOTS, group: int = GROUP) -> DataFrame:
    """Links (a, b) of distinct fingerprints (column fp) whose components are those of all links of at most ``max_bits`` bits."""
    if blocks <= max_bits:
        raise ValueError("more blocks than differing bits are needed")
    masks = _block_masks(blocks, blocks - max_bits)
    keyed = fps.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks))).alias("choice", "part"))
    keyed = stored(keyed, "blocks")
    # Groups over `group` are cut into slices, and every two slices meet (salting by slice pairs).
    large = keyed.groupBy("choice", "part").count().where(F.col("count") > group).select("choice", "part", F.ceil(F.col("count") / group).cast("int").alias("cuts"))
    large = stored(large, "large")
    whole = keyed.join(large, ["choice", "part"], "left_anti").select("choice", "part", F.lit(0).alias("pair"), "fp")
    cut = keyed.join(large, ["choice", "part"]).withColumn("own", F.pmod(F.xxhash64("fp"), "cuts"))
    other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1))
    cut = cut.select("choice", "part", "own", "cuts", "fp", other.alias("other")).select(
        "choice", "part", (F.least("own", "other") * F.col("cuts") + F.greatest("own", "other")).cast("int").alias("pair"), "fp")
    refs = _pivots(pivots)

    def compare(batches):
        tail = None
        for batch in batches:
            rows = [np.asarray(batch.column(k).to_numpy(zero_copy_only=False)).astype(np.int64) for k in range(4)]
            if tail is not None:
                rows = [np.concatenate(x) for x in zip(tail, rows)]
            if not len(rows[0]):
                continue
            new = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0) | (np.diff(rows[2]) != 0)) + 1
            cuts = np.concatenate([[0], new])
            tail = [x[cuts[-1]:] for x in rows]  # the last group may go on in the next batch
            yield from found(rows[3], cuts)
        if tail is not None and len(tail[0]):
            yield from found(tail[3], np.array([0, len(tail[3])]))

    def found(fp: np.ndarray, cuts: np.ndarray):
        out = [group_links(np.sort(fp[a:b].view(np.uint64)), max_bits, refs) for a, b in zip(cuts[:-1], cuts[1:]) if b - a > 1]
        if out:
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    dealt = whole.union(cut).repartition("choice", "part", "pair").sortWithinPartitions("choice", "part", "pair")
    return dealt.mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, text_key, fp, component_id, first_key) for every document.

    component_id is the smallest doc_id reachable by links, first_key the text_key (hash of the text) of that document.  Null and wordless texts
    have fingerprint 0 and link like any other; rows with the same doc_id stay rows; a null doc_id counts as larger than any other, so
    component_id is null only where a whole component has none; extra columns are ignored; no rows give no rows.
    """
    docs_fp = stored(fingerprints(docs, shingle_words), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key"))
    fps = stored(docs_fp.groupBy("fp").agg(first.alias("first")), "distinct")
    roots = stored(connected_components(fingerprint_links(fps.select("fp"), max_bits)), "roots")
    rooted = stored(fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    ids = stored(rooted.groupBy("root").agg(F.min("first").alias("first")), "ids")
    named = rooted.select("fp", "root").join(ids, "root").select("fp", F.col("first.doc_id").alias("component_id"), F.col("first.text_key").alias("first_key"))
    return docs_fp.join(stored(named, "named"), "fp").select("doc_id", "text_key", "fp", "component_id", "first_key")


def first_of_each_group(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """The documents with one row of each near-duplicate group: that with the smallest doc_id.

    Of rows that share this doc_id the text with the smallest hash stays, and of rows with the same id and text one.  Null, empty and
    wordless texts are one group; a null doc_id counts as larger than any other; a text of any length is fingerprinted whole; columns may have any
    names; no rows give no rows.
    """
    groups = near_duplicates(docs, shingle_words, max_bits)
    keep = groups.select(F.coalesce("component_id", F.lit(0)).alias("id"), F.col("component_id").isNull().alias("no_id"), F.col("first_key").alias("key")).distinct()
    keyed = docs.select(whole_row(docs), F.coalesce(docs["doc_id"].cast("long"), F.lit(0)).alias("id"), docs["doc_id"].isNull().alias("no_id"),
                        F.xxhash64(docs["text"].cast("binary")).alias("key"))
    left = keyed.join(stored(keep, "keep"), ["id", "no_id", "key"], "left_semi")
    # Equal rows are reduced to one before they meet, however many there are.
    return left.groupBy("id", "no_id", "key").agg(F.first("row").alias("row")).select("row.*")

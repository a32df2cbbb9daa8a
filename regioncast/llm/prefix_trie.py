"""Prefix trie of conversations, with subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns.  Sequences are told apart by
two 64-bit hashes: each turn's SHA-256 is hashed with its place, and the
hashes of a sequence are combined by exclusive or, so a conversation of any
length is worked on in slices.

Subtree totals come from `subtree_totals`.  In each round leaves give their totals
to their parents (rake), and a chosen part of the nodes with one child leave the tree, their child
taking their place (compress).  No two neighbours leave in one round: a
node goes if its own coin shows heads and its parent's tails.  The number of rounds is
logarithmic in the tree's size, however deep it is.  Nodes that left get their totals back
by following the links to nodes that were raked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regioncast.llm.common import crc_of_id, narrowed, ship, stored

#: Width of the id ranges in which a node's members are joined to text before they meet.
BLOCK = 4096
KEY = ("depth", "x1", "x2")
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _lanes(digest: Column, depth: Column) -> tuple[Column, Column]:
    """Two hashes of a turn at a depth."""
    return F.xxhash64(digest, depth), F.xxhash64(depth, digest, F.lit(1))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, part, place, digest, chars): turns by (turn, null first; SHA-256 of role and text), in slices.

    Sorted by range, so the turns of one conversation, however many, lie in consecutive parts; ``place`` counts from 1 within the part.
    Equal turns can be split too, by the row number.  Rows with a null conv_id name no conversation and are left out; null roles and
    texts are empty.
    """
    rows = narrowed(conversations, conv_id="long", turn="long", role="string", text="string").where("conv_id IS NOT NULL")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)
    turns = rows.select("conv_id", "turn", F.unhex(F.sha2(named.cast("binary"), 256)).alias("digest"),
                        F.char_length(text).cast("long").alias("chars"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", "turn", "digest", "row"]
    ranged = stored(turns.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "turns")
    own = Window.partitionBy("conv_id", "part").orderBy("turn", "digest", "row")
    return ranged.select("conv_id", "part", F.row_number().over(own).cast("long").alias("place"), "digest", "chars")


def _before(part_sums: DataFrame, *sums: tuple[str, Column]) -> DataFrame:
    """Per (conv_id, part), the running aggregates of the parts before it."""
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return part_sums.select("*", *(F.coalesce(total.over(earlier), F.lit(0)).cast("long").alias(name) for name, total in sums))


def _xor(*columns: Column) -> Column:
    return reduce(lambda a, b: a.bitwiseXOR(b), columns)


def prefixes(conversations: DataFrame, family: int = 100, shares: int = 6) -> DataFrame:
    """Rows (conv_id, depth, x1, x2, p1, p2, chars, ends): every prefix of every conversation, the empty one too.

    ``x1, x2`` name the prefix, ``p1, p2`` the one that is a turn shorter; ``chars`` are code points of the last text, ``ends`` is true
    for the whole conversation.  Conversation c begins with the first h = crc32(c) mod ``shares`` turns of conversation
    c - c % ``family`` (all if there are fewer) in place of its own first h; with ``shares`` 1 conversations stay as they are.
    """
    turns = ordered_turns(conversations)
    sizes = _before(turns.groupBy("conv_id", "part").agg(F.count("*").alias("n")), ("offset", F.sum("n")))
    sizes = stored(sizes, "slices")
    first = turns.where((F.col("conv_id") % family == 0) & (F.col("place") < shares)).join(
        sizes.select("conv_id", "part", "offset"), ["conv_id", "part"]).withColumn("place", F.col("place") + F.col("offset"))
    first = first.where(F.col("place") < shares).groupBy(F.col("conv_id").alias("base")).agg(
        F.array_sort(F.collect_list(F.struct("place", "digest", "chars"))).alias("given"))  # at most shares - 1 turns
    convs = sizes.groupBy("conv_id").agg(F.sum("n").alias("own")).withColumn("h", crc_of_id(F.col("conv_id")) % shares)
    given = F.slice(F.coalesce("given", F.array().cast("array<struct<place:bigint,digest:binary,chars:bigint>>")), F.lit(1), F.col("h").cast("int"))
    convs = convs.join(first, F.col("conv_id") - F.col("conv_id") % family == F.col("base"), "left").select("conv_id", "h", "own", given.alias("given"))
    convs = convs.withColumn("shift", F.col("h") - F.size("given")).withColumn(
        "length", F.size("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    lanes = F.transform("given", lambda g: F.struct(*(x.alias(n) for n, x in zip(("a", "b"), _lanes(g["digest"], g["place"])))))
    convs = stored(convs.withColumn("lanes", lanes), "heads")

    def total(field: str, upto: Column) -> Column:
        return F.aggregate(F.slice("lanes", F.lit(1), upto.cast("int")), F.lit(0).cast("long"), lambda acc, x: acc.bitwiseXOR(x[field]))

    empty = convs.select("conv_id", F.lit(0).cast("long").alias("depth"), *(F.lit(0).cast("long").alias(c) for c in ("x1", "x2", "p1", "p2", "chars")),
                         (F.col("length") == 0).alias("ends"))
    heads = convs.select("conv_id", "lanes", "length", F.posexplode("given").alias("k", "g")).select(
        "conv_id", (F.col("k") + 1).cast("long").alias("depth"), total("a", F.col("k") + 1).alias("x1"), total("b", F.col("k") + 1).alias("x2"),
        total("a", F.col("k")).alias("p1"), total("b", F.col("k")).alias("p2"), F.col("g.chars").alias("chars"), (F.col("k") + 1 == F.col("length")).alias("ends"))

    slices = sizes.select("conv_id", "part", "offset").join(
        convs.select("conv_id", "h", "shift", "length", total("a", F.size("given")).alias("h1"), total("b", F.size("given")).alias("h2")), "conv_id")
    mine = turns.join(slices, ["conv_id", "part"]).where(F.col("place") + F.col("offset") > F.col("h"))
    mine = mine.withColumn("depth", F.col("place") + F.col("offset") - F.col("shift"))
    mine = mine.select("*", *(x.alias(n) for n, x in zip(("l1", "l2"), _lanes(F.col("digest"), F.col("depth")))))
    local = Window.partitionBy("conv_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    mine = stored(mine.select("conv_id", "part", "depth", "chars", "length", "h1", "h2", "l1", "l2",
                              *(F.bit_xor(c).over(local).alias(f"r{c[1]}") for c in ("l1", "l2"))), "prefixes")
    parts = _before(mine.groupBy("conv_id", "part").agg(F.bit_xor("l1").alias("s1"), F.bit_xor("l2").alias("s2")),
                    ("b1", F.bit_xor("s1")), ("b2", F.bit_xor("s2"))).select("conv_id", "part", "b1", "b2")
    tails = mine.join(parts, ["conv_id", "part"])
    for i in "12":
        tails = tails.withColumn(f"x{i}", _xor(F.col(f"h{i}"), F.col(f"b{i}"), F.col(f"r{i}"))).withColumn(f"p{i}", _xor(F.col(f"x{i}"), F.col(f"l{i}")))
    tails = tails.withColumn("ends", F.col("depth") == F.col("length"))
    return empty.unionByName(heads.select(*empty.columns)).unionByName(tails.select(*empty.columns))


def _member_hashes(ends: DataFrame) -> DataFrame:
    """Per node, the SHA-256 of its whole conversations' ids in ascending order, joined by commas.

    Ids are first joined within ranges of `BLOCK` ids; a node's ranges then pass through one hash in order, a row at a time, so that
    no node's members are ever held together.
    """
    ship(ends.sparkSession)
    block = F.floor(F.col("conv_id") / BLOCK)
    some = ends.groupBy(*KEY, block.cast("long").alias("block")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    some = some.select(*KEY, "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]):
        key, state = None, None
        for batch in batches:
            out = []
            for *this, ids in zip(*(batch.column(c).to_pylist() for c in (*KEY, "ids"))):
                if this != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = this, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _rows(out)
        if key is not None:
            yield _rows([(*key, state.hexdigest())])

    def _rows(rows):
        types = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=[*KEY, "ends_sha256"])

    dealt = some.repartition(*KEY).sortWithinPartitions(*KEY, "block")
    return dealt.mapInArrow(hashed, "depth long, x1 long, x2 long, ends_sha256 string")


def subtree_totals(nodes: DataFrame, values: tuple[str, ...]) -> DataFrame:
    """Rows (id, *values): for every node of a forest (id, parent, n_children, *values) the sums over its subtree.

    ``parent`` is null for a root, ``n_children`` counts the nodes that name this one as parent.  No nodes give no rows.
    """
    carry = [f"carry_{v}" for v in values]
    gone = [f"gone_{v}" for v in values]
    live = stored(nodes.select("id", "parent", F.col("n_children").alias("kids"), *values, *(F.lit(0).cast("long").alias(c) for c in carry),
                               F.lit(None).cast("long").alias("gone"), *(F.lit(0).cast("long").alias(g) for g in gone)), "tree")
    raked, links, rounds = [], [], 0
    while live.limit(1).count():
        links.append(live.where("gone IS NOT NULL").select(F.col("gone").alias("id"), F.col("id").alias("via"), *(F.col(g).alias(v) for g, v in zip(gone, values))))
        leaves = live.where("kids = 0")
        raked.append(leaves.select("id", *values))
        gains = leaves.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(
            F.count("*").alias("off"), *(F.sum(F.col(v) + F.col(c)).alias(f"gain_{v}") for v, c in zip(values, carry)))
        rest = live.where("kids > 0").drop("gone", *gone).join(gains, "id", "left")
        rest = rest.select("id", "parent", (F.col("kids") - F.coalesce("off", F.lit(0))).alias("kids"),
                           *((F.col(v) + F.coalesce(f"gain_{v}", F.lit(0))).alias(v) for v in values), *carry)

        def heads(node: str) -> Column:
            return F.xxhash64(F.col(node), F.lit(rounds)).bitwiseAND(1) == 1

        leaving = F.coalesce((F.col("kids") == 1) & heads("id") & ~heads("parent"), F.lit(False))
        out = rest.where(leaving).select(F.col("id").alias("gone"), F.col("parent").alias("above"), *(F.col(x).alias(f"_{x}") for x in (*values, *carry)))
        stay = rest.where(~leaving)
        under = F.coalesce(heads("parent"), F.lit(False))  # only these can have a parent that leaves
        moved = stay.where(under).join(out, F.col("parent") == F.col("gone"), "left").select(
            "id", F.coalesce("above", "parent").alias("parent"), "kids", *values,
            *((F.col(c) + F.coalesce(F.col(f"_{v}") + F.col(f"_{c}"), F.lit(0))).alias(c) for v, c in zip(values, carry)),
            "gone", *(F.coalesce(F.col(f"_{v}") + F.col(c), F.lit(0)).alias(g) for v, c, g in zip(values, carry, gone)))
        kept = stay.where(~under).select("*", F.lit(None).cast("long").alias("gone"), *(F.lit(0).cast("long").alias(g) for g in gone))
        live = stored(moved.unionByName(kept), "tree")
        rounds += 1
    if not rounds:
        return nodes.select("id", *values)
    known = stored(reduce(DataFrame.unionByName, raked), "raked")
    chain = reduce(DataFrame.unionByName, links)
    for _ in range((rounds - 1).bit_length()):  # a link leads to a node that left in a later round, or was raked
        chain = stored(chain, "links")
        onward = chain.select(F.col("id").alias("via"), F.col("via").alias("next"), *(F.col(v).alias(f"_{v}") for v in values))
        chain = chain.join(onward, "via", "left").select(
            "id", F.coalesce("next", "via").alias("via"), *((F.col(v) + F.coalesce(f"_{v}", F.lit(0))).alias(v) for v in values))
    found = chain.join(known.select(F.col("id").alias("via"), *(F.col(v).alias(f"_{v}") for v in values)), "via")
    return known.unionByName(found.select("id", *((F.col(v) + F.col(f"_{v}")).alias(v) for v in values)))


def prefix_trie(conversations: DataFrame, family: int = 100, shares: int = 6) -> DataFrame:
    """One row per node of the trie of all conversations (as `prefixes` rebuilds them): conv_id (smallest member), depth,
    parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Members of a node are the conversations that start with it; ``saved_tokens`` sums, over a node's subtree, (n_convs - 1) times the
    code points of the node's last text.  Rows without a conv_id are left out, null roles and texts are empty, turns of equal number
    are ordered by the SHA-256 of role and text, repeated rows are turns of their own; a text or a conversation may be of any length.
    Extra columns are ignored.  No conversations give no rows, not even a root.
    """
    rows = stored(prefixes(conversations, family, shares), "members")
    nodes = rows.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
                                   *(F.min(c).alias(c) for c in ("p1", "p2", "chars")))
    nodes = stored(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    up = nodes.select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"),
                      F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    # the root's children, perhaps most of the nodes, take its id without a join
    top = up.where("depth = 1").select("parent", "parent_conv_id")
    tree = (nodes.where("depth > 1").join(up.where("depth > 1"), ["depth", "p1", "p2"], "left")
            .unionByName(nodes.where("depth = 1").join(F.broadcast(top), F.lit(True)))
            .unionByName(nodes.where("depth = 0").select("*", F.lit(None).cast("long").alias("parent"), F.lit(None).cast("long").alias("parent_conv_id"))))
    tree = stored(tree.select("id", *KEY, "conv_id", "parent", "parent_conv_id", "n_convs", "chars"), "parents")
    children = tree.where("parent IS NOT NULL").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    tree = stored(tree.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie")
    totals = subtree_totals(tree.select("id", "parent", "n_children", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                                        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")), ("n_leaves", "saved_tokens"))
    whole = _member_hashes(rows.where("ends").select(*KEY, "conv_id"))
    return tree.join(totals, "id").join(whole, list(KEY), "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))

"""The trie of conversation prefixes, by digests of blocks of turns.

A conversation is a row of turn digests. Blocks of a fixed number of turns are digested,
and a prefix is known by the digest of all its turns, which is the XOR of hashes of turns
with their places. Conversations are grouped by the digest before a block and the digest
of the block. Where all that go on from a prefix share the next block, its turns are nodes
as they stand; only where siblings diverge are the turn boundaries inside looked at, once
for each different block and not for each conversation.

Sums over subtrees take as many rounds as the depth has binary digits: in each, a node
adds what the nodes below it at twice the former distance have gathered. Only nodes of
several conversations take part; a node of one conversation has one leaf and saves nothing.

No conversation, prefix or list of members is gathered in one task: places and running
digests are made in ranges of rows and carried from range to range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmill.llm.common import keep, ship, whole

#: Turns in a block.
BLOCK = 4
#: Bytes of a part of a list of members that is sent to be digested.
PART = 1 << 16

NODE = ["depth", "p1", "p2"]
_NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def running(
    rows: DataFrame,
    key: str,
    order: Sequence[Column],
    xors: Mapping[str, str] | None = None,
    place: str | None = None,
) -> DataFrame:
    """``rows`` with what the rows of the key before each row amount to, 0 for none.

    ``place`` names the number of those rows, ``xors`` the XOR of a column's values by
    name. Rows are dealt by ranges of key and order, so a key of any size spreads over
    tasks; what the ranges before hold of the key is added from one row a range and key.
    """
    xors = xors or {}
    ranged = rows.repartitionByRange(key, *order).withColumn("part", F.spark_partition_id())
    ranged = keep(ranged, "ranges")
    before = W.partitionBy(key).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    inside = W.partitionBy(key, "part").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    own = ranged.groupBy(key, "part").agg(
        F.count("*").alias("_n"), *(F.bit_xor(c).alias(f"_{n}") for n, c in xors.items())
    )
    zero = F.lit(0).cast("long")
    carried = own.select(
        key,
        "part",
        F.coalesce(F.sum("_n").over(before), zero).alias("_n"),
        *(F.coalesce(F.bit_xor(f"_{n}").over(before), zero).alias(f"_{n}") for n in xors),
    )
    added = {n: F.coalesce(F.bit_xor(c).over(inside), zero) for n, c in xors.items()}
    if place:
        added[place] = F.count("*").over(inside)
    joined = ranged.withColumns(added).join(carried, [key, "part"])
    whole_key = {n: F.col(n).bitwiseXOR(F.col(f"_{n}")) for n in xors}
    if place:
        whole_key[place] = F.col(place) + F.col("_n")
    return joined.withColumns(whole_key).drop("part", "_n", *(f"_{n}" for n in xors))


def numbered(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 0), turn (16 bytes of role and text) and points (code points of the text).

    Ordered by turn, null first; turns that tie by that digest. Rows without conv_id are no
    conversation. Null roles and texts are empty ones.
    """
    role, text = whole(F.col("role")), whole(F.col("text"))
    length = F.octet_length(role).cast("string")
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("at"),
        F.unhex(F.md5(F.concat(length, F.lit(":"), role, text).cast("binary"))).alias("turn"),
        F.char_length(text).cast("long").alias("points"),
    )
    order = [F.col("at").asc_nulls_first(), F.col("turn"), F.col("points")]
    return running(rows, "conv_id", order, place="place").drop("at")


def borrowed_prefixes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations (conv_id) and the rows (conv_id, place, turn, points) they are rebuilt to.

    Conversation c takes the first h turns of c - c % 100, h = crc32(c) % 6, for its own.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("long")
    base = F.col("conv_id") - F.col("conv_id") % 100
    convs = keep(sizes.select("conv_id", "n", taken.alias("h"), base.alias("base")), "conversations")
    of_base = turns.filter((F.col("conv_id") % 100 == 0) & (F.col("place") < 5))
    heads = of_base.select(F.col("conv_id").alias("base"), "place", "turn", "points")
    lent = convs.join(heads, "base").filter(F.col("place") < F.col("h"))
    lengths = convs.filter(F.col("conv_id") % 100 == 0).select("base", F.col("n").alias("base_n"))
    own = turns.withColumns({"h": taken, "base": base}).filter(F.col("place") >= F.col("h"))
    there = F.least("h", F.coalesce("base_n", F.lit(0)))
    rest = own.join(lengths, "base", "left").withColumn("place", F.col("place") - F.col("h") + there)
    columns = ["conv_id", "place", "turn", "points"]
    return convs.select("conv_id"), lent.select(columns).union(rest.select(columns))


def blocks_of(turns: DataFrame) -> DataFrame:
    """conv_id, block, b1 and b2 (its digest), turns (h1, h2, points in order), and s1, s2 before it."""
    h1 = F.xxhash64("place", "turn").alias("h1")
    h2 = F.xxhash64(F.lit(BLOCK), "turn", "place").alias("h2")
    rows = turns.select("conv_id", F.expr(f"place div {BLOCK}").alias("block"), "place", h1, h2, "points")
    blocks = rows.groupBy("conv_id", "block").agg(
        F.bit_xor("h1").alias("b1"),
        F.bit_xor("h2").alias("b2"),
        F.sort_array(F.collect_list(F.struct("place", "h1", "h2", "points"))).alias("turns"),
    )
    return running(blocks, "conv_id", [F.col("block")], {"s1": "b1", "s2": "b2"})


def _boundaries(groups: DataFrame) -> DataFrame:
    """One row for each turn of each group: the node that ends there, and its parent."""

    def upto(name: str, n: Column) -> Column:
        first = F.col(f"s{name[1]}")
        turns = F.slice("turns", F.lit(1), n)
        return F.aggregate(turns, first, lambda x, t: x.bitwiseXOR(t[name]))

    rows = groups.select("*", F.posexplode("turns").alias("i", "t"))
    return rows.select(
        (F.col("t.place") + 1).alias("depth"),
        upto("h1", F.col("i") + 1).alias("p1"),
        upto("h2", F.col("i") + 1).alias("p2"),
        upto("h1", F.col("i")).alias("q1"),
        upto("h2", F.col("i")).alias("q2"),
        "n_convs",
        "first",
        "t.points",
    )


def nodes_of(blocks: DataFrame) -> DataFrame:
    """depth, p1, p2, parent's q1 and q2, n_convs, first (smallest member) and points, below the root."""
    start, content = ["block", "s1", "s2"], ["b1", "b2"]
    groups = blocks.groupBy(*start, *content).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("first"), F.first("turns").alias("turns")
    )
    groups = keep(groups, "block-groups")
    alone = (
        groups.groupBy(*start)
        .agg(F.count("*").alias("n"), *(F.min(c).alias(c) for c in content))
        .filter(F.col("n") == 1)
        .select(*start, *content, F.lit(True).alias("alone"))
    )
    marked = groups.join(alone, [*start, *content], "left")
    shared = _boundaries(marked.filter(F.col("alone")).drop("alone"))
    split = _boundaries(marked.filter(F.col("alone").isNull()).drop("alone"))
    refined = split.groupBy(*NODE, "q1", "q2").agg(
        F.sum("n_convs").alias("n_convs"), F.min("first").alias("first"), F.min("points").alias("points")
    )
    return shared.unionByName(refined)


def _subtrees(shared: DataFrame) -> DataFrame:
    """``shared`` (depth, p1, p2, q1, q2, leaves, saved) with leaves and saved summed over subtrees."""
    deepest = shared.agg(F.max("depth")).first()[0] or 0
    step = 1
    state = keep(shared, "subtrees")
    while step <= deepest:
        above = state.filter(F.col("depth") >= step)
        gathered = above.groupBy((F.col("depth") - step).alias("depth"), "q1", "q2").agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        gathered = gathered.withColumnsRenamed({"q1": "p1", "q2": "p2"})
        # The ancestor at twice the distance: that of the ancestor, where there is one.
        there = state.filter(F.col("depth") >= step).select(
            (F.col("depth") + step).alias("depth"),
            F.col("p1").alias("q1"),
            F.col("p2").alias("q2"),
            F.col("q1").alias("r1"),
            F.col("q2").alias("r2"),
        )
        state = keep(
            state.join(gathered, NODE, "left")
            .join(there, ["depth", "q1", "q2"], "left")
            .select(
                *NODE,
                F.col("r1").alias("q1"),
                F.col("r2").alias("q2"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "subtrees",
        )
        step *= 2
    return state.select(*NODE, "leaves", "saved")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(depth, p1, p2, first, part) from sorted (depth, p1, p2, conv_id): ids joined by commas."""
    node, first, ids, size = None, None, [], 0

    def flush() -> pa.RecordBatch:
        kinds = [pa.int64()] * 4 + [pa.string()]
        values = [*node, first, ",".join(ids)]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [*NODE, "first", "part"]
        )

    done: list[pa.RecordBatch] = []
    for batch in batches:
        for *here, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if here != node or size >= PART:
                if ids:
                    done.append(flush())
                node, first, ids, size = here, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
            done = []
    if ids:
        yield flush()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(depth, p1, p2, ends_sha256) from parts that come sorted by node and first id."""
    node, digest = None, None
    for batch in batches:
        out: list[list] = []
        for *here, _, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if here == node:
                digest.update(b",")
            else:
                if node is not None:
                    out.append([*node, digest.hexdigest()])
                node, digest = here, hashlib.sha256()
            digest.update(part.encode())
        yield _digest_rows(out)
    if node is not None:
        yield _digest_rows([[*node, digest.hexdigest()]])


def _digest_rows(rows: list[list]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [*NODE, "ends_sha256"]
    )


def ends_of(ends: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256) of the rows (conv_id, depth, p1, p2).

    The ids of a node are joined in ranges, and the joined parts digested one after the
    other: a node where a third of all conversations end is a few long parts.
    """
    place = [*NODE, "conv_id"]
    ranged = ends.select(*place).repartitionByRange(*place).sortWithinPartitions(*place)
    parts = ranged.mapInArrow(_parts, "depth long, p1 long, p2 long, first long, part string")
    dealt = parts.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return dealt.mapInArrow(_digests, "depth long, p1 long, p2 long, ends_sha256 string")


def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie of the conversations ``convs`` (conv_id, each once) with ``turns``.

    ``turns`` has conv_id, place (from 0 without a gap), turn (a digest) and points; a
    conversation may have none. Columns: conv_id (smallest member), depth, parent_conv_id
    (null for the root), n_convs, n_children, n_leaves, saved_tokens and ends_sha256.
    Without conversations there is no node.
    """
    ship(convs.sparkSession)
    blocks = keep(blocks_of(turns), "blocks")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("first"))
    none = F.lit(0).cast("long")
    root = root.filter(F.col("n_convs") > 0).select(
        *(none.alias(c) for c in NODE),
        *(F.lit(None).cast("long").alias(c) for c in ("q1", "q2")),
        "n_convs",
        "first",
        none.alias("points"),
    )
    nodes = keep(root.unionByName(nodes_of(blocks)), "nodes")

    up = nodes.filter(F.col("depth") > 0).withColumn("depth", F.col("depth") - 1)
    children = up.groupBy("depth", F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
        F.count("*").alias("n_children"), F.count_if(F.col("n_convs") == 1).alias("single")
    )
    children = keep(children, "children")
    several = (F.col("n_convs") > 1) | (F.col("depth") == 0)
    shared = nodes.filter(several).join(children, NODE, "left")
    leaves = F.coalesce("single", F.lit(0)) + F.when(F.col("n_children").isNull(), 1).otherwise(0)
    saved = F.greatest(F.col("n_convs") - 1, F.lit(0)) * F.col("points")
    sums = _subtrees(shared.select(*NODE, "q1", "q2", leaves.alias("leaves"), saved.alias("saved")))

    length = blocks.groupBy("conv_id").agg(
        F.sum(F.size("turns")).alias("depth"), F.bit_xor("b1").alias("p1"), F.bit_xor("b2").alias("p2")
    )
    ends = convs.select("conv_id").join(length, "conv_id", "left")
    ends = ends_of(ends.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in NODE)))

    # A node whose parent is of one conversation too has the same one.
    parents = nodes.filter(several).select(
        (F.col("depth") + 1).alias("depth"),
        F.col("p1").alias("q1"),
        F.col("p2").alias("q2"),
        F.col("first").alias("of_parent"),
    )
    parent = F.when(F.col("depth") > 0, F.coalesce("of_parent", "first"))
    return (
        nodes.join(children, NODE, "left")
        .join(sums, NODE, "left")
        .join(ends, NODE, "left")
        .join(parents, ["depth", "q1", "q2"], "left")
        .select(
            F.col("first").alias("conv_id"),
            "depth",
            parent.alias("parent_conv_id"),
            "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
            F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(_NO_MEMBERS)).alias("ends_sha256"),
        )
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of all conversations, each rebuilt on the first turns of its hundred's first.

    See ``trie`` for the columns. Turns are ordered by turn, null first, ties by the digest
    of role and text, so repeated rows are repeated turns; null roles and texts are empty.
    Rows without conv_id are left out, and columns other than conv_id, turn, role and text
    are not read.
    """
    rows = keep(numbered(conversations), "turns")
    convs, turns = borrowed_prefixes(rows)
    return trie(convs, keep(turns, "rebuilt"))

"""SimHash near-duplicates through an embedding of fingerprints into bit counts.

Each half of a 64-bit fingerprint is cut into segments of two bits, and once more into
segments shifted by one bit. The bit counts of the segments (0 to 2) are the half's place
in two grids. A changed bit moves a place by one in each grid, so halves that differ in
few bits lie at a Manhattan distance of at most as many in either. A range join on the
grids finds every pair, and the few it finds are compared bit by bit.

A distance of at most 4 over both halves is at most 2 in the first half or at most 1 in
the second. A fingerprint visits its own cell and the cells one bit away: two within 2
of each other in the first half meet in a cell between them, two within 1 in the second
half meet where one of them is at home.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmill.llm.common import keep, ship, whole
from tripmill.llm.components import components

SHINGLE = 4
SEED = 42
MAX_DISTANCE = 4
#: Members of a cell that one task compares; a fuller cell is split into pairs of blocks.
BLOCK = 4096
#: Cells up to this size are compared by shifting, fuller ones node by node.
_FEW = 8
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_PLACE = np.uint64(1) << np.arange(63, -1, -1, dtype=np.uint64)
_SEGMENT_BITS = 0x5555_5555
_HALF = 0xFFFF_FFFF


def shingle_hashes(text: str, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """The hashes of all runs of ``size`` words; fewer words are one run, none has none."""
    words = text.encode().translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined, seed)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    spans = zip(starts, ends[size - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(starts))


def fingerprint(text: str | None) -> int:
    """Bit i is set if it is in more than half of the hashes; 0 without words. Signed."""
    hashes = shingle_hashes(text or "")
    if not len(hashes):
        return 0
    count = np.zeros(64, np.int64)
    for a in range(0, len(hashes), 1 << 16):  # a very long text takes no more memory
        part = hashes[a : a + (1 << 16)].astype(">u8").view(np.uint8)
        count += np.unpackbits(part).reshape(-1, 64).sum(axis=0, dtype=np.int32)
    value = _PLACE[2 * count > len(hashes)].sum(dtype=np.uint64)
    return int(value.astype(np.int64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row, texts taken whole."""
    ship(docs.sparkSession)

    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py()) for t in texts], pa.int64())

    return docs.select("doc_id", of("text").alias("fp"))


def counts(bits: Column) -> Column:
    """The bit counts of the 16 segments of 32 bits, two bits each, packed into one long."""
    mask = F.lit(_SEGMENT_BITS)
    return bits.bitwiseAND(mask) + F.shiftright(bits, 1).bitwiseAND(mask)


def cell(bits: Column, half: Column) -> Column:
    """The cell of 32 bits in both grids of a half, as one hash."""
    turned = F.shiftright(bits, 1) + F.shiftleft(bits.bitwiseAND(F.lit(1)), 31)
    return F.xxhash64(half, counts(bits), counts(turned))


def visits(fps: DataFrame) -> DataFrame:
    """(half, cell, home, fp): the own cell in each half of the grids, and all cells one bit away."""
    halves = F.array(F.col("fp").bitwiseAND(F.lit(_HALF)), F.shiftrightunsigned("fp", 32))
    flips = F.array(*(F.lit(f).cast("long") for f in [0, *(1 << i for i in range(32))]))
    placed = fps.select("fp", F.posexplode(halves).alias("half", "bits")).select(
        "fp", "half", "bits", F.explode(flips).alias("flip")
    )
    return placed.select(
        "half",
        cell(F.col("bits").bitwiseXOR(F.col("flip")), F.col("half")).alias("cell"),
        (F.col("flip") == 0).alias("home"),
        "fp",
    )


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def _star(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint that others are linked to, directly or over others, the lowest of them."""
    low, high, left = [], [], np.unique(fps)
    while len(left):
        queue, members, left = [left[0]], [], left[1:]
        while queue:
            node = queue.pop()
            members.append(node)
            near = _distance(left, node) <= MAX_DISTANCE
            queue.extend(left[near])
            left = left[~near]
        if len(members) > 1:
            lowest = min(members)
            high.append(np.array([m for m in members if m != lowest]))
            low.append(np.full(len(members) - 1, lowest))
    none = np.empty(0, np.int64)
    return np.concatenate([none, *low]), np.concatenate([none, *high])


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within cells from rows (part, fp) that come sorted by part."""

    def links(part: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        bounds = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        sizes = np.diff(np.append(bounds, len(part)))
        u, v = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        few = np.repeat(sizes <= _FEW, sizes)
        p, f = part[few], fp[few]
        for d in range(1, _FEW):
            if len(p) <= d:
                break
            near = (p[d:] == p[:-d]) & (_distance(f[d:], f[:-d]) <= MAX_DISTANCE)
            u.append(f[:-d][near])
            v.append(f[d:][near])
        for i in np.flatnonzero(sizes > _FEW).tolist():
            low, high = _star(fp[bounds[i] : bounds[i] + sizes[i]])
            u.append(low)
            v.append(high)
        found = np.unique(np.stack([np.concatenate(u), np.concatenate(v)]), axis=1)
        found = found[:, found[0] != found[1]]
        return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], ["u", "v"])

    part, fp = np.empty(0, np.int64), np.empty(0, np.int64)
    for batch in batches:
        part = np.append(part, batch.column(0).to_numpy())
        fp = np.append(fp, batch.column(1).to_numpy())
        whole = np.searchsorted(part, part[-1]) if len(part) else 0
        if whole:  # the last cell may go on in the next batch
            yield links(part[:whole], fp[:whole])
            part, fp = part[whole:], fp[whole:]
    if len(part):
        yield links(part, fp)


def linked(fps: DataFrame) -> DataFrame:
    """(u, v) such that exactly the fingerprints joined by links of few bits are connected.

    ``fps`` holds distinct fingerprints. Cells with one visitor end after the first
    exchange. A cell past ``BLOCK`` members is split into blocks, and every two blocks
    meet in a task of their own, so no task holds an unbounded group; it returns a star
    for each set of linked fingerprints and not the pairs.
    """
    ship(fps.sparkSession)
    members = W.partitionBy("cell")
    met = (
        visits(fps)
        .select(
            "cell",
            "fp",
            F.col("half"),
            F.count("*").over(members).alias("n"),
            F.count_if(F.col("home")).over(members).alias("homes"),
        )
        # In the second half only a cell where someone is at home can link.
        .filter((F.col("n") > 1) & ((F.col("half") == 0) | (F.col("homes") > 0)))
    )
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    parts = (
        met.select("cell", "fp", blocks.alias("blocks"), own.alias("own"))
        .select("cell", "fp", "own", F.explode(others).alias("other"))
        .select(
            F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("part"), "fp"
        )
    )
    return (
        parts.repartition("part").sortWithinPartitions("part").mapInArrow(_cells, "u long, v long")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable over links) of every row.

    Null and empty texts have the fingerprint 0, which links like any other. Rows with
    equal fingerprints are one node, however many they are. A row without doc_id has the
    smallest doc_id of its component, or null if none has one. Other columns are not read.
    """
    rows = keep(fingerprints(docs), "fingerprints")
    nodes = keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    rooted = _rooted(nodes)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def _rooted(nodes: DataFrame) -> DataFrame:
    """``nodes`` (distinct fp) with root, the lowest fingerprint of their component."""
    roots = components(linked(nodes.select("fp"))).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    return nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` without all but the first document of each component.

    All columns as they are. A document is a doc_id with a text; the first one has the
    smallest doc_id, and rows without doc_id come after all others. So rows of one doc_id
    with unlike texts all stay, as do unlike texts without doc_id. Of rows alike in
    doc_id and text one stays.
    """
    text_hash = F.xxhash64(whole(F.col("text")))
    wide = docs.select(F.col("doc_id").alias("id"), text_hash.alias("text_hash"), F.struct("*").alias("d"))
    narrow = docs.select(F.struct("doc_id", text_hash.alias("text_hash")).alias("doc_id"), "text")
    rows = keep(fingerprints(narrow).select("doc_id.*", "fp"), "fingerprints")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    nodes = keep(rows.groupBy("fp").agg(F.min(place).alias("first")), "nodes")
    first = _rooted(nodes).groupBy("root").agg(F.min("first").alias("first"))
    stay = first.select(F.col("first.doc_id").alias("s_id"), F.col("first.text_hash").alias("s_hash"))
    same = F.col("id").eqNullSafe(F.col("s_id")) & (F.col("text_hash") == F.col("s_hash"))
    return wide.join(stay, same, "left_semi").dropDuplicates(["id", "text_hash"]).select("d.*")

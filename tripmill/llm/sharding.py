"""Shards by fixed virtual slots.

A record hashes into one of ``n_slots`` virtual slots, for good. Which shard owns a
slot says a small versioned map. Bytes are aggregated by slot, and rebalancing or
growing edits the map: a new version in which some slots have another owner, so only
the rows of those slots move.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmill.llm.common import keep, whole
from tripmill.sources.tables import read_if_exists

N_SLOTS = 8192
#: Equal rows that are laid out by one task.
COPIES = 1 << 12


@dataclass(frozen=True)
class SlotMap:
    """The owner of every slot. At most some thousand entries, whatever the corpus."""

    version: int
    n_shards: int
    owners: tuple[int, ...]

    @staticmethod
    def initial(n_shards: int, n_slots: int = N_SLOTS) -> SlotMap:
        """Version 1: slots dealt out in turn."""
        return SlotMap(1, n_shards, tuple(s % n_shards for s in range(n_slots)))

    def loads(self, slot_bytes: Sequence[int]) -> list[int]:
        total = [0] * self.n_shards
        for slot, owner in enumerate(self.owners):
            total[owner] += slot_bytes[slot]
        return total

    def rebalanced(self, slot_bytes: Sequence[int]) -> SlotMap:
        """The next version, in which slots went from the fullest to the emptiest shard.

        Each step moves the slot, or swaps the two slots, that best halves the gap
        between the two shards; it ends when no step narrows it.
        """
        owners, load = list(self.owners), self.loads(slot_bytes)
        own: list[list[tuple[int, int]]] = [[] for _ in range(self.n_shards)]
        for slot, owner in enumerate(owners):
            insort(own[owner], (slot_bytes[slot], slot))

        def give(slot: int, source: int, target: int) -> None:
            entry = (slot_bytes[slot], slot)
            own[source].pop(bisect_left(own[source], entry))
            insort(own[target], entry)
            owners[slot] = target
            load[source] -= slot_bytes[slot]
            load[target] += slot_bytes[slot]

        for _ in range(len(owners)):
            full = max(range(self.n_shards), key=load.__getitem__)
            low = min(range(self.n_shards), key=load.__getitem__)
            gap = load[full] - load[low]
            best = (gap, -1, -1)
            for taken, back in [(0, -1), *own[low]]:
                at = bisect_left(own[full], (taken + gap // 2, -1))
                for size, slot in own[full][max(0, at - 1) : at + 1]:
                    if size > taken:
                        best = min(best, (abs(gap - 2 * (size - taken)), slot, back))
                if back == -1 and best[0] <= gap // 16:
                    break
            if best[0] >= gap:
                break
            give(best[1], full, low)
            if best[2] != -1:
                give(best[2], low, full)
        return SlotMap(self.version + 1, self.n_shards, tuple(owners))

    def grown(self, slot_bytes: Sequence[int]) -> SlotMap:
        """The next version with one more shard, which takes its share from the fullest ones."""
        owners, load = list(self.owners), [*self.loads(slot_bytes), 0]
        order = sorted(range(len(owners)), key=lambda s: (-slot_bytes[s], s))
        share = sum(load) // len(load)
        own = {k: [s for s in order if owners[s] == k] for k in range(self.n_shards)}
        while any(own.values()):
            full = max((k for k in own if own[k]), key=lambda k: (load[k], -k))
            slot = own[full].pop(0)
            if load[-1] + slot_bytes[slot] <= share:
                owners[slot] = self.n_shards
                load[full] -= slot_bytes[slot]
                load[-1] += slot_bytes[slot]
        return SlotMap(self.version + 1, self.n_shards + 1, tuple(owners))

    def frame(self, spark: SparkSession) -> DataFrame:
        """Columns map_version, n_shards, virtual_slot, shard."""
        rows = [(self.version, self.n_shards, s, k) for s, k in enumerate(self.owners)]
        return spark.createDataFrame(
            rows, "map_version int, n_shards int, virtual_slot int, shard int"
        )


def stored_versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of the stored map in order; none where there is no map."""
    stored = read_if_exists(spark, path)
    if stored is None:
        return []
    return sorted(r[0] for r in stored.select("map_version").distinct().collect())


def save_map(spark: SparkSession, slot_map: SlotMap, path: str) -> None:
    """Add one version to the stored map; versions are never written twice."""
    if slot_map.version in stored_versions(spark, path):
        raise ValueError(f"version {slot_map.version} is stored at {path} already")
    slot_map.frame(spark).coalesce(1).write.mode("append").partitionBy("map_version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """The newest, or the given, stored version."""
    stored = spark.read.parquet(path)
    if version is None:
        version = stored.agg(F.max("map_version")).first()[0]
    rows = stored.filter(F.col("map_version") == version).orderBy("virtual_slot").collect()
    return SlotMap(version, rows[0]["n_shards"], tuple(r["shard"] for r in rows))


def sized(docs: DataFrame, n_slots: int = N_SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and virtual_slot of every row.

    The slot follows from doc_id, text and, for equal rows, their number: neither an id
    nor a row that a third of the table holds is one slot. Equal rows are counted and
    laid out again in blocks, each by a task. A null text has no bytes, as the empty one.
    Other columns are not read, so their names do not matter.
    """
    text = whole(F.col("text"))
    rows = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    equal = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    few = equal.filter(F.col("n") <= COPIES).withColumn("block", F.lit(0).cast("long"))
    many = equal.filter(F.col("n") > COPIES).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}")))
    )
    start = F.col("block") * COPIES
    last = F.least(start + COPIES, F.col("n")) - 1
    numbered = few.union(many.repartition("doc_id", "text_crc32", "block")).select(
        *rows.columns, F.explode(F.sequence(start, last)).alias("copy")
    )
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text_crc32", "size", "copy")
    return numbered.withColumn("virtual_slot", F.pmod(key, F.lit(n_slots)).cast("int")).drop("copy")


def slot_totals(rows: DataFrame, n_slots: int = N_SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows by slot: ``n_slots`` numbers each, combined before the exchange."""
    size, count = [0] * n_slots, [0] * n_slots
    found = rows.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    for row in found.collect():
        size[row["virtual_slot"]], count[row["virtual_slot"]] = row["b"], row["n"]
    return size, count


def number_rows(rows: DataFrame, slot_map: SlotMap, slot_rows: Sequence[int]) -> DataFrame:
    """``rows`` with shard, and slot: the place in the shard, from 0 without a gap.

    Rows are numbered within their virtual slot, thousands of groups, and shifted by the
    rows of the shard's slots before it; no shard is ever sorted as one group. Rows alike
    in doc_id, size and text are interchangeable.
    """
    before, start = [0] * slot_map.n_shards, []
    for slot, owner in enumerate(slot_map.owners):
        start.append((slot, owner, before[owner], slot_map.version))
        before[owner] += slot_rows[slot]
    owners = rows.sparkSession.createDataFrame(
        start, "virtual_slot int, shard int, first long, map_version int"
    )
    place = F.row_number().over(
        W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    )
    return (
        rows.withColumn("place", place - 1)
        .join(F.broadcast(owners), "virtual_slot")  # n_slots rows, fixed
        .withColumn("slot", F.col("first") + F.col("place"))
        .drop("first", "place")
    )


def _stored_start(spark: SparkSession, n_shards: int, n_slots: int, path: str) -> SlotMap:
    """The newest stored map, a first one where there is none."""
    if not stored_versions(spark, path):
        save_map(spark, SlotMap.initial(n_shards, n_slots), path)
    start = load_map(spark, path)
    if len(start.owners) != n_slots or start.n_shards > n_shards:
        raise ValueError(f"{path} has {len(start.owners)} slots in {start.n_shards} shards")
    return start


def shard_by_bytes(
    docs: DataFrame, n_shards: int, n_slots: int = N_SLOTS, map_path: str | None = None
) -> DataFrame:
    """Every row with its shard under a map rebalanced by bytes; an empty table gives no rows.

    Versions are stored at ``map_path``: the newest stored one is edited, or a first one
    made. A stored map of fewer shards grows, shard by shard; one of more shards, or of
    another number of slots, is an error. The text is read once.
    """
    spark, rows = docs.sparkSession, keep(sized(docs, n_slots), "sized")
    slot_bytes, slot_rows = slot_totals(rows, n_slots)
    if map_path is None:
        edited = SlotMap.initial(n_shards, n_slots).rebalanced(slot_bytes)
        return number_rows(rows, edited, slot_rows)
    edited = _stored_start(spark, n_shards, n_slots, map_path)
    while edited.n_shards < n_shards:
        edited = edited.grown(slot_bytes)
        save_map(spark, edited, map_path)
    edited = edited.rebalanced(slot_bytes)
    save_map(spark, edited, map_path)
    return number_rows(rows, edited, slot_rows)

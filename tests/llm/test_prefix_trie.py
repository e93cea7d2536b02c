"""The prefix trie against a dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tripmill.llm import prefix_trie
from tripmill.llm.common import table
from tripmill.llm.queries import REGISTERED


def _slow_trie(rows):
    """Rows (conv_id, turn, role, text) without ties of unlike turns."""
    own = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0)):
        if conv is not None:
            own[conv].append((role or "", text or ""))
    built = {}
    for conv in list(own):
        h = zlib.crc32(str(conv).encode()) % 6
        built[conv] = tuple(own.get(conv - conv % 100, [])[:h] + own[conv][h:])
    members, children = defaultdict(list), defaultdict(set)
    for conv, turns in built.items():
        for depth in range(len(turns) + 1):
            members[turns[:depth]].append(conv)
            if depth:
                children[turns[: depth - 1]].add(turns[:depth])
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        here = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        leaves[node] += not children[node]
        saved[node] += here
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if built[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        numbers = (len(convs), len(children[node]), leaves[node], saved[node])
        out.append((min(convs), len(node), parent, *numbers, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def _table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def _conversations():
    rng = random.Random(4)
    rows = []
    for conv in [*range(120), *range(300, 330), 700, 703, 4005]:
        length = rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 14])
        for turn in range(length):
            text = rng.choice(["a", "a", "a", "bé🙂", ""]) if turn < 9 else f"{rng.random()}"
            rows.append((conv, turn, ["user", "assistant"][turn % 2], text))
    for conv in (500, 501, 512, 590):  # long copies
        rows += [(conv, t, "user", f"turn {t % 7}") for t in range(150)]
    rows += [(800, None, None, None), (800, 3, "user", "x"), (800, 3, "user", "x"), (None, 1, "user", "lost")]
    rows += [(900, -1, None, "x"), (901, 0, "", "x"), (901, 1, "user", None)]
    return rows


@pytest.mark.parametrize("partitions", [3, 40])
def test_trie_equals_the_dictionary(spark, partitions):
    rows = _conversations()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        wide = _table(spark, rows).withColumns({"place": F.lit("x"), "depth": F.lit(0)})
        got = prefix_trie.prefix_trie(wide).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, got), key=str) == _slow_trie(rows)


def test_a_key_over_many_ranges_is_numbered_through(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(4000).selectExpr("if(id % 3 = 0, id, 1) as k", "id * 7 % 4001 as v")
        ranged = rows.repartitionByRange("k", "v").groupBy(F.spark_partition_id()).agg(F.count_if(F.col("k") == 1).alias("n"))
        assert ranged.filter("n > 0").count() > 4
        got = prefix_trie.running(rows, "k", [F.col("v")], {"x": "v"}, "place").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == 4000
    own, xor = defaultdict(int), defaultdict(int)
    for row in sorted(got, key=lambda r: (r["k"], r["v"])):
        assert (row["place"], row["x"]) == (own[row["k"]], xor[row["k"]])
        own[row["k"]] += 1
        xor[row["k"]] ^= row["v"]


def test_many_ends_in_one_node_are_joined_in_order(spark, monkeypatch):
    ids = [7 * i % 5003 for i in range(5003)]
    ends = spark.createDataFrame([(i, 2, -5, 9) for i in ids] + [(1, 0, 0, 0)], "conv_id long, depth long, p1 long, p2 long")
    got = {r["depth"]: r["ends_sha256"] for r in prefix_trie.ends_of(ends).collect()}
    joined = ",".join(map(str, sorted(ids)))
    assert got == {2: hashlib.sha256(joined.encode()).hexdigest(), 0: hashlib.sha256(b"1").hexdigest()}
    monkeypatch.setattr(prefix_trie, "PART", 10)
    import pyarrow as pa

    rows = pa.RecordBatch.from_arrays([pa.array([v] * 9) for v in (2, 3, 4)] + [pa.array(range(9))], [*prefix_trie.NODE, "c"])
    parts = list(prefix_trie._parts(iter([rows])))
    assert sum(p.num_rows for p in parts) == 2
    (digest,) = [d for d in prefix_trie._digests(iter(parts)) if d.num_rows]
    assert digest.column(3).to_pylist() == [hashlib.sha256(b"0,1,2,3,4,5,6,7,8").hexdigest()]


def test_conversations_without_turns(spark):
    # crc32("1") % 6 = 3 and there is no conversation 0: what is left of 1 has no turn.
    assert zlib.crc32(b"1") % 6 == 3
    rows = [(1, 0, "user", "x")]
    got = list(map(tuple, prefix_trie.prefix_trie(_table(spark, rows)).collect()))
    assert got == _slow_trie(rows) and got[0][:2] == (1, 0) and len(got) == 1
    assert prefix_trie.prefix_trie(_table(spark, rows).limit(0)).collect() == []


def test_tied_turns_have_one_order(spark):
    rows = [(200, 1, "user", t) for t in "edcba"] + [(c, t, "user", "z") for c in (201, 202) for t in range(9)]
    a = prefix_trie.prefix_trie(_table(spark, rows)).collect()
    b = prefix_trie.prefix_trie(_table(spark, rows[::-1])).collect()
    assert sorted(a, key=str) == sorted(b, key=str)


def test_registered_trie(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = REGISTERED["op12_prefix_trie"](spark, sf).collect()
    assert sorted(map(tuple, got), key=str) == _slow_trie(rows)

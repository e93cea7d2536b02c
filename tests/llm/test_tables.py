"""Shards, top-k, WARC records and the pipeline."""

import base64
import hashlib
import html.parser
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripmill.llm import decontaminate, sharding, similar, topk, warc
from tripmill.llm.common import table
from tripmill.llm.queries import REGISTERED
from tripmill.session import scratch_path

# ---- shards ----


def test_shards_are_near_equal_and_numbered_without_gaps(spark):
    sf = "/root/testdata/sf0.01"
    docs = {d["doc_id"]: d["text"] or "" for d in table(spark, sf, "documents").collect()}
    rows = REGISTERED["op10_virtual_slots"](spark, sf).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(list(docs))
    load = Counter()
    for r in rows:
        data = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
        load[r["shard"]] += r["size"]
    assert set(load) == set(range(8))
    assert max(load.values()) - min(load.values()) <= 0.005 * sum(load.values()) / 8
    for shard in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(
            range(sum(r["shard"] == shard for r in rows))
        )


def test_rows_without_id_or_text_and_repeated_rows(spark):
    rows = [(1, "a", 7), (1, "a", 7), (1, "b", 7), (None, "x", 7), (None, None, 7), (2, None, 7), (3, "é" * 9999, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    got = sharding.shard_by_bytes(docs, 3, n_slots=16).collect()
    assert len(got) == 7 and sorted(r["size"] for r in got if r["doc_id"] == 1) == [2, 2, 2]
    assert sorted(r["size"] for r in got) == [1, 1, 2, 2, 2, 2, 19_999]
    for shard in range(3):
        own = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert own == list(range(len(own)))
    assert sharding.shard_by_bytes(docs.limit(0), 3, n_slots=16).collect() == []


@pytest.mark.parametrize("same_text", [False, True])
def test_an_id_with_a_third_of_all_rows_fills_no_shard(spark, monkeypatch, same_text):
    monkeypatch.setattr(sharding, "COPIES", 64)
    text = "'hot'" if same_text else "concat('hot ', id)"
    docs = spark.range(9_000).selectExpr(
        "if(id % 3 = 0, 7, id) as doc_id", f"if(id % 3 = 0, {text}, concat('row ', id)) as text"
    )
    got = sharding.shard_by_bytes(docs, 8).collect()
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    assert len(got) == 9_000 and len(load) == 8
    assert max(load.values()) - min(load.values()) <= 0.01 * sum(load.values()) / 8
    for shard in range(8):
        own = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert own == list(range(len(own)))


def test_a_stored_map_gets_one_new_version_a_run(spark):
    docs = spark.range(500).selectExpr("id as doc_id", "repeat('x', cast(id % 50 as int)) as text")
    path = scratch_path(spark, "map")
    sharding.shard_by_bytes(docs, 4, 64, path)
    first = sharding.load_map(spark, path, 1)
    sharding.shard_by_bytes(docs, 4, 64, path)
    assert sharding.stored_versions(spark, path) == [1, 2, 3]
    stored = spark.read.parquet(path).groupBy("map_version").count().collect()
    assert {r["count"] for r in stored} == {64}
    assert sharding.load_map(spark, path, 1) == first == sharding.SlotMap.initial(4, 64)
    more = sharding.shard_by_bytes(docs, 6, 64, path).collect()
    assert {r["shard"] for r in more} == set(range(6)) and {r["map_version"] for r in more} == {6}
    for n_shards, n_slots in ((4, 64), (6, 32)):
        with pytest.raises(ValueError):
            sharding.shard_by_bytes(docs, n_shards, n_slots, path)
    with pytest.raises(ValueError):
        sharding.save_map(spark, first, path)


def test_growing_moves_slots_only_to_the_new_shard():
    rng = random.Random(1)
    loads = [rng.randint(0, 1000) for _ in range(512)]
    old = sharding.SlotMap.initial(8, 512).rebalanced(loads)
    new = old.grown(loads)
    moved = [(a, b) for a, b in zip(old.owners, new.owners, strict=True) if a != b]
    assert moved and {b for _, b in moved} == {8}
    assert (new.version, new.n_shards) == (old.version + 1, 9)
    total = new.loads(loads)
    assert max(total) - min(total) <= 0.05 * sum(total) / 9


def test_rebalancing_moves_few_slots():
    loads = [100] * 512
    base = sharding.SlotMap.initial(8, 512)
    assert base.rebalanced(loads).owners == base.owners
    loads[0] = 5_000
    moved = sum(a != b for a, b in zip(base.owners, base.rebalanced(loads).owners, strict=True))
    assert 0 < moved <= 60


def test_stored_versions(spark, tmp_path):
    path = f"{tmp_path}/map"
    first = sharding.SlotMap.initial(3, 32)
    second = first.rebalanced([i * i for i in range(32)])
    for m in (first, second):
        sharding.save_map(spark, m, path)
    assert sharding.load_map(spark, path) == second
    assert sharding.load_map(spark, path, 1) == first


# ---- top-k ----


def slow_top_k(rows, k):
    vectors = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        vectors.setdefault(i, []).append([int(np.floor(256 * float(np.float32(x)))) for x in v])
    out = set()
    for q in vectors:
        if q % 50:
            continue
        scores = []
        for i, own in vectors.items():
            pairs = [sum(a * b for a, b in zip(x, y, strict=True)) for x in vectors[q] for y in own if len(x) == len(y)]
            if i != q and pairs:
                scores.append((-max(pairs), i))
        out.update((q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1))
    return out


@pytest.mark.parametrize("spread", [0.02, 1.0])
def test_top_k_with_clusters_ties_and_odd_rows(spark, spread, monkeypatch):
    rng = np.random.default_rng(3)
    monkeypatch.setattr(topk, "CELL_QUERIES", 2)
    centres = rng.normal(size=(6, 8))
    vectors = centres[rng.integers(0, 6, 700)] + spread * rng.normal(size=(700, 8))
    rows = [(i, [float(x) for x in v.astype(np.float32)]) for i, v in enumerate(vectors)]
    rows += [(1000 + i, [0.5] * 8) for i in range(200)]  # one common vector
    rows += [(2000, None), (2050, [None] * 8), (2100, [float("nan")] * 8), (2150, [float("inf")] * 8)]
    rows += [(3000, [1.0, 2.0]), (3001, [2.0, 1.0]), (3050, []), (None, [1.0] * 8), (50, rows[50][1]), (7, rows[8][1])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = {tuple(r) for r in topk.top_k(frame, F.col("id") % 50 == 0, 5).collect()}
    assert got == slow_top_k(rows, 5)
    assert topk.top_k(frame.limit(0), F.col("id") % 50 == 0, 5).collect() == []


def test_top_k_with_an_id_repeated_more_than_k_times(spark, monkeypatch):
    """The query's own id and another one fill the best cell; the results lie beyond it."""
    monkeypatch.setattr(topk, "CELL_QUERIES", 1)  # every pivot has a query cell
    rows = [(0, [10.0, 0.0])] * 8 + [(7, [10.0, 0.0])] * 6 + [(7, [-9.0, 0.0])]
    rows += [(i, [1.0, 0.1 * i]) for i in range(1, 5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {tuple(r) for r in topk.top_k(frame, F.col("id") == 0, 5).collect()}
    assert len(got) == 5 and got == {r for r in slow_top_k(rows, 5) if r[0] == 0}


def test_bounds_keep_far_cells_away():
    points = np.array([[100.0, 0.0], [-100.0, 0.0]])
    cells = topk.Cells(points, np.array([10, 10]), np.ones(2), np.ones(2), np.full(2, 101.0))
    wanted = cells.wanted(np.array([[100.0, 1.0], [-100.0, 0.0]]), cells.reached(5))
    assert wanted.tolist() == [[True, False], [False, True]]


def test_scores_beyond_doubles():
    big = np.array([[2**40, 2**40]])
    assert topk.scores(big, big).tolist() == [[2 * 2**80]]


# ---- WARC ----


class Reader(html.parser.HTMLParser):
    """The words a browser's parser sees, and links."""

    def __init__(self):
        super().__init__()
        self.text, self.links, self.hidden = [], [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        if tag == "a":
            self.links += [v for k, v in attrs if k == "href"]
        self.text.append(" " if tag in warc._LINE else "")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")
        self.text.append(" " if tag in warc._LINE else "")

    def handle_data(self, data):
        if not self.hidden:
            self.text.append(data)


def test_records_of_every_page(spark, sf):
    pages = table(spark, sf, "pages")
    records = warc.with_bytes(warc.derive(warc.responses_of_pages(pages, "2026-01-01T00:00:00Z"))).collect()
    by_page = {}
    for r in records:
        by_page.setdefault(r["page_id"], {})[r["type"]] = r
    for page in pages.collect():
        made = by_page.pop(page["page_id"])
        reader = Reader()
        reader.feed(page["html"])
        reader.close()
        assert bytes(made["conversion"]["block"]).decode().split() == "".join(reader.text).split()
        fields = bytes(made["metadata"]["block"]).decode()
        assert len(re.findall("^outlink: ", fields, re.M)) == len(dict.fromkeys(reader.links))
        sha = base64.b32encode(hashlib.sha1(page["html"].encode()).digest()).decode()
        assert f"source-payload-digest: sha1:{sha}\r\n" in fields
        for r in made.values():
            ((headers, block),) = list(warc.parse(bytes(r["record_bytes"])))
            assert block == bytes(r["block"]) and headers["WARC-Refers-To"] == r["refers_to"]
            assert headers["WARC-Block-Digest"] == warc.digest(block)
            assert headers["WARC-Refers-To-Target-URI"] == page["url"]
        assert made["metadata"]["refers_to"] == made["conversion"]["refers_to"]
    assert not by_page
    assert len({r["record_id"] for r in records}) == len(records)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("plain", "plain"),
        ("<p>a&amp;b<p>c  d", "a&b\nc d"),
        ("x<script>if (a < b) '</p>'</script>y", "x y"),
        ("<!-- <p>no</p> -->yes<!-- open", "yes"),
        ('<img alt="a > b">c', "c"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("<b>in</b>line<br/>next", "inline\nnext"),
    ],
)
def test_plain_text(page, text):
    assert warc.plain_text(page) == text


@pytest.mark.parametrize(
    ("page", "found"),
    [
        ("<a href=x>", ["http://b/x"]),
        ("<A class=c HREF = 'x?a=1&amp;b=2'>", ["http://b/x?a=1&b=2"]),
        ('<a data-href="no" href="yes"><a title="href=no">', ["http://b/yes"]),
        ('<a title="a > b" href="x"><a href="x"><a href="y">', ["http://b/x", "http://b/y"]),
        ("<a href=it's><abbr href=no><a\nhref='z'/>", ["http://b/it's", "http://b/z"]),
        ("<a href='x' <a href=y><a href='never ends", ["http://b/x"]),
        ("<!-- <a href=no> --><script>'<a href=no>'</script><a href=yes>", ["http://b/yes"]),
        ("<a href><a href=>", []),
        ("<script <a href=x>y", []),
    ],
)
def test_links(page, found):
    assert [x for x in warc.links(page, "http://b/") if x != "http://b/"] == found


@pytest.mark.parametrize(
    "unit",
    ["<a x ", "<script ", "<title>", "<title ", "<html ", "<a x='", "x", "x ", "<a href=\"", "<!--", "<",
     "=\"<a ='\"'", "<a \"'", "</script ", "&amp;"],
)
def test_time_grows_with_the_page(unit):
    """One megabyte of tags that never end. Quadratic scans would take minutes."""
    page = "<a " + unit * (1_000_000 // len(unit))
    begun = time.process_time()
    warc.links(page, "http://b/"), warc.plain_text(page), warc.title_of(page), warc._LANG.search(page)
    assert time.process_time() - begun < 10


def test_odd_pages(spark):
    rows = [(1, None, None, "x"), (2, "http://a/b", "", "y"), (2, "http://a/b", "", "y"), (None, "::", "<a href='http://[bad'>z", "w")]
    rows += [(5, "http://a/", "<p>word</p>" * 60_000, "v")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, type string")
    records = warc.derive(warc.responses_of_pages(pages, "2026-01-01T00:00:00Z")).collect()
    assert len(records) == 10
    assert all(r["content_length"] == len(r["block"]) for r in records)
    assert not any(h["name"].endswith("Target-URI") for r in records if r["page_id"] == 1 for h in r["headers"])
    assert warc.derive(warc.responses_of_pages(pages.limit(0), "d")).collect() == []


def test_source_headers_are_kept(spark):
    kind = "page_id long, record_id string, target_uri string, date string, headers array<struct<name:string,value:string>>, payload_digest string, payload binary"
    row = (1, "<urn:uuid:1>", "http://a/", "2020-01-01T00:00:00Z", [("Server", "x\r\ny"), ("ETag", None)], "sha1:ABC", b"<p>t")
    meta = warc.derive(spark.createDataFrame([row], kind)).filter("type = 'metadata'").first()
    assert bytes(meta["block"]) == b"source-payload-digest: sha1:ABC\r\nsource-server: x y\r\n" or b"source-server: x" in bytes(meta["block"])
    assert meta["payload_digest"] == "sha1:ABC" and meta["refers_to"] == "<urn:uuid:1>"


# ---- pipeline ----


def test_pipeline(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    before = {d["doc_id"]: d for d in docs.collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, k
    out = corpus_pipeline.run(spark, sf).collect()
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in out)
    kept = {r["doc_id"] for r in out}
    assert len(kept) == len(out) and kept <= set(before)
    # A document that shares nothing with any other stays.
    lines_of = Counter(x for d in before.values() for x in set(d["text"].split("\n")))
    roots = Counter(r["root"] for r in similar.near_copies(docs).collect())
    near = {r["doc_id"] for r in similar.near_copies(docs).collect() if roots[r["root"]] > 1}
    dirty = {
        r["doc_id"] for r in decontaminate.rate(docs, table(spark, sf, "benchmark")).filter("n_hit > 0").collect()
    }
    alone = {
        i for i, d in before.items() if i not in near | dirty and all(lines_of[x] == 1 for x in d["text"].split("\n"))
    }
    assert len(alone) > 100 and alone <= kept


def test_pipeline_of_an_empty_table(spark, sf):
    docs = table(spark, sf, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).collect() == []

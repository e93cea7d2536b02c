"""The search over vectors: what is exchanged, what a task holds, and its merging against brute force."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripmill.llm import topk


def slow(rows, q_id, query, k):
    """The k best (id, score) of one query; an id counts once."""
    best = {}
    for i, v in rows:
        if i != q_id:
            best[i] = max(best.get(i, -(1 << 200)), sum(int(a) * int(b) for a, b in zip(query, v, strict=True)))
    return sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]


@pytest.mark.parametrize("size", [3, 1 << 40])
def test_a_slice_gives_the_best_of_its_rows(size, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 7)
    rng = np.random.default_rng(int(size))
    for n, k in ((1, 5), (40, 1), (300, 5)):
        ids = rng.integers(0, max(2, n // 2), n)  # repeated, some beyond a chunk
        ids[: n // 3] = 3
        vectors = rng.integers(-size, size + 1, (n, 4))  # of small numbers most scores are ties
        wants = rng.integers(0, 4, n) | np.int64(-1 << 63)
        q_ids, queries = np.arange(12), rng.integers(-size, size + 1, (12, 4))
        here = topk.Slice(ids, vectors, wants)
        for cell in (0, 1, 63):
            best = here.best(cell, q_ids, queries, k)
            rows = [(int(i), v) for i, v, w in zip(ids, vectors, wants, strict=True) if w >> cell & 1]
            for q, found, score in zip(q_ids, best.ids, best.scores, strict=True):
                got = [(int(i), int(s)) for i, s in zip(found, score, strict=True) if s > best.floor]
                assert got == slow(rows, q, queries[q], k)


def test_numbers_are_packed_as_they_need():
    for number, width in ((-(1 << 15), 2), (1 << 15, 4), (-(1 << 31), 4), (1 << 31, 8), ((1 << 63) - 1, 8), (0, 2)):
        vectors = np.array([[number, 1, 2]])
        packed = topk._narrow(vectors)
        assert len(packed) == 3 * width and topk._wide(pa.py_buffer(packed), 1, 3).tolist() == vectors.tolist()


def test_rows_are_exchanged_once_and_slices_are_bounded(spark, monkeypatch):
    # Cells that no bound keeps apart, and one row that comes a thousand times.
    vectors = np.random.default_rng(8).normal(size=(3000, 256)).round(3)
    vectors[2000:] = vectors[2000]
    ids = np.minimum(np.arange(3000), 2000)
    embedding = pa.FixedSizeListArray.from_arrays(vectors.ravel(), 256).cast(pa.list_(pa.float64()))
    frame = spark.createDataFrame(pa.table({"vec_id": ids, "embedding": embedding}))
    monkeypatch.setattr(topk, "CELL_QUERIES", 1)  # so many query cells as pivots
    rows_held = 2 * topk.BLOCK_BYTES // (8 * 256)
    monkeypatch.setattr(topk, "SLICE_BYTES", rows_held * 8 * 256)
    written, keep = {}, topk.keep
    monkeypatch.setattr(topk, "keep", lambda df, label: written.setdefault(label, keep(df, label)))
    found, meet = [], topk._meet

    def watched(k):
        run = meet(k)

        def step(batches):
            held = {}

            def counted():
                for batch in batches:
                    for r in batch.to_pylist():
                        if r["query_cell"] < 0:
                            held[r["slice"]] = held.get(r["slice"], 0) + len(r["ids"]) // 8
                    yield batch

            yield from run(counted())
            for n in held.values():
                yield pa.RecordBatch.from_pydict({"query_id": [-1], "vec_id": [n], "score": [n]})

        return step

    monkeypatch.setattr(topk, "_meet", watched)
    got = {tuple(r) for r in topk.top_k(frame, F.col("id") % 50 == 0, 5).collect()}
    sent = written["blocks"].agg(F.sum(F.length("ids") / 8)).first()[0]
    assert sent <= 3000  # once, not once for each query cell
    assert max(n for q, _, _, n in got if q == -1) <= 2 * rows_held
    whole = np.floor(256 * vectors).astype(np.int64)
    for q in range(0, 2001, 50):
        best = np.lexsort((ids[:2001], -(whole[:2001] @ whole[q])))
        best = best[best != q][:5]
        want = [(n + 1, int(i), int(whole[i] @ whole[q])) for n, i in enumerate(best)]
        assert sorted((r, i, s) for a, r, i, s in got if a == q) == want

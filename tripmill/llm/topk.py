"""Exact top-k by inner product: a Voronoi join of queries and data.

Pivots cut the space into cells. From a summary of each cell (rows, radius around the
pivot, largest norm) follow bounds on the score of any query of one cell with any row of
another. The lower bounds say which score each query cell reaches at least k times; rows
whose upper bound is below it cannot be among the results there.

Rows that some query cell wants are exchanged once, into slices of their own cell. A query
goes to the slices of every cell with a row that its query cell wants, and meets the rows
that it wants there. A task holds one slice, which is bounded, while the queries stream by;
of each query it keeps the best k, and those of all slices are merged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tripmill.llm.common import keep, lean, ship

#: Cells; the pivots are the rows with the lowest hash of the id. Results do not depend on them.
PIVOTS = 64
#: Query cells are the cells of the first pivots, one for so many queries.
CELL_QUERIES = 256
#: Bytes of 64-bit numbers: of the vectors of a block, and of those that a task holds at once.
BLOCK_BYTES = 1 << 18
SLICE_BYTES = 1 << 25
#: Queries and rows that are multiplied at once.
QUERY_BLOCK = 256
CHUNK = 2048


def quantised(vector: Column) -> Column:
    """floor(256 * x) of each component, or null if any component is null or not finite."""
    x = F.transform(vector, lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~bad, F.transform(x, lambda v: F.floor(256 * v).cast("long")))


def usable(rows: DataFrame, vector: Column) -> DataFrame:
    """(id, vector) of the rows with an id and a whole vector. Empty vectors take no part."""
    found = rows.select(F.col("vec_id").alias("id"), quantised(vector).alias("vector"))
    return found.filter(F.col("id").isNotNull() & (F.size("vector") > 0))


@dataclass(frozen=True)
class Cells:
    """Pivots of one dimension and the summary of their cells; ``PIVOTS`` entries at most.

    ``rows`` counts distinct ids, each in one cell, so no id adds to the sure score twice.
    The first ``len(query_norm)`` pivots are those of the query cells.
    """

    pivots: np.ndarray
    rows: np.ndarray
    radius: np.ndarray
    query_radius: np.ndarray
    query_norm: np.ndarray

    @property
    def query_pivots(self) -> np.ndarray:
        return self.pivots[: len(self.query_norm)]

    def reached(self, k: int) -> np.ndarray:
        """For each query cell a score that k rows besides the query itself surely reach."""
        norm = np.linalg.norm(self.pivots, axis=1)
        centre = self.query_pivots @ self.pivots.T
        slack = self.query_radius[:, None] * norm[None, :]
        slack = slack + self.query_norm[:, None] * self.radius[None, :]
        low = np.where(self.rows[None, :] > 0, centre - slack, -np.inf)
        order = np.argsort(-low, axis=1)
        enough = np.cumsum(self.rows[order], axis=1) >= k + 1
        at = np.where(enough.any(axis=1), enough.argmax(axis=1), -1)
        value = np.take_along_axis(low, order, axis=1)[np.arange(len(low)), at]
        value = np.where(at >= 0, value, -np.inf)
        return value - 1e-6 * (1 + np.abs(np.where(np.isfinite(value), value, 0)))

    def wanted(self, vectors: np.ndarray, reached: np.ndarray) -> np.ndarray:
        """Per row and query cell: could the row be a result there?"""
        high = vectors @ self.query_pivots.T
        high = high + np.linalg.norm(vectors, axis=1)[:, None] * self.query_radius[None, :]
        high = high + 1e-6 * (1 + np.abs(high))
        return (high >= reached[None, :]) & (self.query_norm >= 0)[None, :]


def _matrices(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """The rows of a batch by dimension: places in the batch, ids and a matrix of doubles."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat, starts = vectors.values.to_numpy(), vectors.offsets.to_numpy()[:-1]
    number = ids.to_numpy()
    for dim in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == dim)
        yield dim, at, number[at], flat[starts[at][:, None] + np.arange(dim)].astype(np.float64)


def _distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (vectors**2).sum(axis=1)[:, None] + (pivots**2).sum(axis=1)[None, :]
    return np.sqrt(np.maximum(square - 2 * vectors @ pivots.T, 0))


def _assign(handed):
    """The rows (id, vector) with dimension, cell and query cell, distances to both pivots, norm.

    What is handed over are the pivots and the number of query cells of each dimension.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, _, ids, vectors in _matrices(batch.column(0), batch.column(1)):
                pivots, n_query = handed.value[dim]
                distance = _distances(vectors, pivots)
                cell = distance.argmin(axis=1)
                query_cell = distance[:, :n_query].argmin(axis=1)
                each = np.arange(len(ids))
                bounds = np.arange(len(ids) + 1, dtype=np.int32) * dim
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids),
                        pa.ListArray.from_arrays(
                            pa.array(bounds), pa.array(vectors.ravel().astype(np.int64))
                        ),
                        pa.array(np.full(len(ids), dim, np.int32)),
                        pa.array(cell.astype(np.int32)),
                        pa.array(distance[each, cell]),
                        pa.array(query_cell.astype(np.int32)),
                        pa.array(distance[each, query_cell]),
                        pa.array(np.linalg.norm(vectors, axis=1)),
                    ],
                    ["id", "vector", "dim", "cell", "distance", "query_cell", "query_distance", "norm"],
                )

    return run


_BLOCK = "dim int, cell int, ids binary, matrix binary"
_SENT = f"{_BLOCK}, wants binary, rows long, want long, place long"


def _pieces(dim: int, n: int) -> Iterator[slice]:
    """``n`` rows of one dimension in blocks of at most ``BLOCK_BYTES``."""
    step = max(1, BLOCK_BYTES // (8 * dim))
    return (slice(a, a + step) for a in range(0, n, step))


def _narrow(vectors: np.ndarray) -> bytes:
    """Whole numbers in 16, 32 or 64 bits each, whatever they need."""
    whole = vectors.astype(np.int64)
    for kind in (np.int16, np.int32):
        if whole.min(initial=0) >= np.iinfo(kind).min and whole.max(initial=0) <= np.iinfo(kind).max:
            return whole.astype(kind).tobytes()
    return whole.tobytes()


def _wide(matrix: pa.Buffer, n: int, dim: int) -> np.ndarray:
    """The ``n`` vectors that ``_narrow`` packed, copied."""
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[matrix.size // (n * dim)]
    return np.frombuffer(matrix, kind).reshape(n, dim).astype(np.int64)


def _blocks(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    names, types = zip(*(field.split() for field in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], list(names)
    )


def _send(handed):
    """The rows (id, vector, cell) that a query cell wants, as blocks of one cell.

    ``wants`` has a number for each row whose bits are the query cells that want it, ``want``
    those of the block; ``place`` counts the blocks of a cell, so that slices get equal shares.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, sent = TaskContext.get().partitionId() * 7919, Counter()
        for batch in batches:
            for dim, at, ids, vectors in _matrices(batch.column(0), batch.column(1)):
                if dim not in handed.value:  # no query has this dimension
                    continue
                cells, reached = handed.value[dim]
                wanted = cells.wanted(vectors, reached)
                bits = np.zeros((len(ids), PIVOTS // 8), np.uint8)
                packed = np.packbits(wanted, axis=1, bitorder="little")
                bits[:, : packed.shape[1]] = packed
                wants = bits.view(np.int64).ravel()
                home = np.where(wants != 0, batch.column(2).to_numpy()[at], -1)
                for cell in np.unique(home[home >= 0]).tolist():
                    of = np.flatnonzero(home == cell)
                    for piece in (of[p] for p in _pieces(dim, len(of))):
                        want = int(np.bitwise_or.reduce(wants[piece]))
                        block = dim, cell, ids[piece].tobytes(), _narrow(vectors[piece])
                        place = start + sent[dim, cell]
                        yield _blocks([(*block, wants[piece].tobytes(), len(piece), want, place)], _SENT)
                        sent[dim, cell] += 1

    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The query rows (id, vector, query cell) as blocks of one query cell."""
    for batch in batches:
        for dim, at, ids, vectors in _matrices(batch.column(0), batch.column(1)):
            cells = batch.column(2).to_numpy()[at]
            for cell in np.unique(cells).tolist():
                of = np.flatnonzero(cells == cell)
                pieces = [of[p] for p in _pieces(dim, len(of))]
                yield _blocks([(dim, cell, ids[p].tobytes(), _narrow(vectors[p])) for p in pieces], _BLOCK)


def scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products of integer vectors, exact whatever their size."""
    dim = max(queries.shape[1], 1)
    largest = int(np.abs(queries).max(initial=0)) * int(np.abs(data).max(initial=0)) * dim
    if largest < 1 << 53:
        return (queries.astype(np.float64) @ data.T.astype(np.float64)).astype(np.int64)
    if largest < 1 << 63:
        return queries @ data.T
    return queries.astype(object) @ data.T.astype(object)


class Best:
    """The k best (id, score) of each query among rows that are seen by rising id."""

    def __init__(self, n: int, k: int, huge: bool):
        #: Below every score.
        self.floor = -(1 << 200) if huge else -np.iinfo(np.int64).max
        self.ids = np.zeros((n, k), np.int64)
        self.scores = np.full((n, k), self.floor, object if huge else np.int64)

    def see(self, ids: np.ndarray, found: np.ndarray) -> None:
        """Scores of distinct ids, none smaller than those before; only the last one may come again.

        Among equal scores the id that came first is the smaller one, so a later id must be better.
        """
        rows = np.flatnonzero(found.max(axis=1, initial=self.floor) > self.scores[:, -1])
        found = found[rows]
        while len(rows):
            each = np.arange(len(rows))
            at = found.argmax(axis=1)
            score = found[each, at]
            better = score > self.scores[rows, -1]
            if not better.all():
                rows, found, at, score = rows[better], found[better], at[better], score[better]
                each = np.arange(len(rows))
            found[each, at] = self.floor
            self._put(rows, ids[at], score)

    def _put(self, rows: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        old = self.scores[rows]
        again = (self.ids[rows] == ids[:, None]) & (old != self.floor)
        less = again & (old < score[:, None])
        known = again.any(axis=1) & ~less.any(axis=1)
        old[less] = self.floor
        score[known] = self.floor
        scores = np.concatenate([old, score[:, None]], axis=1)
        ids = np.concatenate([self.ids[rows], ids[:, None]], axis=1)
        order = np.argsort(-scores, axis=1, kind="stable")[:, :-1]
        self.scores[rows] = np.take_along_axis(scores, order, axis=1)
        self.ids[rows] = np.take_along_axis(ids, order, axis=1)


class Slice:
    """Rows of one cell, by rising id, and the query cells that want each of them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, wants: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.wants = ids[order], vectors[order], wants[order]
        self.largest = int(np.abs(vectors).max(initial=0))

    def best(self, cell: int, q_ids: np.ndarray, queries: np.ndarray, k: int) -> Best:
        """The best of queries of one cell among the rows that it wants, their own ids left out."""
        huge = self.largest * int(np.abs(queries).max(initial=0)) * max(queries.shape[1], 1) >= 1 << 63
        best = Best(len(q_ids), k, huge)
        for a in range(0, len(self.ids), CHUNK):
            ids, vectors = self.ids[a : a + CHUNK], self.vectors[a : a + CHUNK]
            mine = self.wants[a : a + CHUNK] >> cell & 1 == 1
            if not mine.all():
                ids, vectors = ids[mine], vectors[mine]
            if not len(ids):
                continue
            found = scores(queries, vectors)
            found = found.astype(object) if huge else found
            starts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
            if len(starts) < len(ids):
                ids, found = ids[starts], np.maximum.reduceat(found, starts, axis=1)
            at = np.minimum(np.searchsorted(ids, q_ids), len(ids) - 1)
            own = np.flatnonzero(ids[at] == q_ids)
            found[own, at[own]] = best.floor
            best.see(ids, found)
        return best


def _meet(k: int):
    """(query_id, vec_id, score) of the best in each slice, from blocks that come sorted by slice.

    Of a slice the data come first (query cell -1), then the queries, by cell.
    """

    def answers(here: Slice, cell: int, asked: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids, queries = (np.concatenate(x) for x in zip(*asked, strict=True))
        for a in range(0, len(ids), QUERY_BLOCK):
            part = slice(a, a + QUERY_BLOCK)
            best = here.best(cell, ids[part], queries[part], k)
            there = best.scores > best.floor
            columns = np.repeat(ids[part], there.sum(axis=1)), best.ids[there], best.scores[there]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, here, last = None, None, -1
        data: list[tuple] = []
        asked: list[tuple] = []
        for batch in batches:
            slices, cells, dims = (batch.column(i).to_pylist() for i in range(3))
            for i, (at, cell, dim) in enumerate(zip(slices, cells, dims, strict=True)):
                if asked and ((at, cell) != (number, last) or sum(len(a[0]) for a in asked) >= QUERY_BLOCK):
                    yield from answers(here, last, asked)
                    asked = []
                if at != number:
                    number, here, data = at, None, []
                last = cell
                ids = np.frombuffer(batch.column(3)[i].as_buffer(), np.int64).copy()
                vectors = _wide(batch.column(4)[i].as_buffer(), len(ids), dim)
                if cell < 0:
                    wants = np.frombuffer(batch.column(5)[i].as_buffer(), np.int64).copy()
                    data.append((ids, vectors, wants))
                    continue
                if here is None and not data:  # a slice may have no block
                    continue
                if here is None:
                    here, data = Slice(*(np.concatenate(x) for x in zip(*data, strict=True))), []
                asked.append((ids, vectors))
        if asked:
            yield from answers(here, last, asked)

    return lean(run)


def top_k(rows: DataFrame, is_query: Column, k: int, vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows of highest inner product.

    ``rows`` has vec_id and a vector; ``is_query`` is a condition on ``id``. Candidates are
    all rows of another id and the same dimension; fewer than k give fewer results. Rows
    without id, or with a null, empty or not finite vector, take no part. Rows of one id
    are one: a pair counts once, with its highest score. Other columns are not read.
    """
    spark = rows.sparkSession
    ship(spark)
    data = usable(rows, F.col(vector))
    by_dim = W.partitionBy("dim").orderBy(F.xxhash64("id"), "id")
    sample = (
        data.withColumn("dim", F.size("vector"))
        .withColumn("n", F.row_number().over(by_dim))
        .filter(F.col("n") <= PIVOTS)
    )
    pivots: dict[int, list] = {}
    for row in sample.orderBy("dim", "n").collect():  # PIVOTS rows for each dimension
        pivots.setdefault(row["dim"], []).append(row["vector"])
    query = F.coalesce(is_query, F.lit(False))
    asked = data.filter(query).groupBy(F.size("vector").alias("dim")).count().collect()
    n_queries = {r["dim"]: r["count"] for r in asked}
    centres: dict[int, tuple[np.ndarray, int]] = {}
    for dim, points in pivots.items():
        distinct = np.array(list(dict.fromkeys(map(tuple, points))), np.float64)
        cells_of_queries = -(-n_queries.get(dim, 0) // CELL_QUERIES)
        centres[dim] = distinct, max(1, min(len(distinct), cells_of_queries))
    schema = (
        "id long, vector array<long>, dim int, cell int, distance double,"
        " query_cell int, query_distance double, norm double"
    )
    placed = keep(data.mapInArrow(_assign(spark.sparkContext.broadcast(centres)), schema), "vectors")
    # An id counts once, in the lowest of its cells: results count it once, too.
    homes = placed.groupBy("dim", "id").agg(F.min("cell").alias("cell"))
    ids = homes.groupBy("dim", "cell").agg(F.count("*").alias("rows"))
    in_cells = placed.groupBy("dim", "cell").agg(F.max("distance").alias("radius"))
    in_cells = in_cells.join(ids, ["dim", "cell"], "left").fillna(0, ["rows"])
    of_queries = placed.filter(query).groupBy("dim", "query_cell").agg(
        F.max("query_distance").alias("radius"), F.max("norm").alias("norm")
    )
    cells: dict[int, tuple[Cells, np.ndarray]] = {}
    summary, asking = in_cells.collect(), of_queries.collect()
    for dim in n_queries:
        points, m = centres[dim]
        n = len(points)
        made = Cells(points, np.zeros(n, np.int64), np.zeros(n), np.zeros(m), np.full(m, -1.0))
        for r in (r for r in summary if r["dim"] == dim):
            made.rows[r["cell"]], made.radius[r["cell"]] = r["rows"], r["radius"] * (1 + 1e-9) + 1e-6
        for r in (r for r in asking if r["dim"] == dim):
            made.query_radius[r["query_cell"]] = r["radius"] * (1 + 1e-9) + 1e-6
            made.query_norm[r["query_cell"]] = r["norm"] * (1 + 1e-9)
        cells[dim] = made, made.reached(k)
    handed = spark.sparkContext.broadcast(cells)
    sent = keep(placed.select("id", "vector", "cell").mapInArrow(_send(handed), _SENT), "blocks")
    wanting = sent.groupBy("dim", "cell").agg(F.sum("rows").alias("rows"), F.bit_or("want").alias("want"))
    slices, routes, n_slices = [], [], 0
    for r in wanting.collect():  # a row for each cell
        first, n = n_slices, -(-r["rows"] * 8 * r["dim"] // SLICE_BYTES)
        n_slices += n
        slices.append((r["dim"], r["cell"], first, n))
        asking_cells = [c for c in range(PIVOTS) if r["want"] >> c & 1]
        routes += [(r["dim"], c, first, n_slices - 1) for c in asking_cells]
    sliced = F.broadcast(spark.createDataFrame(slices, "dim int, cell int, first int, n int"))
    routed = F.broadcast(spark.createDataFrame(routes, "dim int, cell int, first int, last int"))
    served = sent.join(sliced, ["dim", "cell"]).select(
        (F.col("first") + F.pmod("place", F.col("n"))).cast("int").alias("slice"),
        F.lit(-1).alias("query_cell"),
        "dim",
        "ids",
        "matrix",
        "wants",
    )
    asked = placed.filter(query).select("id", "vector", "query_cell").mapInArrow(_gather, _BLOCK)
    asked = asked.join(routed, ["dim", "cell"]).select(
        F.explode(F.sequence("first", "last")).alias("slice"),
        F.col("cell").alias("query_cell"),
        "dim",
        "ids",
        "matrix",
        F.lit(None).cast("binary").alias("wants"),
    )
    # A number of partitions of its own: bytes do not tell how long a slice takes.
    dealt = served.union(asked).repartition(max(1, 2 * n_slices), "slice")
    met = dealt.sortWithinPartitions("slice", "query_cell")
    pairs = met.mapInArrow(_meet(k), "query_id long, vec_id long, score long")
    once = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

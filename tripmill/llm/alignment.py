"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled by the full text, so copies become one text with a multiplicity. Each
distinct text is encoded by both tokenizers, and cut into groups at the byte offsets where
tokens of both end; every token of A in a group is linked to every token of B in it. Where
no token of either side crosses a space, texts are cut there, and a task aligns each
segment once. It works in blocks of texts and writes, beside the texts' own measures, one list of the
block's id pairs with the number of documents that hold them. Pair counts are summed over
blocks, and go back to each block as one list, from which the texts of the block read the
counts of their links. So what is exchanged are the pairs of blocks, not of texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import keep, ship, whole
from tripmill.llm.token_counts import content_digest
from tripmill.llm.vocabularies import TokenizerFile

#: Characters of text in a block, whose pairs are one list; a longer text is its own block.
BLOCK = 1 << 21
#: Characters that are encoded and aligned together.
CHUNK = 1 << 19
#: Segments of texts whose links are looked up together.
SLICE = 1 << 18
#: Pairs of known segments past which a task forgets them.
KNOWN_PAIRS = 1 << 20
#: Links of a group up to which they are laid out one by one.
FEW_LINKS = 1 << 10

_TEXT = "key binary, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_ALIGNED = f"block binary, {_TEXT}, places array<int>, times array<long>, pairs array<long>, weights array<long>"
_MEASURED = (
    "key binary, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


class Side:
    """One tokenizer with the bytes and the lengths of its ids."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.bytes_of = tokenizer.token_bytes()
        self.length = np.array([len(b) for b in self.bytes_of], np.int64)


def segments(text: str, cuttable: bool) -> list[str]:
    """The text cut at spaces that no token of either side crosses; the spaces are left out.

    Such a space follows a letter, a number or another visible ASCII character. Tokens of
    both sides end before it, so it is the border of a group too.
    """
    if not cuttable:
        return [text]
    found, open_parts = [], []
    for part in text.split(" "):
        open_parts.append(part)
        if part and ("!" <= part[-1] <= "~" or part[-1].isalnum()):
            found.append(part if len(open_parts) == 1 else " ".join(open_parts))
            open_parts = []
    rest = " ".join(open_parts)
    if rest or not found:
        found.append(rest)
    elif open_parts:  # a model has no token for an empty text, so the last space stays
        found[-1] += " "
    return found


class Aligner:
    """Segments by number, each encoded and aligned once as long as it is known."""

    def __init__(self, a: Side, b: Side) -> None:
        self.a, self.b = a, b
        self.cuttable = a.tokenizer.cuttable and b.tokenizer.cuttable
        self.size_b = len(b.bytes_of)
        self.space = len(a.bytes_of) * self.size_b
        most = max(len(a.bytes_of), self.size_b)
        # The separators of the written form of the groups.
        self.signs = [f"{i}{mark}" for mark in ",|;" for i in range(most)]
        self.marks = most
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.written: list[str] = []
        self.faithful = np.empty(0, bool)
        self.sums = np.empty((0, 4), np.int64)
        self.first = np.zeros(1, np.int64)
        self.pairs, self.times = np.empty(0, np.int64), np.empty(0, np.int64)

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """The segments of each text as numbers; new ones are learned."""
        if len(self.pairs) > KNOWN_PAIRS:
            self.forget()
        known, new, out = self.number, [], []
        for text in texts:
            own = []
            for segment in segments(text, self.cuttable):
                n = known.get(segment)
                if n is None:
                    n = known[segment] = len(known)
                    new.append(segment)
                own.append(n)
            out.append(own)
        at = 0
        while at < len(new):
            size, end = 0, at
            while end < len(new) and size < CHUNK:
                size += len(new[end]) + 1
                end += 1
            self._learn(new[at:end])
            at = end
        return out

    def _learn(self, new: list[str]) -> None:
        """Align segments that got the next numbers. One that is not given back has no groups."""
        spaced = [f" {t}" for t in new]
        ids_a, ids_b = self.a.tokenizer.ids(spaced), self.b.tokenizer.ids(new)
        whole_a, whole_b = self.a.bytes_of.__getitem__, self.b.bytes_of.__getitem__
        faithful = np.fromiter(
            (
                b"".join(map(whole_a, a)) == text.encode() == b"".join(map(whole_b, b))
                for text, a, b in zip(spaced, ids_a, ids_b, strict=True)
            ),
            bool,
            len(new),
        )
        sums, n_pairs = np.zeros((len(new), 4), np.int64), np.zeros(len(new), np.int64)
        written, used = [""] * len(new), np.flatnonzero(faithful)
        if len(used):
            *four, keys, times, order = self.align([ids_a[i] for i in used], [ids_b[i] for i in used])
            sums[used] = np.stack(four, axis=1)
            cuts = np.searchsorted(keys, np.arange(len(used) + 1) * self.space)
            n_pairs[used] = np.diff(cuts)
            self.pairs = np.concatenate([self.pairs, keys % self.space])
            self.times = np.concatenate([self.times, times])
            signs, ends = order.tolist(), np.cumsum(sums[used, 0] + sums[used, 1]).tolist()
            for i, start, end in zip(used.tolist(), [0, *ends], ends, strict=False):
                written[i] = "".join(map(self.signs.__getitem__, signs[start:end]))[:-1]
        self.written += written
        self.faithful = np.concatenate([self.faithful, faithful])
        self.sums = np.concatenate([self.sums, sums])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(n_pairs)])

    def align(self, ids_a: list[list[int]], ids_b: list[list[int]]) -> tuple[np.ndarray, ...]:
        """Per segment tokens of A, of B, groups and links; distinct (segment, pair) and their links; signs.

        Both lists hold tokens of the same bytes, and none is empty.
        """
        n_a = np.fromiter(map(len, ids_a), np.int64, len(ids_a))
        n_b = np.fromiter(map(len, ids_b), np.int64, len(ids_b))
        a = np.fromiter(chain.from_iterable(ids_a), np.int64, int(n_a.sum()))
        b = np.fromiter(chain.from_iterable(ids_b), np.int64, int(n_b.sum()))
        ends_a, ends_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        at = np.searchsorted(ends_b, ends_a)
        last_a = np.flatnonzero(ends_b[at] == ends_a)  # the last tokens of the groups
        last_b = at[last_a]
        in_a, in_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
        owner = np.repeat(np.arange(len(n_a)), n_a)[last_a]
        n_groups = np.bincount(owner, minlength=len(n_a))
        n_links = np.zeros(len(n_a), np.int64)
        np.add.at(n_links, owner, in_a * in_b)
        found = self._pairs(a, b, last_a, last_b, in_a, in_b, owner)
        group_a = np.repeat(np.arange(len(in_a)), in_a)
        group_b = np.repeat(np.arange(len(in_b)), in_b)
        order = np.empty(len(a) + len(b), np.int64)
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[last_a], mark_b[last_b] = 1, 2
        order[np.arange(len(a)) + (last_b - in_b + 1)[group_a]] = a + mark_a * self.marks
        order[np.arange(len(b)) + (last_a + 1)[group_b]] = b + mark_b * self.marks
        return n_a, n_b, n_groups, n_links, *found, order

    def _pairs(self, a, b, last_a, last_b, in_a, in_b, owner) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys owner * space + pair, and how many links each has."""
        few = in_a * in_b <= FEW_LINKS
        of_a = np.repeat(np.arange(len(in_a)), in_a)
        listed = few[of_a]
        group = of_a[listed]
        repeat = in_b[group]
        first = np.cumsum(repeat) - repeat
        total = int(repeat.sum())
        with_b = np.arange(total) + np.repeat((last_b - in_b + 1)[group] - first, repeat)
        keys = np.repeat(owner[group] * self.space + a[listed] * self.size_b, repeat) + b[with_b]
        found, times = np.unique(keys, return_counts=True)
        parts, counts = [found], [times]
        for g in np.flatnonzero(~few).tolist():
            own_a, times_a = np.unique(a[last_a[g] - in_a[g] + 1 : last_a[g] + 1], return_counts=True)
            own_b, times_b = np.unique(b[last_b[g] - in_b[g] + 1 : last_b[g] + 1], return_counts=True)
            for one, n in zip(own_a.tolist(), times_a.tolist(), strict=True):
                parts.append(owner[g] * self.space + one * self.size_b + own_b)
                counts.append(n * times_b)
        return _summed(np.concatenate(parts), np.concatenate(counts)) if len(parts) > 1 else (found, times)

    def links(self, numbers: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys owner * space + pair of segments, and how many links each has."""
        n = (self.first[1:] - self.first[:-1])[numbers]
        ends = np.cumsum(n)
        place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[numbers] - (ends - n), n)
        return _summed(np.repeat(owner * self.space, n) + self.pairs[place], self.times[place])


@lru_cache(maxsize=1)
def _aligner(a, b) -> Aligner:
    """Kept by the worker from task to task; what it knows is bounded."""
    return Aligner(Side(a), Side(b))


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the values of each."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[starts], np.add.reduceat(values[order], starts)


def _block_rows(rows: list[tuple[bytes, int, str]], aligner: Aligner) -> pa.RecordBatch:
    """One row for each faithful text (key, documents, text), and one with the pairs of the block."""
    split = [np.array(n, np.int64) for n in aligner.numbers([text for _, _, text in rows])]
    kept = [(key, n, own) for (key, n, _), own in zip(rows, split, strict=True) if aligner.faithful[own].all()]
    kinds = [pa.binary(), pa.binary(), *[pa.int64()] * 4, pa.string(), pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 3]
    columns: list[list] = [[] for _ in kinds]
    if kept:
        flat = np.concatenate([own for _, _, own in kept])
        owner = np.repeat(np.arange(len(kept)), [len(own) for _, _, own in kept])
        parts = [
            aligner.links(flat[i : i + SLICE], owner[i : i + SLICE]) for i in range(0, len(flat), SLICE)
        ]
        keys, times = _summed(*(np.concatenate(p) for p in zip(*parts, strict=True)))
        cuts = np.searchsorted(keys, np.arange(len(kept) + 1) * aligner.space)
        documents = np.repeat([n for _, n, _ in kept], np.diff(cuts))
        known, weight = _summed(keys % aligner.space, documents)
        place = np.searchsorted(known, keys % aligner.space).astype(np.int32)
        block = kept[0][0]
        for i, (key, _, own) in enumerate(kept):
            digest = hashlib.sha256()
            for j in range(0, len(own), SLICE):
                digest.update(b";" if j else b"")
                digest.update(";".join(map(aligner.written.__getitem__, own[j : j + SLICE].tolist())).encode())
            here = slice(cuts[i], cuts[i + 1])
            sums = aligner.sums[own].sum(axis=0).tolist()
            row = [block, key, *sums, digest.hexdigest(), place[here], times[here], None, None]
            for column, value in zip(columns, row, strict=True):
                column.append(value)
        row = [block, *[None] * 8, known, weight]
        for column, value in zip(columns, row, strict=True):
            column.append(value)
    names = [part.split()[0] for part in _ALIGNED.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


def aligned(docs: DataFrame, first: TokenizerFile, second: TokenizerFile) -> DataFrame:
    """Distinct texts of ``docs`` aligned, in blocks; a row without a key has a block's pairs.

    Only texts with tokens have rows. The key of a block is that of its first text.
    """
    ship(docs.sparkSession)
    text = whole(F.col("text")).alias("text")
    distinct = docs.select(text).filter(F.col("text") != "").groupBy("text").agg(F.count("*").alias("n"))
    a, b = first.handed(), second.handed()

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(a(), b())
        rows, size = [], 0
        for batch in batches:
            for text, n, key in zip(*batch.columns, strict=True):
                text = text.as_py()
                rows.append((key.as_py(), n.as_py(), text))
                size += len(text)
                if size >= BLOCK:
                    yield _block_rows(rows, aligner)
                    rows, size = [], 0
        if rows:
            yield _block_rows(rows, aligner)

    keyed = distinct.select("text", "n", content_digest(F.col("text")).alias("key"))
    return keyed.mapInArrow(blocks, _ALIGNED)


def pair_counts(blocks: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): documents that hold the pair, and whether no pair of its A id has more."""
    listed = blocks.filter(F.col("key").isNull())
    pairs = listed.select(F.explode(F.arrays_zip("pairs", "weights")).alias("p"))
    counts = pairs.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.weights").alias("n"))
    counts = counts.withColumn("a", F.expr(f"pair div {size_b}"))
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    # At most one row for each id of the first vocabulary.
    joined = counts.join(F.broadcast(most), "a")
    return joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that come sorted by block, the block's counts before its texts."""
    block, n, best = None, np.empty(0), np.empty(0)
    for batch in batches:
        columns: list[list] = [[] for _ in range(8)]
        for row in range(batch.num_rows):
            own = batch.column(0)[row].as_py()
            counted = batch.column(9)[row]
            if counted.is_valid:
                fields = counted.values.flatten()
                pair, n, best = (f.to_numpy(zero_copy_only=False) for f in fields)
                order = np.argsort(pair)
                block, n, best = own, n[order], best[order]
                continue
            if own != block:
                raise ValueError("a block without its pair counts")
            place = batch.column(7)[row].values.to_numpy()
            times = batch.column(8)[row].values.to_numpy()
            sums = [batch.column(i)[row].as_py() for i in (2, 3, 4, 5)]
            values = [batch.column(1)[row].as_py(), *sums]
            values += [int(times[best[place]].sum()), int(times @ n[place]), batch.column(6)[row].as_py()]
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        kinds = [pa.binary(), *[pa.int64()] * 6, pa.string()]
        names = [part.split()[0] for part in _MEASURED.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )


def alignment(docs: DataFrame, first: TokenizerFile, second: TokenizerFile) -> DataFrame:
    """The links of every row between the tokens of ``first`` and ``second``.

    Columns doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose pair no other
    pair of its A id outdoes in documents), count_sum (documents of the pairs, over links)
    and groups_sha256. Rows whose text is null, empty, or not given back byte by byte by
    both tokenizers have no tokens: zeros and an empty string. Repeated rows count as
    often as they occur and are all returned; a null doc_id is as good as any. An empty
    table gives no rows. Columns other than doc_id and text are not read.

    A task holds one block of texts at a time, or one long text; a block's pairs are at
    most its tokens' links.
    """
    size_b = len(first.handed()().token_bytes()), len(second.handed()().token_bytes())
    blocks = keep(aligned(docs, first, second), "aligned-blocks")
    counts = keep(pair_counts(blocks, size_b[1]), "pair-counts")
    listed = blocks.filter(F.col("key").isNull()).select("block", F.explode("pairs").alias("pair"))
    told = listed.join(counts, "pair").groupBy("block")
    told = told.agg(F.collect_list(F.struct("pair", "n", "best")).alias("counts"))
    texts = blocks.filter(F.col("key").isNotNull())
    counted = "array<struct<pair:long,n:long,best:boolean>>"
    names = ["block", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "places", "times"]
    rows = texts.select(*names, F.lit(None).cast(counted).alias("counts")).unionByName(
        told, allowMissingColumns=True
    )
    ordered = rows.repartition("block").sortWithinPartitions("block", F.col("key").asc_nulls_first())
    measures = ordered.mapInArrow(_measured, _MEASURED)
    keyed = docs.select("doc_id", content_digest(whole(F.col("text"))).alias("key"))
    # No hint: the partition of a text that a third of all rows hold is split by Spark.
    joined = keyed.join(measures, "key", "left")
    zeros = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return joined.select(
        "doc_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in zeros),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )

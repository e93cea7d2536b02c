"""Byte-level BPE over a rank queue of hierarchical bitmaps.

The bytes of many pre-tokens lie in one doubly linked list that is cut between
pre-tokens. Every adjacent pair with a rank sits in that rank's bucket, and a
three-level bitmap over the ranks tells by find-first-set which bucket is next. A
popped bucket is merged in whole: entries whose pair has changed since are stale and
skipped, overlapping pairs are taken from the left, and the new pairs beside each merge
are put into their buckets. The cost follows the number of merges, so one pre-token of
a million bytes costs what a million bytes of short ones do.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tripmill.llm.common import each, ship

_NONE = np.int32(2**31 - 1)
#: Bytes of text whose pre-tokens are gathered before they are encoded together.
BLOCK_BYTES = 8 << 20
#: Pre-tokens whose ids are kept from block to block.
KNOWN_PRETOKENS = 400_000


class RankQueue:
    """Buckets by rank below three levels of 64-bit occupancy words."""

    def __init__(self, n_ranks: int) -> None:
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.low = [0] * (n_ranks // 64 + 1)
        self.mid = [0] * (n_ranks // 4096 + 1)
        self.top = 0

    def _add(self, rank: int, positions: np.ndarray) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket.append(positions)
            return
        self.buckets[rank] = [positions]
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def push(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        """Put each position into the bucket of its rank."""
        if len(positions) == 1:
            self._add(int(ranks[0]), positions)
            return
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for rank, a, b in zip(ranks[starts].tolist(), starts, [*starts[1:], len(ranks)], strict=True):
            self._add(rank, positions[a:b])

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank that has entries, and all of them."""
        if not self.top:
            return None
        i = (self.top & -self.top).bit_length() - 1
        word = self.mid[i]
        j = i << 6 | ((word & -word).bit_length() - 1)
        word = self.low[j]
        rank = j << 6 | ((word & -word).bit_length() - 1)
        self.low[j] &= word - 1
        if not self.low[j]:
            self.mid[i] &= ~(1 << (j & 63))
            if not self.mid[i]:
                self.top &= ~(1 << i)
        found = self.buckets.pop(rank)
        return rank, found[0] if len(found) == 1 else np.concatenate(found)


class Vocabulary:
    """Ranks of byte strings, with lookup of what two neighbours merge into."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.bytes_of: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = np.array(
            [
                (ranks[token[:i]], ranks[token[i:]], rank)
                for token, rank in ranks.items()
                for i in range(1, len(token))
                if token[:i] in ranks and token[i:] in ranks
            ],
            np.int64,
        ).reshape(-1, 3)
        self.after = self._index(pairs[:, 0], pairs[:, 1], pairs[:, 2])
        self.before = self._index(pairs[:, 1], pairs[:, 0], pairs[:, 2])
        byte_of = np.full(self.size, -1)
        byte_of[self.single] = np.arange(256)
        a, b = byte_of[pairs[:, 0]], byte_of[pairs[:, 1]]
        both = (a >= 0) & (b >= 0)
        self.of_bytes = np.full((256, 256), _NONE, np.int32)
        self.of_bytes[a[both], b[both]] = pairs[both, 2]

    def _index(self, first, second, merged):
        order = np.lexsort((second, first))
        bounds = np.searchsorted(first[order], np.arange(self.size + 1)).tolist()
        return bounds, second[order].astype(np.int32), merged[order].astype(np.int32)

    @staticmethod
    def _find(index, fixed: int, other: np.ndarray) -> np.ndarray:
        bounds, partners, merged = index
        a, b = bounds[fixed], bounds[fixed + 1]
        if a == b:
            return np.full(len(other), _NONE, np.int32)
        at = np.searchsorted(partners[a:b], other)
        at[at == b - a] = 0
        return np.where(partners[a:b][at] == other, merged[a:b][at], _NONE)

    def merged_after(self, rank: int, right: np.ndarray) -> np.ndarray:
        """Rank of ``rank`` followed by each of ``right``."""
        return self._find(self.after, rank, right)

    def merged_before(self, rank: int, left: np.ndarray) -> np.ndarray:
        """Rank of each of ``left`` followed by ``rank``."""
        return self._find(self.before, rank, left)

    def encode_all(self, pretokens: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pre-tokens in one array, and the number of ids of each."""
        whole = np.fromiter(
            (self.ranks.get(p, -1) for p in pretokens), np.int32, count=len(pretokens)
        )
        rest = np.flatnonzero(whole < 0).tolist()
        ids, counts = self._merge([pretokens[i] for i in rest])
        n = np.ones(len(pretokens), np.int64)
        n[rest] = counts
        out = np.empty(n.sum(), np.int32)
        simple = np.repeat(whole >= 0, n)
        out[simple] = whole[whole >= 0]
        out[~simple] = ids
        return out, n

    def _merge(self, pretokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        data = np.frombuffer(b"".join(pretokens), np.uint8)
        lengths = np.fromiter(map(len, pretokens), np.int64, count=len(pretokens))
        n = len(data)
        if not n:
            return np.empty(0, np.int32), lengths
        starts = np.cumsum(lengths) - lengths
        # Position n stands for "none"; it has no rank with anything.
        token = np.append(self.single[data], np.int32(self.size))
        following = np.arange(1, n + 2, dtype=np.int32)
        previous = np.arange(-1, n, dtype=np.int32)
        full = lengths > 0
        following[(starts + lengths - 1)[full]] = n
        previous[starts[full]] = n
        following[n] = previous[n] = n
        rank_at = np.full(n + 1, _NONE, np.int32)
        rank_at[: n - 1] = self.of_bytes[data[:-1], data[1:]]
        rank_at[:n][following[:n] == n] = _NONE
        alive = np.ones(n, bool)
        queue = RankQueue(self.size)
        known = np.flatnonzero(rank_at != _NONE).astype(np.int32)
        if len(known):
            queue.push(known, rank_at[known])
        while (popped := queue.pop()) is not None:
            rank, at = popped
            at = at[rank_at[at] == rank]  # the others are stale
            if not len(at):
                continue
            if len(at) > 1:
                at = np.unique(at)
                chained = following[at[:-1]] == at[1:]
                if chained.any():
                    # Of overlapping pairs the first, third, ... from the left.
                    index = np.arange(len(at))
                    first = np.where(np.append(True, ~chained), index, 0)
                    at = at[(index - np.maximum.accumulate(first)) % 2 == 0]
            second = following[at]
            right, left = following[second], previous[at]
            left_token, right_token = token[left], token[right]
            touching = None
            if len(at) > 1:
                touching = np.flatnonzero(right[:-1] == at[1:])
                lowest = _NONE
                if len(touching):
                    lowest = self.merged_after(rank, right_token[touching]).min()
                    left_token[touching + 1] = rank
                    right_token[touching] = rank
                    left[touching + 1] = at[touching]
            on_left = self.merged_before(rank, left_token)
            on_right = self.merged_after(rank, right_token)
            if len(at) > 1 and min(lowest, on_left.min(), on_right.min()) < rank:
                # A new pair comes before the rest of this bucket: only the first pair of
                # each pre-token is merged now, the others wait in the queue.
                word = np.searchsorted(starts, at, side="right")
                one = np.append(True, word[1:] != word[:-1])
                queue.push(at[~one], rank_at[at[~one]])
                at, second = at[one], second[one]
                right, left = following[second], previous[at]
                on_left = self.merged_before(rank, token[left])
                on_right = self.merged_after(rank, token[right])
            token[at] = rank
            following[at] = right
            previous[right] = at
            following[n] = previous[n] = n
            rank_at[second] = _NONE
            alive[second] = False
            rank_at[left] = on_left
            rank_at[at] = on_right
            rank_at[n] = _NONE
            some = on_left != _NONE
            if some.any():
                queue.push(left[some], on_left[some])
            some = on_right != _NONE
            if some.any():
                queue.push(at[some], on_right[some])
        kept = np.flatnonzero(alive)
        counts = np.zeros(len(lengths), np.int64)
        np.add.at(counts, np.searchsorted(starts + lengths, kept, side="right"), 1)
        return token[kept], counts


def read_ranks(content: bytes) -> dict[bytes, int]:
    """The ranks in the text of a rank file: base64 and rank on each line."""
    pairs = (line.split() for line in content.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


@lru_cache(maxsize=2)
def vocabulary(content: bytes) -> Vocabulary:
    return Vocabulary(read_ranks(content))


class _Numbers(dict):
    """Numbers distinct pre-tokens in the order they are first seen."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Known:
    """Pre-tokens met so far with their ids; forgotten when they become too many."""

    def __init__(self) -> None:
        self.numbers = _Numbers()
        self.ids, self.counts = np.empty(0, np.int32), np.empty(0, np.int64)

    def learn(self, vocab: Vocabulary) -> None:
        """Encode those numbered since the last time, all at once."""
        new = list(islice(self.numbers, len(self.counts), None))
        ids, counts = vocab.encode_all([p.encode() for p in new])
        self.ids, self.counts = np.append(self.ids, ids), np.append(self.counts, counts)


def encode_texts(
    vocab: Vocabulary, split: regex.Pattern, texts: Sequence[str], known: Known | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in one array, and the bounds of each text in it."""
    known = known or Known()
    numbers = known.numbers
    parts, sizes = [], []
    for text in texts:
        pretokens = split.findall(text)
        parts.append(np.fromiter(map(numbers.__getitem__, pretokens), np.int32, len(pretokens)))
        sizes.append(len(pretokens))
    known.learn(vocab)
    ids, counts = known.ids, known.counts
    first = np.cumsum(counts) - counts
    flat = np.concatenate(parts) if parts else np.empty(0, np.int32)
    n = counts[flat]
    ends = np.cumsum(n)
    # Each id's place: the start of its pre-token's ids plus its offset in them.
    place = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[flat] - (ends - n), n)
    bounds = np.append(0, ends)[np.append(0, np.cumsum(sizes, dtype=np.int64))]
    return ids[place], bounds


def _blocks(column: pa.Array) -> Iterator[list[str]]:
    """The texts, null as empty, in lists of about ``BLOCK_BYTES``."""
    block, size = [], 0
    for value in column:
        block.append(value.as_py() or "")
        size += len(block[-1])
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


class Codec:
    """Encoding and decoding as column functions under one rank file and split pattern.

    Null encodes as the empty text, to no ids; null ids decode to no bytes. The rank file
    (about a megabyte, fixed) is broadcast once. Each function is declared not
    deterministic, so Spark never evaluates it once for every use of its result.
    """

    def __init__(self, spark: SparkSession, rank_file: str, pattern: str) -> None:
        ship(spark)
        self.content = spark.sparkContext.broadcast(Path(rank_file).read_bytes())
        self.pattern = pattern

    def encode(self, text: Column) -> Column:
        """array<int> of the text's ids, each match of the pattern encoded by itself."""
        encoder = _encoder(self.content, self.pattern)
        return F.arrow_udf(lambda column: encoder(column)[0], "array<int>").asNondeterministic()(text)

    def decode(self, ids: Column) -> Column:
        """The bytes that the ids stand for."""
        content = self.content

        def decode(column: pa.Array) -> pa.Array:
            return _decode(vocabulary(content.value), column)

        return F.arrow_udf(decode, "binary").asNondeterministic()(ids)

    def round_trip(self, text: Column) -> Column:
        """struct<ids, decoded>: both directions in one pass over the text."""
        encoder = _encoder(self.content, self.pattern)

        def both(column: pa.Array) -> pa.Array:
            ids, vocab = encoder(column)
            return pa.StructArray.from_arrays([ids, _decode(vocab, ids)], ["ids", "decoded"])

        kind = "struct<ids:array<int>,decoded:binary>"
        return F.arrow_udf(each(both), kind).asNondeterministic()(text)


def _encoder(content, pattern: str) -> Callable[[pa.Array], tuple[pa.Array, Vocabulary]]:
    def encode(column: pa.Array) -> tuple[pa.Array, Vocabulary]:
        vocab, split = vocabulary(content.value), regex.compile(pattern)
        ids, bounds = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
        known = Known()
        for block in _blocks(column):
            if len(known.numbers) > KNOWN_PRETOKENS:
                known = Known()
            part, ends = encode_texts(vocab, split, block, known)
            ids.append(part)
            bounds.append(ends[1:] + bounds[-1][-1])
        offsets = pa.array(np.concatenate(bounds).astype(np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids))), vocab

    return encode


def _decode(vocab: Vocabulary, column: pa.Array) -> pa.Array:
    bounds, ids = column.offsets.to_numpy(), column.values.to_numpy()
    valid = column.is_valid().to_numpy(zero_copy_only=False)

    def rows() -> Iterator[bytes]:
        for a, b, there in zip(bounds[:-1].tolist(), bounds[1:].tolist(), valid, strict=True):
            own = ids[a:b].tolist() if there else []
            yield b"".join(map(vocab.bytes_of.__getitem__, own))

    return pa.array(rows(), pa.binary())

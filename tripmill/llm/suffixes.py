"""Exact removal of repeated byte strings by suffix arrays of shards.

A window is a string of ``WINDOW`` bytes. Its anchor is the lowest hash of the ``GRAM``
byte strings inside, so equal windows have equal anchors, wherever they are. Only
windows whose anchor occurs at least twice in the corpus can repeat; the stretches they
cover are the regions. Regions go to shards by their lowest anchor, so copies meet.

A shard sorts its suffixes by Larsson-Sadakane refinement to a window's length, no
further; neighbours that it leaves in one group share that length, so they are equal
windows, and all but the first repeat. If an anchor also occurs outside the shard, the
windows left under it go on, sorted, to where all shards' windows of one content meet,
and are merged by binary search.
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

WINDOW = 100
GRAM = 32
#: Strings of GRAM bytes in a window.
_SPAN = WINDOW - GRAM + 1
#: Bytes of text that one shard sorts at once; the regions of one anchor past it are split.
SHARD_BYTES = 3 << 20
#: Bytes from which whole small shards are no longer sorted with further ones.
_TOGETHER = 1 << 20
#: Bytes of text whose anchors are taken at once.
_BLOCK = 1 << 20
#: Positions whose numbers stay in a processor's cache from one pass over them to the next.
_PIECE = 1 << 15
_MAX = np.uint64(2**64 - 1)


# ---- anchors ---------------------------------------------------------------


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number."""
    two = data[:-1].astype(np.uint64) << np.uint64(8) | data[1:]
    four = two[:-2] << np.uint64(16) | two[2:]
    return four[:-4] << np.uint64(32) | four[4:]


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position."""
    word = _words(data)
    n = len(data) - GRAM + 1
    mixed = word[:n] * np.uint64(0x9E3779B97F4A7C15)
    for i, odd in ((8, 0xC2B2AE3D27D4EB4F), (16, 0x165667B19E3779F9), (24, 0xD6E8FEB86659FD93)):
        mixed ^= mixed >> np.uint64(29)
        mixed += word[i : i + n]
        mixed *= np.uint64(odd)
    mixed ^= mixed >> np.uint64(32)
    return np.minimum(mixed, _MAX - np.uint64(1))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over each run of ``width`` values."""
    done = 1
    while 2 * done <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return pick(values[:-rest], values[rest:]) if rest else values


def _no_window(lengths: np.ndarray) -> np.ndarray:
    """Positions of texts one after another from which no window fits."""
    ends = np.cumsum(lengths)
    over = np.minimum(lengths, WINDOW - 1)
    return np.repeat(ends - over - (np.cumsum(over) - over), over) + np.arange(over.sum())


def window_anchors(
    data: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the windows of texts that lie one after another in ``data``.

    The first array has the anchor of the window from each position, the highest number
    where none starts; then the positions whose hash is the anchor of some window, and
    those hashes.
    """
    n = len(data)
    anchor = np.full(n, _MAX)
    if n < WINDOW:
        return anchor, np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = np.empty(n - GRAM + 1, np.uint64)
    for a in range(0, len(hashes), _PIECE):
        hashes[a : a + _PIECE] = _gram_hashes(data[a : a + _PIECE + GRAM - 1])
    # The anchors between windows before and after all others, 0 where there are none.
    starts = np.zeros(len(hashes) + _SPAN - 1, np.uint64)
    low = starts[_SPAN - 1 : len(starts) - _SPAN + 1]
    for a in range(0, len(low), _PIECE):
        low[a : a + _PIECE] = _sliding(hashes[a : a + _PIECE + _SPAN - 1], _SPAN, np.minimum)
    bad = _no_window(lengths)
    anchor[: len(low)] = low
    anchor[bad] = _MAX
    low[bad[bad < len(low)]] = 0
    spots = []
    for a in range(0, len(hashes), _PIECE):
        # The highest anchor of the windows around a position.
        high = _sliding(starts[a : a + _PIECE + _SPAN - 1], _SPAN, np.maximum)
        spots.append(np.flatnonzero(hashes[a : a + _PIECE] == high) + a)
    at = np.concatenate(spots)
    return anchor, at, hashes[at]


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rows of a batch with their bytes in one array and the length of each, by blocks."""
    values = batch.column(column).cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset :][: len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)
    a = 0
    while a < len(values):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + _BLOCK)))
        b = min(b, len(values))
        yield slice(a, b), data[offsets[a] : offsets[b]], np.diff(offsets[a : b + 1])
        a = b


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor) once for each place of it in the rows (text)."""
    for batch in batches:
        for _, data, lengths in _texts(batch, 0):
            _, _, found = window_anchors(data, lengths)
            if len(found):
                yield pa.RecordBatch.from_arrays([_signed(found)], ["anchor"])


def _anchors_by_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, doc_id, text_hash) of the rows (doc_id, text_hash, text), once a row."""
    for batch in batches:
        for rows, data, lengths in _texts(batch, 2):
            _, places, found = window_anchors(data, lengths)
            if not len(places):
                continue
            row = np.searchsorted(np.cumsum(lengths), places, side="right")
            # Like anchors of a row come together, in no order else.
            order = np.argsort(found + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            row, found = row[order], found[order]
            new = np.append(True, (row[1:] != row[:-1]) | (found[1:] != found[:-1]))
            taken = pa.array(row[new] + rows.start)
            yield pa.RecordBatch.from_arrays(
                [_signed(found[new]), batch.column(0).take(taken), batch.column(1).take(taken)],
                ["anchor", "doc_id", "text_hash"],
            )


# ---- regions ---------------------------------------------------------------

_REGION = (
    "key long, doc_id long, text_hash long, start int, data binary,"
    " anchors array<long>, counts array<int>"
)


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-last index of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _covered(
    starts: np.ndarray, ends: np.ndarray, rows: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Bytes covered by the windows of runs of window starts, as spans that do not touch in a row."""
    ends = ends + WINDOW - 1
    if not len(starts):
        return starts, ends
    apart = np.append(True, (starts[1:] > ends[:-1]) | (rows[1:] != rows[:-1]))
    last = np.append(np.flatnonzero(apart)[1:] - 1, len(starts) - 1)
    return starts[apart], ends[last]


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The regions of the rows (doc_id, text_hash, text, anchors, counts)."""
    for batch in batches:
        for rows, data, lengths in _texts(batch, 2):
            listed = batch.column(3).slice(rows.start, rows.stop - rows.start).flatten()
            counted = batch.column(4).slice(rows.start, rows.stop - rows.start).flatten()
            # An anchor that repeats for one row repeats for all of them.
            known, at = np.unique(listed.to_numpy().view(np.uint64), return_index=True)
            number = counted.to_numpy()[at]
            anchor, _, _ = window_anchors(data, lengths)
            # Windows one after another that have one anchor; texts end where none starts.
            first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
            past = np.append(first[1:], len(anchor))
            at = np.minimum(np.searchsorted(known, anchor[first]), len(known) - 1)
            inside = known[at] == anchor[first]
            first, past, at = first[inside], past[inside], at[inside]
            stops = np.cumsum(lengths)
            row = np.searchsorted(stops, first, side="right")
            starts, ends = _covered(first, past, row)
            # The anchors of each region, once each and the lowest first.
            region = np.searchsorted(starts, first, side="right") - 1
            own = np.unique(region * len(known) + at)
            region, own = own // len(known), own % len(known)
            ranges = pa.array(np.searchsorted(region, np.arange(len(starts) + 1)), pa.int32())
            row = np.searchsorted(stops, starts, side="right")
            taken = pa.array(row + rows.start)
            texts = [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(known[own[ranges.to_numpy()[:-1]]]),
                    batch.column(0).take(taken),
                    batch.column(1).take(taken),
                    pa.array((starts - (stops - lengths)[row]).astype(np.int32)),
                    pa.array(texts, pa.binary()),
                    pa.ListArray.from_arrays(ranges, _signed(known[own])),
                    pa.ListArray.from_arrays(ranges, pa.array(number[own].astype(np.int32))),
                ],
                ["key", "doc_id", "text_hash", "start", "data", "anchors", "counts"],
            )


# ---- suffix arrays ---------------------------------------------------------


def _sorted_with_places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys, of ``bits`` bits, in order, and the place of each before; equal ones in order.

    Numbers that hold key and place are sorted faster than places by their keys.
    """
    low = len(keys).bit_length()
    if bits + low > 64:
        place = np.argsort(keys, kind="stable")
        return keys[place], place
    both = keys << np.uint64(low)
    both |= np.arange(len(keys), dtype=np.uint64)
    both.sort()
    place = (both & np.uint64((1 << low) - 1)).view(np.int64)
    both >>= np.uint64(low)
    return both, place


def _refined(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions sorted by ``depth`` bytes from each, by refinement of groups.

    Groups of suffixes alike in their first h bytes are sorted by the rank of the suffix h
    bytes on, which makes them alike in 2h, or fewer bytes on where ``depth`` ends before;
    suffixes alone in their group are done. Past the end every byte counts as zero. Also
    returns the places in that order whose suffix is not alone, and the group of each.
    Positions of a group ascend.
    """
    n = len(data)
    bits = n.bit_length()
    h = min((64 - bits) // 8, depth)
    word = _words(np.append(data, np.zeros(8, np.uint8)))[:n]
    first, order = _sorted_with_places(word >> np.uint64(64 - 8 * h), 8 * h)
    start = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
    size = np.diff(np.append(start, n))
    rank = np.empty(n + 1, np.int64)
    rank[order] = np.repeat(start + 1, size)
    rank[n] = 0
    del first, word
    open_ = np.flatnonzero(np.repeat(size > 1, size))
    group = np.repeat(start, size)[open_]
    while h < depth and len(open_):
        step = min(h, depth - h)
        at = order[open_]
        number = np.cumsum(np.append(False, group[1:] != group[:-1]))
        key = number << bits | rank[np.minimum(at + step, n)]
        wide = int(number[-1]).bit_length() + bits
        key, new = _sorted_with_places(key.view(np.uint64), wide)
        at = at[new]
        order[open_] = at
        first_of = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        count = np.diff(np.append(first_of, len(at)))
        # A group's rank is the place of its first member in the whole order.
        group = np.repeat(open_[first_of], count)
        rank[at] = group + 1
        several = np.repeat(count > 1, count)
        open_, group = open_[several], group[several]
        h += step
    return order, open_, group


def suffix_array(data: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """Positions sorted by ``depth`` bytes from each; past the end every byte counts as zero."""
    return _refined(data, depth)[0]


def common_prefixes(data: np.ndarray, order: np.ndarray, limit: int = WINDOW) -> np.ndarray:
    """Length, up to ``limit``, that each suffix of the order shares with the one before it.

    By Kasai's rule the length falls by one at most from a position to the next, if the
    neighbour's next suffix still comes before; in an order of limited depth it may not,
    and the comparison starts anew. Positions are walked in many strides at once. For orders
    of any depth; ``repeated_windows`` has its groups from the refinement itself.
    """
    n = len(data)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = n
    place = np.empty(n + 1, np.int64)
    place[order] = np.arange(n)
    place[n] = n
    # Eight bytes at a time, as numbers; past the end there is nothing to share.
    word = _words(np.append(data, np.zeros(limit + 16, np.uint8)))
    shared = np.zeros(n, np.int16)
    stride = 256
    lanes = np.arange(0, n, stride)
    length = np.zeros(len(lanes), np.int64)
    other = np.full(len(lanes), n)
    for step in range(min(stride, n)):
        at = lanes + step
        if at[-1] >= n:
            lanes, at, length, other = lanes[:-1], at[:-1], length[:-1], other[:-1]
        holds = place[np.minimum(other + 1, n)] < place[at]
        length = np.where(holds, np.maximum(length - 1, 0), 0)
        other = before[at]
        length[other == n] = 0
        going = np.flatnonzero((length < limit) & (other < n))
        while len(going):
            a, b = at[going] + length[going], other[going] + length[going]
            differ = word[a] ^ word[b]
            equal = np.full(len(going), 8)
            some = differ != 0
            # Leading bytes alike in words that differ: those below the highest set bit.
            equal[some] = (64 - np.frexp(differ[some].astype(np.float64))[1]) // 8
            length[going] += equal
            going = going[~some & (length[going] < limit)]
        length = np.minimum(length, np.minimum(limit, n - np.maximum(at, other)))
        length = np.maximum(length, 0)
        shared[at] = length
    return shared[order]


def repeated_windows(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For texts one after another, in order: does the window from each position repeat an earlier one?"""
    n = len(data)
    order, open_, group = _refined(data, WINDOW)
    at = order[open_]
    starts_none = np.zeros(n, bool)
    starts_none[_no_window(lengths)] = True
    whole_window = ~starts_none[at]
    at, group = at[whole_window], group[whole_window]
    later = np.append(False, group[1:] == group[:-1]) if len(at) else np.empty(0, bool)
    repeats = np.zeros(n, bool)
    repeats[at[later]] = True
    return repeats


# ---- shards ----------------------------------------------------------------

_FOUND = "part long, doc_id long, text_hash long, start int, stop int, data binary"


def _found(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        ["part", "doc_id", "text_hash", "start", "stop", "data"],
    )


def _in_order(doc, text_hash, start) -> tuple:
    """Sort key of a place in the corpus; rows without a doc_id come last."""
    return (doc is None, doc or 0, text_hash, start)


def _solve(rows: list[tuple]) -> Iterator[tuple]:
    """Spans that repeat within a shard (no data), and windows that others may repeat.

    ``rows`` are (key, doc_id, text_hash, start, data, anchors, counts). A region that is
    a whole copy of an earlier one repeats in every window and is not sorted again.
    """
    rows.sort(key=lambda r: _in_order(*r[1:4]))
    places = [r[1:4] for r in rows]
    rows = [r for i, r in enumerate(rows) if i == 0 or places[i] != places[i - 1]]
    copies: dict[bytes, int] = {}
    for _, doc, text_hash, start, text, *_ in rows:
        copies[text] = copies.get(text, 0) + 1
        if copies[text] > 1:
            yield None, doc, text_hash, start, start + len(text), None
    first: dict[bytes, tuple] = {}
    for row in rows:
        first.setdefault(row[4], row)
    rows = list(first.values())
    times = np.array([copies[r[4]] for r in rows])
    data = np.frombuffer(b"".join(r[4] for r in rows), np.uint8)
    lengths = np.array([len(r[4]) for r in rows])
    begin = np.cumsum(lengths) - lengths
    repeats = repeated_windows(data, lengths)
    anchor, spots, here = window_anchors(data, lengths)
    known, at = np.unique(
        np.concatenate([r[5] for r in rows]).view(np.uint64), return_index=True
    )
    number = np.concatenate([r[6] for r in rows])[at]
    # Places of each anchor in this shard against those in the corpus.
    at = np.minimum(np.searchsorted(known, here), len(known) - 1)
    mine = known[at] == here
    weight = times[np.searchsorted(begin, spots[mine], side="right") - 1]
    local = np.bincount(at[mine], weights=weight, minlength=len(known))
    shared = known[local < number]
    row_of = lambda x: np.searchsorted(begin, x, side="right") - 1
    x, y = _runs(repeats)
    for i, a, b in zip(*(v.tolist() for v in (row_of(x), x, y)), strict=True):
        _, doc, text_hash, start, *_ = rows[i]
        at_ = start - int(begin[i])
        yield None, doc, text_hash, a + at_, b + at_ + WINDOW - 1, None
    if not len(shared):
        return
    at = np.minimum(np.searchsorted(shared, anchor), len(shared) - 1)
    elsewhere = np.flatnonzero((shared[at] == anchor) & ~repeats)
    text = data.tobytes()
    for part, i, p, q in _parts(text, anchor, elsewhere, spots, here, row_of(elsewhere)):
        _, doc, text_hash, start, *_ = rows[i]
        at_ = start - int(begin[i])
        yield part, doc, text_hash, p + at_, q + at_, text[p : q + WINDOW - 1]


def _parts(text, anchor, windows, spots, hashes, rows) -> Iterator[tuple[int, int, int, int]]:
    """(part, row, first, past last) of runs of ``windows``: equal windows fall into equal parts.

    A window's part hashes its anchor and the half of it that the anchor is in, so that
    windows with one frequent anchor but different text around it do not meet.
    """
    if not len(windows):
        return
    # The first place of the anchor in each window, a function of the window alone.
    at = np.searchsorted(spots, windows)
    wrong = np.flatnonzero(hashes[at] != anchor[windows])
    while len(wrong):
        at[wrong] += 1
        wrong = wrong[hashes[at[wrong]] != anchor[windows[wrong]]]
    spot = spots[at]
    late = spot - windows >= _SPAN // 2
    new = (windows[1:] != windows[:-1] + 1) | (spot[1:] != spot[:-1])
    new |= (late[1:] != late[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(np.append(True, new))
    last = np.append(first[1:], len(windows)) - 1
    # Bytes that every window of a part holds, whichever windows those are.
    a = np.where(late[first], spot[first] - _SPAN // 2, spot[first])
    b = np.where(late[first], spot[first] + GRAM, spot[first] + WINDOW - _SPAN // 2 + 1)
    columns = (rows[first], windows[first], windows[last] + 1, a, b, late[first])
    for row, p, q, x, y, side in zip(*(c.tolist() for c in columns), strict=True):
        yield xxhash.xxh3_64_intdigest(text[x:y], int(side)) - (1 << 63), row, p, q


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column, none of them null."""
    values, edges = column.values.to_numpy(), column.offsets.to_pylist()
    return [values[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Solves rows (shard, region) that come sorted by shard, as many shards at once as fit."""
    rows: list[tuple] = []
    done, size, shard = 0, 0, None  # rows of whole shards, bytes held, the shard going on
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns[:6]] + [_lists(c) for c in batch.columns[6:]]
        for row in zip(*columns, strict=True):
            if row[0] != shard:
                if size >= min(SHARD_BYTES, _TOGETHER) and rows:
                    yield _found(list(_solve(rows)))
                    rows, size = [], 0
                shard = row[0]
            rows.append(row[1:])
            size += len(row[5])
    if rows:
        yield _found(list(_solve(rows)))


# ---- merging ---------------------------------------------------------------


def _window_hashes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of the window from each of the positions."""
    word = _words(np.append(data, np.zeros(8, np.uint8)))
    mixed = np.full(len(at), 0x27D4EB2F165667C5, np.uint64)
    for i in (*range(0, WINDOW - 8, 8), WINDOW - 8):
        mixed = (mixed ^ word[at + i]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def _same_windows(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the windows from positions ``a`` and ``b`` hold the same bytes."""
    word = _words(np.append(data, np.zeros(8, np.uint8)))
    same = np.ones(len(a), bool)
    for i in (*range(0, WINDOW - 8, 8), WINDOW - 8):
        same &= word[a + i] == word[b + i]
    return same


def later_windows(
    data: np.ndarray, at: np.ndarray, part: np.ndarray, rank: np.ndarray, size: np.ndarray
) -> np.ndarray:
    """Which of the windows repeat one of an earlier list of their part.

    A part has ``size`` lists, numbered by ``rank`` in the order of the corpus, without
    repetitions in a list. Lists are merged in pairs, then pairs of pairs: the windows of
    the second of each pair are looked up among the sorted ones of the first by binary
    search, for all parts at once. Hashes are searched and the bytes compared; should
    different bytes share a hash, the part's windows are searched for as bytes.
    """
    hashes = _window_hashes(data, at) ^ (part.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    late = np.zeros(len(at), bool)
    alive = np.arange(len(at))
    clash: set[int] = set()
    level = 0
    while True:
        alive = alive[(size[alive] > 1 << level) & ~late[alive]]
        if not len(alive):
            break
        one = rank[alive] >> level
        key = (hashes[alive] + (one >> 1).astype(np.uint64)) * np.uint64(0x165667B19E3779F9)
        key ^= key >> np.uint64(31)
        second = one & 1 == 1
        order = np.argsort(key[~second])
        first, sought = key[~second][order], key[second]
        if len(first) and len(sought):
            place = np.minimum(np.searchsorted(first, sought), len(first) - 1)
            hit = first[place] == sought
            a, b = alive[~second][order][place[hit]], alive[second][hit]
            same = _same_windows(data, at[a], at[b])
            late[b[same]] = True
            clash.update(part[b[~same]].tolist())
        level += 1
    for p in clash:
        seen: set[bytes] = set()
        for i in np.flatnonzero(part == p).tolist():
            window = data[at[i] : at[i] + WINDOW].tobytes()
            late[i] = window in seen
            seen.add(window)
    return late


def _compare(table: pa.Table) -> pa.RecordBatch:
    """Spans that repeat among the windows of several shards.

    The rows are whole parts as in ``_found``, in the order of the corpus within a part.
    """
    part = table.column(0).to_numpy()
    start, stop = table.column(3).to_numpy().astype(np.int64), table.column(4).to_numpy()
    windows = stop - start
    values = table.column(5).combine_chunks().cast(pa.large_binary())
    data = np.frombuffer(b"".join(values.to_pylist()), np.uint8)
    new = np.append(True, part[1:] != part[:-1])
    group = np.cumsum(new) - 1
    rank = np.arange(len(part)) - np.flatnonzero(new)[group]
    size = np.bincount(group)[group]
    row = np.repeat(np.arange(len(part)), windows)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    length = windows + WINDOW - 1
    at = (np.cumsum(length) - length)[row] + inside
    late = later_windows(data, at, group[row], rank[row], size[row])
    # Runs of late windows, cut between rows.
    begins = late & np.append(True, ~late[:-1] | (row[1:] != row[:-1]))
    ends = late & np.append(~late[1:] | (row[1:] != row[:-1]), True)
    x, y = np.flatnonzero(begins), np.flatnonzero(ends)
    rows = pa.array(row[x])
    first = start[row[x]]
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(len(x), pa.int64()),
            table.column(1).combine_chunks().take(rows),
            table.column(2).combine_chunks().take(rows),
            pa.array((first + inside[x]).astype(np.int32)),
            pa.array((first + inside[y] + WINDOW).astype(np.int32)),
            pa.nulls(len(x), pa.binary()),
        ],
        ["part", "doc_id", "text_hash", "start", "stop", "data"],
    )


def _merges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares rows (part, ...) that come sorted by part and corpus, whole parts at a time."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        part = held.column(0).to_numpy()
        if len(part) and part[0] != part[-1]:
            whole_parts = int(np.searchsorted(part, part[-1]))
            yield _compare(held.slice(0, whole_parts))
            held = held.slice(whole_parts)
    if held is not None and held.num_rows:
        yield _compare(held)


# ---- the operator ----------------------------------------------------------


def _text_hash(text: Column) -> Column:
    return F.xxhash64(whole(text)).alias("text_hash")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, spans): bytes that repeat earlier ones, for every row with any.

    ``spans`` are (start, stop) in UTF-8 bytes; they may overlap and are in no order. Rows
    alike in doc_id and text are one document. Earlier is a smaller doc_id, then a smaller
    text_hash, then an earlier start; rows without a doc_id come last. Null and short texts
    have no windows. Other columns are not read.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", _text_hash(F.col("text")), whole(F.col("text")).alias("text"))
    again = (
        rows.select("text")
        .mapInArrow(_anchors, "anchor long")
        .groupBy("anchor")
        .agg(F.count("*").cast("int").alias("n"))
        .filter(F.col("n") > 1)
    )
    by_row = (
        rows.mapInArrow(_anchors_by_row, "anchor long, doc_id long, text_hash long")
        .join(again, "anchor")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("anchor", "n")).alias("known"))
    )
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (
        F.col("a.text_hash") == F.col("b.text_hash")
    )
    regions = keep(
        rows.alias("a")
        .join(by_row.alias("b"), same)
        .select("a.doc_id", "a.text_hash", "a.text", "b.known.anchor", "b.known.n")
        .mapInArrow(_regions, _REGION),
        "regions",
    )
    shards = (
        regions.groupBy("key")
        .agg(F.sum(F.length("data")).alias("size"))
        .select("key", F.ceil(F.col("size") / SHARD_BYTES).cast("int").alias("split"))
        .filter(F.col("split") > 1)
    )
    place = F.pmod(F.xxhash64("doc_id", "text_hash", "start"), F.coalesce("split", F.lit(1)))
    found = keep(
        regions.join(shards, "key", "left")
        .select(F.xxhash64("key", place).alias("shard"), *regions.columns)
        .repartition("shard")
        .sortWithinPartitions("shard")
        .mapInArrow(_shards, _FOUND),
        "repeats",
    )
    met = F.count("*").over(W.partitionBy("part"))
    merged = (
        found.filter(F.col("part").isNotNull())
        .withColumn("met", met)
        .filter(F.col("met") > 1)
        .drop("met")
        .sortWithinPartitions("part", F.col("doc_id").asc_nulls_last(), "text_hash", "start")
        .mapInArrow(_merges, _FOUND)
    )
    spans = found.filter(F.col("part").isNull()).unionAll(merged)
    return spans.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")
    )


def removed_spans(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of bytes in any of the spans."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["stop"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, removed (maximal spans) and kept (the other bytes) of every row.

    Every byte inside a string of 100 bytes that also starts earlier goes; see
    ``repeated_spans``. A null text is empty.
    """
    rows = docs.select("doc_id", _text_hash(F.col("text")), whole(F.col("text")).alias("text"))
    spans = repeated_spans(docs)
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (
        F.col("a.text_hash") == F.col("b.text_hash")
    )
    joined = rows.alias("a").join(spans.alias("b"), same, "left").select("a.doc_id", "a.text", "b.spans")

    @F.arrow_udf("struct<removed:array<struct<start:int,stop:int>>,kept:binary>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        removed, kept = [], []
        for text, span in zip(texts, spans, strict=True):
            data = text.as_py().encode()
            gone = removed_spans(span.as_py() or [])
            edges = [0, *(e for pair in gone for e in pair), len(data)]
            removed.append([{"start": a, "stop": b} for a, b in gone])
            kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
        span_kind = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
        return pa.StructArray.from_arrays(
            [pa.array(removed, pa.list_(span_kind)), pa.array(kept, pa.binary())], ["removed", "kept"]
        )

    judged = joined.select(
        "doc_id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        cut.asNondeterministic()("text", "spans").alias("c"),
    )
    return judged.select("doc_id", "n_bytes", "c.removed", "c.kept")


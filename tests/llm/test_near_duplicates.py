"""SimHash, components, line templates and suffix arrays against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripmill.llm import components, lines, simhash, suffixes
from tripmill.llm.queries import REGISTERED

DOCS = "doc_id long, text string, fp string, text_hash string, spans string, n_chars long"


def frame(spark, rows):
    """Documents with extra columns named like the operators' own."""
    return spark.createDataFrame([(i, t, "x", "y", "z", len(t or "")) for i, t in rows], DOCS)


# ---- SimHash ----


def slow_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    runs = [" ".join(found[i : i + 4]) for i in range(max(1, len(found) - 3))] if found else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """Smallest id reachable for each (id, fingerprint)."""
    parent = {i: i for i in range(len(prints))}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 4:
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        least.setdefault(root(i), []).append(doc)
    return [min((d for d in least[root(i)] if d is not None), default=None) for i in range(len(prints))]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=300))
def test_fingerprint(text):
    assert simhash.fingerprint(text) % (1 << 64) == slow_fingerprint(text)


def test_simhash_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    prints = [(d["doc_id"], slow_fingerprint(d["text"])) for d in docs]
    want = {
        (i, f"{p:016x}", c) for (i, p), c in zip(prints, slow_components(prints), strict=True)
    }
    assert {tuple(r) for r in REGISTERED["op5_simhash"](spark, sf).collect()} == want


def test_links_of_random_fingerprints(spark):
    """Clusters around few centres, past the size of a block, and pairs at exactly four and five bits."""
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(6)]
    prints = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for c in centres for _ in range(80)}
    values = [int(np.uint64(p).astype(np.int64)) for p in sorted(prints)]
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    old, simhash.BLOCK = simhash.BLOCK, 5
    try:
        found = components.components(simhash.linked(fps)).collect()
    finally:
        simhash.BLOCK = old
    root = {r["u"]: r["v"] for r in found}
    want = slow_components([(v, v % (1 << 64)) for v in values])
    assert [root.get(v, v) for v in values] == want


def test_simhash_of_nulls_repeats_and_empties(spark):
    rows = [(3, None), (1, ""), (2, "  \n"), (2, "  \n"), (9, "one two three"), (9, "ONE two three"), (None, "z")]
    found = simhash.near_duplicates(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in found) == [
        (-1, -1), (1, 1), (2, 1), (2, 1), (3, 1), (9, 9), (9, 9),
    ]
    kept = simhash.keep_one(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "fp", "text_hash", "spans", "n_chars"]
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 9]
    assert simhash.near_duplicates(frame(spark, [])).collect() == []


def test_keep_one_of_rows_without_id_and_of_one_id_with_two_texts(spark):
    rng = random.Random(4)
    texts = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(60)) for _ in range(7)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2])]
    rows += [(1, texts[2]), (5, texts[3]), (5, texts[4]), (5, texts[4]), (4, texts[3]), (6, texts[5]), (6, texts[6])]
    kept = simhash.keep_one(frame(spark, rows)).collect()
    place = {t: i for i, t in enumerate(texts)}
    assert sorted((r["doc_id"] or 0, place[r["text"]]) for r in kept) == [
        (0, 0), (0, 1), (1, 2), (4, 3), (5, 4), (6, 5), (6, 6),
    ]


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, i) for i in range(100, 130)]
    links = spark.createDataFrame(chain + star + chain[:3], "a long, b long")
    root = {r["u"]: r["v"] for r in components.components(links).collect()}
    assert root == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in [*range(101, 130), 1000]}}


# ---- lines ----


def slow_groups(rows, placed):
    """The near-copy groups (lowest fingerprint) that hold a line which can need them."""
    texts, contexts, count, in_leaf, holders = dict(rows), {}, Counter(), Counter(), {}
    for doc, _, _, form, around in placed:
        contexts.setdefault(form, set()).add(around)
        holders.setdefault(form, set()).add(texts[doc])
        count[form] += 1
        in_leaf[len(form), form[:3]] += 1
    asked = {
        f
        for f, n in count.items()
        if (n > len(contexts[f]) and in_leaf[len(f), f[:3]] >= lines.RECURS)
        or (len(f) >= lines.LONG and n > 1)
    }
    prints = {t: simhash.fingerprint(t) for f in asked for t in holders[f]}
    root = {p: p for p in prints.values()}
    changed = True
    while changed:
        changed = False
        for p, q in itertools.combinations(root, 2):
            if ((p ^ q) & (2**64 - 1)).bit_count() <= 4 and root[p] != root[q]:
                root[p] = root[q] = min(root[p], root[q])
                changed = True
    return {f: {root[prints[t]] for t in holders[f]} for f in asked}


def slow_drops(rows):
    """Line numbers that go, by the rules of the template tree, for distinct (doc_id, text)."""
    placed = []
    for doc, text in rows:
        found = lines.text_lines(text or "")
        forms = [m for _, m in found]
        around = ["", *forms, ""]
        for k, (number, form) in enumerate(found):
            placed.append((doc, text, number, tuple(form.split(" ")), (around[k], around[k + 2])))
    contexts = {(p[3], p[4]) for p in placed}
    groups = slow_groups(rows, placed)
    leaf = lambda f: (len(f), f[:3])
    weight = Counter(form for form, _ in contexts)
    for form, roots in groups.items():
        weight[form] = max(weight[form], len(roots))
    in_leaf, seen = {}, Counter()
    for form, n in weight.items():
        in_leaf.setdefault(leaf(form), []).append(form)
        for at, token in enumerate(form):
            seen[leaf(form), at, token] += n
    template = {}
    for form in weight:
        template[form] = form
        members = in_leaf[leaf(form)]
        if sum(weight[m] for m in members) >= lines.RECURS and len(members) > 1:
            constant = [
                at < 3 or seen[leaf(form), at, token] >= lines.RECURS for at, token in enumerate(form)
            ]
            n = sum(c and t != lines.FIELD for c, t in zip(constant, form, strict=True))
            if lines.CONSTANT * len(form) <= n < len(form):
                template[form] = (
                    "general",
                    *(t if c else lines.FIELD for c, t in zip(constant, form, strict=True)),
                )
    first, where = {}, {}
    for p in sorted(placed, key=lambda p: (p[0], p[2])):
        t = template[p[3]]
        first.setdefault(t, (p[0], p[2]))
        where.setdefault(t, {}).setdefault(p[4], p[0])
    recurring = {t for t, c in where.items() if len(set(c.values())) >= lines.RECURS}
    apart = {}
    for form, roots in groups.items():
        apart.setdefault(template[form], set()).update(roots)
        far = any(
            ((p ^ q) & (2**64 - 1)).bit_count() >= lines.UNLIKE_BITS
            for p, q in itertools.combinations(roots, 2)
        )
        if len(form) >= lines.LONG and 1 < len(roots) < lines.RECURS and far:
            recurring.add(template[form])
    recurring |= {t for t, roots in apart.items() if len(roots) >= lines.RECURS}
    drops = {}
    for p in placed:
        if template[p[3]] in recurring and first[template[p[3]]] != (p[0], p[2]):
            drops.setdefault(p[0], set()).add(p[2])
    return drops


def test_lines_with_variable_fields(spark):
    rng = random.Random(3)
    words = [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    rows = []
    for i in range(40):
        own = [" ".join(rng.choices(words, k=9)) for _ in range(3)]
        own.insert(rng.randint(0, 3), f"Page {i} of the site shown at {i}:30 today for all readers")
        own.insert(rng.randint(0, 4), f"All rights are reserved by {rng.choice(words)} and its many good friends")
        rows.append((i, "\n".join(own)))
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, ""), (103, None), (104, "a\n\n\nb\n")]
    want = slow_drops(rows)
    found = lines.dropped_lines(frame(spark, rows)).collect()
    assert {r["doc_id"]: set(r["dropped"]) for r in found} == want
    assert sum(map(len, want.values())) >= 75  # both templates, but their first lines
    text = {r["doc_id"]: r["text"] for r in lines.report(frame(spark, rows)).collect()}
    for doc, before in rows:
        kept = before and "\n".join(x for k, x in enumerate(before.split("\n")) if k not in want.get(doc, ()))
        assert text[doc] == kept


def test_lines_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = slow_drops([(d["doc_id"], d["text"]) for d in docs])
    assert any(want.values())
    rows = {r["doc_id"]: r for r in REGISTERED["op4_template_tree"](spark, sf).collect()}
    assert len(rows) == len(docs)
    for d in docs:
        gone = want.get(d["doc_id"], set())
        kept = "\n".join(x for k, x in enumerate(d["text"].split("\n")) if k not in gone)
        row = rows[d["doc_id"]]
        assert row["n_dropped"] == len(gone)
        assert row["kept_sha256"] == hashlib.sha256(kept.encode()).hexdigest()


def test_a_long_line_in_two_unlike_documents(spark):
    """A passage of 60 words in unlike documents goes but for its first place; copies keep theirs."""
    rng = random.Random(12)
    own = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    passage, short = own(60), own(50)
    rows = [(i, "\n".join([own(90), passage, short, own(70)])) for i in range(4)]
    story = [own(80) for _ in range(4)]
    rows += [(10, "\n".join(story)), (11, "\n".join(story)), (12, "\n".join([*story[:3], story[3] + " end"]))]
    found = {r["doc_id"]: set(r["dropped"]) for r in lines.dropped_lines(frame(spark, rows)).collect()}
    assert found == {1: {1}, 2: {1}, 3: {1}} == slow_drops(rows)


def test_a_text_of_very_many_lines(spark):
    import time

    rng = random.Random(13)
    numbers = list(range(200_000))
    text = "\n".join(f"line {i}" for i in numbers)
    gone = sorted(rng.sample(numbers, 100_000))
    df = spark.createDataFrame([(text, gone), (text, None), ("a\nb", [1]), ("a\nb", [0]), ("a", [0])], "text string, gone array<int>")
    begun = time.perf_counter()
    got = [r[0] for r in df.select(lines.kept_text(F.col("text"), F.col("gone"))).collect()]
    assert time.perf_counter() - begun < 5
    kept = set(numbers) - set(gone)
    assert got == ["\n".join(f"line {i}" for i in numbers if i in kept), text, "a", "b", ""]


def test_copies_do_not_make_templates_of_their_own_text(spark):
    text = "first line of a story\nsecond line of a story\nthird line of a story"
    kept = lines.dedup_lines(frame(spark, [(i, text) for i in range(30)])).collect()
    assert len(kept) == 30 and {r["text"] for r in kept} == {text}


def test_inner_lines_of_a_block_in_unlike_documents(spark):
    """A four-line block in the middle, a footer of three lines with a field, one group of copies."""
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(400)]
    own = lambda n: " ".join(rng.choices(words, k=n))
    block = ["this is the licence", "it has an inner line", "and one more of them", "here it ends"]
    names = [own(1) for _ in range(3)]
    rows = []
    for i in range(12):
        foot = ["about this site", f"all rights are reserved by the good company {names[i % 3]}", "last line"]
        rows.append((i, "\n".join([own(40), *block, own(40), *foot])))
    copied = [own(12) for _ in range(6)]
    rows += [(100 + i, "\n".join(copied)) for i in range(9)]
    found = {r["doc_id"]: set(r["dropped"]) for r in lines.dropped_lines(frame(spark, rows)).collect()}
    assert found == {i: {1, 2, 3, 4, 6, 7, 8} for i in range(1, 12)}


def test_lines_of_numbers_are_no_template(spark):
    """Rows of a table differ in their values; one equal row in unlike documents recurs."""
    rng = random.Random(6)
    own = lambda: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(30))
    data = lambda i: [f"{i} {i + 1} {i + 2}", f"2023-01-{i}", f"v1.{i} 20{i}", "7 8 9"]
    rows = [(i, "\n".join([own(), *data(i), own()])) for i in range(10, 22)]
    rows += [(100 + i, f"{i}00 {i}01 {i}02") for i in range(8)]
    found = {r["doc_id"]: set(r["dropped"]) for r in lines.dropped_lines(frame(spark, rows)).collect()}
    assert found == {i: {4} for i in range(11, 22)}


def test_emptied_documents_go_and_columns_stay(spark):
    rows = [(i, f"story {chr(97 + i)} x y z {chr(97 + i)}\nthe same old footer line") for i in range(8)]
    rows += [(50, "the same old footer line"), (51, None), (51, None), (None, " ")]
    docs = frame(spark, rows)
    kept = {r["doc_id"]: r for r in lines.dedup_lines(docs).collect()}
    assert 50 not in kept and kept[51]["text"] is None and kept[None]["text"] == " "
    assert kept[0]["text"] == rows[0][1] and kept[1]["text"] == "story b x y z b"
    assert kept[1]["n_chars"] == 15 and kept[1]["text_hash"] == "y"
    assert lines.report(frame(spark, [])).collect() == []


# ---- suffix arrays ----


def slow_removed(rows):
    """Bytes that go, for (doc_id, text) in order."""
    seen, out = set(), []
    for _, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            window = data[p : p + 100]
            if window in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(window)
        out.append(bytes(b for b, g in zip(data, gone, strict=True) if not g))
    return out


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abé", max_size=500), max_size=4), st.integers(0, 3))
def test_repeated_windows_in_one_shard(texts, copies):
    texts = texts + texts[:copies]
    data = [t.encode() for t in texts]
    if not any(data):
        return
    flat = np.frombuffer(b"".join(data), np.uint8)
    lengths = np.array([len(d) for d in data])
    found = suffixes.repeated_windows(flat, lengths)
    seen, want = set(), []
    for d in data:
        for p in range(len(d)):
            window = d[p : p + 100]
            want.append(len(window) == 100 and window in seen)
            seen.add(window if len(window) == 100 else None)
    assert found.tolist() == want


def test_suffix_array_and_common_prefixes():
    data = np.frombuffer(b"abracadabra" * 30 + b"banana" * 20, np.uint8)
    order = suffixes.suffix_array(data, depth=512)
    text = data.tobytes()
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    shared = suffixes.common_prefixes(data, order, limit=50)
    for k in range(1, len(order)):
        a, b = text[order[k - 1] :], text[order[k] :]
        n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert shared[k] == min(n, 50)


@pytest.mark.parametrize("piece", [1, 64, 1 << 15])
def test_anchors_taken_by_pieces(piece, monkeypatch):
    monkeypatch.setattr(suffixes, "_PIECE", piece)
    rng = random.Random(piece)
    texts = [bytes(rng.choices(b"ab", k=n)) for n in (0, 99, 100, 300, 31, 180)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts])
    anchor, spots, found = suffixes.window_anchors(data, lengths)
    hashes = suffixes._gram_hashes(data).tolist()
    want, places, begin = [], set(), 0
    for n in lengths.tolist():
        for p in range(begin, begin + n):
            around = hashes[p : p + 69] if p + 100 <= begin + n else [2**64 - 1]
            want.append(min(around))
            if len(around) > 1:
                places.update(q for q in range(p, p + 69) if hashes[q] == min(around))
        begin += n
    assert anchor.tolist() == want
    assert spots.tolist() == sorted(places)
    assert found.tolist() == [hashes[q] for q in sorted(places)]


def test_groups_of_the_order_are_the_equal_windows(monkeypatch):
    """Suffixes are sorted by a window's length, so no neighbours are compared after it."""
    monkeypatch.delattr(suffixes, "common_prefixes")
    rng = random.Random(3)
    passage = bytes(rng.choices(b"abc", k=130))
    texts = [passage[:99] + b"d", passage, passage[1:101] + b"e", passage[30:] + passage, b"a" * 260]
    data = np.frombuffer(b"".join(texts), np.uint8)
    order, places, group = suffixes._refined(data, 100)
    text = data.tobytes().ljust(len(data) + 100, b"\0")
    window = [text[i : i + 100] for i in order.tolist()]
    assert window == sorted(window)
    times = Counter(window)
    valid = [k for k, i in enumerate(order.tolist()) if i + 100 <= len(data)]
    assert [k for k in places.tolist() if order[k] + 100 <= len(data)] == [k for k in valid if times[window[k]] > 1]
    assert [window[k] for k in group.tolist()] == [window[k] for k in places.tolist()]
    lengths = np.array([len(t) for t in texts])
    repeats, seen, begin = suffixes.repeated_windows(data, lengths), set(), 0
    for n in lengths.tolist():
        for p in range(begin, begin + n):
            whole = p + 100 <= begin + n
            assert repeats[p] == (whole and text[p : p + 100] in seen)
            seen.update([text[p : p + 100]] * whole)
        begin += n


@pytest.mark.parametrize("bits", [3, 40, 63])
def test_keys_sorted_with_their_places(bits):
    """With 63 bits a key and its place do not fit into one number."""
    rng = np.random.default_rng(bits)
    keys = rng.integers(0, 1 << bits, 50, np.uint64).repeat(3)[rng.permutation(150)]
    want = np.argsort(keys, kind="stable")
    found, place = suffixes._sorted_with_places(keys, bits)
    assert place.tolist() == want.tolist() and found.tolist() == keys[want].tolist()


def test_small_shards_are_sorted_a_megabyte_at_once(monkeypatch):
    sorted_at_once = []
    solve = suffixes._solve
    monkeypatch.setattr(
        suffixes, "_solve", lambda rows: sorted_at_once.append(sum(len(r[4]) for r in rows)) or solve(rows)
    )
    rng = np.random.default_rng(1)
    rows = [rng.integers(0, 256, 50_000, np.uint8).tobytes() for _ in range(80)]
    n = len(rows)
    batch = suffixes.pa.RecordBatch.from_pydict(
        {
            "shard": list(range(n)),
            "key": [0] * n,
            "doc_id": list(range(n)),
            "text_hash": [0] * n,
            "start": [0] * n,
            "data": rows,
            "anchors": suffixes.pa.array([[1]] * n, suffixes.pa.list_(suffixes.pa.int64())),
            "counts": suffixes.pa.array([[2]] * n, suffixes.pa.list_(suffixes.pa.int32())),
        }
    )
    # The second batch starts inside its lists' values, as a slice does.
    list(suffixes._shards(iter([batch.slice(0, 45), batch.slice(45)])))
    assert sum(sorted_at_once) == 4_000_000 and max(sorted_at_once) < (1 << 20) + 50_000


@pytest.mark.parametrize("shard_bytes", [suffixes.SHARD_BYTES, 700])
def test_repeats_across_documents_and_shards(spark, shard_bytes, monkeypatch):
    rng = random.Random(9)
    letters = "abcdefghij é"
    passages = ["".join(rng.choices(letters, k=rng.randint(90, 260))) for _ in range(5)]
    rows = []
    for i in range(40):
        parts = ["".join(rng.choices(letters, k=rng.randint(0, 150)))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), "".join(rng.choices(letters, k=rng.randint(0, 80)))]
        rows.append((i, "".join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1] + "x"), (102, "q" * 400), (103, None), (104, "")]
    rows += [(105, "ab" * 300), (106, "\x00" * 150), (107, "\x00" * 150)]
    monkeypatch.setattr(suffixes, "SHARD_BYTES", shard_bytes)
    found = suffixes.without_repeats(frame(spark, rows)).collect()
    kept = {r["doc_id"]: bytes(r["kept"]) for r in found}
    assert [kept[i] for i, _ in rows] == slow_removed(rows)
    for r in found:
        spans = [(s["start"], s["stop"]) for s in r["removed"]]
        assert all(b < c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))
        assert r["n_bytes"] - sum(b - a for a, b in spans) == len(kept[r["doc_id"]])


def test_repeated_rows_are_one_document(spark):
    text = "".join(chr(97 + (i * i) % 23) for i in range(300))
    rows = [(1, text), (1, text), (2, text), (None, text), (None, "short")]
    found = suffixes.without_repeats(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, len(r["kept"])) for r in found) == sorted(
        [(1, len(slow_removed([(1, text)])[0]))] * 2 + [(2, 0), (0, 0), (0, 5)]
    )
    assert suffixes.without_repeats(frame(spark, [])).collect() == []


def test_suffix_query(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    kept = slow_removed([(d["doc_id"], d["text"]) for d in docs])
    rows = {r["doc_id"]: r for r in REGISTERED["op9_suffix_arrays"](spark, sf).collect()}
    for d, rest in zip(docs, kept, strict=True):
        row = rows[d["doc_id"]]
        assert row["kept_sha256"] == hashlib.sha256(rest).hexdigest()
        assert row["n_bytes"] - row["n_removed"] == len(rest)


@pytest.mark.parametrize("clash", [False, True])
def test_merging_lists_by_binary_search(clash, monkeypatch):
    """Up to 40 lists a part; with ``clash`` all hashes of a part are equal."""
    rng = random.Random(7)
    if clash:
        monkeypatch.setattr(
            suffixes, "_window_hashes", lambda data, at: np.full(len(at), 5, np.uint64)
        )
    pool = [bytes(rng.choices(b"ab", k=100)) for _ in range(12)]
    data, at, part, rank, size, want = b"", [], [], [], [], []
    for p in range(5):
        n, seen = rng.choice([1, 2, 3, 9, 40]), set()
        for r in range(n):
            chosen = rng.sample(pool, rng.randint(1, 5))
            for window in chosen:
                at.append(len(data))
                part.append(p)
                rank.append(r)
                size.append(n)
                want.append(window in seen)
                data += window
            seen.update(chosen)
    found = suffixes.later_windows(
        np.frombuffer(data, np.uint8), *(np.array(x, np.int64) for x in (at, part, rank, size))
    )
    assert found.tolist() == want

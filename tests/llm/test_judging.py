"""Language, toxicity and contamination against brute force and held-out rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from checks.compare import plain
from tripmill.llm import decontaminate, language, toxicity
from tripmill.llm.oracle import ORACLE
from tripmill.llm.queries import REGISTERED


def same_as_sql(spark, db, sf, name):
    frame = REGISTERED[name](spark, sf)
    columns = sorted(frame.columns)
    mine = sorted([plain(v) for v in row] for row in frame.select(columns).collect())
    result = db.execute(ORACLE[name])
    order = [[d[0] for d in result.description].index(c) for c in columns]
    assert mine == sorted([plain(row[i]) for i in order] for row in result.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_with_sql(spark, db, sf, name):
    same_as_sql(spark, db, sf, name)


# ---- language ----


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 20])
def test_codewords_are_apart(n):
    codes = language.codewords(n)
    gaps = [(codes[i] != codes[j]).sum() for i in range(n) for j in range(i)]
    assert min(gaps) >= max(1, codes.shape[1] // 2 - (n > 6))
    columns = {tuple(c if c[0] > 0 else -c) for c in codes.T}
    assert len(columns) == codes.shape[1] and not any((c == c[0]).all() for c in codes.T)


def test_decoding_corrects_a_wrong_bit():
    codes = language.codewords(4)
    even = np.full(codes.shape, 1 / codes.shape[1])
    model = language.LanguageModel(["a", "b", "c", "d"], np.zeros((1, 7)), codes, even)
    for i in range(4):
        for bit in range(7):
            margins = codes[i].astype(float)
            margins[bit] *= -1
            assert model.decode(margins).argmax() == i


def test_language_of_held_out_rows(spark):
    found = REGISTERED["op3_output_codes"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = found.join(docs, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows} == {True}
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


LANG = "doc_id long, text string, lang string, lang_pred string, source string"


def test_language_of_odd_rows(spark):
    texts = {"en": "the cat and the dog", "fr": "le chat et le chien", "xx": "zq zq qzz qzq"}
    rows = [(i, f"{texts[k]} {i}", k, "?", "s") for i in range(60) for k in texts]
    rows += [(900, None, "en", "?", "s"), (901, "", "en", "?", "s"), (902, "123 -- 4", None, "?", "s")]
    rows += [(None, "le chien", "en", "?", "s"), (903, "the dog " * 60_000, None, "?", "s"), (904, "É", None, "?", "s")]
    docs = spark.createDataFrame(rows, LANG)
    got = language.predict(docs, language.fit(docs)).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows)
    assert [by_id[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3
    assert by_id[None]["lang_pred"] == "fr" and by_id[903]["lang_pred"] == "en"
    assert by_id[904]["lang_pred"] in texts
    kept = {r["doc_id"]: r["lang_pred"] for r in got if r["doc_id"] is not None and r["doc_id"] < 60}
    assert set(kept.values()) <= set(texts)


def test_language_without_or_with_one_label(spark):
    rows = [(i, "some text", None, "?", "s") for i in range(8)]
    docs = spark.createDataFrame(rows, LANG)
    got = language.predict(docs, language.fit(docs)).collect()
    assert {(r["lang_pred"], r["lang_score"]) for r in got} == {("und", 0.0)}
    one = docs.withColumn("lang", F.lit("en"))
    assert {r["lang_pred"] for r in language.predict(one, language.fit(one)).collect()} == {"en"}
    none = docs.limit(0)
    assert language.predict(none, language.fit(none)).collect() == []


# ---- toxicity ----


def slow_segments(hits, gap):
    """Maximal segments by their definition: the best of the range, then of both sides."""
    scores = dict(hits)
    n = max(scores, default=-1) + 1
    values = [scores.get(i, -gap) for i in range(n)]

    def split(a, b):
        best = max(
            ((sum(values[i:j]), i - j, i, j) for i in range(a, b) for j in range(i + 1, b + 1)),
            default=(0, 0, 0, 0),
        )
        if best[0] <= 0:
            return []
        _, _, i, j = best
        return [*split(a, i), (best[0], i, j - 1), *split(j, b)]

    return split(0, n)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(0, 18), st.sampled_from([0.25, 0.75, 1.0, 2.0, 3.5]), max_size=8))
def test_maximal_segments(scores):
    hits = sorted(scores.items())
    found = toxicity.maximal_segments(hits, 0.5)
    want = slow_segments(hits, 0.5)
    assert sum(s for s, _, _ in found) == pytest.approx(sum(s for s, _, _ in want))
    assert max(found, default=(0,))[0] == pytest.approx(max(want, default=(0,))[0])
    assert all(a <= b for _, a, b in found)
    assert all(x[2] < y[1] for x, y in zip(found, found[1:], strict=False))


def test_toxicity_of_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = REGISTERED["op7_toxic_segments"](spark, sf).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in rows)
    hits = sum(r["predicted"] and r["toxic"] for r in held)
    assert hits >= 0.8 * sum(r["toxic"] for r in held)
    assert hits >= 0.95 * sum(r["predicted"] for r in held)


def test_toxicity_of_odd_rows(spark):
    rng = random.Random(2)
    mild = ["".join(rng.choices("aeioulmnrst", k=rng.randint(2, 9))) for _ in range(300)]
    rows, marks = [], []
    for i in range(400):
        text = rng.choices(mild, k=60)
        if i % 4 == 0:
            for at in rng.sample(range(60), 5):
                text[at] = rng.choice(["vileword", "badword"])
        rows.append((i, " ".join(text), "?"))
        marks.append((i, 1, int(i % 4 == 0)))
    rows += [(900, None, "?"), (901, "", "?"), (902, "!!! 12", "?"), (None, "badword " * 9, "?")]
    rows += [(903, f"{mild[0]} {mild[1]} " * 40_000 + "badword vileword badword vileword badword", "?"), (0, rows[0][1], "?")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame(marks + [(1, 1, 0), (None, 1, 1), (901, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    score = {r["doc_id"]: r["score"] for r in got}
    assert all((score[i] >= 0.7) == (i % 4 == 0) for i in range(400))
    assert max(score[i] for i in (900, 901, 902)) < 0.5 < min(score[None], score[903])
    passage = next(r for r in got if r["doc_id"] == 903)["passages"][0]
    assert passage["first"] == 80_000 and passage["last"] == 80_004
    nothing = toxicity.fit(docs, labels.limit(0))
    assert max(r["score"] for r in toxicity.score(docs, nothing).collect()) < 0.7
    assert toxicity.score(docs.limit(0), model).collect() == []


@pytest.mark.parametrize("share", [0.03, 0.5, 0.9])
@pytest.mark.parametrize("fit_rows", [24_000, 1_500])
def test_toxicity_whatever_the_share_of_toxic_rows(spark, monkeypatch, share, fit_rows):
    """With every labelled row, and with a bound on them that binds."""
    monkeypatch.setattr(toxicity, "FIT_ROWS", fit_rows)
    rng = random.Random(5)
    mild = ["".join(rng.choices("aeioulmnrst", k=rng.randint(2, 9))) for _ in range(2_000)]
    vile = ["vileword", "badword", "scumling", "rotface"]
    rows, marks = [], []
    for i in range(6_000):
        toxic = rng.random() < share
        text = rng.choices(mild, k=70)
        for at in rng.sample(range(70), 6 if toxic else 0):
            text[at] = rng.choice(vile)
        rows.append((i, " ".join(text)))
        marks.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    assert {f"{w}$" for w in vile} <= set(model.lexicon)
    score = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [(score[i] >= 0.7, t) for i, t in marks if zlib.crc32(str(i).encode()) % 3 == 1]
    hits = sum(said and toxic for said, toxic in held)
    assert hits >= 0.9 * sum(t for _, t in held)
    assert hits >= 0.95 * sum(said for said, _ in held)


# ---- contamination ----


def slow_rate(docs, items):
    def words(text):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)

    windows = set()
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        windows.update((tuple(w[i : i + n]), item) for i in range(len(w) - n + 1) if n)
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for window, item in windows:
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found.add(item)
        bad = bool(hit) and 20 * len(hit) >= len(w)
        out.append((doc if doc is not None else -1, len(w), len(hit), sorted(str(i) for i in found if i is not None), bad))
    return sorted(out)


def test_contamination_of_odd_rows(spark):
    rng = random.Random(4)
    vocabulary = ["One", "two", "three", "é", "7", "ÉTÉ"]
    text = lambda n: rng.choice([" ", "\n", ", "]).join(rng.choices(vocabulary, k=n))
    items = [(i, text(rng.choice([3, 12, 13, 14, 30]))) for i in range(12)]
    items += [(50, None), (51, "..."), (52, items[0][1]), (None, text(20)), (3, text(15))]
    docs = [(i, f"{text(rng.randint(0, 40))} {rng.choice(items)[1] or ''} {text(rng.randint(0, 200))}") for i in range(60)]
    docs += [(70, None), (71, ""), (72, "--"), (5, docs[5][1]), (None, docs[6][1]), (73, items[1][1].upper())]
    frame = spark.createDataFrame([(d, t, "s", 1) for d, t in docs], "doc_id long, text string, spans string, hash int")
    bench = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, gram int")
    got = [
        (r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["n_hit"], sorted(map(str, r["items"])), r["contaminated"])
        for r in decontaminate.rate(frame, bench).collect()
    ]
    want = slow_rate(docs, items)
    assert sorted(got) == want
    clean = decontaminate.drop_contaminated(frame, bench)
    assert clean.columns == ["doc_id", "text", "spans", "hash"]
    assert clean.count() == sum(not w[-1] for w in want)
    assert decontaminate.rate(frame.limit(0), bench).collect() == []
    assert {r["n_hit"] for r in decontaminate.rate(frame, bench.limit(0)).collect()} == {0}


def test_contamination_runs_without_python(spark, sf):
    plan = REGISTERED["op8_decontaminate"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def test_items_hash(spark, sf):
    row = REGISTERED["op8_decontaminate"](spark, sf).filter("n_items = 0").first()
    assert row["items_sha256"] == hashlib.sha256(b"").hexdigest()


def test_a_benchmark_too_large_to_broadcast(spark, sf, db, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    same_as_sql(spark, db, sf, "op8_decontaminate")

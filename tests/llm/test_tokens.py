"""Token counts and the alignment of tokenizers against plain loops over the same libraries."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tripmill.llm import alignment, token_counts, vocabularies
from tripmill.llm.common import table
from tripmill.llm.queries import REGISTERED
from tripmill.session import scratch_path

JSON = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    None,
    "",
    " ",
    "  two  spaces ",
    "a",
    "plain words, plain words",
    "tabs\tand\nlines\r\n",
    "<|endoftext|> in <|endoftext|>a text",
    "<s> and </s> <unk> <0x41>",
    "▁lower block ▁",
    "naïve café 東京 🙂👍🏽 é",
    "nul\x00 and \x1f control   wide　space",
    "1234567890 3.14 it's we'll",
    "a" * 3000,
    "مرحبا بالعالم",
    "word " * 700 + " end  \n\n",
]


def _json(plain):
    tokenizer = Tokenizer.from_file(JSON)
    tokenizer.encode_special_tokens = plain
    return tokenizer


# ---- counts ----


@pytest.mark.parametrize("path", [JSON, WORDS, MODEL])
def test_counts_equal_the_library(spark, path):
    rows = [(i, t, "x") for i, t in enumerate([*ODD, *ODD])] + [(None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = token_counts.token_counts(
        docs, vocabularies.TokenizerFile(spark, path), scratch_path(spark, "cache")
    ).collect()
    if path == MODEL:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        plain = Tokenizer.from_file(path)
        plain.no_truncation()
        count = lambda t: len(plain.encode(t, add_special_tokens=False).ids)
    want = Counter((i, len((t or "").encode()), count(t or "")) for i, t, _ in rows)
    assert Counter(map(tuple, got)) == want


def test_long_texts_are_cut_where_no_token_crosses(monkeypatch):
    text = " ".join(str(t) for t in ODD if t) * 3
    for kind, path in ((".json", JSON), (".model", MODEL)):
        with open(path, "rb") as file:
            tokenizer = vocabularies.load(kind, file.read())
        assert tokenizer.cuttable
        for size in (1, 7, 100):
            monkeypatch.setattr(vocabularies, "PIECE", size)
            parts = list(vocabularies.pieces(text, True))
            assert "".join(parts) == text and len(parts) > 3
            if kind == ".json":
                assert sum(tokenizer.ids(parts), []) == tokenizer.ids([text])[0]
                assert token_counts.counted([text, "", text], tokenizer)[::2] == [len(tokenizer.ids([text])[0])] * 2
            else:  # each later piece's space is the one the model adds
                again = [p[1:] if i else p for i, p in enumerate(parts)]
                assert sum(tokenizer.ids(again), []) == tokenizer.ids([text])[0]
    with open(WORDS, "rb") as file:
        assert not vocabularies.load(".json", file.read()).cuttable


def test_only_texts_that_the_cache_lacks_are_encoded_and_once(spark, monkeypatch):
    tokenizer, cache = vocabularies.TokenizerFile(spark, JSON), scratch_path(spark, "cache")
    encoded, plain = [], token_counts.encode_counts

    def spied(texts, tokenizer):
        encoded.append(sorted(r["text"] for r in texts.collect()))
        return plain(texts, tokenizer)

    monkeypatch.setattr(token_counts, "encode_counts", spied)
    first = spark.createDataFrame([(1, "one"), (2, "one"), (3, "two words")], "doc_id long, text string")
    more = first.union(spark.createDataFrame([(4, "three"), (4, "three"), (5, None)], first.schema))
    a = token_counts.token_counts(first, tokenizer, cache).collect()
    b = token_counts.token_counts(more, tokenizer, cache).collect()
    assert encoded == [["one", "two words"], ["", "three"]]
    assert len(a) == 3 and set(a) < set(b) and len(b) == 6
    assert token_counts.stored_counts(spark, cache, tokenizer.version).count() == 4
    # Another version of the tokenizer has counts of its own.
    other = vocabularies.TokenizerFile(spark, JSON, plain=True)
    assert other.version != tokenizer.version
    token_counts.token_counts(first, other, cache)
    assert encoded[2] == ["one", "two words"]
    # A digest that was appended twice is one.
    twice = spark.read.parquet(f"{cache}/tokenizer={tokenizer.version}")
    twice.write.mode("append").parquet(f"{cache}/tokenizer={tokenizer.version}")
    assert sorted(token_counts.token_counts(more, tokenizer, cache).collect(), key=str) == sorted(b, key=str)


def test_counts_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    tokenizer, cache = vocabularies.TokenizerFile(spark, JSON), scratch_path(spark, "cache")
    assert token_counts.token_counts(docs, tokenizer, cache).collect() == []
    assert token_counts.token_counts(docs, tokenizer, cache).collect() == []


def test_registered_counts(spark):
    sf = "/root/testdata/sf0.01"
    plain = _json(False)
    want = set()
    for row in table(spark, sf, "documents").collect():
        n = len(plain.encode(row["text"] or "", add_special_tokens=False).ids)
        want.add((row["doc_id"], len((row["text"] or "").encode()), n, n > 1024))
    assert set(map(tuple, REGISTERED["op11_digest_cache"](spark, sf).collect())) == want


# ---- alignment ----


def _byte_alphabet():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _slow_alignment(texts):
    """The contract, one document after the other, links one by one."""
    first, second = _json(True), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    value = _byte_alphabet()
    per_doc, holders = [], Counter()
    for text in texts:
        groups = []
        if text:
            data = f" {text}".encode()
            a = [
                (i, bytes(value[c] for c in first.id_to_token(i)))
                for i in first.encode(f" {text}", add_special_tokens=False).ids
            ]
            b = []
            for i in second.encode(text):
                piece = second.id_to_piece(i)
                b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
            if b"".join(x for _, x in a) == data == b"".join(x for _, x in b):
                ends = defaultdict(int)
                for side in (a, b):
                    at = 0
                    for _, x in side:
                        at += len(x)
                        ends[at] += 1
                common = sorted(e for e, n in ends.items() if n == 2)
                places = [[], []]
                for side, place in zip((a, b), places, strict=True):
                    at = g = 0
                    for i, x in side:
                        at += len(x)
                        place.append((g, i))
                        g += at in common
                groups = [([], []) for _ in common]
                for side, place in enumerate(places):
                    for g, i in place:
                        groups[g][side].append(i)
        links = [(x, y) for a, b in groups for x in a for y in b]
        holders.update(set(links))
        per_doc.append((groups, links))
    best = Counter()
    for (x, _), n in holders.items():
        best[x] = max(best[x], n)
    out = []
    for groups, links in per_doc:
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append(
            (
                sum(len(a) for a, _ in groups),
                sum(len(b) for _, b in groups),
                len(groups),
                len(links),
                sum(holders[link] == best[link[0]] for link in links),
                sum(holders[link] for link in links),
                hashlib.sha256(written.encode()).hexdigest() if groups else "",
            )
        )
    return out


def _files(spark):
    return vocabularies.TokenizerFile(spark, JSON, plain=True), vocabularies.TokenizerFile(spark, MODEL)


def test_alignment_equals_plain_loops(spark):
    texts = [*ODD, *ODD[5:9], "plain words", "plain words"]
    docs = spark.createDataFrame([(t, i, 0) for i, t in enumerate(texts)], "text string, doc_id long, n_a int")
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.alignment(docs, *_files(spark)).collect()}
    want = _slow_alignment(texts)
    assert [got[i] for i in range(len(texts))] == want


def test_small_chunks_change_nothing(monkeypatch):
    """In this process, so that the patched sizes hold."""
    sides = []
    for kind, path, plain in ((".json", JSON, True), (".model", MODEL, False)):
        with open(path, "rb") as file:
            sides.append(alignment.Side(vocabularies.load(kind, file.read(), plain)))
    texts = [t for t in ODD if t] + [" ".join(t for t in ODD if t)]

    def rows():
        block = [(str(i).encode(), i + 1, t) for i, t in enumerate(texts)]
        aligner = alignment.Aligner(*sides)
        first = alignment._block_rows(block, aligner).to_pylist()
        assert alignment._block_rows(block, aligner).to_pylist() == first  # with known segments
        return first

    whole = rows()
    assert len(whole) > len(texts) - 4
    for sizes in ((30, 1 << 10, 9, 0), (1, 1, 1, 50), (1 << 19, 0, 3, 1 << 22)):
        for name, size in zip(("CHUNK", "FEW_LINKS", "SLICE", "KNOWN_PAIRS"), sizes, strict=True):
            monkeypatch.setattr(alignment, name, size)
        assert rows() == whole
    monkeypatch.setattr(alignment, "segments", lambda text, cuttable: [text])  # texts as they are
    assert rows() == whole


def test_segments_give_the_text_back():
    for text in [t for t in ODD if t] + [" ", "  ", "a ", "a  ", " a", "\n a", "é  b. c\t d"]:
        found = alignment.segments(text, True)
        assert " ".join(found) == text and all(found)
    assert alignment.segments("a b", False) == ["a b"]


def test_alignment_of_rows_without_tokens(spark):
    docs = spark.createDataFrame([(1, None), (None, ""), (3, "a ▁b")], "doc_id long, text string")
    got = sorted(alignment.alignment(docs, *_files(spark)).collect(), key=str)
    assert {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "")} and len(got) == 3
    assert alignment.alignment(docs.limit(0), *_files(spark)).collect() == []


def test_registered_alignment(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents").orderBy("doc_id").collect()
    want = _slow_alignment([d["text"] for d in docs])
    got = {r["doc_id"]: tuple(r)[1:] for r in REGISTERED["op13_exact_text"](spark, sf).collect()}
    assert [got[d["doc_id"]] for d in docs] == want

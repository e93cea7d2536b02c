"""Language identification by error-correcting output codes.

Each language has a codeword. For each bit a binary classifier over byte n-grams tells
languages with a 1 from those with a 0: its weights are log-odds of smoothed n-gram
shares, every language counting the same. A text's n-grams give a margin for each bit;
the codeword of least loss wins, each bit's loss weighted by how well its classifier
does on that language. A narrow win is flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import each, lean, ship

#: Hash buckets of the byte n-grams.
BUCKETS = 1 << 15
GRAMS = (2, 3, 4)
SMOOTHING = 0.5
#: Margins are mean log-odds of an n-gram; this many make a sure bit.
SCALE = 4.0
#: Lead in probability below which a text is ambiguous.
NARROW = 0.2
UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_MULTIPLIERS = {2: 0x9E3779B1, 3: 0x85EBCA77, 4: 0xC2B2AE3D}
# A to Z in lower case; what is neither a letter nor part of a longer UTF-8 sequence is a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def held_out(doc_id: Column) -> Column:
    """Rows whose language is never read; a row without id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def grams(text: str) -> np.ndarray:
    """Buckets of all byte n-grams of the folded text, words set off by one space."""
    folded = b" ".join(text.encode().translate(_FOLD).split())
    data = np.frombuffer(b" " + folded + b" ", np.uint8).astype(np.uint32)
    out = []
    code = data.copy()
    for n in range(2, max(GRAMS) + 1):
        if len(data) < n:
            break
        code = (code[:-1] << np.uint32(8)) | data[n - 1 :]
        if n in GRAMS:
            out.append((code * np.uint32(_MULTIPLIERS[n])) >> np.uint32(17))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 for each of ``n`` languages, no two columns alike or opposite.

    Up to six languages take every split of them, more take columns of a Hadamard matrix,
    any two rows of which differ in half of all bits.
    """
    if n <= 1:
        return np.ones((n, 0), np.int8)
    if n <= 6:
        splits = np.arange(1, 1 << (n - 1))
        return np.where(splits[None, :] >> np.arange(n)[:, None] & 1, 1, -1).astype(np.int8)
    matrix = np.ones((1, 1), np.int8)
    while len(matrix) < n + 1:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    return matrix[1 : n + 1, 1:][:, (matrix[1 : n + 1, 1:] != matrix[1, 1:]).any(axis=0)]


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order, weights (bucket, bit), codewords, and the trust in each bit."""

    languages: list[str]
    weights: np.ndarray
    codes: np.ndarray
    trust: np.ndarray

    def margins(self, text: str) -> np.ndarray:
        """Mean log-odds of the text's n-grams for each bit."""
        total, found = np.zeros(self.weights.shape[1]), grams(text)
        for a in range(0, len(found), 1 << 16):  # a very long text takes no more memory
            total += self.weights[found[a : a + (1 << 16)]].sum(axis=0, dtype=np.float64)
        return total / max(len(found), 1)

    def decode(self, margins: np.ndarray) -> np.ndarray:
        """Probability of each language, from the weighted loss of its codeword."""
        agreement = self.codes * np.clip(margins * SCALE, -30, 30)
        loss = (self.trust * np.log1p(np.exp(-agreement))).sum(axis=1)
        share = np.exp(-(loss - loss.min()) * len(self.languages))
        return share / share.sum()


@lean
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) over a task's rows (lang, text)."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            count = total.setdefault(lang.as_py(), np.zeros(BUCKETS, np.int64))
            count += np.bincount(grams(text.as_py()), minlength=BUCKETS)
    for lang, count in total.items():
        seen = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(seen), pa.string()), pa.array(seen), pa.array(count[seen])],
            ["lang", "bucket", "n"],
        )


def _bit_hits(handed):
    """Per task (lang, bit, right, n): how often each bit's sign is that of the codeword."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = handed.value
        at = {lang: i for i, lang in enumerate(model.languages)}
        right, n = np.zeros(model.codes.shape, np.int64), np.zeros(len(at), np.int64)
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1), strict=True):
                i = at[lang.as_py()]
                right[i] += model.margins(text.as_py()) * model.codes[i] > 0
                n[i] += 1
        bits = model.codes.shape[1]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(at)), bits)),
                pa.array(np.tile(np.arange(bits), len(at))),
                pa.array(right.ravel()),
                pa.array(np.repeat(n, bits)),
            ],
            ["lang", "bit", "right", "n"],
        )

    return run


def fit(docs: DataFrame) -> LanguageModel:
    """A model from the text and lang of all rows that are not held out.

    Rows without text, letters or lang teach nothing. What reaches the driver is a number
    for each language and bucket, whatever the corpus. With one language every text with
    a letter has it; without any, every text is undetermined.
    """
    spark = docs.sparkSession
    ship(spark)
    taught = docs.filter(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    taught = taught.filter(F.col("text").rlike(r"\p{L}")).select("lang", "text")
    counts = taught.mapInArrow(_counted, "lang string, bucket long, n long")
    found = counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    table = np.zeros((len(languages), BUCKETS))
    at = {lang: i for i, lang in enumerate(languages)}
    table[found["lang"].map(at).to_numpy(np.int64), found["bucket"].to_numpy()] = found["n"]
    table += SMOOTHING
    table /= table.sum(axis=1, keepdims=True)
    codes = codewords(len(languages))
    weights = np.zeros((BUCKETS, codes.shape[1]), np.float32)
    for bit in range(codes.shape[1]):
        ones, zeros = table[codes[:, bit] > 0].mean(axis=0), table[codes[:, bit] < 0].mean(axis=0)
        weights[:, bit] = np.log(ones) - np.log(zeros)
    even = np.full(codes.shape, 1 / max(codes.shape[1], 1))
    model = LanguageModel(languages, weights, codes, even)
    if not codes.shape[1]:
        return model
    hits = taught.mapInArrow(
        _bit_hits(spark.sparkContext.broadcast(model)), "lang long, bit long, right long, n long"
    )
    trust = np.zeros(codes.shape)
    for row in hits.groupBy("lang", "bit").agg(F.sum("right").alias("r"), F.sum("n").alias("n")).collect():
        trust[row["lang"], row["bit"]] = (row["r"] + 1) / (row["n"] + 2)
    return LanguageModel(languages, weights, codes, trust / trust.sum(axis=1, keepdims=True))


def predict(docs: DataFrame, model: LanguageModel, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns with lang_pred, lang_score and lang_ambiguous for every row.

    A null text or one without a letter is undetermined, with score 0 and ambiguous.
    Texts are read whole; no other column is an input.
    """
    ship(docs.sparkSession)
    handed = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets, fixed

    @F.arrow_udf("struct<lang:string,score:double,ambiguous:boolean>")
    @each
    def judge(texts: pa.Array) -> pa.Array:
        learned, out = handed.value, []
        for value in texts:
            text = value.as_py() or ""
            if not learned.languages or not _LETTER.search(text):
                out.append({"lang": UNDETERMINED, "score": 0.0, "ambiguous": True})
                continue
            share = learned.decode(learned.margins(text))
            best = int(np.argmax(share))
            lead = share[best] - max(np.delete(share, best), default=0.0)
            out.append(
                {
                    "lang": learned.languages[best],
                    "score": float(share[best]),
                    "ambiguous": bool(lead < NARROW),
                }
            )
        kind = pa.struct(
            [("lang", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())]
        )
        return pa.array(out, kind)

    judged = docs.select(*carry, judge.asNondeterministic()("text").alias("judged_lang"))
    return judged.select(
        *carry,
        F.col("judged_lang.lang").alias("lang_pred"),
        F.col("judged_lang.score").alias("lang_score"),
        F.col("judged_lang.ambiguous").alias("lang_ambiguous"),
    )

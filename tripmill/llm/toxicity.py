"""Toxicity by maximum-scoring segments of words.

Word scores are log-odds of toxic against clean rows under an informative Dirichlet
prior, for whole words and for word beginnings, which carry inflected or compound words
never seen whole. A linear scan finds every maximal segment, whose score cannot be
raised by a longer or shorter one. Best segment scores of clean text follow an extreme
value law; its parameters turn the score of a segment into the number of segments as
good that clean text of this length holds by chance. What is left over all significant
segments is the evidence, and a logistic curve fitted to other rows makes it a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import ship

#: Labelled rows that are read to fit, of both labels together; half for log-odds, half for the curve.
FIT_ROWS = 24_000
#: Weight of the prior, as a share of the contexts of the label that has fewer.
PRIOR = 0.2
MIN_Z = 3.0
MIN_LOG_ODDS = 1.5
#: Cost of a word that says nothing.
GAP = 0.5
#: Chance segments in clean text below which a segment is significant.
SIGNIFICANT = 0.05
PREFIXES = (4, 5, 6, 7, 8)
_LETTERS = regex.compile(r"\p{L}+")


def words(text: str) -> list[str]:
    """Runs of letters in lower case."""
    return _LETTERS.findall(text.lower())


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never read; a row without id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def maximal_segments(hits: Iterable[tuple[int, float]], gap: float = GAP) -> list[tuple[float, int, int]]:
    """(score, first word, last word) of all maximal segments, in linear time.

    ``hits`` are the words of positive score by position; each word between costs ``gap``.
    """
    found: list[list] = []  # [sum before, sum with, first, last], every sum before is a valley
    total, at = 0.0, 0
    for position, score in hits:
        total -= gap * (position - at)
        at = position + 1
        new = [total, total + score, position, position]
        total += score
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][0] >= new[0]:
                j -= 1
            if j < 0 or found[j][1] >= new[1]:
                found.append(new)
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
    return [(high - low, first, last) for low, high, first, last in found]


class WordScores(dict):
    """The score of each word met, from the evidence best supported for it; 0 for none."""

    def __init__(self, lexicon: dict[str, tuple[float, float]]) -> None:
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        known = [self.lexicon.get(f) for f in features(word)]
        # Of all evidence for the word, the highest log-odds less one standard error.
        best = max((odds - odds / z for z, odds in filter(None, known)), default=0.0)
        if len(self) >= 1 << 18:  # a bounded memory
            self.clear()
        self[word] = best
        return best


def features(word: str) -> list[str]:
    """The whole word, and its beginnings."""
    return [f"{word}$", *(word[:n] for n in PREFIXES if len(word) > n)]


@dataclass(frozen=True)
class ToxicityModel:
    """Everything learned. ``lexicon``: feature to (z, log-odds), from ``FIT_ROWS`` rows at most."""

    lexicon: dict[str, tuple[float, float]]
    decay: float
    rate: float
    offset: float
    slope: float

    def segments(self, found: list[str], scores: WordScores) -> list[tuple[float, int, int]]:
        hits = [(i, s) for i, s in enumerate(map(scores.__getitem__, found)) if s > 0]
        return maximal_segments(hits)

    def surprise(self, score: float, n_words: int) -> float:
        """Minus the logarithm of the chance segments as good in clean text of this length."""
        return self.decay * score - math.log(self.rate * max(n_words, 1))

    def evidence(self, segments: list[tuple[float, int, int]], n_words: int) -> float:
        best = [self.surprise(s, n_words) for s, _, _ in segments] or [self.surprise(0.0, n_words)]
        significant = [x for x in best if x >= -math.log(SIGNIFICANT)]
        return sum(significant) if significant else min(max(best), -math.log(SIGNIFICANT))

    def probability(self, evidence: float) -> float:
        x = max(-50.0, min(50.0, self.offset + self.slope * evidence))
        return 1.0 / (1.0 + math.exp(-x))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(toxic, around, word) of the rows (toxic, text), once a batch; around are both neighbours."""
    for batch in batches:
        seen: set[tuple[int, str, str]] = set()
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = words(text or "")
            around = zip(["", *found], [*found[1:], ""], found, strict=False)
            seen.update((toxic, f"{a} {b}", word) for a, b, word in around)
        rows = list(seen)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array([r[1] for r in rows], pa.string()),
                pa.array([r[2] for r in rows], pa.string()),
            ],
            ["toxic", "around", "word"],
        )


def lexicon(rows: DataFrame) -> dict[str, tuple[float, float]]:
    """Features of significantly raised odds in the rows (toxic, text).

    A word counts once for each pair of neighbours, so copies of one text add nothing. The
    prior gives either label the same few contexts of a feature, by the mean of its rates
    under both; so neither the odds of a feature nor their error depend on how many rows
    of a label there are beside it, only on how many contexts speak for it.
    """
    contexts = rows.mapInArrow(_contexts, "toxic int, around string, word string").distinct()
    by_word = contexts.groupBy("word").agg(
        F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b")
    )
    starts = [
        F.when(F.length("word") > n, F.substring("word", 1, n)).otherwise(F.lit(None)) for n in PREFIXES
    ]
    named = F.array_compact(F.array(F.concat("word", F.lit("$")), *starts))
    counts = by_word.select(F.explode(named).alias("feature"), "a", "b")
    counts = counts.groupBy("feature").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    n = by_word.agg(F.sum("a"), F.sum("b")).first()
    if not n[0] or not n[1]:
        return {}
    mass = PRIOR * min(n)
    prior = F.col("share") * mass
    a, b = F.col("a") + prior, F.col("b") + prior
    log_odds = F.log(a / (n[0] + mass - a)) - F.log(b / (n[1] + mass - b))
    share = (F.col("a") / n[0] + F.col("b") / n[1]) / 2
    scored = counts.withColumn("share", share).select(
        "feature", log_odds.alias("odds"), (log_odds / F.sqrt(1 / a + 1 / b)).alias("z")
    )
    raised = scored.filter((F.col("z") >= MIN_Z) & (F.col("odds") >= MIN_LOG_ODDS))
    return {r["feature"]: (r["z"], r["odds"]) for r in raised.collect()}


def _decay(counts: Counter, n_words: int) -> float:
    """The positive root of E[exp(x * score)] = 1 over the words of clean text."""
    rows = sum(counts.values())
    # One more hit of each score, so that text without any still has a root.
    scores = np.array([-GAP, *(counts.keys() or [MIN_LOG_ODDS])])
    hits = np.array([float(c) + 1 for c in counts.values()] or [1.0])
    weights = np.append(max(n_words - rows, 1), hits)
    weights = weights / weights.sum()
    if (scores * weights).sum() >= 0:
        return 0.05  # hits so common that chance alone builds long segments
    low, high = 0.0, 4.0
    for _ in range(80):
        mid = (low + high) / 2
        if (weights * np.exp(mid * scores)).sum() > 1:
            high = mid
        else:
            low = mid
    return max(low, 0.05)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Offset and slope by damped Newton steps, with a slight pull to a slope of 1."""
    beta = np.array([0.0, 1.0])
    design = np.stack([np.ones(len(x)), np.clip(x, -20, 40)], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -40, 40)))
        pull = np.array([0.0, beta[1] - 1.0])
        slope = design.T @ (weight * (p - y)) + pull
        bend = (design * (weight * p * (1 - p) + 1e-9)[:, None]).T @ design + np.diag([1e-3, 1.0])
        step = np.linalg.solve(bend, slope)
        beta -= np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), max(float(beta[1]), 0.05)


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """A model from labelled rows that are not held out, ``FIT_ROWS`` at most.

    The rows are those of lowest hash of the id, so the bound takes no order into account
    and keeps the share of either label.
    Null labels and labels other than 0 and 1 are not read; without rows of both labels
    every score is low and the same for all texts of a length.
    """
    spark = docs.sparkSession
    ship(spark)
    named = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1))
    named = named.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    totals = {r["toxic"]: r["count"] for r in named.groupBy("toxic").count().collect()}
    order = F.xxhash64("doc_id")
    picked = named.orderBy(order, "doc_id").limit(FIT_ROWS)
    chosen = picked.withColumn("part", F.pmod(order, F.lit(2)))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # FIT_ROWS rows
    words_of = lexicon(rows.filter(F.col("part") == 0).select("toxic", "text"))
    handed = spark.sparkContext.broadcast(words_of)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = ToxicityModel(handed.value, 1.0, 1.0, 0.0, 1.0)
        scores = WordScores(plain.lexicon)
        for batch in batches:
            out = []
            for toxic, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = words(text or "")
                values = [s for s in map(scores.__getitem__, found) if s > 0]
                out.append((toxic, len(found), [s[0] for s in plain.segments(found, scores)], values))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in out], pa.int32()),
                    pa.array([r[1] for r in out], pa.int64()),
                    pa.array([r[2] for r in out], pa.list_(pa.float64())),
                    pa.array([r[3] for r in out], pa.list_(pa.float64())),
                ],
                ["toxic", "n", "segments", "hits"],
            )

    rest = rows.filter(F.col("part") == 1).select("toxic", "text")
    seen = rest.mapInArrow(judged, "toxic int, n long, segments array<double>, hits array<double>")
    # At most FIT_ROWS small rows.
    seen = seen.orderBy("toxic", "n", "segments", "hits").collect()
    clean = [r for r in seen if r["toxic"] == 0]
    hits = Counter(round(h, 1) for r in clean for h in r["hits"])
    decay = _decay(hits, sum(r["n"] for r in clean))
    expected = [max(r["n"], 1) * math.exp(-decay * max(r["segments"], default=0.0)) for r in clean]
    rate = len(clean) / sum(expected) if clean else 1.0
    model = ToxicityModel(words_of, decay, rate, 0.0, 1.0)
    if not clean or len(clean) == len(seen):
        return ToxicityModel(words_of, decay, rate, -2.0, 1.0)
    x = np.array([model.evidence([(s, 0, 0) for s in r["segments"]], r["n"]) for r in seen])
    y = np.array([float(r["toxic"]) for r in seen])
    n = [len(clean), len(seen) - len(clean)]
    share = totals[1] / (totals[0] + totals[1])
    weight = np.where(y == 1, share / n[1], (1 - share) / n[0]) * len(seen)
    offset, slope = _logistic(x, y, weight)
    return ToxicityModel(words_of, decay, rate, offset, slope)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score and passages (first word, last word, chance) of every row.

    ``passages`` are the significant segments, words counted from 0; ``chance`` is the
    expected number of segments as good in clean text. Null and empty texts have no words.
    Texts are read whole. Other columns are not read.
    """
    ship(docs.sparkSession)
    handed = docs.sparkSession.sparkContext.broadcast(model)  # bounded by FIT_ROWS

    @F.arrow_udf("struct<score:double,passages:array<struct<first:int,last:int,chance:double>>>")
    def judge(texts: pa.Array) -> pa.Array:
        learned = handed.value
        scores, out = WordScores(learned.lexicon), []
        for text in texts:
            found = words(text.as_py() or "")
            segments = learned.segments(found, scores)
            passages = [
                {"first": a, "last": b, "chance": math.exp(-x)}
                for s, a, b in segments
                if (x := learned.surprise(s, len(found))) >= -math.log(SIGNIFICANT)
            ]
            value = learned.probability(learned.evidence(segments, len(found)))
            out.append({"score": value, "passages": passages})
        passage = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("chance", pa.float64())])
        return pa.array(out, pa.struct([("score", pa.float64()), ("passages", pa.list_(passage))]))

    judged = docs.select("doc_id", judge.asNondeterministic()("text").alias("j"))
    return judged.select("doc_id", "j.score", "j.passages")

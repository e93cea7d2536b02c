"""Benchmark decontamination by a broadcast set of word n-grams, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import ascii_lower, keep, whole

WINDOW = 13
#: A side up to so many bytes is broadcast, some four million hashed benchmark windows.
BROADCAST_BYTES = 64 << 20
# All that is not a word character once A to Z are lower case.
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The normalised words: A to Z lowered, maximal runs of digits, a to z and non-ASCII."""
    return F.array_remove(F.split(ascii_lower(whole(text)), _GAP), "")


def window_hashes(found: Column, length: Column | int) -> Column:
    """The hash of each run of ``length`` words, in order."""
    length = F.lit(length) if isinstance(length, int) else length
    last = F.size(found) - length + 1
    starts = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(found, i, length)))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct (hash, gram, length, item_id): every window of every item.

    An item shorter than a window is one window; one without words has none.
    """
    item = benchmark.select(F.col("item_id"), words(F.col("text")).alias("w"))
    item = item.filter(F.size("w") > 0).withColumn("length", F.least(F.size("w"), F.lit(window)))
    return (
        item.select(
            "item_id",
            "w",
            "length",
            F.posexplode(window_hashes(F.col("w"), F.col("length"))).alias("place", "hash"),
        )
        .select(
            "hash",
            F.concat_ws(" ", F.slice("w", F.col("place") + 1, F.col("length"))).alias("gram"),
            "length",
            "item_id",
        )
        .distinct()
    )


def covered(spans: Column) -> Column:
    """Words inside at least one of the (start, length) spans, which are sorted."""
    zero = F.struct(F.lit(1).alias("end"), F.lit(0).cast("long").alias("n"))

    def step(acc: Column, span: Column) -> Column:
        end = span["start"] + span["length"]
        fresh = F.greatest(end - F.greatest(acc["end"], span["start"]), F.lit(0))
        return F.struct(
            F.greatest(acc["end"], end).alias("end"), (acc["n"] + fresh).cast("long").alias("n")
        )

    return F.aggregate(spans, zero, step, lambda acc: acc["n"])


def _small(df: DataFrame, size: Column) -> DataFrame:
    """Broadcast where the sum of row sizes proves it small; else Spark joins by exchange."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def _lookups(found: Column, lengths: list[int]) -> Column:
    """The window hashes of each length, and one null under 0 that stands for the row itself."""
    none = F.array(F.lit(None).cast("long"))
    row = F.struct(F.lit(0).alias("length"), none.alias("hashes"))
    own = (F.struct(F.lit(n).alias("length"), window_hashes(found, n).alias("hashes")) for n in lengths)
    return F.array(row, *own)


def hit_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_words, copies, spans and items.

    The hashes of all windows are looked up in the set; then the words of the hits are
    compared, so a span (start from 1, length) is an exact occurrence. Null and empty
    texts have no words. Rows alike in doc_id and text give one row that counts them in
    ``copies``. A null item_id gives spans without an item; an empty benchmark none. Other
    columns are not read, so their names do not matter.
    """
    grams = keep(benchmark_windows(benchmark, window), "grams")
    lengths = sorted(r["length"] for r in grams.select("length").distinct().collect())
    rows = docs.select(
        "doc_id",
        F.xxhash64(whole(F.col("text"))).alias("text_hash"),
        words(F.col("text")).alias("w"),
    )
    known = grams.select("hash", F.lit(True).alias("known")).distinct()
    places = rows.select(
        "doc_id", "text_hash", F.size("w").alias("n_words"), F.explode(_lookups(F.col("w"), lengths))
    ).select(
        "doc_id",
        "text_hash",
        "n_words",
        "col.length",
        F.posexplode("col.hashes").alias("place", "hash"),
    )
    itself = F.col("length") == 0
    found = places.join(_small(known, F.lit(32)), "hash", "left").filter(itself | F.col("known"))
    start = (F.col("place") + 1).alias("start")
    hit = F.when(~itself, F.struct(start, "length"))
    judged = keep(
        found.groupBy("doc_id", "text_hash").agg(
            F.max("n_words").cast("long").alias("n_words"),
            F.count_if(itself).alias("copies"),
            F.collect_set(hit).alias("spans"),
        ),
        "hits",
    )
    key = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (
        F.col("a.text_hash") == F.col("b.text_hash")
    )
    to_verify = judged.filter(F.size("spans") > 0).select("doc_id", "text_hash", "spans")
    words_of_hits = (
        rows.alias("a")
        .join(_small(to_verify, 64 + 32 * F.size("spans")).alias("b"), key)
        .select(
            "a.doc_id",
            "a.text_hash",
            F.transform(
                "b.spans",
                lambda s: F.struct(
                    s["start"].alias("start"),
                    s["length"].alias("length"),
                    F.concat_ws(" ", F.slice("a.w", s["start"], s["length"])).alias("gram"),
                ),
            ).alias("s"),
        )
        .select("doc_id", "text_hash", F.explode("s"))
        .select("doc_id", "text_hash", "col.*")
    )
    exact = (
        words_of_hits.join(
            _small(
                grams.select("gram", "item_id"),
                32 + F.octet_length("gram") + F.coalesce(F.octet_length(F.col("item_id").cast("string")), F.lit(0)),
            ),
            "gram",
        )
        .groupBy("doc_id", "text_hash")
        .agg(
            F.array_sort(F.collect_set(F.struct("start", "length"))).alias("spans"),
            F.collect_set("item_id").alias("items"),
        )
    )
    return (
        judged.drop("spans").alias("a")
        .join(exact.alias("b"), key, "left")
        .select(
            "a.*",
            F.coalesce("b.spans", F.array().cast("array<struct<start:int,length:int>>")).alias("spans"),
            F.coalesce("b.items", F.array().cast(exact.schema["items"].dataType)).alias("items"),
        )
    )


def rate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: doc_id, text_hash, n_words, n_hit, items, spans, contaminated."""
    hits = hit_spans(docs, benchmark, window).withColumn("n_hit", covered(F.col("spans")))
    every = hits.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return every.select(
        "doc_id", "text_hash", "n_words", "n_hit", "items", "spans",
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that are not contaminated."""
    hits = hit_spans(docs, benchmark, window).filter(F.size("spans") > 0)
    bad = hits.filter(contaminated(covered(F.col("spans")), F.col("n_words")))
    key = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (
        F.xxhash64(whole(F.col("a.text"))) == F.col("b.text_hash")
    )
    return docs.alias("a").join(bad.select("doc_id", "text_hash").alias("b"), key, "left_anti")


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """At least one word in twenty is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)

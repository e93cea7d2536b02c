"""Token counts through a cache of content digests.

A count is stored under the digest of the text and the digest of the tokenizer's version
(file, library, options). Texts meet the cache as digests, 32 bytes each; only digests it
does not hold have their texts fetched, once each whatever the copies, encoded, and
appended. Stored counts never change, so a digest appended twice by two runs at the same
time is read as one, and a failed append leaves the cache as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import vocabularies
from tripmill.llm.common import keep, ship, whole
from tripmill.llm.vocabularies import TokenizerFile, pieces
from tripmill.sources.tables import read_if_exists

#: Characters of text that are encoded together.
BATCH = 1 << 20


def content_digest(text: Column) -> Column:
    """32 bytes that stand for a text."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def stored_counts(spark: SparkSession, cache_path: str, version: str) -> DataFrame | None:
    """(digest, n_tokens) of one tokenizer version, each digest once; None without a cache."""
    stored = read_if_exists(spark, f"{cache_path}/tokenizer={version}")
    if stored is None:
        return None
    return stored.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def counted(texts: list[str], tokenizer) -> list[int]:
    """Tokens of each text; long ones are counted in pieces."""
    totals, batch, owners, size = [0] * len(texts), [], [], 0

    def flush() -> None:
        for owner, n in zip(owners, tokenizer.counts(batch), strict=True):
            totals[owner] += n
        batch.clear()
        owners.clear()

    for i, text in enumerate(texts):
        for piece in pieces(text, tokenizer.cuttable, vocabularies.PIECE):
            batch.append(piece)
            owners.append(i)
            size += len(piece)
            if size >= BATCH:
                flush()
                size = 0
    flush()
    return totals


def encode_counts(texts: DataFrame, tokenizer: TokenizerFile) -> DataFrame:
    """(digest, n_tokens) of the rows (digest, text)."""
    handed = tokenizer.handed()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = counted(batch.column(1).to_pylist(), handed())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64())], ["digest", "n_tokens"]
            )

    return texts.mapInArrow(count, "digest binary, n_tokens long")


def fill_cache(rows: DataFrame, tokenizer: TokenizerFile, cache_path: str) -> int:
    """Encode the texts of the rows (digest, text) that the cache lacks; how many those were.

    Copies are combined before the exchange, so each text travels once from a task. Texts
    that are stored already do not travel at all.
    """
    spark = rows.sparkSession
    stored = stored_counts(spark, cache_path, tokenizer.version)
    if stored is not None:
        missing = rows.select("digest").distinct().join(stored, "digest", "left_anti")
        rows = rows.join(keep(missing, "missing-digests"), "digest", "left_semi")
    texts = rows.groupBy("digest").agg(F.first("text").alias("text"))
    found = keep(encode_counts(texts, tokenizer), "token-counts")
    found.write.mode("append").parquet(f"{cache_path}/tokenizer={tokenizer.version}")
    return found.count()


def token_counts(
    docs: DataFrame,
    tokenizer: TokenizerFile,
    cache_path: str,
    normalise: Callable[[Column], Column] = whole,
) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every row, texts taken whole.

    ``normalise`` maps a text to the content that is digested and encoded; the default
    only makes null the empty text, as anything more may change counts. Without tokens
    there are zero. Rows alike in text share one entry, repeated rows are all returned, a
    null doc_id is as good as any. An empty table gives no rows and adds none to the cache.
    Columns other than doc_id and text are not read.
    """
    ship(docs.sparkSession)
    text = normalise(F.col("text"))
    fill_cache(docs.select(content_digest(text).alias("digest"), text.alias("text")), tokenizer, cache_path)
    rows = docs.select(
        "doc_id",
        F.octet_length(whole(F.col("text"))).cast("long").alias("n_bytes"),
        content_digest(text).alias("digest"),
    )
    counts = stored_counts(docs.sparkSession, cache_path, tokenizer.version)
    # No hint: the partition of a text that a third of all rows hold is split by Spark.
    return rows.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")

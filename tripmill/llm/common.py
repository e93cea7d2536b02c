"""Column helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import string
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def whole(text: Column) -> Column:
    """The text, null as the empty text."""
    return F.coalesce(text, F.lit(""))


def keep(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, no lineage to redo."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a sieve at most, some 50 MB where it is broadcast. A fuller sieve lets more keys pass.
SIEVE_WORDS = 1 << 20


def sift(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """``df`` with ``maybe``: false where ``key`` is surely not in the column of that name of ``keys``.

    A bit for each hash, 16 bits a key: one other key in sixteen passes. What passes can be
    exchanged for an exact join; the rest needs none. ``keys`` is counted first.
    """
    words = min(max(keys.count() // 4, 64), SIEVE_WORDS)
    hashed = F.xxhash64(key)
    word, bit = F.pmod(hashed, F.lit(words)).alias("sieve_word"), F.shiftrightunsigned(hashed, 58).cast("int")
    one = F.expr("shiftleft(1L, sieve_bit)")
    bits = keys.select(word, bit.alias("sieve_bit")).groupBy("sieve_word").agg(F.bit_or(one).alias("sieve_bits"))
    tested = df.select("*", word, bit.alias("sieve_bit")).join(F.broadcast(bits), "sieve_word", "left")
    maybe = F.coalesce(F.expr("shiftright(sieve_bits, sieve_bit) & 1L = 1L"), F.lit(False))
    return tested.withColumn("maybe", maybe).drop("sieve_word", "sieve_bit", "sieve_bits")


def give_back() -> None:
    """Memory that this process has freed goes back to the system, from Arrow's pool and glibc's heap."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)(0)


def lean(step: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``step`` over batches, after which its Python worker gives back what it has freed.

    Workers live on between tasks and stages. What they hold of the last batches would else
    count beside the JVM while it sorts and joins.
    """

    @wraps(step)
    def run(batches: Iterator) -> Iterator:
        yield from step(batches)
        give_back()

    return run


def each(of: Callable[[pa.Array], pa.Array]) -> Callable[[Iterator[pa.Array]], Iterator[pa.Array]]:
    """``of`` for every batch of an arrow_udf, by a worker that is ``lean``."""

    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from map(of, arrays)
        give_back()

    return run


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python, once an application.

    Needed where the driver found it on its own path only; Spark serves the archive.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tripmill-")) / "tripmill.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)

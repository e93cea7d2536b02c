"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.llm import (
    alignment,
    bpe,
    decontaminate,
    language,
    lines,
    prefix_trie,
    sharding,
    simhash,
    suffixes,
    token_counts,
    topk,
    toxicity,
    warc,
)
from tripmill.llm.common import table
from tripmill.llm.vocabularies import TokenizerFile
from tripmill.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def register(query: Query) -> Query:
    REGISTERED[query.__name__] = query
    return query


RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@register
def op1_byte_bpe(spark, sf):
    """Every text as token ids and back."""
    codec = bpe.Codec(spark, RANK_FILE, public_tokenizers.PATTERN)
    coded = table(spark, sf, "documents").select("doc_id", codec.round_trip(F.col("text")).alias("c"))
    return coded.select(
        "doc_id",
        F.size("c.ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("c.ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("c.decoded", 256).alias("decoded_sha256"),
    )


@register
def op2_voronoi_top_k(spark, sf):
    """The five rows of highest inner product for every fiftieth vector."""
    return topk.top_k(table(spark, sf, "embeddings"), F.col("id") % 50 == 0, k=5)


@register
def op3_output_codes(spark, sf):
    """The language of every document."""
    docs = table(spark, sf, "documents")
    predicted = language.predict(docs, language.fit(docs))
    return predicted.select(
        "doc_id",
        language.held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
        F.col("lang_ambiguous").alias("ambiguous"),
    )


@register
def op4_template_tree(spark, sf):
    """Every document without the lines of recurring templates."""
    kept = lines.report(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@register
def op5_simhash(spark, sf):
    """The component of every document under links of at most four fingerprint bits."""
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


@register
def op6_warc_derivatives(spark, sf):
    """Metadata and plain-text records of every page."""
    responses = warc.responses_of_pages(table(spark, sf, "pages"), date="2026-01-01T00:00:00Z")
    records = warc.with_bytes(warc.derive(responses))
    return records.select(
        "page_id",
        "type",
        "record_id",
        "refers_to",
        "target_uri",
        "content_type",
        "content_length",
        "block_digest",
        "payload_digest",
        F.sha2("record_bytes", 256).alias("record_sha256"),
    )


@register
def op7_toxic_segments(spark, sf):
    """The toxicity of every document."""
    docs = table(spark, sf, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf, "labels")))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


@register
def op8_decontaminate(spark, sf):
    """Words of benchmark windows in every document."""
    rated = decontaminate.rate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    items = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return rated.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        "contaminated",
    )


@register
def op9_suffix_arrays(spark, sf):
    """Every document without bytes that repeat an earlier string of 100 bytes."""
    found = suffixes.without_repeats(table(spark, sf, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@register
def op10_virtual_slots(spark, sf):
    """All documents in eight shards of near equal bytes."""
    placed = sharding.shard_by_bytes(
        table(spark, sf, "documents"), n_shards=8, map_path=scratch_path(spark, "slot-map")
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


JSON_FILE = public_tokenizers.path("byte_bpe_50k.json")
MODEL_FILE = public_tokenizers.path("piece_bpe_32k.model")


@register
def op11_digest_cache(spark, sf):
    """The tokens of every document, counted once for each text."""
    counts = token_counts.token_counts(
        table(spark, sf, "documents"),
        TokenizerFile(spark, JSON_FILE),
        scratch_path(spark, "token-cache"),
    )
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@register
def op12_prefix_trie(spark, sf):
    """The prefixes that conversations share."""
    return prefix_trie.prefix_trie(table(spark, sf, "conversations"))


@register
def op13_exact_text(spark, sf):
    """The links between the tokens of two tokenizers in every document."""
    return alignment.alignment(
        table(spark, sf, "documents"),
        TokenizerFile(spark, JSON_FILE, plain=True),
        TokenizerFile(spark, MODEL_FILE),
    )

"""Rendezvous hashing of record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.ranges import end_to_end

SEED = 20_081


def rendezvous(key: Column, weights: Sequence[float], seed: int = SEED) -> Column:
    """The shard, 0 to len(weights) - 1, that a key belongs to.

    Each pair of key and shard hashes to a number u in (0, 1); the shard with the smallest
    -ln(u) / weight wins, so a shard's share of the keys is its weight's share. Adding a shard
    moves keys into it only; removing the last moves its keys only; a shard of weight 0 gets
    none. Equal scores go to the lower shard. All NULL keys belong to one shard.
    """
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one of them has to be positive")
    scores = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.lit(shard), key), 11)
            u = (bits.cast("double") + 0.5) / float(2**53)
            scores.append(F.struct((-F.log(u) / float(weight)).alias("score"), F.lit(shard).alias("shard")))
    return (F.least(*scores) if len(scores) > 1 else scores[0])["shard"]


def assign_shards(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", name: str = "shard") -> DataFrame:
    """The rows with a column that names their shard; nothing is shuffled.

    A column of that name is replaced. Empty texts, NULL texts and repeated rows are rows like
    any other; rows without a key share one shard.
    """
    return docs.withColumn(name, rendezvous(F.col(key), weights))


def write_shards(docs: DataFrame, weights: Sequence[float], path: str, key: str = "doc_id") -> None:
    """Write a folder ``shard=<n>`` of Parquet files per shard; Spark cuts large ones in files."""
    assign_shards(docs, weights, key).hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def shard_manifest(docs: DataFrame, weights: Sequence[float], grown_weight: float = 1.0) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes and 1 more; a NULL text counts as empty. ``slot``
    numbers the rows of a shard from 0 without gaps, in the order of a hash of the row.
    ``grown_shard`` is the shard after one more, of weight ``grown_weight``, is added. An
    empty table gives no rows; columns besides ``doc_id`` and ``text`` are ignored. Rows that
    repeat share a shard and have slots of their own.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    ).withColumn("shard", rendezvous(F.col("doc_id"), weights))
    slots = end_to_end(rows, "shard", F.lit(1), ["doc_id", "size", "text_crc32"])
    grown = rendezvous(F.col("doc_id"), [*weights, grown_weight])
    return slots.select(
        "doc_id", "size", "text_crc32", "shard", F.col("start").alias("slot"), grown.alias("grown_shard")
    )

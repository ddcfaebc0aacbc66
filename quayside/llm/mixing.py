"""Mixing sources to target weights in blocks of a fixed number of words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ID, NO_ID, TEXT_HASH, WORD, whole_rows
from quayside.llm.ranges import end_to_end
from quayside.scratch import Workspace

#: Up to so many sources are sent to all executors; more are joined by a shuffle.
BROADCAST_SOURCES = 100_000


@dataclass(frozen=True)
class Mix:
    """Parameters of a mixture.

    ``weights`` repeat over the sources in code-point order, NULL last. ``most`` is how often
    a source's words may be used. The words taken are ``share`` of all words.
    """

    block_words: int = 64
    shards: int = 8
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    most: int = 3
    share: float = 1.0
    seed: int = 11


def targets(sizes: list[int], mix: Mix) -> list[float]:
    """Words wanted of each source: shares by weight, none above ``most`` times its size."""
    weights = np.array([mix.weights[i % len(mix.weights)] for i in range(len(sizes))], dtype=float)
    size = np.array(sizes, dtype=float)
    limit, wanted = mix.most * size, np.zeros(len(sizes))
    free = size > 0
    rest = min(mix.share * size.sum(), limit.sum())
    while free.any() and rest > 0:
        part = rest * weights / max(weights[free].sum(), 1e-300) * free
        over = free & (part >= limit)
        if not over.any():
            wanted[free] = part[free]
            break
        wanted[over] = limit[over]
        rest -= limit[over].sum()
        free &= ~over
    return [float(x) for x in wanted]


def draws(wanted: list[float], sizes: list[int], mix: Mix) -> np.ndarray:
    """Slots of each source in each output shard, ``[shard, source]``.

    The slots of a shard are drawn multinomially by the sources' shares: whole expected counts
    are given out as they are and the fractions that remain are drawn, with what earlier
    shards gave too much or too little carried on. So a source's total stays within a few
    blocks of its target. No source gets more slots than ``most`` times its blocks.
    """
    size = np.array(sizes, dtype=np.int64)
    blocks = -(-size // mix.block_words)
    slots = np.divide(
        np.array(wanted) * blocks, size, out=np.zeros(len(sizes)), where=size > 0
    )
    rng = np.random.default_rng(mix.seed)
    out = np.zeros((mix.shards, len(sizes)), dtype=np.int64)
    most = mix.most * blocks
    for k in range(mix.shards):
        given = out[:k].sum(axis=0)
        due = np.minimum(np.maximum(slots * (k + 1) / mix.shards - given, 0), most - given)
        whole = np.floor(due + 1e-9).astype(np.int64)
        fraction = np.where(given + whole < most, np.maximum(due - whole, 0), 0)
        rest = int(round(fraction.sum()))
        if rest:
            whole += np.minimum(rng.multinomial(rest, fraction / fraction.sum()), most - given - whole)
        out[k] = whole
    return out


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0 to size - 1: a Feistel network that walks its cycles."""
    half = max(1, (int(size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = _mixed(np.arange(6, dtype=np.uint64) + np.uint64(key & (2**64 - 1)) * np.uint64(6))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            left, right = right, left ^ (_mixed(right + k) & mask)
        return (left << np.uint64(half)) | right

    x = once(index.astype(np.uint64))
    while (outside := x >= np.uint64(size)).any():
        x[outside] = once(x[outside])
    return x.astype(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD1B54A32D192ED03)
    return x ^ (x >> np.uint64(32))


@dataclass(frozen=True)
class Mixed:
    """``rows``: one row per document, with where it lies in its source's words; ``pieces``: what is taken."""

    rows: DataFrame
    pieces: DataFrame
    sources: DataFrame


ROW = ["source_no", "start"]


def mix_sources(docs: DataFrame, mix: Mix = Mix(), identity: Column | None = None) -> Mixed:
    """Mix the words of all documents to the sources' target weights.

    Each source's documents are laid end to end and cut in blocks of ``block_words`` words.
    The slots of a source, counted over the output shards, are mapped to its blocks by a
    pseudorandom permutation, another one each time the blocks are used up; slots and blocks
    meet by index. Nothing depends on how rows are partitioned, so reruns agree.

    ``rows``: ``source_no, start, doc_id, size, identity`` per document. ``pieces``:
    ``shard, slot, source_no, start, first_word, n_words`` per slot and document in it.
    ``sources``: ``source, source_no, source_size, target``.

    NULL texts and texts without words have size 0 and give no pieces; the NULL source is a
    source, the last. Rows that repeat are mixed as rows of their own. An empty table gives no
    rows. Columns besides ``doc_id, text, source`` are ignored.
    """
    spark = docs.sparkSession
    size = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long")
    text_hash = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").alias("source"),
        size.alias("size"),
        (F.lit(0).cast("long") if identity is None else identity).alias("identity"),
        text_hash.alias(TEXT_HASH),
    )
    # Words are counted once; all that follows reads the counts.
    sized = Workspace(spark, "mixing").table(sized, "sized")
    found = sized.groupBy("source").agg(F.sum("size").alias("size")).collect()
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in found]
    wanted = targets(sizes, mix)
    counts = draws(wanted, sizes, mix)
    sources = spark.createDataFrame(
        [(r["source"], i, sizes[i], wanted[i]) for i, r in enumerate(found)],
        "source string, source_no int, source_size long, target double",
    )
    if len(found) <= BROADCAST_SOURCES:
        sources = F.broadcast(sources)
    known = sources
    rows = (
        sized.withColumnRenamed("source", "_source")
        .join(known, F.col("_source").eqNullSafe(known["source"]))
        .select("source_no", "doc_id", "size", "identity", TEXT_HASH)
    )
    rows = end_to_end(rows, "source_no", F.col("size"), ["doc_id", "size", "identity", TEXT_HASH])
    blocks = F.sequence(
        F.floor(F.col("start") / mix.block_words), F.floor((F.col("start") + F.col("size") - 1) / mix.block_words)
    )
    cut = (
        rows.where("size > 0")
        .select("source_no", "start", "size", F.explode(blocks).alias("block"))
        .withColumn("_from", F.greatest("start", F.col("block") * mix.block_words))
        .withColumn("_to", F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * mix.block_words))
        .select(
            "source_no",
            "block",
            "start",
            (F.col("_from") - F.col("start")).alias("first_word"),
            (F.col("_to") - F.col("_from")).alias("n_words"),
        )
    )
    pieces = cut.join(_slots(docs, counts, sizes, mix), ["source_no", "block"]).drop("block")
    return Mixed(rows, pieces, sources)


def _slots(docs: DataFrame, counts: np.ndarray, sizes: list[int], mix: Mix) -> DataFrame:
    """``source_no, block, shard, slot`` of all slots."""
    per_source = counts.sum(axis=0)
    ends, shard_ends = np.cumsum(per_source), np.cumsum(counts, axis=0)
    n_blocks = [-(-s // mix.block_words) for s in sizes]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column(0).to_numpy()
            source = np.searchsorted(ends, slot, side="right")
            nth = slot - (ends - per_source)[source]
            block, shard = np.empty_like(nth), np.empty(len(nth), dtype=np.int32)
            for s in np.unique(source):
                own = source == s
                shard[own] = np.searchsorted(shard_ends[:, s], nth[own], side="right")
                turn = nth[own] // n_blocks[s]
                place = nth[own] % n_blocks[s]
                for t in np.unique(turn):
                    place[turn == t] = permuted(
                        place[turn == t], n_blocks[s], mix.seed * 1_000_003 + int(s) * mix.most + int(t)
                    )
                block[own] = place
            yield pa.RecordBatch.from_arrays(
                [pa.array(source.astype(np.int32)), pa.array(block), pa.array(shard), pa.array(slot)],
                ["source_no", "block", "shard", "slot"],
            )

    total = int(per_source.sum())
    return docs.sparkSession.range(total).mapInArrow(
        fill, "source_no int, block long, shard int, slot long"
    )


def taken(mixed: Mixed) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``."""
    sums = mixed.pieces.groupBy(*ROW).agg(F.sum("n_words").alias("taken"))
    sized = mixed.rows.where("size > 0").join(sums, ROW, "left")
    empty = mixed.rows.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    return (
        sized.unionByName(empty)
        .join(mixed.sources, "source_no")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mixture as rows with the columns of ``docs``.

    A document comes once for each time its words are taken: the n-th row has the words taken
    at least n times, in order. The text is the document's own where all of its words are
    taken, else the words joined by one space. ``n_chars`` follows the text, where there is
    such a column.
    """
    columns = docs.columns
    row = F.xxhash64(*[F.col(c) for c in columns if c != "text"])
    mixed = mix_sources(docs, mix, identity=row)
    times = mixed.pieces.groupBy(*ROW, "first_word", "n_words").agg(F.count("*").cast("int").alias("times"))
    turns = times.withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("times"))))
    words = F.sort_array(F.collect_list(F.struct("first_word", "n_words")))
    per_turn = (
        turns.groupBy(*ROW, "turn")
        .agg(words.alias("_runs"), F.sum("n_words").alias("_taken"))
        .join(mixed.rows.where("size > 0"), ROW)
        .select(
            F.coalesce("doc_id", F.lit(NO_ID)).alias(ID),
            TEXT_HASH,
            F.col("identity").alias("_identity"),
            "_runs",
            (F.col("_taken") == F.col("size")).alias("_whole"),
        )
    )
    own = whole_rows(docs).withColumn("_identity", F.xxhash64(*[f"_row.{c}" for c in columns if c != "text"]))
    joined = own.dropDuplicates([ID, TEXT_HASH, "_identity"]).join(per_turn, [ID, TEXT_HASH, "_identity"])
    words = F.regexp_extract_all("_row.text", F.lit(f"({WORD})"), F.lit(1))
    joined = joined.withColumn("_words", F.when(~F.col("_whole"), words))
    run = F.transform(
        "_runs",
        lambda r: F.slice(F.col("_words"), (r["first_word"] + 1).cast("int"), r["n_words"].cast("int")),
    )
    joined = joined.withColumn(
        "_text", F.when(F.col("_whole"), F.col("_row.text")).otherwise(F.array_join(F.flatten(run), " "))
    )
    new = {"text": F.col("_text")}
    if "n_chars" in columns:
        new["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return joined.select(*[new.get(c, F.col(f"_row.{c}")).alias(c) for c in columns])

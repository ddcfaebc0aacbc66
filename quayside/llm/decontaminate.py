"""Benchmark passages in documents: word windows of test items that occur in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ID, NO_ID, TEXT_HASH, ascii_lower, keyed, whole_rows
from quayside.scratch import Workspace

SEPARATOR = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

#: Up to so many different windows (8 bytes each) are sent to all executors; more are joined
#: by a shuffle. The rows are the same.
BROADCAST_WINDOWS = 1_000_000
#: Their words are sent up to so many bytes, and joined beyond.
BROADCAST_BYTES = 64 << 20


def normal_words(text: Column) -> Column:
    """Words of ASCII letters, digits and all characters beyond ASCII, A-Z lower-cased."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATOR, -1), "")


def windows(words: Column, lengths: Sequence[int]) -> Column:
    """An array of ``(start, length, hash)`` of all windows of the lengths."""

    def of(n: int) -> Column:
        def window(i: Column) -> Column:
            return F.struct(
                i.alias("start"), F.lit(n).alias("length"), F.xxhash64(F.slice(words, i + 1, n)).alias("hash")
            )

        starts = F.sequence(F.lit(0), F.size(words) - n)
        return F.when(F.size(words) >= n, F.transform(starts, window)).otherwise(
            F.array().cast("array<struct<start:int,length:int,hash:bigint>>")
        )

    return F.concat(*[of(n) for n in lengths])


def contaminated_words(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, hit_words, items, contaminated``
    and ``_text_hash``, which tells rows of one id and different texts apart.

    A window is ``size`` consecutive words of a benchmark item; an item of fewer words, but
    not none, is one window. ``hit_words`` are the sorted positions of the document's words
    inside an occurrence of a window, ``items`` the sorted ids (as text) of the items whose
    windows occur; both are empty for a clean document.

    Texts that are NULL or have no word have nothing to hit; items without words have no
    window and items without an id are left out of ``items``, though their windows hit. Rows
    with the same id and text get the same result each. Empty tables give no rows, or no
    hits. Other columns are ignored.

    Token windows of the documents are hashed and looked up among the distinct window hashes
    of the items, sent to all executors if they are few (``BROADCAST_WINDOWS``). Hits are
    verified word by word against the items in a second read of the documents hit.
    """
    work = Workspace(docs.sparkSession, "decontaminate")
    base = keyed(docs)
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"),
        normal_words(F.coalesce(F.col("text"), F.lit(""))).alias("words"),
    ).where(F.size("words") > 0)
    per_item = items.select(
        "item_id", "words", F.explode(_own_windows(F.col("words"), size)).alias("w")
    ).select(
        "item_id", "w.*", F.expr("slice(words, w.start + 1, w.length)").alias("passage")
    )
    per_item = work.table(per_item, "items")
    lengths = sorted(r[0] for r in per_item.select("length").distinct().collect())
    nothing = F.lit(None).cast("long")
    if not lengths:
        return _rows(base, base.limit(0).select(ID, TEXT_HASH, nothing.alias("n"), *_no_hits()))

    passages = per_item.select("hash", "length", "passage").distinct()
    hashes = passages.select("hash", "length").distinct()
    held = F.octet_length(F.array_join("passage", "")) + 24 * F.size("passage")
    n_passages, n_bytes = passages.agg(F.count("*"), F.sum(held)).first()
    if n_passages <= BROADCAST_WINDOWS:
        hashes = F.broadcast(hashes)
    if n_bytes <= BROADCAST_BYTES:
        passages = F.broadcast(passages)
    found = (
        base.select(ID, TEXT_HASH, normal_words(F.col("text")).alias("words"))
        .select(ID, TEXT_HASH, F.inline(windows(F.col("words"), lengths)))
        .join(hashes, ["hash", "length"], "left_semi")
    )
    found = work.table(found.distinct(), "found")
    starts = found.groupBy(ID, TEXT_HASH).agg(F.collect_list(F.struct("start", "length", "hash")).alias("hits"))
    verified = (
        base.select(ID, TEXT_HASH, "text")
        .join(starts, [ID, TEXT_HASH])
        .select(ID, TEXT_HASH, normal_words(F.col("text")).alias("words"), "hits")
        .select(ID, TEXT_HASH, F.explode(_with_words(F.col("words"), F.col("hits"))).alias("hit"))
        .select(ID, TEXT_HASH, "hit.*")
        .join(passages, ["hash", "length", "passage"], "left_semi")
        .select(ID, TEXT_HASH, "start", "length", "hash")
        .distinct()
    )
    verified = work.table(verified, "verified")
    covered = verified.groupBy(ID, TEXT_HASH).agg(
        F.sort_array(
            F.array_distinct(
                F.flatten(F.collect_list(F.expr("sequence(start, start + length - 1)")))
            )
        ).alias("hit_words")
    )
    named = (
        verified.select(ID, TEXT_HASH, "hash", "length")
        .distinct()
        .join(per_item.select("hash", "length", "item_id").distinct(), ["hash", "length"])
        .groupBy(ID, TEXT_HASH)
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    return _rows(base, covered.join(named, [ID, TEXT_HASH], "left"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no window of a benchmark item occurs, as they are."""
    hit = contaminated_words(docs, benchmark, size).where("contaminated")
    hit = hit.select(F.coalesce("doc_id", F.lit(NO_ID)).alias(ID), TEXT_HASH).distinct()
    return whole_rows(docs).join(hit, [ID, TEXT_HASH], "left_anti").select("_row.*")


def _no_hits() -> list[Column]:
    return [F.array().cast("array<int>").alias("hit_words"), F.array().cast("array<string>").alias("items")]


def _rows(base: DataFrame, hits: DataFrame) -> DataFrame:
    words = F.when(F.col("text") == "", F.lit(0)).otherwise(F.size(normal_words(F.col("text"))))
    counted = base.select(ID, TEXT_HASH, "doc_id", words.cast("long").alias("n_words"))
    empty_hits, empty_items = _no_hits()
    return counted.join(hits, [ID, TEXT_HASH], "left").select(
        "doc_id",
        TEXT_HASH,
        "n_words",
        F.coalesce(F.size("hit_words"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("hit_words", empty_hits).alias("hit_words"),
        F.coalesce("items", empty_items).alias("items"),
        F.col("hit_words").isNotNull().alias("contaminated"),
    )


def _own_windows(words: Column, size: int) -> Column:
    """The windows of an item: all of ``size`` words, or the whole of a shorter one."""
    shorter = windows(words, range(1, size))
    return F.when(F.size(words) >= size, windows(words, [size])).otherwise(
        F.filter(shorter, lambda w: w["length"] == F.size(words))
    )


def _with_words(words: Column, hits: Column) -> Column:
    def passage(hit: Column) -> Column:
        return F.struct(
            hit["start"].alias("start"),
            hit["length"].alias("length"),
            hit["hash"].alias("hash"),
            F.slice(words, hit["start"] + 1, hit["length"]).alias("passage"),
        )

    return F.transform(hits, passage)

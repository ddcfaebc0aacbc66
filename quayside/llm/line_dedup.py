"""Lines that several documents share stay in one of them only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ID, SPACES, TEXT_HASH, ascii_lower, keyed
from quayside.scratch import Workspace

LAST_ID = 2**63 - 1


def dedup_lines(docs: DataFrame, min_chars: int = 10, min_documents: int = 2) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_dropped, kept_text``.

    A line's key is the line without spaces at its ends and with A-Z lower-cased. A key of at
    least ``min_chars`` code points that at least ``min_documents`` documents hold keeps its
    lines in the smallest ``doc_id`` of them only. Lines shorter than that always stay.

    A NULL text is one empty line. Rows without a ``doc_id`` count as one document that comes
    after all others; rows that repeat a ``doc_id`` are one document. An empty table gives
    no rows; columns besides ``doc_id`` and ``text`` are ignored.

    The lines are exploded to 128-bit hashes, which are written once. Hashes are counted with
    map-side combination (the smallest and largest id of each hash say whether it is shared),
    so a line that all documents hold is a row per task in the shuffle. Only positions are
    shuffled back to the documents.
    """
    work = Workspace(docs.sparkSession, "line-dedup")
    base = keyed(docs).withColumn(ID, F.coalesce("doc_id", F.lit(LAST_ID)))
    key = ascii_lower(F.btrim(F.col("line"), F.lit(SPACES)))
    lines = (
        base.select(ID, TEXT_HASH, F.posexplode(F.split("text", "\n", -1)).alias("position", "line"))
        .select(ID, TEXT_HASH, "position", key.alias("key"))
        .where(F.length("key") >= min_chars)
        .select(
            ID, TEXT_HASH, "position", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
        )
    )
    lines = work.table(lines, "lines")
    # A table of its own, so that Spark shuffles both sides of the join and splits a hot line.
    shared = work.table(_shared(lines, min_documents), "shared")
    dropped = (
        lines.join(shared, ["h1", "h2"])
        .where(F.col(ID) != F.col("first_id"))
        .groupBy(ID, TEXT_HASH)
        .agg(F.sort_array(F.collect_set("position")).alias("drops"))
    )
    joined = base.join(dropped, [ID, TEXT_HASH], "left")
    cells = F.split("text", "\n", -1)
    return joined.select(
        "doc_id",
        F.size(cells).cast("long").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drops").isNull(), F.col("text"))
        .otherwise(_without(cells, F.col("drops")))
        .alias("kept_text"),
    )


def _shared(lines: DataFrame, min_documents: int) -> DataFrame:
    """``h1, h2, first_id`` of the hashes that enough documents hold."""
    by_hash = lines.groupBy("h1", "h2")
    if min_documents == 2:
        ends = by_hash.agg(F.min(ID).alias("first_id"), F.max(ID).alias("last_id"))
        return ends.where("first_id < last_id").drop("last_id")
    holders = lines.select("h1", "h2", ID).distinct().groupBy("h1", "h2")
    counted = holders.agg(F.min(ID).alias("first_id"), F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_documents).drop("n")


def _without(cells: Column, drops: Column) -> Column:
    """The cells at other positions than the sorted ``drops``, joined again: the runs between them."""

    def run(i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.get(drops, i - 1) + 1)
        end = F.when(i == F.size(drops), F.size(cells)).otherwise(F.get(drops, i))
        return F.slice(cells, start + 1, end - start)

    return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(drops)), run)), "\n")

"""Hard negatives by the threshold algorithm: sorted lists per dimension, random access for scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.vectors import packed, padded, piece_of, pieces, sound, values
from quayside.scratch import Workspace

#: Stands for an id that is NULL; such rows come after all others of their score.
NO_ID = np.iinfo(np.int64).max
#: How deep the lists are read at first; every further round reads as much again.
FIRST = 32
#: Once more than one of so many rows has been met, the others are looked up at once: from there on
#: reading the lists takes longer than the products that are left.
SCAN = 8
#: A task holds some blocks and reads about so many anchors, or more so that there are no more than
#: so many tasks (or four for each core): what the driver keeps grows with the tasks, and pairs are many.
STRIPE_ROWS, TASKS = 1024, 500
#: From so many blocks on a task holds several at once, with their lists up to so many bytes. Each
#: anchor is sent to every task that holds other blocks.
SINGLE_BLOCKS, HELD_BYTES = 64, 1 << 27
SENT = ["group", "row", "id", "label", "x"]
FOUND = "anchor_row long, window long, other_row long, other_id long, score long"


@dataclass(frozen=True)
class Mining:
    """Parameters.

    Components are counted in units of 1 / ``scale``, rounded down. An anchor has its best
    ``positives`` rows of the same label. For each of them the best ``negatives`` rows of
    another label are wanted whose score is at least ``least`` and at most ``most`` percent of
    the positive's. Candidates are dealt in blocks of about ``block_rows`` and anchors in groups
    of about ``group_rows``; a task reads a block and then one group after the other.
    """

    scale: int = 256
    positives: int = 5
    negatives: int = 3
    least: int = 50
    most: int = 95
    block_rows: int = 8192
    group_rows: int = 128


def hard_negatives(rows: DataFrame, anchors: Column, p: Mining | None = None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id``, ``label`` and ``embedding``; ``anchors`` is a condition on these.
    A row whose label or vector is NULL, or has a NULL or non-finite component, takes no part. A
    shorter vector counts as if it ended in zeros. Rows that repeat an id are rows of their own,
    so copies of an anchor are among its positives; a NULL id comes last among equal scores. A
    positive score of zero admits only zeros, a negative one nothing. Scores that may not fit 64
    bits are an error. Other columns are left out; an empty table gives no rows.

    Blocks of candidates keep a sorted list per dimension. An anchor reads each list from the
    end its own sign favours, looks up what it meets, and stops in a block once the bound on
    all rows not met, the sum of its products with the last entries read, is strictly below
    the last score wanted in each of its windows, or below the window. Where that does not come
    early, the rest of the block is looked up at once. The first pass finds positives, the second
    negatives; per anchor only what a block found is sent on, and ranked over all blocks.
    """
    p = p or Mining()
    work = Workspace(rows.sparkSession, "negatives")
    counted = F.transform("embedding", lambda c: F.floor(F.lit(p.scale) * c.cast("double")).cast("int"))
    kept = (
        rows.where(F.col("label").isNotNull() & sound(F.col("embedding")))
        .select(
            F.monotonically_increasing_id().alias("row"),
            F.col("vec_id").cast("long").alias("id"),
            F.col("label").cast("int").alias("label"),
            counted.alias("x"),
            F.coalesce(anchors, F.lit(False)).alias("anchor"),
        )
    )
    kept = work.table(kept, "rows")
    n, n_anchors, width, least, most = kept.agg(
        F.count("*"),
        F.count_if("anchor"),
        F.coalesce(F.max(F.size("x")), F.lit(0)),
        F.coalesce(F.min(F.array_min("x")), F.lit(0)),
        F.coalesce(F.max(F.array_max("x")), F.lit(0)),
    ).first()
    largest = width * max(abs(least), abs(most)) ** 2
    if largest >= 2**63:
        raise OverflowError("scores of these vectors do not fit 64 bits")
    kept = kept.withColumn("x", padded(F.col("x"), width, F.lit(0)))

    blocks = pieces(n, p.block_rows)
    dealt = kept.select(piece_of(F.col("row"), blocks).alias("block"), "row", "id", "label", "x")
    candidates = work.table(packed(dealt, "block", "", flat=("x",)), "blocks")
    groups = pieces(n_anchors, p.group_rows)
    asking = kept.where("anchor").select(piece_of(F.col("row"), groups).alias("group"), "row", "id", "label", "x")
    most_tasks = max(TASKS, 4 * rows.sparkSession.sparkContext.defaultParallelism)
    held, stripes, tasks = grid(blocks, groups, n_anchors, 20 * max(width, 1) * p.block_rows, most_tasks)
    shares = pieces(blocks, held)

    def best(asked: DataFrame, same_label: bool, k: int) -> DataFrame:
        """The best ``k`` rows of each anchor and window, over all blocks."""
        groups_of = packed(asked, "group", "", flat=("x",)).select(
            F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"),
            F.pmod("group", F.lit(stripes)).alias("stripe"), *SENT, "windows",
        )
        blocks_of = candidates.select(
            F.floor(F.col("block") / held).cast("int").alias("share"),
            F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("stripe"), F.lit(-1).alias("group"), *SENT[1:],
        )
        cell = F.col("share").cast("long") * stripes + F.col("stripe")
        task = F.floor(cell * tasks / F.lit(shares * stripes)).cast("int")
        pairs = (
            blocks_of.unionByName(groups_of, allowMissingColumns=True)
            .repartitionById(tasks, task)
            .sortWithinPartitions("share", "stripe", "group")
        )
        found = pairs.mapInArrow(searcher(width, largest, same_label, k), FOUND)
        order = [F.desc("score"), F.asc("other_id"), F.asc("other_row")]
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("anchor_row", "window").orderBy(*order)))
        return ranked.where(F.col("rank") <= k)

    anything = F.array(F.struct(*[F.lit(v).cast("long").alias(c) for c, v in (("window", 0), ("low", -(2**62)), ("high", 2**62))]))
    positives = work.table(best(asking.withColumn("windows", anything), True, p.positives), "positives")
    # 100 * score >= least * positive and <= most * positive, in whole numbers
    score = F.col("score").cast("decimal(38,0)")
    bounds = positives.where("score >= 0").select(
        "anchor_row",
        F.col("score").alias("window"),
        F.ceil(score * p.least / F.lit(100).cast("decimal(3,0)")).cast("long").alias("low"),
        F.floor(score * p.most / F.lit(100).cast("decimal(3,0)")).cast("long").alias("high"),
    )
    windows = bounds.groupBy("anchor_row").agg(F.collect_set(F.struct("window", "low", "high")).alias("windows"))
    windowed = asking.join(windows.withColumnRenamed("anchor_row", "row"), "row")
    negatives = best(windowed, False, p.negatives).select(
        "anchor_row", "rank", F.col("window").alias("positive_score"), known("other_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    named = positives.join(kept.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id")), "anchor_row")
    return named.select(
        "anchor_row", "anchor_id", known("other_id").alias("positive_id"), F.col("score").alias("positive_score")
    ).join(negatives, ["anchor_row", "positive_score"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def grid(blocks: int, groups: int, n_anchors: int, block_bytes: int, most_tasks: int) -> tuple[int, int, int]:
    """How many blocks a task holds at once, in how many stripes the groups of anchors go to them, and how many tasks there are."""
    held = max(1, min(blocks // SINGLE_BLOCKS, HELD_BYTES // block_bytes))
    shares = pieces(blocks, held)
    stripes = max(1, min(pieces(n_anchors, STRIPE_ROWS), groups, most_tasks // shares))
    return held, stripes, min(shares * stripes, most_tasks)


def known(column: str) -> Column:
    return F.when(F.col(column) != int(NO_ID), F.col(column))


class SortedLists:
    """A block of rows with a sorted list per dimension."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.order = np.argsort(x, axis=0, kind="stable").astype(np.int32)
        self.sorted = np.take_along_axis(x, self.order, axis=0)

    def rounds(self, anchor: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int | None]]:
        """Rows met for the first time, their scores, and a bound on the rows not met (None: all are)."""
        n = len(self.x)
        rising = anchor >= 0
        ends = {True: np.flatnonzero(rising), False: np.flatnonzero(~rising)}
        met = np.zeros(n, dtype=bool)
        low, high = 0, FIRST
        while low < n:
            high = min(high, n)
            now = np.zeros(n, dtype=bool)
            now[self.order[n - high : n - low, ends[True]].ravel()] = True
            now[self.order[low:high, ends[False]].ravel()] = True
            now &= ~met
            met |= now
            new = np.flatnonzero(now)
            last = np.where(rising, self.sorted[n - high], self.sorted[high - 1])
            bound = None if high == n or met.all() else int(last @ anchor)
            yield new, (self.x[new] @ anchor).astype(np.int64), bound
            if bound is None:
                return
            if SCAN * np.count_nonzero(met) > n:
                rest = np.flatnonzero(~met)
                yield rest, (self.x @ anchor)[rest].astype(np.int64), None
                return
            low, high = high, 2 * high

    def best(self, anchor: np.ndarray, allowed: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        """Allowed rows and scores that hold the best ``k`` of each window ``low <= score <= high``."""
        rows, scores = [], []
        for new, score, bound in self.rounds(anchor):
            own = allowed[new] & (score >= low.min()) & (score <= high.max())
            rows.append(new[own])
            scores.append(score[own])
            if bound is None:
                break
            above = np.concatenate(scores)
            above = np.sort(above[above > bound])
            held = np.searchsorted(above, high, "right") - np.searchsorted(above, low, "left")
            if ((held >= k) | (bound < low)).all():
                break
        return np.concatenate(rows), np.concatenate(scores)


def searcher(width: int, largest: int, same_label: bool, k: int):
    """Reads blocks, each with the groups of anchors that ask it, gives what a block has for each anchor."""
    # sums of whole numbers are exact in floats that have bits enough for the largest
    kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else np.int64
    schema = pa.schema([(c.split()[0], pa.int64()) for c in FOUND.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                if (own := (batch.column("share")[i].as_py(), batch.column("stripe")[i].as_py())) != cell:
                    cell, held = own, []
                rows, labels = values(batch, "row", i), values(batch, "label", i)
                x = values(batch, "x", i).reshape(len(rows), width).astype(kind)
                if batch.column("group")[i].as_py() < 0:  # blocks come before the groups that ask them
                    held.append((rows.copy(), values(batch, "id", i, NO_ID).copy(), labels.copy(), SortedLists(x)))
                    continue
                windows = batch.column("windows")[i].as_py()
                bounds = [[np.array([w[c] for w in own], dtype=np.int64) for c in ("low", "high")] for own in windows]
                met: list[list[tuple]] = [[] for _ in rows]
                for own_rows, own_ids, own_labels, lists in held:
                    for row, label, anchor, (low, high), own in zip(rows, labels, x, bounds, met, strict=True):
                        allowed = (own_labels == label) & (own_rows != row) if same_label else own_labels != label
                        near, scores = lists.best(anchor, allowed, low, high, k)
                        own.append((own_rows[near], own_ids[near], scores))
                out = []
                for row, own, wanted, (low, high) in zip(rows, met, windows, bounds, strict=True):
                    if not own:
                        continue
                    near, ids, scores = map(np.concatenate, zip(*own, strict=True))
                    order = np.lexsort((near, ids, -scores))
                    near, ids, scores = near[order], ids[order], scores[order]
                    for w, lo, hi in zip(wanted, low, high, strict=True):
                        at = np.flatnonzero((scores >= lo) & (scores <= hi))[:k]
                        out += [(row, w["window"], near[j], ids[j], scores[j]) for j in at]
                if out:
                    cells = np.array(out, dtype=np.int64).T
                    yield pa.record_batch([pa.array(c) for c in cells], schema=schema)

    return run

"""Fixed-length windows of bytes or words that occur more than once, found without a row per window.

Every window of ``threshold`` units has an anchor: the leftmost smallest fingerprint among its
runs of ``gram`` units. Equal windows have equal anchors at equal places, so only windows whose
anchor fingerprints occur again can be repeats. An anchor owns the windows that chose it, a
range of starts. The starts are cut in blocks of ``block``, counted back from the anchor, so
that equal windows lie in blocks of the same alignment. All windows of a block share a core of
``threshold - block + 1`` units, and lie in a hull of ``threshold + block - 1``: a core found
once rules all of them out, a hull found twice proves all of them at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.buffers import BYTE_VALUES, ByteRuns, FieldRuns, Runs, Words, document_runs, text_buffer
from quayside.llm.common import ID, TEXT_HASH, keyed
from quayside.scratch import Workspace

#: Units that are worked on at once; of bytes fewer, so that what is made of them stays in the processor's cache.
PART = 1 << 20
BYTE_PART = 1 << 18
PLACE = np.uint64((1 << 24) - 1)
KEY = [ID, TEXT_HASH]

Values = Callable[[int, int], np.ndarray]


@dataclass(frozen=True)
class Scheme:
    unit: str
    threshold: int
    gram: int
    block: int

    @property
    def width(self) -> int:
        """Grams in a window."""
        return self.threshold - self.gram + 1

    @property
    def core(self) -> int:
        return self.threshold - self.block + 1

    @property
    def hull(self) -> int:
        return self.threshold + self.block - 1


def sequences(scheme: Scheme, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, Values]]:
    """For ranges of documents: the first, where each begins (and the last ends), and values: bytes or hashes of words."""
    data, offsets = text_buffer(texts)
    if scheme.unit == "byte":
        if len(texts):
            yield 0, offsets, lambda lo, hi: data[lo:hi]
        return
    for first, last in document_runs(offsets):
        words = Words(data, offsets, first, last)
        yield first, words.begins, lambda lo, hi, w=words: w.values[lo:hi]


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    n = len(x)
    padded = np.full(-(-n // width) * width, np.iinfo(x.dtype).max, dtype=x.dtype)
    padded[:n] = x
    rows = padded.reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def _parts(begins: np.ndarray, scheme: Scheme) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents, and where they start and end, of about ``PART`` units; long ones are cut with an overlap."""
    most = min(PART, BYTE_PART) if scheme.unit == "byte" else PART
    for first, last in document_runs(begins, most):
        b, e = int(begins[first]), int(begins[last])
        if last - first == 1 and e - b > most:
            for start in range(b, e - scheme.threshold + 1, most):
                end = min(e, start + most + scheme.threshold - 1)
                yield np.array([first]), np.array([start]), np.array([end])
        else:
            yield np.arange(first, last), begins[first:last], begins[first + 1 : last + 1]


def _anchors(scheme: Scheme, values: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Which document, anchor, first and last start, and fingerprint, of the runs of windows with one anchor."""
    counts = np.maximum(ends - starts - scheme.threshold + 1, 0)
    if not counts.any():
        return None
    if values.dtype == np.uint8:
        values = BYTE_VALUES[values]
    prints = Runs(values).everywhere(scheme.gram)
    place = np.arange(len(prints), dtype=np.uint64)
    lowest = sliding_minimum((prints & ~PLACE) | place, scheme.width)
    window = np.arange(counts.sum()) + np.repeat(starts - (np.cumsum(counts) - counts), counts)
    anchor = (lowest[window] & PLACE).astype(np.int64)
    doc = np.repeat(np.arange(len(starts)), counts)
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]))))
    end = np.concatenate((new[1:], [len(window)])) - 1
    return doc[new], anchor[new], window[new], window[end], prints[anchor[new]]


def _emit_anchors(scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, begins, values in sequences(scheme, batch.column(2)):
                for docs, starts, ends in _parts(begins, scheme):
                    lo, hi = int(starts[0]), int(ends[-1])
                    found = _anchors(scheme, values(lo, hi), starts - lo, ends - lo)
                    if found is None:
                        continue
                    which, anchor, w0, w1, prints = found
                    doc = docs[which]
                    shift = lo - begins[doc]
                    rows = pa.array(first + doc)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(rows),
                            batch.column(1).take(rows),
                            pa.array(prints.view(np.int64)),
                            *[pa.array(x + shift) for x in (anchor, w0, w1)],
                        ],
                        [*KEY, "print", "anchor", "first", "last"],
                    )

    return run


def anchored_documents(docs: DataFrame, scheme: Scheme, work: Workspace) -> DataFrame:
    """``_id, _text_hash, text, anchors``: the documents with anchors that occur again, and those anchors."""
    base = keyed(docs).select(*KEY, "text")
    anchors = base.mapInArrow(
        _emit_anchors(scheme),
        f"{ID} long, {TEXT_HASH} long, print long, anchor long, first long, last long",
    )
    anchors = work.table(anchors, "anchors")
    # A table of its own, so that Spark shuffles both sides of the join and splits a hot print.
    again = anchors.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print")
    again = work.table(again, "again")
    own = (
        anchors.join(again, "print")
        .groupBy(*KEY)
        .agg(F.collect_set(F.struct("anchor", "first", "last")).alias("anchors"))
    )
    out = work.table(base.join(own, KEY), "documents")
    work.drop("anchors", "again")
    return out


def requests(
    scheme: Scheme, batch: pa.RecordBatch, fields: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, Values]]:
    """For ranges of documents of ``(key, key, text, array<struct>)``: row of each request, where its
    document begins, the request's numbers ``[field, request]``, and values."""
    lists = batch.column(3)
    counts = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    numbers = np.stack([flat.field(i).to_numpy() for i in range(fields)])
    ends = np.cumsum(counts)
    for first, begins, values in sequences(scheme, batch.column(2)):
        last = first + len(begins) - 1
        row = np.repeat(np.arange(first, last), counts[first:last])
        lo, hi = (ends[first] - counts[first], ends[last - 1]) if last > first else (0, 0)
        yield row, begins[row - first], numbers[:, lo:hi], values


def fingerprints(
    values: Values, starts: np.ndarray, lengths: list[tuple[int, int]], base: int = 0
) -> np.ndarray:
    """Fingerprints ``[run, start]`` of the runs of ``(offset, length)`` at absolute starts.

    The starts may come in any order; runs that leave the text give anything.
    """
    out = np.zeros((len(lengths), len(starts)), dtype=np.uint64)
    if not len(starts):
        return out
    order = np.argsort(starts, kind="stable")
    ordered = starts[order]
    before = max(0, -min(o for o, _ in lengths))
    after = max(o + n for o, n in lengths)
    most = min(PART, BYTE_PART) if values(0, 0).dtype == np.uint8 else PART
    at = 0
    while at < len(ordered):
        lo = max(0, int(ordered[at]) - before)
        to = int(np.searchsorted(ordered, ordered[at] + most))
        part = values(lo, int(ordered[to - 1]) + after)
        runs = (ByteRuns if part.dtype == np.uint8 else FieldRuns)(part, base)
        own = ordered[at:to] - lo
        for k, (offset, length) in enumerate(lengths):
            inside = (own + offset >= 0) & (own + offset + length <= len(part))
            out[k, order[at:to][inside]] = runs.at((own + offset)[inside], length)
        at = to
    return out


def blocks_of(scheme: Scheme, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The blocks of ``[anchor, first, last]``: which anchor, head (the last start it may have), first, last."""
    anchor, first, last = numbers
    low, high = (anchor - last) // scheme.block, (anchor - first) // scheme.block
    counts = high - low + 1
    which = np.repeat(np.arange(len(anchor)), counts)
    step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + low[which]
    head = anchor[which] - scheme.block * step
    return which, head, np.maximum(first[which], head - scheme.block + 1), np.minimum(last[which], head)


def emit_blocks(scheme: Scheme, names: list[tuple[int, int]]):
    """Documents with anchors to blocks: head, first and last start, names of runs at the head, hull.

    ``names`` are (offset, length); the hull is NULL for a block that is not whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, begin, numbers, values in requests(scheme, batch, 3):
                which, head, first, last = blocks_of(scheme, numbers)
                if not len(which):
                    continue
                at = begin[which] + head
                found = fingerprints(values, at, names)
                hull = fingerprints(values, at, [(1 - scheme.block, scheme.hull)], base=1)[0]
                part = (first > head - scheme.block + 1) | (last < head)
                rows = pa.array(row[which])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        *[pa.array(x) for x in (head, first, last)],
                        *[pa.array(x.view(np.int64)) for x in found],
                        pa.array(hull.view(np.int64), mask=part),
                    ],
                    [*KEY, "head", "first", "last", *[f"name{i}" for i in range(len(names))], "hull"],
                )

    return run


def block_schema(names: int) -> str:
    return f"{ID} long, {TEXT_HASH} long, head long, first long, last long, " + "".join(
        f"name{i} long, " for i in range(names)
    ) + "hull long"


def judge_hulls(blocks: DataFrame, core: list[str], work: Workspace, name: str) -> DataFrame:
    """Blocks of cores that occur again, with ``solved`` (its hull occurs again) and ``probe``.

    Probes are the blocks whose windows are to be compared one by one: the unsolved ones and,
    for them to be compared with, one block of each hull of the same core.
    """
    place = F.struct(*KEY, "head", "first", "last")
    hulls = blocks.groupBy(*core, "hull").agg(F.count("*").alias("n"), F.min(place).alias("one"))
    alone = F.col("hull").isNull() | (F.col("n") == 1)
    cores = hulls.groupBy(*core).agg(F.max(alone).alias("unsolved"), F.sum("n").alias("total"))
    hulls = work.table(hulls.join(cores.where("total > 1").drop("total"), core), f"{name}-hulls")
    solved = ~alone
    other = hulls.select(*[F.col(c).alias(f"_{c}") for c in core], F.col("hull").alias("_hull"), "n", "one", "unsolved")
    same = F.col("hull").eqNullSafe(F.col("_hull"))
    for c in core:
        same = same & (F.col(c) == F.col(f"_{c}"))
    judged = (
        blocks.join(other, same)
        .withColumn("solved", solved)
        .withColumn("probe", ~solved | (F.col("unsolved") & (F.col("one") == place)))
        .select(*KEY, "head", "first", "last", "solved", "probe")
    )
    judged = work.table(judged, name)
    work.drop(f"{name}-hulls")
    return judged


def refined(documents: DataFrame, judged: DataFrame, scheme: Scheme, block: int, work: Workspace) -> DataFrame:
    """The probes in smaller blocks, judged again: what is left at the ends of repeats is small."""
    fine = replace(scheme, block=block)
    heads = F.collect_set(F.struct(F.col("head").alias("anchor"), "first", "last")).alias("anchors")
    own = judged.where("probe").groupBy(*KEY).agg(heads)
    blocks = documents.select(*KEY, "text").join(own, KEY)
    blocks = blocks.mapInArrow(emit_blocks(fine, [(0, fine.core)]), block_schema(1))
    blocks = work.table(blocks, "small-blocks")
    ends = judge_hulls(blocks, ["name0"], work, "ends")
    work.drop("small-blocks")
    return ends


def with_probes(documents: DataFrame, judged: DataFrame) -> DataFrame:
    """The documents of the probes: ``_id, _text_hash, text, probes``."""
    own = judged.where("probe").groupBy(*KEY).agg(F.collect_set(F.struct("first", "last")).alias("probes"))
    return documents.select(*KEY, "text").join(own, KEY)


def starts_of(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All starts of ``[first, last]``, and whose they are."""
    first, last = numbers
    counts = last - first + 1
    which = np.repeat(np.arange(len(first)), counts)
    return which, np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + first[which]


def repeated_ranges(judged: DataFrame, starts: DataFrame) -> DataFrame:
    """``_id, _text_hash, ranges``: first and last start of repeated windows, per document."""
    whole = judged.where("solved").select(*KEY, "first", "last")
    single = starts.select(*KEY, F.col("start").alias("first"), F.col("start").alias("last"))
    return (
        whole.unionByName(single).groupBy(*KEY).agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    )


def merged(first: np.ndarray, last: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs ``[start, end)`` that the windows of a document cover."""
    order = np.argsort(first)
    start, end = first[order], np.maximum.accumulate(last[order] + threshold)
    new = np.concatenate(([True], start[1:] > end[:-1]))
    return start[new], end[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(end) - 1]))]

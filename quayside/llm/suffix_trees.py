"""Word sequences that occur again anywhere: suffix trees of groups that share a prefix."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import ID, TEXT_HASH, keyed
from quayside.llm.windows import (
    KEY,
    Scheme,
    anchored_documents,
    block_schema,
    emit_blocks,
    fingerprints,
    judge_hulls,
    merged,
    refined,
    repeated_ranges,
    requests,
    starts_of,
    with_probes,
)
from quayside.scratch import Workspace

#: Edges of a suffix's path from the root to the threshold.
EDGES = 5

#: Suffixes of one subtree; a larger group is split by a longer prefix.
GROUP = 100_000


def edges(threshold: int) -> list[tuple[int, int]]:
    """Offset and length of the parts that a suffix of ``threshold`` words is cut in."""
    n = min(EDGES, threshold)
    borders = [threshold * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(borders, borders[1:], strict=False)]


def repeated_sequences(
    docs: DataFrame, work: Workspace, threshold: int = 35, group: int = GROUP
) -> tuple[DataFrame, DataFrame]:
    """``(documents, ranges)``: texts that may repeat, and the starts of windows that occur again.

    A window is a suffix, cut after ``threshold`` words. Suffixes are first grouped by the
    prefix of their block (see ``windows``), then of a smaller block: a group of one has no
    internal node deep enough, and hulls that occur again stand for their suffixes as one
    leaf. The other suffixes get a
    path of ``EDGES`` edges, names of the words between two depths. Prefixes of one edge
    split them; a group of more than ``group`` suffixes is split by two edges, and so on, so
    that a group fits in a task. What still is larger at the full depth is one internal node,
    all of whose leaves are repeats. Each task sorts the paths of its groups, which lists the
    leaves of the subtrees in order: neighbours whose common prefix reaches the threshold
    hang below an internal node of that depth.
    """
    scheme = Scheme("word", threshold, gram=max(1, threshold * 12 // 35), block=max(1, threshold * 8 // 35))
    texts = anchored_documents(docs, scheme, work)
    blocks = texts.mapInArrow(emit_blocks(scheme, [(0, scheme.core)]), block_schema(1))
    blocks = work.table(blocks, "blocks")
    judged = judge_hulls(blocks, ["name0"], work, "judged")
    work.drop("blocks")
    ends = refined(texts, judged, scheme, max(1, scheme.block // 4), work)
    judged = judged.where("solved").unionByName(ends.where("solved"))
    parts = edges(threshold)
    path = [f"edge{i}" for i in range(len(parts))]
    suffixes = with_probes(texts, ends).mapInArrow(
        _emit_suffixes(parts, path), f"{ID} long, {TEXT_HASH} long, start long, " + ", ".join(f"{e} long" for e in path)
    )
    suffixes = work.table(suffixes, "suffixes")
    return texts, repeated_ranges(judged, _below_deep_nodes(suffixes, path, group, work))


def _below_deep_nodes(suffixes: DataFrame, path: list[str], group: int, work: Workspace) -> DataFrame:
    """``_id, _text_hash, start`` of the suffixes that share their whole path with another."""
    rest, deep = suffixes, None
    for depth in range(1, len(path) + 1):
        prefix = path[:depth]
        sizes = rest.groupBy(*prefix).agg(F.count("*").alias("n")).where("n > 1")
        sizes = work.table(sizes, f"prefixes{depth}")
        largest = sizes.agg(F.max("n")).first()[0] or 0
        last = depth == len(path)
        fits = sizes if last else sizes.where(F.col("n") <= group)
        found = rest.join(fits.drop("n"), prefix)
        if not last:
            found = _subtrees(found, prefix, path)
        found = found.select(*KEY, "start")
        deep = found if deep is None else deep.unionByName(found)
        if largest <= group or last:
            return deep
        rest = rest.join(sizes.where(F.col("n") > group).drop("n"), prefix)
    return deep


def _subtrees(suffixes: DataFrame, prefix: list[str], path: list[str]) -> DataFrame:
    """The suffixes below an internal node at full depth; a prefix's suffixes are in one task, together."""
    grouped = suffixes.withColumn("group", F.xxhash64(*prefix)).select("group", *KEY, "start", *path)
    grouped = grouped.repartition("group").sortWithinPartitions("group", *path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            ids = held.column(0).to_numpy()
            whole = int(np.searchsorted(ids != ids[-1], False)) if len(ids) else 0
            if whole:
                yield from _leaves(held.slice(0, whole), path)
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield from _leaves(held, path)

    return grouped.mapInArrow(run, f"{ID} long, {TEXT_HASH} long, start long")


def _leaves(rows: pa.Table, path: list[str]) -> Iterator[pa.RecordBatch]:
    """Leaves of whole groups, in the order of their paths, below nodes of full depth."""
    columns = [rows.column("group").to_numpy(), *[rows.column(e).to_numpy() for e in path]]
    together = np.ones(rows.num_rows - 1, dtype=bool)
    common = np.zeros(rows.num_rows - 1, dtype=np.int64)
    for column in columns:
        together &= column[1:] == column[:-1]
        common += together
    deep = common == len(columns)
    below = np.concatenate((deep, [False])) | np.concatenate(([False], deep))
    yield from rows.select([*KEY, "start"]).filter(pa.array(below)).combine_chunks().to_batches()


def _emit_suffixes(parts: list[tuple[int, int]], path: list[str]):
    scheme = Scheme("word", parts[-1][0] + parts[-1][1], 1, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, begin, numbers, values in requests(scheme, batch, 2):
                which, start = starts_of(numbers)
                if not len(which):
                    continue
                found = fingerprints(values, begin[which] + start, parts, base=1)
                rows = pa.array(row[which])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(start),
                        *[pa.array(x.view(np.int64)) for x in found],
                    ],
                    [*KEY, "start", *path],
                )

    return run


def cut_repeated_sequences(docs: DataFrame, threshold: int = 35, group: int = GROUP) -> DataFrame:
    """The documents that lose words: ``_id, _text_hash, spans, n_removed, kept_text``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes if a window of ``threshold``
    consecutive words that covers it also starts anywhere else, in the same document or
    another one; windows do not cross documents and are judged on the texts as they came.
    ``spans`` are the maximal runs ``(start, end)`` of words removed, ``kept_text`` the other
    words joined by one space.

    Texts that are NULL, empty or of fewer words lose nothing. Rows that repeat an id and text
    are documents that repeat each other and share a row here. An empty table gives no rows;
    columns besides ``doc_id`` and ``text`` are ignored.
    """
    work = Workspace(docs.sparkSession, "suffix-trees")
    texts, ranges = repeated_sequences(docs, work, threshold, group)
    return (
        texts.select(*KEY, "text")
        .dropDuplicates(KEY)
        .join(ranges, KEY)
        .mapInArrow(
            _cut(threshold),
            f"{ID} long, {TEXT_HASH} long, spans array<struct<start:long,end:long>>, n_removed long, kept_text string",
        )
    )


def _cut(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists = batch.column(2), batch.column(3)
            counts = np.diff(lists.offsets.to_numpy())
            ends = np.cumsum(counts)
            flat = lists.flatten()
            first, last = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            spans, removed, kept = [], [], []
            for i in range(batch.num_rows):
                own = slice(ends[i] - counts[i], ends[i])
                start, end = merged(first[own], last[own], threshold)
                words = texts[i].as_py().encode().split()
                cuts = np.concatenate(([0], np.stack([start, end], axis=1).ravel(), [len(words)]))
                left = [w for a, b in cuts.reshape(-1, 2) for w in words[a:b]]
                kept.append(b" ".join(left).decode())
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(start, end, strict=True)])
                removed.append(int((end - start).sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                [*KEY, "spans", "n_removed", "kept_text"],
            )

    return run


def words_digest(docs: DataFrame) -> DataFrame:
    """``_id, _text_hash, doc_id, n_words, joined_sha256`` of the words joined by one space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests = [], []
            for text in batch.column(3).to_pylist():
                words = text.encode().split()
                counts.append(len(words))
                digests.append(sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(3)], pa.array(counts, pa.int64()), pa.array(digests, pa.string())],
                [*KEY, "doc_id", "n_words", "joined_sha256"],
            )

    return keyed(docs).mapInArrow(
        run, f"{ID} long, {TEXT_HASH} long, doc_id long, n_words long, joined_sha256 string"
    )

"""Byte strings that occur again anywhere: distributed prefix doubling over chosen positions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.buffers import text_buffer
from quayside.llm.common import ID, TEXT_HASH
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


def doubling(scheme: Scheme) -> list[tuple[int, int]]:
    """Offset and length of the runs whose names are paired: 0, then 2**k at 2**k, to the core's end.

    The first run has twice the length of an anchor's gram, as shorter ones are known to occur
    again; the last is moved back to end with the core.
    """
    out, done = [(0, min(2 * scheme.gram, scheme.core))], min(2 * scheme.gram, scheme.core)
    while done < scheme.core:
        out.append((min(done, scheme.core - done), done))
        done = min(2 * done, scheme.core)
    return out


def repeated_strings(docs: DataFrame, work: Workspace, threshold: int = 400) -> tuple[DataFrame, DataFrame]:
    """``(documents, ranges)``: texts that may repeat, and the starts of strings that occur again.

    Positions are sampled: block heads near anchors, see ``windows``. A position's rank at
    length L names its first L bytes. Each round pairs a position's rank with the name of the
    run at the next offset, groups the pairs, gives each pair a rank and drops the positions
    whose pair is unique, until the length is that of a core; the offsets double. Names are
    64-bit fingerprints, which do not depend on other tasks, so that the run at the offset
    need not be a sampled position too. What is left is settled by the hulls and, at the ends
    of repeats, by smaller blocks and then by the names of single strings of ``threshold``
    bytes (128 bits).
    """
    scheme = Scheme("byte", threshold, gram=max(1, threshold * 4 // 25), block=max(1, threshold * 2 // 25))
    texts = anchored_documents(docs, scheme, work)
    runs = doubling(scheme)
    positions = texts.mapInArrow(emit_blocks(scheme, runs), block_schema(len(runs)))
    positions = work.table(positions, "positions").withColumnRenamed("name0", "rank")
    for k in range(1, len(runs)):
        pair = ["rank", f"name{k}"]
        ranked = (
            positions.groupBy(*pair)
            .agg(F.count("*").alias("n"))
            .where("n > 1")
            .select(*pair, F.xxhash64(F.lit(k), *pair).alias("next_rank"))
        )
        ranked = work.table(ranked, f"pairs{k}")
        positions = positions.join(ranked, pair).drop(*pair).withColumnRenamed("next_rank", "rank")
        positions = work.table(positions, f"rank{k}")
        work.drop(f"pairs{k}", "positions" if k == 1 else f"rank{k - 1}")
    judged = judge_hulls(positions, ["rank"], work, "judged")
    work.drop("positions" if len(runs) == 1 else f"rank{len(runs) - 1}")
    ends = refined(texts, judged, scheme, max(1, scheme.block // 4), work)
    judged = judged.where("solved").unionByName(ends.where("solved"))
    names = with_probes(texts, ends).mapInArrow(
        _emit_strings(scheme), f"{ID} long, {TEXT_HASH} long, start long, a long, b long"
    )
    names = work.table(names, "names")
    again = names.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b")
    again = work.table(again, "again")
    return texts, repeated_ranges(judged, names.join(again, ["a", "b"]).select(*KEY, "start"))


def _emit_strings(scheme: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, begin, numbers, values in requests(scheme, batch, 2):
                which, start = starts_of(numbers)
                if not len(which):
                    continue
                at = begin[which] + start
                a, b = (fingerprints(values, at, [(0, scheme.threshold)], base)[0] for base in (0, 1))
                rows = pa.array(row[which])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(start),
                        pa.array(a.view(np.int64)),
                        pa.array(b.view(np.int64)),
                    ],
                    [*KEY, "start", "a", "b"],
                )

    return run


def cut_repeated_strings(docs: DataFrame, threshold: int = 400) -> DataFrame:
    """The documents that lose bytes: ``_id, _text_hash, spans, n_removed, kept``.

    A byte goes if a string of ``threshold`` bytes that covers it also starts anywhere else,
    in the same document or another one; matches do not cross documents, and strings are
    judged on the texts as they came. ``spans`` are the maximal runs ``(start, end)`` removed,
    ``kept`` (binary) is what remains, which may cut a character in two.

    Texts that are NULL, empty or shorter than ``threshold`` lose nothing. Rows that repeat an
    id and text are documents that repeat each other and share a row here. An empty table
    gives no rows; columns besides ``doc_id`` and ``text`` are ignored.
    """
    work = Workspace(docs.sparkSession, "suffix-array")
    texts, ranges = repeated_strings(docs, work, threshold)
    return (
        texts.select(*KEY, "text")
        .dropDuplicates(KEY)
        .join(ranges, KEY)
        .mapInArrow(
            _cut(threshold),
            f"{ID} long, {TEXT_HASH} long, spans array<struct<start:long,end:long>>, n_removed long, kept binary",
        )
    )


def _cut(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            lists = batch.column(3)
            counts = np.diff(lists.offsets.to_numpy())
            ends = np.cumsum(counts)
            flat = lists.flatten()
            first, last = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            spans, removed, kept = [], [], []
            for i in range(batch.num_rows):
                own = slice(ends[i] - counts[i], ends[i])
                start, end = merged(first[own], last[own], threshold)
                text = data[offsets[i] : offsets[i + 1]]
                cuts = np.concatenate(([0], np.stack([start, end], axis=1).ravel(), [len(text)]))
                kept.append(b"".join(text[a:b].tobytes() for a, b in cuts.reshape(-1, 2)))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(start, end, strict=True)])
                removed.append(int((end - start).sum()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()),
                ],
                [*KEY, "spans", "n_removed", "kept"],
            )

    return run

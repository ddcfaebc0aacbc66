"""Land a stream: every micro-batch goes through the batch code."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from quayside.batch import Batch
from quayside.sinks.tables import TableSink, land_tables

# The ways to append, and how often a stream does.
FILE_LOADS, STREAMING_INSERTS = "FILE_LOADS", "STREAMING_INSERTS"
EXACTLY_ONCE, AT_LEAST_ONCE = "STORAGE_WRITE_API", "STORAGE_API_AT_LEAST_ONCE"
STORAGE_METHODS = (EXACTLY_ONCE, AT_LEAST_ONCE)
TRIGGER = "60 seconds"


def land_stream(
    rows: DataFrame,
    read: Callable[[DataFrame], Batch],
    sink: TableSink,
    checkpoint: str,
    *,
    steps: Iterable[Callable[[Batch], Batch]] = (),
    method: str = EXACTLY_ONCE,
    trigger: str = TRIGGER,
    available_now: bool = False,
) -> StreamingQuery:
    """Start a stream that reads, transforms and appends every micro-batch.

    The checkpoint holds the offsets and the stream's own id. With ``STORAGE_WRITE_API`` a
    micro-batch is committed under that id and its number, and a batch that is replayed after
    a failure is not appended again; the other methods append again. The storage methods
    leave out columns that an existing table does not have, the others add them. A batch that
    fails stops the stream, which then goes on from the checkpoint.
    """
    if method in STORAGE_METHODS:
        sink = replace(sink, unknown_columns="ignore")

    def land(batch: Batch, batch_id: str) -> None:
        land_tables(batch, sink, batch_id if method == EXACTLY_ONCE else None)

    return each_batch(rows, read, steps, land, checkpoint, trigger, available_now)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in the checkpoint: the same after a restart, another for each stream."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def each_batch(
    rows: DataFrame,
    read: Callable[[DataFrame], Batch],
    steps: Iterable[Callable[[Batch], Batch]],
    write: Callable[[Batch, str], None],
    checkpoint: str,
    trigger: str = TRIGGER,
    available_now: bool = False,
) -> StreamingQuery:
    """Read, transform and write every micro-batch; ``write`` gets an id that replays repeat."""
    steps = list(steps)

    def run(micro: DataFrame, number: int) -> None:
        # Discovery and the writes all read the micro-batch; fetch it once.
        micro = micro.persist()
        try:
            batch = read(micro)
            for step in steps:
                batch = step(batch)
            write(batch, f"{stream_id(micro.sparkSession, checkpoint)}-{number}")
        finally:
            micro.unpersist()

    writer = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()

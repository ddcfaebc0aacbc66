"""Land batches as files: ``table=<name>/meta_load_date=<day>/<shard>-<load id><suffix>``."""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame

from quayside.batch import ERROR_SUFFIX, META, TABLE, Batch, LandingError, quoted, session, visible
from quayside.scratch import delete_folder, scratch
from quayside.sinks.commits import Folder
from quayside.sinks.tables import FEW_TABLES, TABLES_AT_ONCE, known_tables, split_by_table

STAGE = "_temporary"


@dataclass(frozen=True)
class FileSink:
    """Where and how: ``format`` is any file format that Spark can write."""

    root: str
    directory: str = "default"
    error_suffix: str = ERROR_SUFFIX
    suffix: str = ".avro"
    shards: int | None = None
    format: str = "avro"


def land_files(batch: Batch, sink: FileSink, day: datetime | None = None) -> str:
    """Write good rows and rejects below the root; returns the id of this load.

    A file has just the columns of its destination. Files are written by Spark in a staging
    folder below the root, and get their names by renames once all of them are complete.
    """
    load_id = str(uuid.uuid4())
    date = (day or datetime.now(UTC)).strftime("%Y-%m-%d")
    spark = session(batch.good)
    stage = f"{STAGE}/{load_id}"
    folder = Folder(spark, sink.root.rstrip("/"))
    try:
        written = write_side(
            batch.good, batch.layout, known_tables(batch), sink, sink.directory, f"{stage}/good", batch.names
        )
        if batch.bad_tables != []:
            tables = batch.bad_tables if batch.routed else [None]
            written |= write_side(
                batch.bad, None, tables, sink, sink.directory + sink.error_suffix, f"{stage}/bad", {}
            )
        moves = [
            (f"{own}/{name}", f"table={table}/meta_load_date={date}/{file_name(name, load_id, sink.suffix)}")
            for table, own in written.items()
            for name in folder.data_files(own)
        ]
        with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
            list(pool.map(lambda m: folder.move(*m), moves))
    finally:
        folder.delete(stage)
    return load_id


def file_name(name: str, load_id: str, suffix: str) -> str:
    """The shard of Spark's own file name, and its number where a task wrote several."""
    shard, part = re.match(r"part-(\d+)-.*?(?:[.-]c(\d+))?(?:\.|\Z)", name).groups()
    more = f"-{int(part)}" if part and int(part) else ""
    return f"{int(shard)}{more}-{load_id}{suffix}"


def write_side(
    df: DataFrame,
    layout: dict | None,
    tables: list | None,
    sink: FileSink,
    default: str,
    stage: str,
    names: dict[str, str],
) -> dict[str, str]:
    """Write a folder per destination; gives the folders that have files."""
    spark, root = session(df), sink.root.rstrip("/")
    written: dict[str, str] = {}

    def write(table: str | None, rows: DataFrame) -> None:
        columns = layout[table] if layout is not None and table in layout else visible(rows)
        rows = rows.select(*[quoted(c).alias(names.get(c, c)) for c in columns])
        if sink.shards:
            rows = rows.repartition(sink.shards)
        own = f"{stage}/{table if table is not None else default}"
        try:
            rows.write.format(sink.format).save(f"{root}/{own}")
        except AnalysisException as e:
            if "DATA_SOURCE" not in str(e.getCondition()) and "avro" not in str(e).lower():
                raise
            raise LandingError(f"this Spark cannot write {sink.format} files; set another format") from None
        written[table if table is not None else default] = own

    if tables is not None and len(tables) == 1:
        write(tables[0], df.drop(META, TABLE))
        return written
    parsed = scratch(spark, "stage")
    try:
        parts = split_by_table(df, parsed, few=tables is not None and len(tables) <= FEW_TABLES)
        with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
            for done in [pool.submit(inheritable_thread_target(write), t, rows) for t, rows in parts.items()]:
                done.result()
    finally:
        delete_folder(spark, parsed)
    return written

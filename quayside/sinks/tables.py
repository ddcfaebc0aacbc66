"""Land batches in catalog tables: one table per destination, schemas that may grow."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce
from zlib import crc32

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.batch import (
    ERROR_SUFFIX,
    META,
    TABLE,
    Batch,
    LandingError,
    quoted,
    session,
    visible,
)
from quayside.operators.stage import staged
from quayside.scratch import delete_folder, scratch
from quayside.sinks.commits import append_once, finish

# The dispositions and units a table can be written with.
CREATE_IF_NEEDED, CREATE_NEVER = "CREATE_IF_NEEDED", "CREATE_NEVER"
WRITE_APPEND, WRITE_TRUNCATE, WRITE_EMPTY = "WRITE_APPEND", "WRITE_TRUNCATE", "WRITE_EMPTY"
PARTITION_UNITS = {
    "HOUR": "HOUR", "DAY": "DAY", "MONTH": "MONTH", "YEAR": "YEAR", "TIMESTAMP": "DAY",
}
FEW_TABLES = 32
TABLES_AT_ONCE = 8


@dataclass(frozen=True)
class TableSink:
    """How to land; the defaults append and create what is missing.

    ``partition_by`` is ``(column, unit)``: rows are stored by that unit of time in a
    column ``<column>_<unit>``. ``unknown_columns`` says what happens to columns that the
    table does not have yet: they are added to it, or ignored.
    """

    dataset: str
    table: str | None = None
    project: str | None = None
    create: str = CREATE_IF_NEEDED
    write: str = WRITE_APPEND
    partition_by: tuple[str, str] | None = None
    error_suffix: str = ERROR_SUFFIX
    unknown_columns: str = "add"
    format: str = "parquet"

    def name(self, table: str) -> str:
        parts = (self.project, self.dataset, table)
        return ".".join(quoted_name(p) for p in parts if p)


def quoted_name(part: str) -> str:
    return "`" + part.replace("`", "``") + "`"


def land_tables(batch: Batch, sink: TableSink, batch_id: str | None = None) -> None:
    """Write good rows and rejects, each to the table it asks for.

    Rows that reach one table on several ways (without a table and by its default name, by spellings that
    the catalog holds for one, or rejects and rows routed to the error table) are one write.
    With a ``batch_id`` all tables are one commit: rows that an earlier attempt has committed under that id
    are not written again, so that a replayed micro-batch does not repeat rows. Rejects are
    stored by time only where they have the column.
    """
    spark = session(batch.good)
    if batch_id is not None:
        # several sinks of one micro-batch have a commit each
        stream, _, number = batch_id.rpartition("-")
        batch_id = f"{stream}.{crc32(repr(sink).encode()):08x}-{number}"
        if finish(spark, commits_of(spark, sink), batch_id):
            return
    stage = scratch(spark, "stage")
    default = None if sink.table is None else sink.table + sink.error_suffix
    try:
        routes = side_routes(batch.good, batch.layout, known_tables(batch), sink.table, f"{stage}/good", batch.names)
        good = len(routes)
        routes += side_routes(batch.bad, None, batch.bad_tables, default, f"{stage}/bad", {})
        by_table: dict[str, list[tuple[bool, str, DataFrame]]] = {}
        for i, (table, rows) in enumerate(routes):
            by_table.setdefault(sink.name(table).lower(), []).append((i < good, table, rows))

        def prepared(parts: list[tuple[bool, str, DataFrame]]) -> Write:
            table = parts[0][1]
            rows = merged([rows for _, _, rows in parts], sink, table)
            own = sink
            if sink.partition_by is not None and not any(is_good for is_good, _, _ in parts):
                if sink.partition_by[0] not in rows.columns:
                    own = replace(sink, partition_by=None)
            return prepare(rows, own, table, batch_id is not None)

        def write(parts: list[tuple[bool, str, DataFrame]]) -> None:
            prepared(parts).run()

        if batch_id is None:
            at_once(write, by_table.values())
        else:
            writes = at_once(prepared, by_table.values())
            append_once(spark, commits_of(spark, sink), batch_id, writes, at_once)
    finally:
        delete_folder(spark, stage)


def at_once(work: Callable, items: Iterable) -> list:
    """The results for all items; the jobs of different tables do not wait for each other."""
    items = list(items)
    if len(items) == 1:
        return [work(items[0])]
    with ThreadPoolExecutor(TABLES_AT_ONCE) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(work), item) for item in items]]


def known_tables(batch: Batch) -> list[str | None] | None:
    if batch.layout is not None:
        return list(batch.layout)
    return None if batch.routed else [None]


def side_routes(
    df: DataFrame,
    layout: dict | None,
    tables: list[str | None] | None,
    default: str | None,
    stage: str,
    names: dict[str, str],
) -> list[tuple[str, DataFrame]]:
    """Tables and their rows of one side; without known ``tables`` the rows tell, if there are any."""
    if tables == []:
        return []
    if tables is not None and len(tables) == 1:
        parts = {tables[0]: df}
    else:
        parts = split_by_table(df, stage, few=tables is not None and len(tables) <= FEW_TABLES)
    if None in parts and default is None:
        raise LandingError("no table is configured, and rows do not ask for one")
    routes = []
    for table, rows in parts.items():
        columns = {c: c for c in visible(rows)}
        if layout is not None and table in layout:
            columns = {c: names.get(c, c) for c in layout[table]}
        named = rows.select(*[quoted(c).alias(name) for c, name in columns.items()])
        routes.append((default if table is None else table, named))
    return routes


def merged(parts: list[DataFrame], sink: TableSink, table: str) -> DataFrame:
    """Rows for one table as one frame. Where their types differ they get the table's, else become text."""
    if len(parts) == 1:
        return parts[0]
    spark, name = session(parts[0]), sink.name(table)
    stored = {f.name.lower(): f for f in spark.table(name).schema} if spark.catalog.tableExists(name) else {}
    fields: dict[str, T.StructField] = {}
    for field in (f for part in parts for f in part.schema):
        key = field.name.lower()
        known = fields.setdefault(key, field)
        if known.dataType.simpleString() != field.dataType.simpleString():
            fields[key] = stored.get(key, T.StructField(known.name, T.StringType()))
    shaped = []
    for part in parts:
        own = {f.name.lower(): f for f in part.schema}
        cells = [
            fitted(quoted(own[key].name), own[key].dataType, field, name) if key in own else F.lit(None).cast(field.dataType)
            for key, field in fields.items()
        ]
        shaped.append(part.select(*[c.alias(field.name) for c, field in zip(cells, fields.values(), strict=True)]))
    return reduce(DataFrame.unionByName, shaped)


def commits_of(spark: SparkSession, sink: TableSink) -> str:
    """The folder of the dataset, where its commits are."""
    dataset = ".".join(quoted_name(p) for p in (sink.project, sink.dataset) if p)
    described = spark.sql(f"DESCRIBE DATABASE EXTENDED {dataset}").collect()
    return next(r[1] for r in described if r[0] == "Location").rstrip("/")


def split_by_table(df: DataFrame, stage: str, few: bool) -> dict[str | None, DataFrame]:
    """Rows by destination, parsed once: staged in a folder per destination.

    Every task writes a file per destination it has rows of. Where these may be many the
    rows are rebalanced first: Spark then brings the rows of a destination together, and
    cuts a destination that holds most of them over several tasks.
    """
    spark = session(df)
    keyed = df.drop(META) if few else df.drop(META).hint("rebalance", TABLE)
    keyed.write.partitionBy(TABLE).parquet(stage)
    known = T.StructType([f for f in df.schema.fields if f.name != META])
    staged = spark.read.schema(known).parquet(stage)
    found = [r[TABLE] for r in staged.select(TABLE).distinct().collect()]
    return {
        t: staged.filter(F.col(TABLE).isNull() if t is None else F.col(TABLE) == t)
        for t in sorted(found, key=lambda t: t or "")
    }


@dataclass(frozen=True)
class Write:
    """Rows that are ready to go to a table, and how: ``create``, ``replace`` or ``append``."""

    rows: DataFrame
    name: str
    partitions: list[str]
    format: str
    how: str

    def run(self) -> None:
        if self.how == "append":
            self.rows.write.mode("append").insertInto(self.name)
            return
        writer = self.rows.write.format(self.format).partitionBy(*self.partitions)
        (writer.mode("overwrite") if self.how == "replace" else writer).saveAsTable(self.name)


def prepare(rows: DataFrame, sink: TableSink, table: str, by_commit: bool = False) -> Write:
    """Check a table's dispositions and give rows its columns; for a commit the table has to be there."""
    spark, name = session(rows), sink.name(table)
    partitions = []
    if sink.partition_by is not None:
        column, unit = sink.partition_by
        unit = PARTITION_UNITS.get(unit.upper(), "")
        stored = f"{column}_{unit.lower()}"
        rows = rows.withColumn(stored, time_unit(quoted(column), unit))
        partitions.append(stored)
    if partitions:
        # Few files per partition, and a partition with most rows cut over several tasks.
        rows = rows.hint("rebalance", *partitions)

    exists = spark.catalog.tableExists(name)
    if not exists and sink.create == CREATE_NEVER:
        raise LandingError(f"table does not exist and must not be created: {name}")
    if exists and sink.write == WRITE_EMPTY and not spark.table(name).isEmpty():
        raise LandingError(f"table is not empty: {name}")
    if not by_commit and (not exists or sink.write == WRITE_TRUNCATE):
        return Write(rows, name, partitions, sink.format, "replace" if exists else "create")
    if not exists:
        rows.limit(0).write.format(sink.format).partitionBy(*partitions).saveAsTable(name)
    return Write(align(rows, name, sink), name, partitions, sink.format, "append")


def align(rows: DataFrame, name: str, sink: TableSink) -> DataFrame:
    """Give rows the columns of an existing table, which may get new columns first."""
    spark = session(rows)
    known = {f.name.lower(): f for f in spark.table(name).schema.fields}
    new = [f for f in rows.schema.fields if f.name.lower() not in known]
    if new and sink.unknown_columns == "add":
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({added})")
    own = {f.name.lower(): f for f in rows.schema.fields}
    columns = []
    for field in spark.table(name).schema.fields:
        given = own.get(field.name.lower())
        if given is None:
            cell = F.lit(None).cast(field.dataType)
        else:
            cell = fitted(quoted(given.name), given.dataType, field, name)
        columns.append(cell.alias(field.name))
    return rows.select(*columns)


def fitted(cell: Column, kind: T.DataType, field: T.StructField, name: str) -> Column:
    """A cell as the type its table has; text takes nested values as JSON."""
    if kind.simpleString() == field.dataType.simpleString():
        return cell
    if field.dataType == T.StringType():
        if isinstance(kind, (T.MapType, T.ArrayType, T.StructType)):
            return F.to_json(cell)
        return cell.cast("string")
    if isinstance(kind, T.NumericType) and isinstance(field.dataType, T.NumericType):
        return cell.cast(field.dataType)
    raise LandingError(
        f"column {field.name} of {name} is {field.dataType.simpleString()},"
        f" rows have {kind.simpleString()}"
    )


def time_unit(column: Column, unit: str) -> Column:
    if not unit:
        raise LandingError(f"unknown unit to partition by; known: {sorted(PARTITION_UNITS)}")
    at = F.date_trunc(unit, column.cast("timestamp"))
    return F.date_format(at, "yyyy-MM-dd-HH") if unit == "HOUR" else F.to_date(at)


def fan_out(batch: Batch, sinks: list[Callable[[Batch], None]]) -> None:
    """Give one batch to several sinks; it is parsed once for all of them."""
    with staged(batch) as kept:
        for sink in sinks:
            sink(kept)


def create_dataset(spark: SparkSession, dataset: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{dataset}` LOCATION '{location}'")

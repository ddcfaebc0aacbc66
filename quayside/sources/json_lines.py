"""Line-delimited JSON files, document exports and any column of JSON text."""

from __future__ import annotations

import io
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.batch import META, TABLE, Batch, empty_meta, quoted
from quayside.functions.names import Destination, decoded
from quayside.operators.documents import parse_documents
from quayside.sources.files import FILE, existing, hidden_files, list_files
from quayside.sources.units import NONE, Forward, emitter, open_unit, spread, units

LINE = "value string, file_name string, archive string"


def read_json_lines(
    spark: SparkSession,
    patterns: list[str],
    *,
    replacement: str = "",
    destination: Destination | None = None,
    compression: str = NONE,
    skip: Iterable[str] = (),
    schema: T.StructType | None = None,
    json_null: str = "null",
    json_fields: dict[str, str | None] | None = None,
    redistribute: int | None = None,
) -> Batch:
    """One JSON document per line; see ``parse_documents`` for the columns.

    ``redistribute`` spreads the lines of archive entries over that many tasks before
    they are parsed, for archives with one entry much bigger than the others.
    """
    if compression == NONE:
        found = existing(spark, patterns)
        lines = spark.read.text(found) if found else spark.createDataFrame([], "value string")
        name = decoded("_metadata.file_name") if found else F.lit("")
        lines = lines.select("value", name.alias("file_name"), F.lit("").alias("archive"))
        if odd := hidden_files(spark, patterns):
            work = units(spark.createDataFrame(odd, FILE))
            lines = lines.unionByName(spread(work).mapInArrow(line_reader(()), LINE))
    else:
        skip = tuple(skip)
        work = units(list_files(spark, patterns), compression, skip)
        lines = spread(work).mapInArrow(line_reader(skip), LINE)
        if redistribute:
            lines = lines.repartition(redistribute)
    docs = with_origin(lines, destination, archived=compression != NONE)
    if json_fields is not None:
        from quayside.operators.extract import extract_paths

        return extract_paths(docs, json_fields, replacement, routed=destination is not None)
    return parse_documents(
        docs,
        replacement=replacement,
        routed=destination is not None,
        schema=schema,
        json_null=json_null,
    )


def line_reader(skip: tuple[str, ...]):
    def rows(unit: dict) -> Iterator[tuple]:
        for file_name, stream in open_unit(unit, skip):
            for line in io.BufferedReader(Forward(stream), 1 << 20):
                yield line.decode("utf-8", "replace").rstrip("\r\n"), file_name, unit["archive"]

    return emitter(rows, LINE)


def with_origin(
    texts: DataFrame, destination: Destination | None, archived: bool, text: str = "value"
) -> DataFrame:
    """Add the hidden columns to texts that know their file and archive."""
    meta = [F.col("file_name").alias("meta_file_name")]
    if archived:
        meta.insert(0, F.col("archive").alias("meta_archive_file_name"))
    table = F.lit(None).cast("string")
    if destination is not None:
        table = destination.column(F.col("file_name"))
    return texts.withColumn(META, F.struct(*meta)).withColumn(TABLE, table)


def read_documents(
    docs: DataFrame,
    column: str = "value",
    *,
    replacement: str = "",
    schema: T.StructType | None = None,
    json_null: str = "null",
) -> Batch:
    """Documents exported from a document store, one JSON text per row."""
    texts = docs.select(
        quoted(column).cast("string").alias("value"),
        F.lit(None).cast("string").alias(TABLE),
        empty_meta().alias(META),
    )
    return parse_documents(texts, replacement=replacement, schema=schema, json_null=json_null)

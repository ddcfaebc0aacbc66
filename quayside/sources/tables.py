"""Catalog tables, SQL queries and files staged by a warehouse."""

from __future__ import annotations

from pyspark.sql import SparkSession

from quayside.batch import Batch, LandingError, from_frame
from quayside.sources.delimited import read_delimited
from quayside.sources.dialects import Dialect


def read_table(
    spark: SparkSession,
    *,
    query: str | None = None,
    table: str | None = None,
    dataset: str | None = None,
    project: str | None = None,
) -> Batch:
    """A query, or a table the catalog knows; names and types stay as they are."""
    if query is None and table is None:
        raise LandingError("a query or a table is required")
    if query is not None:
        return from_frame(spark.sql(query))
    name = ".".join(f"`{part}`" for part in (project, dataset, table) if part)
    return from_frame(spark.table(name))


def read_staged(
    spark: SparkSession,
    patterns: list[str],
    *,
    format: Dialect | None = None,
    replacement: str = "",
) -> Batch:
    """Headerless files a warehouse has unloaded: text columns ``field_1``, ``field_2``, ..."""
    return read_delimited(
        spark, patterns, format=format, replacement=replacement, generic_prefix="field_"
    )

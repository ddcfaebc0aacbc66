"""Which table a row goes to, and how rows are spread over tasks."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame

from quayside.batch import TABLE, Batch


def route(batch: Batch, table: Column) -> Batch:
    """Choose the destination of every good row; NULL means the sink's default."""
    good = batch.good.withColumn(TABLE, table.cast("string"))
    return replace(batch, good=good, layout=None, routed=True)


def redistribute(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """Spread rows evenly over tasks, or by key where rows of a key must meet.

    Without keys no task gets more than its share, however the rows came.
    """
    return df.repartition(tasks, *keys) if keys else df.repartition(tasks)

"""Keep what was parsed."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame

from quayside.batch import META, Batch, meta_fields, session, with_hidden
from quayside.scratch import delete_folder, scratch


def stage(batch: Batch) -> Batch:
    """Write a batch to the shared folder and go on from there.

    For batches that are used several times: by several sinks, or by a step with a pass of
    its own. Sources are read and parsed once, and lost executors cost no second parse.
    """
    bad = batch.bad if batch.bad_tables == [] else stored(batch.bad)
    return replace(batch, good=stored(batch.good), bad=bad)


@contextmanager
def staged(batch: Batch) -> Iterator[Batch]:
    """``stage`` for as long as the sinks need it; the copy is deleted afterwards."""
    spark = session(batch.good)
    folder = scratch(spark, "parsed")
    try:
        bad = batch.bad if batch.bad_tables == [] else stored(batch.bad, f"{folder}/bad")
        yield replace(batch, good=stored(batch.good, f"{folder}/good"), bad=bad)
    finally:
        delete_folder(spark, folder)


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    spark = session(df)
    folder = folder or scratch(spark, "parsed")
    if not meta_fields(df):
        df = df.drop(META)
    df.write.parquet(folder)
    return with_hidden(spark.read.schema(df.schema).parquet(folder))

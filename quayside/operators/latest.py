"""The latest record of every key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.batch import quoted


def latest(df: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    """One row per key: the one that is last by ``order``; name enough columns for no ties.

    An aggregation rather than a window: every task keeps one row per key before the
    shuffle, so a key with a large share of all rows is not sorted by one task.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    last = F.max_by(pack(rest), pack(order)).alias("_last")
    found = df.groupBy(*[quoted(k) for k in keys]).agg(last)
    return found.select(
        *[
            quoted(c) if c in keys else F.col("_last").getField(c).alias(c)
            for c in df.columns
        ]
    )


def pack(columns: list[str]) -> Column:
    return F.struct(*[quoted(c) for c in columns])

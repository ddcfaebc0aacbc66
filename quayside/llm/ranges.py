"""Rows laid end to end within groups, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 4096
#: Copies of a row that are listed at once.
RUN = 1 << 16


def end_to_end(rows: DataFrame, group: str, weight: Column, identity: list[str]) -> DataFrame:
    """The rows' ``group``, ``identity`` columns and ``start``: the weight of the rows before them.

    Rows are laid in the order of a hash of their identity, then of the identity itself; rows
    that repeat are interchangeable and follow each other. A group is cut in ``BUCKETS`` parts
    by that hash, which fill evenly whatever the identities are. Repeated rows are counted
    before the shuffle and multiplied again at the end, so that one row that makes up a large
    share of a group does not land in one task either. Only sums per part are ordered across
    parts: at most ``BUCKETS`` rows for a group.
    """
    counted = (
        rows.groupBy(group, *identity)
        .agg(F.count("*").alias("_copies"))
        .withColumn("_hash", F.xxhash64(*identity))
        .withColumn("_part", F.pmod(F.col("_hash"), F.lit(BUCKETS)).cast("int"))
        .withColumn("_weight", weight.cast("long"))
    )
    whole = F.col("_weight") * F.col("_copies")
    parts = counted.groupBy(group, "_part").agg(F.sum(whole).alias("_sum"))
    across = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(group, "_part", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_before"))
    within = (
        Window.partitionBy(group, "_part")
        .orderBy("_hash", *identity)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("_before") + F.coalesce(F.sum(whole).over(within), F.lit(0))
    return (
        counted.join(parts, [group, "_part"])
        .withColumn("_first", first)
        .withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(RUN).cast("long"))))
        .select(
            group,
            *identity,
            "_first",
            "_weight",
            F.explode(F.sequence("_run", F.least(F.col("_run") + RUN, "_copies") - 1)).alias("_copy"),
        )
        .select(group, *identity, (F.col("_first") + F.col("_copy") * F.col("_weight")).alias("start"))
    )

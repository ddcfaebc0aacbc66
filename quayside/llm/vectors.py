"""What the operators on vectors share: sound vectors, blocks of packed rows, numpy views of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def sound(vector: Column) -> Column:
    """Whether a vector is there and all of its components are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def padded(vector: Column, width: int, nothing: Column) -> Column:
    """The vector with as many components as the widest one has."""
    return F.concat(vector, F.array_repeat(nothing, F.lit(width) - F.size(vector)))


def pieces(rows: int, most: int) -> int:
    """How many pieces of about ``most`` rows there are."""
    return max(1, -(-rows // most))


def piece_of(identity: Column, count: int) -> Column:
    return F.pmod(F.xxhash64(identity), F.lit(count)).cast("int")


def packed(rows: DataFrame, piece: str, prefix: str, flat: tuple[str, ...] = ()) -> DataFrame:
    """One row per piece: a list per column, those in ``flat`` with their lists one after the other.

    Pieces are dealt by a hash of rows that are all different, so their size is bounded.
    """
    names = [c for c in rows.columns if c != piece]
    gathered = rows.groupBy(piece).agg(F.collect_list(F.struct(*names)).alias("_rows"))
    columns = [F.col(f"_rows.{c}") for c in names]
    return gathered.select(
        piece,
        *[
            (F.flatten(column) if name in flat else column).alias(f"{prefix}{name}")
            for name, column in zip(names, columns, strict=True)
        ],
    )


def values(batch: pa.RecordBatch, column: str, row: int, missing: int | None = None) -> np.ndarray:
    """One row's list as an array."""
    cells = batch.column(column)[row].values
    if missing is not None and cells.null_count:
        cells = cells.fill_null(missing)
    return cells.to_numpy(zero_copy_only=False)

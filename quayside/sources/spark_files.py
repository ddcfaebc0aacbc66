"""Files of any format that Spark reads, with the ``key=value`` folders of their paths as columns."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quayside.batch import META, TABLE, Batch, no_rejects, quoted
from quayside.functions.names import decoded


def read_files(
    spark: SparkSession, patterns: list[str], format: str = "avro", folders: tuple[str, ...] = ()
) -> Batch:
    """Rows of the files; files may have different columns, a column has one type.

    ``folders`` names keys of ``key=value`` folders to read as columns of text.
    """
    rows = spark.read.format(format).option("mergeSchema", True).load(patterns)
    path = F.col("_metadata.file_path")
    parts = [F.regexp_extract(path, f"/{key}=([^/]*)/", 1).alias(key) for key in folders]
    own = [quoted(c) for c in rows.columns if c not in folders]
    good = rows.select(
        *own,
        *parts,
        F.lit(None).cast("string").alias(TABLE),
        F.struct(decoded("_metadata.file_name").alias("meta_file_name")).alias(META),
    )
    return Batch(good, no_rejects(good), bad_tables=[])

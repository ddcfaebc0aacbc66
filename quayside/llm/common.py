"""Helpers that several corpus operators share."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six characters of [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"

#: Two columns that name a document: its id and a hash of its text, never NULL. Rows that
#: repeat a document share both; rows with one id and different texts do not.
ID, TEXT_HASH = "_id", "_text_hash"
NO_ID = -(2**63)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other characters as they are.

    ``lower`` does that for texts of ASCII only, and is much cheaper than ``translate``.
    """
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """``_id``, ``_text_hash``, ``doc_id``, ``text`` (NULL as empty) and the columns named."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        F.coalesce(doc_id, F.lit(NO_ID)).alias(ID),
        F.xxhash64(text).alias(TEXT_HASH),
        doc_id.alias("doc_id"),
        text.alias("text"),
        *more,
    )


def whole_rows(docs: DataFrame) -> DataFrame:
    """``_id``, ``_text_hash`` and ``_row``, the row as it is: its column names clash with nothing."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias(ID),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias(TEXT_HASH),
        F.struct(*docs.columns).alias("_row"),
    )


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts

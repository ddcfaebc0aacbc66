"""The corpus pipeline: documents in, documents sharded for training out.

Each stage takes the documents that the stage before it kept, written as Parquet and read
again. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import remainder
from quayside.llm.decontaminate import clean_documents
from quayside.llm.language_id import UNDETERMINED, learn_profiles, predict
from quayside.llm.minhash import distinct_documents
from quayside.llm.mixing import mixed_documents
from quayside.llm.sharding import assign_shards
from quayside.scratch import Workspace

SHARDS = 8


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from these documents; a missing ``lang`` is filled in.

    Texts whose language cannot be told go: those that are NULL, empty or without letters, and all where no
    language was learned. Columns of any names stay as they are.
    """
    profiles = learn_profiles(docs.where(remainder(F.col("doc_id"), 4) != 2))
    told = predict(docs.select("text", F.struct(*docs.columns).alias("_row")), profiles)
    row = F.col("_row")
    known = {"lang": F.coalesce(row["lang"], F.col("lang_pred"))}
    return told.where(F.col("lang_pred") != UNDETERMINED).select(
        *[known.get(c, row[c]).alias(c) for c in docs.columns]
    )


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id; unlike texts of one id all stay."""
    return distinct_documents(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources' words in their target weights; a document comes once for each time it is used."""
    return mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the shard that their id belongs to."""
    return assign_shards(docs, [1.0] * SHARDS)


STAGES = [
    ("language", language),
    ("dedup", dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

#: Language profiles, MinHash components and the permutations of the mixture have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, on the documents of a folder."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.table(stage(spark, docs, sf_dir), name)
    return docs

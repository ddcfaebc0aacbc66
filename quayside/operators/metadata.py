"""Where rows came from: promote, derive and look up metadata, rename columns."""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import replace
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.batch import (
    HIDDEN,
    META,
    TABLE,
    Batch,
    LandingError,
    meta_fields,
    quoted,
    visible,
)
from quayside.functions.names import name_token, trailing_digits, underscored_digits

# Names of metadata fields.
LOAD_TIMESTAMP = "meta_load_timestamp"
FILE_NAME = "meta_file_name"
LOOKUP_ROWS = 100_000
MINISTRY, MINISTRY_ID, FILE_DATE = "meta_ministry", "meta_ministryid", "meta_filedate"


def inject_metadata(
    batch: Batch,
    *,
    load_timestamp: datetime | None = None,
    load_timestamp_name: str = LOAD_TIMESTAMP,
    rename: dict[str, str] | None = None,
) -> Batch:
    """Put the metadata of good and rejected rows in front, sorted by name.

    All rows of a run get the same load timestamp. ``rename`` applies to the other
    columns; names that do not occur are ignored.
    """
    at = (load_timestamp or datetime.now(UTC)).astimezone(UTC)
    loaded = F.lit(at.strftime("%Y-%m-%dT%H:%M:%S.%fZ")).cast("timestamp")

    names: dict[str, str] = {}

    def promote(df: DataFrame) -> DataFrame:
        values = {f: F.col(META).getField(f) for f in meta_fields(df)}
        values[load_timestamp_name] = loaded
        front = [values[name].alias(name) for name in sorted(values)]
        own = [quoted(c).alias(renamed(c)) for c in visible(df)]
        check_distinct([*values, *map(renamed, visible(df))])
        return df.select(*front, *own, *HIDDEN)

    def renamed(column: str) -> str:
        return rename_one(batch, column, rename or {}, names)

    layout = None
    if batch.layout is not None:
        front = sorted([*meta_fields(batch.good), load_timestamp_name])
        layout = {t: [*front, *map(renamed, known)] for t, known in batch.layout.items()}
    good, bad = promote(batch.good), promote(batch.bad)
    return replace(batch, good=good, bad=bad, layout=layout, names=names)


def rename_one(batch: Batch, column: str, rename: dict[str, str], names: dict[str, str]) -> str:
    """The new name of a column; of one that is there once per type, all are renamed."""
    known = batch.name(column)
    wanted = rename.get(known, known)
    if column not in batch.names:
        return wanted
    made = wanted + column[len(known) :] if column.startswith(known) else column
    names[made] = wanted
    return made


def check_distinct(names: list[str]) -> None:
    twice = sorted(n for n, times in Counter(names).items() if times > 1)
    if twice:
        raise LandingError(f"columns would occur twice: {twice}")


def rename_columns(batch: Batch, names: dict[str, str]) -> Batch:
    """Rename columns of good rows; the order stays, missing sources are ignored."""
    kept: dict[str, str] = {}
    made = {c: rename_one(batch, c, names, kept) for c in batch.columns}
    check_distinct(list(made.values()))
    good = batch.good.select(*[quoted(c).alias(n) for c, n in made.items()], *HIDDEN)
    layout = batch.layout and {t: [made[c] for c in known] for t, known in batch.layout.items()}
    return replace(batch, good=good, layout=layout, names=kept)


def add_meta(batch: Batch, values: Callable[[Column], dict[str, Column]]) -> Batch:
    """Add hidden metadata fields to good and rejected rows; InjectMetadata shows them."""

    def step(df: DataFrame) -> DataFrame:
        known = {f: F.col(META).getField(f) for f in meta_fields(df)}
        known.update(values(F.col(META)))
        return df.withColumn(META, F.struct(*[c.alias(n) for n, c in known.items()]))

    return batch.map(step)


def constant_metadata(batch: Batch, name: str, value: str) -> Batch:
    return add_meta(batch, lambda _: {name: F.lit(value)})


def derived_metadata(batch: Batch, name: str, derive: Callable[[Column], Column]) -> Batch:
    """A metadata field that is a function of the file name."""
    return add_meta(batch, lambda meta: {name: derive(meta.getField(FILE_NAME))})


def token_metadata(batch: Batch, name: str, position: int, separator: str = "_") -> Batch:
    """A metadata field that is the n-th token of the file stem."""
    return derived_metadata(batch, name, lambda file: name_token(file, position, separator))


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object file of ``id: name`` as two columns; a broken file is an error."""
    text = spark.read.text(path, wholetext=True).first()
    try:
        entries = json.loads(text[0]) if text else None
    except json.JSONDecodeError as e:
        raise LandingError(f"error parsing json file: {e}") from None
    if not isinstance(entries, dict):
        raise LandingError(f"lookup is not a JSON object: {path}")
    pairs = [(k, v if v is None or isinstance(v, str) else str(v)) for k, v in entries.items()]
    return spark.createDataFrame(pairs, "id string, name string")


def file_name_metadata(batch: Batch, lookup: DataFrame) -> Batch:
    """Ids and dates in the file name, and the name the lookup has for the id.

    ``lookup`` has the columns ``id`` and ``name`` with one row per id. All rows of a file
    have one id, so they are not shuffled by it: what the lookup has for the ids that occur is
    sent to all executors if it has at most ``LOOKUP_ROWS`` rows. Beyond that, which takes as
    many files, it is a join whose skewed partitions Spark splits.
    """
    size = lookup.count()

    def step(df: DataFrame) -> DataFrame:
        file = F.col(META).getField(FILE_NAME)
        known = lookup.select(F.col("id").alias("_id"), F.col("name").alias("_name"))
        few = size <= LOOKUP_ROWS
        if not few:
            known = known.join(df.select(trailing_digits(file).alias("_id")).distinct(), "_id", "left_semi")
            few = known.count() <= LOOKUP_ROWS
        known = F.broadcast(known) if few else known
        joined = df.withColumn("_id", trailing_digits(file)).join(known, "_id", "left")
        fields = {f: F.col(META).getField(f) for f in meta_fields(df)}
        fields |= {
            FILE_DATE: underscored_digits(file),
            MINISTRY: F.col("_name"),
            MINISTRY_ID: F.col("_id"),
        }
        meta = F.struct(*[c.alias(n) for n, c in fields.items()]).alias(META)
        return joined.select(*[quoted(c) for c in visible(df)], TABLE, meta)

    return batch.map(step)


def drop_columns(batch: Batch, names: Iterable[str]) -> Batch:
    names = set(names)
    good = batch.good.select(*[quoted(c) for c in batch.columns if c not in names], *HIDDEN)
    layout = batch.layout and {
        t: [c for c in known if c not in names] for t, known in batch.layout.items()
    }
    return replace(batch, good=good, layout=layout)

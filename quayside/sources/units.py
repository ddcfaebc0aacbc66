"""Units of work for readers that parse inside tasks.

A unit is a whole file, an archive entry or a run of entries. Units are rows, so
Spark spreads them over the cluster; a task opens its unit by path and streams it.
"""

from __future__ import annotations

import io
import re
import tarfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quayside.batch import LandingError
from quayside.sources.files import open_path, open_plain

UNIT = (
    "path string, archive string, entry string, file_name string,"
    " start long, length long, how string"
)
# Entries that are never data.
ALWAYS_SKIPPED = (r"^.*audit.*$", r"^.*readme.*$", r"^\./\..*$")
NONE, ZIP, TAR = "NONE", "ZIP", "TAR"
# Entries of a ZIP archive that one task reads after another: up to so many, or so much text.
RUN_ENTRIES, RUN_BYTES = 1000, 1 << 24


def units(files: DataFrame, compression: str = NONE, skip: Iterable[str] = ()) -> DataFrame:
    """One row per file, archive entry or run of entries to read."""
    if compression == NONE:
        return files.select(
            "path",
            F.lit(None).cast("string").alias("archive"),
            F.lit(None).cast("string").alias("entry"),
            "file_name",
            F.lit(0).cast("long").alias("start"),
            "length",
            F.lit("plain").alias("how"),
        )
    if compression not in (ZIP, TAR):
        raise LandingError(f"unknown compression format {compression!r}")
    name = F.lower("file_name")
    archives = files.filter(name.endswith(".zip") if compression == ZIP else name.contains(".tar"))
    listed = spread(archives).mapInArrow(entry_lister(compression), UNIT)
    wanted = ~F.col("entry").rlike(rf"\A(?:{skip_pattern(skip)})\z")
    return listed.filter(F.col("entry").isNull() | wanted | (F.col("how") == "zip"))


def spread(work: DataFrame) -> DataFrame:
    """Give every core its share of the units, in tasks of about one scan split each, and no more tasks than units."""
    spark = work.sparkSession
    total, n = work.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    tasks = max(spark.sparkContext.defaultParallelism, min(n, total // split_size(spark, total)))
    return work.repartition(int(tasks))


def split_size(spark: SparkSession, total: int) -> int:
    """How much of ``total`` bytes a task should read; Spark's file scans choose the same."""
    most, least = (
        size_setting(spark.conf.get(f"spark.sql.files.{name}", default))
        for name, default in (("maxPartitionBytes", "128m"), ("openCostInBytes", "4m"))
    )
    return min(most, max(least, total // spark.sparkContext.defaultParallelism))


def size_setting(text: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)i?b?", text.strip().lower()).groups()
    return int(number) << {"": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def skip_pattern(skip: Iterable[str]) -> str:
    return "|".join(f"(?:{p})" for p in (*skip, *ALWAYS_SKIPPED))


def entry_lister(compression: str) -> Callable:
    def rows(unit: dict) -> Iterator[tuple]:
        path, archive = unit["path"], unit["file_name"]
        with open_path(path) as stream:
            if compression == ZIP:
                infos = zipfile.ZipFile(stream).infolist()
                for first, last in runs([info.file_size for info in infos]):
                    size = sum(info.file_size for info in infos[first:last])
                    yield path, archive, f"{first}:{last}", infos[first].filename, 0, size, "zip"
            elif compressed(stream):
                # A compressed tar can only be read front to back: once, by one task.
                archive = re.sub(r"^\./", "", archive)
                yield path, archive, None, None, 0, unit["length"], "tar stream"
            else:
                archive = re.sub(r"^\./", "", archive)
                with tarfile.open(fileobj=stream, mode="r:") as tar:
                    for info in tar:
                        if info.isreg():
                            # A sparse entry is not stored in one run of bytes.
                            how = "tar entry" if info.issparse() else "tar"
                            yield (
                                path, archive, info.name, info.name,
                                info.offset_data, info.size, how,
                            )

    return emitter(rows, UNIT)


def runs(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Neighbouring entries to read together, so that an archive's directory is not read for each."""
    first = total = 0
    for i, size in enumerate(sizes):
        if i > first and (total + size > RUN_BYTES or i - first >= RUN_ENTRIES):
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def compressed(stream: BinaryIO) -> bool:
    # The first bytes of gzip, bzip2, xz and zstd data.
    magic = (b"\x1f\x8b", b"BZh", b"\xfd7zXZ", b"\x28\xb5\x2f\xfd")
    head = stream.read(6)
    stream.seek(0)
    return head.startswith(magic)


def open_unit(unit: dict, skip: Iterable[str] = ()) -> Iterator[tuple[str, BinaryIO]]:
    """``(file name, stream)`` of what a unit covers."""
    how = unit["how"]
    if how == "tar stream":
        skipped = re.compile(skip_pattern(skip))
        with open_path(unit["path"]) as stream:
            for info in (tar := tarfile.open(fileobj=stream, mode="r|*")):
                if info.isreg() and not skipped.fullmatch(info.name):
                    yield info.name, io.BufferedReader(Forward(tar.extractfile(info)), 1 << 20)
    elif how == "zip":
        skipped = re.compile(skip_pattern(skip))
        first, last = map(int, unit["entry"].split(":"))
        with open_path(unit["path"]) as stream, zipfile.ZipFile(stream) as archive:
            for info in archive.infolist()[first:last]:
                if not info.is_dir() and not skipped.fullmatch(info.filename):
                    with archive.open(info) as entry:
                        yield info.filename, entry
    elif how == "tar entry":
        with open_path(unit["path"]) as stream, tarfile.open(fileobj=stream, mode="r:") as tar:
            yield unit["file_name"], io.BufferedReader(tar.extractfile(unit["entry"]), 1 << 20)
    elif how == "plain":
        with open_plain(unit["path"]) as stream:
            yield unit["file_name"], stream
    else:
        with open_path(unit["path"]) as stream:
            window = Window(stream, unit["start"], unit["length"])
            yield unit["file_name"], io.BufferedReader(window, 1 << 20)


class Forward(io.RawIOBase):
    """A stream that is only ever read forward."""

    def __init__(self, source: BinaryIO):
        self.source = source

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        block = self.source.read(len(buffer))
        buffer[: len(block)] = block
        return len(block)


class Window(io.RawIOBase):
    """A part of a stream."""

    def __init__(self, stream: BinaryIO, start: int, length: int):
        self.stream, self.left = stream, length
        stream.seek(start)

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        block = self.stream.read(min(len(buffer), self.left))
        self.left -= len(block)
        buffer[: len(block)] = block
        return len(block)


def emitter(rows: Callable[[dict], Iterator[tuple]], schema: str | StructType) -> Callable:
    """A ``mapInArrow`` function that writes the tuples ``rows`` makes of each input row.

    Batches are cut by row count and text size, so a task never holds a whole unit.
    """
    target = to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for unit in batch.to_pylist():
                for row in rows(unit):
                    held.append(row)
                    size += sum([len(v) for v in row if type(v) is str]) + 64
                    if len(held) >= 10_000 or size > 1 << 23:
                        yield to_batch(held, target)
                        held, size = [], 0
        if held:
            yield to_batch(held, target)

    return run


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )

"""Raw inputs for the queries, made by Spark from the given tables."""

from __future__ import annotations

import io
import posixpath
import tarfile
import uuid
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.scratch import scratch
from quayside.sinks.tables import create_dataset
from quayside.sources.files import file_system


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_files(spark: SparkSession, lines: DataFrame, label: str, mode: str = "error") -> str:
    """Write a frame of one text column as line files; gives the folder."""
    folder = scratch(spark, label)
    lines.write.mode(mode).text(folder)
    return folder


def one_file_per_row(spark: SparkSession, texts: DataFrame, label: str) -> str:
    """Write each row of one text column as a line of a file of its own; gives the folder.

    Tasks write the files themselves: Spark's writer takes a process to set the rights of each.
    """
    folder = scratch(spark, label)
    filesystem, root = file_system(folder)
    filesystem.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = file_system(folder)
        part, written = TaskContext.get().partitionId(), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                path = posixpath.join(root, f"part-{part:05d}-{written:07d}.txt")
                with filesystem.open_output_stream(path, compression=None) as out:
                    out.write(f"{text or ''}\n".encode())
                written += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([written], pa.int64())})

    texts.mapInArrow(write, "files long").agg(F.sum("files")).first()
    return folder


def csv_line(*cells: Column) -> Column:
    """Cells as a line of comma-separated, fully quoted text; NULL is an empty cell."""
    return F.concat_ws(
        ",",
        *[
            F.coalesce(F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')), F.lit(""))
            for c in (cell.cast("string") for cell in cells)
        ],
    )


def new_dataset(spark: SparkSession, label: str) -> str:
    """A database of its own in the scratch folder."""
    name = f"{label}_{uuid.uuid4().hex}"
    create_dataset(spark, name, scratch(spark, label))
    return name


def archives(
    spark: SparkSession, entries: DataFrame, label: str, kind: str, extras: bool = True
) -> str:
    """Write one archive per row of ``(name, files array<struct<name,text>>)``.

    Each archive also gets entries that a reader has to skip.
    """
    folder = scratch(spark, label)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = file_system(folder)
        filesystem.create_dir(root, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                files = [(f["name"], f["text"].encode()) for f in row["files"]]
                if extras:
                    for name in ("readme.txt", "x_audit.csv", "./.hidden"):
                        files.append((name, b"not,data\n1,2\n"))
                with filesystem.open_output_stream(
                    posixpath.join(root, row["name"]), compression=None
                ) as out:
                    out.write(packed(files, kind, row["name"]))
                yield pa.RecordBatch.from_pydict({"name": [row["name"]]})

    entries.mapInArrow(write, "name string").count()
    return folder


def packed(files: list[tuple[str, bytes]], kind: str, name: str) -> bytes:
    out = io.BytesIO()
    if kind == "zip":
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
            for entry, data in files:
                archive.writestr(entry, data)
    else:
        with tarfile.open(fileobj=out, mode="w:gz" if name.endswith("gz") else "w") as archive:
            for entry, data in files:
                info = tarfile.TarInfo(entry)
                info.size = len(data)
                archive.addfile(info, io.BytesIO(data))
    return out.getvalue()

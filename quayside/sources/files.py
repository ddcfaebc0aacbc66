"""Which files to read, and how a task opens one of them."""

from __future__ import annotations

import re
from typing import BinaryIO
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.batch import LandingError

WILDCARD = re.compile(r"[*?\[{]")
SEPARATOR = "~"


def file_patterns(
    spark: SparkSession, patterns: str | None = None, patterns_from_file: str | None = None
) -> list[str]:
    """Split a ``~``-separated pattern list; a pattern file takes the place of the list."""
    if patterns_from_file:
        patterns = spark.read.text(patterns_from_file, wholetext=True).first()[0]
    if not patterns:
        raise LandingError("no input file pattern is given")
    return [p for p in (part.strip() for part in patterns.split(SEPARATOR)) if p]


def existing(spark: SparkSession, patterns: list[str]) -> list[str]:
    """Drop wildcards that match nothing; a missing literal path is an error."""
    found = []
    for pattern in patterns:
        try:
            spark.read.format("binaryFile").load(pattern)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            if not WILDCARD.search(pattern):
                raise FileNotFoundError(f"input file does not exist: {pattern}") from None
        else:
            found.append(pattern)
    return found


FILE = "path string, file_name string, length long"


def list_files(spark: SparkSession, patterns: list[str], empty: bool = False) -> DataFrame:
    """``(path, file_name, length)`` of the matching files; contents are not read.

    A scan leaves out empty files; ``empty`` adds them for readers that report them.
    """
    found = existing(spark, patterns)
    if not found:
        return spark.createDataFrame([], FILE)
    odd = hidden_files(spark, patterns)
    files = spark.read.format("binaryFile").load(found)
    listed = files.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length")
    if empty:
        known = {short(r["path"]) for r in listed.select("path").collect()}
        paths = sorted({short(unquote(p)) for p in files.inputFiles()} - known)
        if paths:
            rows = [(p, p.rpartition("/")[2], 0) for p in paths]
            listed = listed.unionByName(spark.createDataFrame(rows, FILE))
    return listed.unionByName(spark.createDataFrame(odd, FILE)) if odd else listed


def hidden_files(spark: SparkSession, patterns: list[str]) -> list[tuple[str, str, int]]:
    """Files that the patterns name and Spark's scans leave out: ``_x`` and ``.x``.

    Within a folder that is given as such they are left out, as in any folder of a table.
    """
    jvm = spark.sparkContext._jvm
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    names = jvm.org.apache.hadoop.fs.GlobFilter("[_.]*")
    out = []
    for pattern in patterns:
        path = jvm.org.apache.hadoop.fs.Path(pattern)
        for status in path.getFileSystem(settings).globStatus(path, names) or []:
            if not status.isDirectory():
                out.append((short(status.getPath().toString()), status.getPath().getName(), status.getLen()))
    return sorted(set(out))


def short(path: str) -> str:
    return re.sub(r"^file:/+", "file:/", path)


def open_path(path: str) -> BinaryIO:
    """Open a file of any file system pyarrow knows, seekable, from within a task."""
    filesystem, inner = file_system(path)
    return filesystem.open_input_file(inner)


def file_system(path: str):
    """The pyarrow file system of a path, and the path within it."""
    from pyarrow import fs

    scheme, colon, rest = path.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem(), re.sub(r"^/+", "/", rest if colon else path)
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    return fs.FileSystem.from_uri(f"{scheme}:{rest}")


def open_plain(path: str) -> BinaryIO:
    """Open a file, decompressing a single gzip file."""
    stream = open_path(path)
    if path.lower().endswith(".gz"):
        import gzip

        return gzip.GzipFile(fileobj=stream)
    return stream

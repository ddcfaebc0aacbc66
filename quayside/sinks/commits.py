"""Append a micro-batch to its tables once, however often it is tried.

The rows of every table, good ones and rejects, are written to a staging folder below that
table. Then one commit file with the names of all files written is put in the dataset's folder, and the files
are moved in. A try that finds the commit file only moves what has not been moved. The
commit file is written by a rename, so it is there as a whole or not at all: either all tables
have the micro-batch or none. Folders that start with an underscore are not read as data.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

COMMITS, STAGING = "_commits", "_staging"


def append_once(spark: SparkSession, home: str, batch_id: str, writes: list, at_once: Callable) -> None:
    """Append rows that have their tables' columns, under an id ``<stream>-<number>``.

    ``home`` is the folder that has the commits; each table has one of the ``writes``.
    """

    def put_aside(write) -> dict:
        root, staging = location(spark, write.name), f"{STAGING}/{batch_id}"
        files = Folder(spark, root)
        files.delete(staging)
        write.rows.write.format(write.format).partitionBy(*write.partitions).save(f"{root}/{staging}")
        return {
            "table": write.name,
            "root": root,
            "partitioned": bool(write.partitions),
            "files": files.data_files(staging),
        }

    record = at_once(put_aside, writes) if writes else []
    Folder(spark, home).write(f"{COMMITS}/{batch_id}", json.dumps(record))
    finish(spark, home, batch_id)


def finish(spark: SparkSession, home: str, batch_id: str) -> bool:
    """Move in what a commit names and is not there yet; False where there is no such commit."""
    commits = Folder(spark, home)
    if not commits.exists(f"{COMMITS}/{batch_id}"):
        return False
    for own in json.loads(commits.read(f"{COMMITS}/{batch_id}")):
        files, staging = Folder(spark, own["root"]), f"{STAGING}/{batch_id}"
        for name in own["files"]:
            if files.exists(f"{staging}/{name}"):
                files.move(f"{staging}/{name}", name)
        files.delete(staging)
        if own["partitioned"]:
            spark.catalog.recoverPartitions(own["table"])
        spark.catalog.refreshTable(own["table"])
    forget_before(commits, batch_id)
    return True


def forget_before(files: Folder, batch_id: str) -> None:
    """Drop commits of the same stream that can no longer be replayed: all but the last two."""
    stream, _, number = batch_id.rpartition("-")
    for old in files.names(COMMITS):
        own, _, n = old.rpartition("-")
        if own == stream and n.isdigit() and number.isdigit() and int(n) < int(number) - 1:
            files.delete(f"{COMMITS}/{old}")


def location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return next(r["data_type"] for r in described if r["col_name"] == "Location").rstrip("/")


class Folder:
    """Files below a folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self.spark = root, spark
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.system = self.path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.path(f"{self.root}/{name}")

    def exists(self, name: str) -> bool:
        return self.system.exists(self.at(name))

    def delete(self, name: str) -> None:
        self.system.delete(self.at(name), True)

    def names(self, folder: str) -> list[str]:
        if not self.exists(folder):
            return []
        return [s.getPath().getName() for s in self.system.listStatus(self.at(folder))]

    def data_files(self, folder: str, below: str = "") -> list[str]:
        """Paths of data files, relative to the folder."""
        found = []
        for status in self.system.listStatus(self.at(f"{folder}/{below}" if below else folder)):
            name = status.getPath().getName()
            own = f"{below}/{name}" if below else name
            if status.isDirectory():
                found += self.data_files(folder, own)
            elif not name.startswith(("_", ".")):
                found.append(own)
        return found

    def move(self, source: str, target: str) -> None:
        self.system.mkdirs(self.at(target).getParent())
        if not self.system.rename(self.at(source), self.at(target)):
            raise OSError(f"cannot move {self.root}/{source} to {self.root}/{target}")

    def write(self, name: str, text: str) -> None:
        """Put a file there as a whole."""
        draft = f"{name}.draft"
        stream = self.system.create(self.at(draft), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        self.move(draft, name)

    def read(self, name: str) -> str:
        row = self.spark.read.text(f"{self.root}/{name}", wholetext=True).first()
        return row[0] if row else ""

"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of this machine only where all of Spark runs on it.

    Executors on other machines cannot see a local folder, so a cluster without the setting
    is an error rather than a silent loss of rows.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="quayside-")
    return _LOCAL[context.applicationId]


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder under the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class Workspace:
    """Written tables of one run: they cut lineage, survive lost executors and can be dropped."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = scratch(spark, label)

    def table(self, frame: DataFrame, name: str) -> DataFrame:
        """Write a frame below the folder and read it back."""
        path = f"{self.folder}/{name}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        for name in names:
            delete_folder(self.spark, f"{self.folder}/{name}")

    def close(self) -> None:
        delete_folder(self.spark, self.folder)

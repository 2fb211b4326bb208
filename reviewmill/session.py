"""Shared-folder staging.

Results that several jobs read (token lists, counts, the vocabulary) are written
once as Parquet and read back.  The copy cuts the lineage, survives the loss of
executors, keeps column pruning, and gives the optimizer the true size of the
table, so that a join against it is broadcast only when it is small enough.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """Folder of staged tables: ``spark.checkpoint.dir``, else the checkpoint folder, else the warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def _path(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


class Scratch:
    """Staged tables of one job, released together when the job has its result.

    ``with Scratch(spark) as scratch`` releases them at the end; a frame that is returned must not
    read them any more, so stage it with :func:`stage`.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/reviewmill-{uuid.uuid4().hex}"
        self.count = 0

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_: object) -> None:
        self.release()

    def stage(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` to the shared folder and return a scan of the written copy."""
        self.count += 1
        location = f"{self.folder}/{self.count}-{label}"
        df.write.parquet(location)
        return self.spark.read.schema(df.schema).parquet(location)

    def release(self) -> None:
        path, files = _path(self.spark, self.folder)
        files.delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """A staged table by itself; its copy is removed when the driver ends."""
    scratch = Scratch(df.sparkSession)
    copy = scratch.stage(df, label)
    path, files = _path(df.sparkSession, scratch.folder)
    files.deleteOnExit(path)
    return copy


SMALL_BYTES = 32 << 20


def sent_if_small(copy: DataFrame, limit: int = SMALL_BYTES) -> DataFrame:
    """A staged table with fixed-width columns, marked for broadcast if its files are within ``limit``; else Spark joins it as it likes."""
    size = int(copy._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(copy) if size <= limit else copy


def new_folder(spark: SparkSession, label: str) -> str:
    """A new place for files in the shared folder, removed when the driver ends."""
    location = f"{shared_folder(spark)}/reviewmill-{label}-{uuid.uuid4().hex}"
    path, files = _path(spark, location)
    files.deleteOnExit(path)
    return location

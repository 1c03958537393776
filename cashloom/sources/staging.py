"""Shared working copies of frames that several outputs read."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


class Staging:
    """Working copies below one folder, released together.

    A copy is a table in a folder that all executors share: lost executors cost no
    recomputation, tables read on the way may change afterwards, and each reader takes only the
    columns it needs. The caller releases the copies once the outputs that read them are written::

        with Staging(spark) as stage:
            result = purchases_ingest(feed, ..., stage=stage)
            ...  # write the outputs
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or shared_folder(spark)
        self.paths: list[str] = []

    def __call__(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/copy-{uuid4()}"
        df.write.option("compression", "zstd").parquet(path)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Delete the copies made so far; frames that read them can no longer be computed."""
        context = self.spark.sparkContext
        for path in self.paths:
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
        self.paths.clear()

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        self.release()


def shared_copy(df: DataFrame, folder: str | None = None) -> DataFrame:
    """One working copy that stays until its folder is cleared, as checkpoints do; see :class:`Staging`."""
    return Staging(df.sparkSession, folder)(df)


_local: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names for checkpoints; a local session without one gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="cashloom-"))
        folder = _local[0]
    return folder

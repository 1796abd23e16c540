"""Cutting lineage in iterative operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Scratch folders that this process has made and not removed.
_made: list[str] = []


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the session names in spark.checkpoint.dir. Where it
    is unset, as in tests, use a folder in the session's warehouse, which every
    executor reaches as it reaches the tables."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    sc.setCheckpointDir(configured or f"{warehouse.rstrip('/')}/_panelwright")


def cut(df: DataFrame) -> DataFrame:
    """Write the frame to the reliable checkpoint folder and drop its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for written tables, next to the checkpoints, so that every
    executor can reach it."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    _made.append(folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to a scratch folder and read it again: it is computed
    once, and lost executors cost nothing of it."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if folder in _made:
        _made.remove(folder)


def release(spark: SparkSession) -> None:
    """Remove all scratch folders made so far. To be called once the results
    that read them have been written: a frame that is still lazy needs them."""
    for folder in list(_made):
        remove_folder(spark, folder)


class Rounds:
    """The newest written copy of a frame that changes round by round: each
    round is computed once, and the copy before it is removed."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.name, self.folder = spark, name, None

    def put(self, df: DataFrame) -> DataFrame:
        before, self.folder = self.folder, scratch_folder(self.spark, self.name)
        df.write.parquet(self.folder)
        if before:
            remove_folder(self.spark, before)
        return self.spark.read.schema(df.schema).parquet(self.folder)

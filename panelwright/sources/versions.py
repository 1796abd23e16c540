"""A store of versions under one folder, each sealed by a manifest written last.

A version is a folder `v<number>-<id>` of any file system that Spark can write.
Writers put their files into a new one and seal it; readers only see sealed ones, so what a
broken writer leaves behind is never read, and an earlier version stays what it
was. Two writers at the same time get folders of their own.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

VERSION = re.compile(r"v(\d{6,})-[0-9a-f]{32}")


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _exists(spark: SparkSession, path: str) -> bool:
    files, where = _files(spark, path)
    return files.exists(where)


def _folders(spark: SparkSession, store: str) -> list[tuple[int, str]]:
    """(number, name) of all version folders, sealed or not, in order."""
    files, where = _files(spark, store)
    if not files.exists(where):
        return []
    names = [status.getPath().getName() for status in files.listStatus(where) if status.isDirectory()]
    return sorted((int(found[1]), name) for name in names if (found := VERSION.fullmatch(name)))


def new_version(spark: SparkSession, store: str) -> str:
    """The folder of a version that follows all there are. Nothing is made yet."""
    number = max((n for n, _ in _folders(spark, store)), default=0) + 1
    return f"{store}/v{number:06d}-{uuid.uuid4().hex}"


def seal(spark: SparkSession, folder: str, manifest: dict) -> None:
    """Write the manifest of a version whose files are all there. Spark marks
    the end of this write, and that mark is what readers look for."""
    rows = spark.createDataFrame([(json.dumps(manifest),)], "value string")
    rows.coalesce(1).write.mode("errorifexists").text(f"{folder}/manifest")


def versions(spark: SparkSession, store: str) -> list[str]:
    """Folders of the sealed versions, from the first to the latest."""
    found = [f"{store}/{name}" for _, name in _folders(spark, store)]
    return [f for f in found if _exists(spark, f"{f}/manifest/_SUCCESS")]


def read_manifest(spark: SparkSession, folder: str) -> dict:
    if not _exists(spark, f"{folder}/manifest/_SUCCESS"):
        raise FileNotFoundError(f"{folder} is no finished version")
    return json.loads(spark.read.text(f"{folder}/manifest").first()[0])

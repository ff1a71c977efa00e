"""The folder that driver and executors share, and small things done there through Hadoop's file system."""

from __future__ import annotations

import itertools
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A fresh path below spark.checkpoint.dir. Only local masters, as in tests, get a folder of their own where that is unset."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        made = sc._jsc.sc().getCheckpointDir()
        if made.isDefined():
            root = made.get()
        elif sc.master.startswith("local"):
            root = tempfile.mkdtemp(prefix="tesserae-")
            sc.setCheckpointDir(root)
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def kept(df: DataFrame, path: str | None = None) -> DataFrame:
    """df written as Parquet into the shared folder and read again: what follows starts from the table, also when an executor is lost."""
    path = path or shared_dir(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def framed(rows: Iterable[tuple], names: list[str], size: int = 2000) -> Iterator[pd.DataFrame]:
    """Rows as frames of a bounded number of rows, so that a file of many is never held as rows; an empty one gives none."""
    left = iter(rows)
    while some := list(itertools.islice(left, size)):
        yield pd.DataFrame(some, columns=names)


class Folder:
    """A path in whatever store Hadoop knows."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def has(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.path}/{name}"))

    def names(self, below: str = "") -> list[str]:
        """Names in a folder below, sorted; none if it doesn't exist."""
        at = self._path(f"{self.path}/{below}" if below else self.path)
        return sorted(x.getPath().getName() for x in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def folders(self) -> list[str]:
        """Names of the folders in this one, sorted."""
        return sorted(x.getPath().getName() for x in self._fs.listStatus(self._path(self.path)) if x.isDirectory())

    def create(self, name: str) -> bool:
        """An empty file, made by one caller alone: False if it was there."""
        return self._fs.createNewFile(self._path(f"{self.path}/{name}"))

    def drop(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.path}/{name}"), True)

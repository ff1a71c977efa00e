"""Rewriting files so that a failed rewrite changes nothing.

A store is a folder of versions, each a Parquet table of files, and a marker for each version that has been published; the latest marker's version is the
current one. A rewrite is written beside it, checked as it was written, and then published; files in which the check still finds defects
keep their old contents. Older versions stay as backups, named by the time at which they were made.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import Folder
from .relational import audited_changes, registry_diff

C = F.col


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.folder = spark, root.rstrip("/"), Folder(spark, root)

    def published(self) -> list[str]:
        """Names of published versions, oldest first."""
        return self.folder.names("_published")

    def current(self) -> str | None:
        return next(reversed(self.published()), None)

    def read(self, name: str | None = None) -> DataFrame:
        name = name or self.current()
        if name is None:
            raise FileNotFoundError(f"nothing has been published in {self.root}")
        return self.spark.read.parquet(f"{self.root}/{name}")

    def stage(self, rows: DataFrame) -> str:
        """Rows as a version that isn't current yet."""
        name = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(f"{self.root}/{name}")
        return name

    def publish(self, name: str) -> None:
        """Makes a staged version the current one by one file; readers see the old version or the new one, never parts of both."""
        if not self.folder.has(f"{name}/_SUCCESS"):
            raise ValueError(f"{name} has not been written to its end")
        self.folder.create(f"_published/{name}")

    def drop(self, name: str) -> None:
        """Removes a version that was never published."""
        if self.folder.has(f"_published/{name}"):
            raise ValueError(f"{name} is published")
        self.folder.drop(name)


def rewritten(store: Store, content: str, rewrite: Callable[[Column], Column], defects: Callable[[Column], Column], key: str = "path", dry_run: bool = False) -> DataFrame:
    """path, before, after, outcome for each file (key) of the store whose `content` has defects; the store then has a new version.

    defects counts them in a content. outcome: fixed, restored (defects are left: the old content stays) or, in a dry run, would_fix and
    would_restore; then nothing is published. A store without defects keeps its version. Null contents have none.
    """
    count = lambda c: F.coalesce(defects(c).cast("long"), F.lit(0))
    old = store.read()
    before = old.withColumn("_before", count(C(content)))
    if before.filter(C("_before") > 0).isEmpty():
        return before.filter("false").select(key, C("_before").alias("before"), C("_before").alias("after"), F.lit("").alias("outcome"))
    tried = store.stage(before.withColumns({"_old": C(content), content: F.when(C("_before") > 0, rewrite(C(content))).otherwise(C(content))}))
    checked = store.read(tried).withColumn("_after", count(C(content)))
    good = C("_after") == 0
    names = ("would_fix", "would_restore") if dry_run else ("fixed", "restored")
    report = checked.filter(C("_before") > 0).select(key, C("_before").alias("before"), C("_after").alias("after"), F.when(good, names[0]).otherwise(names[1]).alias("outcome"))
    if not dry_run:
        store.publish(store.stage(checked.withColumn(content, F.when(good, C(content)).otherwise(C("_old"))).select(old.columns)))
    return report


def synchronised(store: Store, upstream: DataFrame, key: str, value: str, dry_run: bool = False) -> DataFrame:
    """The differences (key, old_value, new_value, status) between the store's current map and upstream, which becomes a new version if there are any.

    Keys are compared in lower case and written so; nothing is written in a dry run or without a difference. An empty store takes upstream as it is.
    """
    schema = upstream.select(key, value).schema
    old = store.read() if store.current() else store.spark.createDataFrame([], schema)
    diff = registry_diff(old, upstream, key, value).filter(C("status") != "unchanged")
    if dry_run or diff.isEmpty():
        return diff
    shown = store.spark.read.parquet(f"{store.root}/{store.stage(diff)}")  # as it was before the new version
    store.publish(store.stage(upstream.select(F.lower(key).alias(key), value)))
    return shown


def verified(store: Store, after: DataFrame, planned: DataFrame, key: str, value: str, others: list[str] = ()) -> DataFrame:
    """The problems (relational.audited_changes) of `after` as the store's next version, read back as it was written; it is published if there are none."""
    name = store.stage(after)
    problems = audited_changes(store.read(), store.read(name), planned, key, value, others)
    if problems.isEmpty():
        store.publish(name)
    return problems

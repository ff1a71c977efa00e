"""Helpers that several corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: ASCII white space, the only separators of words in this subpackage.
SPACE = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Array of the words `[^\\x20\\x09-\\x0D]+` of a text; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh path in the folder that driver and executors share.

    The folder is the one named by spark.checkpoint.dir; a local one is made only where
    that setting is absent, on local masters as in tests; elsewhere that is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        made = sc._jsc.sc().getCheckpointDir()
        if made.isDefined():
            root = made.get()
        elif not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        else:
            root = tempfile.mkdtemp(prefix="tesserae-")
            sc.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


class Scratch:
    """The tables that written() makes while this is the innermost one open; drop() deletes them.

        with Scratch(spark) as scratch:
            result = operator(docs)
        result.write.parquet(path)
        scratch.drop()

    Results are lazy, so drop() belongs after the result has been written. Tables made outside of any Scratch stay.
    """

    open: list[Scratch] = []

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        Scratch.open.append(self)
        return self

    def __exit__(self, *_) -> None:
        Scratch.open.remove(self)

    def drop(self) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        while self.paths:
            path = jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            path.getFileSystem(conf).delete(path, True)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """Cut lineage: write df as Parquet into the shared folder and read it again.

    The shuffle files of the write are dropped at its end, since its rows are then read from the table.
    """
    spark = df.sparkSession
    path, before = shared_dir(spark), spark.conf.get(CLEANUP, "false")
    if Scratch.open:
        Scratch.open[-1].paths.append(path)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def in_range_order(df: DataFrame, *keys: str | Column) -> DataFrame:
    """df dealt by ranges of the keys, with its range number; written, so that numbers stay.

    Adds `_part` (range number, ascending with the keys).
    """
    n = parts(df.sparkSession)
    dealt = df.repartitionByRange(n, *keys).withColumn("_part", F.spark_partition_id())
    return written(dealt)


def running_totals(df: DataFrame, order: list[str], sums: dict[str, Column], within: list[str] = ()) -> DataFrame:
    """Adds exclusive running sums in the order of `order`, without one task seeing all rows.

    sums: name of the new column -> value to add up. within: leading columns of `order`
    in each of whose groups the sums start anew. Rows are dealt by ranges; each range is
    summed on its own, and one row for each range (and group) carries totals across ranges.
    Ties in `order` get some fixed order.
    """
    held = in_range_order(df.withColumns({f"_v_{k}": v for k, v in sums.items()}), *order)
    local = Window.partitionBy("_part", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    across = (Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = held.groupBy("_part", *within).agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums])
    totals = totals.select(
        F.col("_part").alias("_part2"), *[F.col(c).alias(f"_w_{c}") for c in within],
        *[F.coalesce(F.sum(f"_t_{k}").over(across), F.lit(0)).alias(f"_b_{k}") for k in sums],
    )
    on = F.col("_part") == F.col("_part2")
    for c in within:
        on = on & F.col(c).eqNullSafe(F.col(f"_w_{c}"))
    out = held.withColumns({f"_l_{k}": F.coalesce(F.sum(f"_v_{k}").over(local), F.lit(0)) for k in sums})
    out = out.join(totals, on, "left")
    return out.select(*df.columns, *[(F.col(f"_l_{k}") + F.col(f"_b_{k}")).cast("long").alias(k) for k in sums])


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that `column`, a string or binary, holds about `size` bytes in each; rows stay whole."""
    for batch in batches:
        start, held = 0, 0
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        if not len(lengths):
            continue
        ends = np.cumsum(lengths)
        while start < len(ends):
            stop = max(start + 1, int(np.searchsorted(ends, held + size, side="right")))
            yield batch.slice(start, stop - start)
            held, start = int(ends[stop - 1]), stop

"""Long work in batches that a killed run doesn't lose.

A ledger is a folder of batches, each a Parquet table that counts once its _SUCCESS is there. What a run has still to do is what the ledger doesn't hold; a batch that was
cut short is written anew. Nothing is ever appended to a finished batch, so a rerun adds exactly the rest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.shared import Folder

C = F.col


class Ledger:
    def __init__(self, spark: SparkSession, root: str, schema: StructType | str):
        self.spark, self.root, self.folder = spark, root.rstrip("/"), Folder(spark, root)
        self.schema = spark.createDataFrame([], schema).schema

    def finished(self) -> list[str]:
        return [name for name in self.folder.names() if self.folder.has(f"{name}/_SUCCESS")]

    def rows(self) -> DataFrame:
        """All rows of finished batches."""
        done = self.finished()
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{x}" for x in done]) if done else self.spark.createDataFrame([], self.schema)

    def add(self, name: str, rows: DataFrame) -> bool:
        """Rows as a batch of that name; False, and nothing done, if it is finished. Spark moves a batch's files into place when all of its tasks have ended."""
        if self.folder.has(f"{name}/_SUCCESS"):
            return False
        rows.select(*[C(f.name).cast(f.dataType).alias(f.name) for f in self.schema]).write.mode("overwrite").parquet(f"{self.root}/{name}")
        return True

    def sink(self, work: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
        """For foreachBatch: a micro-batch that is delivered twice is added once."""

        def add(batch: DataFrame, number: int) -> None:
            self.add(f"stream-{number:012d}", work(batch))

        return add


def remaining(wanted: DataFrame, ledger: Ledger, key: str) -> DataFrame:
    """Rows of wanted whose key the ledger doesn't have."""
    done = ledger.rows().select(C(key).alias("_done"))
    return wanted.join(done, C(key).eqNullSafe(C("_done")), "left_anti")


def resumed(wanted: DataFrame, ledger: Ledger, key: str, work: Callable[[DataFrame], DataFrame], batches: int, most: int | None = None) -> int:
    """Works off what the ledger lacks, in `batches` batches by a hash of the key (at most `most` of them in this run); how many it added.

    work turns rows of wanted into rows of the ledger, with the key. Rows that share a key are in one batch. An empty batch is added too, so that the
    number of batches doesn't depend on the data.
    """
    own = ledger.finished()
    number = 1 + max((int(x.split("-")[1]) for x in own if x.startswith("batch-")), default=-1)
    added = 0
    for k in range(batches):
        if added == most:
            break
        part = remaining(wanted.filter(F.pmod(F.xxhash64(key), F.lit(batches)) == k), ledger, key)
        if own and part.isEmpty():
            continue
        ledger.add(f"batch-{number:06d}", work(part))
        number, added = number + 1, added + 1
    return added


def with_fallback(done: Column, source: Column) -> Column:
    """The result of a step that may have failed (null), else its source."""
    return F.coalesce(done, source)

"""Row checks have no state, so they run over a stream as they do over a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.checks import findings


def checked(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, names: list[str] | None = None) -> StreamingQuery:
    """Findings of each micro-batch of pairs (locale, pos, src, dst) to a sink; a batch counts once the sink returns."""
    return findings(stream, names).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, at: str = "ts", kind: str = "event_type", late: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Counts and sums per window and kind; events later than `late` are dropped in a stream."""
    return events.withWatermark(at, late).groupBy(F.window(at, window).alias("w"), kind).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), kind, "n", "total")

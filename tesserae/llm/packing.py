"""Packing of token sequences by best-fit decreasing.

Overlong documents are cut into full windows first. What is left of each document, below a
window long, is packed over the whole corpus at once: lengths are fewer than the window, so
their histogram is bounded, and best-fit decreasing runs over the histogram. A segment tree
over remaining capacities finds the tightest open window; windows with equal remainders are
handled as ranges. Rows are then placed by their number among those of equal length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, written
from .tokenizing import encoder


class CapacityTree:
    """Segment tree over capacities 0..size: which of them have an open window."""

    def __init__(self, size: int):
        self.base = 1 << size.bit_length()
        self.any = [False] * (2 * self.base)

    def set(self, capacity: int, value: bool) -> None:
        i = self.base + capacity
        self.any[i] = value
        while i > 1:
            i //= 2
            self.any[i] = self.any[2 * i] or self.any[2 * i + 1]

    def tightest(self, need: int) -> int | None:
        """The least capacity of `need` or more that has an open window."""
        i = self.base + need
        if self.any[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.any[i + 1]:
                i += 1
                while i < self.base:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.base
            i //= 2
        return None


def best_fit_decreasing(counts: dict[int, int], window: int) -> tuple[list[tuple[int, int, int, int, int]], list[tuple[int, int, int]]]:
    """Pack counts[length] pieces of each length (1 to window) into windows.

    Returns placements (length, first piece, first window, pieces in a window, offset): piece k
    of that length from `first piece` on goes to window first + (k - first piece) // pieces at
    offset + (k - first piece) % pieces * length; and fills (first window, windows, used).
    The result is that of piece by piece best-fit decreasing, for as many steps as lengths and
    ranges, whatever the counts.
    """
    tree, open_ = CapacityTree(window), {}
    places, n_windows = [], 0

    def put(capacity: int, first: int, n: int) -> None:
        if n:
            open_.setdefault(capacity, []).append((first, n))
            tree.set(capacity, True)

    for length in sorted(counts, reverse=True):
        done, total = 0, counts[length]
        while done < total:
            capacity = tree.tightest(length)
            if capacity is None:
                fit = window // length
                first, n = n_windows, -(-(total - done) // fit)
                n_windows += n
                capacity = window
            else:
                first, n = open_[capacity].pop()
                if not open_[capacity]:
                    tree.set(capacity, False)
                fit = capacity // length
            take = min(total - done, n * fit)
            places.append((length, done, first, fit, window - capacity))
            full, rest = divmod(take, fit)
            put(capacity - fit * length, first, full)
            if rest:
                put(capacity - rest * length, first + full, 1)
            put(capacity, first + full + bool(rest), n - full - bool(rest))
            done += take
    fills = sorted((first, n, window - capacity) for capacity, ranges in open_.items() for first, n in ranges)
    return places, fills


def padded_length(used: int, window: int) -> int:
    """Sequences are padded to the window, but for those at a power of two."""
    return used if used & (used - 1) == 0 else window


PIECES = "part int, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, full boolean, k long"


def cut(docs: DataFrame, tokenizer: str, end_id: int, window: int) -> DataFrame:
    """Tokenise `text` of docs (doc_id, text; null is empty) and cut it: a row for each piece.

    k numbers the full pieces of a part, or its rests of equal length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, part = encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4")
        seen: dict[int, int] = {}
        for batch in slices(batches):
            out = {c: [] for c in ("part", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "full", "k")}
            flat, sizes = to.column(batch.column("text"))
            stops = np.cumsum(sizes)
            raw = memoryview(np.insert(flat.astype("<u4"), stops, end).tobytes())
            stops += np.arange(1, len(stops) + 1)
            for name, total, stop in zip(batch.column("doc_id").to_pylist(), (sizes + 1).tolist(), stops.tolist(), strict=True):
                ids = raw[4 * (stop - total) : 4 * stop]
                for start in range(0, total, window):
                    length = min(window, total - start)
                    k = seen.get(length, 0)
                    seen[length] = k + 1
                    for c, v in zip(out, (part, name, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), total, length == window, k), strict=True):
                        out[c].append(v)
            kinds = {"part": pa.int32(), "full": pa.bool_()}
            yield pa.RecordBatch.from_pydict({c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


def pack_pieces(pieces: DataFrame, window: int) -> DataFrame:
    """Adds sequence_id, offset, sequence_used to pieces as cut() gives them; pieces must be written."""
    spark = pieces.sparkSession
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    bases = counts.select(F.col("length").alias("_length"), F.col("part").alias("_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    # at most `window` rows, whatever the input
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    full = histogram.pop(window, 0)
    places, fills = best_fit_decreasing(histogram, window)
    by_length: dict[int, np.ndarray] = {}
    for length in histogram:
        by_length[length] = np.array([p[1:] for p in places if p[0] == length], np.int64)
    first = np.array([f[0] for f in fills], np.int64)
    used = np.array([f[2] for f in fills], np.int64)
    plan = spark.sparkContext.broadcast((by_length, first, used))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length, first, used = plan.value
        for batch in batches:
            if not batch.num_rows:
                continue
            length, g = batch.column("length").to_numpy(), batch.column("g").to_numpy()
            sequence, offset, fill = g.copy(), np.zeros(len(g), np.int64), np.full(len(g), window, np.int64)
            for size in np.unique(length):
                if size == window:
                    continue
                own, table = np.flatnonzero(length == size), by_length[int(size)]
                row = table[np.searchsorted(table[:, 0], g[own], side="right") - 1]
                j = g[own] - row[:, 0]
                at = row[:, 1] + j // row[:, 2]
                sequence[own] = full + at
                offset[own] = row[:, 3] + j % row[:, 2] * size
                fill[own] = used[np.searchsorted(first, at, side="right") - 1]
            columns = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset), pa.array(fill)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_used"])

    numbered = pieces.join(bases, (F.col("length") == F.col("_length")) & (F.col("part") == F.col("_part")))
    numbered = numbered.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("k") + F.col("_base")).alias("g"))
    return numbered.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_used long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = 2048) -> DataFrame:
    """Pack all docs (doc_id, text) into sequences of at most `window` tokens.

    Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_used,
    and sequence_length, its length with padding. Documents with a null or empty text are their end id.
    Rows that share a doc_id are documents of their own; other columns may have any name. An empty table gives no rows.
    """
    out = pack_pieces(written(cut(docs, tokenizer, end_id, window)), window)
    used = F.col("sequence_used")
    return out.withColumn("sequence_length", F.when(used.bitwiseAND(used - 1) == 0, used).otherwise(F.lit(window)).cast("long"))

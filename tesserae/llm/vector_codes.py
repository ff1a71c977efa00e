"""Product codes of vectors: codebooks by Lloyd's rounds, nearest entries by exponion search in exact integers.

A vector's parts start at the entry they had in the round before. With its squared distance u to that entry a, no entry further than twice the distance from a
can be as near (triangle inequality), so of a's list of entries by distance only those within 4 u, squared, are looked at. Distances are
whole numbers, held in doubles where all of them are below 2^53 and in 64-bit integers else, so ties are exact; they go to the lower index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, written

C = F.col
SCALE = 1024
#: Vectors that a task looks at together, components of these at most, and rows of a table of distances.
SLAB, SLAB_COMPONENTS, CHUNK = 1 << 15, 1 << 22, 1 << 12
#: Labels up to this number are broadcast (some 50 bytes each); beyond, the join shuffles.
BROADCAST_ROWS = 20_000


def exact_type(*arrays: np.ndarray) -> type:
    """float64 if squared distances between rows of these arrays are exact in it, else int64; an error beyond."""
    most = max((int(np.abs(a).max()) for a in arrays if a.size), default=0)
    bound = (2 * most) ** 2 * max(a.shape[1] for a in arrays)
    if bound >= 1 << 63:
        raise OverflowError(f"components up to {most} make squared distances beyond 64 bits")
    return np.float64 if bound < 1 << 53 else np.int64


@dataclass(frozen=True)
class Codebook:
    """entries (k, p) of one part; near[a] the entries by distance from entry a, then by index, apart[a] those squared distances."""

    entries: np.ndarray
    near: np.ndarray
    apart: np.ndarray

    @classmethod
    def of(cls, entries: np.ndarray) -> Codebook:
        e = entries.astype(exact_type(entries))
        squares = (e * e).sum(1)
        apart = (squares[:, None] + squares - 2 * (e @ e.T)).astype(np.int64)
        near = np.argsort(apart, axis=1, kind="stable")
        return cls(entries, near, np.take_along_axis(apart, near, 1))

    def nearest(self, points: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entry, squared distance) for points (n, p), searched from their entries `start`."""
        kind = exact_type(points, self.entries)
        x, e = points.astype(kind), self.entries.astype(kind)
        own = x - e[start]
        error = (own * own).sum(1).astype(np.int64)
        found = start.astype(np.int64)
        order = np.argsort(start, kind="stable")
        bounds = np.searchsorted(start[order], np.arange(len(e) + 1))
        for a in np.flatnonzero(np.diff(bounds)):
            rows = order[bounds[a] : bounds[a + 1]]
            # a squared distance is below 2^63, its quadruple might not be
            within = np.searchsorted(self.apart[a] // 4 + (self.apart[a] % 4 > 0), error[rows], side="right")
            low = 1
            while low < len(e):
                high = min(4 * low, len(e))
                some = rows[(within > low) & (within <= high)]
                for k in range(0, len(some), CHUNK):
                    self._improve(x, e, some[k : k + CHUNK], self.near[a, :high], found, error)
                low = high
        return found, error

    @staticmethod
    def _improve(x: np.ndarray, e: np.ndarray, rows: np.ndarray, candidates: np.ndarray, found: np.ndarray, error: np.ndarray) -> None:
        points, entries = x[rows], e[candidates]
        squared = (points * points).sum(1)[:, None] - 2 * (points @ entries.T) + (entries * entries).sum(1)
        least = squared.min(1)
        found[rows] = np.where(squared == least[:, None], candidates, len(e)).min(1)
        error[rows] = least.astype(np.int64)


def _integers(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    """The batch's vectors, all of that length, as floor(1024 * x)."""
    column = batch.column("_v")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) if isinstance(column, pa.ListArray) else np.frombuffer(column.buffers()[2], np.int32, batch.num_rows * dims, column.offset * dims * 4)
    if isinstance(column, pa.ListArray):
        flat = np.floor(flat * SCALE)
        if flat.size and np.abs(flat).max() >= 1 << 31:
            raise OverflowError("a component is beyond 32 bits after scaling")
        flat = flat.astype(np.int32)
    return flat.reshape(batch.num_rows, dims)


def _slabs(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """Batches put together to SLAB rows, or fewer long ones, so that each entry has many points."""
    rows = max(1, min(SLAB, SLAB_COMPONENTS // max(dims, 1)))
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, rows))
            if sum(b.num_rows for b in held) >= rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _searched(batch: pa.RecordBatch, books: list[Codebook], dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(integers, codes (n, parts), errors) of a slab whose column _code has the entries of the round before, null in the first."""
    ints, wide = _integers(batch, dims), dims // len(books)
    code = batch.column("_code")
    before = np.zeros((batch.num_rows, len(books)), np.uint8) if code.null_count else np.frombuffer(code.buffers()[2], np.uint8, batch.num_rows * len(books), code.offset * len(books)).reshape(-1, len(books))
    codes, errors = np.empty((batch.num_rows, len(books)), np.uint8), np.zeros(batch.num_rows, np.int64)
    for p, book in enumerate(books):
        found, error = book.nearest(ints[:, p * wide : (p + 1) * wide], before[:, p].astype(np.int64))
        codes[:, p] = found
        errors += error
    return ints, codes, errors


def _binary(rows: np.ndarray) -> pa.Array:
    """Each row's bytes as a binary value."""
    rows = np.ascontiguousarray(rows)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(len(rows) + 1, dtype=np.int32) * rows[0].nbytes if len(rows) else np.zeros(1, np.int32)), pa.py_buffer(rows)])


def assigned(books: list[Codebook], dims: int, kind: pa.DataType) -> Callable:
    """A round's pass: vectors with their new codes, and at a task's end a row for each entry that has points, with their number and sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, wide = len(books[0].entries), dims // len(books)
        counts, sums = np.zeros((len(books), k), np.int64), np.zeros((len(books), k, wide), np.int64)
        names = ["vec_id", "label", "_v", "_code", "_part", "_entry", "_n", "_sum"]
        for batch in _slabs(batches, dims):
            ints, codes, _ = _searched(batch, books, dims)
            for p in range(len(books)):
                counts[p] += np.bincount(codes[:, p], minlength=k)
                order = np.argsort(codes[:, p], kind="stable")
                some, first = np.unique(codes[order, p], return_index=True)
                if wide:
                    sums[p][some] += np.add.reduceat(ints[order, p * wide : (p + 1) * wide], first, axis=0, dtype=np.int64)
            none = [pa.nulls(len(ints), t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _binary(ints), _binary(codes), *none], names=names)
        p, e = np.nonzero(counts)
        none = [pa.nulls(len(p), t) for t in (pa.int64(), kind, pa.binary(), pa.binary())]
        totals = pa.array(sums[p, e].tolist(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*none, pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(counts[p, e]), totals], names=names)

    return run


def coded(books: list[Codebook], dims: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slabs(batches, dims):
            _, codes, errors = _searched(batch, books, dims)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array([bytes(c).hex() for c in codes]), pa.array(errors)], names=["vec_id", "label", "code", "error"])

    return run


def moved(entries: np.ndarray, state: DataFrame) -> np.ndarray:
    """entries (parts, k, p) with those that have points at the floor of their mean; what comes to the driver is one number for each component of an entry."""
    out = entries.copy()
    each = state.filter(C("_part").isNotNull()).select("_part", "_entry", "_n", F.posexplode_outer("_sum").alias("_at", "_x"))
    for r in each.filter(C("_at").isNotNull()).groupBy("_part", "_entry", "_at").agg(F.sum("_n").alias("n"), F.sum("_x").alias("x")).collect():
        out[r["_part"], r["_entry"], r["_at"]] = r["x"] // r["n"]
    return out


def compressed(vectors: DataFrame, column: str = "embedding", split: int = 4, size: int = 256, rounds: int = 4) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 for each row of vectors (vec_id, `column`, label) with a usable vector.

    A vector is usable if it is not null, has no null, NaN or infinite component, and the length that most such vectors have (of two lengths as
    common, the shorter); `split` must divide that length. The codebooks start from the `size` (256 at most) least vec_ids, null last, of rows that share one by
    their components; repeated rows are points of their own. Fewer rows make fewer entries. Rows with a null label share one label_error. Components beyond 2^31 / 1024, and squared distances beyond
    63 bits, are an OverflowError. Other columns may have any name; an empty table gives no rows.

    Each round reads and writes the vectors once, with their codes, and drops what the round before has written; only codebooks, at most 256 entries, are on the driver and in every task.
    """
    spark = vectors.sparkSession
    finite = F.forall(C("_v"), lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    own = vectors.select(C("vec_id").cast("long").alias("vec_id"), C("label"), C(column).cast("array<double>").alias("_v")).filter(C("_v").isNotNull() & finite)
    kind = spark.createDataFrame([], own.select("label").schema).toArrow().schema.field("label").type
    common = own.groupBy(F.size("_v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    dims = common["d"] if common else split
    if dims % split:
        raise ValueError(f"{split} parts don't divide vectors of {dims} components")
    own = own.filter(F.size("_v") == dims)
    first = own.orderBy(C("vec_id").isNull(), "vec_id", "_v").select("_v").limit(size).collect()
    start = np.floor(np.array([r["_v"] for r in first], np.float64).reshape(len(first), dims) * SCALE).astype(np.int64)
    entries = np.stack(np.split(start, split, axis=1)) if dims else np.zeros((split, len(first), 0), np.int64)
    state = own.withColumn("_code", F.lit(None).cast("binary"))
    row = f"vec_id long, label {own.schema['label'].dataType.simpleString()}, "
    before = Scratch(spark)
    if first:
        for _ in range(rounds):
            books = [Codebook.of(e) for e in entries]
            with Scratch(spark) as now:
                state = written(state.select("vec_id", "label", "_v", "_code").mapInArrow(assigned(books, dims, kind), row + "_v binary, _code binary, _part int, _entry int, _n long, _sum array<long>"))
            before.drop()  # the round before has been read for the last time
            before = now
            entries = moved(entries, state)
            state = state.filter(C("_part").isNull())
    books = [Codebook.of(e) for e in entries]
    out = written(state.select("vec_id", "label", "_v", "_code").mapInArrow(coded(books, dims), row + "code string, error long"))
    before.drop()
    errors = out.groupBy(C("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    if errors.count() <= BROADCAST_ROWS:
        errors = F.broadcast(errors)
    digest = hashlib.sha256(",".join(map(str, entries.reshape(-1).tolist())).encode()).hexdigest()
    return out.join(errors, C("label").eqNullSafe(C("_label"))).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))

"""Token-ID output: Simple-8b word-aligned coding in shards of blocks.

File format. A table of segments, one row for about `segment_ids` ids; a row holds whole
documents in ascending doc_id order, and rows are ordered by (shard, segment). `payload` is

    magic "S8B1", u32 block size, u64 number of ids, u64 words, u64 escapes,
    u32[blocks + 1] first word of each block, u64[words], u64[escapes] place, u64[escapes] id.

Each 64-bit word has a selector in its top 4 bits and as many ids as that selector says in
the other 60. A block is `block` ids (the last one fewer) and starts a word of its own, so
that blocks decode on their own and all together, vectorised. An id of 2^60 or more is an
escape: its place holds zero, and place and id stand at the end.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import parts, shared_dir, slices
from .tokenizing import encoder

# The sixteen selectors of Simple-8b, ids in a word and bits of each.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

MAGIC = b"S8B1"
HEAD = struct.Struct("<4sIQQQ")
ESCAPE = np.uint64(1) << np.uint64(60)


_SHORT = np.concatenate([[0], np.floor(np.log2(np.arange(1, 1 << 16))) + 1]).astype(np.uint8)


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs."""
    if ids.dtype == np.uint16 or (len(ids) and ids.max() < 1 << 16):
        return _SHORT[ids]
    out = np.zeros(len(ids), np.uint8)
    rest = ids.astype(np.uint64)
    for step in (48, 32, 16):
        high = rest >= (np.uint64(1) << np.uint64(step))
        out[high] += np.uint8(16)
        rest[high] >>= np.uint64(16)
    return out + _SHORT[rest]


def encode(ids: np.ndarray, block: int = 512) -> bytes:
    """ids (unsigned) as one payload."""
    n = len(ids)
    places = np.flatnonzero(ids >= ESCAPE) if ids.dtype.itemsize == 8 else np.zeros(0, np.int64)
    escaped = ids[places].astype(np.uint64)
    if len(places):
        ids = ids.copy()
        ids[places] = 0
    blocks = -(-n // block)
    # the widest id of the next c, for growing c; beyond a block's end all is 0 bits wide
    wide = np.zeros((blocks, block), np.uint8)
    wide.reshape(-1)[:n] = _widths(ids)
    pick = np.full((blocks, block), 15, np.uint8)
    spans = {1: wide}
    size = 1
    while size * 2 <= min(block, 240) and spans[size].min(initial=64) <= BITS[np.searchsorted(-COUNTS, -size, side="right") - 1]:
        half = spans[size]
        both = half.copy()
        both[:, : block - size] = np.maximum(half[:, : block - size], half[:, size:])
        spans[size * 2] = both
        size *= 2
    for s in range(14, -1, -1):
        c = int(COUNTS[s])
        k = min(1 << (c.bit_length() - 1), size)
        if spans[k].min(initial=64) > BITS[s]:
            continue
        most = spans[k].copy()
        for at in [*range(k, c - k, k), c - k]:
            if 0 < at < block:
                most[:, : block - at] = np.maximum(most[:, : block - at], spans[k][:, at:])
        pick[most <= BITS[s]] = s
    # all blocks step through their words together
    ends = np.full(blocks, block)
    if blocks:
        ends[-1] = n - block * (blocks - 1)
    at, row, where, owner = np.zeros(blocks, np.int64), np.arange(blocks), [], []
    while len(row):
        where.append(row * block + at)
        owner.append(row)
        at = at + COUNTS[pick[row, at]]
        keep = at < ends[row]
        at, row = at[keep], row[keep]
    starts = np.sort(np.concatenate(where)) if where else np.zeros(0, np.int64)
    words = np.zeros(len(starts), np.uint64)
    offsets = np.zeros(blocks + 1, np.uint32)
    if blocks:
        np.cumsum(np.bincount(starts // block, minlength=blocks), out=offsets[1:])
    padded = np.concatenate([ids, np.zeros(240, ids.dtype)])
    chosen = pick.reshape(-1)[starts]
    room = np.minimum((starts // block + 1) * block, n) - starts
    for s in np.unique(chosen):
        own = np.flatnonzero(chosen == s)
        c, b = int(COUNTS[s]), int(BITS[s])
        word = np.full(len(own), np.uint64(int(s) << 60))
        if b:
            first, over = starts[own], np.flatnonzero(room[own] < c)
            for j in range(c):
                value = padded[first + j].astype(np.uint64)
                value[over[room[own[over]] <= j]] = 0
                word |= value << np.uint64(b * j)
        words[own] = word
    return HEAD.pack(MAGIC, block, n, len(words), len(places)) + offsets.tobytes() + words.tobytes() + places.astype("<u8").tobytes() + escaped.tobytes()


def decode(payload: bytes) -> np.ndarray:
    """The ids of a payload."""
    magic, block, n, n_words, n_escapes = HEAD.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a payload of this format")
    blocks = -(-n // block)
    at = HEAD.size
    offsets = np.frombuffer(payload, np.uint32, blocks + 1, at).astype(np.int64)
    words = np.frombuffer(payload, np.uint64, n_words, at := at + 4 * (blocks + 1))
    places = np.frombuffer(payload, np.uint64, n_escapes, at := at + 8 * n_words)
    escaped = np.frombuffer(payload, np.uint64, n_escapes, at + 8 * n_escapes)
    selector = (words >> np.uint64(60)).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(COUNTS[selector])])
    owner = np.repeat(np.arange(blocks), np.diff(offsets))
    first = owner * block + before[:-1] - before[offsets[:-1]][owner]
    out = np.zeros(n + 240, np.uint64)
    stop = np.minimum((owner + 1) * block, n)
    for s in np.unique(selector):
        c, b = int(COUNTS[s]), int(BITS[s])
        if not b:
            continue
        own = np.flatnonzero(selector == s)
        mask, at, word = np.uint64((1 << b) - 1), first[own], words[own]
        over = np.flatnonzero(at + c > stop[own])
        for j in range(c):
            put = at + j
            put[over[put[over] >= stop[own[over]]]] = n  # past the block's end
            out[put] = (word >> np.uint64(b * j)) & mask
    out = out[:n]
    out[places.astype(np.int64)] = escaped
    return out


SEGMENTS = "shard int, segment long, before long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int, segment_ids: int = 1 << 19, special_as_text: bool = False) -> None:
    """Tokenise `text` of docs (doc_id, text) and write its ids, in ascending doc_id order.

    Null texts are empty: their documents have the end id alone. Rows that share a doc_id
    keep together, in some order. A document is never split between segments, so the longest
    document bounds a segment; columns but doc_id and text are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = encoder(tokenizer, special_as_text)
        shard, segment, before = TaskContext.get().partitionId(), 0, 0
        names, texts, size = [], [], 0
        end = np.array([end_id], to.kind)

        def flush() -> pa.RecordBatch:
            nonlocal segment, before
            ids, lengths = np.concatenate(texts), [len(x) for x in texts]
            row = {"shard": [shard], "segment": [segment], "before": [before], "n_ids": [len(ids)], "doc_ids": [list(names)], "lengths": [lengths], "payload": [encode(ids)]}
            segment, before = segment + 1, before + len(ids)
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("shard", pa.int32()), ("segment", pa.int64()), ("before", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())]))

        for batch in slices(batches):
            flat, sizes = to.column(batch.column("text"))
            stops = np.cumsum(sizes)
            flat = np.insert(flat, stops, end)
            stops += np.arange(1, len(stops) + 1)
            for name, i, j in zip(batch.column("doc_id").to_pylist(), (stops - sizes - 1).tolist(), stops.tolist(), strict=True):
                names.append(name)
                texts.append(flat[i:j])
                size += j - i
                if size >= segment_ids:
                    yield flush()
                    names, texts, size = [], [], 0
        if names:
            yield flush()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = own.repartitionByRange(parts(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, SEGMENTS).write.parquet(path)


def read_documents(files: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                raw = memoryview(decode(row["payload"]).astype("<u4").tobytes())
                ends = np.cumsum(np.array(row["lengths"], np.int64))
                begins = ends - np.array(row["lengths"], np.int64)
                crcs = [zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(begins.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array([row["shard"]] * len(crcs), pa.int32()), "doc_id": pa.array(row["doc_ids"], pa.int64()), "local": pa.array(begins + row["before"], pa.int64()),
                    "n_tokens": pa.array(row["lengths"], pa.int64()), "ids_crc32": pa.array(crcs, pa.int64()),
                })

    whole = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(F.col("shard").alias("of"), F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("base"))
    docs = files.select("shard", "before", "doc_ids", "lengths", "payload").mapInArrow(run, "shard int, doc_id long, local long, n_tokens long, ids_crc32 long")
    return docs.join(shards, docs.shard == shards.of).select("doc_id", (F.col("base") + F.col("local")).cast("long").alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer: str, end_id: int, path: str | None = None) -> DataFrame:
    """Write the token files of docs (doc_id, text), then return what read_documents() finds in them: doc_id, start, n_tokens, ids_crc32.

    A null or empty text is its end id alone. Documents stand by ascending doc_id, null first; rows that share a doc_id are documents of their own, in some order. Texts
    of any length are encoded whole; other columns may have any name; an empty table gives no rows.
    """
    spark = docs.sparkSession
    path = path or shared_dir(spark)
    write(docs, path, tokenizer, end_id)
    return read_documents(spark.read.schema(SEGMENTS).parquet(path))

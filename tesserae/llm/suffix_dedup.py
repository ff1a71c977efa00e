"""Removal of long repeats across documents, with suffix arrays by external induced sorting.

A byte goes if a string of `width` bytes that covers it also starts in a document with a
smaller doc_id. The corpus is cut so that equal strings meet:

1. Every window of `width` bytes has an anchor, the 16-byte gram of least hash in it, leftmost among
   equals. A run of windows with one anchor is a segment; equal windows have equal anchors, so
   they meet in the anchor's shard. Segments equal as wholes collapse there to that of the least
   doc_id: all others repeat it and go. Within a task this is done before the shuffle.
2. Anchors under which different segments of different documents remain get these segments' bytes; those that
   cannot agree on `width` bytes around the anchor drop out. Each shard's text is suffix-sorted by induced sorting, its tuples in disk-backed queues beyond a
   bound of memory; neighbours that share `width` bytes form groups, and in each group all windows
   but those of the least doc_id go. Common prefixes, of which only `width` bytes matter,
   are compared after the induction, eight bytes at a time.
3. Spans come back to their documents, hashed by doc_id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts, slices, written
from .induced import suffix_array

C = F.col
GRAM = 16
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_BASE = np.uint64(0xD1342543DE82EF95)
_CODES = np.random.default_rng(50).integers(1, 1 << 63, 256, dtype=np.uint64)


def _loads(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one integer; beyond the end are zeros."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), "<u8", padded, strides=(1,)).copy()


_POWERS: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(n, 1 << 20)
        for name, base in (("up", int(_BASE)), ("down", pow(int(_BASE), -1, 1 << 64))):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def segments(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(start, size, lead, gram, content) of all segments of documents that end at `ends` in data.

    lead: the anchor's place in the segment. gram and content: 64-bit hashes.
    """
    n = len(data)
    if n < width:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    x = _loads(data)
    g = np.zeros(n, np.uint64)
    g[: n - 8] = x[8:]
    g *= _MIX[1]
    g ^= g >> np.uint64(31)
    g += x * _MIX[0]
    g ^= g >> np.uint64(30)
    g *= _MIX[2]
    g ^= g >> np.uint64(29)
    value, place = g, np.arange(n, dtype=np.int32 if n < 1 << 31 else np.int64)
    span, most = 1, width - GRAM + 1
    while span < most:
        step = min(span, most - span)
        right = value[step:] < value[:-step]
        value, place = np.where(right, value[step:], value[:-step]), np.where(right, place[step:], place[:-step])
        span += step
    bad = np.zeros(n + 1, np.int32)
    begins = np.concatenate([[0], ends[:-1]])
    np.add.at(bad, np.maximum(begins, ends - width + 1), 1)
    np.add.at(bad, ends, -1)
    valid = np.cumsum(bad[: n - width + 1]) == 0
    place = place[: n - width + 1]
    turn = np.concatenate([[True], place[1:] != place[:-1]])
    start = np.flatnonzero(valid & (turn | ~np.concatenate([[False], valid[:-1]])))
    last = np.flatnonzero(valid & (np.concatenate([turn[1:], [True]]) | ~np.concatenate([valid[1:], [False]])))
    up, down = _powers(n)
    total = np.concatenate([[np.uint64(0)], np.cumsum(_CODES[data] * up, dtype=np.uint64)])
    content = (total[last + width] - total[start]) * down[start]
    content ^= content >> np.uint64(32)
    return start, last - start + width, place[start] - start, g[place[start]], content


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls, and each value's end among them."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets[1:] - offsets[0]


def keyed(docs: DataFrame) -> DataFrame:
    """All columns of docs but text in the struct `_row`, so that no name clashes, with `_doc` (doc_id, null least), `_tie` (tells rows with one doc_id apart) and `_data` (the text's bytes)."""
    data = F.coalesce(C("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.coalesce(C("doc_id").cast("long"), F.lit(-(2**63))).alias("_doc"), F.hash("text").alias("_tie"), data.alias("_data"), F.struct(*[c for c in docs.columns if c != "text"]).alias("_row"))


def _segment_rows(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_data", 2 << 20):
            data, ends = _bytes_of(batch.column("_data"))
            start, size, lead, gram, content = segments(data, ends, width)
            own = np.searchsorted(ends, start, side="right")
            doc, tie = batch.column("_doc").to_numpy()[own], batch.column("_tie").to_numpy()[own]
            where = ((start - np.concatenate([[0], ends[:-1]])[own]) << 16) | (size << 8) | lead
            # equal segments: those after the least doc_id go at once
            order = np.lexsort((doc, content, gram))
            first = np.concatenate([[True], (gram[order][1:] != gram[order][:-1]) | (content[order][1:] != content[order][:-1])]) if len(order) else np.zeros(0, bool)
            least = doc[order][np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))] if len(order) else doc
            gone = np.zeros(len(start), bool)
            gone[order] = doc[order] > least
            gram = gram.view(np.int64).copy()
            gram[gone] ^= start[gone] * np.int64(2654435761)  # any shard will do for these
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(content.view(np.int64)), pa.array(doc), pa.array(tie), pa.array(where), pa.array(gone)], names=["gram", "content", "doc", "tie", "at", "gone"])

    return run


class _Shard:
    """Rows of a shard in order of (gone, gram, content, doc), seen batch by batch."""

    def __init__(self):
        self.last = None  # gram, content and least doc of the class that the last batch ended in
        self.only: int | None = None  # the one document that its gram has so far, None if more
        self.held: list[tuple[np.ndarray, ...]] = []  # that document's rows under the gram

    def batch(self, gram, content, doc, tie, at, gone):
        """(rows to remove, rows to compare) as boolean masks, and held rows to compare."""
        n = len(gram)
        live = np.flatnonzero(~gone)
        remove, compare, late = gone.copy(), np.zeros(n, bool), []
        if not len(live):
            return remove, compare, late
        g, c, d = gram[live], content[live], doc[live]
        new_g = np.concatenate([[self.last is None or g[0] != self.last[0]], g[1:] != g[:-1]])
        new_c = new_g | np.concatenate([[self.last is None or c[0] != self.last[1]], c[1:] != c[:-1]])
        at_c = np.maximum.accumulate(np.where(new_c, np.arange(len(live)), -1))
        least = np.where(at_c >= 0, d[at_c], self.last[2] if self.last else 0)
        remove[live] = d > least
        keep = d == least
        starts = np.flatnonzero(new_g | (np.arange(len(live)) == 0))
        lo = np.minimum.reduceat(np.where(keep, d, np.iinfo(np.int64).max), starts)
        hi = np.maximum.reduceat(np.where(keep, d, np.iinfo(np.int64).min), starts)
        several = lo < hi
        if not new_g[0]:  # the first gram began before
            before = self.only
            if before is None or (lo[0] <= hi[0] and (lo[0] != before or hi[0] != before)):
                several[0] = True
                late, self.held = self.held, []
        else:
            self.held = []
        size = np.diff(np.concatenate([starts, [len(live)]]))
        compare[live] = keep & np.repeat(several, size)
        tail = slice(starts[-1], len(live))
        if several[-1]:
            self.only = None
        else:
            if len(starts) > 1 or new_g[0]:
                self.held, self.only = [], int(lo[-1])
            rows = live[tail][keep[tail]]
            self.held.append((gram[rows], doc[rows], tie[rows], at[rows]))
        self.last = (g[-1], c[-1], least[-1])
        return remove, compare, late


STAGED = "kind int, gram long, doc long, tie int, at long, size int, lead int"


def _staged(kind: int, gram, doc, tie, at) -> pa.RecordBatch:
    start, size, lead = (x.astype(t) for x, t in zip((at >> 16, (at >> 8) & 0xFF, at & 0xFF), (np.int64, np.int32, np.int32), strict=True))
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(doc), kind, np.int32), gram, doc, tie, start, size, lead)], names=["kind", "gram", "doc", "tie", "at", "size", "lead"])


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = _Shard()
    for batch in batches:
        if not batch.num_rows:
            continue
        gram, content, doc, tie, at = (batch.column(c).to_numpy() for c in ("gram", "content", "doc", "tie", "at"))
        remove, compare, late = shard.batch(gram, content, doc, tie, at, batch.column("gone").to_numpy(zero_copy_only=False).astype(bool))
        yield _staged(0, *(x[remove] for x in (gram, doc, tie, at)))
        yield _staged(1, *(x[compare] for x in (gram, doc, tie, at)))
        for rows in late:
            yield _staged(1, *rows)


def repeats(data: np.ndarray, begins: np.ndarray, doc: np.ndarray, width: int, memory: int = 1 << 23) -> np.ndarray:
    """Positions in data of windows of `width` bytes that also start under a smaller doc.

    data: strings one after the other, each begun at `begins` and of documents `doc`; windows that cross strings don't count.
    """
    n = len(data)
    ends = np.concatenate([begins[1:], [n]])
    text = np.zeros(n + len(begins), np.int16)
    owner = np.repeat(np.arange(len(begins)), ends - begins)
    to = np.arange(n) + owner  # a separator, less than any byte, after each string
    text[to] = data.astype(np.int16) + 1
    valid = np.arange(n) + width <= ends[owner]
    back = np.full(len(text), -1, np.int64)
    back[to[valid]] = np.flatnonzero(valid)
    order = back[suffix_array(text, memory)]
    order = order[order >= 0]
    if not len(order):
        return order
    x = _loads(data)
    same = np.ones(len(order) - 1, bool)
    for k in [*range(0, width - 8, 8), width - 8]:
        same &= x[order[1:] + k] == x[order[:-1] + k]
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    own = doc[owner[order]]
    least = np.repeat(np.minimum.reduceat(own, starts), np.diff(np.concatenate([starts, [len(order)]])))
    return np.sort(order[own > least])


def comparable(data: np.ndarray, begins: np.ndarray, anchor: np.ndarray, doc: np.ndarray, width: int, splits: int = 7) -> np.ndarray:
    """Which strings can share a window of `width` bytes around their anchors with a string of another document.

    Of such a window the anchor leaves width - GRAM bytes. Their number before the anchor lies in one of `splits` ranges: the two strings agree on the
    anchor with the least number of the range before it and, behind it, what the greatest leaves.
    """
    ends, rest = np.concatenate([begins[1:], [len(data)]]), width - GRAM
    step = -(-(rest + 1) // splits)
    x = _loads(data)
    out = np.zeros(len(begins), bool)
    for before in range(0, rest + 1, step):
        behind = max(0, rest - (before + step - 1))
        size, first = before + GRAM + behind, anchor - before
        own = np.flatnonzero((anchor - begins >= before) & (ends - anchor - GRAM >= behind))
        if not len(own):
            continue
        code = np.zeros(len(own), np.uint64)
        for k in [*range(0, size - 8, 8), size - 8]:
            code = (code ^ x[first[own] + k]) * _MIX[0]
            code ^= code >> np.uint64(32)
        order = np.argsort(code, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], code[order][1:] != code[order][:-1]]))
        several = np.minimum.reduceat(doc[own][order], starts) < np.maximum.reduceat(doc[own][order], starts)
        out[own[order]] |= np.repeat(several, np.diff(np.concatenate([starts, [len(own)]])))
    return out


SPANS = "doc long, tie int, at long, size int"


def _sorted_shard(width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        data, ends = _bytes_of(table.column("data").chunk(0))
        begins = np.concatenate([[0], ends[:-1]])
        doc, tie, at, lead = (table.column(c).to_numpy() for c in ("doc", "tie", "at", "lead"))
        some = np.flatnonzero(comparable(data, begins, begins + lead, doc, width))
        if not len(some):
            return
        size = (ends - begins)[some]
        data = data[np.repeat(begins[some] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        ends = np.cumsum(size)
        begins, doc, tie, at = ends - size, doc[some], tie[some], at[some]
        found = repeats(data, begins, doc, width)
        if not len(found):
            return
        own = np.searchsorted(ends, found, side="right")
        new = np.concatenate([[True], (found[1:] != found[:-1] + 1) | (own[1:] != own[:-1])])
        first = np.flatnonzero(new)
        last = np.concatenate([first[1:], [len(found)]]) - 1
        own = own[first]
        yield pa.RecordBatch.from_arrays([pa.array(doc[own]), pa.array(tie[own]), pa.array(at[own] + found[first] - begins[own]), pa.array((found[last] - found[first] + width).astype(np.int32))], names=["doc", "tie", "at", "size"])

    return run


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {c: [] for c in ("gram", "doc", "tie", "at", "lead", "data")}
        for doc, tie, data, wanted in zip(*(batch.column(c).to_pylist() for c in ("_doc", "_tie", "_data")), batch.column("_wanted"), strict=True):
            rows = wanted.values
            gram, at, size, lead = (rows.field(k).to_pylist() for k in range(4))
            out["lead"] += lead
            out["gram"] += gram
            out["doc"] += [doc] * len(gram)
            out["tie"] += [tie] * len(gram)
            out["at"] += at
            out["data"] += [data[i : i + k] for i, k in zip(at, size, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(out["gram"], pa.int64()), pa.array(out["doc"], pa.int64()), pa.array(out["tie"], pa.int32()), pa.array(out["at"], pa.int64()), pa.array(out["lead"], pa.int32()), pa.array(out["data"], pa.binary())], names=list(out))


def _per_document(rows: DataFrame, *fields: str) -> DataFrame:
    return rows.groupBy(C("doc").alias("_d"), C("tie").alias("_t")).agg(F.collect_list(F.struct(*fields)).alias("_wanted"))


def with_spans(docs: DataFrame, width: int = 50) -> DataFrame:
    """`_row` (the columns of docs but text), `_doc`, `_tie`, `_data` and `_wanted`: the (at, size) of removed spans, overlapping and in no order; null if none."""
    n = parts(docs.sparkSession)
    full = keyed(docs)
    rows = full.select("_doc", "_tie", "_data").mapInArrow(_segment_rows(width), "gram long, content long, doc long, tie int, at long, gone boolean")
    staged = written(rows.repartition(n, "gram").sortWithinPartitions("gone", "gram", "content", "doc").mapInArrow(_classes, STAGED))
    dealt = full.repartition(n, "_doc")  # both joins take all its columns, so that the texts move once
    wanted = _per_document(staged.filter("kind = 1"), "gram", "at", "size", "lead")
    one = (C("_doc") == C("_d")) & (C("_tie").bitwiseXOR(C("_t")) == 0)  # rows with one doc_id are few: told apart after the join
    found = dealt.join(wanted, one).select("_doc", "_tie", "_data", "_row", "_wanted").mapInArrow(_fetch, "gram long, doc long, tie int, at long, lead int, data binary")
    spans = found.repartition(4 * n, "gram").mapInArrow(_sorted_shard(width), SPANS).union(staged.filter("kind = 0").select("doc", "tie", "at", "size"))
    return dealt.join(_per_document(spans, "at", "size"), one, "left").drop("_d", "_t")


def merged(at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs (begin, end) of overlapping or touching spans."""
    order = np.argsort(at, kind="stable")
    begin, end = at[order], np.maximum.accumulate((at + size)[order])
    new = np.concatenate([[True], begin[1:] > end[:-1]])
    first = np.flatnonzero(new)
    return begin[first], end[np.concatenate([first[1:], [len(begin)]]) - 1]


def _runs(wanted: pa.StructArray | None) -> tuple[list[int], list[int]]:
    if wanted is None:
        return [], []
    begin, end = merged(wanted.field(0).to_numpy(), wanted.field(1).to_numpy().astype(np.int64))
    return begin.tolist(), end.tolist()


def removal_report(docs: DataFrame, width: int = 50) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null text is empty. A null doc_id is the least. Rows with one doc_id remove nothing from each other. Long texts are read whole; other columns may have any name. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
            for data, wanted in zip(batch.column("_data"), batch.column("_wanted"), strict=True):
                raw = memoryview(data.as_buffer())
                begin, end = _runs(wanted.values)
                kept, at = hashlib.sha256(), 0
                for i, j in zip(begin, end, strict=True):
                    kept.update(raw[at:i])
                    at = j
                kept.update(raw[at:])
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(sum(end) - sum(begin))
                out["n_spans"].append(len(begin))
                out["kept_sha256"].append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, pa.string() if c == "kept_sha256" else pa.int64()) for c, v in out.items())], names=["doc_id", *out])

    own = with_spans(docs.select(C("doc_id").cast("long").alias("doc_id"), "text"), width)
    return own.select("_row.doc_id", "_data", "_wanted").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, width: int = 50) -> DataFrame:
    """docs with their repeats cut out of `text`; columns as in docs.

    Spans shrink to whole characters, so texts stay valid. n_chars, if there, is counted anew. Documents of which nothing is left go, null and empty ones too.
    Columns may have any name; rows that share a doc_id remove nothing from each other; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for data, wanted in zip(batch.column("_data"), batch.column("_wanted"), strict=True):
                raw = data.as_py()
                begin, end = _runs(wanted.values)
                out, at = [], 0
                for i, j in zip(begin, end, strict=True):
                    while i < j and raw[i] & 0xC0 == 0x80:
                        i += 1
                    while j > i and j < len(raw) and raw[j] & 0xC0 == 0x80:
                        j -= 1
                    out.append(raw[at:i])
                    at = j
                out.append(raw[at:])
                texts.append(b"".join(out).decode("utf-8", "replace"))
            columns = dict(zip([c for c in names if c != "text"], batch.column("_row").flatten(), strict=True))
            columns["text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    names = docs.columns
    cut = with_spans(docs, width).select("_row", "_data", "_wanted").mapInArrow(run, docs.schema)
    if "n_chars" in names:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.filter(F.length("text") > 0)

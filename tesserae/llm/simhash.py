"""SimHash near-duplicates by a binary trie self-join.

Fingerprints within `budget` bits leave at least blocks - budget of `blocks` bit blocks equal.
For every choice of so many blocks the fingerprints' bits are turned to begin with them, and
a binary trie of the turned fingerprints is joined with itself: pairs of nodes descend together, add up
their differing bits, and are dropped when these exceed the budget - which is none at all in
the leading blocks, so that tries of different leading bits are different tasks. A trie that
many fingerprints share is dealt out further, by pairs of nodes some levels down.

Equal fingerprints are one leaf. A task hands on, of the links it finds, a spanning forest with the
nearest first: no link between different groups is lost, and no group is written out pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts, written
from .components import components

C = F.col
#: Stands for a null doc_id, before all others.
NONE = -(2**63)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority bits of the XXH64 (seed 42) of a text's shingles of lower-cased (A-Z) words.

    Fewer words than a shingle are one shingle; no words, or a null text, give zero.
    """
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    runs = map(b" ".join, zip(*(w[i:] for i in range(shingle)))) if len(w) >= shingle else [b" ".join(w)]
    h = np.array([xxhash.xxh64_intdigest(x, 42) for x in runs], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fp (bigint with the fingerprint's bits) and same (Spark's xxhash64 of the text) of all docs (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = np.array([fingerprint(x, shingle) for x in texts], dtype=np.uint64)
            same = np.array([xxhash.xxh64_intdigest((x or "").encode("utf-8", "surrogatepass"), 42) for x in texts], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64)), pa.array(same.view(np.int64))], names=["doc_id", "fp", "same"])

    return docs.select(C("doc_id").cast("long").alias("doc_id"), C("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long, same long")


def keyed_prints(docs: DataFrame, shingle: int, words: int) -> DataFrame:
    """fingerprints(docs, shingle), its `same` as key, with n and sketch of the text's shingles of `words` words."""
    text = F.coalesce(C("text").cast("string"), F.lit(""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = np.array([fingerprint(x, shingle) for x in texts], dtype=np.uint64)
            sets = [hashed(x, words) for x in texts]
            sizes, drawn = [len(h) for h in sets], [sketch(h) for h in sets]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(found.view(np.int64)), pa.array(sizes, pa.int32()), pa.array(drawn, pa.binary())], names=["doc_id", "key", "fp", "n", "sketch"])

    some = docs.select(C("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    return some.mapInArrow(run, "doc_id long, key long, fp long, n int, sketch binary")


def turns(budget: int, blocks: int) -> list[list[tuple[int, int]]]:
    """For every choice of blocks - budget blocks: pieces (shift, width) of the bits, leading ones first."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    spans = [(64 - edges[i + 1], edges[i + 1] - edges[i]) for i in range(blocks)]
    out = []
    for first in combinations(range(blocks), blocks - budget):
        out.append([spans[i] for i in first] + [spans[i] for i in range(blocks) if i not in first])
    return out


def turned(fp: np.ndarray, pieces: list[tuple[int, int]]) -> np.ndarray:
    out = np.zeros(len(fp), np.uint64)
    for shift, width in pieces:
        out = (out << np.uint64(width)) | ((fp >> np.uint64(shift)) & np.uint64((1 << width) - 1))
    return out


def leading(pieces: list[tuple[int, int]], equal: int) -> int:
    return sum(width for _, width in pieces[:equal])


def trie_pairs(keys: np.ndarray, lead: int, budget: int, side: np.ndarray | None = None, room: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of sorted distinct keys within `budget` bits whose first `lead` bits are equal.

    A node is a range of keys with equal leading bits. A frontier of node pairs descends a level
    at a time; halves of a frontier larger than `room` wait on a stack, so memory is bounded.
    With side (0 or 1 for each key), only pairs between the sides are wanted.
    """
    if not len(keys):
        return
    one = np.uint64(1)

    def split(lo: np.ndarray, hi: np.ndarray, bit: int) -> np.ndarray:
        """First key of each range that has a one at `bit`; within a range higher bits agree."""
        base = keys[lo] >> np.uint64(bit) >> one << one << np.uint64(bit) if bit < 63 else np.zeros(len(lo), np.uint64)
        return np.clip(np.searchsorted(keys, base | (one << np.uint64(bit))), lo, hi)

    group = keys >> np.uint64(64 - lead) if lead else np.zeros(len(keys), np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    ends = np.concatenate([starts[1:], [len(keys)]])
    keep = ends - starts > 1
    starts, ends = starts[keep], ends[keep]
    stack = [(starts, ends, starts, ends, np.zeros(len(starts), np.int64), 63 - lead)]
    while stack:
        alo, ahi, blo, bhi, used, bit = stack.pop()
        if not len(alo):
            continue
        small = (ahi - alo) * (bhi - blo) <= 16
        if bit < 0:
            small[:] = True
        if small.any():
            yield from _leaves(keys, alo[small], ahi[small], blo[small], bhi[small], budget, side)
            alo, ahi, blo, bhi, used = (x[~small] for x in (alo, ahi, blo, bhi, used))
            if not len(alo):
                continue
        if len(alo) > room:
            half = len(alo) // 2
            stack.append(tuple(x[half:] for x in (alo, ahi, blo, bhi, used)) + (bit,))
            stack.append(tuple(x[:half] for x in (alo, ahi, blo, bhi, used)) + (bit,))
            continue
        am, bm = split(alo, ahi, bit), split(blo, bhi, bit)
        same = (alo == blo) & (ahi == bhi)
        kids = [(alo, am, blo, bm, used, None), (am, ahi, bm, bhi, used, None), (alo, am, bm, bhi, used + 1, None), (am, ahi, blo, bm, used + 1, ~same)]
        out = []
        for a, b, c, d, u, only in kids:
            ok = (b > a) & (d > c) & (u <= budget)
            if only is not None:  # a node with itself: the crossing pair is one pair
                ok &= only
            ok &= ~((a == c) & (b == d) & (b - a == 1))
            out.append(tuple(x[ok] for x in (a, b, c, d, u)))
        stack.append(tuple(np.concatenate(x) for x in zip(*out, strict=True)) + (bit - 1,))


def _leaves(keys, alo, ahi, blo, bhi, budget, side) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs below small node pairs, compared as they are."""
    na, nb = ahi - alo, bhi - blo
    size = na * nb
    step = max(1, (1 << 22) // max(int(size.max(initial=1)), 1))
    for k in range(0, len(size), step):
        s = slice(k, k + step)
        owner = np.repeat(np.arange(k, min(k + step, len(size))), size[s])
        first = np.cumsum(size[s]) - size[s]
        at = np.arange(len(owner)) - np.repeat(first, size[s])
        i, j = alo[owner] + at // nb[owner], blo[owner] + at % nb[owner]
        ok = (np.bitwise_count(keys[i] ^ keys[j]) <= budget) & (i != j)
        ok &= (i < j) | (alo[owner] != blo[owner])
        if side is not None:
            ok &= side[i] != side[j]
        yield i[ok], j[ok]


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Joins the trees of each link; returns those of the links that joined two."""
        used: list[tuple[np.ndarray, np.ndarray]] = [(i[:0], j[:0])]
        while True:
            a, b = self.root[i], self.root[j]
            open_ = a != b
            if not open_.any():
                return np.concatenate([x for x, _ in used]), np.concatenate([y for _, y in used])
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            high, first = np.unique(np.maximum(a, b), return_index=True)  # each root hangs below a smaller one, by one link
            self.root[high] = np.minimum(a, b)[first]
            used.append((i[first], j[first]))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def nearest_forest(keys: np.ndarray, pairs: Iterator[tuple[np.ndarray, np.ndarray]], budget: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs in which nearer keys are linked first. Memory is that of the forest and one portion of pairs."""
    i, j = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for a, b in pairs:
        if not len(a):
            continue
        i, j = np.concatenate([i, a]), np.concatenate([j, b])
        apart, forest, kept = np.bitwise_count(keys[i] ^ keys[j]), Forest(len(keys)), []
        for d in range(budget + 1):
            own = apart == d
            kept.append(forest.add(i[own], j[own]))
        i, j = (np.concatenate([k[x] for k in kept]) for x in (0, 1))
    return i, j


def trie_links(prints: DataFrame, budget: int = 3, blocks: int | None = None, heavy: int = 1 << 15) -> DataFrame:
    """Links (u, v) between fingerprints fp (bigint, distinct) that span their groups at `budget` bits.

    Two fingerprints are in one component of the links exactly if a chain of pairs within the
    budget joins them. heavy: from so many fingerprints on, a trie is dealt out by pairs of
    nodes some levels down, each with at most about heavy / 4 fingerprints if the bits spread.
    """
    blocks = blocks or budget + 1
    plan = turns(budget, blocks)
    equal = blocks - budget
    leads = [leading(p, equal) for p in plan]
    spark = prints.sparkSession

    def unroll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            for t, pieces in enumerate(plan):
                key = turned(fp, pieces)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(fp), t, np.int32)), pa.array((key >> np.uint64(64 - leads[t])).view(np.int64)), pa.array(key.view(np.int64))], names=["turn", "lead", "key"])

    keys = prints.select("fp").mapInArrow(unroll, "turn int, lead long, key long")
    sizes = keys.groupBy("turn", "lead").agg(F.count("*").alias("n")).filter(C("n") > 1)
    sizes = written(sizes)
    large = sizes.filter(C("n") > heavy)
    dealt = keys.withColumn("sub", F.lit(-1).cast("long")).withColumn("side", F.lit(0))
    n_large = large.count()
    if n_large:
        dealt = _deal_heavy(keys, sizes, plan, leads, budget, heavy)
    n = parts(spark)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        turn, key = table.column("turn").to_numpy(), table.column("key").to_numpy().view(np.uint64)
        sub, side = table.column("sub").to_numpy(), table.column("side").to_numpy()
        order = np.lexsort((side, key, sub, turn))
        turn, key, sub, side = turn[order], key[order], sub[order], side[order]
        cuts = np.flatnonzero(np.concatenate([[True], (turn[1:] != turn[:-1]) | (sub[1:] != sub[:-1]), [True]]))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            own = key[a:b]
            cross = side[a:b] if side[a:b].any() and not side[a:b].all() else None
            i, j = nearest_forest(own, trie_pairs(own, leads[turn[a]], budget, cross), budget)
            if len(i):
                back = _unturned(own, plan[turn[a]])
                yield pa.RecordBatch.from_arrays([pa.array(back[i].view(np.int64)), pa.array(back[j].view(np.int64))], names=["u", "v"])

    spread = dealt.repartition(n, "turn", "lead", "sub")
    return spread.select("turn", "sub", "side", "key").mapInArrow(join, "u long, v long")


def _unturned(key: np.ndarray, pieces: list[tuple[int, int]]) -> np.ndarray:
    out, at = np.zeros(len(key), np.uint64), 64
    for shift, width in pieces:
        at -= width
        out |= ((key >> np.uint64(at)) & np.uint64((1 << width) - 1)) << np.uint64(shift)
    return out


def _deal_heavy(keys: DataFrame, sizes: DataFrame, plan, leads, budget: int, heavy: int) -> DataFrame:
    """keys with sub and side: those of heavy tries once for each pair of nodes `depth` levels down
    that differ in `budget` bits or fewer, the others once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turn, lead, key = batch.column("turn").to_numpy(), batch.column("lead").to_numpy(), batch.column("key").to_numpy().view(np.uint64)
            n = batch.column("n").to_numpy(zero_copy_only=False)
            depth = np.where(n > heavy, np.minimum(np.ceil(np.log2(np.maximum(n, 1) * 4 / heavy)), 16), 0).astype(np.int64)
            for t, d in {(int(a), int(b)) for a, b in zip(turn, depth, strict=True)}:
                own = np.flatnonzero((turn == t) & (depth == d))
                if not d:
                    yield _batch(turn[own], lead[own], key[own], np.full(len(own), -1), np.zeros(len(own), np.int32))
                    continue
                node = (key[own] >> np.uint64(64 - leads[t] - d)) & np.uint64((1 << d) - 1)
                for flips in range(min(budget, d) + 1):
                    for bits in combinations(range(d), flips):
                        other = node ^ np.uint64(sum(1 << b for b in bits))
                        low, high = np.minimum(node, other), np.maximum(node, other)
                        sub = ((low << np.uint64(d)) | high).astype(np.int64)
                        yield _batch(turn[own], lead[own], key[own], sub, (node > other).astype(np.int32))

    with_n = keys.join(sizes.withColumnsRenamed({"turn": "_t", "lead": "_l"}), (C("turn") == C("_t")) & (C("lead") == C("_l"))).select("turn", "lead", "key", "n")
    return with_n.mapInArrow(run, "turn int, lead long, key long, sub long, side int")


def _batch(turn, lead, key, sub, side) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(turn.astype(np.int32)), pa.array(lead), pa.array(key.view(np.int64)), pa.array(sub.astype(np.int64)), pa.array(side)], names=["turn", "lead", "key", "sub", "side"])


def near_duplicates(docs: DataFrame, shingle: int = 3, budget: int = 3, blocks: int | None = None) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, fingerprint (16 hexadecimal digits), component_id.

    component_id is the smallest doc_id that links of at most `budget` differing bits reach.
    Texts without words have fingerprint zero and link like others; repeated rows get equal
    results; rows with a null doc_id are linked but name no component unless alone with others of that kind; an empty table gives no rows.
    """
    prints = written(fingerprints(docs, shingle))
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = components(trie_links(least.select("fp"), budget, blocks))
    named = least.join(groups, C("fp") == C("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    named = written(named.select("fp", "root", "least"))
    roots = named.groupBy(C("root").alias("_root")).agg(F.min("least").alias("component_id"))
    by_print = named.join(roots, C("root") == C("_root")).select(C("fp").alias("_fp"), "component_id")
    out = prints.join(by_print, C("fp") == C("_fp"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _alike(words: int, least: float):
    """Of pairs (a, b, text_a, text_b) those whose shingles of `words` words are that alike (Jaccard)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True):
                own, other = shingles(x, words), shingles(y, words)
                both = len(own & other)
                ok.append(both >= least * (len(own) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def shingles(text: str | None, n: int) -> set[bytes]:
    """The set of a text's shingles of n lower-cased (A-Z) words; fewer words are one shingle."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return set(map(b" ".join, zip(*(w[i:] for i in range(n))))) if len(w) >= n else {b" ".join(w)} if w else set()


def hashed(text: str | None, n: int) -> np.ndarray:
    """Ascending 64-bit hashes of shingles(text, n); a text without words has a zero, as such texts are alike."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.zeros(1, np.uint64)
    own = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    n = min(n, len(own))
    out = np.full(len(own) - n + 1, n, np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + own[j : len(own) - n + 1 + j]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(out ^ (out >> np.uint64(29)))


def sketch(h: np.ndarray) -> bytes:
    """Whether each of a power of two of buckets has an odd number of the hashes, bit by bit.

    Two sketches differ in no more bits than the sets have hashes that only one of them has. Halves laid
    over each other (xor) are the sketch of half the buckets, so that sketches of any sizes can be compared.
    """
    power = len(h).bit_length()
    size = 1 << max(9, min(power, 11), power - 1)  # at least half as many buckets as hashes: unlike sets differ in a fourth of their hashes, alike ones in two ninths
    odd = np.bincount((h & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


class Sketches:
    """Sketches of some sets, each held in its own size and folded to every smaller one that occurs."""

    def __init__(self, column: pa.Array):
        data, offsets = _flat(column)
        size = np.diff(offsets)
        self.kind = np.log2(np.maximum(size, 1)).astype(np.int64)
        self.rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        held, whose = None, np.zeros(0, np.int64)
        for kind in range(int(self.kind.max(initial=0)), int(self.kind.min(initial=0)) - 1, -1):
            own = np.flatnonzero(self.kind == kind)
            fresh = data[(offsets[own][:, None] + np.arange(1 << kind)).ravel()].view(np.uint64).reshape(len(own), (1 << kind) // 8)
            if held is not None:
                half = held.shape[1] // 2
                fresh = np.concatenate([held[:, :half] ^ held[:, half:], fresh])
            held, whose = fresh, np.concatenate([whose, own])
            place = np.zeros(len(size), np.int32)
            place[whose] = np.arange(len(whose))
            self.rows[kind] = held, place

    def apart(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """In how many bits, at the smaller size of both, the sketches differ."""
        out, least = np.zeros(len(i), np.int64), np.minimum(self.kind[i], self.kind[j])
        for kind in np.unique(least).tolist():
            (bits, place), own = self.rows[kind], np.flatnonzero(least == kind)
            step = max(1, (1 << 22) >> kind)
            for k in range(0, len(own), step):
                some = own[k : k + step]
                out[some] = np.bitwise_count(bits[place[i[some]]] ^ bits[place[j[some]]]).sum(1, dtype=np.int64)
        return out


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls, and where each value begins and ends among them."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def room(n: np.ndarray, m: np.ndarray, least: float) -> np.ndarray:
    """How many elements only one of two sets of n and m can have if they are `least` alike."""
    return n + m - 2 * needed(n + m, least / (1 + least))


def needed(n: np.ndarray | int, share: float) -> np.ndarray:
    """The least whole number that is `share` of n or more."""
    return np.ceil(share * n - 1e-9).astype(np.int64)


def _keyed_texts(docs: DataFrame) -> DataFrame:
    """key (the `same` of fingerprints) and text."""
    text = F.coalesce(C("text").cast("string"), F.lit(""))
    return docs.select(F.xxhash64(text).alias("key"), text.alias("text"))


def common_shingles(texts: DataFrame, words: int, sample: int = 20000, least: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Ascending hashes and counts of shingles that `least` or more of about `sample` distinct texts have: bounded by the sample.

    They are only put last in the order of shingles; any order gives the same pairs.
    """
    total = texts.count()
    some = texts.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < F.lit(int(min(1.0, sample / max(total, 1)) * (1 << 20))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            found = [hashed(t, words) for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True) if not (k in seen or seen.add(k))]
            if found:
                h, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    often = some.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(C("n") >= least).toArrow()
    h, n = often.column("h").to_numpy().view(np.uint64), often.column("n").to_numpy()
    order = np.argsort(h)
    return h[order], n[order]


def shared_shingles(docs: DataFrame, words: int, least: float) -> DataFrame:
    """sig, key, n, at: a row for each text and shingle that can prove it alike to another, if two texts or more have it.

    In any one order of all shingles, sets of n and m that are `least` alike have their first common shingle among the first
    n - needed(n) + 1 and m - needed(m) + 1. Rare shingles come first, so that few texts meet. n is the text's number of shingles, at the place of this one.
    """
    texts = _keyed_texts(docs)
    model = docs.sparkSession.sparkContext.broadcast(common_shingles(texts, words))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, counts = model.value
        seen: set[int] = set()
        for batch in batches:
            sigs, sizes, own = [np.zeros(0, np.uint64)], [], []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if key in seen:
                    continue
                seen.add(key)
                h = hashed(text, words)
                if len(often):
                    place = np.minimum(np.searchsorted(often, h), len(often) - 1)
                    h = h[np.argsort(np.where(often[place] == h, counts[place], 0), kind="stable")]
                sigs.append(h[: len(h) - int(needed(len(h), least)) + 1])
                sizes.append(len(h))
                own.append(key)
            taken = np.array([len(x) for x in sigs[1:]], np.int64)
            at = np.arange(taken.sum()) - np.repeat(np.cumsum(taken) - taken, taken)
            columns = [np.concatenate(sigs).view(np.int64), np.repeat(np.array(own, np.int64), taken), np.repeat(np.array(sizes, np.int32), taken), at.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["sig", "key", "n", "at"])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, _SIGS)
        sig, key = table.column("sig").to_numpy(), table.column("key").to_numpy()
        order = np.lexsort((key, sig))
        sig, key = sig[order], key[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        order, sig = order[new], sig[new]
        twin = np.zeros(len(sig), bool)
        twin[1:] = sig[1:] == sig[:-1]
        twin[:-1] |= sig[1:] == sig[:-1]
        yield from table.take(pa.array(order[twin])).to_batches(max_chunksize=1 << 16)

    kind = "sig long, key long, n int, at int"
    return texts.mapInArrow(first, kind).repartition(parts(docs.sparkSession), "sig").mapInArrow(met, kind)


_SIGS = pa.schema([("sig", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("at", pa.int32())])


def _held(batches: Iterator[pa.RecordBatch], *keys: str) -> pa.Table | None:
    """A task's rows as one table in the order of `keys`; None if there are none."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return None
    table = pa.Table.from_batches(held)
    return table.take(pa.array(np.lexsort([table.column(k).to_numpy() for k in reversed(keys)]))).combine_chunks()


def _partners(sig: np.ndarray, n: np.ndarray, at: np.ndarray, root: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows in the order of sig that share it, are of different roots and can be alike by size and place."""
    starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
    ends = np.repeat(np.concatenate([starts[1:], [len(sig)]]), np.diff(np.concatenate([starts, [len(sig)]])))
    i, apart = np.arange(len(sig)), 1
    while True:
        i = i[i + apart < ends[i]]
        if not len(i):
            return
        j = i + apart
        ok = root[i] != root[j]
        ok &= np.minimum(n[i], n[j]) >= needed(np.maximum(n[i], n[j]), least)
        ok &= np.minimum(at[i], at[j]) + np.minimum(n[i] - at[i], n[j] - at[j]) >= needed(n[i] + n[j], least / (1 + least))
        yield i[ok], j[ok]
        apart += 1


def _open_rows(sigs: DataFrame, roots: DataFrame, least: float) -> DataFrame:
    """sig, key, n, at, root of those rows of sigs that can have a partner: no sketch need travel to the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _held(batches, "sig", "key")
        if table is None:
            return
        some = np.zeros(table.num_rows, bool)
        for i, j in _partners(*(table.column(c).to_numpy().astype(np.int64) for c in ("sig", "n", "at", "root")), least):
            some[i] = some[j] = True
        yield from table.filter(pa.array(some)).to_batches(max_chunksize=1 << 16)

    named = sigs.join(roots, C("key") == C("node"), "left").select(*sigs.columns, F.coalesce("root", "key").alias("root"))
    return named.repartition(parts(sigs.sparkSession), "sig").mapInArrow(run, "sig long, key long, n int, at int, root long")


def _open_pairs(rows: DataFrame, texts: DataFrame, least: float, nearest: bool) -> tuple[DataFrame, DataFrame]:
    """Distinct pairs (a, b) of keys of different roots that share a sig and can be alike by size, place and sketch, and the rows that are in such pairs.

    nearest: of a task's pairs only a spanning forest of the roots, with the nearest first; so no more than the task has rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _held(batches, "sig", "key")
        if table is None:
            return
        sig, key, n, at, root = (table.column(c).to_numpy().astype(np.int64) for c in ("sig", "key", "n", "at", "root"))
        sketches = Sketches(table.column("sketch").chunk(0))
        names, own = np.unique(key, return_inverse=True)
        tree = np.zeros(len(names), np.int64)
        roots, tree[own] = np.unique(root, return_inverse=True)
        none = [np.zeros(0, np.int64)] * 3
        held, waiting, count, some = none, [], 0, np.zeros(len(sig), bool)

        def once() -> list[np.ndarray]:
            """a, b and distance of the pairs held and waiting, each once; nearest: a forest of them."""
            a, b, far = (np.concatenate([x, *(w[k] for w in waiting)]) for k, x in enumerate(held))
            _, first = np.unique(a * len(names) + b, return_index=True)
            a, b, far = a[first], b[first], far[first]
            if not nearest:
                return [a, b, far]
            forest, kept = Forest(len(roots)), [np.zeros(0, np.int64)]
            for d in np.unique(far).tolist():
                same = np.flatnonzero(far == d)
                low, high = np.minimum(tree[a[same]], tree[b[same]]), np.maximum(tree[a[same]], tree[b[same]])
                code, where = np.unique(low * len(roots) + high, return_index=True)
                u, v = forest.add(low[where], high[where])
                kept.append(same[where[np.searchsorted(code, u * len(roots) + v)]])
            return [x[np.concatenate(kept)] for x in (a, b, far)]

        def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.nulls(len(a), t) for t in _SIGS.types] + [pa.array(names[a]), pa.array(names[b])], names=[*_SIGS.names, "a", "b"])

        for i, j in _partners(sig, n, at, root, least):
            bits, most = sketches.apart(i, j), room(n[i], n[j], least)
            ok = bits <= most
            i, j, far = i[ok], j[ok], bits[ok] * 16 // np.maximum(most[ok], 1)
            some[i] = some[j] = True
            waiting.append((np.minimum(own[i], own[j]), np.maximum(own[i], own[j]), far))
            count += len(i)
            if count >= 1 << 20:
                held, waiting, count = once(), [], 0
                if not nearest:
                    yield out(*held[:2])
                    held = none
        yield out(*once()[:2])
        for batch in table.select(_SIGS.names).filter(pa.array(some)).to_batches(max_chunksize=1 << 16):
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.nulls(batch.num_rows, pa.int64())] * 2], names=[*_SIGS.names, "a", "b"])

    drawn = rows.join(texts.select(C("key").alias("_key"), "sketch"), C("key") == C("_key")).select("sig", "key", "n", "at", "root", "sketch")
    found = written(drawn.repartition(parts(rows.sparkSession), "sig").mapInArrow(run, "sig long, key long, n int, at int, a long, b long"))
    return found.filter("a is not null").select("a", "b").distinct(), found.filter("sig is not null").select(*_SIGS.names)


def _likely(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Those pairs (a, b) of keys that can be alike by size and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            n, m = (batch.column(c).to_numpy().astype(np.int64) for c in ("n_a", "n_b"))
            both = Sketches(pa.concat_arrays([batch.column("sketch_a"), batch.column("sketch_b")]))
            ok = np.minimum(n, m) >= needed(np.maximum(n, m), least)
            ok &= both.apart(np.arange(len(n)), np.arange(len(n), 2 * len(n))) <= room(n, m, least)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    for c in ("a", "b"):
        pairs = pairs.join(texts.select(C("key").alias(f"_{c}"), C("n").alias(f"n_{c}"), C("sketch").alias(f"sketch_{c}")), C(c) == C(f"_{c}"))
    return pairs.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def _true_links(docs: DataFrame, pairs: DataFrame, words: int, least: float) -> DataFrame:
    """Links (u, v) of those pairs (a, b) of keys whose texts, read whole, are alike."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("_key")).distinct()
    some = written(_keyed_texts(docs).join(wanted, C("key") == C("_key"), "left_semi").groupBy("key").agg(F.min("text").alias("text")))
    both = pairs.join(some.select(C("key").alias("_a"), C("text").alias("text_a")), C("a") == C("_a")).join(some.select(C("key").alias("_b"), C("text").alias("text_b")), C("b") == C("_b"))
    return written(both.select("a", "b", "text_a", "text_b").mapInArrow(_alike(words, least), "a long, b long").select(C("a").alias("u"), C("b").alias("v")))


def one_of_each(docs: DataFrame, shingle: int = 2, budget: int = 4, blocks: int | None = None, words: int = 5, least: float = 0.8) -> DataFrame:
    """docs without near duplicates: columns as they are.

    Texts whose shingles of `words` words are at least `least` alike (Jaccard), both read whole, are linked, and of each component the
    smallest doc_id stays. The links of the trie join within `budget` bits are read first, so that dense groups are one early. Then every pair
    of different groups that shares a shingle as alike texts must (shared_shingles) is read: first the nearest that join groups, then all that are still
    apart. Sketches tell, without an error, that most pairs can't be alike, so that few texts are read. So no component at `least` is missed. Equal texts
    are one text from the start. Rows with a null doc_id stay unless a text with a doc_id equals theirs in all; rows that share a doc_id stay or go together.
    """
    prints = written(keyed_prints(docs, shingle, words))
    texts = prints.groupBy("key").agg(F.min("fp").alias("fp"), F.coalesce(F.min("doc_id"), F.lit(NONE)).alias("doc"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    texts = written(texts)
    lead = written(texts.groupBy("fp").agg(F.min("key").alias("lead")))
    own = texts.join(lead.withColumnRenamed("fp", "_fp"), C("fp") == C("_fp")).filter(C("key") != C("lead")).select(C("key").alias("a"), C("lead").alias("b"))
    links = trie_links(lead.select("fp"), budget, blocks).distinct()
    links = links.join(lead.select(C("fp").alias("_u"), C("lead").alias("a")), C("u") == C("_u")).join(lead.select(C("fp").alias("_v"), C("lead").alias("b")), C("v") == C("_v")).select("a", "b")
    pairs = own.union(links).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = written(_likely(pairs, texts, least))
    true = _true_links(docs, pairs, words, least)
    rows = written(shared_shingles(docs, words, least))
    for nearest in (True, False):
        more, rows = _open_pairs(_open_rows(rows, components(true), least), texts, least, nearest)
        more = written(more.join(pairs.select(C("a").alias("_a"), C("b").alias("_b")), (C("a") == C("_a")) & (C("b") == C("_b")), "left_anti"))
        true, pairs = true.union(_true_links(docs, more, words, least)), pairs.union(more)
    grouped = texts.join(components(true), C("key") == C("node"), "left").groupBy(F.coalesce("root", "key").alias("root"))
    stay = grouped.agg(F.min("doc").alias("_stay")).select("_stay").distinct()
    held = docs.select(F.coalesce(C("doc_id").cast("long"), F.lit(NONE)).alias("_id"), F.struct(*docs.columns).alias("_held"))
    return held.join(stay, C("_id") == C("_stay"), "left_semi").select("_held.*")

"""N-gram scoring with Elias-Fano tries over all n-grams.

Documents are dealt to blocks, n-grams to shards: a shard has some first words with all that follows them. First words so
frequent that they would fill a shard are spread over several by their second word. Which words these are is read from a sample; it decides
where n-grams are kept, never what is counted.

1. A block is a row of a table, its texts compressed. It sends each shard its distinct n-grams as a small packed trie: words of all orders with their
   training counts, those of documents held out with a count of zero.
2. A shard adds these up and builds its trie: level k has the n-grams of k words. A word is stored as its hash lifted by
   its parent's number, so a level is one monotone sequence in Elias-Fano coding; where the children of a node begin is a second one. Probabilities
   and back-off weights are bytes on a quantised log scale. The levels are mapped from files. The n-grams that blocks ask for are looked up by
   successor search among the children of their context, and the bytes go back to each block in the order that it sent.
3. A block takes up the answers and scores its texts.

Nothing is left out: no n-gram is too rare, and no list of words is held by the driver or broadcast.

Smoothing is interpolated. Bigrams: (c(vw) + b p(w)) / (c(v) + b) (a Dirichlet prior). Longer n-grams: absolute discounting, where what
the counts lose goes to the next shorter context. Unigrams: discounted by Ney's estimate in favour of one class of unknown words.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import parts, slices, written

C = F.col
END = b" end"  # no word holds a space
#: Bits of a word's hash below its parent's number, and bytes that travel: after one word there are more followers to tell apart than after two.
WORD_BITS = 40
_MIX = np.uint64(0x9E3779B97F4A7C15)


class EliasFano:
    """An ascending sequence: low bits in whole bytes, high bits in unary with samples for select."""

    def __init__(self, low: np.ndarray, high: np.ndarray, width: int, n: int):
        self.low, self.high, self.width, self.n = low, high, width, n
        self._ones: np.ndarray | None = None

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = min(7, -(-max(0, (top // max(n, 1)).bit_length() - 1) // 8))
        bits = 8 * width
        high = np.zeros((n + (top >> bits) + 8) // 8, np.uint8)
        at = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        np.bitwise_or.at(high, at >> 3, (1 << (at & 7)).astype(np.uint8))
        low = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]).ravel()
        return cls(np.concatenate([low, np.zeros(8, np.uint8)]), high, width, n)

    def _select(self) -> tuple[np.ndarray, np.ndarray]:
        """Byte that holds every 64th one of the high bits, and the ones before that byte; found once."""
        if self._ones is None:
            counts = np.cumsum(np.bitwise_count(np.asarray(self.high)), dtype=np.int64)
            self._ones = np.searchsorted(counts, np.arange(0, self.n, 64), side="right")
            self._before = np.concatenate([[0], counts])[self._ones]
        return self._ones, self._before

    def _lows(self, i) -> np.ndarray:
        if not self.width:
            return np.zeros(self.n, np.uint64)[i]
        loads = np.ndarray((self.n,), "<u8", self.low, strides=(self.width,))
        return loads[i] & np.uint64((1 << (8 * self.width)) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at positions i."""
        i = np.asarray(i, np.int64)
        if not len(i):
            return np.zeros(0, np.uint64)
        ones, befores = self._select()
        byte, before = ones[i // 64].copy(), befores[i // 64].copy()
        while True:  # step to the byte that holds the one wanted
            own = np.bitwise_count(self.high[byte]).astype(np.int64)
            on = before + own <= i
            if not on.any():
                break
            before[on] += own[on]
            byte[on] += 1
        left, bit = i - before, np.zeros(len(i), np.int64)
        rest = self.high[byte].astype(np.int64)
        for b in range(8):
            one = (rest >> b) & 1
            hit = (one == 1) & (left == 0)
            bit[hit] = b
            left = np.where(hit, -1, left - one)
        return ((byte * 8 + bit - i).astype(np.uint64) << np.uint64(8 * self.width)) | self._lows(i)

    def decode(self, lo: int, hi: int) -> np.ndarray:
        """Values at positions lo..hi-1."""
        if hi <= lo:
            return np.zeros(0, np.uint64)
        ones, befores = self._select()
        byte, skip = int(ones[lo // 64]), lo - int(befores[lo // 64])
        stop = int(ones[(hi - 1) // 64 + 1]) + 1 if (hi - 1) // 64 + 1 < len(ones) else len(self.high)
        bits = np.flatnonzero(np.unpackbits(np.asarray(self.high[byte:stop]), bitorder="little"))[skip : skip + hi - lo]
        upper = (byte * 8 + bits - np.arange(lo, hi)).astype(np.uint64)
        return (upper << np.uint64(8 * self.width)) | self._lows(slice(lo, hi))

    def successor(self, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
        """First position in [lo, hi) whose value is not less than `value`, hi if none."""
        lo, hi = lo.copy(), hi.copy()
        while (open_ := lo < hi).any():
            at = np.flatnonzero(open_)
            mid = (lo[at] + hi[at]) // 2
            less = self.get(mid) < value[at]
            lo[at[less]] = mid[less] + 1
            hi[at[~less]] = mid[~less]
        return lo


class Quantiser:
    """Log10 values as codes 1..255 on an even scale from zero to `least`; code 0 stands for `absent`."""

    def __init__(self, least: float):
        self.least = min(float(least), -1e-6)

    def code(self, x: np.ndarray) -> np.ndarray:
        return (1 + np.round(np.clip(np.log10(np.maximum(x, 1e-300)) / self.least, 0, 1) * 254)).astype(np.uint8)

    def values(self, absent: float) -> np.ndarray:
        """What each of the 256 codes stands for, no longer as a logarithm."""
        return np.concatenate([[absent], 10.0 ** (np.arange(255) / 254 * self.least)])

    @classmethod
    def over(cls, x: np.ndarray) -> Quantiser:
        return cls(np.log10(max(float(x.min(initial=1.0)), 1e-300)))


def lifted(node: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of words below nodes, ascending with both."""
    if len(node) and int(node.max()) >> (64 - WORD_BITS):
        raise ValueError("a shard has too many n-grams; deal to more shards")
    return (node.astype(np.uint64) << np.uint64(WORD_BITS)) | word


class Trie:
    """Level 0: first words by hash. Level k: keys (words lifted by their parents), first (where a node's children begin), prob and,
    but for the last level, backoff, the weight of the next shorter context."""

    def __init__(self, levels: list[dict]):
        self.levels = levels

    @classmethod
    def of(cls, words: np.ndarray, totals: np.ndarray, grams: list[tuple[np.ndarray, np.ndarray]], prior: float, discount: float) -> Trie:
        """words: ascending hashes with their counts `totals`. grams: for each longer order ascending keys (number of the parent among all
        n-grams of the order below, hash of the word) and their counts. What has a count of zero isn't stored."""
        seen = totals > 0
        levels, node, context = [{"keys": EliasFano.of(words[seen])}], np.cumsum(seen) - 1, totals[seen].astype(np.float64)
        for k, (keys, counts) in enumerate(grams):
            seen = counts > 0
            own, count = keys[seen], counts[seen].astype(np.float64)
            parent = node[(own >> np.uint64(WORD_BITS)).astype(np.int64)]
            if k:
                prob = np.maximum(count - discount, 0) / context[parent]
                weight = discount * np.bincount(parent, minlength=len(context)) / np.maximum(context, 1)
                weight[weight <= 0] = 1.0  # a context without children says nothing
                scale = Quantiser.over(weight)
                levels[-1] |= {"backoff": scale.code(weight), "backoff_scale": scale}
            else:
                prob = count / (context[parent] + prior)
            scale = Quantiser.over(prob)
            levels.append({
                "keys": EliasFano.of(lifted(parent, own & np.uint64((1 << WORD_BITS) - 1))), "first": EliasFano.of(np.searchsorted(parent, np.arange(len(context) + 1))),
                "prob": scale.code(prob), "scale": scale, "backoff": np.ones(len(own), np.uint8), "backoff_scale": Quantiser(-1.0),
            })
            node, context = np.cumsum(seen) - 1, count
        return cls(levels)

    def save(self, folder: str) -> None:
        """A file for each array."""
        for k, level in enumerate(self.levels):
            for name, x in level.items():
                if isinstance(x, EliasFano):
                    np.save(f"{folder}/{k}-{name}-low.npy", x.low)
                    np.save(f"{folder}/{k}-{name}-high.npy", x.high)
                    np.save(f"{folder}/{k}-{name}-shape.npy", np.array([x.width, x.n]))
                else:
                    np.save(f"{folder}/{k}-{name}.npy", np.array([x.least]) if isinstance(x, Quantiser) else x)

    @classmethod
    def load(cls, folder: str) -> Trie:
        """The trie with its arrays mapped from the files."""

        def mapped(name: str) -> np.ndarray:
            path = f"{folder}/{name}.npy"
            return np.load(path, mmap_mode="r") if os.path.getsize(path) > 128 else np.load(path)

        levels: list[dict] = []
        while os.path.exists(f"{folder}/{len(levels)}-keys-low.npy"):
            k, level = len(levels), {}
            for name in ("keys", "first")[: 1 + (k > 0)]:
                width, n = mapped(f"{k}-{name}-shape")
                level[name] = EliasFano(mapped(f"{k}-{name}-low"), mapped(f"{k}-{name}-high"), int(width), int(n))
            if k:
                level |= {"prob": mapped(f"{k}-prob"), "backoff": mapped(f"{k}-backoff")}
                level |= {name: Quantiser(mapped(f"{k}-{name}")[0]) for name in ("scale", "backoff_scale")}
            levels.append(level)
        return cls(levels)

    def roots(self, words: np.ndarray) -> np.ndarray:
        """Numbers of first words (ascending hashes) in level 0, -1 where absent."""
        keys = self.levels[0]["keys"]
        have = keys.decode(0, keys.n)
        at = np.searchsorted(have, words)
        out = np.minimum(at, max(len(have) - 1, 0))
        return np.where(have[out] == words, out, -1) if len(have) else np.full(len(words), -1)

    def children(self, k: int, node: np.ndarray, word: np.ndarray, run: int = 1 << 16) -> np.ndarray:
        """Numbers in level k of the children `word` (hashes) of nodes of the level above (-1: none), -1 where absent.

        Questions come in ascending order of nodes and words. A run of them reads the children from those of its first
        context to those of its last, once, and finds each successor there.
        """
        level, out = self.levels[k], np.full(len(node), -1, np.int64)
        own = np.flatnonzero(node >= 0)
        for i in range(0, len(own), run):
            ask = own[i : i + run]
            lo, hi = level["first"].get(np.array([node[ask[0]], node[ask[-1]] + 1])).astype(np.int64).tolist()
            have, want = level["keys"].decode(lo, hi), lifted(node[ask], word[ask])
            if len(have):
                at = np.minimum(np.searchsorted(have, want), len(have) - 1)
                out[ask] = np.where(have[at] == want, at + lo, -1)
        return out


# --- packed counts and words ---------------------------------------------------------------


def _squeezed(raw: bytes) -> bytes:
    """Bytes of few kinds, by their entropy, after their length."""
    out = zstandard.ZstdCompressor(level=1).compress(raw)
    return len(out).to_bytes(4, "little") + out


def _pack(x: np.ndarray) -> bytes:
    """Counts as bytes; those of 255 or more follow as 64-bit integers."""
    return _squeezed(np.minimum(x, 255).astype(np.uint8).tobytes() + x[x >= 255].astype("<i8").tobytes())


class _Reader:
    def __init__(self, raw: bytes):
        self.raw, self.at = raw, 0

    def take(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self.raw, kind, n, self.at)
        self.at += out.nbytes
        return out

    def squeezed(self) -> _Reader:
        n = int(self.take("<u4", 1)[0])
        return _Reader(zstandard.ZstdDecompressor().decompress(self.take("u1", n)))

    def counts(self, n: int) -> np.ndarray:
        own = self.squeezed()
        out = own.take("u1", n).astype(np.int64)
        large = np.flatnonzero(out == 255)
        out[large] = own.take("<i8", len(large))
        return out

    def hashes(self, n: int, width: int) -> np.ndarray:
        out = np.zeros((n, 8), np.uint8)
        out[:, :width] = self.take("u1", n * width).reshape(n, width)
        return out.view("<u8").ravel()


def sent_bytes(k: int) -> int:
    """Bytes of a word's hash that travel at level k."""
    return 8 if k == 0 else WORD_BITS // 8 if k == 1 else 4


def held_out(doc_id: int | None, of: int = 10, rest: int = 0) -> bool:
    return crc32(str(doc_id).encode() if doc_id is not None else b"") % of == rest


class Block:
    """The tokens of some texts and their distinct n-grams, which depend on the set of texts alone, not on its order.

    words: ascending hashes. Level k has keys (number of the (k-1)-gram, number of the word) of the distinct k-grams; at[k] and which[k] say
    at which tokens one ends and which one.
    """

    def __init__(self, table: pa.Table, order: int, hot: tuple[np.ndarray, np.ndarray], n_shards: int):
        self.doc_id = table.column("doc_id")
        texts = pc.fill_null(table.column("text"), "")
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        cut = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        bounds = cut.offsets.to_numpy().astype(np.int64)
        coded = cut.flatten().dictionary_encode()
        local, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.binary()).to_pylist()
        names.append(END)
        real = np.fromiter((len(x) > 0 for x in names), bool, len(names))[local]  # white space at an end leaves empty pieces
        kept = np.concatenate([[0], np.cumsum(real)])[bounds - bounds[0]]
        self.sizes = np.diff(kept) + 1
        self.first = np.cumsum(self.sizes) - self.sizes
        own = np.full(int(self.sizes.sum()), len(names) - 1, np.int64)
        last = np.zeros(len(own), bool)
        last[self.first + self.sizes - 1] = True
        own[~last] = local[real]
        h = np.fromiter((xxhash.xxh64_intdigest(x or END) for x in names), np.uint64, len(names))
        self.words, number = np.unique(h, return_inverse=True)
        self.own, n = number[own], len(self.words)
        self.flags = np.fromiter((held_out(x) for x in self.doc_id.to_pylist()), bool, len(self.sizes))
        learned = np.repeat(~self.flags, self.sizes)
        self.counts = [np.bincount(self.own[learned], minlength=n)]
        self.keys, self.at, self.which = [np.arange(n)], [np.arange(len(own))], [self.own]
        node, blocked = self.own, np.zeros(len(own), bool)  # blocked: no n-gram of this order ends here
        blocked[self.first] = True
        for _ in range(2, order + 1):
            at = np.flatnonzero(~blocked)
            keys, which = np.unique(node[at - 1] * n + self.own[at], return_inverse=True)
            self.keys.append(keys)
            self.at.append(at)
            self.which.append(which)
            self.counts.append(np.bincount(which[learned[at]], minlength=len(keys)))
            node = np.full(len(own), -1, np.int64)
            node[at] = which
            blocked = blocked | np.concatenate([[True], blocked[:-1]])
        self._deal(hot, n_shards)

    def _deal(self, hot: tuple[np.ndarray, np.ndarray], n_shards: int) -> None:
        """order[k]: level k by shard; bounds[k]: where each shard begins there; kids[k]: children of each in that order."""
        n, kind = len(self.words), np.uint16 if n_shards < 1 << 16 else np.int64
        home = (self.words % np.uint64(n_shards)).astype(np.int64)
        spread = np.ones(n, np.int64)
        if len(hot[0]) and n:
            place = np.minimum(np.searchsorted(hot[0], self.words), len(hot[0]) - 1)
            spread = np.where(hot[0][place] == self.words, hot[1][place], 1)
        copies = np.repeat(np.arange(n), spread)
        turn = np.arange(len(copies)) - np.repeat(np.cumsum(spread) - spread, spread)
        shard = (home[copies] + turn) % n_shards
        by = np.argsort(shard.astype(kind), kind="stable")
        self.order, self.shards = [copies[by]], np.arange(n_shards + 1)
        self.bounds, self.kids = [np.searchsorted(shard[by], self.shards)], []
        place = shard[by] * n + copies[by]  # ascending
        where = place
        for k in range(1, len(self.keys)):
            parent, word = self.keys[k] // n, self.keys[k] % n
            if k == 1:
                some = np.where(spread[parent] > 1, ((self.words[word] * _MIX) >> np.uint64(33)).astype(np.int64) % spread[parent], 0)
                shard = (home[parent] + some) % n_shards
                above = np.searchsorted(place, shard * n + parent)
            else:
                shard, above = shard[parent], where[parent]
            by = np.argsort(shard.astype(kind), kind="stable")
            self.kids.append(np.bincount(above, minlength=len(self.order[-1])))
            self.order.append(by)
            self.bounds.append(np.searchsorted(shard[by], self.shards))
            where = np.empty(len(by), np.int64)
            where[by] = np.arange(len(by))
        self.kids.append(np.zeros(len(self.order[-1]), np.int64))

    def parcels(self) -> Iterator[tuple[int, bytes]]:
        """(shard, packed trie) for each shard that has any of the n-grams."""
        n = len(self.words)
        raw = self.words.astype("<u8").view(np.uint8).reshape(n, 8)
        words = [raw[o if k == 0 else self.keys[k][o] % n, : sent_bytes(k)] for k, o in enumerate(self.order)]
        counts = [c[o] for c, o in zip(self.counts, self.order, strict=True)]
        for s in range(len(self.shards) - 1):
            spans = [slice(int(b[s]), int(b[s + 1])) for b in self.bounds]
            if spans[0].start == spans[0].stop:
                continue
            out = [np.array([x.stop - x.start for x in spans], "<i8").tobytes()]
            for k, x in enumerate(spans):
                out += [words[k][x].tobytes(), _pack(counts[k][x])]
                if k < len(spans) - 1:
                    out.append(_pack(self.kids[k][x]))
            yield s, b"".join(out)

    def scores(self, replies: list[bytes], facts: tuple[int, int, float], prior: float) -> list[np.ndarray]:
        """n_known, base and score of each text. replies: in order of shards."""
        total, types, d = facts
        levels = len(self.order)
        found = [[] for _ in range(levels)]
        weight = [[] for _ in range(levels)]
        for raw in replies:
            read = _Reader(raw)
            sizes = read.take("<i8", levels)
            found[0].append(read.counts(int(sizes[0])))
            for k in range(1, levels):
                least, backoff = read.take("<f8", 2)
                found[k].append(Quantiser(least).values(0.0)[read.squeezed().take("u1", int(sizes[k]))])
                weight[k].append(Quantiser(backoff).values(1.0)[read.squeezed().take("u1", int(sizes[k]))])

        def ordered(k: int, values: list[np.ndarray]) -> np.ndarray:
            out = np.empty(len(self.keys[k]), values[0].dtype)
            out[self.order[k]] = np.concatenate(values)
            return out

        counts = ordered(0, found[0])
        unseen = max(d * types / total, 1e-9) if total else 1.0
        base = np.log10((counts + 0.1) / (total + 0.1 * (types + 1)))[self.own]
        now = np.where(counts > 0, np.maximum(counts - d, 1e-9) / max(total, 1), unseen)[self.own]
        share = np.where(counts > 0, prior / (counts + prior), 1.0)[self.own]  # weight of the shorter context after a token
        for k in range(1, levels):
            at = self.at[k]
            now[at] = ordered(k, found[k])[self.which[k]] + share[at - 1] * now[at]
            share = np.ones(len(now))
            share[at] = ordered(k, weight[k])[self.which[k]]
        return [np.add.reduceat(x, self.first) for x in ((counts > 0).astype(np.int64)[self.own], base, np.log10(now))]


REPLY = "shard int, block int, data binary, n long, types long, ones long, twos long"


def answer(shard: int, blocks: list[int], parcels: list[bytes], order: int, n_shards: int, prior: float, discount: float) -> pa.RecordBatch:
    """Adds up the parcels of a shard, builds its trie and looks up in it what each block asks for.

    n, types, ones, twos (on the first row): training tokens, distinct ones, and words seen once and twice of the words at home here.
    """
    words: list[list] = [[] for _ in range(order)]
    counts: list[list] = [[] for _ in range(order)]
    kids: list[list] = [[] for _ in range(order)]
    sizes = []
    for raw in parcels:
        read = _Reader(raw)
        sizes.append(read.take("<i8", order).tolist())
        for k, n in enumerate(sizes[-1]):
            words[k].append(read.hashes(n, sent_bytes(k)))
            counts[k].append(read.counts(n))
            if k < order - 1:
                kids[k].append(read.counts(n))
    keys, which = np.unique(np.concatenate(words[0]), return_inverse=True)
    totals = np.bincount(which, np.concatenate(counts[0]), len(keys)).astype(np.int64)
    grams, inverse = [], [which]
    for k in range(1, order):
        parent = np.repeat(which, np.concatenate(kids[k - 1]))
        own, which = np.unique(lifted(parent, np.concatenate(words[k])), return_inverse=True)
        grams.append((own, np.bincount(which, np.concatenate(counts[k]), len(own)).astype(np.int64)))
        inverse.append(which)
    with tempfile.TemporaryDirectory(prefix="trie-") as folder:
        Trie.of(keys, totals, grams, prior, discount).save(folder)
        trie = Trie.load(folder)
        node, found = trie.roots(keys), []
        for k in range(1, order):
            node = trie.children(k, node[(grams[k - 1][0] >> np.uint64(WORD_BITS)).astype(np.int64)], grams[k - 1][0] & np.uint64((1 << WORD_BITS) - 1))
            level, hit = trie.levels[k], node >= 0
            codes = [np.zeros(len(node), np.uint8) for _ in range(2)]
            for code, name in zip(codes, ("prob", "backoff"), strict=True):
                code[hit] = level[name][node[hit]]
            found.append((np.array([level["scale"].least, level["backoff_scale"].least], "<f8").tobytes(), *codes))
    at, data = [0] * order, []
    for own in sizes:
        spans = [slice(a, a + n) for a, n in zip(at, own, strict=True)]
        at = [x.stop for x in spans]
        out = [np.array(own, "<i8").tobytes(), _pack(totals[inverse[0][spans[0]]])]
        for k in range(1, order):
            scale, prob, backoff = found[k - 1]
            out += [scale, *(_squeezed(x[inverse[k][spans[k]]].tobytes()) for x in (prob, backoff))]
        data.append(b"".join(out))
    home = totals[(keys % np.uint64(n_shards)).astype(np.int64) == shard]
    facts = [int(home.sum()), int((home > 0).sum()), int((home == 1).sum()), int((home == 2).sum())]
    rest = [pa.array([x] + [0] * (len(blocks) - 1), pa.int64()) for x in facts]
    return pa.RecordBatch.from_arrays([pa.array([shard] * len(blocks), pa.int32()), pa.array(blocks, pa.int32()), pa.array(data, pa.binary()), *rest], names=["shard", "block", "data", "n", "types", "ones", "twos"])


def _hot_words(docs: DataFrame, size: int, n_shards: int, sample: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending hashes of the words that have half a shard's share of a sample's tokens or more (at most 2 n_shards), and over how many shards to spread each.

    sample: bytes of the sample, about. What isn't found hot here only makes a shard larger.
    """
    some = docs.select("text").sample(min(1.0, sample / max(size, 1)), seed=5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(batch.column("text"), ""))).flatten()
            found = pc.value_counts(words)
            n = found.field("counts").to_numpy()
            often = n * 8 * n_shards >= n.sum()
            h = np.fromiter((xxhash.xxh64_intdigest(x or END) for x in found.field("values").filter(pa.array(often)).cast(pa.binary()).to_pylist()), np.uint64, int(often.sum()))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([h.view(np.int64), [0]])), pa.array(np.concatenate([n[often], [0]])), pa.array(np.concatenate([np.zeros(len(h), np.int64), [n.sum()]]))], names=["h", "n", "of"])

    counts = some.mapInArrow(run, "h long, n long, of long").groupBy("h").agg(F.sum("n").alias("n"), F.sum("of").alias("of"))
    total = counts.agg(F.sum("of")).first()[0] or 0
    rows = counts.filter(C("n") * 2 * n_shards >= F.lit(max(total, 1))).select("h", "n").toArrow()
    h, n = rows.column("h").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    by = np.argsort(h)
    return h[by], np.minimum(np.ceil(2.0 * n_shards * n[by] / max(total, 1)), n_shards).astype(np.int64)


SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def scored(docs: DataFrame, order: int = 3, prior: float = 300.0, discount: float = 0.75, block_bytes: int = 4 << 20, shard_bytes: int = 12 << 20, sample: int = 16 << 20) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Documents whose crc32(doc_id as text) mod 10 is 0 are held out; the others are learned from, whole. A null text is empty: one
    end. Repeated rows count and are scored as they are. A null doc_id is learned from or not by the crc32 of an empty text (0: held out). Without a training token all words are unknown.
    Only doc_id and text are read, so other columns may have any name. An empty table gives no rows. Words are told apart by 64-bit hashes, words after one word by 40 bits of them, after two or more by 32.
    order: words of the longest n-gram, 2 at least. block_bytes, shard_bytes: text that one task's block or shard has, about; numbers of both grow with the input.
    """
    n = parts(docs.sparkSession)
    own = docs.select(C("doc_id").cast("long").alias("doc_id"), C("text").cast("string").alias("text"))
    size = own.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    n_blocks, n_shards = max(n, -(-size // block_bytes)), max(n, -(-size // shard_bytes))
    hot = _hot_words(own, size, n_shards, sample)
    dealt = own.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int")).groupBy("block")

    def pack(table: pa.Table) -> pa.Table:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        return pa.table({"block": table.column("block").slice(0, 1), "texts": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    def unpacked(texts: pa.Scalar) -> Block:
        return Block(pa.ipc.open_stream(texts.as_buffer()).read_all(), order, hot, n_shards)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, texts in zip(batch.column("block"), batch.column("texts"), strict=True):
                found = list(unpacked(texts).parcels())
                yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in found], pa.int32()), pa.array([block.as_py()] * len(found), pa.int32()), pa.array([x for _, x in found], pa.binary())], names=["shard", "block", "data"])
                del found
                pa.default_memory_pool().release_unused()  # else workers keep what one block took beside the JVM

    def reply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for shard, block, data in zip(*(batch.column(c).to_pylist() for c in ("shard", "block", "data")), strict=True):
                blocks, parcels = held.setdefault(shard, ([], []))
                blocks.append(block)
                parcels.append(data)
        for shard in list(held):
            yield answer(shard, *held.pop(shard), order, n_shards, prior, discount)

    blocks = written(dealt.applyInArrow(pack, "block int, texts binary"))
    parcels = blocks.mapInArrow(send, "shard int, block int, data binary")
    replies = written(parcels.repartitionById(n_shards, C("shard")).mapInArrow(reply, REPLY))
    found = replies.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "types", "ones", "twos")]).first()
    total, types, ones, twos = map(int, found)
    # discount of unigrams by Ney's estimate; what it takes from them is what unknown words get
    facts = (total, types, ones / (ones + 2 * twos) if ones else 0.5)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        block = unpacked(left.column("texts")[0])
        by = np.argsort(right.column("shard").to_numpy())
        data = right.column("data")
        sums = block.scores([data[i].as_py() for i in by.tolist()], facts, prior)
        known, base, of = sums
        columns = [block.doc_id, pa.array(block.flags), pa.array(block.sizes), pa.array(known), pa.array(np.full(len(known), total, np.int64)), pa.array(base), pa.array(of)]
        return pa.Table.from_arrays([x if isinstance(x, pa.ChunkedArray) else pa.chunked_array([x]) for x in columns], schema=SCORES)

    both = blocks.groupBy("block").cogroup(replies.select("block", "shard", "data").groupBy("block"))
    return both.applyInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")

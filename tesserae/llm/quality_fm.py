"""Quality classifier: a factorisation machine over hashed words, word shapes and structure.

score = w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j, the pairs by the sum-of-squares
identity, 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2), so in linear time. The model is
fitted on a bounded sample of labelled rows; every text is scored whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

C = F.col
WORDS, SHAPES = 1 << 15, 1 << 10
STATS = ("words", "word_length", "symbols", "capitals", "digits", "distinct", "stutter", "triples", "duplicate_lines", "line_words", "ends")
SIZE = WORDS + SHAPES + len(STATS)

_RUNS = [(re.compile(rb"[a-z\x80-\xff]+"), b"a"), (re.compile(rb"[A-Z]+"), b"A"), (re.compile(rb"[0-9]+"), b"0")]
_SYMBOLS, _CAPITALS, _DIGITS = b"#*$%&|<>", bytes(range(65, 91)), bytes(range(48, 58))


class _Buckets(dict):
    """word -> (word bucket << 10 | shape bucket), for as many words as fit the bound."""

    def __missing__(self, word: bytes) -> int:
        shape = word
        for run, mark in _RUNS:
            shape = run.sub(mark, shape)
        found = (crc32(word.lower()) % WORDS << 10) | crc32(shape[:8]) % SHAPES
        if len(self) < 500_000:
            self[word] = found
        return found


_BUCKETS = _Buckets()


def _unique(owner: np.ndarray, bucket: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    key, n = np.unique(owner * size + bucket, return_counts=True)
    return key // size, key % size, n


def _scaled(owner: np.ndarray, n: np.ndarray, docs: int) -> np.ndarray:
    """Log counts of each document, to length one."""
    x = np.log1p(n)
    return x / np.sqrt(np.bincount(owner, x * x, minlength=docs))[owner]


def featured(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, feature, value) triples of texts, by document; a text has at least its statistics."""
    docs = len(texts)
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    split = [r.split() for r in raw]
    sizes = np.array([len(w) for w in split])
    owner = np.repeat(np.arange(docs), sizes)
    both = np.fromiter(map(_BUCKETS.__getitem__, chain.from_iterable(split)), np.int64, len(owner))
    word, shape = both >> 10, both & 1023
    wo, wb, wn = _unique(owner, word, WORDS)
    so, sb, sn = _unique(owner, shape, SHAPES)
    some = np.maximum(sizes, 1)
    stats = np.zeros((docs, len(STATS)))
    chars = np.array([sum(map(len, w)) for w in split])
    near = owner[1:] == owner[:-1]
    stats[:, 0] = np.log1p(sizes) / 5
    stats[:, 1] = np.minimum(chars / some, 20) / 5
    stats[:, 2] = np.minimum([(len(r) - len(r.translate(None, _SYMBOLS))) / n for r, n in zip(raw, some.tolist(), strict=True)], 3)
    stats[:, 3] = [(len(r) - len(r.translate(None, _CAPITALS))) / max(len(r), 1) for r in raw]
    stats[:, 4] = [(len(r) - len(r.translate(None, _DIGITS))) / max(len(r), 1) for r in raw]
    stats[:, 5] = np.bincount(wo, minlength=docs) / some
    stats[:, 6] = np.bincount(owner[1:], near & (both[1:] == both[:-1]), minlength=docs) / some if len(owner) else 0
    if len(owner) > 2:
        whole = (owner[2:] == owner[:-2])
        to, _, _ = _unique(owner[2:][whole], (word[2:] + word[1:-1] * 31 + word[:-2] * 1021)[whole] % (1 << 40), 1 << 40)
        stats[:, 7] = 1 - np.bincount(to, minlength=docs) / np.maximum(sizes - 2, 1)
    lines = [[x for x in r.split(b"\n") if x.strip()] for r in raw]
    stats[:, 8] = [1 - len(set(x)) / max(len(x), 1) for x in lines]
    stats[:, 9] = np.log1p(some / np.maximum([len(x) for x in lines], 1)) / 5
    stats[:, 10] = [sum(x.rstrip()[-1:] in b".!?" for x in ls) / max(len(ls), 1) for ls in lines]
    d = np.concatenate([wo, so, np.repeat(np.arange(docs), len(STATS))])
    f = np.concatenate([wb, WORDS + sb, np.tile(WORDS + SHAPES + np.arange(len(STATS)), docs)])
    x = np.concatenate([_scaled(wo, wn, docs), _scaled(so, sn, docs), stats.reshape(-1)])
    order = np.argsort(d, kind="stable")
    return d[order], f[order], x[order].astype(np.float32)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def logits(self, d: np.ndarray, f: np.ndarray, x: np.ndarray, docs: int) -> np.ndarray:
        """Linear in the number of triples; d ascending, each of 0..docs-1 at least once."""
        first = np.searchsorted(d, np.arange(docs))
        vx = self.factors[f] * x[:, None]
        pairs = 0.5 * (np.add.reduceat(vx, first) ** 2 - np.add.reduceat(vx * vx, first)).sum(1)
        return self.bias + np.add.reduceat(self.linear[f] * x, first) + pairs

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.logits(*featured(texts), len(texts)), -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int = 8, epochs: int = 8, rate: float = 0.02, decay: float = 1e-5, batch: int = 128, seed: int = 5) -> Machine:
    """Logistic loss, Adam; rows are (features, values) of a document. Without both labels the score is the rate of label 1."""
    rng = np.random.default_rng(seed)
    share = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
    machine = Machine(float(np.log(share / (1 - share))), np.zeros(SIZE, np.float32), rng.normal(0, 0.02, (SIZE, rank)).astype(np.float32))
    if len(set(labels.tolist())) < 2:
        machine.factors[:] = 0
        return machine
    moments = [np.zeros_like(machine.linear), np.zeros_like(machine.linear), np.zeros_like(machine.factors), np.zeros_like(machine.factors)]
    bias_m, bias_v, step = 0.0, 0.0, 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), batch):
            own, step = order[k : k + batch], step + 1
            f, x = (np.concatenate([rows[i][j] for i in own]) for j in (0, 1))
            sizes = np.array([len(rows[i][0]) for i in own])
            d = np.repeat(np.arange(len(own)), sizes)
            first = np.cumsum(sizes) - sizes
            vx = machine.factors[f] * x[:, None]
            sums = np.add.reduceat(vx, first)
            z = machine.bias + np.add.reduceat(machine.linear[f] * x, first) + 0.5 * (sums**2 - np.add.reduceat(vx * vx, first)).sum(1)
            error = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[own]) / len(own)).astype(np.float32)
            gl = np.bincount(f, error[d] * x, minlength=SIZE).astype(np.float32) + decay * machine.linear
            gf = np.zeros_like(machine.factors)
            np.add.at(gf, f, (error[d] * x)[:, None] * (sums[d] - vx))
            gf += decay * machine.factors
            fix1, fix2 = 1 - 0.9**step, 1 - 0.999**step
            for value, grad, m, v in ((machine.linear, gl, moments[0], moments[1]), (machine.factors, gf, moments[2], moments[3])):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                value -= rate * (m / fix1) / (np.sqrt(v / fix2) + 1e-8)
            gb = float(error.sum())
            bias_m, bias_v = 0.9 * bias_m + 0.1 * gb, 0.999 * bias_v + 0.001 * gb * gb
            machine.bias -= rate * (bias_m / fix1) / (np.sqrt(bias_v / fix2) + 1e-8)
    return machine


def _is_held_out(doc_id: int | None) -> bool:
    return crc32(str(doc_id).encode() if doc_id is not None else b"") % 4 == 2


def training_sample(docs: DataFrame, labels: DataFrame, rows: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Features and labels of at most `rows` labelled documents that are not held out, chosen by a hash of their doc_id."""
    own = labels.filter(C("quality").isNotNull() & C("doc_id").isNotNull()).groupBy(C("doc_id").cast("long").alias("_id")).agg(F.max("quality").alias("_quality"))
    own = own.filter(F.pmod(F.crc32(C("_id").cast("string").cast("binary")), F.lit(4)) != 2)
    some = own.orderBy(F.xxhash64("_id"), "_id").limit(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            d, f, x = featured(batch.column("text").to_pylist())
            first = np.searchsorted(d, np.arange(batch.num_rows + 1))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(f.astype(np.int32))), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(x))], names=["doc_id", "quality", "f", "x"])

    texts = docs.select(C("doc_id").cast("long").alias("doc_id"), C("text").cast("string").alias("text"))
    # at most `rows` rows on one side
    picked = texts.join(F.broadcast(some), C("doc_id") == C("_id")).select("doc_id", "text", C("_quality").cast("int").alias("quality"))
    table = picked.mapInArrow(run, "doc_id long, quality int, f array<int>, x array<float>").toArrow().sort_by("doc_id")
    f, x = (table.column(c).to_pylist() for c in ("f", "x"))
    return [(np.array(a, np.int32), np.array(b, np.float32)) for a, b in zip(f, x, strict=True)], table.column("quality").to_numpy().astype(np.float64)


def classified(docs: DataFrame, labels: DataFrame, rows: int = 8000, threshold: float = 0.7) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, held_out, score (0 to 1), predicted (1 from `threshold` on).

    labels (doc_id, quality 0/1) of documents whose crc32(doc_id as text) mod 4 is 2 are never read; of
    several for a document the greatest counts. rows bounds the sample that the model is fitted on. Only texts
    make a score; a null text is empty, and empty texts share one score. Repeated rows get equal scores. Without labels all scores are 0.5. Long texts are read whole; other columns may have any name; an empty table gives no rows.
    """
    machine = docs.sparkSession.sparkContext.broadcast(fit(*training_sample(docs, labels, rows)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            score = machine.value.scores(batch.column("text").to_pylist())
            flags = [_is_held_out(x) for x in batch.column("doc_id").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(flags), pa.array(score), pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    texts = docs.select(C("doc_id").cast("long").alias("doc_id"), C("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")

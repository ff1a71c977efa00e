"""Encoding with a public tokenizer, one cache of white-space chunks for each worker."""

from __future__ import annotations

import ctypes
import threading
from collections.abc import Iterable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

class ChunkEncoder:
    """Encodes texts with the `tokenizers` library, remembering chunks between single spaces.

    A byte-level pre-tokenizer ends a token wherever one space follows a non-space
    character and precedes another, so a text equals its chunks " word" encoded one
    by one. Texts where a space meets other white space are encoded whole.
    The cache holds at most `limit` chunks, then starts anew: memory is bounded and
    the ids never depend on it.
    """

    def __init__(self, path: str, limit: int = 1_000_000, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.limit = limit
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.spaced = np.array([(self.tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])
        self.chunks: dict[str, bytes] = {}
        self.lock = threading.Lock()
        self.timer: threading.Timer | None = None

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=self.kind).tobytes() for x in found]

    def _learn(self, missing: Iterable[str]) -> None:
        """Encodes new chunks in long runs; a token that begins with a space begins a chunk."""
        new = list(missing)
        for k in range(0, len(new), 200):
            some = new[k : k + 200]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, dtype=self.kind)
            at = np.flatnonzero(self.spaced[ids])
            if len(at) != len(some):  # a special token in the text took a space with it
                self.chunks.update(zip(some, self._plain([f" {x}" for x in some]), strict=True))
                continue
            raw, w = ids.tobytes(), self.kind.itemsize
            ends = [*(at[1:] * w).tolist(), len(ids) * w]
            self.chunks.update(zip(some, (raw[i:j] for i, j in zip((at * w).tolist(), ends, strict=True)), strict=True))

    def _forget(self) -> None:
        """Give memory back: a Python worker that waits for its next task keeps what it holds beside the JVM."""
        with self.lock:
            self.chunks = {}
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text); a null text has none.

        Chunks are forgotten a few seconds after the last use.
        """
        if self.timer:
            self.timer.cancel()
        with self.lock:
            out = self._column(texts)
        self.timer = threading.Timer(4, self._forget)
        self.timer.daemon = True
        self.timer.start()
        return out

    def _column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        n = len(texts)
        if not n:
            return np.zeros(0, self.kind), np.zeros(0, np.int64)
        cut = pc.split_pattern(texts, " ")
        bounds = cut.offsets.to_numpy().astype(np.int64)
        bounds, heads = bounds - bounds[0], cut.offsets.to_numpy()[:-1] - cut.offsets[0].as_py()
        pieces = cut.flatten().dictionary_encode()
        at, names = pieces.indices.to_numpy().astype(np.int64), pieces.dictionary.to_pylist()
        first = [names[i] for i in at[heads].tolist()]
        if len(self.chunks) > self.limit:
            self.chunks = {}
        odd = np.array([not x or x[0].isspace() or x[-1].isspace() for x in names])
        beside = odd[at]
        beside[heads] = False
        whole = np.logical_or.reduceat(beside, heads)
        whole |= np.array([not x or x[-1].isspace() for x in first])
        self._learn(x for x, o in zip(names, odd.tolist(), strict=True) if not o and x not in self.chunks)
        own = self._plain([x if not w else texts[i].as_py() for i, (x, w) in enumerate(zip(first, whole.tolist(), strict=True))])
        raw = [*map(self.chunks.get, names, repeat(b"")), *own]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // self.kind.itemsize
        starts = np.cumsum(sizes) - sizes
        at[heads] = len(names) + np.arange(n)
        long = sizes[at]
        drop = np.repeat(whole, np.diff(bounds))
        drop[heads] = False
        long[drop] = 0
        ends = np.cumsum(long)
        flat = np.frombuffer(b"".join(raw), self.kind)[np.repeat(starts[at] - (ends - long), long) + np.arange(ends[-1])]
        return flat, np.diff(np.concatenate([[0], ends])[bounds])

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        flat, sizes = self.column(pa.array(texts, pa.string()))
        return np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []


_ENCODERS: dict[tuple, ChunkEncoder] = {}


def encoder(path: str, special_as_text: bool = False) -> ChunkEncoder:
    """The encoder of this Python process for that file."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    key = (path, special_as_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(path, special_as_text=special_as_text)
    return _ENCODERS[key]

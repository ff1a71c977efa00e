"""Suffix arrays by external induced sorting, vectorised.

Suffixes are S (less than their successor) or L. The leftmost S suffixes (LMS) are sorted by
recursion on the string of their substrings' names; they induce the L suffixes in ascending
order, and these the S suffixes in descending order. Tuples wait in a priority queue of sorted runs that go to
disk beyond a bound of memory; equal keys come out first in, first out. All tuples whose keys lie
in a range that nothing from that range is induced into are taken at once.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np


#: Strings of names within the recursion below this length are sorted by doubling: taking their tuples range by range costs more than sorting them.
SHORT = 1 << 16


class RunQueue:
    """(key, value) tuples out by ascending key, first in first out among equals.

    New tuples gather in a buffer, which becomes a sorted run; beyond `memory` tuples the runs are
    written to files of a temporary folder and mapped.
    """

    def __init__(self, memory: int = 1 << 23, buffer: int = 1 << 16):
        self.memory, self.limit = memory, buffer
        self.runs: list[list] = []  # keys, values, first not taken
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_new = self.held = 0
        self.folder: tempfile.TemporaryDirectory | None = None

    def push(self, keys: np.ndarray, values: np.ndarray) -> None:
        if len(keys):
            self.new.append((keys, values))
            self.n_new += len(keys)
            if self.n_new >= self.limit:
                self._close()

    def _close(self) -> None:
        if not self.new:
            return
        keys = np.concatenate([k for k, _ in self.new])
        values = np.concatenate([v for _, v in self.new])
        order = np.argsort(keys, kind="stable")
        run = [keys[order], values[order], 0]
        self.new, self.n_new = [], 0
        self.held += len(run[0])
        # runs at the end that are no longer than twice what follows are merged with it: few runs are left, of falling lengths and in order of age
        size, first = len(run[0]), len(self.runs)
        while first and not isinstance(self.runs[first - 1][0], np.memmap) and len(self.runs[first - 1][0]) - self.runs[first - 1][2] <= 2 * size:
            first -= 1
            size += len(self.runs[first][0]) - self.runs[first][2]
        if first < len(self.runs):
            last = [*self.runs[first:], run]
            self.runs = self.runs[:first]
            k, v = (np.concatenate([r[x][r[2] :] for r in last]) for x in (0, 1))
            order = np.argsort(k, kind="stable")
            run = [k[order], v[order], 0]
        if self.held > self.memory:
            self._spill()
        self.runs.append(run)

    def _spill(self) -> None:
        self.folder = self.folder or tempfile.TemporaryDirectory(prefix="runs-")
        for run in self.runs:
            if not isinstance(run[0], np.memmap) and len(run[0]) > run[2]:
                for x in (0, 1):
                    path = os.path.join(self.folder.name, f"{id(run)}-{x}-{len(os.listdir(self.folder.name))}.npy")
                    np.save(path, run[x][run[2] :])
                    run[x] = np.load(path, mmap_mode="r")
                run[2] = 0
        self.held = 0

    def least(self) -> int | None:
        self._close()
        heads = [int(k[p]) for k, _, p in self.runs if p < len(k)]
        return min(heads) if heads else None

    def take(self, below: int) -> tuple[np.ndarray, np.ndarray]:
        """All tuples with a key less than `below`."""
        keys, values = [], []
        for run in self.runs:
            k, v, p = run
            if p < len(k) and k[p] < below:
                q = p + int(np.searchsorted(k[p:], below))
                keys.append(k[p:q])
                values.append(v[p:q])
                run[2] = q
        self.runs = [r for r in self.runs if r[2] < len(r[0])]
        if len(keys) == 1:
            return np.asarray(keys[0]), np.asarray(values[0])
        k, v = np.concatenate(keys), np.concatenate(values)
        order = np.argsort(k, kind="stable")
        return k[order], v[order]

    def close(self) -> None:
        self.runs = []
        if self.folder:
            self.folder.cleanup()


def _induce(seed_keys: np.ndarray, seeds: np.ndarray, wanted: np.ndarray, keys: np.ndarray, first: int | None, memory: int) -> tuple[np.ndarray, np.ndarray]:
    """Induced suffixes in order and their keys.

    wanted[j]: j is of the induced type. keys[j]: its key. A suffix that comes out puts its predecessor in.
    """
    queue = RunQueue(memory)
    if first is not None:
        queue.push(keys[first : first + 1], np.array([first], seeds.dtype))
    queue.push(seed_keys, seeds)
    out_k, out_v, width = [], [], 1
    while (low := queue.least()) is not None:
        k, v = queue.take(low + width)
        before = v - 1
        ok = before >= 0
        ok[ok] = wanted[before[ok]]
        to = keys[before[ok]]
        inside = to < low + width
        cut = max(int(to[inside].min()), low + 1) if inside.any() else low + width
        if cut < low + width:
            m = int(np.searchsorted(k, cut))
            back_k, back_v = k[m:], v[m:]
            k, v, ok, before = k[:m], v[:m], ok[:m], before[:m]
            queue.push(back_k, back_v)
            queue._close()
            to = keys[before[ok]]
            width = max(1, cut - low)
        elif not inside.any():
            width *= 2
        own = wanted[v]
        out_k.append(k[own])
        out_v.append(v[own])
        queue.push(to, before[ok])
    queue.close()
    if not out_v:
        return np.zeros(0, keys.dtype), np.zeros(0, seeds.dtype)
    return np.concatenate(out_k), np.concatenate(out_v)


def _types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is S; the end of the text is less than any character."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int64) - text[:-1]).astype(np.int8)
    step[-1] = -1
    at = np.where(step != 0, np.arange(n), n)
    nearest = np.minimum.accumulate(at[::-1])[::-1]
    return step[nearest] > 0


def _sorted_from(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, memory: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """L suffixes ascending and S suffixes descending, each with keys, induced from LMS suffixes in the given order."""
    wide = text.astype(np.int32 if len(text) < 1 << 30 else np.int64) * 2
    keys = wide + is_s
    order = np.argsort(text[lms], kind="stable")
    seeds = lms[order]
    lk, lv = _induce(keys[seeds], seeds, ~is_s, keys, len(text) - 1, memory)
    down = keys.max() - keys
    sk, sv = _induce(down[lv[::-1]], lv[::-1], is_s, down, None, memory)
    return lk, lv, keys.max() - sk, sv


def _names(text: np.ndarray, lms: np.ndarray, by_order: np.ndarray) -> np.ndarray:
    """Name of each LMS substring, by text position: the rank of its content. by_order: LMS positions sorted by substring."""
    n = len(text)
    stop = np.full(n + 1, n, lms.dtype)
    stop[lms[:-1]] = lms[1:]
    a, b = by_order[:-1], by_order[1:]
    la, lb = stop[a] - a, stop[b] - b
    differ = la != lb
    differ |= (stop[a] == n) | (stop[b] == n)  # the last one reaches the end of the text
    open_, k = np.flatnonzero(~differ), 0
    while len(open_):
        same = text[a[open_] + k] == text[b[open_] + k]
        differ[open_[~same]] = True
        open_ = open_[same]
        k += 1
        open_ = open_[la[open_] >= k]
    rank = np.concatenate([[0], np.cumsum(differ)])
    out = np.zeros(n, np.int64)
    out[by_order] = rank
    return out[lms]


def _small(text: np.ndarray) -> np.ndarray:
    """Suffix array by doubling, for short texts."""
    n = len(text)
    rank, k = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while True:
        second = np.full(n, -1, np.int64)
        second[: n - k] = rank[k:] if k < n else 0
        order = np.lexsort((second, rank))
        step = (rank[order][1:] != rank[order][:-1]) | (second[order][1:] != second[order][:-1])
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(step)
        rank, k = new, 2 * k
        if k >= n or rank.max(initial=0) == n - 1:
            return np.argsort(rank, kind="stable")


def suffix_array(text: np.ndarray, memory: int = 1 << 23, short: int = 512) -> np.ndarray:
    """Start positions of all suffixes of an array of non-negative integers, sorted; of less than `short` by doubling."""
    n = len(text)
    if n < short:
        return _small(text) if n else np.zeros(0, np.int64)
    is_s = _types(text)
    position = np.int32 if n < 1 << 31 else np.int64
    lms = (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(position)
    if len(lms) > 1:
        _, _, _, sv = _sorted_from(text, is_s, lms, memory)
        mark = np.zeros(n, bool)
        mark[lms] = True
        by_order = sv[::-1][mark[sv[::-1]]]
        names = _names(text, lms, by_order)
        if names.max() + 1 < len(lms):
            lms = lms[suffix_array(names, memory, SHORT)]
        else:
            lms = by_order
    lk, lv, sk, sv = _sorted_from(text, is_s, lms, memory)
    keys, values = np.concatenate([lk, sk[::-1]]), np.concatenate([lv, sv[::-1]])
    return values[np.argsort(keys, kind="stable")]

"""Sorting the suffixes of one shard by induction, with common-prefix lengths.

A suffix is S if it is smaller than the next one, L if larger; an S after an L is
a sample (LMS).  Sorted samples determine all L suffixes in one ascending sweep
over the buckets of first symbols, and the L suffixes all S ones in a descending
sweep: a suffix taken from the front of the order puts the one before it, if it
has the sweep's type, at the end of its symbol's queue.  The length that two
neighbours of a queue have in common is one more than the least such length
between the suffixes that put them there, so it is carried along.

The samples are sorted by the same sweeps over their substrings, which gives them
names, and then as the string of these names; that string has as many symbols as
names, too many for queues, and is sorted by doubling ranks.

Queues take (suffix, common length) tuples a whole batch at a time.  They are
kept in memory up to a limit and go to files of the task's own beyond it, one a
symbol, which are read when the sweep comes to that symbol.  What a sweep has
taken of a symbol is kept in a file as well if the shard is large.  So besides
the text, its samples and one symbol's suffixes a bounded number of tuples is
held, however large the shard.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

MEMORY = 128 << 20  # bytes of queued tuples held at a time
_TUPLE = np.dtype([("at", np.int64), ("common", np.int32)])


class Queues:
    """A first-in, first-out queue of tuples for each symbol, on disk beyond a limit."""

    def __init__(self, symbols: int, memory: int = MEMORY):
        self.parts: list[list[np.ndarray]] = [[] for _ in range(symbols)]
        self.memory, self.held, self.folder = memory, 0, None

    def put(self, symbol: int, tuples: np.ndarray) -> None:
        self.parts[symbol].append(tuples)
        self.held += tuples.nbytes
        if self.held > self.memory:
            self._spill()

    def _file(self, symbol: int) -> str:
        return os.path.join(self.folder.name, str(symbol))

    def _spill(self) -> None:
        if self.folder is None:
            self.folder = tempfile.TemporaryDirectory(prefix="queues-")
        for symbol, parts in enumerate(self.parts):
            if parts:
                with open(self._file(symbol), "ab") as out:
                    for part in parts:
                        out.write(part.tobytes())
                parts.clear()
        self.held = 0

    def take(self, symbol: int) -> Iterator[np.ndarray]:
        """The queue's batches in order; what is put meanwhile comes in later batches."""
        while True:
            if self.folder is not None and os.path.exists(self._file(symbol)):
                os.rename(self._file(symbol), self._file(symbol) + "-taken")
                held, self.parts[symbol] = self.parts[symbol], []
                self.held -= sum(p.nbytes for p in held)
                with open(self._file(symbol) + "-taken", "rb") as file:
                    while part := file.read(max(1, self.memory // 4 // _TUPLE.itemsize) * _TUPLE.itemsize):
                        yield np.frombuffer(part, _TUPLE)
                yield from held
            elif self.parts[symbol]:
                held, self.parts[symbol] = self.parts[symbol], []
                self.held -= sum(p.nbytes for p in held)
                yield np.concatenate(held)
            else:
                return

    def close(self) -> None:
        if self.folder is not None:
            self.folder.cleanup()


def _tuples(at: np.ndarray, common: np.ndarray | int) -> np.ndarray:
    out = np.empty(len(at), _TUPLE)
    out["at"], out["common"] = at, common
    return out


class Sorter:
    """Suffixes of ``text``, symbols below ``symbols``; the end counts as smaller than any symbol."""

    def __init__(self, text: np.ndarray, symbols: int, memory: int = MEMORY):
        self.text, self.symbols, self.memory = text, symbols, memory
        n = len(text)
        large = 2 * n * _TUPLE.itemsize > memory
        self.folder = tempfile.TemporaryDirectory(prefix="sorted-") if large else None
        self.files = 0
        # S where the next differing symbol is larger; the last suffix is L.
        differs = np.append(text[:-1] != text[1:], True)
        next_change = np.where(differs, np.arange(n), n)
        next_change = np.minimum.accumulate(next_change[::-1])[::-1]
        rises = np.append(text[:-1] < text[1:], False)
        self.is_s = rises[next_change]
        self.samples = np.flatnonzero(self.is_s & ~np.concatenate(([True], self.is_s[:-1])))

        # Four symbols from each place on in one number, and a hash of 32.
        wide = np.concatenate((text, np.full(32, symbols, text.dtype))).astype(np.uint64)
        self.four = wide[:-3] | wide[1:-2] << np.uint64(16) | wide[2:-1] << np.uint64(32) | wide[3:] << np.uint64(48)
        block, size = self.four, 4
        while size < 32:
            block = (block[:-size] * np.uint64(0x9E3779B97F4A7C15) ^ block[:-size] >> np.uint64(29)) + block[size:]
            size *= 2
        self.block = block

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols the (different) suffixes at a and b have in common.

        Blocks of 32 symbols are compared by 64-bit hashes, the rest symbol by symbol.
        """
        out, n = np.zeros(len(a), np.int64), len(self.text)
        for values, size in ((self.block, 32), (self.four, 4)):
            live = np.arange(len(a))
            while len(live):
                x, y = a[live] + out[live], b[live] + out[live]
                live = live[(np.maximum(x, y) + size <= n) & (values[np.minimum(x, n)] == values[np.minimum(y, n)])]
                out[live] += size
        differ = self.four[a + out] ^ self.four[b + out]  # beyond the end stand symbols of no text
        left = n - np.maximum(a, b) - out
        return (out + np.minimum(left, (differ & 0xFFFF == 0).astype(np.int64) * (1 + (differ & 0xFFFFFFFF == 0) * (1 + (differ & 0xFFFFFFFFFFFF == 0))))).astype(np.int32)

    def _kept(self, parts: list[np.ndarray]) -> np.ndarray:
        """The parts as one array, mapped from a file if the shard is large."""
        if self.folder is None:
            return np.concatenate(parts)
        self.files += 1
        path = os.path.join(self.folder.name, str(self.files))
        with open(path, "wb") as out:
            for part in parts:
                out.write(part.tobytes())
        return np.memmap(path, _TUPLE, "r")

    def _sweep(self, starts: list[tuple[np.ndarray, np.ndarray]], up: bool, with_common: bool) -> list[np.ndarray]:
        """One sweep: per symbol, the tuples of the sweep's type in the order taken.

        ``starts``: per symbol, the already sorted suffixes that are taken after the queue's (in the sweep's direction).
        """
        text, queues = self.text, Queues(self.symbols, self.memory)
        since = np.zeros(self.symbols, np.int32)  # least common length of what was taken since the last put
        done: list[np.ndarray] = [np.empty(0, _TUPLE)] * self.symbols

        def put(batch: np.ndarray) -> None:
            before = batch["at"] - 1
            ok = np.flatnonzero((before >= 0) & (self.is_s[before] != up))
            # An L suffix is put by a smaller one, an S suffix by a larger one, or by its equal in the same bucket.
            if with_common and len(batch):
                lengths = batch["common"]
                everything = lengths.min()
            if not len(ok):
                if with_common and len(batch):
                    np.minimum(since, everything, out=since)
                return
            kinds = text[before[ok]]
            by = np.argsort(kinds, kind="stable")
            edges = np.flatnonzero(np.diff(kinds[by])) + 1
            groups = np.split(ok[by], edges)
            if with_common:
                later = np.minimum(since, everything)
            for group in groups:
                symbol = int(text[before[group[0]]])
                common: np.ndarray | int = 0
                if with_common:
                    cuts = np.concatenate(([0], group + 1))
                    last = cuts[-1] < len(lengths)
                    least = np.minimum.reduceat(lengths, cuts if last else cuts[:-1])
                    common = least[: len(group)].copy()
                    common[0] = min(common[0], since[symbol])
                    common += 1
                    later[symbol] = least[-1] if last else np.iinfo(np.int32).max
                queues.put(symbol, _tuples(before[group], common))
            if with_common:
                since[:] = later

        def seed() -> None:
            # The last suffix is L and is put by the end, before anything else.
            if up and len(text):
                queues.put(int(text[-1]), _tuples(np.array([len(text) - 1]), 0))

        try:
            seed()
            for symbol in range(self.symbols) if up else range(self.symbols - 1, -1, -1):
                since[:] = 0  # nothing in common with another symbol's suffixes
                fresh, taken = True, []
                for batch in queues.take(symbol):
                    if fresh and len(batch):
                        batch = batch.copy()
                        batch["common"][0], fresh = 0, False
                    taken.append(batch)
                    put(batch)
                if taken:
                    done[symbol] = self._kept(taken)
                at, common = starts[symbol]
                if len(at):
                    batch = _tuples(at, common)
                    if with_common:
                        last = done[symbol]["at"][-1:] if len(done[symbol]) else at[:0]
                        batch["common"][0] = self.common(last, at[:1])[0] if len(last) else 0
                    put(batch)
        finally:
            queues.close()
        return done

    def _by_symbol(self, at: np.ndarray, common: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        edges = np.searchsorted(self.text[at], np.arange(self.symbols + 1))
        return [(at[i:j], common[i:j]) for i, j in zip(edges, edges[1:], strict=False)]

    def _induced(self, samples: np.ndarray, common: np.ndarray, with_common: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All suffixes from sorted samples, symbol by symbol; common: with the suffix before."""
        larger = self._sweep(self._by_symbol(samples, common), True, with_common)
        # Downwards the length belongs to the pair of a suffix and the larger one, taken before it.
        down = [(part["at"][::-1], _shifted(part["common"][::-1])) for part in larger]
        smaller = self._sweep(down, False, with_common)
        for l_part, s_part in zip(larger, smaller, strict=True):
            s_at, s_common = s_part["at"][::-1], _shifted(s_part["common"][::-1])
            if with_common and len(s_at) and len(l_part):
                s_common[0] = self.common(l_part["at"][-1:], s_at[:1])[0]
            yield np.concatenate((l_part["at"], s_at)), np.concatenate((l_part["common"], s_common))

    def _sorted_samples(self) -> np.ndarray:
        samples = self.samples
        if len(samples) < 2:
            return samples
        # Sweeps over samples sorted by their first symbol only leave their substrings sorted.
        first = samples[np.argsort(self.text[samples], kind="stable")]
        is_sample = np.zeros(len(self.text), bool)
        is_sample[samples] = True
        order = np.concatenate([at[is_sample[at]] for at, _ in self._induced(first, np.zeros(len(first), np.int32), False)])
        place = np.searchsorted(samples, order)
        size = np.diff(np.append(samples, len(self.text)))[place] + 1  # a substring ends with the next sample's first symbol
        same = size[1:] == size[:-1]
        pairs = np.flatnonzero(same)
        same[pairs] = self.common(order[pairs], order[pairs + 1]) >= size[pairs]
        names = np.empty(len(samples), np.int64)
        names[place] = np.concatenate(([0], np.cumsum(~same)))
        return samples[_by_doubling(names)]

    def sort(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each symbol, (suffixes in order, what each has in common with the one before)."""
        if not len(self.text):
            return
        samples = self._sorted_samples()
        common = np.zeros(len(samples), np.int32)
        common[1:] = self.common(samples[:-1], samples[1:])
        yield from self._induced(samples, common, True)
        if self.folder is not None:
            self.folder.cleanup()


def _shifted(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths), np.int32)
    out[1:] = lengths[:-1]
    return out


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """The suffix array of a string of names."""
    rank, n, k = names.astype(np.int64), len(names), 1
    while True:
        after = np.full(n, 0, np.int64)
        if k < n:
            after[:-k] = rank[k:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key)
        fresh = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        k *= 2

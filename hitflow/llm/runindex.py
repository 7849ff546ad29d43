"""A run-length index of many short texts: run-compressed Burrows-Wheeler transform with sampled run ends.

Texts end in a sign of their own below all bytes, those of earlier texts first. Only what a run needs is kept of the
transform: where it starts, its byte, where its first place maps to, the text places of its first and last suffix, and the
runs of the same byte before and behind. Repetitive texts have few runs.

``repeated`` streams all texts from their ends to their starts at once, one byte a step, and keeps for each the matching
statistics against everything else in the index: how long the neighbours of its suffix in suffix order match it. Inside a
run the neighbours move along with the text and the match grows by one; only at a run's edge a neighbour changes, to the
sampled end of the next run of that byte, and is compared byte by byte.
"""

from __future__ import annotations

import numpy as np


class RunIndex:
    """Index of ``texts``; memory is some forty numbers for each byte while it is built."""

    def __init__(self, texts: list[bytes]):
        lengths = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
        n = self.size = len(data)
        symbols = data.astype(np.int64) + 1
        symbols[self.ends] = 0
        # Place of the end of the text that a place belongs to.
        self.end_of = np.repeat(self.ends, lengths + 1)
        suffixes = self._sort(symbols)
        # The place before the first one of a text is the end of the text before it, in a circle.
        before = symbols[suffixes - 1]
        self._runs(before, suffixes)
        padded = np.concatenate((data, np.zeros(8, np.uint8)))
        self.eights = np.lib.stride_tricks.sliding_window_view(padded, 8)[: n + 1].copy().view(np.uint64).ravel()

    def _sort(self, symbols: np.ndarray) -> np.ndarray:
        """Suffix array: names of seven symbols, then of twice as many, until the longest text is covered."""
        n, place = self.size, np.arange(self.size)
        left = self.end_of - place
        key = symbols.copy()
        for ahead in range(1, 7):
            key <<= 9
            here = max(n - ahead, 0)
            key[:here] |= np.where(left[:here] >= ahead, symbols[ahead:], 0)
        depth, longest = 7, int(left.max())
        while True:
            # The last sort is stable: equal rests of texts are in the order of the texts.
            last = depth > longest
            order = np.argsort(key, kind="stable" if last else None)
            if last:
                return order
            ordered = key[order]
            name = np.empty(n, np.int64)
            name[order] = np.cumsum(np.concatenate(([1], ordered[1:] != ordered[:-1])))
            key = name * (n + 1)
            here = max(n - depth, 0)
            key[:here] += np.where(left[:here] >= depth, name[depth:], 0)
            depth *= 2

    def _runs(self, before: np.ndarray, suffixes: np.ndarray) -> None:
        head = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
        tail = np.append(head[1:], len(before)) - 1
        byte = before[head]
        by_byte = np.argsort(byte, kind="stable")
        sizes = (tail - head + 1)[by_byte]
        # Runs of one byte after another keep the order of their suffixes: places are the smaller bytes, then earlier runs.
        self.head, self.tail = head, tail
        self.maps_to = np.empty(len(head), np.int64)
        self.maps_to[by_byte] = np.cumsum(sizes) - sizes
        same = byte[by_byte][1:] == byte[by_byte][:-1]
        self.run_before, self.run_behind = np.full(len(head), -1), np.full(len(head), -1)
        self.run_before[by_byte[1:][same]] = by_byte[:-1][same]
        self.run_behind[by_byte[:-1][same]] = by_byte[1:][same]
        self.first_place, self.last_place = suffixes[head], suffixes[tail]

    def common(self, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
        """Length, up to ``most``, that the texts at places ``x`` and ``y`` have in common."""
        steps = np.arange(0, most, 8)
        out = np.empty(len(x), np.int64)
        limit = np.minimum(np.minimum(self.end_of[x] - x, self.end_of[y] - y), most)
        for start in range(0, len(x), 8192):
            a, b = x[start : start + 8192, None] + steps, y[start : start + 8192, None] + steps
            np.minimum(a, self.size, out=a)
            np.minimum(b, self.size, out=b)
            differ = self.eights[a] ^ self.eights[b]
            unequal = differ != 0
            at = unequal.argmax(axis=1)
            word = differ[np.arange(len(at)), at]
            lowest = word & (~word + np.uint64(1))
            equal = np.where(word == 0, most, at * 8 + np.log2(np.maximum(lowest, 1).astype(np.float64)).astype(np.int64) // 8)
            out[start : start + 8192] = equal
        return np.minimum(out, limit)

    def repeated(self, length: int) -> np.ndarray:
        """Whether the ``length`` bytes at a place stand at another place as well, for all places in text order."""
        found = np.zeros(self.size, bool)
        texts = np.arange(len(self.ends))
        rank, place = texts.copy(), self.ends.copy()
        above, below = np.zeros((2, len(texts)), np.int64)
        above_at, below_at = self.ends[texts - 1], self.ends[(texts + 1) % len(texts)]
        while True:
            going = place > self.starts[texts]
            if not going.all():
                texts, rank, place = texts[going], rank[going], place[going]
                above, below, above_at, below_at = above[going], below[going], above_at[going], below_at[going]
            if not len(texts):
                return found
            run = np.searchsorted(self.head, rank, "right") - 1
            above, above_at = self._neighbour(rank == self.head[run], self.run_before[run], self.last_place, above, above_at, place, length)
            below, below_at = self._neighbour(rank == self.tail[run], self.run_behind[run], self.first_place, below, below_at, place, length)
            rank = self.maps_to[run] + rank - self.head[run]
            place = place - 1
            found[place] = np.maximum(above, below) >= length

    def _neighbour(self, edge, run, sampled, match, at, place, length):
        match, at = match + 1, at - 1
        lost = np.flatnonzero(edge & (run < 0))
        match[lost], at[lost] = 0, 0
        jump = np.flatnonzero(edge & (run >= 0))
        if len(jump):
            other = sampled[run[jump]]
            match[jump] = 1 + self.common(other, place[jump], length)
            at[jump] = other - 1
        return match, at

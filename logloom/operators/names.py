"""Longest contained names of many texts: every place is looked up by a rolling hash, so work grows with the texts, not with texts times names."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np

#: Characters that are looked up at once.
PLACES = 1 << 16
#: Odd, so that its powers have inverses modulo 2^64.
BASE = 0x9E3779B97F4A7C15
#: Places of a table by a hash's first bits, as a power of two: between these, and eight for a name.
LEAST_BITS, MOST_BITS = 12, 24


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def _lookup(windows: np.ndarray, bits: int, begin: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose hash is among the sorted ``hashes``, and where its first stands."""
    low = begin[windows >> np.uint64(64 - bits)]
    at = np.flatnonzero(low >= 0)
    low = low[at]
    ats, lows = [], []
    while len(at):  # as often as hashes share their first bits
        found, there = windows[at], hashes[low]
        hit = there == found
        ats.append(at[hit])
        lows.append(low[hit])
        more = (there < found) & (low + 1 < len(hashes))
        at, low = at[more], low[more] + 1
        same = hashes[low] >> np.uint64(64 - bits) == windows[at] >> np.uint64(64 - bits)
        at, low = at[same], low[same]
    if not ats:
        return at, low
    at, low = np.concatenate(ats), np.concatenate(lows)
    order = np.argsort(at, kind="stable")
    return at[order], low[order]


class Longest:
    """Finds the longest of ``names`` in texts, ties to the first by code point; hashes propose and a comparison of characters decides."""

    def __init__(self, names: Iterable[str]) -> None:
        self.names: list[str] = sorted(set(names), key=lambda n: (-len(n), n))  # a lower number is a better name
        self.empty = bool(self.names) and self.names[-1] == ""
        sizes = np.array([len(n) for n in self.names if n], dtype=np.int64)
        self.longest = int(sizes[0]) if len(sizes) else 0
        power = _powers(BASE, max(1, self.longest))
        self.powers = self.inverses = _powers(1, 1)
        self.tables: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []
        ends = np.append(np.flatnonzero(sizes[1:] != sizes[:-1]) + 1, len(sizes)) if len(sizes) else []
        a = 0
        for b in ends:
            size = int(sizes[a])
            step = max(1, PLACES // size)
            with np.errstate(over="ignore"):
                hashes = np.concatenate([(_codes("".join(self.names[i : min(i + step, b)])).reshape(-1, size) * power[:size]).sum(axis=1, dtype=np.uint64) for i in range(a, b, step)])
            order = np.argsort(hashes, kind="stable")
            bits = int(np.clip(np.ceil(np.log2(8 * (b - a))), LEAST_BITS, MOST_BITS))
            hashes = hashes[order]
            begin = np.full(1 << bits, -1, dtype=np.int32)  # the first of the sorted hashes with these bits
            begin[(hashes >> np.uint64(64 - bits))[::-1]] = np.arange(len(hashes))[::-1]
            self.tables.append((size, bits, begin, hashes, order + a))
            a = int(b)

    def __call__(self, texts: Sequence[str | None]) -> list[str | None]:
        best = np.full(len(texts), len(self.names), dtype=np.int64)
        held: list[tuple[int, str]] = []
        n, step = 0, max(PLACES, self.longest)
        for row, text in enumerate(texts):
            # a long text is cut to pieces that share all but one of the longest name's characters
            for at in range(0, len(text or ""), step):
                piece = text[at : at + step + max(0, self.longest - 1)]
                if n + len(piece) > PLACES:
                    self._search(held, best)
                    held, n = [], 0
                held.append((row, piece))
                n += len(piece)
        self._search(held, best)
        none = "" if self.empty else None
        return [None if t is None else self.names[b] if b < len(self.names) else none for t, b in zip(texts, best.tolist(), strict=True)]

    def _search(self, pieces: list[tuple[int, str]], best: np.ndarray) -> None:
        known = -1
        for size, bits, begin, hashes, ranks in self.tables:
            pieces = [(row, p) for row, p in pieces if best[row] == len(self.names) or len(self.names[best[row]]) <= size]
            if not pieces:
                return
            if known != len(pieces):
                known = len(pieces)
                starts = np.cumsum([0] + [len(p) for _, p in pieces])
                codes = _codes("".join(p for _, p in pieces))
                if len(self.powers) < len(codes):
                    self.powers, self.inverses = _powers(BASE, len(codes)), _powers(pow(BASE, -1, 1 << 64), len(codes))
                sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(codes * self.powers[: len(codes)], dtype=np.uint64)])
            if len(codes) < size:
                continue  # the next names are shorter
            windows = (sums[size:] - sums[:-size]) * self.inverses[: len(codes) - size + 1]
            at, low = _lookup(windows, bits, begin, hashes)
            if not len(at):
                continue
            of = np.searchsorted(starts, at, side="right") - 1  # a place that runs into the next piece is refused by the comparison
            firsts = np.append(0, np.flatnonzero(of[1:] != of[:-1]) + 1)
            for a, b in zip(firsts.tolist(), np.append(firsts[1:], len(of)).tolist(), strict=True):
                row, piece = pieces[of[a]]
                best[row] = min(best[row], self._first(piece, hashes, ranks, low[a:b]))

    def _first(self, piece: str, hashes: np.ndarray, ranks: np.ndarray, low: np.ndarray) -> int:
        """The first name among those proposed that stands in the piece; ``low`` is the first of each hash."""
        rank = int(ranks[low].min())  # of a hash, the first name comes first
        if self.names[rank] in piece:
            return rank
        high = np.searchsorted(hashes, hashes[low], side="right")
        return next((r for r in sorted({int(r) for a, b in set(zip(low.tolist(), high.tolist(), strict=True)) for r in ranks[a:b]}) if self.names[r] in piece), len(self.names))

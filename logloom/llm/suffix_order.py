"""Blockwise suffix order with a difference cover, for the bytes of one block.

A difference cover of period ``PERIOD`` is a set of residues such that any two places, moved on by some common step
below the period, both fall on it. Suffixes are sorted by their first ``PERIOD`` bytes; those that tie are told apart by
the ranks of the cover's places, which are computed once for the block, so ties of any length cost one look-up and no
more memory than the ranks.
"""

from __future__ import annotations

import functools

import numpy as np

PERIOD = 32
WORDS = PERIOD // 8


@functools.lru_cache(maxsize=8)
def cover(period: int = PERIOD) -> tuple[int, ...]:
    """A small difference cover, greedily: always the residue that adds most new differences."""
    chosen, seen = [0], {0}
    while len(seen) < period:
        best = max(range(period), key=lambda r: (len(({(r - c) % period for c in chosen} | {(c - r) % period for c in chosen}) - seen), -r))
        seen |= {(best - c) % period for c in chosen} | {(c - best) % period for c in chosen}
        chosen.append(best)
    return tuple(sorted(chosen))


@functools.lru_cache(maxsize=8)
def steps(period: int = PERIOD) -> np.ndarray:
    """``steps()[a, b]``: the least step that takes residues a and b onto the cover together."""
    held = np.isin(np.arange(2 * period) % period, cover(period))
    return np.array([[next(d for d in range(period) if held[a + d] and held[b + d]) for b in range(period)] for a in range(period)])


def word_at(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number in byte order; ``text`` is padded."""
    return np.lib.stride_tricks.sliding_window_view(text, 8)[places].copy().view(">u8").ravel()


def ranks(text: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Dense ranks of the ``depth`` bytes from each place on."""
    words = [word_at(text, places + 8 * k) for k in range(-(-depth // 8))]
    order = np.lexsort(words[::-1])
    new = np.zeros(len(places), dtype=bool)
    for w in words:
        new[1:] |= w[order][1:] != w[order][:-1]
    out = np.empty(len(places), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def suffix_order(text: np.ndarray, starts: np.ndarray, depth: int, bucket: np.ndarray) -> np.ndarray:
    """Order of ``starts`` by bucket and then by the bytes from there on, so that equal prefixes of ``depth`` stand together.

    ``text`` is padded by ``depth + 2 * PERIOD`` bytes. Where the suffixes of a bucket share one residue, as the caller
    lays them out, ties need one rank each; a tie of mixed residues is settled pair by pair with its common step.
    """
    residue = starts % PERIOD
    onto = steps()[residue, residue]
    sample, back = np.unique(starts + onto, return_inverse=True)
    rank = ranks(text, sample, depth)[back]
    words = [word_at(text, starts + 8 * k) for k in range(WORDS)]
    order = np.lexsort((rank, residue, *words[::-1], bucket))
    tied = np.ones(max(len(order) - 1, 0), dtype=bool)
    for w in (bucket, *words):
        tied &= w[order][1:] == w[order][:-1]
    mixed = tied & (residue[order][1:] != residue[order][:-1])
    if mixed.any():
        ends = np.append(np.flatnonzero(~tied) + 1, len(order))
        for end in np.unique(ends[np.searchsorted(ends, np.flatnonzero(mixed), side="right")]):
            begin = int(ends[np.searchsorted(ends, end) - 1]) if end != ends[0] else 0
            part = order[begin:end]
            after = {}

            def key(i: int, step: int) -> bytes:
                at = int(starts[i]) + step
                if at not in after:
                    after[at] = text[at : at + depth].tobytes()
                return after[at]

            def compare(i: int, j: int) -> int:
                step = int(steps()[residue[i], residue[j]])
                a, b = key(i, step), key(j, step)
                return (a > b) - (a < b)

            order[begin:end] = sorted(part.tolist(), key=functools.cmp_to_key(compare))
    return order


def equal_neighbours(text: np.ndarray, starts: np.ndarray, order: np.ndarray, depth: int, bucket: np.ndarray) -> np.ndarray:
    """For each place in the order but the first: whether its ``depth`` bytes and bucket equal those of the one before."""
    same = bucket[order][1:] == bucket[order][:-1]
    for k in [*range(0, depth - 7, 8), depth - 8]:
        at = np.flatnonzero(same)
        same[at] = word_at(text, starts[order[at + 1]] + k) == word_at(text, starts[order[at]] + k)
    return same

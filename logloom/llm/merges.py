"""Vocabulary files of byte-pair encoders, read once per Python worker."""

from __future__ import annotations

import functools
import json

import numpy as np

#: What a pair that is never merged looks up: larger than any rank.
NEVER = np.int64(1 << 60)
BITS = 20
#: The rank of a pair that is never merged, where ranks stand alone.
LAST = np.int32(2**31 - 1)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves; the others take code points from 256 on, in order.
    """
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Merges:
    """ids by symbol, and for each pair of adjacent ids its rank and the id that replaces it."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.specials: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        vocab = self.vocab
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            self.pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.byte_ids = [vocab[s] for s in byte_symbols()]
        self.table = PairTable(self.pairs)


class PairTable:
    """Adjacent ids to ``rank << BITS | new id`` for whole arrays at once: open addressing over two flat arrays."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]) -> None:
        self.shift = np.uint64(64 - max(4, (4 * len(pairs)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys = np.full(size + 64, -1, dtype=np.int64)
        self.values = np.full(size + 64, NEVER, dtype=np.int64)
        todo = np.array([(a << BITS) | b for a, b in pairs], dtype=np.int64)
        values = np.array([(r << BITS) | n for r, n in pairs.values()], dtype=np.int64)
        #: the id that each rank's pair becomes
        self.made = np.zeros(int((values >> BITS).max(initial=-1)) + 1, dtype=np.int32)
        self.made[values >> BITS] = values & ((1 << BITS) - 1)
        slot = self.slot(todo)
        while len(todo):
            free = self.keys[slot] < 0
            _, first = np.unique(np.where(free, slot, -1), return_index=True)
            first = first[free[first]]
            self.keys[slot[first]], self.values[slot[first]] = todo[first], values[first]
            rest = np.ones(len(todo), dtype=bool)
            rest[first] = False
            todo, values, slot = todo[rest], values[rest], slot[rest]
            slot = np.where(self.keys[slot] >= 0, slot + 1, slot)
            if len(slot) and slot.max() >= len(self.keys):
                raise ValueError("pair table is too full")

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids below zero stand for no symbol and are in no pair."""
        keys = (left << BITS) | right
        slot = self.slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], NEVER)
        more = np.flatnonzero((found >= 0) & (found != keys))
        slot = slot[more]
        while len(more):
            slot = slot + 1
            found, wanted = self.keys[slot], keys[more]
            same = found == wanted
            out[more[same]] = self.values[slot[same]]
            going = (found >= 0) & ~same
            more, slot = more[going], slot[going]
        out[(left < 0) | (right < 0)] = NEVER
        return out

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of 32-bit ids, ``LAST`` where a pair is never merged."""
        found = self.look_up(left.astype(np.int64), right) >> BITS
        return np.minimum(found, LAST).astype(np.int32)


@functools.lru_cache(maxsize=4)
def load(path: str) -> Merges:
    return Merges(path)

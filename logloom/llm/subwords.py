"""Hashed character n-grams of words, for whole batches of words in numpy."""

from __future__ import annotations

import numpy as np

#: ASCII characters that are neither letters nor digits part words; bytes of other characters are kept.
PART = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words of a text, as UTF-8."""
    return text.lower().encode().translate(PART).split() if text else []


def hashed(words: list[bytes], sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Owner (index of the word) and bucket of every byte n-gram of ``<word>``, and of the word as a whole."""
    marked = [b"<" + w + b">" for w in words]
    lengths = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    flat = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), lengths)
    ends = np.repeat(np.cumsum(lengths), lengths)
    place = np.arange(len(flat))
    owners, found = [], []
    h = np.zeros(len(flat), dtype=np.uint64)
    base = np.uint64(1_000_003)
    for n in range(1, max(sizes) + 1):
        h = h[: len(flat) - n + 1] * base + flat[n - 1 :] + np.uint64(1)
        if n in sizes:
            inside = place[: len(h)] + n <= ends[: len(h)]
            owners.append(owner[: len(h)][inside])
            found.append(mixed(h[inside] + np.uint64(n << 40), buckets))
    if len(words):
        powers = np.cumprod(np.full(int(lengths.max()), base, dtype=np.uint64))
        starts = np.cumsum(lengths) - lengths
        whole = np.add.reduceat((flat + np.uint64(1)) * powers[place - starts[owner]], starts)
        owners.append(np.arange(len(words)))
        found.append(mixed(whole, buckets))
    return (np.concatenate(owners), np.concatenate(found)) if owners else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def mixed(h: np.ndarray, buckets: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return ((h ^ (h >> np.uint64(33))) % np.uint64(buckets)).astype(np.int64)

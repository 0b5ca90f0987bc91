"""Token counts by rank-synchronous array merging.

The pre-tokens of a batch that have not been counted before are held as one ragged numpy array. In every round each
sequence finds its lowest-ranked adjacent pair, all sequences apply theirs at once, and sequences without a pair left
drop out; what survives is the count. A pair that overlaps itself (``aaa``) is applied from the left.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated rows give repeated rows; a null id stays
null; an empty table gives an empty table; other columns are ignored. Special strings inside a text count as one token
each, as the tokenizers library does by default.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from logloom.llm.bpe import SPACE
from logloom.llm.common import small_batches
from logloom.llm.merges import BITS, NEVER, Merges, byte_symbols, load

#: Chunks kept per Python worker before the cache starts anew.
CACHE = 400_000
#: Fixed value: the word pattern of the pre-tokeniser; it never spans white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^" + SPACE + r"\p{L}\p{N}]+"


class Counter:
    """Counts of the tokens of white-space separated chunks."""

    def __init__(self, path: str) -> None:
        m: Merges = load(path)
        self.specials = m.specials
        self.find = regex.compile(PATTERN).findall
        self.split = regex.compile("[" + SPACE + "]+").split
        self.special = regex.compile("|".join(map(regex.escape, m.specials))) if m.specials else None
        self.table = m.table
        symbols = byte_symbols()
        self.inner = np.array([m.vocab[s] for s in symbols], dtype=np.int64)
        self.last = np.array([m.vocab[s + m.suffix] for s in symbols], dtype=np.int64)
        self.known: dict[str, int] = {}

    def count_words(self, words: list[str]) -> np.ndarray:
        """Surviving symbols of each word; no word is empty."""
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        flat = np.frombuffer(b"".join(raw), dtype=np.uint8)
        ids = self.inner[flat]
        ends = np.cumsum(sizes) - 1
        ids[ends] = self.last[flat[ends]]
        seq = np.repeat(np.arange(len(raw)), sizes)
        counts = sizes.copy()
        while len(ids) > 1:
            value = np.append(self.table.look_up(ids[:-1], ids[1:]), NEVER)
            change = np.append(seq[1:] != seq[:-1], True)
            value[change] = NEVER
            starts = np.flatnonzero(np.r_[True, change[:-1]])
            low = np.repeat(np.minimum.reduceat(value, starts), np.diff(np.append(starts, len(seq))))
            place = np.flatnonzero((value == low) & (low < NEVER))
            if not len(place):
                break
            run = np.r_[True, np.diff(place) != 1]
            begin = place[run][np.cumsum(run) - 1]
            place = place[(place - begin) & 1 == 0]
            ids[place] = value[place] & ((1 << BITS) - 1)
            keep = low < NEVER  # finished sequences drop out
            keep[place + 1] = False
            counts -= np.bincount(seq[place], minlength=len(counts))
            ids, seq = ids[keep], seq[keep]
        return counts

    def learn(self, chunks: set[str]) -> None:
        """Count chunks that are not known yet."""
        if not chunks:
            return
        order, words, owners = list(chunks), [], []
        for k, chunk in enumerate(order):
            folded = unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
            for word in self.find(folded):
                words.append(word)
                owners.append(k)
        total = np.zeros(len(order), dtype=np.int64)
        if words:
            np.add.at(total, owners, self.count_words(words))
        self.known.update(zip(order, total.tolist(), strict=True))

    def chunks(self, text: str) -> tuple[list[str], int]:
        """White-space separated chunks, and the number of special strings beside them."""
        specials = 0
        if self.special is not None and "<|" in text:
            text, specials = self.special.subn(" ", text)
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [c for c in self.split(text) if c], specials
        return text.split(), specials

    def count(self, texts: list[str | None]) -> list[int]:
        out, known = [], self.known
        if len(known) >= CACHE:
            known.clear()
        cut = [self.chunks(t or "") for t in texts]
        self.learn({c for chunks, _ in cut for c in set(chunks) if c not in known})
        for chunks, specials in cut:
            out.append(sum(map(known.__getitem__, chunks)) + specials)
        return out


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens); narrow, no shuffle."""
    small_batches(docs.sparkSession, 128)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = c.count(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len((t or "").encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], ["id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean").withColumnRenamed("id", id_col)

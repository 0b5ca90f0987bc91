"""Byte-level BPE encoding and decoding by a contiguous rank array.

A word of the pre-tokeniser is held as a row of part ids and, beside it, the rank of every adjacent pair. The smallest
rank is found by a scan, the boundary there is deleted and the ranks of the two neighbours are looked up again; words of
like length take these steps side by side. Words longer than ``SHORT`` bytes use the same merges in the same order
through a heap, since repeated scans would be quadratic in their length.

Defined results: a null text counts as an empty one (0 tokens, the digest of no bytes); repeated rows give repeated
rows; a null id stays null; an empty table gives an empty table; other columns are ignored. Special strings inside a
text become their special id, as the tokenizers library does by default.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from logloom.llm.common import small_batches, tidy
from logloom.llm.merges import LAST, Merges, PairTable, byte_symbols, load

#: Words of at most this many bytes are merged by scans.
SHORT = 128
#: Widths of the arrays in which words are merged together, in bytes.
WIDTHS = (2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14, 16, 20, 24, 32, 48, 64, 96, SHORT)
#: Bytes of text that are encoded together; a longer text is encoded alone.
GROUP = 4 << 20
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Fixed value: the word pattern of the byte-level pre-tokeniser.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+|[" + SPACE + "]+(?![^" + SPACE + "])|[" + SPACE + "]+"


def merge_short(ids: np.ndarray, table: PairTable) -> np.ndarray:
    """The symbols that each row of ``ids`` (one word a row, -1 after its end) is merged to.

    Beside the parts stands the rank array of their adjacent pairs. In a round every row scans for its minimum, deletes
    that boundary, and looks up the ranks of the two pairs beside it again.
    """
    n, width = ids.shape
    out = np.full((n, width), -1, dtype=np.int32)
    rows = np.arange(n)
    ranks = np.full((n, width), LAST, dtype=np.int32)  # the last column stays empty
    ranks[:, :-1] = table.rank_of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(n, width - 1)
    while len(rows):
        at = ranks.argmin(axis=1)
        each = np.arange(len(rows))
        low = ranks[each, at]
        going = low < LAST
        if not going.all():
            out[rows[~going], : ids.shape[1]] = ids[~going]
            rows, ids, ranks, at, low = rows[going], ids[going], ranks[going], at[going], low[going]
            each = np.arange(len(rows))
        # every row loses one boundary, so the arrays become one column narrower
        kept = np.ones(ids.shape, dtype=bool)
        kept[each, at + 1] = False
        ids[each, at] = table.made[low]
        ids = ids[kept].reshape(len(rows), ids.shape[1] - 1)
        ranks = ranks[kept].reshape(len(rows), ids.shape[1])
        here, last = ids[each, at], at == ids.shape[1] - 1
        after = ids[each, np.where(last, at, at + 1)]
        ranks[each, at] = np.where(last, LAST, table.rank_of(here, after))
        left = np.flatnonzero(at > 0)
        ranks[left, at[left] - 1] = table.rank_of(ids[left, at[left] - 1], here[left])
    return out


def merge_long(ids: list[int], pairs: dict) -> list[int]:
    """The same merges for a long word: a heap of (rank, place) over a doubly linked list."""
    n = len(ids)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = [(found[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (found := pairs.get((ids[i], ids[i + 1])))]
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if ids[i] != left or j >= n or ids[j] != right:
            continue
        ids[i] = pairs[left, right][1]
        ids[j] = -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if found := pairs.get((ids[i], ids[k])):
                heapq.heappush(heap, (found[0], i, ids[i], ids[k]))
        if (h := before[i]) >= 0 and (found := pairs.get((ids[h], ids[i]))):
            heapq.heappush(heap, (found[0], h, ids[h], ids[i]))
    return [x for x in ids if x >= 0]


def gathered(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` one after another, and where each begins there (and the last one ends)."""
    ends = np.append(0, np.cumsum(size))
    return flat[np.arange(ends[-1]) + np.repeat(begin - ends[:-1], size)], ends


class Encoder:
    """Texts to packed little-endian 32-bit ids, and back."""

    def __init__(self, path: str) -> None:
        self.merges: Merges = load(path)
        self.find = regex.compile(PATTERN).findall
        specials = sorted(self.merges.specials, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        self.blank = frozenset(regex.findall("[" + SPACE + "]", "".join(map(chr, range(0x3001)))))
        back = {s: b for b, s in enumerate(byte_symbols())}
        top = max([*self.merges.vocab.values(), *self.merges.specials.values()]) + 1
        bytes_of = [b""] * top
        for token, i in self.merges.vocab.items():
            known = all(c in back for c in token)
            bytes_of[i] = bytes(back[c] for c in token) if known else token.encode()
        for token, i in self.merges.specials.items():
            bytes_of[i] = token.encode()
        self.vocabulary = pa.array(bytes_of, pa.large_binary())

    def merge(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after another, and where each word's begin; words of like length are merged together."""
        offsets = np.frombuffer(words.buffers()[1], dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        raw = np.frombuffer(words.buffers()[2] or b"\0", dtype=np.uint8)
        sizes = np.diff(offsets)
        order = np.argsort(sizes, kind="stable")
        byte_ids = np.array(self.merges.byte_ids, dtype=np.int32)
        out, many = [], []
        begin = 0
        for width in WIDTHS:
            end = int(np.searchsorted(sizes[order], width, side="right"))
            for start in range(begin, end, 16384):
                group = order[start : min(end, start + 16384)]
                held = sizes[group, None] > np.arange(width)
                ids = np.full(held.shape, -1, dtype=np.int32)
                ids[held] = byte_ids[raw[(offsets[group, None] + np.arange(width))[held]]]
                merged = merge_short(ids, self.merges.table)
                out.append(merged[merged >= 0])
                many.append((merged >= 0).sum(axis=1))
            begin = end
        for i in order[begin:].tolist():
            out.append(np.array(merge_long(byte_ids[raw[offsets[i] : offsets[i + 1]]].tolist(), self.merges.pairs), dtype=np.int32))
            many.append(np.array([len(out[-1])]))
        if not out:
            return np.zeros(0, dtype="<u4"), np.zeros(1, dtype=np.int64)
        count = np.concatenate(many)
        ends = np.cumsum(count)
        size, first = np.empty(len(order), dtype=np.int64), np.empty(len(order), dtype=np.int64)
        size[order], first[order] = count, ends - count
        return gathered(np.concatenate(out).astype("<u4"), first, size)

    def merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """As ``merge`` for words that may repeat."""
        coded = pa.array(words, pa.string()).dictionary_encode()
        flat, ends = self.merge(coded.dictionary)
        number = coded.indices.to_numpy()
        return gathered(flat, ends[number], np.diff(ends)[number])

    def encode(self, text: str | None) -> bytes:
        """The packed ids of one text."""
        if not text:
            return b""
        if self.special is None or "<|" not in text:
            return self.merged(self.find(text))[0].tobytes()
        specials = self.merges.specials
        return b"".join(struct.pack("<I", specials[p]) if p in specials else self.merged(self.find(p))[0].tobytes() for p in self.special.split(text) if p)

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's begin (and the last one's end).

        Arrow cuts the texts at spaces and numbers the distinct units. A space before a character that is none always
        begins a word, so a unit with the space before it is independent of its neighbours, and Python cuts each distinct
        unit to words once. A text with an empty unit, or one that begins with white space, is cut as a whole.
        """
        texts = pc.fill_null(texts, "")
        apart = np.asarray(pc.match_substring(texts, "<|")) if self.special is not None else np.zeros(len(texts), bool)
        cut = pc.split_pattern(pc.if_else(pa.array(apart), "", texts), " ")
        begins = cut.offsets.to_numpy().astype(np.int64)  # every text has a unit at least, if an empty one
        coded = cut.values.dictionary_encode()
        number = coded.indices.to_numpy().astype(np.int64)
        units = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        # the first unit of a text has no space before it
        leads, lead = np.unique(number[begins[:-1]], return_inverse=True)
        number[begins[:-1]] = len(units) + lead
        leads = [units[i] for i in leads.tolist()]
        odd = np.fromiter((not u or u[0] in self.blank for u in units), dtype=bool, count=len(units))
        whole = np.flatnonzero(np.add.reduceat(np.append(odd, np.zeros(len(leads), dtype=bool))[number].astype(np.int32), begins[:-1]) > 0) if len(texts) else begins[:0]
        plain = units if not odd.any() else [u for u, o in zip(units, odd.tolist(), strict=True) if not o]
        words = self.find(" " + " ".join(plain)) if plain else []
        first = np.fromiter((w[0] == " " for w in words), dtype=bool, count=len(words))
        lists = [self.find(t) for t in leads] + [self.find(texts[i].as_py()) for i in whole.tolist()]
        starts = np.full(len(units), -1)
        starts[~odd] = np.flatnonzero(first)
        # where the words of every unit, first unit and whole text begin and end
        later = np.append(len(words), len(words) + np.cumsum([len(x) for x in lists])).astype(np.int64)
        stops = np.full(len(units), -1)
        stops[~odd] = np.append(starts[~odd], len(words))[1:]
        flat, ends = self.merged([*words, *itertools.chain.from_iterable(lists)])
        begin, end = ends[np.append(starts, later[:-1])], ends[np.append(stops, later[1:])]
        if len(whole) or apart.any():
            owner = np.repeat(np.arange(len(texts)), np.diff(begins))
            alone = np.flatnonzero(apart)
            more = [np.frombuffer(self.encode(texts[i].as_py()), dtype="<u4") for i in alone.tolist()]
            after = len(flat) + np.append(0, np.cumsum([len(m) for m in more])).astype(np.int64)
            flat = np.concatenate([flat, *more])
            number[np.isin(owner, np.append(whole, alone))] = len(begin)
            number[begins[whole]] = len(units) + len(leads) + np.arange(len(whole))
            number[begins[alone]] = len(begin) + 1 + np.arange(len(alone))
            begin, end = np.concatenate([begin, [0], after[:-1]]), np.concatenate([end, [0], after[1:]])
        ids, ends = gathered(flat, begin[number], (end - begin)[number])
        return ids, ends[begins]

    def decode_batch(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """The texts of ids that stand one after another; ``ends`` as ``encode_batch`` gives them."""
        taken = self.vocabulary.take(pa.array(ids))
        raw = memoryview(taken.buffers()[2] or b"")
        at = np.frombuffer(taken.buffers()[1], dtype=np.int64)[ends].tolist() if len(ids) else [0] * len(ends)
        return [str(raw[i:j], "utf-8", "replace") for i, j in itertools.pairwise(at)]


def grouped(batches: Iterator[pa.RecordBatch], limit: int = GROUP) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches together, up to about ``limit`` bytes: the more texts, the more often a word is one of before."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if held and size + batch.nbytes > limit:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ids (binary: packed little-endian unsigned 32-bit ids), n_tokens; narrow, no shuffle."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in grouped(batches):
            ids, ends = enc.encode_batch(batch.column(1))
            raw = memoryview(ids).cast("B")
            each = [bytes(raw[i:j]) for i, j in itertools.pairwise((4 * ends).tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(each, pa.binary()), pa.array(np.diff(ends))], ["id", "ids", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(tidy(run), f"id {kind}, ids binary, n_tokens bigint").withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, text: what the packed ids stand for; null ids give an empty text."""
    small_batches(tokens.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            each = [x or b"" for x in batch.column(1).to_pylist()]
            ends = np.append(0, np.cumsum([len(x) // 4 for x in each])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(enc.decode_batch(np.frombuffer(b"".join(each), "<u4"), ends), pa.string())], ["id", "text"])

    kind = tokens.schema[id_col].dataType.simpleString()
    return tokens.select(tokens[id_col].alias("id"), tokens[ids_col].alias("ids")).mapInArrow(tidy(run), f"id {kind}, text string").withColumnRenamed("id", id_col)


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256: both directions in one pass, so ids and texts need not leave the worker."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in grouped(batches):
            ids, ends = enc.encode_batch(batch.column(1))
            raw = memoryview(ids).cast("B")
            sums = [hashlib.sha256(raw[i:j]).hexdigest() for i, j in itertools.pairwise((4 * ends).tolist())]
            decoded = [hashlib.sha256(t.encode()).hexdigest() for t in enc.decode_batch(ids, ends)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(ends)), pa.array(sums, pa.string()), pa.array(decoded, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(tidy(run), f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)

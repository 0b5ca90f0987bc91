"""Benchmark decontamination by a generalised suffix automaton of the test items.

Items are normalised to words and fed to one automaton per block of ``block_words`` item words, so a block's automaton
is bounded however many items there are. Documents are streamed through it: at each word the automaton holds the
longest match that ends there; wherever that reaches the window, or is a whole short item, the words are hit.

Defined results: null or wordless documents have no words and are clean; null or wordless items have no window;
repeated document rows give repeated rows, repeated item rows (same id) count once; a null item id takes no part; empty
tables give an empty table or clean documents; other columns are ignored. A document is scanned as a whole, however
long, in time and memory proportional to its words; overlapping and adjoining windows are one hit span.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import checkpointed, small_batches, written

#: Bytes to lower-cased words apart: separators are the ASCII characters that are neither letters nor digits.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(FOLD).split() if text else []


class Automaton:
    """Suffix automaton of several word sequences; ids of words are dense, -1 is any other word."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int) -> None:
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: items by the window they hold: full windows and whole shorter items
        self.holders: dict[tuple[int, ...], set[str]] = {}
        short: set[int] = set()
        for item, words in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
            if not ids:
                continue
            state = 0
            for i in ids:
                state = self.extend(state, i)
            width = min(window, len(ids))
            if width < window:
                short.add(width)
            for j in range(len(ids) - width + 1):
                self.holders.setdefault(tuple(ids[j : j + width]), set()).add(item)
        self.short = sorted(short)
        self.least = min([window, *short]) if self.holders else 0

    def extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            return q if length[q] == length[last] + 1 else self.clone(last, c, q)
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self.clone(p, c, q)
        return cur

    def clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = new
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str], int]:
        """Hit spans (begin, end) in order and apart, items with an occurring window, and the longest match."""
        nxt, link, length, window, short, least = self.next, self.link, self.length, self.window, self.short, self.least
        spans: list[list[int]] = []
        found: set[str] = set()
        longest = 0
        ids = list(map(self.vocab.get, words))
        state = size = 0
        for end, c in enumerate(ids, 1):
            if c is None:
                state = size = 0
                continue
            while state and c not in nxt[state]:
                state = link[state]
                size = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                size += 1
            if size < least:
                continue
            longest = max(longest, size)
            width = 0
            if size >= window:
                width = window
                found |= self.holders[tuple(ids[end - width : end])]
            for w in short:
                if w > size:
                    break
                if holders := self.holders.get(tuple(ids[end - w : end])):
                    found |= holders
                    width = max(width, w)
            if width:
                begin = end - width
                while spans and begin <= spans[-1][1]:
                    begin = min(begin, spans.pop()[0])
                spans.append([begin, end])
        return [(a, b) for a, b in spans], found, longest


def automata(items: DataFrame, window: int, block_words: int, id_col: str, text_col: str) -> DataFrame:
    """One row (block, automaton) per block of at most about ``block_words`` item words."""
    rows = items.select(items[id_col].cast("string").alias("item"), items[text_col].cast("string").alias("text")).dropna().dropDuplicates(["item", "text"])
    total = rows.agg(F.coalesce(F.sum(F.length("text") + 1), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-int(total) // (6 * block_words)))

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["item", "text"])
        return pd.DataFrame({"block": [key[0]], "automaton": [pickle.dumps(Automaton([(i, words_of(t)) for i, t in zip(pdf["item"], pdf["text"], strict=True)], window))]})

    return rows.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")).groupBy("block").applyInPandas(build, "block int, automaton binary")


def scan(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """id, text, n_words, spans (word begin and end), items (sorted ids) and longest match of every row of ``docs``."""
    return found_in(docs, items, id_col=id_col, **options).withColumnRenamed("id", id_col)


def found_in(docs: DataFrame, items: DataFrame, window: int = 10, block_words: int = 200_000, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """As ``scan``, with the ``keep`` columns under the names k0, k1 and so on, so that they clash with none.

    Automata are built on the executors; one block, of bounded size, is sent to all tasks at a time. With one block (any
    benchmark of up to ``block_words`` words) documents are read once and nothing is shuffled; with more, the findings
    of a block are stored beside the documents before the next block is sent, so a worker never holds two.
    """
    spark = docs.sparkSession
    small_batches(spark)
    kept = [docs[c].alias(f"k{i}") for i, c in enumerate(keep)]
    df = docs.select(docs[id_col].alias("id"), *kept, docs[text_col].cast("string").alias("text"), F.lit(None).cast("array<struct<begin:int,end:int>>").alias("spans"), F.lit(None).cast("array<string>").alias("items"), F.lit(0).alias("longest"), F.lit(0).cast("bigint").alias("n_words"))
    built = checkpointed(automata(items, window, block_words, item_id_col, item_text_col))
    blocks = [r["block"] for r in built.select("block").orderBy("block").collect()]
    schema = df.schema
    for k, block in enumerate(blocks or [None]):
        row = built.filter(F.col("block") == block).first() if block is not None else None
        shared = spark.sparkContext.broadcast(bytes(row["automaton"]) if row else pickle.dumps(Automaton([], window)))
        df = df.mapInArrow(_scanner(shared, len(keep)), schema)
        if k + 1 < len(blocks):
            df = written(df)
            shared.unpersist()
    return df


def _scanner(shared, n_keep: int):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton: Automaton = pickle.loads(shared.value)  # noqa: S301 - written by this job
        for batch in batches:
            t = 1 + n_keep
            texts, spans, items, longest = (batch.column(t + i).to_pylist() for i in range(4))
            counts = []
            for i, text in enumerate(texts):
                words = words_of(text)
                counts.append(len(words))
                got, found, most = automaton.scan(words) if automaton.least else ([], set(), 0)
                spans[i] = _joined([(s["begin"], s["end"]) for s in spans[i] or []], got)
                items[i] = sorted(found.union(items[i] or []))
                longest[i] = max(longest[i], most)
            kind = batch.schema
            made = [pa.array(spans, kind.field(t + 1).type), pa.array(items, kind.field(t + 2).type), pa.array(longest, kind.field(t + 3).type), pa.array(counts, kind.field(t + 4).type)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: t + 1], *made], schema=kind)

    return run


def _joined(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[list[int]] = []
    for begin, end in sorted(a + b):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [{"begin": x, "end": y} for x, y in out]


def contamination(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256, contaminated."""
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + (s["end"] - s["begin"]))
    return scanned.select(F.col(id_col), "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def cut(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of ``spans`` and what stands between them."""
    if not text or not spans:
        return text
    raw = text.encode()
    folded = raw.translate(FOLD)
    places, at = [], 0
    for word in folded.split():
        at = folded.index(word, at)
        places.append((at, at + len(word)))
        at += len(word)
    out, last = [], 0
    for begin, end in spans:
        out.append(raw[last : places[begin][0]])
        last = places[end - 1][1]
    return b"".join([*out, raw[last:]]).decode()


def remove(docs: DataFrame, items: DataFrame, window: int = 10, max_coverage: float = 0.5, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with hit spans cut from the texts; a document of which more than ``max_coverage`` of the words is hit goes."""
    names = docs.columns
    others = tuple(c for c in names if c not in (id_col, text_col))
    scanned = found_in(docs, items, window=window, id_col=id_col, text_col=text_col, keep=others, **options)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + (s["end"] - s["begin"]))
    left = scanned.filter((F.size("spans") == 0) | (hit <= max_coverage * F.col("n_words")))
    held = {id_col: "id", text_col: "text"} | {c: f"k{i}" for i, c in enumerate(others)}
    picked = left.select("spans", *[held[c] for c in names])
    at = 1 + names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [cut(t, [(s["begin"], s["end"]) for s in found]) if found else t for t, found in zip(batch.column(at).to_pylist(), batch.column(0).to_pylist(), strict=True)]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns[1:], names=batch.schema.names[1:])

    return picked.mapInArrow(run, picked.drop("spans").schema).toDF(*names)


def digest(items: list[str]) -> str:
    """The digest of item ids that ``contamination`` gives."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()

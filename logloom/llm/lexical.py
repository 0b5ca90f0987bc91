"""Ranked lexical search of many queries at once by multi-query common-subexpression evaluation.

All items of a block are evaluated together. Terms that the same items hold fold into one accumulator; then the pair of
accumulators that stands side by side in most items (most shared first) becomes a node of its own, again and again, as
long as two items share it. A document's partial sums are worked out once per node, children before parents, and an
item's score is the sum of the few nodes that it has left. All documents of a batch go through the graph together.

Corpus counts come from a first pass over all documents (sums leave a task, not documents), scores from a second one;
a task keeps the k best of each item and its bar rises from batch to batch. No text is shuffled.

Score of a document: the sum over an item's distinct terms of ``w * ((10**9 * tf) div (1000 * tf + 8 * m))``, where
``w = floor(1000 * ln((2 N + 2) / (2 df + 1)))`` and ``m = 10 + (90 n N) div L``. N counts documents with a term, L all
their terms, n those of the document; all but the logarithm is 64-bit integer.

Defined results: a null or empty text, item or document, has no term; such documents count in no statistic and such items
have no row. Rows of one item id (null is an id of its own) are one item with the terms of all. Repeated documents are
candidates each; equal scores go to the smaller id, a null id comes last. Scores of 0 are no hits. Empty tables give an
empty table; other columns are ignored. Texts are read whole, in memory proportional to one batch of documents.
"""

from __future__ import annotations

import heapq
import math
import pickle
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import ascii_lower, checkpointed, small_batches
from logloom.llm.decontaminate import words_of

#: Terms: everything but the ASCII characters that are neither letters nor digits.
TERM = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
#: Numbers in the accumulator matrix of one group of documents.
CELLS = 1 << 22
#: Stands for a null document id inside a task: after every other in order.
LAST = np.int64(2**63 - 1)


class Plan:
    """The query-sharing graph of the items of one block.

    ``vocab`` numbers the terms, ``atom`` gives the accumulator of each, ``left`` and ``right`` the children of the nodes
    that follow the atoms, ``levels`` the bounds of nodes that need no node of their own level, ``parts`` and ``starts``
    the nodes that each item sums.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]]) -> None:
        items = [(i, sorted(set(terms))) for i, terms in items if terms]
        self.items = [i for i, _ in items]
        self.vocab: dict[bytes, int] = {}
        holders: dict[bytes, list[int]] = defaultdict(list)
        for k, (_, terms) in enumerate(items):
            for t in terms:
                holders[t].append(k)
        atoms: dict[tuple[int, ...], int] = {}
        self.atom = np.zeros(len(holders), np.int64)
        for t in sorted(holders):
            self.atom[self.vocab.setdefault(t, len(self.vocab))] = atoms.setdefault(tuple(holders[t]), len(atoms))
        self.n_atoms = len(atoms)
        rows: list[list[int]] = [[] for _ in items]
        for held, a in sorted(atoms.items(), key=lambda x: (-len(x[0]), x[1])):
            for k in held:
                rows[k].append(a)
        pairs = self.mine(rows)
        self.order_nodes(pairs, rows)

    def mine(self, rows: list[list[int]]) -> list[tuple[int, int]]:
        """Replace shared neighbours by new nodes, in place; the children of the new nodes in order."""
        pairs: list[tuple[int, int]] = []
        where: dict[tuple[int, int], set[int]] = defaultdict(set)
        for k, row in enumerate(rows):
            for p in zip(row, row[1:], strict=False):
                where[p].add(k)
        heap = [(-len(ks), p) for p, ks in where.items() if len(ks) > 1]
        heapq.heapify(heap)
        while heap:
            n, pair = heapq.heappop(heap)
            shared = where[pair]
            if len(shared) < 2:
                continue
            if len(shared) != -n:
                heapq.heappush(heap, (-len(shared), pair))
                continue
            node = self.n_atoms + len(pairs)
            pairs.append(pair)
            touched: set[tuple[int, int]] = set()
            for k in sorted(shared):
                row = rows[k]
                at = next(i for i in range(len(row) - 1) if (row[i], row[i + 1]) == pair)
                if at:
                    where[row[at - 1], pair[0]].discard(k)
                    where[row[at - 1], node].add(k)
                    touched.add((row[at - 1], node))
                if at + 2 < len(row):
                    where[pair[1], row[at + 2]].discard(k)
                    where[node, row[at + 2]].add(k)
                    touched.add((node, row[at + 2]))
                row[at : at + 2] = [node]
            where[pair] = set()
            for p in touched:
                if len(where[p]) > 1:
                    heapq.heappush(heap, (-len(where[p]), p))
        return pairs

    def order_nodes(self, pairs: list[tuple[int, int]], rows: list[list[int]]) -> None:
        """Number the nodes by level, so that a level is one addition of two slices of rows."""
        level = [0] * self.n_atoms
        for a, b in pairs:
            level.append(1 + max(level[a], level[b]))
        order = sorted(range(len(level)), key=lambda i: (level[i], i))
        new = {old: i for i, old in enumerate(order)}
        children = np.array([(new[pairs[i - self.n_atoms][0]], new[pairs[i - self.n_atoms][1]]) for i in order[self.n_atoms :]], np.int64).reshape(-1, 2)
        self.left, self.right = children[:, 0], children[:, 1]
        depths = np.array([level[i] for i in order], np.int64)
        self.levels = [(int(np.searchsorted(depths, d)), int(np.searchsorted(depths, d, side="right"))) for d in range(1, int(depths.max(initial=0)) + 1)]
        self.parts = np.array([new[i] for row in rows for i in row], np.int64)
        self.starts = np.cumsum([0, *[len(row) for row in rows]])[:-1].astype(np.int64)
        self.size = len(order)

    def scores(self, terms: np.ndarray, docs: np.ndarray, added: np.ndarray, n_docs: int) -> np.ndarray:
        """(items, documents): scores from what each (term, document) adds."""
        held = np.zeros((self.size, n_docs), np.int64)
        np.add.at(held, (self.atom[terms], docs), added)
        for low, high in self.levels:
            at = slice(low - self.n_atoms, high - self.n_atoms)
            held[low:high] = held[self.left[at]] + held[self.right[at]]
        return np.add.reduceat(held[self.parts], self.starts, axis=0)


class Ranking:
    """The ``k`` best (score, document) of every item over the batches of a task."""

    def __init__(self, n_items: int, k: int) -> None:
        self.k = k
        self.item, self.doc, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.bars = np.ones(n_items, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        item, at = np.nonzero(scores >= self.bars[:, None])
        item, doc, score = (np.concatenate(x) for x in ((self.item, item), (self.doc, ids[at]), (self.score, scores[item, at])))
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        first = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else item
        place = np.arange(len(item)) - np.repeat(first, np.diff(np.append(first, len(item))))
        self.item, self.doc, self.score = (x[place < self.k] for x in (item, doc, score))
        last = place == self.k - 1
        self.bars[item[last]] = score[last]


def item_terms(items: DataFrame, item_id_col: str, text_col: str) -> DataFrame:
    """(item, terms): the distinct terms of every item id that has one."""
    terms = F.explode(F.array_distinct(F.regexp_extract_all(ascii_lower(items[text_col].cast("string")), F.lit(TERM), F.lit(1))))
    return items.select(items[item_id_col].cast("string").alias("item"), terms.alias("term")).distinct()


def plans(items: DataFrame, block_terms: int, item_id_col: str, text_col: str) -> DataFrame:
    """One row (block, plan) per block of items with some ``block_terms`` terms; an item is never cut, so one that has more is more."""
    rows = item_terms(items, item_id_col, text_col)
    blocks = max(1, -(-rows.count() // block_terms))

    def build(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        held: dict[str | None, list[bytes]] = defaultdict(list)
        for item, term in zip(pdf["item"], pdf["term"], strict=True):
            held[item if isinstance(item, str) else None].append(term.encode())
        made = Plan(sorted(held.items(), key=lambda x: (x[0] is None, x[0] or "")))
        return pd.DataFrame({"block": [key[0]], "plan": [pickle.dumps(made)]})

    return rows.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int")).groupBy("block").applyInPandas(build, "block int, plan binary")


def term_counts(texts: list[str | None], vocab: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(length of each text, term, place of the text, frequency): one entry per text and vocabulary term in it."""
    lengths, found, counts, sizes = [], [], [], []
    for text in texts:
        words = words_of(text)
        lengths.append(len(words))
        held = Counter(map(vocab.get, words))
        held.pop(None, None)
        found.extend(held.keys())
        counts.extend(held.values())
        sizes.append(len(held))
    return np.array(lengths, np.int64), np.array(found, np.int64), np.repeat(np.arange(len(texts)), sizes), np.array(counts, np.int64)


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_terms: int = 100_000, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item (id as text), rank, doc_id, score: the ``k`` best documents of every item.

    Items are dealt to blocks of a bounded number of terms; a block's plan is built on an executor and sent to all tasks,
    one block at a time, so what is broadcast does not grow with the items. Every block reads the documents twice.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].cast("string").alias("text"))
    built = checkpointed(plans(items, block_terms, item_id_col, item_text_col))
    out = spark.createDataFrame([], "item string, doc bigint, score bigint")
    totals = None
    for block in [r["block"] for r in built.select("block").orderBy("block").collect()]:
        plan = built.filter(F.col("block") == block).first()["plan"]
        shared = spark.sparkContext.broadcast(bytes(plan))
        vocab = pickle.loads(bytes(plan)).vocab  # noqa: S301 - written by this job
        counted = rows.select("text").mapInArrow(_counter(shared), "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()  # one row a term of the block
        seen = {r["term"]: r["n"] for r in counted}
        totals = totals or (seen.get(-1, 0), seen.get(-2, 0))
        weights = np.array([math.floor(1000 * math.log((2 * totals[0] + 2) / (2 * seen.get(t, 0) + 1))) for t in range(len(vocab))], np.int64)
        out = out.union(rows.mapInArrow(_ranker(shared, spark.sparkContext.broadcast((weights, *totals)), k), out.schema))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("item", "rank", F.col("doc").alias("doc_id"), "score")


def _counter(shared):  # noqa: ANN001, ANN202
    """Document frequency of every term that a task has met, as term -1 the documents with a term, as -2 all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = pickle.loads(shared.value).vocab  # noqa: S301 - written by this job
        seen = np.zeros(len(vocab), np.int64)
        documents = words = 0
        for batch in batches:
            lengths, terms, _, _ = term_counts(batch.column(0).to_pylist(), vocab)
            seen += np.bincount(terms, minlength=len(vocab))
            documents += int((lengths > 0).sum())
            words += int(lengths.sum())
        met = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[met, -1, -2].astype(np.int32)), pa.array(np.r_[seen[met], documents, words])], ["term", "n"])

    return run


def _ranker(shared, sums, k: int):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan: Plan = pickle.loads(shared.value)  # noqa: S301 - written by this job
        weights, n_all, l_all = sums.value
        best = Ranking(len(plan.items), k)
        step = max(1, CELLS // max(plan.size, len(plan.parts), 1))
        for batch in batches:
            lengths, terms, docs, tf = term_counts(batch.column(1).to_pylist(), plan.vocab)
            ids = np.array([LAST if i is None else i for i in batch.column(0).to_pylist()], np.int64)
            damp = 10 + (90 * lengths * n_all) // max(l_all, 1)
            added = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * damp[docs]))
            for low in range(0, len(ids), step):
                a, b = np.searchsorted(docs, (low, low + step))
                part = ids[low : low + step]
                best.add(plan.scores(terms[a:b], docs[a:b] - low, added[a:b], len(part)), part)
        yield pa.RecordBatch.from_arrays([pa.array([plan.items[i] for i in best.item], pa.string()), pa.array(best.doc, mask=best.doc == LAST), pa.array(best.score)], ["item", "doc", "score"])

    return run

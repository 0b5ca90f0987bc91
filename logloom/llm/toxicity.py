"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A window of words is the average of the vectors of its words and of their hashed character n-grams, so a misspelling
that was never seen shares most of its vectors with the word it comes from; a text scores what its highest window does,
so a toxic passage is not thinned out by the length of its text. Embeddings and softmax are trained together in
numpy, in one task, on a sample of at most ``max_rows`` labelled rows. For scoring, embeddings and softmax fold into one
number per bucket, so a word is one look-up.

Defined results: a null, empty or wordless text scores what the bias alone gives; repeated rows give repeated rows; a
null id stays null; an empty table gives an empty table; other columns are ignored. Labels that are null, or whose id is
null or has no document, are not used; several labels of one id count each. Without any label every text scores the
``prior``; with one class only, near that class. Texts of any length are learnt from and scored as wholes. A score of exactly
the threshold counts as toxic.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import small_batches, tidy
from logloom.llm.subwords import hashed, words_of

SIZES = (3, 4, 5)
BUCKETS = 1 << 16
CACHE = 300_000
#: Words of a window, and from one window to the next: a text is as toxic as its most toxic window, however long it is.
WINDOW, STRIDE = 16, 8
#: Averages are small numbers; they are scaled to keep the steps of training in a usual range.
SCALE = 16.0


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, begin and end of each window over texts that stand one after another; a text without words has none."""
    many = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(sizes)), many)
    k = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many)
    base = (np.cumsum(sizes) - sizes)[text]
    begin = base + np.minimum(k * STRIDE, np.maximum(sizes[text] - WINDOW, 0))
    return text, begin, np.minimum(begin + WINDOW, base + sizes[text])


def train(texts: list[str | None], labels: np.ndarray, dim: int = 6, epochs: int = 10, warm: int = 2, batch: int = 256, rate: float = 0.05, decay: float = 1e-5, drop: float = 0.2, least: int = 3, prior: float = 0.0) -> dict:
    """Folded model: one number per bucket, and the bias.

    The first ``warm`` rounds learn from random windows of every text; the later ones from the window that scores
    highest now, and from a random one of texts with label 0. Buckets that fewer than ``least`` texts hold stay 0.
    """
    empty = {"value": np.zeros(BUCKETS), "bias": float(np.log(max(prior, 1e-6) / (1 - prior)))}
    vocab: dict[bytes, int] = {}
    ids = [np.array([vocab.setdefault(w, len(vocab)) for w in words_of(t)], dtype=np.int32) for t in texts]
    if not vocab:
        return empty
    rng = np.random.default_rng(7)
    sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
    flat = np.concatenate(ids)
    words, grams, many = list(vocab), [], []
    del vocab, ids
    for start in range(0, len(words), 20_000):  # hashing a word takes far more room than its buckets
        owner, found = hashed(words[start : start + 20_000], SIZES, BUCKETS)
        grams.append(found[np.argsort(owner, kind="stable")].astype(np.int32))
        many.append(np.bincount(owner, minlength=len(words[start : start + 20_000])))
    bucket, many, n_words = np.concatenate(grams), np.concatenate(many), len(words)
    del grams, words
    at = np.cumsum(many) - many
    docs_of = np.zeros(BUCKETS)
    ends = np.cumsum(sizes)
    for start in range(0, len(sizes), 50):
        upto = min(start + 50, len(sizes))
        begin = int(ends[start] - sizes[start])
        text = np.repeat(np.arange(upto - start), sizes[start:upto])
        text, word = np.divmod(np.unique(text * n_words + flat[begin : int(ends[upto - 1])]), n_words)
        found, per = gather(at, many, bucket, word)
        docs_of += np.bincount(np.unique(np.repeat(text, per) * BUCKETS + found) % BUCKETS, minlength=BUCKETS)
    used = docs_of >= least
    text, begin, end = windows(sizes)
    first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    count = np.diff(np.append(first, len(text)))
    vectors = rng.normal(0, 0.1, (BUCKETS, dim)) * used[:, None]
    soft = rng.normal(0, 0.3, (dim, 2))
    bias = np.zeros(2)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (vectors, soft, bias)]
    step = 0
    lengths = np.append(0, np.cumsum(many[flat]))
    for epoch in range(epochs):
        picks = [first + (rng.random(len(first)) * count).astype(np.int64) for _ in range(3 if epoch < warm else 1)]
        if epoch >= warm:
            word_value = np.add.reduceat((vectors @ (soft[:, 1] - soft[:, 0]))[bucket], at)
            sums = np.append(0, np.cumsum(word_value[flat]))
            z = (sums[end] - sums[begin]) / np.maximum(lengths[end] - lengths[begin], 1)
            order = np.lexsort((z, text))
            picks = [order[first + count - 1], picks[0][labels[text[picks[0]]] == 0]]
        chosen = np.unique(np.concatenate(picks))
        rng.shuffle(chosen)
        for start in range(0, len(chosen), batch):
            part = chosen[start : start + batch]
            y = labels[text[part]]
            words = flat[np.concatenate([np.arange(i, j) for i, j in zip(begin[part], end[part], strict=True)])]
            index, per_word = gather(at, many, bucket, words)
            rows = np.repeat(np.repeat(np.arange(len(part)), end[part] - begin[part]), per_word)
            share = (SCALE / np.bincount(rows, minlength=len(part)))[rows] * (rng.random(len(rows)) >= drop) / (1 - drop)
            bag = vectors[index] * share[:, None]
            mean = np.stack([np.bincount(rows, bag[:, d], len(part)) for d in range(dim)], axis=1)
            z = mean @ soft + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), y] -= 1
            p /= len(part)
            back = (p @ soft.T)[rows] * share[:, None]
            grad = np.stack([np.bincount(index, back[:, d], BUCKETS) for d in range(dim)], axis=1)
            step += 1
            pace = rate * (1 - epoch / epochs)
            for x, g, s in zip((vectors, soft, bias), (grad * used[:, None] + decay * vectors, mean.T @ p, p.sum(axis=0)), state, strict=True):
                s[0] = 0.9 * s[0] + 0.1 * g
                s[1] = 0.99 * s[1] + 0.01 * g * g
                x -= pace * (s[0] / (1 - 0.9**step)) / (np.sqrt(s[1] / (1 - 0.99**step)) + 1e-8)
    return {"value": vectors @ (soft[:, 1] - soft[:, 0]) * SCALE, "bias": float(bias[1] - bias[0])}


def gather(at: np.ndarray, many: np.ndarray, bucket: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word in turn, and how many each has."""
    n = many[words]
    total = np.cumsum(n)
    place = np.arange(int(total[-1]) if len(total) else 0) - np.repeat(total - n, n) + np.repeat(at[words], n)
    return bucket[place], n


class Scorer:
    """Texts to probabilities; words are looked up in a cache of sums over their n-grams (real) and counts (imaginary)."""

    def __init__(self, model: dict) -> None:
        self.value, self.bias = model["value"], model["bias"]
        self.known: dict[bytes, complex] = {}

    def score(self, texts: list[str | None]) -> list[float]:
        if len(self.known) > CACHE:
            self.known.clear()
        cut = [words_of(t) for t in texts]
        new: set[bytes] = set()
        new.update(*cut)
        words = [w for w in new if w not in self.known]
        if words:
            owner, bucket = hashed(words, SIZES, BUCKETS)
            total = np.bincount(owner, self.value[bucket], len(words)) + 1j * np.bincount(owner, minlength=len(words))
            self.known.update(zip(words, total.tolist(), strict=True))
        sizes = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        each = np.fromiter((x for w in cut for x in map(self.known.__getitem__, w)), dtype=complex, count=int(sizes.sum()))
        sums = np.append(0, np.cumsum(each))
        text, begin, end = windows(sizes)
        part = sums[end] - sums[begin]
        z = np.full(len(texts), self.bias)
        if len(text):
            first = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            z[text[first]] = np.maximum.reduceat(part.real / np.maximum(part.imag, 1) + self.bias, first)
        return (1 / (1 + np.exp(-np.clip(z, -500, 500)))).tolist()


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 8000, prior: float = 0.0, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> bytes:
    """A folded model from at most ``max_rows`` labelled rows, chosen by a hash of their id; about half a megabyte."""
    small_batches(docs.sparkSession)
    ids = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("y")).filter("id is not null and y in (0, 1)")
    ids = ids.orderBy(F.xxhash64("id"), "id", "y").limit(max_rows)
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    rows = texts.join(F.broadcast(ids), "id").repartition(1).sortWithinPartitions("id", "y")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [b for b in batches if len(b)]
        pdf = pd.concat(parts) if parts else pd.DataFrame({"text": [], "y": []})
        model = train([t if isinstance(t, str) else None for t in pdf["text"]], pdf["y"].to_numpy(dtype=np.int64), prior=prior)
        yield pd.DataFrame({"model": [pickle.dumps({"value": model["value"].astype(np.float32), "bias": model["bias"]})]})

    found = rows.mapInPandas(tidy(run), "model binary").collect()
    return bytes(found[0]["model"]) if found else pickle.dumps(train([], np.zeros(0, np.int64), prior=prior))


def score(docs: DataFrame, model: bytes, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score, predicted; narrow, no shuffle."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(pickle.loads(shared.value))  # noqa: S301 - written by this job
        for batch in batches:
            found = scorer.score(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64()), pa.array([int(x >= threshold) for x in found], pa.int32())], ["id", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(tidy(run), f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, model: bytes, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; narrow, no shuffle."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(pickle.loads(shared.value))  # noqa: S301 - written by this job
        for batch in batches:
            found = scorer.score(batch.column(at).to_pylist())
            yield batch.filter(pa.array([x < threshold for x in found], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)

"""Language identification by nearest centroids.

A text becomes a normalised TF-IDF vector of hashed byte n-grams; every language has several centroids, clustered from
its own training texts. The language of the nearest centroid by cosine is predicted; a text farther from it than all
but ``reject_share`` of that centroid's training texts is marked as rejected, and keeps its nearest language.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected; repeated rows give repeated
rows; a null id stays null; an empty table gives an empty table; other columns are ignored. Without any training row
every text is ``und`` with score 0. Of equally near centroids the first by name and number counts. A text is counted as
a whole; texts are counted in groups of at most ``ROWS`` texts and ``GROUP`` characters, and one beyond that alone, in
slices that overlap by the longest n-gram, so memory is bounded however long it is.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import small_batches, tidy, written
from logloom.llm.subwords import PART, mixed

SIZES = (1, 2, 3)
BUCKETS = 4096
UNKNOWN = "und"
#: Texts whose counts are held at once: a row of counts is ``BUCKETS`` numbers.
ROWS = 128
GROUP = 2_000_000


def counts(texts: list[str]) -> np.ndarray:
    """Log-damped counts of the n-grams of each text, a row a text."""
    return np.log1p(np.concatenate([raw_counts(part) for part in groups([b" " + b" ".join(t.lower().encode().translate(PART).split()) + b" " for t in texts])]))


def groups(folded: list[bytes]) -> Iterator[list[bytes]]:
    """Neighbouring texts of at most ``GROUP`` bytes together, or a longer one."""
    part: list[bytes] = []
    size = 0
    for f in folded:
        if part and size + len(f) > GROUP:
            yield part
            part, size = [], 0
        part.append(f)
        size += len(f)
    if part:
        yield part


def raw_counts(folded: list[bytes]) -> np.ndarray:
    if len(folded) == 1 and len(folded[0]) > GROUP:
        whole, out = folded[0], np.zeros((1, BUCKETS))
        for start in range(0, len(whole), GROUP):
            out += raw_counts([whole[start : start + GROUP]])
            for n in SIZES:  # n-grams across the end of the slice
                edge = whole[max(start + GROUP - n + 1, 0) : start + GROUP + n - 1]
                for i in range(len(edge) - n + 1 if start + GROUP < len(whole) else 0):
                    out += one_gram(edge[i : i + n])
        return out
    lengths = np.fromiter(map(len, folded), dtype=np.int64, count=len(folded))
    flat = np.frombuffer(b"".join(folded), dtype=np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(folded)) * BUCKETS, lengths)
    out = np.zeros(len(folded) * BUCKETS)
    h = np.zeros(len(flat), dtype=np.uint64)
    for n in range(1, max(SIZES) + 1):
        h = h[: len(flat) - n + 1] * np.uint64(1_000_003) + flat[n - 1 :] + np.uint64(1)
        inside = owner[: len(h)] == owner[n - 1 :]
        if n in SIZES:
            out += np.bincount(owner[: len(h)][inside] + mixed(h[inside] + np.uint64(n << 40), BUCKETS), minlength=len(out))
    return out.reshape(len(folded), BUCKETS)


def one_gram(gram: bytes) -> np.ndarray:
    """The count of a single n-gram."""
    h = np.zeros(1, dtype=np.uint64)
    for b in gram:
        h = h * np.uint64(1_000_003) + np.uint64(b + 1)
    return np.bincount(mixed(h + np.uint64(len(gram) << 40), BUCKETS), minlength=BUCKETS).astype(float)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=-1, keepdims=True), 1e-12)


def clustered(rows: np.ndarray, clusters: int = 3, rounds: int = 8, reject_share: float = 0.005) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of one language's vectors and their least cosines."""
    centres = rows[np.random.default_rng(11).permutation(len(rows))[:clusters]]
    for _ in range(rounds):
        near = (rows @ centres.T).argmax(axis=1)
        centres = unit(np.stack([rows[near == c].mean(axis=0) if (near == c).any() else centres[c] for c in range(len(centres))]))
    best = rows @ centres.T
    near = best.argmax(axis=1)
    least = [float(np.quantile(best[near == c, c], reject_share)) if (near == c).any() else 1.0 for c in range(len(centres))]
    return centres.astype(np.float32), np.array(least)


def predict(texts: list[str | None], model: dict) -> tuple[list[str], list[float], list[bool]]:
    langs, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
    held = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if model["langs"] else []
    for start in range(0, len(held), ROWS):
        part = held[start : start + ROWS]
        near = unit(counts([texts[i] for i in part]) * model["idf"]) @ model["centroids"].T
        best = near.argmax(axis=1)
        for i, k, row in zip(part, best.tolist(), near, strict=True):
            langs[i], scores[i], rejected[i] = model["langs"][k], float(min(max(row[k], 0.0), 1.0)), bool(row[k] < model["least"][k])
    return langs, scores, rejected


def fit(docs: DataFrame, per_lang: int = 600, clusters: int = 3, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> bytes:
    """A model from at most ``per_lang`` texts of every language, chosen by a hash of their id; a task trains a language.

    Only the inverse document frequencies and the centroids, ``clusters`` a language, come to the driver.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ids = docs.select(docs[id_col].alias("id"), docs[lang_col].cast("string").alias("lang")).filter("id is not null and lang is not null")
    # rows with a small enough hash are a few times as many as wanted, however frequent a language is
    share = (F.xxhash64("id").cast("double") + 2.0**63) / 2.0**64
    low = ids.join(ids.groupBy("lang").count(), "lang").filter(share * F.col("count") <= 1.5 * per_lang + 50)
    ranked = low.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")))
    chosen = ranked.filter(F.col("rank") <= per_lang).select("id", "lang").distinct()
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).filter("text is not null")

    def lettered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([any(map(str.isalpha, t)) for t in b.column(1).to_pylist()], pa.bool_()))

    kind = docs.schema[id_col].dataType.simpleString()
    rows = written(texts.join(chosen, "id").select("id", "text", "lang").mapInArrow(lettered, f"id {kind}, text string, lang string"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(BUCKETS, dtype=np.int64)
        for b in batches:
            held = b.column(0).to_pylist()
            for i in range(0, len(held), ROWS):
                found += (counts(held[i : i + ROWS]) > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(found)], ["bucket", "n"])

    n, df = rows.count(), np.zeros(BUCKETS)
    for r in rows.select("text").mapInArrow(frequencies, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        df[r["bucket"]] = r["n"]
    idf = np.log((1 + n) / (1 + df)) + 0.1 if n else np.ones(BUCKETS)

    def learn(own: pd.DataFrame) -> pd.DataFrame:
        held = own.sort_values(["id", "text"])["text"].tolist()
        tf = np.concatenate([counts(held[i : i + ROWS]).astype(np.float32) for i in range(0, len(held), ROWS)])
        centres, least = clustered(unit(tf * idf.astype(np.float32)), clusters)
        return pd.DataFrame({"lang": [own["lang"].iloc[0]] * len(least), "k": range(len(least)), "centroid": [c.tobytes() for c in centres], "least": least})

    found = sorted(rows.groupBy("lang").applyInPandas(learn, "lang string, k int, centroid binary, least double").collect(), key=lambda r: (r["lang"], r["k"]))
    centroids = np.stack([np.frombuffer(r["centroid"], np.float32) for r in found]) if found else np.zeros((0, BUCKETS), np.float32)
    return pickle.dumps({"idf": idf, "centroids": centroids, "langs": [r["lang"] for r in found], "least": np.array([r["least"] for r in found])})


def identify(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score (cosine to the nearest centroid), rejected; narrow, no shuffle."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pickle.loads(shared.value)  # noqa: S301 - written by this job
        for batch in batches:
            langs, scores, rejected = predict(batch.column(1).to_pylist(), held)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())], ["id", "lang_pred", "score", "rejected"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(tidy(run), f"id {kind}, lang_pred string, score double, rejected boolean").withColumnRenamed("id", id_col)

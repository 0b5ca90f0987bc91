"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again for the next.

Each stage takes all that its predecessor kept and, but for the last, returns the columns of ``documents``:
toxic documents go, one document of each near-duplicate group stays, passages of 100 bytes that stand earlier go,
benchmark passages go (and with them documents of which more than half is such), and what is left is encoded.

Defined results: of documents with a null, empty or wordless text one (the smallest id) passes near-dedup, and null and empty
texts end at suffix-array dedup; rows without an id are scored, cleaned and encoded but not compared; of rows that are
there twice one stays; columns beyond those of ``documents`` are carried along under their own names; an empty table runs to an
empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import bpe, decontaminate, simhash, suffix_dedup, toxicity
from logloom.llm.common import drop_folder, scratch, shared_folder
from logloom.llm.queries import table, tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the model learns from the labels of all documents."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 100 bytes that stand earlier; documents of which nothing is left go, as do null and empty ones."""
    return suffix_dedup.cut_texts(docs).filter(F.coalesce(F.length("text"), F.lit(0)) > 0)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without windows of ten words of a benchmark item."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """BPE encoding and decoding of all that is left."""
    return bpe.encode_decode(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_copies), ("suffix_array_dedup", cut_repeats), ("benchmark_decontamination", decontaminated), ("bpe_codec", encoded)]

#: Trained weights, fingerprints and suffix order are not SQL; tests hold the rows of ``run`` against brute force over every stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage's rows are written to the shared folder and read again.

    What a stage stored on its way, and the rows of the stage before it, go as soon as its own rows are written.
    """
    top = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{top}/{k}-{name}"
        with scratch():
            stage(spark, docs, sf_dir).write.parquet(path)
        if k:
            drop_folder(before)
        docs, before = spark.read.parquet(path), path
    return docs

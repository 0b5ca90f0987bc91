"""Retrieval: cosine top-k, recall, greedy coverage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.arrays import once
from logloom.operators.windows import ranked

#: Queries of a block and vectors of a shard: what one task holds at once.
QUERIES, VECTORS = 1024, 4096


def cosine_top_k(index: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", query_col: str = "query_id") -> DataFrame:
    """(query, rank, id, score): cosine by normalised vectors, ties to the smaller id; zero and null vectors match nothing.

    Index rows are dealt to shards and queries to blocks, both of a bounded size. A row of the join on (shard, block) is
    a matrix product in one task and gives at most ``k`` rows a query. The join shuffles both sides: a broadcast would take all
    vectors through the driver.
    """

    def packed(df: DataFrame, name: str, size: int, part: str) -> DataFrame:
        rows = df.filter(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0)).select(F.col(name).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        parts = max(1, -(-rows.count() // size))

        def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            m = np.stack(pdf["v"])
            norm = np.linalg.norm(m, axis=1, keepdims=True)
            held = norm[:, 0] > 0
            m = m[held] / norm[held]
            return pd.DataFrame({part: [key[0]], "n": [len(m)], "ids": [pdf["id"].to_numpy("<i8")[held].tobytes()], "m": [m.tobytes()]})

        return rows.withColumn(part, F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")).groupBy(part).applyInPandas(pack, f"{part} int, n int, ids binary, m binary"), parts

    shards, n_shards = packed(index, id_col, VECTORS, "shard")
    blocks, n_blocks = packed(queries, query_col, QUERIES, "block")
    left = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    right = blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"), F.col("n").alias("qn"), F.col("ids").alias("q_ids"), F.col("m").alias("qm"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                if not r.n or not r.qn:
                    continue
                ids, q_ids = np.frombuffer(r.ids, "<i8"), np.frombuffer(r.q_ids, "<i8")
                scores = np.frombuffer(r.qm).reshape(r.qn, -1) @ np.frombuffer(r.m).reshape(r.n, -1).T
                order = np.lexsort((np.broadcast_to(ids, scores.shape), -np.round(scores, 9)), axis=1)[:, :k]
                yield pd.DataFrame({"query": np.repeat(q_ids, order.shape[1]), "id": ids[order].ravel(), "score": np.take_along_axis(scores, order, 1).ravel()})

    found = left.join(right.hint("merge"), ["shard", "block"]).mapInPandas(run, "query bigint, id bigint, score double")
    out = ranked(found, ["query"], [F.desc(F.round("score", 9)), F.col("id")]).filter(F.col("rank") <= k)
    return out.select(F.col("query").alias(query_col), "rank", F.col("id").alias(id_col), "score")


def recall(hits: DataFrame, targets: DataFrame, user: str, item: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, hits, targets, recall, users): micro recall of distinct retrieved items; no target gives 0."""
    keys = list(keys)
    t = targets.select(*keys, user, item).distinct()
    h = hits.select(*keys, user, item).distinct().withColumn("__hit", F.lit(1))
    agg = [F.coalesce(F.sum("__hit"), F.lit(0)).cast("bigint").alias("hits"), F.count("*").alias("targets"), (F.coalesce(F.sum("__hit"), F.lit(0)) / F.count("*")).alias("recall"), F.count_distinct(user).alias("users")]
    return t.join(h, [*keys, user, item], "left").groupBy(*keys).agg(*agg)


def greedy_cover(df: DataFrame, user: str, candidate: str, item: str, k: int) -> DataFrame:
    """(user, step, candidate, gain): up to ``k`` candidates per user by the most items not yet covered, ties to the smaller.

    Greedy choice is sequential within a user, whose candidates are one row; null candidates are none.
    """
    kind = lambda c: df.schema[c].dataType.simpleString()
    sets = df.filter(F.col(candidate).isNotNull()).groupBy(user, candidate).agg(F.collect_set(item).alias("i"), F.max(F.col(item).isNull()).alias("n"))
    held = F.when(F.col("n"), F.concat("i", F.array(F.lit(None).cast(kind(item))))).otherwise(F.col("i"))
    rows = sets.select(user, F.struct(F.col(candidate).alias("c"), held.alias("i")).alias("x")).groupBy(user).agg(F.collect_list("x").alias("xs"))

    def choose(s: Column, step: Column) -> Column:
        best = F.array_min(F.transform("xs", lambda x: F.struct((-F.size(F.array_except(x["i"], s["covered"]))).alias("g"), x["c"].alias("c"), x["i"].alias("i"))))
        return once(best, lambda b: F.when(b["g"] < 0, F.struct(F.array_union(s["covered"], b["i"]).alias("covered"), F.concat(s["picked"], F.array(F.struct(step.alias("step"), b["c"].alias("c"), (-b["g"]).alias("gain")))).alias("picked"))).otherwise(s))

    none = F.struct(F.array().cast(f"array<{kind(item)}>").alias("covered"), F.array().cast(f"array<struct<step:int,c:{kind(candidate)},gain:int>>").alias("picked"))
    picked = rows.select(user, F.aggregate(F.sequence(F.lit(1), F.lit(k)), none, choose)["picked"].alias("p"))
    return picked.select(user, F.explode_outer("p").alias("p")).filter("p is not null").select(user, "p.step", F.col("p.c").alias(candidate), "p.gain")


def dynamic_top(df: DataFrame, user: str, order: Sequence, limits: DataFrame, limit: str) -> DataFrame:
    """The best rows of each user, as many as ``limits`` says."""
    return ranked(df.join(limits, user), [user], order).filter(F.col("rank") <= F.col(limit)).drop(limit)

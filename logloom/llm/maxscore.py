"""Exact top-k inner products by MaxScore over shards.

Vectors are cut to shards; a dimension is a term and a shard's column its posting list, of which the largest and the
smallest value bound what the term can add to a query. For each query the terms are put in order of their bounds. Terms
whose bounds together stay below the k-th best score so far are non-essential: candidates are scored over the essential
terms first and probed in the others only while they can still compete. A task goes through its shards with the k best
of each query so far, so the bar rises from shard to shard; it hands out k rows a query, and tasks are merged at the end.

Defined results: vectors that are null, empty, or hold a null or non-finite component, and rows without an id, take no
part; a vector meets only those of its own length; a query's own row is the rows of its id, and rows of one id are one
query, the first of their vectors in order; equal scores go to the smaller id; repeated rows are candidates each; empty
tables give an empty table; other columns are ignored. Scores are
64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.llm.common import written

#: Vectors of a shard, queries of a block, and terms that are probed at once.
SHARD, BLOCK, STEP = 2048, 512, 8
#: Bytes of the query blocks that are sent to all tasks for one pass over the shards.
PASS = 64 << 20


def quantised(column: Column, scale: int) -> Column:
    return F.transform(column, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint"))


def packed(rows: DataFrame, size: int) -> DataFrame:
    """(dim, part, ids, matrix): up to ``size`` vectors of one length in a row."""
    counts = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return rows.sparkSession.createDataFrame([], "dim int, part int, ids binary, matrix binary")
    parts = F.lit(1)
    for dim, n in counts.items():
        parts = F.when(F.col("dim") == dim, -(-n // size)).otherwise(parts)
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable")
        return pd.DataFrame({"dim": [key[0]], "part": [key[1]], "ids": [pdf["id"].to_numpy("<i8").tobytes()], "matrix": [np.stack(pdf["v"]).astype("<i8").tobytes()]})

    return dealt.groupBy("dim", "part").applyInPandas(pack, "dim int, part int, ids binary, matrix binary")


def search_shard(queries: np.ndarray, query_ids: np.ndarray, matrix: np.ndarray, ids: np.ndarray, k: int, bars: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the query, id, score) of each query's best ``k`` in one shard; ids ascend.

    ``bars`` are scores that k candidates of other shards reach already; what stays below its query's is left out.
    """
    exact = float(np.abs(queries).max(initial=0)) * float(np.abs(matrix).max(initial=0)) * matrix.shape[1] < 2**52
    kind = np.float64 if exact else np.int64
    queries, columns = queries.astype(kind), np.ascontiguousarray(matrix.T.astype(kind))
    high, low = columns.max(axis=1), columns.min(axis=1)
    who, found, scores = [], [], []
    seed = min(len(ids), 8 * k + 16)
    for i, q in enumerate(queries):
        bound = np.maximum(q * high, q * low)
        order = np.argsort(-(bound - np.minimum(q * high, q * low)), kind="stable")
        rest = np.concatenate([np.cumsum(bound[order][::-1])[::-1], np.zeros(1, kind)])  # what terms from here on can add
        other = ids != query_ids[i]
        first = q @ columns[:, :seed]
        own = np.flatnonzero(other[:seed])
        floor = np.partition(first[own], len(own) - k)[len(own) - k] if len(own) >= k else None
        if bars is not None and bars[i] > UNSET and (floor is None or bars[i] > floor):
            floor = kind(bars[i])
        alive = np.flatnonzero(other)
        partial = np.zeros(len(alive), kind)
        essential = len(order) if floor is None else max(STEP, int(np.searchsorted(-rest, -floor, side="right")))
        at = 0
        while at < len(order):
            upto = min(len(order), essential if at == 0 else at + STEP)
            terms = order[at:upto]
            block = columns[np.ix_(terms, alive)] if len(alive) < columns.shape[1] else columns[terms]
            partial = partial + q[terms] @ block
            at = upto
            if floor is not None and at < len(order):
                keep = partial + rest[at] >= floor
                alive, partial = alive[keep], partial[keep]
        if floor is not None:
            keep = partial >= floor
            alive, partial = alive[keep], partial[keep]
        best = np.lexsort((ids[alive], -partial))[:k]
        who.append(np.full(len(best), i))
        found.append(ids[alive][best])
        scores.append(partial[best].astype(np.int64))
    return np.concatenate(who), np.concatenate(found), np.concatenate(scores)


#: Below every score.
UNSET = np.int64(-(2**63))


class Best:
    """The ``k`` best (score, id) of each query of one block, over the shards of a task."""

    def __init__(self, dim: int, ids: bytes, matrix: bytes, k: int) -> None:
        self.dim, self.k = dim, k
        self.ids, self.queries = np.frombuffer(ids, "<i8"), np.frombuffer(matrix, "<i8").reshape(-1, dim)
        self.who, self.found, self.scores = (np.zeros(0, np.int64) for _ in range(3))
        self.bars = np.full(len(self.ids), UNSET)

    def add(self, matrix: np.ndarray, ids: np.ndarray) -> None:
        more = search_shard(self.queries, self.ids, matrix, ids, self.k, self.bars)
        who, found, scores = (np.concatenate(x) for x in zip((self.who, self.found, self.scores), more, strict=True))
        order = np.lexsort((found, -scores, who))
        who = who[order]
        begin = np.flatnonzero(np.r_[True, who[1:] != who[:-1]]) if len(who) else who
        place = np.arange(len(who)) - np.repeat(begin, np.diff(np.append(begin, len(who))))
        kept = order[place < self.k]
        last = order[place == self.k - 1]
        self.who, self.found, self.scores = (np.concatenate([a, b])[kept] for a, b in zip((self.who, self.found, self.scores), more, strict=True))
        self.bars[who[place == self.k - 1]] = scores[last]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score for every row of ``queries`` against all ``vectors``.

    Shards and query blocks have a bounded size. Blocks of at most ``PASS`` bytes together are sent to all tasks, which
    meet every shard once with them; more queries take more passes over the stored shards. No vector is shuffled again.
    """
    spark = vectors.sparkSession

    def held(df: DataFrame) -> DataFrame:
        v = df[vector_col]
        good = df[id_col].isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
        rows = df.filter(F.coalesce(good, F.lit(False))).select(df[id_col].cast("bigint").alias("id"), quantised(v, scale).alias("v"))
        return rows.withColumn("dim", F.size("v"))

    asked = held(queries).groupBy("id").agg(F.min(F.struct("dim", "v")).alias("q")).select("id", "q.v", "q.dim")
    shards, blocks = packed(held(vectors), SHARD), written(packed(asked, BLOCK))
    sizes = blocks.select("dim", "part", F.octet_length("matrix").alias("n")).orderBy("dim", "part").collect()  # three numbers a block
    passes: list[list] = []
    room = 0
    for r in sizes:
        if not passes or room < r["n"]:
            passes.append([])
            room = PASS
        passes[-1].append((r["dim"], r["part"]))
        room -= r["n"]
    if len(passes) > 1:
        shards = written(shards)
    out = spark.createDataFrame([], "query_id bigint, vec_id bigint, score bigint")
    for wanted in passes:
        (dim, part), (last_dim, last_part) = wanted[0], wanted[-1]
        place = F.struct("dim", "part")
        between = (place >= F.struct(F.lit(dim).alias("dim"), F.lit(part).alias("part"))) & (place <= F.struct(F.lit(last_dim).alias("dim"), F.lit(last_part).alias("part")))
        shared = spark.sparkContext.broadcast([(r["dim"], bytes(r["ids"]), bytes(r["matrix"])) for r in blocks.filter(between).collect()])
        found = shards.select("dim", "ids", "matrix").mapInArrow(_searcher(shared, k), out.schema)
        if len(passes) > 1:
            found = written(found)
            shared.unpersist()
        out = found if wanted is passes[0] else out.union(found)
    ranked = out.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _searcher(shared, k: int):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [Best(*row, k) for row in shared.value]
        for batch in batches:
            for row in range(batch.num_rows):
                dim, ids, matrix = (batch.column(c)[row].as_py() for c in range(3))
                ids, matrix = np.frombuffer(ids, "<i8"), np.frombuffer(matrix, "<i8").reshape(-1, dim)
                for b in blocks:
                    if b.dim == dim:
                        b.add(matrix, ids)
        for b in blocks:
            yield pa.RecordBatch.from_arrays([pa.array(b.ids[b.who]), pa.array(b.found), pa.array(b.scores)], ["query_id", "vec_id", "score"])

    return run

"""Sinks: bucketed sorted exports, size-balanced shards, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def guard(inputs: Sequence[str], outputs: Sequence[str]) -> None:
    """Outputs are distinct and none is an input."""
    norm = lambda p: p.rstrip("/")
    if len({*map(norm, outputs)}) < len(outputs) or {*map(norm, inputs)} & {*map(norm, outputs)}:
        raise ValueError("an output is named twice or is an input")


def tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").csv(path)


def bucketed(df: DataFrame, path: str, bucket: Column, buckets: int, order: Sequence[str]) -> None:
    """``buckets`` folders, each sorted; one shuffle, rows of a bucket in one file."""
    rows = df.withColumn("bucket", bucket).repartition(buckets, "bucket").sortWithinPartitions("bucket", *order)
    rows.write.mode("overwrite").partitionBy("bucket").parquet(path)


def ordered_prefix(df: DataFrame, order: Sequence[str], size: Column, ranges: int = 64) -> DataFrame:
    """``df`` with ``prefix``: the sum of ``size`` of all rows before it in ``order``, whose first column is a number.

    Rows are dealt by ranges of the first order column, summed within a range and offset by the sums of the ranges
    before, which are as few as ``ranges``; no window runs over all rows in one task.
    """
    cuts = df.select(F.col(order[0]).alias("k")).agg(F.percentile_approx("k", [i / ranges for i in range(1, ranges)], 10_000).alias("c")) if ranges > 1 else None
    rows = df.withColumn("c", F.array(*map(F.lit, cuts.first()["c"] or []))) if cuts is not None and not df.isEmpty() else df.withColumn("c", F.array().cast("array<double>"))
    rows = rows.withColumn("__range", F.size(F.filter("c", lambda c: c <= F.col(order[0])))).drop("c").withColumn("__size", size)
    sums = rows.groupBy("__range").agg(F.sum("__size").alias("__n"))
    before = sums.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    within = F.sum("__size").over(Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("__upto", within).join(F.broadcast(before), "__range").withColumn("prefix", F.col("__before") + F.col("__upto") - F.col("__size")).drop("__range", "__size", "__upto", "__before")


def shard_ids(df: DataFrame, order: Sequence[str], size: Column, shards: int, total: int) -> DataFrame:
    """Contiguous shards of about equal size: the shard that a row's first byte falls into."""
    return ordered_prefix(df, order, size).withColumn("shard", F.least(F.floor(F.col("prefix") * shards / total), F.lit(shards - 1)).cast("int")).drop("prefix")


def shards(df: DataFrame, path: str, order: Sequence[str], size: Column, count: int) -> None:
    total = df.agg(F.sum(size)).first()[0] or 1
    shard_ids(df, order, size, count, total).repartition(count, "shard").sortWithinPartitions("shard", *order).write.mode("overwrite").partitionBy("shard").parquet(path)


def batch_groups(df: DataFrame, path: str, batch: str, slot: str, size: int) -> None:
    """Parquet in which every row group is one batch: batches have ``size`` rows each and stand in order, whole in one file.

    Rows are dealt by ranges of the batch, so a file begins and ends with one, and a row group ends after ``size`` rows; a
    reader that asks for one batch reads one group. A batch of another size is an error, since groups would drift.
    """
    odd = df.groupBy(batch).agg(F.count("*").alias("n")).filter(F.col("n") != size).limit(1).collect()
    if odd:
        raise ValueError(f"batch {odd[0][batch]} has {odd[0]['n']} rows, not {size}")
    rows = df.repartitionByRange(batch).sortWithinPartitions(batch, slot)
    rows.write.mode("overwrite").option("parquet.block.row.count.limit", size).option("parquet.page.row.count.limit", size).parquet(path)


def report(counts: DataFrame, path: str) -> None:
    counts.coalesce(1).write.mode("overwrite").json(path)

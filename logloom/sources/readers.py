"""Scans: JSON lines with counted errors, dated folders, tables by extension."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lines(spark: SparkSession, paths: str | Sequence[str], glob: str = "*", recursive: bool = True) -> DataFrame:
    """(path, place, line): non-blank lines of text files; ``place`` orders the lines of a file as they stand there."""
    df = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).text(paths)
    # a file may be read in several blocks; within one, rows are numbered as they are read
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return df.select(F.col("_metadata.file_path").alias("path"), place.alias("place"), F.col("value").alias("line")).filter(F.trim("line") != "")


def json_lines(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str, strict: bool = False, glob: str = "*.jsonl") -> DataFrame:
    """(path, place, line, drop, record): ``drop`` is ``invalid_json`` or ``not_an_object`` where there is no record.

    With ``strict`` a bad line fails the job with its path instead.
    """
    df = lines(spark, paths, glob)
    parsed = F.try_parse_json("line")
    drop = F.when(parsed.isNull(), "invalid_json").when(~F.ltrim("line").startswith("{"), "not_an_object")
    if strict:
        drop = F.when(drop.isNull(), drop).otherwise(F.raise_error(F.concat(F.lit("bad JSON line in "), F.col("path"))).cast("string"))
    df = df.withColumn("drop", drop)
    return df.withColumn("record", F.when(F.col("drop").isNull(), F.from_json("line", schema)))


def first_per_file(df: DataFrame, n: int, order: str = "place") -> DataFrame:
    """The first ``n`` rows of every file, as they stand there."""
    from logloom.operators.windows import ranked

    return ranked(df, ["path"], [F.col(order)], "__rank").filter(F.col("__rank") <= n).drop("__rank")


def by_extension(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet and JSON (lines) files by name, columns matched by name; other kinds are refused."""
    out = None
    for path in paths:
        kind = os.path.splitext(path)[1].lower()
        if kind not in (".parquet", ".json", ".jsonl"):
            raise ValueError(f"unsupported file kind: {path}")
        df = spark.read.parquet(path) if kind == ".parquet" else spark.read.json(path)
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no paths")
    return out


def dated(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Rows whose folder is a calendar date ``yyyy-MM-dd``, as column ``folder_date``; ranges do not count."""
    name = F.regexp_extract(path_col, r"/(\d{4}-\d{2}-\d{2})/[^/]*$", 1)
    return df.withColumn("folder_date", F.when(name != "", F.try_to_timestamp(name, F.lit("yyyy-MM-dd")).cast("date"))).filter("folder_date is not null")


def tsv_in_text(df: DataFrame, text_col: str, columns: Sequence[str]) -> DataFrame:
    """One row per tab-separated line of a text column; quoted fields lose their quotes, doubled quotes become one."""
    rows = df.withColumn("__line", F.explode(F.split(text_col, "\n"))).filter(F.trim("__line") != "")
    parts = F.transform(F.split("__line", "\t"), lambda p: F.when(p.rlike('^".*"$'), F.replace(F.substring(p, F.lit(2), F.length(p) - 2), F.lit('""'), F.lit('"'))).otherwise(p))
    return rows.select(*[c for c in df.columns if c != text_col], *[F.get(parts, F.lit(i)).alias(c) for i, c in enumerate(columns)])


def one_batch(df: DataFrame, key_col: str, key: object) -> DataFrame:
    """The single row of a batch key; the filter reaches the scan. Any other number of rows fails."""
    found = df.filter(F.col(key_col) == F.lit(key))
    if len(found.take(2)) != 1:
        raise ValueError(f"{key_col} = {key!r} is not exactly one row")
    return found

"""Aggregations: reports of reasons, votes, metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def reason_counts(df: DataFrame, reasons: str, rules: Sequence[str]) -> DataFrame:
    """(rule, rows, share, sole): rows that break a rule, also those that break it alone; rules that none breaks count 0."""
    each = df.agg(F.count("*").alias("__n"), *[F.count_if(F.array_contains(reasons, r)).alias(f"n{i}") for i, r in enumerate(rules)], *[F.count_if(F.array_contains(reasons, r) & (F.size(reasons) == 1)).alias(f"s{i}") for i, r in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(f"n{i}").alias("rows"), F.when(F.col("__n") > 0, F.col(f"n{i}") / F.col("__n")).otherwise(F.lit(0.0)).alias("share"), F.col(f"s{i}").alias("sole")) for i, r in enumerate(rules)])
    return each.select(F.explode(rows).alias("r")).select("r.*")


def first_reason_counts(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """(reason, rows): exclusive, by the first check that fails; ``kept`` counts the others."""
    reason = F.coalesce(*[F.when(c, name) for name, c in checks], F.lit("kept"))
    return df.groupBy(reason.alias("reason")).agg(F.count("*").alias("rows"))


def vote(df: DataFrame, keys: Sequence[str], label: str, least: int = 1, share: float = 0.0, mixed: str = "mix") -> DataFrame:
    """The most frequent label of each key, smaller label on a tie; ``mixed`` below ``least`` votes or ``share``."""
    counts = df.groupBy(*keys, label).agg(F.count("*").alias("__n"))
    best = counts.groupBy(*keys).agg(F.sum("__n").alias("votes"), F.max("__n").alias("top"), F.min_by(label, F.struct(-F.col("__n"), F.col(label))).alias("__best"))
    return best.withColumn(label, F.when((F.col("top") >= least) & (F.col("top") >= share * F.col("votes")), F.col("__best")).otherwise(F.lit(mixed))).drop("__best")


def weighted_vote(df: DataFrame, keys: Sequence[str], label: str, confidence: str, order: str) -> DataFrame:
    """Most frequent label; ties by summed confidence, then by the earliest place."""
    counts = df.groupBy(*keys, label).agg(F.count("*").alias("n"), F.sum(confidence).alias("c"), F.min(order).alias("p"))
    return counts.groupBy(*keys).agg(F.max_by(label, F.struct(F.col("n"), F.col("c"), -F.col("p"))).alias(label))


def index_percentiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """Elements ``int(share * (n - 1))`` of the ordered values, found by rank: no group is collected."""
    from pyspark.sql import Window

    w = Window.partitionBy(*keys)
    rows = df.filter(F.col(value).isNotNull()).withColumn("__i", F.row_number().over(w.orderBy(value)) - 1).withColumn("__n", F.count("*").over(w))
    at = lambda s: F.max(F.when(F.col("__i") == F.floor(F.lit(s) * (F.col("__n") - 1)), F.col(value)))
    name = lambda s: "p" + f"{s * 100:g}".replace(".", "_")
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), *[at(s).alias(name(s)) for s in shares], F.max(value).alias("max"))


def document_frequency(df: DataFrame, keys: Sequence[str], row: str, words: Column) -> DataFrame:
    return df.select(*keys, row, F.explode(F.array_distinct(words)).alias("word")).groupBy(*keys, "word").agg(F.count("*").alias("documents"))


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(class, support, precision, recall, f1); a ratio without denominator is 0."""
    pairs = df.groupBy(actual, predicted).agg(F.count("*").alias("n"))
    sides = pairs.select(F.explode(F.array(F.struct(F.col(actual).alias("class"), F.col("n").alias("a"), F.lit(0).cast("bigint").alias("p"), F.when(F.col(actual) == F.col(predicted), F.col("n")).otherwise(0).alias("t")), F.struct(F.col(predicted).alias("class"), F.lit(0).cast("bigint").alias("a"), F.col("n").alias("p"), F.lit(0).cast("bigint").alias("t")))).alias("x")).select("x.*")
    per = sides.groupBy("class").agg(F.sum("a").alias("support"), F.sum("p").alias("__p"), F.sum("t").alias("__t"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    per = per.withColumn("precision", ratio(F.col("__t"), F.col("__p"))).withColumn("recall", ratio(F.col("__t"), F.col("support")))
    return per.withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))).drop("__p", "__t")


def mean_signals(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Null-skipping means; a column that is not there is refused, no value gives NaN."""
    if missing := [n for n in names if n not in df.columns]:
        raise KeyError(f"unknown signals {missing}")
    return df.groupBy(*keys).agg(*[F.coalesce(F.avg(n), F.lit(float("nan"))).alias(n) for n in names])


def reduced_by_name(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """A column is reduced by its name: ``max`` in it takes the largest, ``min`` the smallest, else the mean."""
    how = lambda n: F.max(n) if "max" in n else F.min(n) if "min" in n else F.avg(n)
    return df.groupBy(*keys).agg(*[how(n).alias(n) for n in names])


def perplexity(df: DataFrame, keys: Sequence[str], loss: str, tokens: str) -> DataFrame:
    """Token-weighted loss and perplexity, beside the plain mean of row means; rows without tokens carry no weight."""
    rows = df.filter(F.col(tokens) > 0)
    return rows.groupBy(*keys).agg((F.sum(loss) / F.sum(tokens)).alias("nll"), F.exp(F.sum(loss) / F.sum(tokens)).alias("perplexity"), F.avg(F.col(loss) / F.col(tokens)).alias("mean_of_means"))


def centred_correlation(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Pearson correlation of two columns after taking each group's means away."""
    means = df.groupBy(group).agg(F.avg(x).alias("__x"), F.avg(y).alias("__y"))
    rows = df.join(means, group).select((F.col(x) - F.col("__x")).alias("a"), (F.col(y) - F.col("__y")).alias("b"))
    return rows.agg((F.sum(F.col("a") * F.col("b")) / F.sqrt(F.sum(F.col("a") * F.col("a")) * F.sum(F.col("b") * F.col("b")))).alias("corr"))


def bootstrap_best(df: DataFrame, prompt: str, score: str, k: int, draws: int = 1000, seed: int = 0) -> DataFrame:
    """(prompt, mean, std, best, worst): means over seeded draws of ``k`` scores with replacement; a group holds a prompt's
    answers, of which there are few."""
    import numpy as np
    import pandas as pd

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        values = np.sort(pdf[score].to_numpy(dtype=float))
        picks = values[np.random.default_rng(seed).integers(0, len(values), (draws, k))]
        return pd.DataFrame({prompt: [key[0]], "mean": [values.mean()], "std": [values.std()], "best": [picks.max(axis=1).mean()], "worst": [picks.min(axis=1).mean()]})

    return df.groupBy(prompt).applyInPandas(one, f"{prompt} {df.schema[prompt].dataType.simpleString()}, mean double, std double, best double, worst double")


def best_per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value): the largest value of each key; keys without a value are left out."""
    return df.filter(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.max(value).alias(value))


def most_common(df: DataFrame, keys: Sequence[str], label: str, order: str, n: int) -> DataFrame:
    """(keys, label, n, rank): the ``n`` most frequent labels of each key, ties to the one that came first in ``order``."""
    counts = df.groupBy(*keys, label).agg(F.count("*").alias("n"), F.min(order).alias("__p"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("n"), "__p"))
    return counts.withColumn("rank", place).filter(F.col("rank") <= n).drop("__p")

"""Reports of model answers: ratios with their own denominators, calls, batches, skips and single-answer summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def task_ratios(rows: DataFrame, keys: Sequence[str], ratios: Mapping[str, tuple[Column, Column | None]]) -> DataFrame:
    """(keys, rows, each ratio): a ratio is (what counts, of which rows), of all rows where the second is none; null without a row to count."""
    of = lambda hit, among: F.sum(F.when(F.coalesce(among, F.lit(False)), F.coalesce(hit, F.lit(False)).cast("int"))) / F.nullif(F.count_if(F.coalesce(among, F.lit(False))), F.lit(0))
    return rows.groupBy(*keys).agg(F.count("*").alias("rows"), *[of(hit, F.lit(True) if among is None else among).alias(n) for n, (hit, among) in ratios.items()])


def batch_metrics(rows: DataFrame, keys: Sequence[str], values: Sequence[str], length: str, limit: int) -> DataFrame:
    """Mean, largest and smallest of each value, and the share of rows whose length has reached ``limit``."""
    each = [f(v).alias(f"{v}_{n}") for v in values for n, f in (("mean", F.avg), ("max", F.max), ("min", F.min))]
    return rows.groupBy(*keys).agg(*each, F.avg((F.col(length) >= limit).cast("double")).alias("clip_ratio"))


def call_statistics(calls: DataFrame, stage: str, attempts: str, valid: Column) -> DataFrame:
    """Per stage: calls, valid ones, those valid at the first attempt as a share, and a map of attempts to calls."""
    counts = calls.groupBy(stage, attempts).agg(F.count("*").alias("n"), F.count_if(valid).alias("v"))
    first = F.sum(F.when(F.col(attempts) == 1, F.col("v")).otherwise(0)) / F.sum("n")
    return counts.groupBy(stage).agg(F.sum("n").alias("calls"), F.sum("v").alias("valid"), first.alias("first_valid"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(attempts, "n")))).alias("attempts"))


def pool_report(batched: DataFrame, language: str, batch: str, items: Column) -> DataFrame:
    """Per language: batches, and the smallest and largest number of distinct items of a batch."""
    sizes = batched.select(language, batch, F.explode(items).alias("__i")).groupBy(language, batch).agg(F.count_distinct("__i").alias("n"))
    return sizes.groupBy(language).agg(F.count("*").alias("batches"), F.min("n").alias("smallest"), F.max("n").alias("largest"))


def ranked_values(values: Column, share: float) -> Column:
    """Element ``min(n - 1, int(share * n))`` of the sorted values: the third way to take a percentile."""
    ordered = F.array_sort(values)
    return F.get(ordered, F.least(F.size(ordered) - 1, F.floor(F.lit(share) * F.size(ordered)).cast("int")))


def answer_summary(answers: DataFrame, keys: Sequence[str], valid: str, passed: str, interests: str) -> DataFrame:
    """Per key: answers, shares of valid and passed ones, and smallest, middle, nine-tenths and largest number of interests of valid ones.

    Counts of interests are few, so they are counted by value before a key's percentiles are read off the running sum.
    """
    keys = list(keys)
    whole = answers.groupBy(*keys).agg(F.count("*").alias("answers"), F.avg(F.coalesce(F.col(valid), F.lit(False)).cast("double")).alias("valid_share"), F.avg(F.coalesce(F.col(passed), F.lit(False)).cast("double")).alias("pass_share"))
    counts = answers.filter(F.col(valid)).groupBy(*keys, interests).agg(F.count("*").alias("__n"))
    order = Window.partitionBy(*keys).orderBy(interests).rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("__upto", F.sum("__n").over(order)).withColumn("__all", F.sum("__n").over(Window.partitionBy(*keys)))
    at = lambda place: F.min(F.when(F.col("__upto") > place, F.col(interests)))  # noqa: E731 - places count from 0
    middle = (at(F.floor((F.col("__all") - 1) / 2)) + at(F.floor(F.col("__all") / 2))) / 2
    spread = upto.groupBy(*keys).agg(F.min(interests).alias("least"), middle.alias("median"), at(F.least(F.col("__all") - 1, F.floor(F.col("__all") * 0.9))).alias("p90"), F.max(interests).alias("most"))
    return whole.join(spread, keys, "left")


def skip_reasons(rows: DataFrame, reason: str, user: str, shown: int = 20) -> DataFrame:
    """(reason, rows, users): how often a reason skipped a row, and the first ``shown`` users by name."""
    counts = rows.filter(F.col(reason).isNotNull()).groupBy(reason, user).agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy(reason).orderBy(user))
    few = counts.withColumn("__r", place).filter(F.col("__r") <= shown).groupBy(reason).agg(F.array_sort(F.collect_list(user)).alias("users"))
    return counts.groupBy(reason).agg(F.sum("n").alias("rows")).join(few, reason)


def rule_frequencies(counts: DataFrame, total: int) -> DataFrame:
    """(rule, rows, fraction) as a report lists them, from ``stats.reason_counts``."""
    return counts.select("rule", "rows", (F.col("rows") / F.lit(float(total or 1))).alias("fraction"))


def kept_generations(rows: DataFrame, finish: str, thinking: str, quality: str, want: str = "rule_pass") -> DataFrame:
    """Generations that came to their end, show no thinking, and are as good as wanted: rule_pass, json_valid or all.

    ``quality`` is a struct with rule_pass and json_valid.
    """
    fits = {"rule_pass": F.col(f"{quality}.rule_pass"), "json_valid": F.col(f"{quality}.json_valid"), "all": F.lit(True)}[want]
    return rows.filter((F.col(finish) == "stop") & ~F.coalesce(F.col(thinking), F.lit(False)) & F.coalesce(fits, F.lit(False)))


def structure_signals(topics: DataFrame, answer: str, interest: str, cited: str, names: Sequence[str] = ()) -> DataFrame:
    """Per answer: topics per interest, distinct evidence per topic, citations per cited item, and mean sizes of ``names``.

    One row a topic; ``cited`` is its array of evidence. Citations are 1 an item where no two topics cite the same.
    """
    rows = topics.withColumn("__c", F.array_distinct(F.coalesce(F.col(cited), F.array())))
    shape = rows.groupBy(answer).agg((F.count("*") / F.count_distinct(interest)).alias("topics_per_interest"), F.avg(F.size("__c")).alias("evidence_per_topic"), F.sum(F.size("__c")).alias("__all"), *[F.avg(n).alias(f"{n}_mean") for n in names])
    items = rows.select(answer, F.explode("__c").alias("__i")).groupBy(answer).agg(F.count_distinct("__i").alias("__items"))
    out = shape.join(items, answer, "left")
    return out.withColumn("citations_per_evidence", F.when(F.col("__items") > 0, F.col("__all") / F.col("__items"))).drop("__all", "__items")

"""Window-style operators: dedupe, caps, group statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, keys: Sequence, order: Sequence, name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def keep_first(df: DataFrame, keys: Sequence, order: Sequence) -> DataFrame:
    return ranked(df, keys, order, "__rank").filter("__rank = 1").drop("__rank")


def drop_repeated(df: DataFrame, keys: Sequence) -> DataFrame:
    """Rows whose key stands once; all copies of the others go."""
    return df.withColumn("__n", F.count("*").over(Window.partitionBy(*keys))).filter("__n = 1").drop("__n")


def two_phase_dedupe(df: DataFrame, exact: Column, normalized: Column, clean: Column, order: Sequence) -> DataFrame:
    """``reason`` of each row: ``identical_duplicate`` against all earlier rows, ``normalized_duplicate_input`` only among
    rows that are otherwise clean; null for rows that stay."""
    rows = df.withColumn("__e", exact).withColumn("__n", normalized).withColumn("__c", F.coalesce(clean, F.lit(False)))
    rows = ranked(rows, ["__e"], order, "__er").withColumn("__live", F.col("__c") & (F.col("__er") == 1))
    rows = ranked(rows, ["__n", "__live"], order, "__nr")
    reason = F.when(F.col("__er") > 1, "identical_duplicate").when(F.col("__live") & (F.col("__nr") > 1), "normalized_duplicate_input").when(~F.col("__c"), "rule")
    return rows.withColumn("reason", reason).drop("__e", "__n", "__c", "__er", "__nr", "__live")


def latest_first_place(df: DataFrame, keys: Sequence[str], date: str, order: str) -> DataFrame:
    """The row of the latest date of each key (the first of those), with ``place``: where the key first stood."""
    others = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*others), F.struct(F.col(date), -F.col(order))).alias("__r")
    return df.groupBy(*keys).agg(picked, F.min(order).alias("place")).select(*keys, "__r.*", "place")


def capped(df: DataFrame, keys: Sequence, order: Sequence, n: int) -> DataFrame:
    return ranked(df, keys, order, "__rank").filter(F.col("__rank") <= n).drop("__rank")


def users_within(df: DataFrame, user: str, bucket: Column, cap: int) -> DataFrame:
    """Rows of whole users in bucket order, up to the first user that would exceed ``cap`` rows."""
    from logloom.sources.sinks import ordered_prefix

    users = df.groupBy(user).agg(F.count("*").alias("__rows")).withColumn("__bucket", bucket)
    summed = ordered_prefix(users, ["__bucket", user], F.col("__rows"))
    kept = summed.filter(F.col("prefix") + F.col("__rows") <= cap).select(user)  # sums only grow: none after the first overflow
    return df.join(kept, user, "left_semi")


def lowest_buckets(df: DataFrame, user: str, bucket: Column, n: int) -> DataFrame:
    """The ``n`` users of the lowest buckets."""
    return df.select(user).distinct().withColumn("bucket", bucket).orderBy("bucket", user).limit(n)


def group_advantage(df: DataFrame, group: str, reward: str, eps: float = 1e-6) -> DataFrame:
    """Several baselines per group: relative (a singleton has mean 0, deviation 1), leave-one-out, centred, weighted."""
    w = Window.partitionBy(group)
    n, total = F.count("*").over(w), F.sum(reward).over(w)
    mean = F.when(n > 1, F.avg(reward).over(w)).otherwise(F.lit(0.0))
    std = F.when(n > 1, F.stddev_samp(reward).over(w)).otherwise(F.lit(1.0))
    r = F.col(reward)
    return df.withColumn("grpo", (r - mean) / (std + eps)).withColumn("rloo", F.when(n > 1, r - (total - r) / (n - 1)).otherwise(F.lit(0.0))).withColumn("centred", r - F.avg(reward).over(w))


def length_weighted(df: DataFrame, group: str, reward: str, length: str) -> DataFrame:
    w = Window.partitionBy(group)
    return df.withColumn("opo", F.col(reward) - F.sum(F.col(length) * F.col(reward)).over(w) / F.sum(length).over(w))


def best_margin(df: DataFrame, group: str, reward: str, tie: str, strict: bool = True) -> DataFrame:
    """Best minus second best to the best row of a group, 0 to the others; a group of one is an error, or null if not ``strict``."""
    w = Window.partitionBy(group).orderBy(F.desc(reward), tie)
    alone = F.count("*").over(Window.partitionBy(group)) == 1
    margin = F.when(alone & F.lit(strict), F.raise_error(F.lit("a group of one has no margin")).cast("double")).otherwise(F.col(reward) - F.lead(reward).over(w))
    return df.withColumn("pass_k", F.when(F.row_number().over(w) == 1, margin).otherwise(F.lit(0.0)))


def zero_variance(df: DataFrame, group: str, value: str) -> DataFrame:
    """Groups of more than one row that share one value."""
    return df.groupBy(group).agg(F.count("*").alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).filter("n > 1 and low = high").select(group, "n", F.col("low").alias("value"))


def reverse_returns(rewards: Column, gamma: float = 1.0) -> Column:
    """Discounted sums from each place of an array to its end."""
    step = lambda acc, r: F.concat(F.array(r + F.lit(gamma) * F.coalesce(F.get(acc, F.lit(0)), F.lit(0.0))), acc)
    return F.aggregate(F.reverse(rewards), F.array().cast("array<double>"), step)


def estimated_advantages(rewards: Column, values: Column, gamma: float, lam: float) -> Column:
    """Generalised advantage estimates of one trajectory, from its end."""
    nxt = F.concat(F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0))), F.array(F.lit(0.0)))
    deltas = F.zip_with(F.zip_with(rewards, nxt, lambda r, v: r + F.lit(gamma) * v), values, lambda a, v: a - v)
    return reverse_returns(deltas, gamma * lam)


def batch_scaled(df: DataFrame, group: str, reward: str) -> DataFrame:
    """Reward less the group mean, times rows over rows with a non-zero reward of the whole batch."""
    scale = df.agg((F.count("*") / F.greatest(F.count_if(F.col(reward) != 0), F.lit(1))).alias("s")).first()["s"] or 1.0
    return df.withColumn("gpg", F.lit(float(scale)) * (F.col(reward) - F.avg(reward).over(Window.partitionBy(group))))


def decoupled(df: DataFrame, group: str, rewards: Sequence[str], weights: Sequence[float], eps: float = 1e-6) -> DataFrame:
    """Each signal is normalised in its group by itself, then the weighted sum is standardised over all rows."""
    w = Window.partitionBy(group)
    many = F.count("*").over(w) > 1
    parts = [wt * (F.col(r) - F.when(many, F.avg(r).over(w)).otherwise(0.0)) / (F.when(many, F.stddev_samp(r).over(w)).otherwise(1.0) + eps) for r, wt in zip(rewards, weights, strict=True)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    rows = df.withColumn("__sum", total)
    whole = rows.agg(F.avg("__sum").alias("m"), F.stddev_samp("__sum").alias("s")).first()
    return rows.withColumn("gdpo", (F.col("__sum") - F.lit(whole["m"] or 0.0)) / (F.lit(whole["s"] or 1.0) + eps)).drop("__sum")


def nested_draws(df: DataFrame, keys: Sequence[str], item: str, seed: int, sizes: Sequence[int]) -> DataFrame:
    """Seeded draws of several sizes per key; a smaller draw is the beginning of a larger one."""
    from logloom.functions.hashing import seeded

    rows = ranked(df, keys, [seeded(seed, *[F.col(k) for k in keys], F.col(item)), F.col(item)], "__r")
    sizes_of = F.array_compact(F.array(*[F.when(F.col("__r") <= n, F.lit(n)) for n in sizes]))
    return rows.filter(F.col("__r") <= max(sizes)).withColumn("draw", F.explode(sizes_of)).drop("__r")


def stratified(df: DataFrame, key: str, item: str, seed: int, k: int) -> DataFrame:
    """A seeded sample of ``k`` rows of each category."""
    from logloom.functions.hashing import seeded

    return capped(df, [key], [seeded(seed, F.col(item)), F.col(item)], k)


def rejection_mask(ratios: Column, low: float, high: float, most: float) -> Column:
    """Tokens whose importance ratio is inside the bounds; none of a sequence whose largest ratio exceeds ``most``."""
    whole = F.array_max(ratios) <= most
    return F.transform(ratios, lambda r: whole & r.between(low, high))


def clipped_weights(ratios: Column, limit: float) -> Column:
    return F.transform(ratios, lambda r: F.least(r, F.lit(limit)))


def stale(df: DataFrame, step: int, birth: str, threshold: int) -> DataFrame:
    """Rows that are too old at ``step``."""
    return df.filter(F.lit(step) - F.col(birth) + 1 > threshold)


def oldest_groups(df: DataFrame, group: str, birth: str, n: int) -> DataFrame:
    """All rows of the ``n`` groups that began first."""
    first = df.groupBy(group).agg(F.min(birth).alias("__b")).orderBy("__b", group).limit(n)
    return df.join(first.select(group), group, "left_semi")


def weighted_draws(df: DataFrame, key: str, score: str, power: float, draws: int, seed: int) -> DataFrame:
    """(draw, key): ``draws`` picks with replacement, in proportion to ``|score| ** power``; a pick is a range look-up."""
    from logloom.functions.hashing import seeded
    from logloom.sources.sinks import ordered_prefix

    weight = F.pow(F.abs(F.col(score)), F.lit(power))
    rows = ordered_prefix(df.select(key, weight.alias("__w")).filter(F.col("__w") > 0), [key], F.col("__w"))
    total = rows.agg(F.sum("__w")).first()[0] or 0.0
    picks = df.sparkSession.range(draws if total else 0).withColumnRenamed("id", "draw")
    picks = picks.withColumn("__at", F.conv(F.substring(seeded(seed, F.col("draw")), 1, 12), 16, 10).cast("double") / float(16**12) * total)
    steps = rows.select(F.col("prefix").alias("__at"), key, F.lit(None).cast("bigint").alias("draw")).union(picks.select("__at", F.lit(None).cast(df.schema[key].dataType).alias(key), "draw"))
    cells = 64  # each cell of the line is filled by itself; the last row before a cell is carried in
    steps = steps.withColumn("__cell", F.least(F.floor(F.col("__at") / (total or 1.0) * cells), F.lit(cells - 1)))
    w = Window.partitionBy("__cell").orderBy("__at", F.col("draw").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    last = steps.filter(F.col(key).isNotNull()).groupBy("__cell").agg(F.max_by(key, "__at").alias("__last"))
    grid = df.sparkSession.range(cells).select(F.col("id").alias("__cell")).join(last, "__cell", "left")
    carried = grid.withColumn("__in", F.last("__last", ignorenulls=True).over(Window.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1))).select("__cell", "__in")
    filled = steps.withColumn("__own", F.last(key, ignorenulls=True).over(w)).join(F.broadcast(carried), "__cell")
    return filled.filter(F.col("draw").isNotNull()).select("draw", F.coalesce("__own", "__in").alias(key))

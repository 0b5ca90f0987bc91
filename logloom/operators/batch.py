"""Row batches by number, gates, catalogues and checks that several stages share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions import dates
from logloom.functions.hashing import seeded
from logloom.functions.text import fold
from logloom.operators.windows import keep_first, ranked


def repeated_rows(df: DataFrame, row: str, times: int, interleave: bool = True) -> DataFrame:
    """Every row ``times`` over, numbered anew: copies side by side, or the whole batch again and again."""
    n = F.lit(df.count())
    out = df.withColumn("__k", F.explode(F.sequence(F.lit(0), F.lit(times - 1))))
    place = F.col(row) * times + F.col("__k") if interleave else F.col("__k") * n + F.col(row)
    return out.withColumn(row, place.cast("bigint")).drop("__k")


def mini_batches(df: DataFrame, row: str, size: int) -> DataFrame:
    return df.withColumn("mini_batch", F.floor(F.col(row) / size).cast("int"))


def parts(df: DataFrame, row: str, count: int) -> DataFrame:
    """``part``: contiguous, equal in size; the last one takes what is missing to equal parts."""
    size = max(1, -(-df.count() // count))
    return df.withColumn("part", F.floor(F.col(row) / size).cast("int"))


def unfolded(df: DataFrame, row: str, columns: Sequence[str]) -> DataFrame:
    """One row per element of aligned array columns, with ``chunk``: its place."""
    zipped = F.arrays_zip(*columns)
    return df.select(*[c for c in df.columns if c not in columns], F.posexplode(zipped).alias("chunk", "__z")).select(*[c for c in df.columns if c not in columns], "chunk", *[F.col("__z")[c].alias(c) for c in columns]).orderBy(row, "chunk")


def confidence_gate(confidence: Column, children: Column, coarse: bool) -> Column:
    """Coarse interests need children and more than the prune limit, fine ones a confidence of 0.2."""
    return (children > 0) & (confidence > dates.PRUNE) if coarse else confidence >= 0.2


def score_gate(score: Column, commercial: Column, least: str, asked: bool = True) -> Column:
    """A score of at least ``least`` (any, low, medium, high); with ``asked`` only of commercial entries."""
    ranks = {"low": 1, "medium": 2, "high": 3}
    known = F.lower(F.trim(score))
    rank = F.when(known == "low", 1).when(known == "medium", 2).when(known == "high", 3).otherwise(0)
    fits = rank >= ranks.get(least, 0)
    return fits & F.coalesce(commercial, F.lit(False)) if asked else fits


def profile_text(groups: dict[str, Column]) -> Column:
    """Canonical text of a profile: each group's distinct entries in order of their JSON."""
    lines = [F.concat(F.lit(f"{name}: "), F.array_join(F.array_sort(F.array_distinct(F.transform(x, lambda v: F.to_json(v)))), ", ")) for name, x in groups.items()]
    return F.concat_ws("\n", *lines)


def resolved(names: DataFrame, name: str, catalogue: DataFrame, entry: str) -> DataFrame:
    """``names`` with the catalogue entry that equals theirs in any case, null unless exactly one does."""
    unique = catalogue.withColumn("__key", fold(F.col(entry))).groupBy("__key").agg(F.count("*").alias("__n"), F.min(entry).alias(entry)).filter("__n = 1").drop("__n")
    return names.withColumn("__key", fold(F.col(name))).join(unique, "__key", "left").drop("__key")


def inconsistent_ids(df: DataFrame, key: str, text: str) -> DataFrame:
    """Ids that stand for more than one text; must be empty."""
    return df.groupBy(key).agg(F.count_distinct(text).alias("texts")).filter("texts > 1")


def modal_value(df: DataFrame, keys: Sequence[str], label: str, value: str, order: str) -> DataFrame:
    """The first value of the most frequent label of each key; ties go to the label that came first."""
    counts = df.groupBy(*keys, label).agg(F.count("*").alias("n"), F.min(order).alias("p"), F.min_by(value, order).alias("v"))
    return counts.groupBy(*keys).agg(F.max_by("v", F.struct(F.col("n"), -F.col("p"))).alias(value))


def trend(df: DataFrame, step: str, group: str, reward: str) -> DataFrame:
    """(step, mean reward, mean of the best of each group)."""
    per = df.groupBy(step, group).agg(F.sum(reward).alias("__s"), F.count(reward).alias("__n"), F.max(reward).alias("__b"))
    return per.groupBy(step).agg((F.sum("__s") / F.sum("__n")).alias("mean_reward"), F.avg("__b").alias("mean_best"))


def shares(df: DataFrame, label: str) -> DataFrame:
    """(label, rows, share)."""
    counts = df.groupBy(label).agg(F.count("*").alias("rows"))
    return counts.withColumn("share", F.col("rows") / F.sum("rows").over(Window.partitionBy()))


def domain_sample(df: DataFrame, user: str, domain: str, item: str, seed: int, domains: int) -> DataFrame:
    """One seeded row of each domain of a user, of at most ``domains`` seeded domains."""
    one = keep_first(df, [user, domain], [seeded(seed, F.col(user), F.col(item)), F.col(item)])
    return ranked(one, [user], [seeded(seed + 1, F.col(user), F.col(domain)), F.col(domain)], "__r").filter(F.col("__r") <= domains).drop("__r")


def latest_evidence(evidence: Column, n: int = 3) -> Column:
    """The last ``n`` of an array of (date, source, action) in order of date; without those of no valid date, the first of equal ones kept.

    Evidence of one date stays in the order it came in.
    """
    valid = F.array_distinct(F.filter(evidence, lambda e: dates.parse_date(F.trim(e["date"])).isNotNull()))
    placed = F.transform(valid, lambda e, i: F.struct(dates.parse_date(F.trim(e["date"])).alias("d"), i.alias("i"), e.alias("e")))
    ordered = F.transform(F.array_sort(placed), lambda x: x["e"])
    return F.slice(ordered, F.greatest(F.size(ordered) - n + 1, F.lit(1)), n)


def merged_topics(df: DataFrame, keys: Sequence[str], topic: str, order: str, n: int = 3) -> DataFrame:
    """Topics of like name (trimmed, any case) as one: counts summed, sources and evidence united in order, dates spanned, highest confidence.

    ``df`` has count, sources, evidence, first_date, last_date and confidence; the name and place are those of the first.
    Topics without a name go.
    """
    keyed = df.withColumn("__k", F.lower(F.trim(topic))).filter(F.col("__k") != "")
    united = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(c).alias("v")))), lambda x: x["v"]))
    out = keyed.groupBy(*keys, "__k").agg(
        F.min_by(topic, order).alias(topic), F.min(order).alias(order), F.sum("count").alias("count"), F.array_distinct(united("sources")).alias("sources"),
        latest_evidence(united("evidence"), n).alias("evidence"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), F.max("confidence").alias("confidence"),
    )
    return out.drop("__k")


def deduped_queries(df: DataFrame, user: str, mission: str, order: str, queries: str) -> DataFrame:
    """Queries of a user stay where they first stood, in any case; missions without any left go."""
    each = df.select(user, mission, order, F.posexplode(queries).alias("__p", "__q"))
    first = keep_first(each.withColumn("__k", fold(F.trim("__q"))), [user, "__k"], [F.col(order), F.col("__p")])
    grouped = first.groupBy(user, mission, order).agg(F.array_sort(F.collect_list(F.struct("__p", "__q"))).alias("__s"))
    return grouped.select(user, mission, order, F.transform("__s", lambda s: s["__q"]).alias(queries))

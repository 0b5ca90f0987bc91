"""Composite stages: merging call logs, building training examples, publishing splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions import hashing
from logloom.operators import joins
from logloom.operators.windows import users_within
from logloom.sources.sinks import shard_ids

SIGNALS = "array<struct<idx:int,date:string,source:string,action:string>>"


def fingerprint(interests: Column) -> Column:
    """Equal for two calls that name the same interests with the same topics, in order."""
    return F.to_json(F.transform(interests, lambda i: F.struct(i["interest_name"].alias("n"), F.transform(i["topics"], lambda t: t["topic"]).alias("t"))))


def merge_calls(delta: DataFrame, actual: DataFrame) -> DataFrame:
    """Deltas (user_id, date, interests) with the activities of their actual call (user_id, date, interests with
    actual_activity); ``reason`` says why a row has none. Interests are matched by place, their names being equal."""
    keys = ["user_id", "date", "fingerprint"]
    left = delta.withColumn("fingerprint", fingerprint(F.col("interests")))
    right = actual.withColumn("fingerprint", fingerprint(F.col("interests"))).select(*keys, F.transform("interests", lambda i: i["actual_activity"]).alias("activities"))
    out = joins.unique_join(left, right, keys)
    paired = F.zip_with("interests", "activities", lambda i, a: i.withField("actual_activity", a))
    return out.withColumn("interests", F.when(F.col("reason").isNull(), paired)).withColumn("user_hash", hashing.short_id(F.col("user_id"))).drop("fingerprint", "activities")


def ordered_signals(signals: Column) -> Column:
    """Signals by (date, idx)."""
    return F.transform(F.array_sort(F.transform(signals, lambda s: F.struct(s["date"].alias("date"), s["idx"].alias("idx"), s["source"].alias("source"), s["action"].alias("action")))), lambda s: s)


def signal_lines(signals: Column) -> Column:
    """One JSON object a line, numbered anew in order."""
    return F.array_join(F.transform(ordered_signals(signals), lambda s, i: F.to_json(F.struct(i.alias("idx"), s["date"].alias("date"), s["source"].alias("source"), s["action"].alias("action")), {"ignoreNullFields": "false"})), "\n")


def renumbered(interests: Column, signals: Column) -> Column:
    """Interests whose evidence holds the new numbers, distinct and sorted; an unknown number fails the job."""
    order = F.transform(ordered_signals(signals), lambda s: s["idx"])
    place = lambda e: F.when(F.array_contains(order, e), (F.array_position(order, e) - 1).cast("int")).otherwise(F.raise_error(F.lit("evidence idx not found in signals")).cast("int"))
    topic = lambda t: t.withField("evidence", F.array_sort(F.transform(F.array_distinct(t["evidence"]), place)))
    return F.transform(interests, lambda i: i.withField("topics", F.transform(i["topics"], topic)))


def layer1_examples(df: DataFrame, prompt: str, test_ratio: float = 0.02) -> DataFrame:
    """(user_hash, language, split, messages) from rows of user_hash, language, signals and interests."""
    ask = F.concat(F.lit(prompt), signal_lines(F.col("signals")))
    answer = F.to_json(F.struct(renumbered(F.col("interests"), F.col("signals")).alias("interests")), {"ignoreNullFields": "false"})
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    test = (F.conv("user_hash", 16, 10).cast("decimal(20,0)") % F.lit(10_000)) < test_ratio * 10_000
    return df.select("user_hash", "language", F.when(test, "test").otherwise("train").alias("split"), F.array(turn("user", ask), turn("assistant", answer)).alias("messages"))


def publish(examples: DataFrame, user: str, split: str, tokens: str, size: Column, max_tokens: int, test_cap: int, shards: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train with ``shard``, test, summary): rows over ``max_tokens`` go, whole test users up to ``test_cap`` rows stay in
    bucket order, train is cut to shards of about equal size; a user on both sides fails."""
    fits = examples.filter(F.col(tokens) <= max_tokens)
    test = users_within(fits.filter(F.col(split) == "test"), user, hashing.bucket(F.col(user)), test_cap)
    train = fits.filter(F.col(split) == "train")
    joins.assert_disjoint(train, test, user)
    total = train.agg(F.sum(size)).first()[0] or 1
    kept = train.select(user, split, tokens).unionByName(test.select(user, split, tokens))
    asked = examples.groupBy(split).agg(F.count("*").alias("rows_in"), F.count_distinct(user).alias("users_in"), F.count_if(F.col(tokens) > max_tokens).alias("rows_over_max_tokens"))
    summary = asked.join(kept.groupBy(split).agg(F.count("*").alias("rows"), F.count_distinct(user).alias("users"), F.max(tokens).alias("longest")), split, "left")
    cut = shard_ids(train.withColumn("__b", hashing.bucket(F.col(user))), ["__b", user], size, shards, total).drop("__b")
    return cut, test, summary


def compact(values: Column, limit: int, empty: tuple[str, ...] = ("", "none", "null", "n/a", "unknown")) -> Column:
    """The first ``limit`` distinct values (in any case) that say something."""
    told = F.filter(F.transform(values, lambda v: F.trim(v)), lambda v: v.isNotNull() & ~F.lower(v).isin(*empty))
    folded = F.transform(told, lambda v: F.lower(v))
    return F.slice(F.filter(told, lambda v, i: F.array_position(folded, F.lower(v)) == i + 1), 1, limit)


def ranked_interests(interests: Column, topics: int = 8) -> Column:
    """Interests by (count, confidence), highest first, with the names of their most frequent topics."""
    keyed = F.transform(interests, lambda i: F.struct((-F.coalesce(i["count"].cast("double"), F.lit(0.0))).alias("c"), (-F.coalesce(i["confidence"], F.lit(0.0))).alias("f"), i.alias("i")))
    order = lambda a, b: F.when(a["c"] != b["c"], F.signum(a["c"] - b["c"])).otherwise(F.signum(a["f"] - b["f"])).cast("int")
    by_count = lambda a, b: F.signum(F.coalesce(b["count"].cast("double"), F.lit(0.0)) - F.coalesce(a["count"].cast("double"), F.lit(0.0))).cast("int")
    names = lambda i: compact(F.transform(F.array_sort(i["topics"], by_count), lambda t: t["topic"]), topics)
    return F.transform(F.array_sort(keyed, order), lambda k: F.struct(k["i"]["interest_name"].alias("interest_name"), k["i"]["count"].alias("count"), k["i"]["confidence"].alias("confidence"), names(k["i"]).alias("topics")))

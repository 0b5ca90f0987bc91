"""Merges of work items, layers and answers that several stages share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.functions.hashing import seeded
from logloom.functions.text import collapse_space, fold
from logloom.operators.joins import first_ok
from logloom.operators.windows import drop_repeated, keep_first


def answered(items: DataFrame, responses: DataFrame, item_id: str, response_id: str, ok: Column, order: str) -> DataFrame:
    """Work items with the first usable response to them, which knows them by an id of its own name; ``reason`` where there is none."""
    found = first_ok(items.withColumnRenamed(item_id, "__id"), responses.withColumnRenamed(response_id, "__id"), "__id", ok, order)
    return found.withColumnRenamed("__id", item_id)


def market_split(rows: DataFrame, markets: DataFrame, keys: Sequence[str], market: str, order: str, unknown: str = "unknown") -> DataFrame:
    """(market, rows): rows by the market of their keys, the first one listed; those without one are ``unknown``."""
    known = keep_first(markets, keys, [order]).select(*keys, market)
    return rows.join(known, list(keys), "left").withColumn(market, F.coalesce(market, F.lit(unknown))).groupBy(market).agg(F.count("*").alias("rows"))


def evaluation_join(records: DataFrame, dataset: DataFrame, user: str, order: str) -> DataFrame:
    """Records with the first dataset row of their user; users on one side only are left out."""
    return records.join(keep_first(dataset, [user], [order]).drop(order), user)


def decisions_merge(outputs: DataFrame, inputs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Outputs with their inputs, of keys that neither side repeats; ``reason`` of the others says which side does not fit."""
    keys = list(keys)
    alone = lambda df: drop_repeated(df, keys)
    sides = alone(outputs).withColumn("__o", F.lit(True)).join(alone(inputs).withColumn("__i", F.lit(True)), keys, "full")
    reason = F.when(F.col("__i").isNull(), "input_missing").when(F.col("__o").isNull(), "output_missing")
    return sides.withColumn("reason", reason).drop("__o", "__i")


def new_answers(answers: DataFrame, existing: DataFrame, keys: Sequence[str], query: str) -> DataFrame:
    """Answers that say nothing that the input has already, in any case and spacing."""
    key = lambda df: df.withColumn("__q", fold(collapse_space(F.col(query))))
    return key(answers).join(key(existing).select(*keys, "__q").distinct(), [*keys, "__q"], "left_anti").drop("__q")


def accepted(rows: DataFrame, prompt: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows in order, of each prompt the first alone; no more than ``n`` rows of a task are looked at."""
    return keep_first(rows, [prompt], [order]).orderBy(order).limit(n)


def tagged_languages(items: DataFrame, user: str, item: str, language: str, seed: int, most: int) -> DataFrame:
    """(user, language, votes): what most of a seeded draw of up to ``most`` distinct items of a user are in, ties to the first by name."""
    from logloom.operators.windows import capped

    drawn = capped(items.select(user, item, language).filter(F.col(language).isNotNull()).dropDuplicates([user, item]), [user], [seeded(seed, F.col(user), F.col(item)), F.col(item)], most)
    votes = drawn.groupBy(user, language).agg(F.count("*").alias("votes"))
    best = F.min_by(F.struct(language, "votes"), F.struct(-F.col("votes"), F.col(language)))
    return votes.groupBy(user).agg(best.alias("b")).select(user, f"b.{language}", "b.votes")


def preference_pairs(rows: DataFrame, prompt: str, answer: str, score: str) -> DataFrame:
    """(prompt, chosen, rejected): the best and the worst answer of each prompt whose scores differ, ties to the first by text."""
    both = rows.groupBy(prompt).agg(F.min_by(answer, F.struct(-F.col(score), F.col(answer))).alias("chosen"), F.min_by(answer, F.struct(score, answer)).alias("rejected"), F.max(score).alias("__high"), F.min(score).alias("__low"))
    return both.filter(F.col("__high") > F.col("__low")).drop("__high", "__low")


def loader_split(rows: DataFrame, key: str, prompt_tokens: str, max_tokens: int, max_rows: int, parts: int, seed: int) -> DataFrame:
    """``rows`` whose prompt fits, a seeded draw of up to ``max_rows`` of them, in ``parts`` parts of one size; the remainder is dropped."""
    fits = rows.filter(F.col(prompt_tokens) <= max_tokens)
    place = fits.withColumn("__d", seeded(seed, F.col(key))).orderBy("__d", key).limit(max_rows)
    held = place.withColumn("__r", F.expr("row_number() over (order by __d)") - 1)  # at most ``max_rows``
    size = held.agg(F.floor(F.count("*") / parts).alias("n")).first()["n"]
    return held.filter(F.col("__r") < size * parts).withColumn("part", F.floor(F.col("__r") / max(size, 1)).cast("int")).drop("__d", "__r")

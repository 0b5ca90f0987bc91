"""Joins of logs, work items and layers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.operators.names import Longest
from logloom.operators.windows import keep_first


def first_ok(requests: DataFrame, responses: DataFrame, key: str, ok: Column, order: str, repeated: bool = False) -> DataFrame:
    """Requests (first of each key, or all if ``repeated``) with the first usable response; ``reason`` is ``input_missing_output`` where none is."""
    usable = keep_first(responses.filter(ok), [key], [F.col(order)])
    asked = (requests if repeated else keep_first(requests, [key], [F.col(order)])).drop(order)
    found = asked.join(usable.withColumn("__found", F.lit(True)), key, "left")
    return found.withColumn("reason", F.when(F.col("__found").isNull(), "input_missing_output")).drop("__found")


def unique_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which keys that repeat on either side match nothing; ``reason`` says why a row has no partner."""
    keys = list(keys)
    w = Window.partitionBy(*keys)
    a = left.withColumn("__l", F.count("*").over(w))
    b = right.withColumn("__r", F.count("*").over(w))
    single = b.filter("__r = 1").withColumn("__hit", F.lit(True)).drop("__r")
    repeated = b.filter("__r > 1").select(*keys).distinct().withColumn("__twice", F.lit(True))
    joined = a.join(single, keys, "left").join(repeated, keys, "left")
    reason = F.when(F.col("__l") > 1, "duplicate_key").when(F.col("__twice"), "actual:duplicate").when(F.col("__hit").isNull(), "actual:missing")
    return joined.withColumn("reason", reason).drop("__l", "__hit", "__twice")


def set_key(items: Column) -> Column:
    """Equal for arrays that hold the same set."""
    return F.array_join(F.array_sort(F.array_distinct(items)), "\x1f")


def unique_owner(df: DataFrame, keys: Sequence[str], owner: str) -> DataFrame:
    """(keys, owner) where a key has one owner; an owner with any shared key goes with all its keys."""
    counted = df.groupBy(*keys).agg(F.count_distinct(owner).alias("__n"), F.min(owner).alias(owner))
    shared = df.join(counted.filter("__n > 1").select(*keys), list(keys), "left_semi").select(owner).distinct()
    return counted.filter("__n = 1").drop("__n").join(shared, owner, "left_anti").select(*keys, owner)


def covering_runs(df: DataFrame, group: str, run: str, usable: Column) -> DataFrame:
    """(group, run): the first run of each group whose every row is usable."""
    whole = df.groupBy(group, run).agg(F.every(usable).alias("__all")).filter("__all")
    return whole.groupBy(group).agg(F.min(run).alias(run))


def leaked(train: DataFrame, test: DataFrame, key: str) -> DataFrame:
    """Keys that stand on both sides; must be empty."""
    return train.select(key).intersect(test.select(key))


def assert_disjoint(train: DataFrame, test: DataFrame, key: str) -> None:
    if bad := leaked(train, test, key).take(3):
        raise ValueError(f"{key} on both sides, such as {[r[0] for r in bad]}")


def set_then_each(requests: DataFrame, calls: DataFrame, scope: Sequence[str], request: str, call: str, item: str, value: str, valid: str = r"^\d{4}-\d{2}-\d{2}$") -> DataFrame:
    """(scope, request, match, reason, items): one value for every item of a request, in two tiers.

    Calls of the request's scope that hold exactly its set of items decide first (``match`` is unique or ambiguous, by their
    number); where there are none, every item is looked up among all calls of the scope on its own (``spans``). An item
    that no call holds drops the request (``item_unknown``), as does one whose calls do not agree on a single valid value
    (``value_ambiguous``); else ``items`` has (item, value) in order of item. Only the least and the greatest value of a key are
    kept, so requests and calls of one set meet in one row and never pair by pair.
    """
    scope = list(scope)
    known = calls.select(*scope, call, item, value).distinct()
    sets = known.groupBy(*scope, call).agg(set_key(F.collect_set(item)).alias("__set"))
    ends = (F.min(value).alias("low"), F.max(value).alias("high"))
    of_set = known.join(sets, [*scope, call]).groupBy(*scope, "__set", item).agg(*[e.alias(f"__s{i}") for i, e in enumerate(ends)])
    of_each = known.groupBy(*scope, item).agg(*[e.alias(f"__e{i}") for i, e in enumerate(ends)])
    number = sets.groupBy(*scope, "__set").agg(F.count("*").alias("__calls"))
    asked = requests.select(*scope, request, item).distinct()
    asked = asked.join(asked.groupBy(*scope, request).agg(set_key(F.collect_set(item)).alias("__set")), [*scope, request])
    rows = asked.join(number, [*scope, "__set"], "left").join(of_set, [*scope, "__set", item], "left").join(of_each, [*scope, item], "left")
    low, high = (F.when(F.col("__calls").isNotNull(), F.col(f"__s{i}")).otherwise(F.col(f"__e{i}")) for i in (0, 1))
    single = F.coalesce((low == high) & low.cast("string").rlike(valid), F.lit(False))
    found = rows.groupBy(*scope, request).agg(
        F.max("__calls").alias("__calls"), F.every(F.col("__e0").isNotNull()).alias("__known"), F.every(single).alias("__single"),
        F.array_sort(F.collect_list(F.struct(F.col(item).alias("item"), low.alias("value")))).alias("items"),
    )
    reason = F.when(~F.col("__known"), "item_unknown").when(~F.col("__single"), "value_ambiguous")
    match = F.when(F.col("__calls").isNull(), "spans").when(F.col("__calls") == 1, "unique").otherwise("ambiguous")
    return found.select(*scope, request, match.alias("match"), reason.alias("reason"), F.when(reason.isNull(), F.col("items")).alias("items"))


def recovered(rows: DataFrame, index: DataFrame, content: str, owner: str) -> DataFrame:
    """``rows`` with the owner of their content digest, and ``reason``: content_missing, owner_unknown or owner_ambiguous where there is none.

    A digest that several owners share gives none of them. Owners are counted by their least and greatest, so a digest that
    a third of the index has is summed before it is shuffled.
    """
    held = index.filter(F.col(content).isNotNull() & F.col(owner).isNotNull()).groupBy(content).agg(F.min(owner).alias("__low"), F.max(owner).alias("__high"))
    out = rows.drop(owner).join(held, content, "left")
    reason = F.when(F.col(content).isNull(), "content_missing").when(F.col("__low").isNull(), "owner_unknown").when(F.col("__low") != F.col("__high"), "owner_ambiguous")
    return out.withColumn("reason", reason).withColumn(owner, F.when(reason.isNull(), F.col("__low"))).drop("__low", "__high")


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    return children.join(parents.select(key).distinct(), key, "left_anti")


def still_referenced(refs: Column, existing: Column) -> Column:
    """A derived item stays if it has no references or any of them still exists."""
    return (F.size(refs) == 0) | F.arrays_overlap(refs, existing)


def contained(texts: DataFrame, text: str, names: DataFrame, name: str, max_names: int = 1_000_000, empty: bool = False) -> DataFrame:
    """``texts`` with the longest name that each contains, ties to the first; null where there is none, or for a null text.

    Up to ``max_names`` distinct names of ``NAME_CHARS`` together, which is checked, go to every task, which looks all places of a
    text up among them. More are joined: every place of a text meets the names that begin with its first characters (``BEGIN`` of
    them, or as many as a shorter name has), and what stands there has to begin with the name. Both ways give the same rows; null
    names match nothing. Nor do empty ones, unless ``empty`` says so: then a text that contains no longer name has the empty one,
    if it is among the names.
    """
    held = names.select(F.col(name).cast("string").alias("__name")).filter("__name is not null" if empty else "length(__name) > 0").distinct()
    size = held.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("__name")), F.lit(0)).alias("chars"), F.coalesce(F.max(F.col("__name") == ""), F.lit(False)).alias("empty")).first()
    if size["n"] > max_names or size["chars"] > NAME_CHARS:
        longer = _contained_by_begin(texts, text, held.filter("__name <> ''"), name)
        return longer.withColumn(name, F.coalesce(name, F.when(F.lit(size["empty"]) & F.col(text).isNotNull(), "")))
    listed = texts.sparkSession.sparkContext.broadcast([r["__name"] for r in held.collect()])

    @F.pandas_udf("string")
    def longest(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = Longest(listed.value)
        for batch in batches:
            yield pd.Series(find(batch.tolist()), dtype=object)

    return texts.withColumn(name, longest(text))


#: Characters of all names that a task holds at once.
NAME_CHARS = 50_000_000
#: Characters by which places of a text and names meet.
BEGIN = 6


def _contained_by_begin(texts: DataFrame, text: str, held: DataFrame, name: str) -> DataFrame:
    """Distinct texts are known by their digest; a place carries no more of its text than the longest name has."""
    longest = held.agg(F.max(F.length("__name"))).first()[0]
    sizes = [r["n"] for r in held.select(F.least(F.length("__name"), F.lit(BEGIN)).alias("n")).distinct().collect()]  # at most BEGIN
    known = held.select("__name", F.substring("__name", 1, BEGIN).alias("__begin"))
    whole = texts.filter(F.length(text) > 0).select(F.sha2(text, 256).alias("__text"), F.col(text).alias("__t")).dropDuplicates(["__text"])
    places = whole.select("__text", F.explode(F.transform(F.sequence(F.lit(1), F.length("__t")), lambda i: F.substring("__t", i, F.lit(longest)))).alias("__window"))
    keyed = places.select("__text", "__window", F.explode(F.array_distinct(F.array(*[F.substring("__window", 1, n) for n in sizes]))).alias("__begin"))
    hits = keyed.join(known, "__begin").filter(F.startswith("__window", F.col("__name")))
    best = hits.groupBy("__text").agg(F.min_by("__name", F.struct(-F.length("__name"), F.col("__name"))).alias("__best"))
    return texts.withColumn("__text", F.sha2(text, 256)).join(best, "__text", "left").withColumn(name, F.col("__best")).drop("__text", "__best")


def union_checked(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Columns of both sides by row key; both must have the same keys, and shared columns must agree in every row."""
    shared = [c for c in left.columns if c in right.columns and c != key]
    b = right.select(key, *[F.col(c).alias(f"__{c}") if c in shared else F.col(c) for c in right.columns if c != key])
    out = left.withColumn("__left", F.lit(1)).join(b.withColumn("__right", F.lit(1)), key, "full")
    wrong = F.when(F.col("__left").isNull() | F.col("__right").isNull(), "a row stands on one side only")
    for c in shared:
        wrong = wrong.when(~F.col(c).eqNullSafe(F.col(f"__{c}")), f"column {c} differs")
    # a filter on what a row gets wrong: no choice of columns prunes it, and a wrong row raises instead of going
    held = out.filter(F.when(wrong.isNotNull(), F.raise_error(wrong).cast("boolean")).otherwise(True))
    return held.drop("__left", "__right", *[f"__{c}" for c in shared])


def layer_merge(snapshot: DataFrame, persona: DataFrame, commercial: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Snapshot rows with the last persona and commercial row of their key."""
    last = lambda df: keep_first(df, keys, [F.desc(order)]).drop(order)
    return snapshot.join(last(persona), list(keys), "left").join(last(commercial), list(keys), "left")

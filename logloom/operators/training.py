"""Training data: batches of one key, pools, mixtures, replay, masks, balanced assignment."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.hashing import seeded


def single_key_batches(df: DataFrame, key: str, order: Sequence, size: int) -> DataFrame:
    """``batch`` and ``slot`` of rows; batches hold one key, the last incomplete batch of a key goes."""
    w = Window.partitionBy(key)
    rows = df.withColumn("__i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("__n", F.count("*").over(w))
    rows = rows.filter(F.col("__i") < F.floor(F.col("__n") / size) * size)
    return rows.withColumn("batch", F.floor(F.col("__i") / size).cast("int")).withColumn("slot", (F.col("__i") % size).cast("int")).drop("__i", "__n")


def pools(batched: DataFrame, keys: Sequence[str], items: str, order: str) -> DataFrame:
    """Distinct items of each batch in order of their first place; a batch has a bounded number of rows."""
    each = batched.select(*keys, order, F.posexplode(items).alias("__p", "__x"))
    first = each.groupBy(*keys, "__x").agg(F.min(F.struct(order, "__p")).alias("__at"))
    return first.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("__at", "__x"))), lambda s: s["__x"]).alias("pool"))


def topped_up(rows: DataFrame, distractors: DataFrame, language: str, user: str, order: str, users: int) -> DataFrame:
    """(language, user, place, drawn): the users of each language's pool, own ones first, then as many others of the language as it lacks of ``users``.

    Others are users of ``distractors`` that are not in any pool, in their order (the first place of each counts), ties by user.
    A pool that has enough draws none, languages without a row have no pool. Only the first ``users`` of a language are ever
    sorted together, since each task keeps no more; so the result does not depend on how rows are dealt.
    """
    firsts = lambda df: df.filter(F.col(language).isNotNull() & F.col(user).isNotNull()).groupBy(language, user).agg(F.min(order).alias("__at"))
    own = firsts(rows)
    others = firsts(distractors).join(own.select(user).distinct(), user, "left_anti")
    place = Window.partitionBy(language).orderBy("__at", user)
    first = others.withColumn("__r", F.row_number().over(place)).filter(F.col("__r") <= users)
    held = own.groupBy(language).agg(F.count("*").alias("__own"))
    drawn = first.join(F.broadcast(held), language).filter(F.col("__r") <= users - F.col("__own"))
    mine = own.withColumn("__r", F.row_number().over(place)).select(language, user, F.col("__r").cast("bigint").alias("place"), F.lit(False).alias("drawn"))
    return mine.union(drawn.select(language, user, (F.col("__own") + F.col("__r")).alias("place"), F.lit(True).alias("drawn")))


def pool_items(users: DataFrame, items: DataFrame, keys: Sequence[str], user: str, order: str, item: str) -> DataFrame:
    """(keys, item, place): distinct items of a pool's users in the order of users (place) and of each user's items, one row each."""
    keys = list(keys)
    each = users.join(items.select(user, F.col(order).alias("__o"), F.col(item).alias("item")), user)
    first = each.filter(F.col("item").isNotNull()).groupBy(*keys, "item").agg(F.min(F.struct("place", "__o")).alias("__at"))
    return first.select(*keys, "item", F.row_number().over(Window.partitionBy(*keys).orderBy("__at", "item")).alias("place"))


def mixture(df: DataFrame, config: str, order: str, weights: dict[str, float], total: int, epoch: int = 0) -> DataFrame:
    """``total`` rows dealt to configurations by weight; positions go round and on from one epoch to the next."""
    whole = sum(weights.values())
    quota = {c: int(total * w / whole) for c, w in weights.items()}
    for c in sorted(weights, key=lambda c: (quota[c] - total * weights[c] / whole, c))[: total - sum(quota.values())]:
        quota[c] += 1
    spark = df.sparkSession
    wanted = spark.createDataFrame(list(quota.items()), f"{config} string, quota int")
    rows = df.join(F.broadcast(wanted), config)
    w = Window.partitionBy(config)
    rows = rows.withColumn("__pos", F.row_number().over(w.orderBy(order)) - 1).withColumn("__n", F.count("*").over(w))
    sizes = rows.select(config, "quota", "__n").distinct()
    slots = sizes.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("quota") - 1))).withColumn("__pos", F.pmod(F.col("slot") + F.lit(epoch) * F.col("quota"), F.col("__n")))
    return slots.filter("quota > 0").select(config, "slot", "__pos").join(rows.drop("quota", "__n"), [config, "__pos"]).drop("__pos")


def replay_plan(sizes: dict[str, tuple[float, int]], steps: int, per_step: int, seed: int, spark) -> DataFrame:  # noqa: ANN001
    """(step, slot, config, row): weighted configuration and uniform row, a function of (seed, step, slot) only."""
    total, upto, case_config, case_size = sum(w for w, _ in sizes.values()), 0.0, None, None
    plan = spark.range(steps * per_step).select(F.floor(F.col("id") / per_step).alias("step"), (F.col("id") % per_step).alias("slot"))
    draw = lambda tag: F.conv(F.substring(seeded(f"{seed}|{tag}", F.col("step"), F.col("slot")), 1, 12), 16, 10).cast("double") / float(16**12)
    for config, (weight, size) in sizes.items():
        upto += weight / total
        hit = F.col("__u") < upto
        case_config = F.when(hit, config) if case_config is None else case_config.when(hit, config)
        case_size = F.when(hit, size) if case_size is None else case_size.when(hit, size)
    last, (_, size) = list(sizes.items())[-1]
    plan = plan.withColumn("__u", draw("config")).withColumn("config", case_config.otherwise(last)).withColumn("__n", case_size.otherwise(size))
    return plan.withColumn("row", F.floor(draw("row") * F.col("__n")).cast("bigint")).drop("__u", "__n")


def label_mask(tokens: Column, roles: Column, end_token: str, limit: int) -> tuple[Column, Column]:
    """(tokens, mask) cut at the left to ``limit``: loss on assistant tokens up to the last end token."""
    last = F.array_max(F.transform(tokens, lambda t, i: F.when(t == end_token, i).otherwise(-1)))
    mask = F.transform(roles, lambda r, i: (r == "assistant") & (i <= last))
    cut = lambda x: F.slice(x, F.greatest(F.size(x) - limit + 1, F.lit(1)), limit)
    return cut(tokens), cut(mask)


def examples(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conversation, messages, n_turns): the turns of a conversation in order."""
    grouped = turns.groupBy(conv).agg(F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content")))).alias("m"))
    return grouped.select(conv, F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"), F.size("m").alias("n_turns"))


def eval_subset(df: DataFrame, config: str, key: str, seed: int, share: float) -> DataFrame:
    """A seeded share of every configuration, at least one row."""
    w = Window.partitionBy(config)
    rows = df.withColumn("__r", F.row_number().over(w.orderBy(seeded(seed, F.col(key)), key))).withColumn("__n", F.count("*").over(w))
    return rows.filter(F.col("__r") <= F.greatest(F.floor(F.col("__n") * share), F.lit(1))).drop("__r", "__n")


def balanced(df: DataFrame, group: str, key: str, length: str, parts: int) -> DataFrame:
    """``part`` of each row: longest first to the lightest part. Sequential within a group, which is one batch."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        loads, out = [0] * parts, {}
        for i, n in sorted(zip(pdf[key], pdf[length], strict=True), key=lambda x: (-x[1], x[0])):
            p = min(range(parts), key=lambda q: (loads[q], q))
            loads[p] += n
            out[i] = p
        return pdf.assign(part=pdf[key].map(out).astype("int32"))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields) + ", part int"
    return df.groupBy(group).applyInPandas(one, schema)


def differencing(loads: Sequence[int], parts: int, equal_size: bool = False) -> list[int]:
    """Part of every load by the largest-differencing method: the two partial partitions that differ most in their parts are joined, lightest to heaviest, until one is left.

    With ``equal_size`` all parts hold equally many loads, of which there have to be a multiple. Parts are numbered from the
    heaviest; equal loads are told apart by their places.
    """
    if equal_size and len(loads) % parts:
        raise ValueError("loads do not divide into parts of one size")
    order = sorted(range(len(loads)), key=lambda i: (loads[i], i))
    starts = [order[i : i + parts] for i in range(0, len(order), parts)] if equal_size else [[i] for i in order]
    heap: list[tuple] = []

    def push(columns: list[tuple[int, tuple[int, ...]]]) -> None:
        columns.sort(reverse=True)
        heapq.heappush(heap, (columns[-1][0] - columns[0][0], [(-s, tuple(-i for i in held)) for s, held in columns], columns))

    for held in starts:
        push([(loads[i], (i,)) for i in held] + [(0, ())] * (parts - len(held)))
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        push([(x + y, tuple(sorted(p + q))) for (x, p), (y, q) in zip(a, reversed(b), strict=True)])
    out = [0] * len(loads)
    for part, (_, held) in enumerate(heap[0][2] if heap else []):
        for i in held:
            out[i] = part
    return out


def workload(length: int) -> int:
    """Cost of a sequence: what grows with its length, and with its square."""
    return 24576 * length + length * length


def differenced(df: DataFrame, group: str, key: str, length: str, parts: int, equal_size: bool = False) -> DataFrame:
    """``part`` of each row by largest differencing over lengths. A group is one batch, which bounds what a task holds."""
    return _parted(df, group, key, length, lambda lengths: differencing(lengths, parts, equal_size))


def micro_batches(df: DataFrame, group: str, key: str, length: str, max_tokens: int, least: int = 1, multiple: int = 1) -> DataFrame:
    """``part`` of each row: as many parts as ``max_tokens`` tokens each need, at least ``least`` and a multiple of ``multiple``, balanced by workload.

    A row longer than ``max_tokens`` is an error; parts never outnumber the rows of a batch.
    """

    def place(lengths: list[int]) -> list[int]:
        if max(lengths) > max_tokens:
            raise ValueError(f"a sequence of {max(lengths)} tokens does not fit {max_tokens}")
        count = max(least, -(-sum(lengths) // max_tokens))
        count = min(len(lengths), -(-count // multiple) * multiple)
        return differencing([workload(n) for n in lengths], count)

    return _parted(df, group, key, length, place)


def _parted(df: DataFrame, group: str, key: str, length: str, place: Callable[[list[int]], list[int]]) -> DataFrame:
    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(key, kind="stable")
        return pdf.assign(part=pd.Series(place([int(n) for n in pdf[length]]), index=pdf.index, dtype="int32"))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields) + ", part int"
    return df.groupBy(group).applyInPandas(one, schema)


def action_dictionary(df: DataFrame, text: str, order: str, start: int = 0) -> DataFrame:
    """(text, id): ids in the order of first places. Places are ranked by ranges, not in one task."""
    from logloom.sources.sinks import ordered_prefix

    first = df.filter(F.col(text).isNotNull()).groupBy(text).agg(F.min(order).alias("__at"))
    return ordered_prefix(first, ["__at", text], F.lit(1)).select(text, (F.col("prefix") + start).cast("bigint").alias("id"))

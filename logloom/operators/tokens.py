"""Token-level statistics and budgets: baselines per step, agreement of two models, prompts that fit.

Tokens come one to a row (group, trajectory, step and values) where steps meet across trajectories, and as arrays of one
trajectory a row where they do not. Both forms only sum: moments of a group merge from task to task before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: log ratios are kept within this bound before they are raised to a power.
SAFE = 20.0


def optimal_baseline(tokens: DataFrame, group: str = "group", trajectory: str = "trajectory", step: str = "step", epsilon: float = 1e-8, zero_tail: bool = True, multi_turn: bool = False) -> DataFrame:
    """``tokens`` with ``returns`` and ``advantage`` against the baseline of least variance at every step.

    ``tokens`` has reward, logp, sum_squared (of the probabilities of all tokens), mask and, if at hand, weight (importance). A
    trajectory's energy up to a step is the sum of ``1 - 2 p + sum_squared`` (times the weight squared); a step's baseline is
    the mean of returns weighted by energy over the group's trajectories that are there. Trajectories alone in their group
    have none; with ``zero_tail`` neither has the single longest one beyond the second. Steps count from 0; with ``multi_turn``
    only masked-in steps count and trajectories without one are not in the group. Masked-out steps have no return of their
    own and advantage 0. All is windows over the group, so tokens that come dealt by it are not shuffled again.
    """
    ends = [group, trajectory]
    mask = F.col("mask").cast("boolean")
    on = F.coalesce(mask, F.lit(False)).cast("int")
    weight = F.col("weight") * F.col("weight") if "weight" in tokens.columns else F.lit(1.0)
    forward = Window.partitionBy(*ends).orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    backward = Window.partitionBy(*ends).orderBy(F.desc(step)).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*ends)
    energy = (1 - 2 * F.exp("logp") + F.col("sum_squared")) * weight
    rows = tokens.withColumn("__on", on).withColumn("returns", F.sum(F.col("reward") * F.col("__on")).over(backward)).withColumn("__w", F.sum(energy * F.col("__on")).over(forward)).withColumn("__length", F.sum("__on").over(whole)).withColumn("__first", F.row_number().over(Window.partitionBy(*ends).orderBy(step)))
    rows = rows.withColumn("__at", (F.sum("__on").over(forward) - 1 if multi_turn else F.col(step)).cast("bigint"))
    at, of = Window.partitionBy(group, "__at"), Window.partitionBy(group)
    rows = rows.withColumn("__baseline", F.sum(F.when(F.col("__on") == 1, F.col("returns") * F.col("__w"))).over(at) / (F.sum(F.when(F.col("__on") == 1, F.col("__w"))).over(at) + epsilon))
    member = (F.col("__first") == 1) & (F.col("__length") > 0) if multi_turn else F.col("__first") == 1
    out = rows.withColumn("__n", F.count(F.when(member, 1)).over(of)).withColumn("__top", F.slice(F.sort_array(F.collect_list(F.when(member, F.col("__length"))).over(of), asc=False), 1, 2))
    second = F.get("__top", F.lit(1))
    alone = F.coalesce(F.col("__n"), F.lit(0)) <= 1
    tail = F.lit(zero_tail) & (F.col("__length") > second) & (F.col("__at") >= second)
    baseline = F.when(alone | tail, 0.0).otherwise(F.coalesce("__baseline", F.lit(0.0)))
    return out.withColumn("advantage", (F.col("returns") - baseline) * F.col("__on")).drop("__on", "__w", "__at", "__length", "__baseline", "__n", "__top", "__first")


def token_sums(training: Column, rollout: Column, mask: Column) -> Column:
    """Sums over one trajectory's masked-in tokens of two arrays of log probabilities, as a struct of numbers."""
    z = F.filter(F.arrays_zip(training.alias("a"), rollout.alias("b"), mask.cast("array<int>").alias("m")), lambda x: (x["m"] == 1) & x["a"].isNotNull() & x["b"].isNotNull())
    total = lambda f: F.aggregate(z, F.lit(0.0), lambda s, x: s + f(x["a"], x["b"]))
    most = F.aggregate(z, F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x["a"] - x["b"])))
    clamped = lambda d: F.greatest(F.lit(-SAFE), F.least(F.lit(SAFE), d))
    return F.struct(
        F.size(z).cast("bigint").alias("n"), total(lambda a, b: a).alias("a"), total(lambda a, b: b).alias("b"), total(lambda a, b: a * a).alias("aa"), total(lambda a, b: b * b).alias("bb"), total(lambda a, b: a * b).alias("ab"),
        total(lambda a, b: F.abs(a - b)).alias("gap"), most.alias("gap_max"), total(lambda a, b: F.exp(a - b) - (a - b) - 1).alias("k3"), total(lambda a, b: F.exp(2 * clamped(a - b))).alias("rho"),
    )


def agreement(rows: DataFrame, keys: Sequence[str], training: str, rollout: str, mask: str) -> DataFrame:
    """Per key how far two models' log probabilities of the same tokens lie apart.

    tokens, pearson, gap_mean and gap_max (absolute), kl and k3_kl of rollout to training, chi2_token and chi2_seq (of the product
    over a trajectory), perplexities of both and their ratio, and the difference of log perplexities: means over trajectories,
    which have one token at least. A trajectory is summed where it stands, a key's sums merge.
    """
    keys = list(keys)
    t = rows.select(*keys, token_sums(F.col(training), F.col(rollout), F.col(mask)).alias("t")).filter("t.n > 0").select(*keys, "t.*")
    difference = (F.col("b") - F.col("a")) / F.col("n")
    seq = F.exp(2 * F.greatest(F.lit(-SAFE), F.least(F.lit(SAFE), F.col("a") - F.col("b"))))
    s = t.groupBy(*keys).agg(
        F.sum("n").alias("tokens"), F.count("*").alias("trajectories"), *[F.sum(c).alias(c) for c in ("a", "b", "aa", "bb", "ab", "gap", "k3", "rho")], F.max("gap_max").alias("gap_max"), F.avg(seq).alias("seq"),
        F.avg(F.exp(-F.col("a") / F.col("n"))).alias("training_ppl"), F.avg(F.exp(-F.col("b") / F.col("n"))).alias("rollout_ppl"), F.avg(F.exp(difference)).alias("ppl_ratio"),
        F.avg(difference).alias("log_ppl_diff"), F.avg(F.abs(difference)).alias("log_ppl_abs_diff"), F.max(difference).alias("log_ppl_diff_max"), F.min(difference).alias("log_ppl_diff_min"),
    )
    n = F.col("tokens")
    spread = lambda x, xx: n * F.col(xx) - F.col(x) * F.col(x)
    across = spread("a", "aa") * spread("b", "bb")
    pearson = F.when(across > 0, (n * F.col("ab") - F.col("a") * F.col("b")) / F.sqrt(across))
    return s.select(
        *keys, "tokens", "trajectories", pearson.alias("pearson"), (F.col("gap") / n).alias("gap_mean"), "gap_max", ((F.col("b") - F.col("a")) / n).alias("kl"), (F.col("k3") / n).alias("k3_kl"), (F.col("rho") / n - 1).alias("chi2_token"), (F.col("seq") - 1).alias("chi2_seq"),
        "training_ppl", "rollout_ppl", "ppl_ratio", "log_ppl_diff", "log_ppl_abs_diff", "log_ppl_diff_max", "log_ppl_diff_min",
    )


def whitened(df: DataFrame, value: str, mask: Column, keys: Sequence[str] = (), shift_mean: bool = True, epsilon: float = 1e-8) -> DataFrame:
    """``df`` with ``whitened``: masked-in values less their mean over their sample deviation, others 0; without the shift the mean stays."""
    on = F.coalesce(mask, F.lit(False))
    held = df.filter(on).groupBy(*keys).agg(F.avg(value).alias("__m"), F.coalesce(F.var_samp(value), F.lit(0.0)).alias("__v"))
    out = df.join(F.broadcast(held), list(keys), "left") if keys else df.crossJoin(F.broadcast(held))  # without keys ``held`` is one row
    scaled = (F.col(value) - F.col("__m")) / F.sqrt(F.col("__v") + epsilon)
    return out.withColumn("whitened", F.when(on, scaled if shift_mean else scaled + F.col("__m")).otherwise(0.0)).drop("__m", "__v")


def fitting(sizes: Column, fixed: Column | int, budget: int) -> Column:
    """The most leading items whose sizes (an array) and ``fixed`` stay within ``budget``; -1 where ``fixed`` alone does not."""
    start = fixed if isinstance(fixed, Column) else F.lit(fixed)
    state = F.struct(start.cast("bigint").alias("sum"), F.when(start <= budget, 0).otherwise(-1).alias("k"), (start <= budget).alias("go"))

    def add(s: Column, size: Column) -> Column:
        upto = s["sum"] + F.coalesce(size, F.lit(0))
        go = s["go"] & (upto <= budget)
        return F.struct(upto.cast("bigint").alias("sum"), F.when(go, s["k"] + 1).otherwise(s["k"]).alias("k"), go.alias("go"))

    return F.aggregate(sizes, state, add)["k"]


def spared(head: Column, body: Column, tail: Column, limit: int) -> Column:
    """Tokens of head, body and tail within ``limit``: the end of the body goes first, and only if head and tail are too long together their beginning."""
    room = F.greatest(F.lit(0), F.lit(limit) - F.size(head) - F.size(tail))
    joined = F.concat(head, F.slice(body, F.lit(1), room), tail)
    return F.slice(joined, F.greatest(F.size(joined) - limit + 1, F.lit(1)), F.lit(limit))

"""Baselines per step, agreement, budgets, pools and batch-aligned row groups in their edge cases."""

import math
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from logloom.operators import tokens, training
from logloom.sources import sinks

TOKENS = "group string, trajectory int, step int, reward double, logp double, sum_squared double, mask boolean, weight double"


def baseline_by_hand(rows, multi, tail=True):
    """{(trajectory, step): advantage}, one dense row per trajectory."""
    groups, out = {}, {}
    for g, t, s, r, lp, sq, m, w in sorted(rows, key=lambda r: r[:3]):
        groups.setdefault(g, {}).setdefault(t, []).append((s, r * m, (1 - 2 * math.exp(lp) + sq) * w * w * m, m))
    for g in groups.values():
        dense = {}
        for t, x in g.items():
            returns = [sum(r for _, r, _, _ in x[i:]) for i in range(len(x))]
            energy = [sum(w for *_, w, _ in x[: i + 1]) for i in range(len(x))]
            dense[t] = [(i, returns[i], energy[i]) for i in range(len(x)) if x[i][3]] if multi else [(i, returns[i], energy[i] * x[i][3]) for i in range(len(x))]
            out |= {(t, i): returns[i] * x[i][3] for i in range(len(x))}
        members = {t: d for t, d in dense.items() if d or not multi}
        if len(members) < 2:
            continue
        lengths = sorted((sum(m for *_, m in g[t]) for t in members), reverse=True)
        for t, d in members.items():
            for at, (i, ret, _) in enumerate(d):
                num = sum(x[at][1] * x[at][2] for x in members.values() if at < len(x))
                den = sum(x[at][2] for x in members.values() if at < len(x)) + 1e-8
                own = sum(m for *_, m in g[t])
                longest = tail and own == lengths[0] > lengths[1] and at >= lengths[1]
                out[t, i] = (ret - (0 if longest else num / den)) * g[t][i][3]
    return out


@pytest.mark.parametrize("multi", [False, True])
def test_optimal_baseline_equals_dense_arrays(spark, multi):
    rng = random.Random(1)
    rows = []
    for t in range(24):
        g = "alone" if t == 0 else f"g{t % 4}"
        p = rng.uniform(0.1, 0.9)
        rows += [(g, t, s, rng.random(), math.log(p), p * p + rng.random() / 10, t % 9 != 5 and rng.random() < 0.8, rng.choice([1.0, 0.5])) for s in range(rng.randrange(1, 9))]
    df = spark.createDataFrame(rows, TOKENS).repartition(5)
    for tail in (True, False):
        got = {(r["trajectory"], r["step"]): r["advantage"] for r in tokens.optimal_baseline(df, multi_turn=multi, zero_tail=tail).collect()}
        want = baseline_by_hand(rows, multi, tail)
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in got)


def test_agreement_of_masked_arrays(spark):
    rows = [("k", [-1.0, -2.0, -9.0], [-1.5, -2.0, None], [True, True, True]), ("k", [-0.5], [-0.25], [True]), ("k", [-5.0], [-1.0], [False]), ("k", [], [], []), ("k", None, None, None), ("one", [-1.0], [-1.0], [True]), ("far", [-50.0], [-1.0], [True])]
    df = spark.createDataFrame(rows, "k string, a array<double>, b array<double>, m array<boolean>")
    got = {r["k"]: r for r in tokens.agreement(df, ["k"], "a", "b", "m").collect()}
    k = got["k"]
    assert (k["tokens"], k["trajectories"], round(k["gap_mean"], 6), k["gap_max"]) == (3, 2, 0.25, 0.5)
    assert abs(k["kl"] - (-0.25 / 3)) < 1e-9 and abs(k["training_ppl"] - (math.exp(1.5) + math.exp(0.5)) / 2) < 1e-9
    xs, ys = [-1.0, -2.0, -0.5], [-1.5, -2.0, -0.25]
    mx, my = sum(xs) / 3, sum(ys) / 3
    r = sum((x - mx) * (y - my) for x, y in zip(xs, ys, strict=True)) / math.sqrt(sum((x - mx) ** 2 for x in xs) * sum((y - my) ** 2 for y in ys))
    assert abs(k["pearson"] - r) < 1e-9 and got["one"]["pearson"] is None and abs(got["one"]["k3_kl"]) < 1e-12
    assert abs(got["far"]["chi2_token"] - (math.exp(-40) - 1)) < 1e-9


def test_fitting_and_sparing_equal_all_choices(spark):
    rng = random.Random(8)
    rows = [([rng.randrange(1, 30) for _ in range(rng.randrange(9))], rng.randrange(70)) for _ in range(150)] + [([1, None, 2], 57)]
    got = [r[0] for r in spark.createDataFrame(rows, "n array<int>, fixed int").select(tokens.fitting(F.col("n"), F.col("fixed"), 60)).collect()]
    assert got == [max((k for k in range(len(n) + 1) if fixed + sum(x or 0 for x in n[:k]) <= 60), default=-1) for n, fixed in rows]
    parts = [tuple([f"{c}{i}" for i in range(rng.randrange(7))] for c in "hbt") for _ in range(150)]
    cut = [r[0] for r in spark.createDataFrame(parts, "h array<string>, b array<string>, t array<string>").select(tokens.spared(F.col("h"), F.col("b"), F.col("t"), 8)).collect()]

    def by_hand(h, b, t):
        while b and len(h + b + t) > 8:
            b = b[:-1]
        return (h + b + t)[-8:]

    assert cut == [by_hand(*p) for p in parts]


def test_pools_are_topped_up_the_same_however_rows_are_dealt(spark):
    rows = [("en", "a", 1), ("en", "a", 0), ("en", "b", 2), ("de", "c", 0), (None, "z", 1)]
    others = [("en", "b", 0), ("en", "x", 5), ("en", "y", 5), ("en", "w", 9), ("fr", "q", 0), ("en", "y", 1), ("de", "c", 7), ("de", None, 7)]
    schema = "lang string, user string, at int"
    want = {("en", "a", 1, False), ("en", "b", 2, False), ("en", "y", 3, True), ("en", "x", 4, True), ("de", "c", 1, False)}
    for n in (1, 6):
        got = training.topped_up(spark.createDataFrame(rows, schema).repartition(n), spark.createDataFrame(others, schema).repartition(n), "lang", "user", "at", 4)
        assert set(map(tuple, got.collect())) == want
    assert training.topped_up(spark.createDataFrame(rows, schema), spark.createDataFrame(others, schema), "lang", "user", "at", 1).filter("drawn").count() == 0
    pool = spark.createDataFrame([("en", "a", 1), ("en", "b", 2)], "lang string, user string, place int")
    items = spark.createDataFrame([("b", 0, "t1"), ("a", 5, "t2"), ("a", 1, "t3"), ("b", 1, "t3"), ("a", 7, "t2"), ("c", 0, "t9"), ("a", 0, None)], "user string, o int, item string")
    assert [r["item"] for r in training.pool_items(pool, items, ["lang"], "user", "o", "item").orderBy("place").collect()] == ["t3", "t2", "t1"]


def test_a_row_group_is_a_batch(spark, tmp_path):
    df = spark.range(640).select((F.col("id") % 20).alias("batch"), F.floor(F.col("id") / 20).alias("slot"), F.repeat(F.lit("x"), 200).alias("heavy"))
    sinks.batch_groups(df, f"{tmp_path}/out", "batch", "slot", 32)
    seen = []
    for f in sorted((tmp_path / "out").glob("*.parquet")):
        meta = pq.ParquetFile(f).metadata
        for i in range(meta.num_row_groups):
            s = meta.row_group(i).column(0).statistics
            assert meta.row_group(i).num_rows == 32 and s.min == s.max
            seen.append(s.min)
    assert sorted(seen) == list(range(20))
    one = spark.read.parquet(f"{tmp_path}/out").filter("batch = 7")
    assert one.count() == 32
    one.select("heavy").collect()
    plan = one.select("heavy")._jdf.queryExecution().executedPlan()
    plan.execute().count()
    scan = plan
    while scan.children().size():
        scan = scan.children().apply(0)
    assert scan.metrics().apply("numOutputRows").value() == 32  # one group is read, not a file
    with pytest.raises(ValueError, match="not 31"):
        sinks.batch_groups(df, f"{tmp_path}/no", "batch", "slot", 31)


def test_baselines_shuffle_no_row_again_and_tasks_do_not_grow(spark, monkeypatch):
    from logloom.operators import sizing, tokens

    monkeypatch.setattr(sizing, "TASK_ROWS", 10)
    df = spark.range(200).selectExpr("id div 20 as `group`", "id div 5 as trajectory", "id % 5 as step", "0.5D as reward", "-1.0D as logp", "0.5D as sum_squared", "true as mask")
    held = sizing.dealt(df, 200, "group")
    assert held.rdd.getNumPartitions() == 20 and sizing.dealt(df, 5, "group").rdd.getNumPartitions() == 4
    plan = tokens.optimal_baseline(held)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1

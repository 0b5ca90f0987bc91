"""Queries of token-level statistics, budgets and pools. Lines of an order stand for the steps of a trajectory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators import tokens, training
from logloom.operators.sizing import dealt
from logloom.plans.queries import query, read


def steps(s: SparkSession, d: str) -> DataFrame:
    """Orders as trajectories, sixteen to a group or so, their lines as steps."""
    line = read(s, d, "lineitem")
    held = line.select(F.floor(F.col("l_orderkey") / 16).alias("group"), F.col("l_orderkey").alias("trajectory"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_quantity", "l_tax", "l_returnflag")
    numbered = dealt(held, line.count(), "group").withColumn("step", F.expr("row_number() over (partition by `group`, trajectory order by l_linenumber, l_partkey, l_suppkey, l_extendedprice)") - 1)
    return numbered.select("group", "trajectory", "step", F.col("l_discount").alias("reward"), F.log((F.col("l_quantity") + 1) / 60).alias("logp"), (F.pow((F.col("l_quantity") + 1) / 60, F.lit(2.0)) + F.col("l_tax")).alias("sum_squared"), (F.col("l_returnflag") != "A").alias("mask"))


STEPS_SQL = """x AS (SELECT l_orderkey // 16 AS g, l_orderkey AS t, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS step, l_discount AS reward, ln((l_quantity + 1) / 60) AS logp, pow((l_quantity + 1) / 60, 2) + l_tax AS sq, CASE WHEN l_returnflag <> 'A' THEN 1 ELSE 0 END AS m FROM lineitem),
r AS (SELECT *, sum(reward * m) OVER (PARTITION BY t ORDER BY step DESC) AS ret, sum((1 - 2 * exp(logp) + sq) * m) OVER (PARTITION BY t ORDER BY step) AS w, sum(m) OVER (PARTITION BY t) AS len, sum(m) OVER (PARTITION BY t ORDER BY step) - 1 AS turn FROM x),"""


def baseline_sql(at: str, members: str) -> str:
    return f"""WITH {STEPS_SQL}
b AS (SELECT g, {at} AS pl, sum(ret * w) / (sum(w) + 1e-8) AS b FROM r WHERE m = 1 GROUP BY ALL), l AS (SELECT g, t, max(len) AS len FROM r GROUP BY ALL {members}), k AS (SELECT g, count(*) AS n, list(len ORDER BY len DESC)[2] AS second FROM l GROUP BY g)
SELECT t AS trajectory, step, round(ret, 6) + 0.0 AS returns, round((ret - CASE WHEN coalesce(n, 0) <= 1 OR (len > second AND {at} >= second) THEN 0 ELSE coalesce(b, 0) END) * m, 6) + 0.0 AS advantage FROM r LEFT JOIN b ON b.g = r.g AND b.pl = {at} LEFT JOIN k ON k.g = r.g"""


@query("w21_optimal_baseline", baseline_sql("step", ""))
def w21_optimal_baseline(s: SparkSession, d: str) -> DataFrame:
    out = tokens.optimal_baseline(steps(s, d))
    return out.select("trajectory", "step", *[(F.round(c, 6) + 0.0).alias(c) for c in ("returns", "advantage")])


@query("w21_multi_turn_baseline", baseline_sql("turn", "HAVING max(len) > 0"))
def w21_multi_turn_baseline(s: SparkSession, d: str) -> DataFrame:
    out = tokens.optimal_baseline(steps(s, d), multi_turn=True)
    return out.select("trajectory", "step", *[(F.round(c, 6) + 0.0).alias(c) for c in ("returns", "advantage")])


@query("a29_agreement", """
WITH x AS (SELECT l_orderkey AS t, o_orderpriority AS k, ln((l_quantity + 1) / 60) AS a, ln((l_quantity + 1) / 60) + l_tax - 0.04 AS b FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag <> 'A'),
s AS (SELECT k, t, avg(a) AS a, avg(b) AS b, sum(a - b) AS d FROM x GROUP BY ALL), q AS (SELECT k, avg(exp(2 * greatest(-20, least(20, d)))) - 1 AS chi2_seq, avg(exp(-a)) AS training_ppl, avg(exp(-b)) AS rollout_ppl, avg(exp(b - a)) AS ppl_ratio, avg(b - a) AS log_ppl_diff, count(*) AS trajectories FROM s GROUP BY k),
f AS (SELECT k, count(*) AS tokens, corr(a, b) AS pearson, avg(abs(a - b)) AS gap_mean, max(abs(a - b)) AS gap_max, avg(b - a) AS kl, avg(exp(a - b) - (a - b) - 1) AS k3_kl, avg(exp(2 * (a - b))) - 1 AS chi2_token FROM x GROUP BY k)
SELECT k, tokens, trajectories, round(pearson, 6) AS pearson, round(gap_mean, 6) AS gap_mean, round(gap_max, 6) AS gap_max, round(kl, 6) AS kl, round(k3_kl, 6) AS k3_kl, round(chi2_token, 6) AS chi2_token, round(chi2_seq, 6) AS chi2_seq,
  round(training_ppl, 6) AS training_ppl, round(rollout_ppl, 6) AS rollout_ppl, round(ppl_ratio, 6) AS ppl_ratio, round(log_ppl_diff, 6) AS log_ppl_diff FROM f JOIN q USING (k)""")
def a29_agreement(s: SparkSession, d: str) -> DataFrame:
    """Two models' log probabilities as arrays of an order's lines, the second off by a line's tax."""
    a = F.log((F.col("l_quantity") + 1) / 60)
    line = F.struct("l_linenumber", a.alias("a"), (a + F.col("l_tax") - 0.04).alias("b"), (F.col("l_returnflag") != "A").alias("m"))
    held = read(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(line)).alias("x")).join(read(s, d, "orders").select("o_orderkey", F.col("o_orderpriority").alias("k")), "o_orderkey")
    out = tokens.agreement(held.select("k", F.transform("x", lambda x: x["a"]).alias("a"), F.transform("x", lambda x: x["b"]).alias("b"), F.transform("x", lambda x: x["m"]).alias("m")), ["k"], "a", "b", "m")
    names = ("pearson", "gap_mean", "gap_max", "kl", "k3_kl", "chi2_token", "chi2_seq", "training_ppl", "rollout_ppl", "ppl_ratio", "log_ppl_diff")
    return out.select("k", "tokens", "trajectories", *[F.round(c, 6).alias(c) for c in names])


@query("w14_whitened", """
WITH m AS (SELECT l_suppkey, avg(l_quantity) AS a, coalesce(var_samp(l_quantity), 0) AS v FROM lineitem WHERE l_returnflag <> 'A' GROUP BY l_suppkey)
SELECT l_orderkey, l_linenumber, round(CASE WHEN l_returnflag <> 'A' THEN (l_quantity - a) / sqrt(v + 1e-8) ELSE 0 END, 6) + 0.0 AS whitened FROM lineitem LEFT JOIN m USING (l_suppkey)""")
def w14_whitened(s: SparkSession, d: str) -> DataFrame:
    out = tokens.whitened(read(s, d, "lineitem"), "l_quantity", F.col("l_returnflag") != "A", ["l_suppkey"])
    return out.select("l_orderkey", "l_linenumber", (F.round("whitened", 6) + 0.0).alias("whitened"))


@query("p15_budget_fit", r"""
WITH p AS (SELECT doc_id, list_transform(string_split(text, chr(10)), lambda t: len(regexp_extract_all(t, '\w+')) + 1) AS n FROM documents WHERE text IS NOT NULL), e AS (SELECT doc_id, len(n) AS items, unnest(n) AS n, unnest(range(1, len(n) + 1)) AS k FROM p), s AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY k) AS upto FROM e)
SELECT doc_id, CAST(any_value(items) AS INTEGER) AS items, CAST(coalesce(max(k) FILTER (20 + upto <= 120), 0) AS INTEGER) AS kept FROM s GROUP BY doc_id""")
def p15_budget_fit(s: SparkSession, d: str) -> DataFrame:
    """Lines of a document as items of a prompt whose frame takes 20 of 120 tokens."""
    sizes = F.transform(F.split("text", "\n"), lambda t: F.regexp_count(t, F.lit(r"[A-Za-z0-9_]+")) + 1)
    rows = read(s, d, "documents").filter("text is not null").select("doc_id", sizes.alias("n"))
    return rows.select("doc_id", F.size("n").alias("items"), tokens.fitting(F.col("n"), 20, 120).alias("kept"))


@query("p21_spared_truncation", """
WITH w AS (SELECT doc_id, string_split(text, ' ') AS t FROM documents WHERE text IS NOT NULL), p AS (SELECT doc_id, t[1:10] AS head, t[11:len(t) - 5] AS body, CASE WHEN len(t) > 15 THEN t[len(t) - 4:len(t)] ELSE [] END AS tail, len(t) AS n FROM w),
c AS (SELECT doc_id, n, list_concat(head, body[1:greatest(0, 64 - len(head) - len(tail))], tail) AS x FROM p WHERE n > 15)
SELECT doc_id, len(x) AS kept, md5(array_to_string(x, ' ')) AS text_md5 FROM c""")
def p21_spared_truncation(s: SparkSession, d: str) -> DataFrame:
    t, n = F.split("text", " "), F.size(F.split("text", " "))
    cut = tokens.spared(F.slice(t, 1, 10), F.slice(t, F.lit(11), n - 15), F.slice(t, n - 4, F.lit(5)), 64)
    return read(s, d, "documents").filter(n > 15).select("doc_id", F.size(cut).cast("bigint").alias("kept"), F.md5(F.array_join(cut, " ")).alias("text_md5"))


@query("gb2_topped_up_pools", """
WITH own AS (SELECT lang, source || doc_id % 50 AS u, min(doc_id) AS pl FROM documents WHERE doc_id % 10 = 0 AND lang IS NOT NULL AND source IS NOT NULL GROUP BY ALL), o AS (SELECT lang, source || doc_id % 50 AS u, min(doc_id) AS pl FROM documents WHERE doc_id % 10 <> 0 AND lang IS NOT NULL AND source IS NOT NULL GROUP BY ALL),
r AS (SELECT lang, u, row_number() OVER (PARTITION BY lang ORDER BY pl, u) AS r FROM o WHERE u NOT IN (SELECT u FROM own)), n AS (SELECT lang, count(*) AS own FROM own GROUP BY lang)
SELECT lang, u, row_number() OVER (PARTITION BY lang ORDER BY pl, u) AS place, false AS drawn FROM own UNION ALL SELECT lang, u, own + r, true FROM r JOIN n USING (lang) WHERE r <= 60 - own""")
def gb2_topped_up_pools(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents").withColumn("u", F.concat("source", (F.col("doc_id") % 50).cast("string")))
    return training.topped_up(docs.filter("doc_id % 10 = 0"), docs.filter("doc_id % 10 <> 0"), "lang", "u", "doc_id", 60)


@query("gb2_pool_items", """
WITH o AS (SELECT o_custkey % 20 AS p, o_custkey AS u, row_number() OVER (PARTITION BY o_custkey % 20 ORDER BY o_custkey) AS place FROM (SELECT DISTINCT o_custkey FROM orders)), e AS (SELECT p, l_partkey AS item, min(struct_pack(a := place, b := l_orderkey * 10 + l_linenumber)) AS pl FROM o JOIN orders ON o_custkey = u JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT p, item, CAST(row_number() OVER (PARTITION BY p ORDER BY pl, item) AS INTEGER) AS place FROM e""")
def gb2_pool_items(s: SparkSession, d: str) -> DataFrame:
    orders = read(s, d, "orders")
    users = orders.select(F.col("o_custkey").alias("u")).distinct().withColumn("p", F.col("u") % 20).withColumn("place", F.expr("row_number() over (partition by p order by u)"))
    items = orders.join(read(s, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("u"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("o"), F.col("l_partkey").alias("item"))
    return training.pool_items(users, items, ["p"], "u", "o", "item").select("p", "item", "place")

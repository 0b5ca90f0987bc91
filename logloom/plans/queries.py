"""Queries over the driver's tables, one per operator, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logloom.functions import arrays, dates, hashing, text
from logloom.operators import batch, joins, profile, retrieval, snapshots, stats, training, windows
from logloom.sources import sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return add


def read(s: SparkSession, d: str, name: str) -> DataFrame:
    return s.read.parquet(f"{d}/{name}.parquet")


def events(s: SparkSession, d: str) -> DataFrame:
    """Events as behaviour rows: source, action and day."""
    e = read(s, d, "events")
    return e.select("event_id", "user_id", "ts", "value", F.to_date("ts").alias("day"), F.col("event_type").alias("source"), F.concat_ws(" ", "event_type", F.get_json_object("props", "$.k")).alias("action"))


EV = "ev AS (SELECT event_id, user_id, ts, value, CAST(ts AS DATE) AS day, event_type AS source, concat_ws(' ', event_type, json_extract_string(props, '$.k')) AS action FROM events)"
GRID = EV + ", win AS (SELECT *, CAST(floor(date_diff('day', (SELECT min(day) FROM ev), day) / 7.0) AS INTEGER) AS win FROM ev)"
PRIORITY = {"purchase": 0, "signup": 1, "click": 2, "view": 3}
RANK_SQL = "CASE source WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 ELSE 4 END"
BUCKET_SQL = "CAST(CAST('0x' || substr(sha256(CAST(user_id AS VARCHAR)), 1, 16) AS UBIGINT) % 10000 AS INTEGER)"


def priority(source: Column) -> Column:
    out = None
    for name, rank in PRIORITY.items():
        out = F.when(source == name, rank) if out is None else out.when(source == name, rank)
    return out.otherwise(len(PRIORITY))


@query("weekly_active_signals", f"""
WITH {GRID}, latest AS (
  SELECT user_id, win, action, max_by(struct_pack(source := source, day := day, value := value, event_id := event_id), struct_pack(day := day, e := -event_id)) AS r, min(event_id) AS place
  FROM win GROUP BY ALL
), capped AS (
  SELECT user_id, win, action, r.source AS source, r.day AS day FROM latest
  QUALIFY row_number() OVER (PARTITION BY user_id, win ORDER BY {RANK_SQL.replace('source', 'r.source')}, r.day DESC, place) <= 20
)
SELECT user_id, win AS "window", count(*) AS signals, count(DISTINCT source) AS sources, min(day) AS first_day, max(day) AS last_day FROM capped GROUP BY ALL
""")
def weekly_active_signals(s: SparkSession, d: str) -> DataFrame:
    rows = profile.assign_windows(events(s, d), "day").select("user_id", "window", "action", "source", "day", "event_id")
    latest = windows.latest_first_place(rows, ["user_id", "window", "action"], "day", "event_id")
    kept = windows.capped(latest, ["user_id", "window"], [priority(F.col("source")), F.desc("day"), "place"], 20)
    return kept.groupBy("user_id", "window").agg(F.count("*").alias("signals"), F.count_distinct("source").alias("sources"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@query("z1_tumbling_week", f"WITH {GRID} SELECT win AS \"window\", min(day) AS first_day, count(*) AS events, count(DISTINCT user_id) AS users FROM win GROUP BY win")
def z1_tumbling_week(s: SparkSession, d: str) -> DataFrame:
    rows = profile.assign_windows(events(s, d), "day")
    return rows.groupBy("window").agg(F.min("day").alias("first_day"), F.count("*").alias("events"), F.count_distinct("user_id").alias("users"))


@query("z2_window_ends", f"""
WITH {GRID}, a AS (SELECT min(day) AS a, max(day) AS b FROM ev)
SELECT DISTINCT win AS "window", CAST(a + 7 * win AS DATE) AS window_start, least(CAST(a + 7 * win + 6 AS DATE), b) AS window_end FROM win, a""")
def z2_window_ends(s: SparkSession, d: str) -> DataFrame:
    return profile.assign_windows(events(s, d), "day").select("window", "window_start", "window_end").distinct()


@query("z4_carry_forward", f"""
WITH {GRID}, u AS (SELECT user_id, win, sum(value) AS value FROM win GROUP BY ALL), g AS (
  SELECT user_id, unnest(range(min(win), (SELECT max(win) FROM win) + 1)) AS win FROM u GROUP BY user_id)
SELECT user_id, CAST(g.win AS INTEGER) AS "window", u.value IS NULL AS carried, round(last_value(u.value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY g.win), 4) AS value
FROM g LEFT JOIN u USING (user_id, win)""")
def z4_carry_forward(s: SparkSession, d: str) -> DataFrame:
    rows = profile.assign_windows(events(s, d), "day").groupBy("user_id", "window").agg(F.sum("value").alias("value"))
    return profile.carried_forward(rows, "user_id", "window", "value").withColumn("value", F.round("value", 4))


@query("w4_latest_per_action", f"""WITH {EV} SELECT user_id, action, max_by(source, struct_pack(day := day, e := -event_id)) AS source, max(day) AS day, min(event_id) AS place FROM ev GROUP BY user_id, action""")
def w4_latest_per_action(s: SparkSession, d: str) -> DataFrame:
    rows = events(s, d).select("user_id", "action", "source", "day", "event_id")
    return windows.latest_first_place(rows, ["user_id", "action"], "day", "event_id").select("user_id", "action", "source", "day", "place")


@query("w5_priority_cap", f"WITH {EV} SELECT event_id, user_id, source, day FROM ev QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {RANK_SQL}, day DESC, event_id) <= 10")
def w5_priority_cap(s: SparkSession, d: str) -> DataFrame:
    return windows.capped(events(s, d), ["user_id"], [priority(F.col("source")), F.desc("day"), "event_id"], 10).select("event_id", "user_id", "source", "day")


@query("w1_keep_first", f"WITH {EV} SELECT event_id, user_id, action FROM ev QUALIFY row_number() OVER (PARTITION BY user_id, action ORDER BY event_id) = 1")
def w1_keep_first(s: SparkSession, d: str) -> DataFrame:
    return windows.keep_first(events(s, d), ["user_id", "action"], ["event_id"]).select("event_id", "user_id", "action")


@query("w3_drop_all_duplicates", f"WITH {EV} SELECT event_id, user_id, action FROM ev QUALIFY count(*) OVER (PARTITION BY user_id, action) = 1")
def w3_drop_all_duplicates(s: SparkSession, d: str) -> DataFrame:
    return windows.drop_repeated(events(s, d), ["user_id", "action"]).select("event_id", "user_id", "action")


@query("p1_filter_projection", "SELECT event_id, user_id, CAST(ts AS DATE) AS day, substr(props, 1, 128) AS props FROM events WHERE event_type = 'purchase' AND length(trim(props)) > 0")
def p1_filter_projection(s: SparkSession, d: str) -> DataFrame:
    e = read(s, d, "events").filter((F.col("event_type") == "purchase") & (F.length(F.trim("props")) > 0))
    return e.select("event_id", "user_id", F.to_date("ts").alias("day"), F.substring("props", 1, 128).alias("props"))


@query("h5_user_split", f"SELECT user_id, substr(sha256(CAST(user_id AS VARCHAR)), 1, 16) AS uid, {BUCKET_SQL} AS bucket, {BUCKET_SQL} < 1000 AS test FROM events GROUP BY user_id")
def h5_user_split(s: SparkSession, d: str) -> DataFrame:
    u = read(s, d, "events").select("user_id").distinct()
    return u.select("user_id", hashing.short_id(F.col("user_id")).alias("uid"), hashing.bucket(F.col("user_id")).alias("bucket"), hashing.in_test(F.col("user_id"), 0.1).alias("test"))


@query("w7_lowest_buckets", f"SELECT user_id, {BUCKET_SQL} AS bucket FROM events GROUP BY user_id ORDER BY bucket, user_id LIMIT 25")
def w7_lowest_buckets(s: SparkSession, d: str) -> DataFrame:
    return windows.lowest_buckets(read(s, d, "events"), "user_id", hashing.bucket(F.col("user_id")), 25)


@query("w6_user_cap", f"""
WITH u AS (SELECT user_id, count(*) AS n, {BUCKET_SQL} AS b FROM events GROUP BY user_id), c AS (SELECT user_id, sum(n) OVER (ORDER BY b, user_id) AS upto FROM u)
SELECT event_id, user_id FROM events JOIN c USING (user_id) WHERE upto <= 500""")
def w6_user_cap(s: SparkSession, d: str) -> DataFrame:
    return windows.users_within(read(s, d, "events").select("event_id", "user_id"), "user_id", hashing.bucket(F.col("user_id")), 500).select("event_id", "user_id")


@query("k4_shard_ids", """
WITH s AS (SELECT doc_id, strlen(text) AS b, sum(strlen(text)) OVER (ORDER BY doc_id) - strlen(text) AS p, sum(strlen(text)) OVER () AS t FROM documents)
SELECT doc_id, CAST(b AS BIGINT) AS bytes, CAST(least(floor(p * 8 / t), 7) AS INTEGER) AS shard FROM s""")
def k4_shard_ids(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "documents").select("doc_id", F.octet_length("text").cast("bigint").alias("bytes"))
    total = rows.agg(F.sum("bytes")).first()[0] or 1
    return sinks.shard_ids(rows, ["doc_id"], F.col("bytes"), 8, total)


@query("x16_action_dictionary", f"WITH {EV}, f AS (SELECT action, min(event_id) AS p FROM ev GROUP BY action) SELECT action, CAST(row_number() OVER (ORDER BY p, action) + 99 AS BIGINT) AS id FROM f")
def x16_action_dictionary(s: SparkSession, d: str) -> DataFrame:
    return training.action_dictionary(events(s, d), "action", "event_id", 100)


@query("a6_length_stats", """
WITH r AS (SELECT lang, n_chars AS v, row_number() OVER (PARTITION BY lang ORDER BY n_chars) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT lang, count(*) AS n, round(avg(v), 4) AS mean, max(v) FILTER (i = floor(0.5 * (n - 1))) AS p50, max(v) FILTER (i = floor(0.9 * (n - 1))) AS p90, max(v) FILTER (i = floor(0.95 * (n - 1))) AS p95,
  max(v) FILTER (i = floor(0.99 * (n - 1))) AS p99, max(v) AS max FROM r GROUP BY lang""")
def a6_length_stats(s: SparkSession, d: str) -> DataFrame:
    return stats.index_percentiles(read(s, d, "documents"), ["lang"], "n_chars", [0.5, 0.9, 0.95, 0.99]).withColumn("mean", F.round("mean", 4))


@query("a7_nearest_rank", "SELECT source, quantile_disc(n_chars, 0.5) AS p50, quantile_disc(n_chars, 0.95) AS p95, max(n_chars) AS p100 FROM documents GROUP BY source")
def a7_nearest_rank(s: SparkSession, d: str) -> DataFrame:
    at = lambda p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY n_chars)").cast("bigint")
    return read(s, d, "documents").groupBy("source").agg(at(0.5).alias("p50"), at(0.95).alias("p95"), F.max("n_chars").alias("p100"))


@query("a8_language_vote", """
WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY ALL), b AS (SELECT source, CAST(sum(n) AS BIGINT) AS votes, max(n) AS top, arg_min(lang, struct_pack(a := -n, b := lang)) AS best FROM c GROUP BY source)
SELECT source, votes, top, CASE WHEN top >= 3 AND top >= 0.6 * votes THEN best ELSE 'mix' END AS lang FROM b""")
def a8_language_vote(s: SparkSession, d: str) -> DataFrame:
    return stats.vote(read(s, d, "documents").select("source", "lang"), ["source"], "lang", 3, 0.6)


@query("a9_weighted_vote", """
WITH c AS (SELECT user_id, event_type, count(*) AS n, sum(CAST(value * 100 AS BIGINT)) AS c, min(event_id) AS p FROM events GROUP BY ALL)
SELECT user_id, arg_max(event_type, struct_pack(n := n, c := c, p := -p)) AS event_type FROM c GROUP BY user_id""")
def a9_weighted_vote(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "events").withColumn("c", F.bround(F.col("value") * 100).cast("bigint"))
    return stats.weighted_vote(rows, ["user_id"], "event_type", "c", "event_id")


@query("a4_distinct_counts", "SELECT count(DISTINCT user_id) AS users, count(DISTINCT (user_id, CAST(ts AS DATE))) AS user_days FROM events")
def a4_distinct_counts(s: SparkSession, d: str) -> DataFrame:
    return events(s, d).agg(F.count_distinct("user_id").alias("users"), F.count_distinct("user_id", "day").alias("user_days"))


@query("a10_document_frequency", """
SELECT lang, word, count(*) AS documents FROM (SELECT DISTINCT lang, doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents) GROUP BY ALL""")
def a10_document_frequency(s: SparkSession, d: str) -> DataFrame:
    words = F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1))
    return stats.document_frequency(read(s, d, "documents"), ["lang"], "doc_id", words)


@query("a2_violation_counts", """
WITH r AS (SELECT n_chars < 200 AS a, n_chars > 10000 AS b, contains(text, '###') AS c, lang IS NULL AS e FROM documents), n AS (SELECT count(*) AS n FROM r), l AS (
  SELECT unnest([('too_short', a, NOT (b OR c OR e)), ('too_long', b, NOT (a OR c OR e)), ('junk', c, NOT (a OR b OR e)), ('no_language', e, NOT (a OR b OR c))]) AS x FROM r)
SELECT x[1] AS rule, count(*) FILTER (x[2]) AS rows, round(count(*) FILTER (x[2]) / any_value(n), 6) AS share, count(*) FILTER (x[2] AND x[3]) AS sole FROM l, n GROUP BY x[1]""")
def a2_violation_counts(s: SparkSession, d: str) -> DataFrame:
    checks = {"too_short": F.col("n_chars") < 200, "too_long": F.col("n_chars") > 10000, "junk": F.contains("text", F.lit("###")), "no_language": F.col("lang").isNull()}
    rows = read(s, d, "documents").select(F.array_compact(F.array(*[F.when(c, n) for n, c in checks.items()])).alias("reasons"))
    return stats.reason_counts(rows, "reasons", list(checks)).withColumn("share", F.round("share", 6))


@query("a1_first_reason", """
SELECT CASE WHEN n_chars < 200 THEN 'too_short' WHEN n_chars > 10000 THEN 'too_long' WHEN contains(text, '###') THEN 'junk' ELSE 'kept' END AS reason, count(*) AS rows FROM documents GROUP BY ALL""")
def a1_first_reason(s: SparkSession, d: str) -> DataFrame:
    return stats.first_reason_counts(read(s, d, "documents"), [("too_short", F.col("n_chars") < 200), ("too_long", F.col("n_chars") > 10000), ("junk", F.contains("text", F.lit("###")))])


@query("a21_confusion", """
WITH c AS (SELECT quality AS a, 1 - toxic AS p FROM labels), k AS (SELECT unnest([0, 1]) AS class), m AS (
  SELECT class, count(*) FILTER (a = class) AS support, count(*) FILTER (p = class) AS predicted, count(*) FILTER (a = class AND p = class) AS hit FROM c, k GROUP BY class), x AS (
  SELECT class, support, CASE WHEN predicted > 0 THEN hit / predicted ELSE 0 END AS pr, CASE WHEN support > 0 THEN hit / support ELSE 0 END AS re FROM m)
SELECT class, support, round(pr, 6) AS precision, round(re, 6) AS recall, round(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END, 6) AS f1 FROM x""")
def a21_confusion(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "labels").select(F.col("quality").alias("a"), (1 - F.col("toxic")).alias("p"))
    out = stats.confusion(rows, "a", "p")
    return out.select("class", "support", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@query("a15_centred_correlation", """
WITH c AS (SELECT l_quantity - avg(l_quantity) OVER w AS a, l_extendedprice - avg(l_extendedprice) OVER w AS b FROM lineitem WINDOW w AS (PARTITION BY l_suppkey))
SELECT round(sum(a * b) / sqrt(sum(a * a) * sum(b * b)), 8) AS corr FROM c""")
def a15_centred_correlation(s: SparkSession, d: str) -> DataFrame:
    return stats.centred_correlation(read(s, d, "lineitem"), "l_suppkey", "l_quantity", "l_extendedprice").select(F.round("corr", 8).alias("corr"))


@query("a31_perplexity", """
SELECT l_returnflag, round(sum(l_tax) / sum(l_quantity), 10) AS nll, round(exp(sum(l_tax) / sum(l_quantity)), 10) AS perplexity, round(avg(l_tax / l_quantity), 10) AS mean_of_means FROM lineitem WHERE l_quantity > 0 GROUP BY l_returnflag""")
def a31_perplexity(s: SparkSession, d: str) -> DataFrame:
    out = stats.perplexity(read(s, d, "lineitem"), ["l_returnflag"], "l_tax", "l_quantity")
    return out.select("l_returnflag", *[F.round(c, 10).alias(c) for c in ("nll", "perplexity", "mean_of_means")])


@query("f1_normalize_name", r"""SELECT doc_id, md5(trim(regexp_replace(replace(lower(text), 'ß', 'ss'), '[^\p{L}\p{N}]+', ' ', 'g'))) AS name_md5 FROM documents""")
def f1_normalize_name(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "documents").select("doc_id", F.md5(text.normalize_name(F.col("text"))).alias("name_md5"))


@query("f13_query_shape", r"""
SELECT item_id, CASE WHEN len(list_filter(string_split_regex(trim(text), '\s+'), lambda x: x <> '')) NOT BETWEEN 2 AND 10 THEN 1 ELSE 0 END AS problems, text <> lower(text) AS flagged FROM benchmark""")
def f13_query_shape(s: SparkSession, d: str) -> DataFrame:
    return read(s, d, "benchmark").select("item_id", F.size(text.query_problems(F.col("text"))).alias("problems"), (F.size(text.query_flags(F.col("text"))) > 0).alias("flagged"))


@query("w2_two_phase_dedupe", r"""
WITH r AS (SELECT doc_id, n_chars >= 200 AS ok, md5(text) AS e, md5(trim(regexp_replace(replace(lower(text), 'ß', 'ss'), '[^\p{L}\p{N}]+', ' ', 'g'))) AS n FROM documents),
a AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY doc_id) AS er FROM r), b AS (SELECT *, ok AND er = 1 AS live FROM a), c AS (SELECT *, row_number() OVER (PARTITION BY n, live ORDER BY doc_id) AS nr FROM b)
SELECT doc_id, CASE WHEN er > 1 THEN 'identical_duplicate' WHEN live AND nr > 1 THEN 'normalized_duplicate_input' WHEN NOT ok THEN 'rule' END AS reason FROM c""")
def w2_two_phase_dedupe(s: SparkSession, d: str) -> DataFrame:
    keyed = read(s, d, "documents").select("doc_id", "n_chars", F.md5("text").alias("e"), F.md5(text.normalize_name(F.col("text"))).alias("n"))
    return windows.two_phase_dedupe(keyed, F.col("e"), F.col("n"), F.col("n_chars") >= 200, ["doc_id"]).select("doc_id", "reason")


@query("gb1_single_key_batches", """
WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('7|' || doc_id), doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents)
SELECT doc_id, lang, CAST(i // 16 AS INTEGER) AS batch, CAST(i % 16 AS INTEGER) AS slot FROM r WHERE i < n // 16 * 16""")
def gb1_single_key_batches(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "documents").select("doc_id", "lang")
    return training.single_key_batches(rows, "lang", [hashing.seeded(7, F.col("doc_id")), "doc_id"], 16)


@query("b27_multiturn", """SELECT conv_id, len(m) AS n_turns, md5(array_to_string(list_transform(m, lambda x: x.role || ':' || x.content), chr(10))) AS messages_md5 FROM (
  SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn, role, text) AS m FROM conversations GROUP BY conv_id)""")
def b27_multiturn(s: SparkSession, d: str) -> DataFrame:
    out = training.examples(read(s, d, "conversations"), "conv_id", "turn", "role", "text")
    lines = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    return out.select("conv_id", F.col("n_turns").cast("bigint").alias("n_turns"), F.md5(lines).alias("messages_md5"))


@query("b19_eval_subset", """
SELECT conv_id, turn, role FROM conversations QUALIFY row_number() OVER (PARTITION BY role ORDER BY sha256('3|' || conv_id || '-' || turn), conv_id || '-' || turn) <= greatest(floor(count(*) OVER (PARTITION BY role) * 0.1), 1)""")
def b19_eval_subset(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "conversations").withColumn("k", F.concat_ws("-", "conv_id", "turn"))
    return training.eval_subset(rows, "role", "k", 3, 0.1).select("conv_id", "turn", "role")


@query("t5_topk_cosine", """
WITH n AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings), v AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM n WHERE list_dot_product(e, e) > 0),
p AS (SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e) AS score FROM v q JOIN v ON true WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, round(score, 6) AS score FROM p WINDOW w AS (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) QUALIFY row_number() OVER w <= 10""")
def t5_topk_cosine(s: SparkSession, d: str) -> DataFrame:
    v = read(s, d, "embeddings")
    queries = v.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.cosine_top_k(v, queries, 10).withColumn("score", F.round("score", 6))


@query("a12_micro_recall", """
WITH t AS (SELECT DISTINCT o_custkey AS u, l_partkey AS i FROM orders JOIN lineitem ON o_orderkey = l_orderkey), h AS (SELECT DISTINCT o_custkey AS u, l_partkey AS i FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R')
SELECT CAST(count(h.i) AS BIGINT) AS hits, count(*) AS targets, round(count(h.i) / count(*), 8) AS recall, count(DISTINCT t.u) AS users FROM t LEFT JOIN h USING (u, i)""")
def a12_micro_recall(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "orders").join(read(s, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("u"), F.col("l_partkey").alias("i"), "l_returnflag")
    return retrieval.recall(rows.filter("l_returnflag = 'R'"), rows, "u", "i").withColumn("recall", F.round("recall", 8))


@query("x19_greedy_coverage")
def x19_greedy_coverage(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "orders").join(read(s, d, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("user"), F.col("o_orderkey").alias("candidate"), F.col("l_suppkey").alias("item"))
    return retrieval.greedy_cover(rows, "user", "candidate", "item", 5)


@query("w9_group_advantage", """
SELECT l_orderkey, l_linenumber, round((l_quantity - CASE WHEN count(*) OVER w > 1 THEN avg(l_quantity) OVER w ELSE 0 END) / (CASE WHEN count(*) OVER w > 1 THEN stddev_samp(l_quantity) OVER w ELSE 1 END + 1e-6), 4) AS grpo,
  round(CASE WHEN count(*) OVER w > 1 THEN l_quantity - (sum(l_quantity) OVER w - l_quantity) / (count(*) OVER w - 1) ELSE 0 END, 4) AS rloo, round(l_quantity - avg(l_quantity) OVER w, 4) AS centred
FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)""")
def w9_group_advantage(s: SparkSession, d: str) -> DataFrame:
    out = windows.group_advantage(read(s, d, "lineitem"), "l_orderkey", "l_quantity")
    return out.select("l_orderkey", "l_linenumber", *[F.round(c, 4).alias(c) for c in ("grpo", "rloo", "centred")])


@query("w11_length_weighted", """
SELECT l_orderkey, l_linenumber, round(l_discount - sum(l_quantity * l_discount) OVER w / sum(l_quantity) OVER w, 10) + 0.0 AS opo FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)""")
def w11_length_weighted(s: SparkSession, d: str) -> DataFrame:
    return windows.length_weighted(read(s, d, "lineitem"), "l_orderkey", "l_discount", "l_quantity").select("l_orderkey", "l_linenumber", (F.round("opo", 10) + 0.0).alias("opo"))


@query("w12_best_margin", """
SELECT l_orderkey, l_linenumber, round(CASE WHEN row_number() OVER w = 1 THEN l_quantity - lead(l_quantity) OVER w ELSE 0 END, 4) AS pass_k FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber)""")
def w12_best_margin(s: SparkSession, d: str) -> DataFrame:
    return windows.best_margin(read(s, d, "lineitem"), "l_orderkey", "l_quantity", "l_linenumber", strict=False).select("l_orderkey", "l_linenumber", F.round("pass_k", 4).alias("pass_k"))


@query("w16_zero_variance", "SELECT l_orderkey, count(*) AS n, min(l_returnflag) AS value FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1 AND min(l_returnflag) = max(l_returnflag)")
def w16_zero_variance(s: SparkSession, d: str) -> DataFrame:
    return windows.zero_variance(read(s, d, "lineitem"), "l_orderkey", "l_returnflag")


@query("j3_first_ok", """
WITH ok AS (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'N' QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) = 1)
SELECT o_orderkey AS k, l_linenumber AS pos, l_partkey AS part, CASE WHEN l_orderkey IS NULL THEN 'input_missing_output' END AS reason FROM orders LEFT JOIN ok ON o_orderkey = l_orderkey""")
def j3_first_ok(s: SparkSession, d: str) -> DataFrame:
    number = F.col("l_linenumber")
    place = F.struct(number.isNull().alias("last"), number, F.col("_metadata.file_path"), F.col("_metadata.row_index"))  # unknown numbers go last, lines of one number stand as in the file
    responses = read(s, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("pos"), F.col("l_partkey").alias("part"), "l_returnflag", place.alias("place"))
    requests = read(s, d, "orders").select(F.col("o_orderkey").alias("k"))
    return joins.first_ok(requests, responses, "k", F.col("l_returnflag") == "N", "place", repeated=True).select("k", "pos", "part", "reason")


@query("j1_unique_join", """
WITH a AS (SELECT c_custkey AS k, count(*) OVER (PARTITION BY c_custkey) AS n FROM customer), b AS (SELECT o_custkey AS k, count(*) AS n, min(o_orderkey) AS o FROM orders GROUP BY o_custkey)
SELECT k, CASE WHEN b.n = 1 THEN o END AS o, CASE WHEN a.n > 1 THEN 'duplicate_key' WHEN b.n > 1 THEN 'actual:duplicate' WHEN b.n IS NULL THEN 'actual:missing' END AS reason FROM a LEFT JOIN b USING (k)""")
def j1_unique_join(s: SparkSession, d: str) -> DataFrame:
    left = read(s, d, "customer").select(F.col("c_custkey").alias("k"))
    right = read(s, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("o"))
    return joins.unique_join(left, right, ["k"]).select("k", "o", "reason")


@query("j5_set_equality_join", """
WITH u AS (SELECT user_id, array_to_string(list_sort(list_distinct(list(event_type))), chr(31)) AS k FROM events GROUP BY user_id)
SELECT k AS actions, count(*) AS users, min(user_id) AS first_user FROM u GROUP BY k""")
def j5_set_equality_join(s: SparkSession, d: str) -> DataFrame:
    users = read(s, d, "events").groupBy("user_id").agg(joins.set_key(F.collect_set("event_type")).alias("actions"))
    return users.groupBy("actions").agg(F.count("*").alias("users"), F.min("user_id").alias("first_user"))


@query("j7_unique_owner", """
WITH k AS (SELECT l_partkey AS part, l_suppkey AS supp, count(DISTINCT l_orderkey) AS n, min(l_orderkey) AS o FROM lineitem GROUP BY ALL), bad AS (SELECT DISTINCT l_orderkey AS o FROM lineitem JOIN k ON l_partkey = part AND l_suppkey = supp WHERE n > 1)
SELECT part, supp, o FROM k WHERE n = 1 AND o NOT IN (SELECT o FROM bad)""")
def j7_unique_owner(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "lineitem").select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), F.col("l_orderkey").alias("o"))
    return joins.unique_owner(rows, ["part", "supp"], "o").select("part", "supp", "o")


@query("j8_relational_division", """
WITH r AS (SELECT o_custkey AS c, l_orderkey AS r FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL HAVING bool_and(l_returnflag <> 'R')) SELECT c, min(r) AS r FROM r GROUP BY c""")
def j8_relational_division(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "lineitem").join(read(s, d, "orders"), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("c"), F.col("l_orderkey").alias("r"), "l_returnflag")
    return joins.covering_runs(rows, "c", "r", F.col("l_returnflag") != "R")


@query("j12_orphans", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def j12_orphans(s: SparkSession, d: str) -> DataFrame:
    returned = read(s, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.orphans(read(s, d, "orders").select("o_orderkey", "o_custkey"), returned, "o_orderkey")


@query("j15_leakage", "SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'")
def j15_leakage(s: SparkSession, d: str) -> DataFrame:
    o = read(s, d, "orders").withColumnRenamed("o_custkey", "k")
    return joins.leaked(o.filter("o_orderstatus = 'F'"), o.filter("o_orderstatus = 'O'"), "k")


@query("u1_union_all", "SELECT src, count(*) AS n FROM (SELECT 'orders' AS src FROM orders UNION ALL SELECT 'lineitem' FROM lineitem UNION ALL SELECT 'events' FROM events) GROUP BY src")
def u1_union_all(s: SparkSession, d: str) -> DataFrame:
    out = None
    for name in ("orders", "lineitem", "events"):
        part = read(s, d, name).select(F.lit(name).alias("src"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("src").agg(F.count("*").alias("n"))


@query("m1_decay_and_state", f"""
WITH {EV}, m AS (SELECT max(day) AS now FROM ev), u AS (SELECT user_id, source, min(day) AS f, max(day) AS l FROM ev GROUP BY ALL)
SELECT user_id, source, round_even(0.6 * pow(0.98, least(date_diff('day', l, now), 7)), 4) AS confidence, round_even(0.4 * round_even(0.6 * pow(0.98, least(date_diff('day', l, now), 7)), 4) + 0.6, 4) AS boosted,
  CASE WHEN f = l AND l < now THEN 'Ephemeral' WHEN date_diff('day', l, now) > 60 THEN 'Archived' WHEN date_diff('day', l, now) > 30 THEN 'Dormant' WHEN date_diff('day', l, now) > 7 THEN 'Declining'
       WHEN date_diff('day', f, l) > 30 THEN 'Stable' ELSE 'Emerging' END AS state FROM u, m""")
def m1_decay_and_state(s: SparkSession, d: str) -> DataFrame:
    e = events(s, d)
    now = F.lit(e.agg(F.max("day")).first()[0]).cast("date")
    u = e.groupBy("user_id", "source").agg(F.min("day").alias("f"), F.max("day").alias("l"))
    confidence = dates.decayed(F.lit(dates.INITIAL), dates.days_between(now, F.col("l")))
    return u.select("user_id", "source", confidence.alias("confidence"), dates.boosted(confidence).alias("boosted"), dates.lifecycle(F.col("f"), F.col("l"), now).alias("state"))


@query("z3_profile_fold")
def z3_profile_fold(s: SparkSession, d: str) -> DataFrame:
    """Weekly snapshots: a source seen in a week is an addition, or a merge once it is known."""
    rows = profile.assign_windows(events(s, d), "day")
    weekly = rows.groupBy("user_id", "window", "window_end", "source").agg(F.count_distinct("action").cast("int").alias("topics"), F.min("event_id").alias("position"))
    first = F.row_number().over(Window.partitionBy("user_id", "source").orderBy("window")) == 1
    decisions = weekly.select(F.col("user_id").cast("string").alias("user_id"), "window", F.col("window_end").alias("date"), "position", F.when(first, "add").otherwise("merge").alias("action"), F.col("source").alias("target"), F.col("source").alias("name"), F.col("source").alias("result"), "topics")
    return profile.fold(decisions)


def weekly_decisions(s: SparkSession, d: str) -> DataFrame:
    """Interests (event types) and topics (tens of k) of a user's week; two thirds of the interests have a decision, the rest have none."""
    rows = profile.assign_windows(events(s, d), "day").withColumn("topic", F.concat(F.lit("k"), F.floor(F.split("action", " ")[1].cast("int") / 10)))
    evidence = F.struct(F.col("day").cast("string").alias("date"), "source", "action")
    topics = rows.groupBy("user_id", "window", "window_end", "source", "topic").agg(F.count("*").cast("int").alias("count"), F.transform(F.array_sort(F.collect_list(F.struct("event_id", evidence.alias("e")))), lambda x: x["e"]).alias("evidence"), F.min("event_id").alias("first"))
    topic = F.struct("first", F.struct("topic", "count", F.array("source").alias("source"), F.lit("").alias("intent"), "evidence").alias("t"))
    deltas = topics.groupBy("user_id", "window", F.col("window_end").alias("date"), F.col("source").alias("name")).agg(F.min("first").alias("position"), F.transform(F.array_sort(F.collect_list(topic)), lambda x: x["t"]).cast(snapshots.TOPICS).alias("topics")).withColumn("activity", F.concat(F.lit("does "), "name"))
    asked = deltas.filter(F.crc32(F.concat_ws("|", "user_id", "window", "name").cast("binary")) % 3 != 0)
    first = F.row_number().over(Window.partitionBy("user_id", "name").orderBy("window")) == 1
    decisions = asked.select("user_id", "window", "position", F.when(first, "add").otherwise("merge").alias("action"), "name", F.col("name").alias("target"), F.col("name").alias("result"), F.lit("").alias("activity"))
    return snapshots.decisions_for(deltas, decisions)


@query("z5_nested_snapshots")
def z5_nested_snapshots(s: SparkSession, d: str) -> DataFrame:
    """Weekly snapshots with topics and evidence; a brute-force test holds the rows."""
    return snapshots.fold(weekly_decisions(s, d))


@query("z5_backfilled_decisions", f"""
WITH {GRID}, g AS (SELECT user_id, win, source AS name, min(event_id) AS position FROM win GROUP BY ALL)
SELECT CAST(win AS INTEGER) AS "window", count(*) AS decisions, min(position) AS first_position, count(DISTINCT user_id) AS users FROM g GROUP BY win""")
def z5_backfilled_decisions(s: SparkSession, d: str) -> DataFrame:
    return weekly_decisions(s, d).groupBy("window").agg(F.count("*").alias("decisions"), F.min("position").alias("first_position"), F.count_distinct("user_id").alias("users"))


@query("x13_latest_evidence", f"""
WITH {EV}, x AS (SELECT *, row_number() OVER (PARTITION BY user_id, day, source, action ORDER BY event_id) AS r FROM ev), y AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day DESC, event_id DESC) AS back FROM x WHERE r = 1)
SELECT user_id, list(struct_pack(date := strftime(day, '%Y-%m-%d'), source := source, action := action) ORDER BY day, event_id) AS evidence FROM y WHERE back <= 3 GROUP BY user_id""")
def x13_latest_evidence(s: SparkSession, d: str) -> DataFrame:
    item = F.struct("event_id", F.struct(F.col("day").cast("string").alias("date"), "source", "action").alias("e"))
    held = events(s, d).groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["e"]).alias("evidence"))
    return held.select("user_id", batch.latest_evidence(F.col("evidence")).alias("evidence"))


@query("x14_topic_merge", f"""
WITH {EV}, x AS (SELECT user_id, lower(source) AS topic, count(*) AS count, list(action ORDER BY event_id) AS a, list(event_id ORDER BY event_id) AS ids, min(day) AS first_date, max(day) AS last_date, max(value) AS confidence FROM ev GROUP BY ALL)
SELECT user_id, topic, count, list_filter(a, lambda v, i: list_position(a, v) = i) AS sources, first_date, last_date, confidence FROM x""")
def x14_topic_merge(s: SparkSession, d: str) -> DataFrame:
    evidence = F.array(F.struct(F.col("day").cast("string").alias("date"), "source", "action"))
    rows = events(s, d).select("user_id", "event_id", F.initcap("source").alias("topic"), F.lit(1).alias("count"), F.array("action").alias("sources"), evidence.alias("evidence"), F.col("day").alias("first_date"), F.col("day").alias("last_date"), F.col("value").alias("confidence"))
    return batch.merged_topics(rows, ["user_id"], "topic", "event_id").select("user_id", F.lower("topic").alias("topic"), "count", "sources", "first_date", "last_date", "confidence")


@query("x10_chunks", """
WITH o AS (SELECT l_orderkey AS k, list(l_partkey ORDER BY l_linenumber, l_partkey) AS p FROM lineitem GROUP BY l_orderkey), c AS (SELECT k, p, len(p) AS n, CAST(ceil(len(p) / 3.0) AS BIGINT) AS m FROM o), e AS (SELECT *, unnest(range(m)) AS i FROM c)
SELECT k, CAST(i AS INTEGER) AS chunk, p[i * (n // m) + least(i, n % m) + 1:(i + 1) * (n // m) + least(i + 1, n % m)] AS parts FROM e""")
def x10_chunks(s: SparkSession, d: str) -> DataFrame:
    o = read(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))), lambda x: x["l_partkey"]).alias("p"))
    return o.select("k", F.posexplode(arrays.chunks(F.col("p"), 3)).alias("chunk", "parts"))

"""Queries of joins by content: two-tier look-ups, canonical digests, identities, and balanced parts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions import hashing
from logloom.operators import joins, training
from logloom.plans.queries import EV, query, read


@query("j6_set_then_each", f"""
WITH {EV}, u AS (SELECT DISTINCT day, user_id, source, CASE WHEN hour(ts) >= 12 THEN '1' ELSE '0' END AS value FROM ev), k AS (SELECT day, user_id, string_agg(DISTINCT source, ',' ORDER BY source) AS ks FROM u GROUP BY ALL),
c AS (SELECT * FROM u WHERE user_id % 2 = 0), q AS (SELECT DISTINCT day, user_id, source FROM u WHERE user_id % 2 = 1),
n AS (SELECT day, ks, count(*) AS calls FROM k WHERE user_id % 2 = 0 GROUP BY ALL), s AS (SELECT day, ks, source, min(value) AS a, max(value) AS b FROM c JOIN k USING (day, user_id) GROUP BY ALL), e AS (SELECT day, source, min(value) AS a, max(value) AS b FROM c GROUP BY ALL),
r AS (SELECT q.day, q.user_id, q.source, n.calls, e.a AS ea, CASE WHEN n.calls IS NOT NULL THEN s.a ELSE e.a END AS a, CASE WHEN n.calls IS NOT NULL THEN s.b ELSE e.b END AS b
  FROM q JOIN k USING (day, user_id) LEFT JOIN n ON n.day = q.day AND n.ks = k.ks LEFT JOIN s ON s.day = q.day AND s.ks = k.ks AND s.source = q.source LEFT JOIN e ON e.day = q.day AND e.source = q.source),
g AS (SELECT day, user_id, max(calls) AS calls, bool_and(ea IS NOT NULL) AS known, bool_and(coalesce(a = b, false)) AS single, string_agg(source || '=' || a, ',' ORDER BY source) AS items FROM r GROUP BY ALL)
SELECT day, user_id, CASE WHEN calls IS NULL THEN 'spans' WHEN calls = 1 THEN 'unique' ELSE 'ambiguous' END AS match, CASE WHEN NOT known THEN 'item_unknown' WHEN NOT single THEN 'value_ambiguous' END AS reason, CASE WHEN known AND single THEN items END AS items FROM g""")
def j6_set_then_each(s: SparkSession, d: str) -> DataFrame:
    """Half of a day (the value) for every event type of the odd users, as the even users' days tell it."""
    rows = read(s, d, "events").select(F.to_date("ts").alias("day"), "user_id", F.col("event_type").alias("source"), F.when(F.hour("ts") >= 12, "1").otherwise("0").alias("value"))
    found = joins.set_then_each(rows.filter("user_id % 2 = 1"), rows.filter("user_id % 2 = 0").withColumnRenamed("user_id", "call"), ["day"], "user_id", "call", "source", "value", valid="^[01]$")
    return found.withColumn("items", F.array_join(F.transform("items", lambda x: F.concat(x["item"], F.lit("="), x["value"])), ","))


@query("h2_json_digest", """
SELECT event_id, md5('{"a":[1,{"c":true,"d":null}],"b":{"x":"' || event_type || '","y":{"k":' || json_extract_string(props, '$.k') || '}}}') AS digest FROM events""")
def h2_json_digest(s: SparkSession, d: str) -> DataFrame:
    """Records whose keys stand in one order or the other."""
    e = read(s, d, "events")
    one = F.concat(F.lit('{"b":{"y":'), F.col("props"), F.lit(',"x":"'), F.col("event_type"), F.lit('"},"a":[1,{"d":null,"c":true}]}'))
    other = F.concat(F.lit(' {"a":[1, {"c":true,"d":null}],\n"b":{"x":"'), F.col("event_type"), F.lit('","y":'), F.col("props"), F.lit("}}"))
    return e.select("event_id", hashing.json_digest(F.when(F.col("event_id") % 2 == 0, one).otherwise(other)).alias("digest"))


@query("j9_identity_recovery", """
WITH i AS (SELECT md5(left(text, 200)) AS digest, min(source) AS a, max(source) AS b FROM documents WHERE doc_id % 2 = 0 AND text IS NOT NULL AND source IS NOT NULL GROUP BY 1)
SELECT doc_id, CASE WHEN text IS NULL THEN 'content_missing' WHEN a IS NULL THEN 'owner_unknown' WHEN a <> b THEN 'owner_ambiguous' END AS reason, CASE WHEN a = b THEN a END AS source
FROM documents LEFT JOIN i ON digest = md5(left(text, 200)) WHERE doc_id % 2 = 1""")
def j9_identity_recovery(s: SparkSession, d: str) -> DataFrame:
    """The source of every odd document by the beginning that it shares with even ones of a single source."""
    docs = read(s, d, "documents").withColumn("digest", F.md5(F.substring("text", 1, 200)))
    return joins.recovered(docs.filter("doc_id % 2 = 1").select("doc_id", "digest", "source"), docs.filter("doc_id % 2 = 0"), "digest", "source").select("doc_id", "reason", "source")


@query("x18_differencing")
def x18_differencing(s: SparkSession, d: str) -> DataFrame:
    """Batches of 64 documents in four parts of equal size; tests hold the parts against greedy and brute force."""
    docs = read(s, d, "documents").select("doc_id", F.col("n_chars").alias("length"), F.floor(F.col("doc_id") / 64).alias("batch")).filter("length is not null")
    full = docs.join(docs.groupBy("batch").agg(F.count("*").alias("n")).filter("n % 4 = 0"), "batch", "left_semi")
    return training.differenced(full, "batch", "doc_id", "length", 4, equal_size=True)


@query("x18_micro_batches")
def x18_micro_batches(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents").select("doc_id", F.coalesce("n_chars", F.lit(0)).alias("length"), F.floor(F.col("doc_id") / 64).alias("batch"))
    limit = docs.agg(F.coalesce(F.max("length"), F.lit(1))).first()[0]
    return training.micro_batches(docs, "batch", "doc_id", "length", max(1, limit), least=2, multiple=2)

"""Queries of JSON facts, sections, merges and reports, each held against SQL over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.functions import structure
from logloom.operators import evaluation, merges
from logloom.operators.sizing import dealt
from logloom.plans.queries import EV, events, query, read


@query("x_json_facts", """
SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || ',"s":"a \\" b","l":[1,{"x":null}]}' AS mini, ['object', 'array', 'string', 'number', 'boolean', 'null', NULL][event_id % 7 + 1] AS kind, event_id % 2 = 0 AS exact, event_id % 3 <> 1 AS inner_exact FROM events""")
def x_json_facts(s: SparkSession, d: str) -> DataFrame:
    """Minified JSON (X8), types (X7) and exact key sets (X1)."""
    e = read(s, d, "events")
    k = F.get_json_object("props", "$.k")
    loose = F.concat(F.lit('{ "k" : '), k, F.lit(',\n "s": "a \\" b",\t"l": [ 1, {"x": null } ] }'))
    kinds = F.array(F.lit('{"a":1}'), F.lit("[]"), F.lit('"x"'), F.lit(" 1.5"), F.lit("true"), F.lit("null"), F.lit("{"))
    keyed = F.concat(F.lit('{"b":1,"a":[{"y":1,"x":2}'), F.when(F.col("event_id") % 3 == 1, ',{"x":1}').otherwise(""), F.lit("]"), F.when(F.col("event_id") % 2 == 1, ',"c":0').otherwise(""), F.lit("}"))
    return e.select("event_id", structure.minified(loose).alias("mini"), structure.json_type(F.element_at(kinds, (F.col("event_id") % 7 + 1).cast("int"))).alias("kind"), structure.has_keys(keyed, ["a", "b"]).alias("exact"), structure.each_has_keys(keyed, ["x", "y"], "$.a").alias("inner_exact"))


@query("f_sections", r"""
WITH x AS (SELECT doc_id, regexp_replace(substr(text, 1, 40), '[\n#]', ' ', 'g') AS t, regexp_replace(substr(text, 41, 40), '[\n#]', ' ', 'g') AS u FROM documents WHERE text IS NOT NULL)
SELECT doc_id, trim(t) AS first, CASE WHEN doc_id % 2 = 0 THEN trim(u) END AS second, CASE WHEN doc_id % 3 = 0 THEN 'three' ELSE 'one' END AS block, ['green tea', 'q' || doc_id] AS queries, ['leaf', 'pot co'] AS brands FROM x""")
def f_sections(s: SparkSession, d: str) -> DataFrame:
    """Sections (F10), heading blocks with the last of equal names, and what the lines of a block list (F11)."""
    docs = read(s, d, "documents").filter("text is not null")
    t, u = (F.regexp_replace(F.substring("text", a, 40), r"[\n#]", " ") for a in (1, 41))
    body = F.concat(F.lit("## First part\n"), t, F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("\n## Second (b)\n"), u)).otherwise(""), F.lit("\n"))
    blocks = F.concat(F.lit("intro\n### Interest 1: A\none\n### Interest 2: B\n- Brands: Leaf, Pot Co\n- Existing queries:\n  - green tea\n  - q"), F.col("doc_id").cast("string"), F.lit("\n- Other\n  - no\n"), F.when(F.col("doc_id") % 3 == 0, "### Interest 3: A\nthree\n").otherwise(""))
    held = docs.select("doc_id", structure.section(body, "First part").alias("first"), structure.section(body, "Second (b)").alias("second"), structure.heading_blocks(blocks).alias("m"))
    b = F.element_at("m", "B")
    return held.select("doc_id", "first", "second", F.trim(F.element_at("m", "A"), F.lit("\n")).alias("block"), structure.existing_queries(b).alias("queries"), structure.known_brands(b).alias("brands"))


@query("f17_patterns", r"""
SELECT doc_id, regexp_matches(text, '[{}`]|"(life_stage|biography|value|confidence|evidence)"\s*:') AS artifact, regexp_matches(t, '(?i)\b(he|she|him|his|her|hers|himself|herself)\b') AS pronoun, regexp_matches(lower(t), '\b(not interested|offensive|misleading|inappropriate|dislike[sd]?|downvote[sd]?|repeated ads?)\b') AS reaction
FROM (SELECT *, regexp_replace(text, '[^\x00-\x7f]', '-', 'g') AS t FROM documents)""")
def f17_patterns(s: SparkSession, d: str) -> DataFrame:
    ascii_ = F.regexp_replace("text", r"[^\x00-\x7f]", "-")
    return read(s, d, "documents").select("doc_id", F.rlike("text", F.lit(structure.ARTIFACT)).alias("artifact"), F.rlike(ascii_, F.lit(structure.PRONOUN)).alias("pronoun"), F.rlike(F.lower(ascii_), F.lit(structure.REACTION)).alias("reaction"))


@query("p_sources_and_logits", """
WITH x AS (SELECT l_orderkey, l_linenumber, l_returnflag, [l_discount * 10, l_tax * 10, 0.5] AS z FROM lineitem), e AS (SELECT *, list_max(z) AS top, list_sum(list_transform(z, lambda v: exp(v - list_max(z)))) AS whole FROM x)
SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'a' ELSE 'n' END AS source, CAST(list_position(z, top) - 1 AS INTEGER) AS class, list_transform(z, lambda v: round(exp(v - top) / whole, 8)) AS shares FROM e""")
def p_sources_and_logits(s: SparkSession, d: str) -> DataFrame:
    """Canonical sources (P4), softmax and arg-max (M5)."""
    line = read(s, d, "lineitem")
    z = F.array(F.col("l_discount") * 10, F.col("l_tax") * 10, F.lit(0.5))
    source = structure.canonical_source(F.when(F.col("l_returnflag") == "R", "RETURNED").otherwise(F.lower("l_returnflag")), ["Returned", "Kept"])
    return line.select("l_orderkey", "l_linenumber", source.alias("source"), structure.best_class(z).alias("class"), F.transform(structure.softmax(z), lambda v: F.round(v, 8)).alias("shares"))


@query("p5_without_fields", f"WITH {EV} SELECT user_id, list(struct_pack(event_id := event_id, action := action) ORDER BY event_id) AS signals FROM ev GROUP BY user_id")
def p5_without_fields(s: SparkSession, d: str) -> DataFrame:
    g = events(s, d).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "source", "action", "day"))).alias("signals"))
    return g.select("user_id", structure.without_fields(F.col("signals"), "source", "day").alias("signals"))


@query("a13_task_ratios", """
SELECT o_orderpriority, count(*) AS rows, round(count(*) FILTER (o_orderstatus <> 'F') / count(*), 8) AS json_valid, round(count(*) FILTER (o_orderstatus <> 'F' AND o_totalprice > 150000) / nullif(count(*) FILTER (o_orderstatus <> 'F'), 0), 8) AS rule_pass FROM orders GROUP BY 1""")
def a13_task_ratios(s: SparkSession, d: str) -> DataFrame:
    valid = F.col("o_orderstatus") != "F"
    out = evaluation.task_ratios(read(s, d, "orders"), ["o_orderpriority"], {"json_valid": (valid, None), "rule_pass": (F.col("o_totalprice") > 150000, valid)})
    return out.select("o_orderpriority", "rows", F.round("json_valid", 8).alias("json_valid"), F.round("rule_pass", 8).alias("rule_pass"))


@query("a26_batch_metrics", """
SELECT l_returnflag, round(avg(l_tax), 8) AS l_tax_mean, max(l_tax) AS l_tax_max, min(l_tax) AS l_tax_min, round(avg(CASE WHEN l_quantity >= 45 THEN 1.0 ELSE 0.0 END), 8) AS clip_ratio FROM lineitem GROUP BY 1""")
def a26_batch_metrics(s: SparkSession, d: str) -> DataFrame:
    out = evaluation.batch_metrics(read(s, d, "lineitem"), ["l_returnflag"], ["l_tax"], "l_quantity", 45)
    return out.withColumn("l_tax_mean", F.round("l_tax_mean", 8)).withColumn("clip_ratio", F.round("clip_ratio", 8))


@query("a27_call_statistics", """
WITH c AS (SELECT l_returnflag AS stage, l_linenumber AS attempts, count(*) AS n, count(*) FILTER (l_linestatus = 'F') AS v FROM lineitem GROUP BY ALL)
SELECT stage, CAST(sum(n) AS BIGINT) AS calls, CAST(sum(v) AS BIGINT) AS valid, round(coalesce(sum(v) FILTER (attempts = 1), 0) / sum(n), 8) AS first_valid, string_agg(attempts || ':' || n, ',' ORDER BY attempts) AS attempts FROM c GROUP BY stage""")
def a27_call_statistics(s: SparkSession, d: str) -> DataFrame:
    out = evaluation.call_statistics(read(s, d, "lineitem").withColumnRenamed("l_returnflag", "stage"), "stage", "l_linenumber", F.col("l_linestatus") == "F")
    shown = F.array_join(F.transform(F.array_sort(F.map_entries("attempts")), lambda e: F.concat_ws(":", e["key"], e["value"])), ",")
    return out.select("stage", "calls", "valid", F.round("first_valid", 8).alias("first_valid"), shown.alias("attempts"))


@query("a28_pool_report", """
WITH b AS (SELECT o_orderpriority, o_custkey % 7 AS b, count(DISTINCT l_partkey) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL) SELECT o_orderpriority, count(*) AS batches, min(n) AS smallest, max(n) AS largest FROM b GROUP BY 1""")
def a28_pool_report(s: SparkSession, d: str) -> DataFrame:
    lines = read(s, d, "lineitem")
    orders = dealt(read(s, d, "orders").select("o_orderpriority", "o_orderkey", (F.col("o_custkey") % 7).alias("b")), lines.count(), "o_orderkey")
    held = orders.join(dealt(lines.select("l_orderkey", "l_partkey"), lines.count(), "l_orderkey"), F.col("o_orderkey") == F.col("l_orderkey"))
    return evaluation.pool_report(held, "o_orderpriority", "b", F.array("l_partkey"))


@query("a32_answer_summary", """
WITH x AS (SELECT l_returnflag AS k, l_linestatus = 'F' AS valid, l_linestatus = 'F' AND l_tax > 0.03 AS pass, CAST(l_quantity AS INTEGER) AS n FROM lineitem), v AS (SELECT k, list_sort(list(n)) AS o FROM x WHERE valid GROUP BY k)
SELECT x.k, count(*) AS answers, round(avg(CASE WHEN valid THEN 1.0 ELSE 0.0 END), 8) AS valid_share, round(avg(CASE WHEN pass THEN 1.0 ELSE 0.0 END), 8) AS pass_share, any_value(o[1]) AS least, any_value((o[(len(o) - 1) // 2 + 1] + o[len(o) // 2 + 1]) / 2.0) AS median,
  any_value(o[CAST(least(len(o) - 1, floor(0.9 * len(o))) AS INTEGER) + 1]) AS p90, any_value(o[len(o)]) AS most FROM x LEFT JOIN v ON v.k = x.k GROUP BY x.k""")
def a32_answer_summary(s: SparkSession, d: str) -> DataFrame:
    valid = F.col("l_linestatus") == "F"
    rows = read(s, d, "lineitem").select(F.col("l_returnflag").alias("k"), valid.alias("valid"), (valid & (F.col("l_tax") > 0.03)).alias("pass"), F.col("l_quantity").cast("int").alias("n"))
    out = evaluation.answer_summary(rows, ["k"], "valid", "pass", "n")
    return out.withColumn("valid_share", F.round("valid_share", 8)).withColumn("pass_share", F.round("pass_share", 8))


@query("k11_skip_reasons", """
WITH x AS (SELECT user_id, CASE WHEN value IS NULL THEN 'no_value' WHEN value < 20 THEN 'low' WHEN event_type = 'error' THEN 'error' END AS reason FROM events)
SELECT reason, count(*) AS rows, list_sort(list(DISTINCT user_id))[1:5] AS users FROM x WHERE reason IS NOT NULL GROUP BY reason""")
def k11_skip_reasons(s: SparkSession, d: str) -> DataFrame:
    reason = F.when(F.col("value").isNull(), "no_value").when(F.col("value") < 20, "low").when(F.col("event_type") == "error", "error")
    return evaluation.skip_reasons(read(s, d, "events").withColumn("reason", reason), "reason", "user_id", shown=5)


@query("c16_kept_generations", "SELECT l_orderkey, l_linenumber, l_tax FROM lineitem WHERE l_returnflag = 'N' AND NOT l_linestatus = 'F' AND l_tax > 0.02")
def c16_kept_generations(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_tax", F.when(F.col("l_returnflag") == "N", "stop").otherwise("length").alias("finish"), (F.col("l_linestatus") == "F").alias("thinking"), F.struct((F.col("l_tax") > 0.02).alias("rule_pass"), F.lit(True).alias("json_valid")).alias("quality"))
    return evaluation.kept_generations(rows, "finish", "thinking", "quality").select("l_orderkey", "l_linenumber", "l_tax")


@query("b22_structure_signals", """
WITH t AS (SELECT l_orderkey AS a, l_suppkey % 3 AS i, l_linenumber % 3 AS z, list(DISTINCT l_partkey % 10) AS c FROM lineitem GROUP BY ALL), u AS (SELECT a, count(DISTINCT x) AS items FROM (SELECT a, unnest(c) AS x FROM t) GROUP BY a)
SELECT a, round(count(*) / count(DISTINCT i), 8) AS topics_per_interest, round(avg(len(c)), 8) AS evidence_per_topic, round(avg(z), 8) AS z_mean, round(sum(len(c)) / any_value(items), 8) AS citations_per_evidence FROM t JOIN u USING (a) GROUP BY a""")
def b22_structure_signals(s: SparkSession, d: str) -> DataFrame:
    t = read(s, d, "lineitem").groupBy(F.col("l_orderkey").alias("a"), (F.col("l_suppkey") % 3).alias("i"), (F.col("l_linenumber") % 3).alias("z")).agg(F.collect_list(F.col("l_partkey") % 10).alias("c"))
    out = evaluation.structure_signals(t, "a", "i", "c", ["z"])
    return out.select("a", *[F.round(c, 8).alias(c) for c in ("topics_per_interest", "evidence_per_topic", "z_mean", "citations_per_evidence")])


@query("j4_answered", """
WITH r AS (SELECT l_orderkey AS k, l_linenumber AS pos, l_partkey AS part FROM lineitem WHERE l_linestatus = 'F' QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) = 1)
SELECT o_orderkey AS item, part, CASE WHEN k IS NULL THEN 'input_missing_output' END AS reason FROM orders LEFT JOIN r ON k = o_orderkey""")
def j4_answered(s: SparkSession, d: str) -> DataFrame:
    place = F.col("l_linenumber") * 100_000_000 + F.col("l_partkey")  # line numbers repeat in these tables
    responses = read(s, d, "lineitem").select(F.col("l_orderkey").alias("custom_id"), place.alias("pos"), F.col("l_partkey").alias("part"), "l_linestatus")
    items = read(s, d, "orders").select(F.col("o_orderkey").alias("item"), F.lit(0).alias("pos"))
    return merges.answered(items, responses, "item", "custom_id", F.col("l_linestatus") == "F", "pos").select("item", "part", "reason")


@query("j10_market_split", """
WITH m AS (SELECT user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1) SELECT coalesce(event_type, 'unknown') AS market, count(*) AS rows FROM customer LEFT JOIN m ON user_id = c_custkey GROUP BY 1""")
def j10_market_split(s: SparkSession, d: str) -> DataFrame:
    markets = read(s, d, "events").select("user_id", F.col("event_type").alias("market"), "event_id")
    return merges.market_split(read(s, d, "customer").select(F.col("c_custkey").alias("user_id")), markets, ["user_id"], "market", "event_id")


@query("j13_evaluation_join", """
WITH d AS (SELECT user_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) SELECT o_orderkey, o_custkey AS user_id, value FROM orders JOIN d ON user_id = o_custkey""")
def j13_evaluation_join(s: SparkSession, d: str) -> DataFrame:
    dataset = read(s, d, "events").select("user_id", "value", (-F.col("event_id")).alias("at"))
    return merges.evaluation_join(read(s, d, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id")), dataset, "user_id", "at")


@query("b2_decisions_merge", """
WITH o AS (SELECT user_id AS k, min(value) AS v FROM events WHERE event_type = 'signup' GROUP BY 1 HAVING count(*) = 1), i AS (SELECT user_id AS k, min(event_id) AS e FROM events WHERE event_type = 'error' AND event_id % 9 = 0 GROUP BY 1 HAVING count(*) = 1)
SELECT coalesce(o.k, i.k) AS k, v, e, CASE WHEN i.k IS NULL THEN 'input_missing' WHEN o.k IS NULL THEN 'output_missing' END AS reason FROM o FULL JOIN i ON o.k = i.k""")
def b2_decisions_merge(s: SparkSession, d: str) -> DataFrame:
    e = read(s, d, "events")
    outputs = e.filter("event_type = 'signup'").select(F.col("user_id").alias("k"), F.col("value").alias("v"))
    inputs = e.filter("event_type = 'error' and event_id % 9 = 0").select(F.col("user_id").alias("k"), F.col("event_id").alias("e"))
    return merges.decisions_merge(outputs, inputs, ["k"]).select("k", "v", "e", "reason")


@query("b10_new_answers", f"WITH {EV} SELECT event_id, user_id, action FROM ev x WHERE event_id % 2 = 0 AND NOT EXISTS (SELECT 1 FROM ev y WHERE y.event_id % 2 = 1 AND y.user_id = x.user_id AND y.action = x.action)")
def b10_new_answers(s: SparkSession, d: str) -> DataFrame:
    e = events(s, d).select("event_id", "user_id", "action")
    existing = e.filter("event_id % 2 = 1").withColumn("action", F.concat(F.lit(" "), F.upper("action")))
    return merges.new_answers(e.filter("event_id % 2 = 0"), existing, ["user_id"], "action")


@query("gb3_accepted", f"WITH {EV}, f AS (SELECT event_id, action FROM ev QUALIFY row_number() OVER (PARTITION BY action ORDER BY event_id) = 1) SELECT event_id, action FROM f ORDER BY event_id LIMIT 100")
def gb3_accepted(s: SparkSession, d: str) -> DataFrame:
    return merges.accepted(events(s, d).select("event_id", "action"), "action", "event_id", 100)


@query("b12_tagged_languages", """
WITH x AS (SELECT source AS u, doc_id AS i, lang FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source ORDER BY sha256('6|' || source || '|' || doc_id), doc_id) <= 15), v AS (SELECT u, lang, count(*) AS n FROM x GROUP BY ALL)
SELECT u, arg_min(lang, struct_pack(a := -n, b := lang)) AS lang, max(n) AS votes FROM v GROUP BY u""")
def b12_tagged_languages(s: SparkSession, d: str) -> DataFrame:
    docs = read(s, d, "documents").filter("source is not null").select(F.col("source").alias("u"), F.col("doc_id").alias("i"), "lang")
    return merges.tagged_languages(docs, "u", "i", "lang", 6, 15)


@query("b26_preference_pairs", """
WITH x AS (SELECT l_orderkey AS p, l_partkey || '-' || l_linenumber AS a, l_discount AS s FROM lineitem) SELECT p, arg_min(a, struct_pack(a := -s, b := a)) AS chosen, arg_min(a, struct_pack(a := s, b := a)) AS rejected FROM x GROUP BY p HAVING max(s) > min(s)""")
def b26_preference_pairs(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "lineitem").select(F.col("l_orderkey").alias("p"), F.concat_ws("-", "l_partkey", "l_linenumber").alias("a"), F.col("l_discount").alias("s"))
    return merges.preference_pairs(rows, "p", "a", "s")


@query("b25_loader_split", """
WITH f AS (SELECT doc_id, row_number() OVER (ORDER BY sha256('8|' || doc_id), doc_id) - 1 AS r FROM documents WHERE n_chars <= 3000 ORDER BY r LIMIT 130), n AS (SELECT count(*) // 4 AS size FROM f) SELECT doc_id, CAST(r // size AS INTEGER) AS part FROM f, n WHERE r < size * 4""")
def b25_loader_split(s: SparkSession, d: str) -> DataFrame:
    return merges.loader_split(read(s, d, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 3000, 130, 4, 8).select("doc_id", "part")

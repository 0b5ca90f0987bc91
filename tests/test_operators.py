import datetime
import json

import pytest
from pyspark.sql import functions as F

from logloom.functions import arrays, dates, hashing, text
from logloom.operators import joins, profile, retrieval, rules, stats, training, windows
from logloom.sources import readers, sinks


def values(spark, data, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*columns).collect()]


def test_text_functions(spark):
    got = values(spark, [("Café-Zoë  Straße_1",), (None,)], "x string", text.normalize_name(F.col("x")).alias("n"))
    assert got == [("café zoë strasse 1",), ("",)]
    assert values(spark, [("A  &  B",)], "x string", text.segment_key(F.col("x"))) == [("a and b",)]
    assert values(spark, [("a  b",)], "x string", text.collapse_space(F.col("x"))) == [("a b",)]
    assert values(spark, [("one",), ("what is it?",), ("東京",)], "x string", text.query_problems(F.col("x"))) == [(["query_word_count"],), (["query_question"],), ([],)]
    assert values(spark, [("The answer: 1,234.5 or -7",), ("none",)], "x string", text.last_number(F.col("x"))) == [("-7",), (None,)]
    assert values(spark, [(r"so \boxed{a{b}c} end",), (r"\boxed{a",), (None,)], "x string", text.last_boxed("x")) == [("a{b}c",), (None,), (None,)]
    assert values(spark, [("The  Cat, a Dog!",)], "x string", text.normalize_answer(F.col("x"))) == [("cat dog",)]
    assert values(spark, [(["/a/b/c", "/a/b/d"],), (["/x", "/y"],), ([],)], "x array<string>", text.common_prefix(F.col("x"))) == [("/a/b",), (None,), (None,)]
    assert values(spark, [("Crème—brûlée",)], "x string", text.accent_fold("x")) == [("creme brulee",)]
    assert values(spark, [("user: 7\nlocale: de\n",)], "x string", text.header_field(F.col("x"), "locale"), text.header_field(F.col("x"), "none")) == [("de", None)]


def test_hashing(spark):
    def fnv(t):
        h = 2166136261
        for i in range(0, len(r := t.encode("utf-16-le")), 2):
            h = ((h ^ int.from_bytes(r[i : i + 2], "little")) * 16777619) & 0xFFFFFFFF
        return h % 16

    assert values(spark, [("13",)], "x string", hashing.bucket(F.col("x"))) == [(6934,)]
    assert values(spark, [("user",), (None,)], "x string", hashing.fnv_bucket("x")) == [(fnv("user"),), (fnv(""),)]
    rows = [([("web", "A  b"), ("app", "c")],), ([("app", "C"), ("web", "a b")],)]
    (a,), (b,) = values(spark, rows, "s array<struct<source:string,action:string>>", hashing.input_digest(F.col("s")))
    assert a == b


def test_dates(spark):
    day = datetime.date
    assert values(spark, [("20250131",), ("2025-01-31T05:00:00Z",), ("x",), ("20251399",)], "x string", dates.parse_date(F.col("x"))) == [(day(2025, 1, 31),), (day(2025, 1, 31),), (None,), (None,)]
    cases = [(day(2025, 1, 1), day(2025, 1, 1), day(2025, 1, 2), "Ephemeral"), (day(2025, 1, 1), day(2025, 1, 2), day(2025, 4, 1), "Archived"), (day(2025, 1, 1), day(2025, 1, 2), day(2025, 2, 15), "Dormant"), (day(2025, 1, 1), day(2025, 1, 2), day(2025, 1, 15), "Declining"), (day(2025, 1, 1), day(2025, 3, 1), day(2025, 3, 2), "Stable"), (day(2025, 1, 1), day(2025, 1, 1), day(2025, 1, 1), "Emerging")]
    got = values(spark, cases, "f date, l date, n date, s string", dates.lifecycle(F.col("f"), F.col("l"), F.col("n")), "s")
    assert all(a == b for a, b in got)


def test_arrays(spark):
    assert values(spark, [([1, 2, 3, 4, 5, 6, 7],), ([],)], "x array<int>", arrays.chunks(F.col("x"), 3)) == [([[1, 2, 3], [4, 5], [6, 7]],), ([[]],)]
    assert values(spark, [(["a", "a", "b"], ["a", "c"])], "x array<string>, y array<string>", arrays.multiset_jaccard(F.col("x"), F.col("y"))) == [(0.25,)]
    assert values(spark, [([7, 3, 7, 9], [9, 7])], "x array<int>, o array<int>", arrays.remap_evidence(F.col("x"), F.col("o"))) == [([0, 1],)]


def test_two_phase_dedupe_sees_only_clean_rows(spark):
    df = spark.createDataFrame([(1, "a", "n", False), (2, "b", "n", True), (3, "c", "n", True), (4, "b", "n", True)], "id int, e string, n string, ok boolean")
    got = {r["id"]: r["reason"] for r in windows.two_phase_dedupe(df, F.col("e"), F.col("n"), F.col("ok"), ["id"]).collect()}
    assert got == {1: "rule", 2: None, 3: "normalized_duplicate_input", 4: "identical_duplicate"}


def test_token_level_advantages(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [0.5, 0.5, 0.5])], "r array<double>, v array<double>")
    assert df.select(windows.reverse_returns(F.col("r"), 0.5)).first()[0] == [2.75, 3.5, 3.0]
    got = df.select(windows.estimated_advantages(F.col("r"), F.col("v"), 1.0, 1.0)).first()[0]
    assert got == pytest.approx([5.5, 4.5, 2.5])


def test_join_checks(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    with pytest.raises(ValueError):
        joins.assert_disjoint(a, a, "k")
    names = spark.createDataFrame([("ab",), ("abc",), ("z",)], "name string")
    texts = spark.createDataFrame([("xxabcxx",), ("xaby",), ("q",)], "t string")
    assert [r["name"] for r in joins.contained(texts, "t", names, "name").collect()] == ["abc", "ab", None]


def test_profile_fold_boosts_decays_and_prunes(spark):
    d = datetime.date
    rows = [("u", 0, d(2025, 1, 7), 0, "add", None, "Tea", None, 1), ("u", 0, d(2025, 1, 7), 1, "add", None, "Cars", None, 2), ("u", 1, d(2025, 1, 14), 0, "merge", "tea", "x", "Green tea", 1), ("u", 2, d(2025, 1, 21), 0, "merge", "green TEA", "x", None, 1), ("u", 2, d(2025, 1, 21), 1, "merge", "cars", "x", "Green tea", 1)]
    schema = "user_id string, window int, date date, position int, action string, target string, name string, result string, topics int"
    got = {(r["window"], r["name"]): (r["confidence"], r["count"], r["event"]) for r in profile.fold(spark.createDataFrame(rows, schema)).collect()}
    assert got[0, "Tea"] == (0.6, 1, "added") and got[0, "Cars"] == (0.75, 1, "added")
    assert got[1, "Green tea"] == (0.84, 2, "boosted")
    assert got[1, "Cars"] == (round(0.75 * 0.98**7, 4), 1, "decayed")
    assert [k for k in got if k[0] == 2] == [(2, "Green tea")]  # the second decision takes the name and replaces the first


def test_streaming_profiles_equal_the_batch_fold(spark, tmp_path):
    from logloom.streaming.windows import profiles, weekly_counts

    d = datetime.date
    schema = "user_id string, window int, date date, position int, action string, target string, name string, result string, topics int"
    rows = [(u, w, d(2025, 1, 7) + datetime.timedelta(7 * w), 0, "merge" if w else "add", "a", "a", None, 2) for u in "xy" for w in range(3)]
    df = spark.createDataFrame(rows, schema)
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    q = profiles(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")).writeStream.format("memory").queryName("profiles").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("profiles").collect())) == sorted(map(tuple, profile.fold(df).collect()))
    e = spark.createDataFrame([(datetime.datetime(2025, 1, 1), "a"), (datetime.datetime(2025, 1, 7, 23), "a"), (datetime.datetime(2025, 1, 8), "a")], "ts timestamp, k string")
    e.coalesce(1).write.parquet(f"{tmp_path}/e")
    q = weekly_counts(spark.readStream.schema(e.schema).parquet(f"{tmp_path}/e"), "ts", ["k"], d(2025, 1, 1)).writeStream.format("memory").queryName("weeks").outputMode("complete").option("checkpointLocation", f"{tmp_path}/d").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("weeks").collect())) == [(d(2025, 1, 1), "a", 2), (d(2025, 1, 8), "a", 1)]


def record(interests):
    return json.dumps({"input": {"signals": [{"idx": 1}, {"idx": 2}]}, "output": {"interests": interests}})


def interest(name="Tea", topics=None, **more):
    return {"topics": [{"topic": "t", "evidence": [1]}] if topics is None else topics, "interest_name": name, "actual_activity": "x"} | more


@pytest.mark.parametrize(
    ("text_", "drops"),
    [
        (record([interest()]), []),
        ("{", ["invalid_json"]),
        ("{}", ["malformed"]),
        (record([interest(more=1)]), ["unexpected_keys"]),
        (record([interest(name=" ")]), ["empty_text"]),
        (record([interest(), interest("TEA!")]), ["duplicate_interest_name"]),
        (record([interest(topics=[{"topic": "t", "evidence": [3]}])]), ["unknown_evidence_idx"]),
        (record([interest(topics=[{"topic": "t", "evidence": [1, 1]}])]), ["duplicate_evidence_id"]),
        (record([interest(topics=[{"topic": "t", "evidence": [True]}])]), ["invalid_evidence_format"]),
        (record([interest(topics=[{"topic": "t", "evidence": [1]}, {"topic": "T.", "evidence": [2]}])]), ["duplicate_topic_name"]),
        (record([interest(str(i)) for i in range(40)]), ["too_many_interests"]),
    ],
)
def test_layer1_rules(spark, text_, drops):
    assert rules.check(spark.createDataFrame([(text_,)], "r string"), "r", "layer1").first()["drops"] == drops


def test_layer2_commercial_and_persona_rules():
    merge = {"action": "merge", "delta_interest_name": "Tea", "snapshot_interest_name": "Tea", "merged_interest_name": "Drinks", "merged_actual_activity": "x"}
    row = {"input": {"snapshot": [{"interest_name": "Tea"}, {"interest_name": "Cars"}], "delta": [{"interest_name": "Tea"}, {"interest_name": "Art"}]}, "output": {"decisions": [merge]}}
    assert rules.layer2(row)[0] == {"same_name_merge_renamed", "delta_not_covered"}
    row["output"]["decisions"] = [merge | {"merged_interest_name": "Tea"}, {"action": "add", "delta_interest_name": "Art", "actual_activity": "x"}]
    assert rules.layer2(row)[0] == set()
    entry = {"interest_name": "Tea", "commercial": True, "commercial_score": "low", "intent_funnel_stage": "research", "brands": ["B"], "retailers": [], "products": ["b"], "predicted_queries": ["Green tea"]}
    row = {"input": {"interests": [{"interest_name": "Tea", "actual_activity": "drinks B"}]}, "output": {"interest_commercial": [entry]}}
    assert rules.commercial(row) == (set(), {"query_not_lowercase", "product_overlaps_brand_retailer"})
    assert rules.commercial({"input": {"interests": [{"interest_name": "Tea", "topics": [{"topic": "x", "date": "B"}]}]}, "output": row["output"]})[1] >= {"entity_not_in_evidence"}
    row["output"]["interest_commercial"] = [entry | {"commercial": False}]
    assert rules.commercial(row)[0] == {"schema_violation"} | {f"schema: {x}" for x in ("commercial_score: const", "intent_funnel_stage: const", "brands: maxItems", "products: maxItems", "predicted_queries: maxItems")}
    none = entry | {"commercial": False, "commercial_score": None, "intent_funnel_stage": None, "brands": [], "products": [], "predicted_queries": []}
    row["output"]["interest_commercial"] = [none]
    assert rules.commercial(row) == (set(), set())
    row["output"]["interest_commercial"] = [dict(reversed(entry.items()))]
    assert rules.commercial(row)[0] == {"schema_violation", "schema: <entry>: key_order"}
    p = lambda n, c, t: {"interest_name": n, "category": c, "persona": t}
    row = {"input": {"active_interests": [{"interest_name": "a"}, {"interest_name": "b"}]}, "output": {"interest_personas": [p("a", "/X & Y", "1"), p("b", "/X and Y", "2")]}}
    assert rules.persona(row)[0] == {"inconsistent_output"}
    row["output"]["interest_personas"] = [p("a", "/X/", "1")]
    assert rules.persona(row)[0] == {"schema_violation", "schema: category: pattern"}


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text('{"a": 1}\n\n[1]\nbad\n')
    got = {r["line"]: (r["drop"], r["record"] and r["record"]["a"]) for r in readers.json_lines(spark, f"{tmp_path}/in", "a int").collect()}
    assert got == {'{"a": 1}': (None, 1), "[1]": ("not_an_object", None), "bad": ("invalid_json", None)}
    with pytest.raises(Exception, match="bad JSON line"):
        readers.json_lines(spark, f"{tmp_path}/in", "a int", strict=True).collect()
    df = spark.createDataFrame([(i, f"u{i % 3}") for i in range(20)], "id int, u string")
    sinks.bucketed(df, f"{tmp_path}/b", F.pmod(F.crc32("u"), F.lit(4)), 4, ["u", "id"])
    assert spark.read.parquet(f"{tmp_path}/b").count() == 20
    sinks.shards(df, f"{tmp_path}/s", ["id"], F.lit(1), 4)
    assert [r["count"] for r in spark.read.parquet(f"{tmp_path}/s").groupBy("shard").count().orderBy("shard").collect()] == [5, 5, 5, 5]
    with pytest.raises(ValueError):
        sinks.guard(["x"], ["x/"])
    with pytest.raises(ValueError):
        readers.by_extension(spark, ["a.txt"])
    quoted = spark.createDataFrame([(1, 'a\t"b ""q"""\nc\td')], "id int, t string")
    assert sorted(map(tuple, readers.tsv_in_text(quoted, "t", ["x", "y"]).collect())) == [(1, "a", 'b "q"'), (1, "c", "d")]


def test_training(spark):
    df = spark.createDataFrame([(c, i) for c, n in (("a", 3), ("b", 5)) for i in range(n)], "c string, i int")
    got = training.mixture(df, "c", "i", {"a": 3.0, "b": 1.0}, 8, epoch=1).groupBy("c").count().collect()
    assert {r["c"]: r["count"] for r in got} == {"a": 6, "b": 2}
    plan = training.replay_plan({"a": (1.0, 3), "b": (2.0, 5)}, 4, 3, 9, spark).collect()
    assert len(plan) == 12 and all(0 <= r["row"] < {"a": 3, "b": 5}[r["config"]] for r in plan)
    tokens = spark.createDataFrame([(["h", "i", "e", "x"], ["user", "assistant", "assistant", "assistant"])], "t array<string>, r array<string>")
    cut, mask = training.label_mask(F.col("t"), F.col("r"), "e", 3)
    assert tuple(tokens.select(cut, mask).first()) == (["i", "e", "x"], [True, True, False])
    parts = training.balanced(spark.createDataFrame([(0, i, n) for i, n in enumerate([9, 5, 4])], "g int, k int, n int"), "g", "k", "n", 2).collect()
    assert {r["k"]: r["part"] for r in parts} == {0: 0, 1: 1, 2: 1}


def test_retrieval_and_stats(spark):
    cover = retrieval.greedy_cover(spark.createDataFrame([("u", 1, "a"), ("u", 2, "a"), ("u", 2, "b"), ("u", 3, "c")], "user string, c int, i string"), "user", "c", "i", 2)
    assert sorted(map(tuple, cover.collect())) == [("u", 1, 2, 2), ("u", 2, 3, 1)]
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [2.0, 0.0])], "vec_id int, embedding array<double>")
    top = retrieval.cosine_top_k(v, v.select(F.col("vec_id").alias("query_id"), "embedding"), 5)
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in top.collect()) == [(1, 1, 1), (1, 2, 4), (4, 1, 1), (4, 2, 4)]
    with pytest.raises(KeyError):
        stats.mean_signals(v, [], ["nope"])
    boot = stats.bootstrap_best(spark.createDataFrame([("p", 1.0), ("p", 0.0)], "p string, s double"), "p", "s", 2).first()
    assert boot["mean"] == 0.5 and boot["best"] == pytest.approx(0.75, abs=0.05)


def test_more_group_statistics(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 0.0), ("b", 3, 3.0)], "g string, i int, r double")
    assert {r["i"]: r["gpg"] for r in windows.batch_scaled(df, "g", "r").collect()} == {1: 0.75, 2: -0.75, 3: 0.0}
    got = [r["gdpo"] for r in windows.decoupled(df, "g", ["r"], [1.0]).collect()]
    assert sum(got) == pytest.approx(0, abs=1e-9)
    many = spark.createDataFrame([(u, i) for u in "xy" for i in range(50)], "u string, i int")
    draws = windows.nested_draws(many, ["u"], "i", 1, [5, 10]).collect()
    small = {(r["u"], r["i"]) for r in draws if r["draw"] == 5}
    large = {(r["u"], r["i"]) for r in draws if r["draw"] == 10}
    assert len(small) == 10 and len(large) == 20 and small < large
    assert windows.stratified(many, "u", "i", 3, 7).count() == 14
    picks = windows.weighted_draws(spark.createDataFrame([(i, float(i)) for i in range(5)], "k int, s double"), "k", "s", 1.0, 2000, 1).groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in picks} == pytest.approx({1: 200, 2: 400, 3: 600, 4: 800}, abs=80)
    old = spark.createDataFrame([("a", 1), ("a", 9), ("b", 2), ("c", 3)], "g string, b int")
    assert windows.oldest_groups(old, "g", "b", 2).count() == 3 and windows.stale(old, 10, "b", 8).count() == 2


def test_answer_scores(spark):
    rows = [("number", "it is 1,200", "1200"), ("boxed", r"\boxed{x^2}", "x^2"), ("text", "The Cat!", "cat"), ("number", "none", "3"), ("other", "a", "a")]
    assert values(spark, rows, "s string, a string, t string", text.score_answer(F.col("s"), F.col("a"), F.col("t"))) == [(1.0,), (1.0,), (1.0,), (0.0,), (None,)]
    assert values(spark, [("zh_TW",), ("zh-Hans-CN",), ("en-US",), ("iw",)], "x string", text.locale_language(F.col("x"), {"iw": "he"})) == [("zh-hant",), ("zh-hans",), ("en",), ("he",)]
    assert values(spark, [(10,), (95,), (110,)], "n int", text.overlong_penalty(F.col("n"), 100, 20, 1.0)) == [(0.0,), (-0.75,), (-1.5,)]
    mask = spark.createDataFrame([([1.0, 3.0],), ([1.0, 9.0],)], "r array<double>").select(windows.rejection_mask(F.col("r"), 0.5, 2.0, 5.0).alias("m")).collect()
    assert [r["m"] for r in mask] == [[True, False], [False, False]]


def test_responses_of_one_place_go_by_their_order_in_the_file(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from logloom.plans.queries import j3_first_ok

    n = 4000
    pq.write_table(pa.table({"l_orderkey": [i % 40 for i in range(n)], "l_linenumber": [1] * n, "l_partkey": list(range(n)), "l_returnflag": ["N"] * n}), tmp_path / "lineitem.parquet", row_group_size=100)
    pq.write_table(pa.table({"o_orderkey": list(range(40))}), tmp_path / "orders.parquet")
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in held:
            spark.conf.set(k, "2k")
        assert {(r["k"], r["part"]) for r in j3_first_ok(spark, str(tmp_path)).collect()} == {(i, i) for i in range(40)}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_first_responses_with_unknown_numbers_and_repeated_orders_are_those_of_the_sql(spark, tmp_path):
    """Unknown line numbers came first, and orders of one key, or of none, were one row."""
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    from logloom.plans.queries import ORACLE, j3_first_ok

    pq.write_table(pa.table({"l_orderkey": [1, 1, 1, 2, 2, None], "l_linenumber": pa.array([None, 4, 3, None, None, 1], pa.int32()), "l_partkey": [10, 11, 12, 13, 14, 15], "l_returnflag": ["N", "N", "A", "N", "N", "N"]}), tmp_path / "lineitem.parquet")
    pq.write_table(pa.table({"o_orderkey": [1, 1, 2, 3, None, None]}), tmp_path / "orders.parquet")
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    got = j3_first_ok(spark, str(tmp_path)).select("k", "pos", "part", "reason").collect()
    want = con.execute(f"SELECT k, pos, part, reason FROM ({ORACLE['j3_first_ok']})").fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert (1, 4, 11, None) in want and (2, None, 13, None) in want and len(want) == 6


def test_greedy_cover_takes_the_smaller_of_equals_and_stops_without_gain(spark):
    rows = [("u", 2, "a"), ("u", 2, "b"), ("u", 1, "a"), ("u", 1, "b"), ("u", 3, "c"), ("u", 3, "a"), ("u", 4, "c"), ("u", None, "d"), (None, 1, "a"), ("n", 5, None), ("none", None, "x")]
    got = retrieval.greedy_cover(spark.createDataFrame(rows, "user string, c long, item string"), "user", "c", "item", 5)
    assert {tuple(r) for r in got.collect()} == {("u", 1, 1, 2), ("u", 2, 3, 1), (None, 1, 1, 1), ("n", 1, 5, 1)}
    assert "Pandas" not in got._jdf.queryExecution().executedPlan().toString()


def test_packed_vectors_do_not_pass_through_the_driver(spark):
    v = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(50)], "vec_id long, embedding array<double>")
    found = retrieval.cosine_top_k(v, v.filter("vec_id < 3").select(F.col("vec_id").alias("query_id"), "embedding"), 2)
    found.collect()
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_multisets_split_their_text_once(spark):
    from logloom.functions import arrays

    words = F.split(F.col("t"), " ")
    df = spark.createDataFrame([("a b a c",), ("",)], "t string").select(F.round(arrays.multiset_jaccard(F.slice(words, 1, 3), F.slice(words, 2, 3)), 6).alias("j"))
    assert [r["j"] for r in df.collect()] == [0.5, 0.0] or [r["j"] for r in df.collect()] == [0.5, 1.0]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 2

import json

import pytest
from pyspark.sql import functions as F

from logloom.operators import build, rules

TREE = "array<struct<topics:array<struct<topic:string,evidence:array<int>>>,interest_name:string,actual_activity:string>>"


def test_calls_are_merged_by_fingerprint(spark):
    tree = lambda name, activity=None: [([("t", [1])], name, activity)]
    schema = f"user_id string, date string, interests {TREE}"
    delta = spark.createDataFrame([("u", "d", tree("A")), ("v", "d", tree("B")), ("w", "d", tree("C")), ("w", "d", tree("C"))], schema)
    actual = spark.createDataFrame([("u", "d", tree("A", "does a")), ("w", "d", tree("C", "x"))], schema)
    got = sorted((r["user_id"], r["reason"], r["interests"] and r["interests"][0]["actual_activity"]) for r in build.merge_calls(delta, actual).collect())
    assert got == [("u", None, "does a"), ("v", "actual:missing", None), ("w", "duplicate_key", None), ("w", "duplicate_key", None)]


def test_examples_renumber_signals_and_evidence(spark):
    signals = [(5, "2025-02-01", "web", "b"), (9, "2025-01-01", None, "a")]
    rows = [("00000000000000ff", "en", signals, [([("t", [9, 5, 9])], "A", "x")])]
    df = spark.createDataFrame(rows, f"user_hash string, language string, signals {build.SIGNALS}, interests {TREE}")
    row = build.layer1_examples(df, "P\n").first()
    ask, answer = (m["content"] for m in row["messages"])
    assert ask.split("\n") == ["P", '{"idx":0,"date":"2025-01-01","source":null,"action":"a"}', '{"idx":1,"date":"2025-02-01","source":"web","action":"b"}']
    assert json.loads(answer)["interests"][0]["topics"][0]["evidence"] == [0, 1] and row["split"] == "train"
    bad = spark.createDataFrame([("0f", "en", signals, [([("t", [7])], "A", "x")])], df.schema)
    with pytest.raises(Exception, match="evidence idx"):
        build.layer1_examples(bad, "").collect()


def test_publishing_caps_test_users_and_checks_leaks(spark):
    rows = [(f"u{i}", "test" if i < 4 else "train", 10 + i) for i in range(12) for _ in range(2)]
    df = spark.createDataFrame(rows, "u string, s string, n int")
    train, test, summary = build.publish(df, "u", "s", "n", F.col("n"), 20, 5, 2)
    assert test.count() == 4 and test.select("u").distinct().count() == 2 and set(r["shard"] for r in train.collect()) == {0, 1}
    assert {r["s"]: r["rows_over_max_tokens"] for r in summary.collect()} == {"test": 0, "train": 2}
    with pytest.raises(ValueError):
        build.publish(df.union(spark.createDataFrame([("u0", "train", 1), ("u1", "train", 1), ("u2", "train", 1), ("u3", "train", 1)], df.schema)), "u", "s", "n", F.col("n"), 20, 5, 2)


def test_compact_and_ranked(spark):
    df = spark.createDataFrame([([" A", "a", None, "None", "b", "c"],)], "v array<string>")
    assert df.select(build.compact(F.col("v"), 2)).first()[0] == ["A", "b"]
    one = lambda n, c, f: (n, c, f, [("t1", 1), ("t2", 5), ("T2", 3)])
    df = spark.createDataFrame([([one("x", 1, 0.9), one("y", 2, 0.1), one("z", 2, 0.5)],)], "i array<struct<interest_name:string,count:int,confidence:double,topics:array<struct<topic:string,count:int>>>>")
    got = df.select(build.ranked_interests(F.col("i"))).first()[0]
    assert [g["interest_name"] for g in got] == ["z", "y", "x"] and got[0]["topics"] == ["t2", "t1"]


def test_mission_and_negative_rules():
    row = {"user_id": "u77", "input": {"commercial_interests": "### Interest 1: Tea\ntext\n### Interest 2: Cars\n"}, "output": {"candidate_missions": [{"mission_name": "m", "source_interests": ["Tea"], "scenarios": ["travel"]}]}}
    assert rules.missions(row) == (set(), set())
    row["output"]["candidate_missions"][0]["mission_name"] = "for u77"
    row["output"]["candidate_missions"][0]["source_interests"] = ["Interest 1: Tea"]
    assert rules.missions(row)[0] == {"inconsistent_content", "text_quality"}
    row["output"]["candidate_missions"][0]["scenarios"] = ["sleep"]
    assert rules.missions(row)[0] == {"json_format"}
    signals = [{"idx": i, "date": "2025-01-01", "source": "s", "detailed_source": "d", "action": "Hide | x"} for i in range(2)]
    entry = {"keywords": "cheap cars", "evidence": [0, 1], "source": ["s"], "detailed_source": "d", "signal_type": ["hide"], "reliability_score": 0.5}
    row = {"input": {"signals": signals}, "output": {"negative_interests": [entry]}}
    assert rules.negative(row) == (set(), set())
    row["output"]["negative_interests"] = [entry | {"keywords": "Disliked ads", "evidence": [0]}]
    assert rules.negative(row)[0] == {"inconsistent_content", "text_quality"}
    assert rules.evidence_numbers([1, "0", 1.0, True, {"i": 3}, 9, None], 4) == [1, 0, 3]

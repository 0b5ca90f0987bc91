"""Nested snapshots against a plain walk over the weeks, over a stream, and in the cases their rules name."""

import datetime
from collections import defaultdict

from pyspark.sql import functions as F

from logloom.operators import snapshots
from logloom.plans.queries import QUERIES, weekly_decisions
from logloom.streaming.windows import nested_profiles

D = datetime.date


def walk(rows):
    """Confidence, count, dates and topics of each (user, window, name), in a world where no interest is renamed."""
    users, out = defaultdict(dict), {}
    for (user, _), part in _weeks(rows):
        held, date = users[user], part[0]["date"]
        before = held.pop("", date)
        fade = 0.98 ** min((date - before).days, 7)
        seen = {r["name"]: r for r in part}
        for name, i in held.items():
            if name not in seen:
                i["c"] = round(i["c"] * fade, 4)
            else:
                i["c"], i["n"], i["last"] = round(0.4 * i["c"] + 0.6, 4), i["n"] + 1, date
            for t in i["topics"].values():
                t["hit"] = False
        for name, r in seen.items():
            new = name not in held
            i = held.setdefault(name, {"c": 0.75 if len(r["topics"]) > 1 else 0.6, "n": 1, "first": date, "last": date, "topics": {}})
            for t in r["topics"]:
                e = [(x["date"], x["source"], x["action"]) for x in t["evidence"]]
                if t["topic"] in i["topics"]:
                    k = i["topics"][t["topic"]]
                    every = sorted(dict.fromkeys(k["e"] + e), key=lambda x: x[0])
                    k |= {"c": round(0.4 * k["c"] + 0.6, 4), "n": k["n"] + t["count"], "e": every[-3:], "hit": True}
                else:
                    i["topics"][t["topic"]] = {"c": 0.6, "n": 1, "e": e[-3:], "hit": True}
            assert not new or i["n"] == 1
        for i in held.values():
            for t in i["topics"].values():
                if not t.pop("hit"):
                    t["c"] = round(t["c"] * fade, 4)
            i["topics"] = {k: t for k, t in i["topics"].items() if t["c"] > 0.01}
        for name in [n for n, i in held.items() if i["c"] <= 0.01]:
            del held[name]
        for name, i in held.items():
            out[user, part[0]["window"], name] = (i["c"], i["n"], i["first"].isoformat(), i["last"].isoformat(), sorted((k, t["c"], t["n"], t["e"]) for k, t in i["topics"].items()))
        held[""] = date
    return out


def _weeks(rows):
    weeks = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["user_id"], r["window"], r["late"], r["position"])):
        weeks[r["user_id"], r["window"]].append(r)
    return weeks.items()


def test_snapshots_of_all_events_equal_a_plain_walk(spark, sf):
    want = walk([r.asDict(recursive=True) for r in weekly_decisions(spark, sf).withColumn("user_id", F.col("user_id").cast("string")).collect()])
    rows = [r.asDict(recursive=True) for r in QUERIES["z5_nested_snapshots"](spark, sf).collect()]
    got = {(r["user_id"], r["window"], r["name"]): (r["confidence"], r["count"], r["first_date"], r["last_date"], sorted((t["topic"], t["confidence"], t["count"], [(e["date"], e["source"], e["action"]) for e in t["evidence"]]) for t in r["topics"])) for r in rows}
    assert got == want and len(got) == len(rows)


def topic(name, *days, count=1, source=("web",), intent=""):
    return {"topic": name, "count": count, "source": list(source), "intent": intent, "evidence": [{"date": d, "source": "web", "action": f"{name} {d}"} for d in days]}


DELTAS = "user_id string, window int, date date, position int, name string, activity string, topics " + snapshots.TOPICS
DECISIONS = "user_id string, window int, position int, action string, name string, target string, result string, activity string"


def nested_case(spark):
    a, b, c = D(2025, 1, 7), D(2025, 1, 14), D(2025, 1, 21)
    deltas = [
        ("u", 0, a, 0, "Tea", "brews", [topic("green", "2025-01-01", "bad", "20250103", "2025-01-02T10:00:00Z"), topic(" ", "2025-01-01")]),
        ("u", 0, a, 1, "Bikes", "rides", [topic("road"), topic("Road")]),
        ("u", 1, b, 0, "TEA", "drinks", [topic("GREEN ", "2025-01-09", "2025-01-10", "2025-01-11", count=4, source=("web", "app"), intent="buy"), topic("black")]),
        ("u", 2, c, 0, "Cars", "drives", [topic("suv")]), ("u", 2, c, 1, "Tea", "x", []), (None, 0, a, 0, "lost", "", []), ("v", 0, a, 0, "Solo", "s", None),
    ]
    decisions = [("u", 0, 0, "add", "Tea", None, None, ""), ("u", 1, 0, "merge", "tea", "TEA", "Fine Tea", "sips"), ("u", 2, 0, "merge", "Cars", "Bikes", "fine tea", ""), ("u", 2, 1, None, "Tea", None, None, None)]
    return snapshots.decisions_for(spark.createDataFrame(deltas, DELTAS), spark.createDataFrame(decisions, DECISIONS))


def test_merges_renames_backfill_and_evidence(spark):
    rows = {(r["user_id"], r["window"], r["name"]): r for r in snapshots.fold(nested_case(spark)).collect()}
    tea = rows["u", 0, "Tea"]
    assert (tea["confidence"], tea["event"], tea["state"], [t["topic"] for t in tea["topics"]]) == (0.75, "added", "Emerging", ["green", " "])
    assert rows["u", 0, "Bikes"]["event"] == "added" and rows["v", 0, "Solo"]["topics"] == []  # no decision names them
    fine = rows["u", 1, "Fine Tea"]
    green, black = fine["topics"]
    assert (fine["confidence"], fine["count"], fine["activity"], fine["source"]) == (0.9, 2, "sips", ["web", "app"]) and ("u", 1, "Tea") not in rows
    assert (green["topic"], green["count"], green["confidence"], green["intent"], [e["date"] for e in green["evidence"]]) == ("green", 5, 0.84, "buy", ["2025-01-09", "2025-01-10", "2025-01-11"])
    assert black["confidence"] == 0.6 and rows["u", 1, "Bikes"]["confidence"] == round(0.75 * 0.98**7, 4) and rows["u", 1, "Bikes"]["event"] == "decayed"
    # the merge of cars into bikes takes the name of the tea, the late add of tea begins an interest of its own
    assert {(n, rows["u", 2, n]["event"]) for u, w, n in rows if (u, w) == ("u", 2)} == {("fine tea", "boosted"), ("Tea", "added")}
    assert snapshots.fold(nested_case(spark).limit(0)).count() == 0 and all(u for u, _, _ in rows)


def test_a_stream_of_decisions_gives_the_rows_of_the_batch(spark, tmp_path):
    df = nested_case(spark)
    for w in range(3):
        df.filter(F.col("window") == w).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in{w}")
    held = spark.read.schema(df.schema).parquet(*[f"{tmp_path}/in{w}" for w in range(3)])
    want = sorted((repr(r) for r in snapshots.fold(held).collect()))
    (tmp_path / "all").mkdir()
    for w in range(3):
        source = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/all")
        spark.read.parquet(f"{tmp_path}/in{w}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/all")
        q = nested_profiles(source).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").outputMode("append").start()
        q.processAllAvailable()
        q.stop()
    assert sorted(repr(r) for r in spark.read.parquet(f"{tmp_path}/out").select(*held.sparkSession.createDataFrame([], snapshots.NESTED).columns).collect()) == want

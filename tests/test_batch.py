from pyspark.sql import functions as F

from logloom.operators import batch


def test_row_batches(spark):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(3)], "row bigint, v string")
    assert [r["v"] for r in batch.repeated_rows(df, "row", 2).orderBy("row").collect()] == ["v0", "v0", "v1", "v1", "v2", "v2"]
    assert [r["v"] for r in batch.repeated_rows(df, "row", 2, False).orderBy("row").collect()] == ["v0", "v1", "v2"] * 2
    assert [r["part"] for r in batch.parts(df, "row", 2).orderBy("row").collect()] == [0, 0, 1]
    assert [r["mini_batch"] for r in batch.mini_batches(df, "row", 2).orderBy("row").collect()] == [0, 0, 1]
    wide = spark.createDataFrame([(0, ["a", "b"], [1, 2])], "row int, x array<string>, y array<int>")
    assert [tuple(r) for r in batch.unfolded(wide, "row", ["x", "y"]).collect()] == [(0, 0, "a", 1), (0, 1, "b", 2)]


def test_gates_and_catalogue(spark):
    df = spark.createDataFrame([("High ", True), ("low", True), ("high", None), (None, True)], "s string, c boolean")
    assert [r[0] for r in df.select(batch.score_gate(F.col("s"), F.col("c"), "medium")).collect()] == [True, False, False, False]
    assert [r[0] for r in df.select(batch.score_gate(F.col("s"), F.col("c"), "any", False)).collect()] == [True] * 4
    found = batch.resolved(spark.createDataFrame([("TEA",), ("cars",), ("x",)], "n string"), "n", spark.createDataFrame([("Tea",), ("Cars",), ("CARS",)], "e string"), "e")
    assert {r["n"]: r["e"] for r in found.collect()} == {"TEA": "Tea", "cars": None, "x": None}
    assert batch.inconsistent_ids(spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b")], "i int, t string"), "i", "t").collect()[0]["i"] == 2


def test_votes_trends_and_samples(spark):
    df = spark.createDataFrame([("p", "x", 1.0, 0), ("p", "y", 2.0, 1), ("p", "y", 3.0, 2)], "k string, l string, v double, o int")
    assert batch.modal_value(df, ["k"], "l", "v", "o").first()["v"] == 2.0
    t = batch.trend(spark.createDataFrame([(1, "a", 1.0), (1, "a", 3.0), (1, "b", 2.0)], "s int, g string, r double"), "s", "g", "r").first()
    assert (t["mean_reward"], t["mean_best"]) == (2.0, 2.5)
    assert {r["l"]: r["rows"] for r in batch.shares(df, "l").collect()} == {"x": 1, "y": 2}
    many = spark.createDataFrame([("u", d, i) for d in "abc" for i in range(4)], "u string, d string, i int")
    got = batch.domain_sample(many, "u", "d", "i", 1, 2).collect()
    assert len(got) == 2 and len({r["d"] for r in got}) == 2


def test_queries_and_evidence(spark):
    df = spark.createDataFrame([("u", "m1", 0, ["Tea", "car"]), ("u", "m2", 1, ["tea "]), ("u", "m3", 2, ["car", "new"])], "u string, m string, o int, q array<string>")
    assert sorted((r["m"], r["q"]) for r in batch.deduped_queries(df, "u", "m", "o", "q").collect()) == [("m1", ["Tea", "car"]), ("m3", ["new"])]
    e = spark.createDataFrame([([("2025-01-02", "s", "b"), ("20250101", "s", "a"), ("2025-01-02", "s", "b"), ("no day", "s", "e"), ("2025-01-03", "s", "d"), ("2025-01-03", "s", "c")],)], "e array<struct<date:string,source:string,action:string>>")
    assert [x["action"] for x in e.select(batch.latest_evidence(F.col("e"))).first()[0]] == ["b", "d", "c"]
    text = e.select(batch.profile_text({"a": F.col("e")})).first()[0]
    assert text.startswith('a: {"date":"2025-01-02"') and text.count('"2025-01-02"') == 1

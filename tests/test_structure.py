"""JSON facts, sections, reports and merges where their queries do not reach."""

from pyspark.sql import functions as F

from logloom.functions import structure
from logloom.operators import evaluation, merges


def column(spark, values, f, kind="string"):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").orderBy("i").select(f(F.col("v"))).collect()]


def test_json_facts_of_odd_texts(spark):
    odd = [None, "", "{", "1e3", " -2 ", '"a b"', "[1, 2]", "null", "true", '{"a" : "x \\" { y"}', "{}"]
    assert column(spark, odd, structure.json_type) == [None, None, None, "number", "number", "string", "array", "null", "boolean", "object", "object"]
    assert column(spark, odd, structure.minified)[5:] == ['"a b"', "[1,2]", "null", "true", '{"a":"x \\" { y"}', "{}"]
    assert column(spark, odd, lambda x: structure.has_keys(x, ["a"])) == [False] * 9 + [True, False]
    nested = ['{"a":{"x":1,"y":2}}', '{"a":{"y":2}}', '{"a":[]}', '{"a":[{"x":1,"y":[2]},{"y":3,"x":4}]}', '{"a":[{"x":1}]}', "{}", None]
    assert column(spark, nested, lambda x: structure.has_keys(x, ["y", "x"], "$.a")) == [True] + [False] * 6
    assert column(spark, nested, lambda x: structure.each_has_keys(x, ["y", "x"], "$.a")) == [False, False, True, True, False, False, False]


def test_sections_and_blocks_of_odd_texts(spark):
    texts = [None, "", "## A\nx\n## B\ny", "no ## A\nx", "## A", "## A  \n\n x \n\n## C"]
    assert column(spark, texts, lambda x: structure.section(x, "A")) == [None, None, "x", None, "", "x"]
    blocks = ["", "### Interest 1: a\nx\n### Interest 2: b", "### Interest 1: a\n1\n### Interest 2: a\n2\n", "text ### Interest 1: a"]
    assert column(spark, blocks, structure.heading_blocks) == [{}, {"a": "x\n", "b": ""}, {"a": "2\n"}, {}]
    held = ["- Existing queries:\n  - a b \n  - c\n- X\n  - d", "- Existing queries: none\n", "", None, "- Brands: A, b ,, C\n"]
    assert column(spark, held, structure.existing_queries) == [["a b", "c"], [], [], None, []]
    assert column(spark, held, structure.known_brands) == [[], [], [], None, ["a", "b", "c"]]


def test_logits_and_sources(spark):
    z = [[1.0, 1.0, 0.0], [1000.0, 999.0], [0.0], None]
    assert column(spark, z, structure.best_class, "array<double>") == [0, 0, 0, None]
    assert [x and round(sum(x), 9) for x in column(spark, z, structure.softmax, "array<double>")] == [1.0, 1.0, 1.0, None]
    assert column(spark, ["BING", "Other", None, "edge"], lambda x: structure.canonical_source(x, ["Bing", "Edge"])) == ["Bing", "Other", None, "Edge"]


def test_percentiles_and_ratios_of_small_groups(spark):
    values = [[5], [1, 2], list(range(10)), []]
    assert column(spark, values, lambda x: evaluation.ranked_values(x, 0.9), "array<int>") == [5, 2, 9, None]
    rows = [("a", True, True, 3), ("a", True, False, 1), ("a", True, None, 8), ("a", None, None, None), ("b", False, False, 4)]
    df = spark.createDataFrame(rows, "k string, v boolean, p boolean, n int")
    got = {r["k"]: tuple(r)[1:] for r in evaluation.answer_summary(df, ["k"], "v", "p", "n").collect()}
    assert got == {"a": (4, 0.75, 0.25, 1, 3.0, 8, 8), "b": (1, 0.0, 0.0, None, None, None, None)}
    ratio = evaluation.task_ratios(df, ["k"], {"of_all": (F.col("p"), None), "of_valid": (F.col("p"), F.col("v"))})
    assert {r["k"]: (r["of_all"], r["of_valid"] and round(r["of_valid"], 4)) for r in ratio.collect()} == {"a": (0.25, 0.3333), "b": (0.0, None)}
    cited = spark.createDataFrame([("x", "i", [1, 1, 2]), ("x", "i", [2]), ("x", "j", None), ("y", "i", [])], "a string, i string, c array<int>")
    shape = {r["a"]: (r["topics_per_interest"], r["evidence_per_topic"], r["citations_per_evidence"]) for r in evaluation.structure_signals(cited, "a", "i", "c").collect()}
    assert shape == {"x": (1.5, 1.0, 1.5), "y": (1.0, 0.0, None)}


def test_merges_of_repeated_and_missing_keys(spark):
    o = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (3, "d")], "k int, o string")
    i = spark.createDataFrame([(1, "x"), (3, "y"), (3, "z"), (4, "w")], "k int, i string")
    assert {(r["k"], r["reason"]) for r in merges.decisions_merge(o, i, ["k"]).collect()} == {(1, None), (3, "input_missing"), (4, "output_missing")}
    new = merges.new_answers(spark.createDataFrame([(1, "Tea  time"), (1, "cups"), (2, "tea time")], "k int, q string"), spark.createDataFrame([(1, "tea TIME ")], "k int, q string"), ["k"], "q")
    assert sorted(map(tuple, new.select("k", "q").collect())) == [(1, "cups"), (2, "tea time")]
    pairs = merges.preference_pairs(spark.createDataFrame([("p", "a", 1.0), ("p", "b", 2.0), ("p", "c", 2.0), ("q", "a", 1.0), ("q", "b", 1.0)], "p string, a string, s double"), "p", "a", "s")
    assert [tuple(r) for r in pairs.collect()] == [("p", "b", "a")]
    loaded = merges.loader_split(spark.createDataFrame([(k, k) for k in range(11)], "k int, n int"), "k", "n", 8, 7, 3, 1).collect()
    assert len(loaded) == 6 and {r["part"] for r in loaded} == {0, 1, 2} and max(r["n"] for r in loaded) <= 8

"""Text functions against the values of Python's own folding and word characters."""

import random

from pyspark.sql import functions as F

from logloom.functions import text
from logloom.operators.rules import key_of


def test_names_fold_as_python_does(spark):
    r = random.Random(4)
    letters = [*text.FOLDED, *"aZéΣςß_-  .é", "\u0301", "ह", "ि", "豈", "½", "İ", "Ⅷ"]
    made = ["ΟΔΟΣ", "e\u0301tude", "हिन्दी", "ﬁne", "Straße", "", *("".join(r.choice(letters) for _ in range(r.randint(0, 8))) for _ in range(10_000))]
    df = spark.createDataFrame([(t,) for t in made], "t string").select("t", text.normalize_name(F.col("t")).alias("n"))
    assert [(x["t"], x["n"]) for x in df.collect() if x["n"] != key_of(x["t"])] == []


def test_unspaced_ranges(spark):
    texts = {"豈更": True, "䷀": True, "かな": True, "abc": False, "한국": False}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.unspaced(F.col("t")).alias("u"))
    assert {x["t"]: x["u"] for x in df.collect()} == texts

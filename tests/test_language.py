"""Writing systems, vocabularies and votes, where the tables (Latin texts) do not reach."""

import unicodedata

from pyspark.sql import functions as F

from logloom.operators import language


def test_script_words_by_unicode_names(spark):
    texts = ["Hello wörld", "Привет world-мир", "日本 ひらがな mixedかな", "ΑΒΓ αβγ x", "שלום عالم", "ไทย한국어", "12 3_4 ...", "", None, "aЖ" * 3 + " b", "x" * 50_000 + " й"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", language.script_words(F.col("t")).alias("m"), language.main_script(language.script_words(F.col("t"))).alias("top")).orderBy("i").collect()

    def by_hand(t):
        out = {}
        word = ""
        for c in (t or "") + " ":
            if c.isalpha():
                word += c
                continue
            names = [unicodedata.name(x).split(" ")[0].lower() for x in word]
            kinds = ["cjk" if n in ("cjk", "hiragana", "katakana") else n for n in names]
            for k in kinds:
                if k == "cjk":
                    out["cjk"] = out.get("cjk", 0) + 1
            for k in set(kinds) - {"cjk"}:
                out[k] = out.get(k, 0) + 1
            word = ""
        return out

    assert [r["m"] for r in rows] == [by_hand(t) for t in texts]
    assert [r["top"] for r in rows][:3] == ["latin", "cyrillic", "cjk"] and rows[7]["top"] is None


def test_name_checks_by_script_and_vocabulary(spark):
    known = spark.createDataFrame([("en", w, 30) for w in ("green", "garden", "tea")] + [("fr", w, 30) for w in ("jardin", "vert", "tea")] + [("en", "vert", 5)], "family string, word string, texts long")
    scripts = spark.createDataFrame([("en", "latin"), ("fr", "latin"), ("ru", "cyrillic"), ("th", "thai")], "language string, script string")
    rows = [
        ("same", "Green garden", "the garden", "en", 1.0, "en", 1.0), ("other", "Jardin Vert", "the garden is green", "en", 1.0, "fr", 1.0), ("shared", "Vert tea", "the garden", "en", 1.0, "fr", 1.0),
        ("unknown", "Jardin zzz", "the garden", "en", 1.0, "fr", 1.0), ("unsure", "Jardin Vert", "the garden", "en", 0.8, "fr", 1.0), ("one", "Jardin", "the garden", "en", 1.0, "fr", 1.0), ("acronym", "BMW 3", "Привет мир", "ru", 1.0, "ru", 1.0),
        ("script", "Garden", "Привет мир", "ru", 1.0, "en", 1.0), ("mixed", "Сад garden", "Привет мир", "ru", 1.0, "en", 1.0), ("half", "Garden", "garden tea мир", "ru", 1.0, "en", 1.0), ("latin", "Сад garden", "the garden", "en", 1.0, "en", 1.0),
        ("empty", "", "the garden", "en", 1.0, None, None), ("nulls", None, None, None, None, None, None), ("model", "ไทย", "the garden", "xx", 1.0, "th", 1.0),
    ]
    df = spark.createDataFrame(rows, "id string, name string, activity string, language string, probability double, name_language string, name_probability double")
    got = {r["id"]: r["reason"] for r in language.name_checks(df, known, scripts, "id").collect()}
    wrong = {"other": "language_mismatch", "script": "script_mismatch", "latin": "script_mismatch", "model": "script_mismatch"}
    assert got == {r[0]: wrong.get(r[0]) for r in rows}


def test_units_of_texts_without_a_vote_do_not_count(spark):
    rows = [(1, 1, True, "hello there", "en", 0.9), (1, 1, False, "bonjour", "fr", 0.9), (1, 2, True, "www.x.com", "en", 0.9), (1, 2, False, "x", "en", 0.9), (1, 3, True, "hola", "es", 0.9), (1, 3, False, "ola", "pt", 0.9), (2, 1, True, "a", "en", 0.9), (2, 1, False, "A ", "de", 0.9), (2, 1, False, "b", "fr", 0.9), (2, 2, True, "q", "en", 0.2)]
    df = spark.createDataFrame(rows, "r int, u int, anchor boolean, text string, language string, probability double")
    got = {r["r"]: tuple(r)[1:] for r in language.language_units(df, "r", "u", "anchor").collect()}
    assert got == {1: (1, 0, 1, 1, False)}
    kept = language.kept_languages(df, ["r", "u"], "text", F.lit("en"), ["en"]).collect()
    assert {(r["r"], r["u"]) for r in kept} == {(1, 2), (2, 2)} and {r["voted"] for r in kept if r["u"] == 2 and r["r"] == 2} == {False}


def test_words_fold_alike_one_by_one_and_as_a_text(spark):
    texts = ["Straße STRASSE straße ΣΑΣ σας", "İstanbul ﬁnal ŉab Ǆabc µµµ", "", None, "ab cd", "ſſſ\nSSS 12 a1b2 éÉé\u0301x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    words = F.regexp_extract_all(F.coalesce("t", F.lit("")), F.lit(r"(\p{L}{3,})"), F.lit(1))
    both = df.select(language.vocabulary_words(F.col("t")).alias("a"), F.array_distinct(F.transform(words, language.fold)).alias("b")).collect()
    assert [r["a"] for r in both] == [r["b"] for r in both]


def test_signs_of_a_script_that_are_no_letters_are_no_words(spark):
    df = spark.createDataFrame([("Ⅷ abc १२ ҂ мир x\u03bcy µg",)], "t string")
    assert df.select(language.script_words(F.col("t")).alias("m")).first()["m"] == {"latin": 3, "cyrillic": 1, "greek": 1}


def test_texts_are_searched_once_for_every_use_of_their_counts(spark):
    """Counts named in many places used to be computed in each."""
    df = spark.createDataFrame([("a", "b", "c", "en", 1.0, "fr", 1.0)], "id string, name string, activity string, language string, probability double, name_language string, name_probability double")
    count = lambda d: d._jdf.queryExecution().optimizedPlan().toString().count("x{2000}")
    assert count(df.select(language.script_words(F.col("activity")))) <= 2  # 46 before
    known, scripts = spark.createDataFrame([("en", "a", 30)], "family string, word string, texts long"), spark.createDataFrame([("en", "latin")], "language string, script string")
    assert count(language.name_checks(df, known, scripts, "id")) <= 4  # 368 before

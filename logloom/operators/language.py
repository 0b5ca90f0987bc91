"""Languages of texts by writing system and vocabulary: counts, votes and consistency checks, all Column expressions.

Predictions of an external model come as columns (language and probability); nothing here loads one. A word is a run of
letters; a Chinese or Japanese character is a word of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logloom.functions.arrays import once
from logloom.functions.text import collapse_space, fold, folds_apart
from logloom.operators.sizing import small

#: Writing systems that are told apart, and the ones that are counted by character as ``cjk``.
SCRIPTS = (
    "latin", "cyrillic", "greek", "arabic", "hebrew", "armenian", "georgian", "devanagari", "bengali", "gurmukhi", "gujarati",
    "tamil", "telugu", "kannada", "malayalam", "sinhala", "thai", "lao", "myanmar", "khmer", "tibetan", "ethiopic", "hangul",
)
CJK = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}]"
#: Languages that are close enough to count as one, and names that are no language at all.
FAMILIES = (("es", "pt", "ca", "gl"), ("da", "no", "nn", "sv"), ("cs", "sk"), ("hr", "sr", "bs", "sh", "sl"), ("id", "ms"), ("nl", "de", "af", "lb", "fy"), ("zh", "zh-Hans", "zh-Hant"))
ACRONYM = r"^[A-Z0-9&.+\-/ ]+$"
URL_LIKE = r"(?i)(https?://|www\.|^\S+\.(com|net|org|de|jp|fr|co|io|uk|au|cn|br|es|it|nl|ru)(/\S*)?$)"
#: Characters beyond Latin: texts without one are spared the other counts.
BEYOND = r"[^\x00-\x{24F}\x{1E00}-\x{1EFF}\x{2000}-\x{20CF}]"


def family(language: Column, families: Sequence[Sequence[str]] = FAMILIES) -> Column:
    """The first of a language's family; itself, where it has none."""
    out = language
    for held in families:
        out = F.when(language.isin(*held), held[0]).otherwise(out)
    return out


def words_with(x: Column, script: str) -> Column:
    """Words that hold a letter of ``script``: each is read once, from its first letter."""
    kind = rf"\p{{Is{script.capitalize()}}}"
    return F.regexp_count(x, F.lit(rf"(?<!\p{{L}})[\p{{L}}&&[^{kind}]]*+[\p{{L}}&&{kind}]\p{{L}}*+")).cast("bigint")


#: A word that holds a letter beyond Latin.
OTHER_WORD = r"(?<!\p{L})[\p{L}&&\p{IsLatin}]*+[\p{L}&&[^\p{IsLatin}]]\p{L}*+"


def script_words(x: Column, scripts: Sequence[str] = SCRIPTS) -> Column:
    """Map of writing system to words of a text that use it, without zeros; null gives an empty map.

    A text is read once for Latin. Only where it has characters beyond are its other words taken out, once, and counted for each system.
    """
    text = F.coalesce(x, F.lit(""))
    entry = lambda s, n: F.struct(F.lit(s).alias("key"), n.cast("bigint").alias("value"))
    latin = [entry("latin", words_with(text, "latin"))] if "latin" in scripts else []
    counted = lambda rest: F.array(*latin, *[entry(s, words_with(rest, s)) for s in scripts if s != "latin"], entry("cjk", F.regexp_count(text, F.lit(CJK))))
    rest = F.array_join(F.regexp_extract_all(text, F.lit(OTHER_WORD), F.lit(0)), " ")
    pairs = F.when(text.rlike(BEYOND), once(rest, counted)).otherwise(F.array(*latin) if latin else F.array().cast("array<struct<key:string,value:bigint>>"))
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"] > 0))


def main_script(counts: Column) -> Column:
    """The writing system of most words, ties to the first by name; null where there is none."""
    entries = F.map_entries(counts)
    return F.aggregate(entries, F.struct(F.lit(None).cast("string").alias("key"), F.lit(0).cast("bigint").alias("value")), lambda a, e: F.when((e["value"] > a["value"]) | ((e["value"] == a["value"]) & (e["key"] < a["key"])), e).otherwise(a))["key"]


def writing_systems(texts: DataFrame, language: str, text: str) -> DataFrame:
    """(language, script, words): the writing system that most words of a language's texts use."""
    counts = texts.select(language, F.explode_outer(script_words(F.col(text))).alias("script", "words")).filter("script is not null")
    summed = counts.groupBy(language, "script").agg(F.sum("words").alias("words"))
    best = F.min_by(F.struct("script", "words"), F.struct(-F.col("words"), F.col("script")))
    return summed.groupBy(language).agg(best.alias("b")).select(language, "b.script", "b.words")


def vocabulary_words(x: Column, least: int = 3) -> Column:
    """Distinct folded words of at least ``least`` letters: they are folded as one text, a word a line, and not one by one."""
    words = F.array_join(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(rf"(\p{{L}}{{{least},}})"), F.lit(1)), "\n")
    folded = once(words, lambda w: F.when(folds_apart(w), fold(w)).otherwise(F.lower(w)))
    return F.array_remove(F.array_distinct(F.split(folded, "\n")), "")


def vocabulary(texts: DataFrame, language: str, text: str, least: int = 1, families: Sequence[Sequence[str]] = FAMILIES) -> DataFrame:
    """(family, word, texts): in how many texts of a family a word stands, from ``least`` on. Counts are summed before they are shuffled."""
    words = texts.filter(F.col(language).isNotNull()).select(family(F.col(language), families).alias("family"), vocabulary_words(F.col(text)).alias("words"))
    rows = words.select("family", F.explode_outer("words").alias("word")).filter("word is not null")  # the inner form would compute the words again, for a filter
    return rows.groupBy("family", "word").agg(F.count("*").alias("texts")).filter(F.col("texts") >= least)


def vote_by_words(texts: DataFrame, known: DataFrame, key: str, text: str) -> DataFrame:
    """(key, words, votes, family) of every row: the family whose vocabulary knows most of a text's words, ties to the first by name.

    Each row of ``texts`` has a key of its own. A text without a known word has no family.
    """
    words = texts.select(key, vocabulary_words(F.col(text)).alias("held"))
    each = words.select(key, F.size("held").alias("words"), F.explode_outer("held").alias("word"))
    votes = each.join(small(known.select("family", "word")), "word", "left").groupBy(key, "words", "family").agg(F.count("family").alias("votes"))
    least = F.when(F.col("family").isNotNull(), F.struct(-F.col("votes"), F.col("family")))
    return votes.groupBy(key, "words").agg(F.max("votes").alias("votes"), F.min_by("family", least).alias("family")).select(key, "words", "votes", "family")


def name_checks(
    rows: DataFrame, known: DataFrame, scripts: DataFrame, key: str,
    least: int = 20, confident: float = 0.5, sure: float = 0.9, families: Sequence[Sequence[str]] = FAMILIES,
) -> DataFrame:
    """``rows`` with ``reason``: script_mismatch or language_mismatch where a name is not in the language of its activity, else null.

    ``rows`` has key, name, activity and the predictions language, probability, name_language, name_probability. ``scripts`` has the
    writing system of each language (language, script; as ``writing_systems`` gives them); ``known`` is a ``vocabulary``.
    An acronym and texts without letters pass. A prediction counts from ``confident`` on, and only if at least half of
    the activity's words use its writing system. Latin names of two words or more are held against both
    vocabularies, where both predictions are ``sure`` and of different families: they mismatch, if ``least`` texts of their
    own family know every word of them and fewer of the activity's family know any. Only such names are shuffled, word by word.
    """
    names = [c for c in rows.columns if c != key]
    table = small(scripts.select("language", F.col("script").alias("__told")))
    said = rows.join(table, "language", "left")
    own, other = family(F.col("name_language"), families), family(F.col("language"), families)
    apart = (F.col("probability") >= sure) & (F.col("name_probability") >= sure) & (own != other)

    def judge(v: Column) -> Column:
        a, n = v["a"], v["n"]
        total = F.aggregate(F.map_values(a), F.lit(0).cast("bigint"), lambda s, n: s + n)
        told = F.when(F.col("probability") >= confident, F.col("__told"))
        expected = F.when(F.coalesce(F.try_element_at(a, told), F.lit(0)) * 2 >= total, told)
        open_ = ~F.col("name").rlike(ACRONYM) & (F.size(a) > 0) & (F.size(n) > 0)
        off = F.when(expected.isNull(), ~F.arrays_overlap(n, F.map_keys(a))).otherwise(~F.array_contains(n, expected) | ((expected == "latin") & (F.size(n) > 1)))
        several = (F.size(F.split(collapse_space(F.col("name")), " ")) >= 2) & (F.size(vocabulary_words(F.col("name"))) > 0)
        return F.struct(F.coalesce(open_ & off, F.lit(False)).alias("script"), F.coalesce(apart & open_ & ~off & (expected == "latin") & several, F.lit(False)).alias("asked"))

    systems = F.struct(script_words(F.col("activity")).alias("a"), F.map_keys(script_words(F.col("name"))).alias("n"))
    said = said.withColumn("__j", once(systems, judge))  # one expression, since every use of a text's counts would count it again
    each = said.filter(apart & F.col("__j.asked")).select(key, own.alias("own"), other.alias("other"), F.explode(vocabulary_words(F.col("name"))).alias("word"))
    counts = small(known.filter(F.col("texts") >= least).select("family", "word", F.lit(True).alias("knows")))
    mine = counts.select(F.col("family").alias("own"), "word", F.col("knows").alias("__mine"))
    theirs = counts.select(F.col("family").alias("other"), "word", F.col("knows").alias("__theirs"))
    judged = each.join(mine, ["own", "word"], "left").join(theirs, ["other", "word"], "left").groupBy(key).agg((F.every(F.coalesce("__mine", F.lit(False))) & ~F.some(F.coalesce("__theirs", F.lit(False)))).alias("__wrong"))
    out = said.join(judged, key, "left")
    return out.select(key, *names, F.when(F.col("__j.script"), "script_mismatch").when(F.col("__wrong"), "language_mismatch").alias("reason"))


def detected(rows: DataFrame, keys: Sequence[str], text: str = "text", language: str = "language", probability: str = "probability", confident: float = 0.5, share: float = 0.6) -> DataFrame:
    """(keys, language): what distinct texts of a unit, in any case and without URLs, agree on: ``mix`` below ``share``; units without a vote are left out."""
    keys = list(keys)
    clean = rows.withColumn("__t", fold(collapse_space(F.col(text)))).filter((F.col("__t") != "") & ~F.col("__t").rlike(URL_LIKE) & (F.col(probability) >= confident) & F.col(language).isNotNull())
    votes = clean.groupBy(*keys, "__t").agg(F.min(language).alias(language)).groupBy(*keys, language).agg(F.count("*").alias("__n"))
    best = votes.groupBy(*keys).agg(F.sum("__n").alias("__all"), F.max("__n").alias("__top"), F.min_by(language, F.struct(-F.col("__n"), F.col(language))).alias("__best"))
    return best.select(*keys, F.when(F.col("__top") >= share * F.col("__all"), F.col("__best")).otherwise("mix").alias(language))


def language_units(rows: DataFrame, record: str, unit: str, anchor: str, families: Sequence[Sequence[str]] = FAMILIES, **options) -> DataFrame:
    """Per record: units_en, match_en, units_glb, match_glb and ``wrong_language``, where under half of the units match their anchors.

    ``rows`` has one text each, of a unit of a record, true or false in ``anchor``. A unit counts where both its anchor texts
    and its others agree on a language; ``en`` units are those with an English anchor. Records without a counted unit are left out.
    """
    found = detected(rows, [record, unit, anchor], **options)
    sides = found.groupBy(record, unit).agg(F.max(F.when(F.col(anchor), F.col("language"))).alias("a"), F.max(F.when(~F.col(anchor), F.col("language"))).alias("t"))
    counted = sides.filter("a <> 'mix' and t <> 'mix'").withColumn("hit", (family(F.col("a"), families) == family(F.col("t"), families)).cast("bigint")).withColumn("en", F.col("a") == "en")
    total = lambda v, en: F.coalesce(F.sum(F.when(F.col("en") == en, v)), F.lit(0)).cast("bigint")
    out = counted.groupBy(record).agg(total(F.lit(1), True).alias("units_en"), total(F.col("hit"), True).alias("match_en"), total(F.lit(1), False).alias("units_glb"), total(F.col("hit"), False).alias("match_glb"))
    return out.withColumn("wrong_language", (F.col("match_en") + F.col("match_glb")) * 2 < F.col("units_en") + F.col("units_glb"))


def kept_languages(rows: DataFrame, keys: Sequence[str], text: str, locale: Column, allowed: Sequence[str], share: float = 0.6, least: int = 1, **options) -> DataFrame:
    """Units whose language is allowed: the vote of their texts or, where there are fewer than ``least`` distinct ones or no vote, their locale's language.

    (keys, language, voted): ``locale`` is an expression over the rows that gives the fallback, the first in order of text counts.
    """
    keys = list(keys)
    votes = detected(rows, keys, text=text, share=share, **options)
    units = rows.groupBy(*keys).agg(F.count_distinct(fold(collapse_space(F.col(text)))).alias("__n"), F.min(locale).alias("__locale"))
    joined = units.join(votes, keys, "left").withColumn("voted", F.col("language").isNotNull() & (F.col("__n") >= least))
    chosen = joined.withColumn("language", F.when(F.col("voted"), F.col("language")).otherwise(F.col("__locale")))
    return chosen.filter(F.col("language").isin(*allowed)).select(*keys, "language", "voted")

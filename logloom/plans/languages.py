"""Queries of languages: writing systems, vocabularies, votes and consistency checks over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.operators import language
from logloom.operators.sizing import spread
from logloom.plans.queries import query, read

FOLD_SQL = "replace(lower({}), 'ß', 'ss')"
WORDS_SQL = f"list_distinct(list_transform(regexp_extract_all(text, '\\p{{L}}{{3,}}'), lambda w: {FOLD_SQL.format('w')}))"
FAMILY_SQL = "CASE lang WHEN 'de' THEN 'nl' ELSE lang END"
SCRIPT_SQL = r"""s AS (
  SELECT doc_id, lang, len(list_filter(regexp_extract_all(text, '\p{L}+'), lambda w: regexp_matches(w, '\p{Latin}'))) AS latin, len(list_filter(regexp_extract_all(text, '\p{L}+'), lambda w: regexp_matches(w, '\p{Cyrillic}'))) AS cyrillic,
    len(list_filter(regexp_extract_all(text, '\p{L}+'), lambda w: regexp_matches(w, '\p{Greek}'))) AS greek, len(regexp_extract_all(text, '[\p{Han}\p{Hiragana}\p{Katakana}]')) AS cjk FROM documents)"""


def texts(s: SparkSession, d: str) -> DataFrame:
    return spread(read(s, d, "documents").select("doc_id", "lang", "text"), "doc_id")


@query("f15_script_words", f"WITH {SCRIPT_SQL} SELECT doc_id, latin, cyrillic, greek, cjk FROM s")
def f15_script_words(s: SparkSession, d: str) -> DataFrame:
    counts = language.script_words(F.col("text"))
    rows = texts(s, d).select("doc_id", counts.alias("m"))
    return rows.select("doc_id", *[F.coalesce(F.try_element_at("m", F.lit(k)), F.lit(0)).alias(k) for k in ("latin", "cyrillic", "greek", "cjk")])


@query("a11_writing_system", f"""
WITH {SCRIPT_SQL}, u AS (SELECT lang, unnest([{{'s': 'latin', 'n': latin}}, {{'s': 'cyrillic', 'n': cyrillic}}, {{'s': 'greek', 'n': greek}}, {{'s': 'cjk', 'n': cjk}}]) AS x FROM s), t AS (SELECT lang, x.s AS script, CAST(sum(x.n) AS BIGINT) AS words FROM u GROUP BY ALL)
SELECT lang, arg_min(script, struct_pack(a := -words, b := script)) AS script, max(words) AS words FROM t GROUP BY lang""")
def a11_writing_system(s: SparkSession, d: str) -> DataFrame:
    return language.writing_systems(texts(s, d), "lang", "text")


@query("c2_vocabulary", f"""
SELECT {FAMILY_SQL} AS family, word, count(*) AS texts FROM (SELECT lang, unnest({WORDS_SQL}) AS word FROM documents WHERE lang IS NOT NULL) GROUP BY ALL HAVING count(*) >= 5""")
def c2_vocabulary(s: SparkSession, d: str) -> DataFrame:
    return language.vocabulary(texts(s, d), "lang", "text", least=5)


@query("c2_vocabulary_vote", f"""
WITH w AS (SELECT doc_id, lang, {WORDS_SQL} AS words FROM documents), e AS (SELECT doc_id, {FAMILY_SQL} AS f, unnest(words) AS word FROM w), v AS (SELECT f AS family, word FROM e WHERE f IS NOT NULL GROUP BY ALL HAVING count(*) >= 5),
c AS (SELECT doc_id, family, count(*) AS n FROM e JOIN v USING (word) GROUP BY ALL), b AS (SELECT doc_id, max(n) AS votes, arg_min(family, struct_pack(a := -n, b := family)) AS family FROM c GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(words), 0) AS INTEGER) AS words, coalesce(votes, 0) AS votes, family FROM w LEFT JOIN b USING (doc_id)""")
def c2_vocabulary_vote(s: SparkSession, d: str) -> DataFrame:
    docs = texts(s, d)
    return language.vote_by_words(docs, language.vocabulary(docs, "lang", "text", least=5), "doc_id", "text")


@query("c2_language_consistency", rf"""
WITH w AS (SELECT {FAMILY_SQL} AS family, unnest({WORDS_SQL}) AS word FROM documents WHERE lang IS NOT NULL), v AS (SELECT family, word FROM w GROUP BY ALL HAVING count(*) >= 10),
n AS (SELECT doc_id, lang, text, array_to_string(regexp_extract_all(text, '\p{{L}}{{3,}}')[1:2], ' ') AS name, regexp_extract_all(text, '\p{{L}}{{3,}}')[1:2] AS parts FROM documents),
p AS (SELECT a.doc_id, a.name, a.parts, CASE a.lang WHEN 'de' THEN 'nl' ELSE a.lang END AS own, CASE b.lang WHEN 'de' THEN 'nl' ELSE b.lang END AS other FROM n a JOIN documents b ON b.doc_id = a.doc_id + 1 WHERE regexp_matches(b.text, '\p{{L}}')),
q AS (SELECT doc_id, own, other, unnest(parts) AS part FROM p WHERE own <> other AND len(parts) = 2 AND NOT regexp_full_match(name, '[A-Z0-9&.+\-/ ]+')),
j AS (SELECT doc_id, bool_and((own, {FOLD_SQL.format('part')}) IN (SELECT (family, word) FROM v)) AND NOT bool_or((other, {FOLD_SQL.format('part')}) IN (SELECT (family, word) FROM v)) AS wrong FROM q GROUP BY doc_id)
SELECT a.doc_id, CASE WHEN wrong THEN 'language_mismatch' END AS reason FROM n a JOIN documents b ON b.doc_id = a.doc_id + 1 LEFT JOIN j ON j.doc_id = a.doc_id""")
def c2_language_consistency(s: SparkSession, d: str) -> DataFrame:
    """Every document's first words as a name of the next document's text, whose language they may not be in."""
    docs = texts(s, d)
    words = F.regexp_extract_all("text", F.lit(r"(\p{L}{3,})"), F.lit(1))
    names = docs.select("doc_id", F.array_join(F.slice(words, 1, 2), " ").alias("name"), F.col("lang").alias("name_language"), F.lit(0.95).alias("name_probability"))
    rows = names.join(docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("activity"), F.col("lang").alias("language"), F.lit(1.0).alias("probability")), "doc_id")
    systems = language.writing_systems(docs, "lang", "text").withColumnRenamed("lang", "language")
    return language.name_checks(rows, language.vocabulary(docs, "lang", "text", least=10), systems, "doc_id", least=10).select("doc_id", "reason")


UNIT_SQL = f"""r AS (SELECT doc_id // 40 AS record, doc_id // 4 AS unit, doc_id % 4 = 0 AS anchor, source, lang, {FOLD_SQL.format("trim(regexp_replace(substr(text, 1, 60), '\\s+', ' ', 'g'))")} AS t, n_chars >= 200 AS sure FROM documents),
ok AS (SELECT * FROM r WHERE sure AND t <> '' AND lang IS NOT NULL AND NOT regexp_matches(t, '(https?://|www\\.|^\\S+\\.(com|net|org|de|jp|fr|co|io|uk|au|cn|br|es|it|nl|ru)(/\\S*)?$)'))"""


def voted_sql(keys: str, share: float) -> str:
    return f"(SELECT {keys}, CASE WHEN max(n) >= {share} * sum(n) THEN arg_min(lang, struct_pack(a := -n, b := lang)) ELSE 'mix' END AS language FROM (SELECT {keys}, lang, count(*) AS n FROM (SELECT {keys}, t, min(lang) AS lang FROM ok GROUP BY ALL) GROUP BY ALL) GROUP BY {keys})"


@query("c15_language_units", rf"""
WITH {UNIT_SQL}, v AS {voted_sql("record, unit, anchor", 0.6)}, u AS (SELECT record, unit, max(language) FILTER (anchor) AS a, max(language) FILTER (NOT anchor) AS t FROM v GROUP BY ALL),
k AS (SELECT record, a = 'en' AS en, CASE WHEN (CASE a WHEN 'de' THEN 'nl' ELSE a END) = (CASE t WHEN 'de' THEN 'nl' ELSE t END) THEN 1 ELSE 0 END AS hit FROM u WHERE a <> 'mix' AND t <> 'mix')
SELECT record, count(*) FILTER (en) AS units_en, CAST(coalesce(sum(hit) FILTER (en), 0) AS BIGINT) AS match_en, count(*) FILTER (NOT en) AS units_glb, CAST(coalesce(sum(hit) FILTER (NOT en), 0) AS BIGINT) AS match_glb, sum(hit) * 2 < count(*) AS wrong_language FROM k GROUP BY record""")
def c15_language_units(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "documents").select(F.floor(F.col("doc_id") / 40).alias("record"), F.floor(F.col("doc_id") / 4).alias("unit"), (F.col("doc_id") % 4 == 0).alias("anchor"), F.substring("text", 1, 60).alias("text"), F.col("lang").alias("language"), F.when(F.col("n_chars") >= 200, 0.9).otherwise(0.4).alias("probability"))
    return language.language_units(rows, "record", "unit", "anchor")


@query("c13_kept_languages", f"""
WITH {UNIT_SQL}, v AS {voted_sql("unit", 0.8)}, a AS (SELECT doc_id // 4 AS unit, count(DISTINCT {FOLD_SQL.format("trim(regexp_replace(substr(text, 1, 60), '\\s+', ' ', 'g'))")}) AS n, min(CASE WHEN source < 'm' THEN 'en' ELSE 'es' END) AS locale FROM documents GROUP BY 1),
c AS (SELECT unit, language IS NOT NULL AND n >= 2 AS voted, CASE WHEN language IS NOT NULL AND n >= 2 THEN language ELSE locale END AS language FROM a LEFT JOIN v USING (unit))
SELECT unit, language, voted FROM c WHERE language IN ('en', 'fr')""")
def c13_kept_languages(s: SparkSession, d: str) -> DataFrame:
    rows = read(s, d, "documents").select(F.floor(F.col("doc_id") / 4).alias("unit"), F.substring("text", 1, 60).alias("text"), "source", F.col("lang").alias("language"), F.when(F.col("n_chars") >= 200, 0.9).otherwise(0.4).alias("probability"))
    locale = F.when(F.col("source") < "m", "en").otherwise("es")
    return language.kept_languages(rows, ["unit"], "text", locale, ["en", "fr"], share=0.8, least=2)

"""String functions as Column expressions; Unicode classes where the semantics need them."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions.arrays import once

#: Code points of scripts that are written without spaces (kana, Han, Thai, Lao, Myanmar, Khmer).
UNSPACED = "[\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff]"

#: Characters whose case folding is not their lower case, such as sharp s, final sigma and ligatures, and what they fold to.
FOLDED = {c: c.casefold() for c in map(chr, range(0x110000)) if c.casefold() != c.lower()}
#: Of these, the ones that fold to one character, and the ones that fold to several.
FOLDED_ONE, FOLDED_MORE = ({c: v for c, v in FOLDED.items() if (len(v) > 1) == several} for several in (False, True))


def spans_of(characters: Iterable[str], gap: int = 64) -> str:
    """A regular expression class of few ranges that holds the characters and, between near ones, others."""
    ranges: list[list[int]] = []
    for c in sorted(map(ord, characters)):
        if ranges and c - ranges[-1][1] <= gap:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ranges) + "]"


def folds_apart(x: Column) -> Column:
    """Whether a text can hold characters whose folding is not their lower case."""
    return F.lower(x).rlike(spans_of(FOLDED))


def fold(x: Column) -> Column:
    """Full Unicode case folding: one pass over characters that fold to one, replacements only in texts that can hold the others."""
    one = lambda low: F.when(low.rlike(spans_of(FOLDED_ONE)), F.translate(low, "".join(FOLDED_ONE), "".join(FOLDED_ONE.values()))).otherwise(low)

    def more(sharp: Column) -> Column:
        out = sharp
        for c, v in FOLDED_MORE.items():
            out = F.replace(out, F.lit(c), F.lit(v))
        return F.when(sharp.rlike(spans_of(c for c in FOLDED_MORE if c != "\u00df")), out).otherwise(sharp)

    return once(F.replace(once(F.lower(x), one), F.lit("\u00df"), F.lit("ss")), more)


def normalize_name(x: Column, joiner: str = " ") -> Column:
    """Folded words (letters and numbers) joined by ``joiner``; null gives an empty string."""
    return F.trim(F.regexp_replace(fold(F.coalesce(x, F.lit(""))), r"[^\p{L}\p{N}]+", joiner))


def collapse_space(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"(?U)\s+", " "))


def has_text(x: Column) -> Column:
    return F.coalesce(F.length(collapse_space(x)) > 0, F.lit(False))


def segment_key(x: Column) -> Column:
    """Key of a category segment: ``A & B`` and ``A and B`` are one."""
    return collapse_space(F.replace(fold(x), F.lit("&"), F.lit(" and ")))


def before_pipe(x: Column) -> Column:
    return F.substring_index(x, "|", 1)


def is_url(x: Column) -> Column:
    return F.coalesce(x.rlike(r"(?i)^\s*(https?://|www\.)\S+"), F.lit(False))


def header_field(x: Column, name: str, within: int = 500) -> Column:
    """Value of a ``name: value`` line among the first characters; null where there is none."""
    found = F.regexp_extract(F.substring(x, 1, within), rf"(?m)^{name}:[ \t]*(.*)$", 1)
    return F.when(found != "", found)


def without_lines(x: Column, pattern: str) -> Column:
    return F.regexp_replace(x, rf"(?m)^(?:{pattern}).*(?:\n|\z)", "")


def unspaced(x: Column) -> Column:
    return x.rlike(UNSPACED)


def query_problems(x: Column, low: int = 2, high: int = 10) -> Column:
    """Names of the shape rules a search query breaks."""
    words = F.size(F.filter(F.split(collapse_space(x), " "), lambda w: w != ""))
    return F.array_compact(F.array(F.when(~unspaced(x) & ~words.between(low, high), "query_word_count"), F.when(F.rtrim(x).rlike(r"[?？]$"), "query_question")))


def query_flags(x: Column) -> Column:
    return F.array_compact(F.array(F.when(x != F.lower(x), "query_not_lowercase")))


def category_path(x: Column) -> Column:
    """``/A/B`` with trimmed segments and without empty ones; null where nothing is left."""
    parts = F.filter(F.transform(F.split(x, "/"), lambda p: F.trim(p)), lambda p: p != "")
    return F.when(F.size(parts) > 0, F.concat(F.lit("/"), F.array_join(parts, "/")))


def common_prefix(paths: Column) -> Column:
    """Longest common prefix of an array of category paths."""
    split = lambda p: F.filter(F.split(p, "/"), lambda s: s != "")
    meet = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: F.struct(x.alias("x"), y.alias("y"))), F.struct(F.array().cast("array<string>").alias("p"), F.lit(True).alias("go")), lambda s, z: F.struct(F.when(s["go"] & z["x"].eqNullSafe(z["y"]), F.concat(s["p"], F.array(z["x"]))).otherwise(s["p"]).alias("p"), (s["go"] & z["x"].eqNullSafe(z["y"])).alias("go")))["p"]
    rest = F.slice(paths, 2, F.greatest(F.size(paths) - 1, F.lit(0)))
    parts = F.aggregate(rest, split(F.get(paths, F.lit(0))), lambda a, p: meet(a, split(p)))
    return F.when(F.size(parts) > 0, F.concat(F.lit("/"), F.array_join(parts, "/")))


def normalize_answer(x: Column) -> Column:
    """Lower case, without ASCII punctuation and articles, spaces collapsed."""
    bare = F.regexp_replace(F.lower(x), r"[!-/:-@\[-`{-~]", "")
    return collapse_space(F.regexp_replace(bare, r"\b(a|an|the)\b", " "))


def last_number(x: Column) -> Column:
    """The last number of a text, without thousands separators."""
    return F.replace(F.try_element_at(F.regexp_extract_all(x, F.lit(r"(-?[0-9][0-9,]*(?:\.[0-9]+)?)"), F.lit(1)), F.lit(-1)), F.lit(","), F.lit(""))


@F.pandas_udf(T.StringType())
def last_boxed(texts: pd.Series) -> pd.Series:
    """Content of the last ``\\boxed{...}``, braces balanced; null where there is none or it does not close."""

    def one(t: str | None) -> str | None:
        at = (t or "").rfind("\\boxed{")
        if at < 0:
            return None
        depth = 0
        for i in range(at + 6, len(t)):
            depth += (t[i] == "{") - (t[i] == "}")
            if not depth:
                return t[at + 7 : i]
        return None

    return texts.map(one)


@F.pandas_udf(T.StringType())
def accent_fold(texts: pd.Series) -> pd.Series:
    """Letters without their accents, punctuation as a space."""

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        bare = "".join(c for c in unicodedata.normalize("NFKD", t.casefold()) if not unicodedata.combining(c))
        return " ".join("".join(c if c.isalnum() else " " for c in bare).split())

    return texts.map(one)


@F.pandas_udf(T.MapType(T.StringType(), T.IntegerType()))
def script_words(texts: pd.Series) -> pd.Series:
    """Words by the writing system of their first letter."""

    def one(t: str | None) -> dict[str, int]:
        out: dict[str, int] = {}
        for word in (t or "").split():
            letter = next((c for c in word if c.isalpha()), None)
            if letter:
                name = unicodedata.name(letter, "UNKNOWN").split(" ")[0]
                out[name] = out.get(name, 0) + 1
        return out

    return texts.map(one)


def overlong_penalty(length: Column, limit: int, buffer: int, factor: float) -> Column:
    """0 up to ``limit - buffer``, then falling in proportion to the excess."""
    return F.least(-(length - (limit - buffer)) / F.lit(float(buffer)) * factor, F.lit(0.0))


def score_answer(source: Column, answer: Column, truth: Column) -> Column:
    """1 or 0 by the family of ``source``: last number, boxed expression, or normalised text."""
    same = lambda a, b: F.coalesce((a == b).cast("double"), F.lit(0.0))
    number = same(last_number(answer).cast("double"), last_number(truth).cast("double"))
    return F.when(source == "number", number).when(source == "boxed", same(last_boxed(answer), truth)).when(source == "text", same(normalize_answer(answer), normalize_answer(truth)))


def locale_language(x: Column, aliases: dict[str, str] | None = None) -> Column:
    """Language of a locale such as ``zh-Hant-TW``: the first part, Chinese with its script; aliases come first."""
    parts = F.split(F.lower(F.replace(x, F.lit("_"), F.lit("-"))), "-")
    first = F.get(parts, F.lit(0))
    for a, b in (aliases or {}).items():
        first = F.when(first == a, b).otherwise(first)
    traditional = F.arrays_overlap(parts, F.array(F.lit("hant"), F.lit("tw"), F.lit("hk"), F.lit("mo")))
    return F.when(first == "zh", F.when(traditional, "zh-hant").otherwise("zh-hans")).otherwise(first)

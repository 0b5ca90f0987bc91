"""Facts of JSON texts and of sectioned texts, as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Leftovers of JSON in prose, pronouns that assert a gender, and reactions to advertisements.
ARTIFACT = r'[{}`]|"(life_stage|biography|value|confidence|evidence)"\s*:'
PRONOUN = r"(?i)\b(he|she|him|his|her|hers|himself|herself)\b"
REACTION = r"\b(not interested|offensive|misleading|inappropriate|dislike[sd]?|downvote[sd]?|repeated ads?)\b"


def minified(text: Column) -> Column:
    """A JSON text without the white space between its tokens, keys in their order and characters as they are."""
    return F.regexp_replace(text, r'("(?:[^"\\]|\\.)*+")|\s+', "$1")


def json_type(text: Column) -> Column:
    """object, array, string, number, boolean or null; SQL null where the text is no JSON."""
    kind = F.schema_of_variant(F.try_parse_json(text))
    named = F.when(F.startswith(kind, F.lit("OBJECT")), "object").when(F.startswith(kind, F.lit("ARRAY")), "array").when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null")
    return named.otherwise(F.when(kind.isNotNull(), "number"))


def has_keys(text: Column, keys: Sequence[str], path: str = "$") -> Column:
    """Whether the object at ``path`` has these keys and no others, in any order; false where there is no object."""
    found = F.json_object_keys(text if path == "$" else F.get_json_object(text, path))
    return F.coalesce(F.array_sort(found) == F.array(*map(F.lit, sorted(keys))), F.lit(False))


def each_has_keys(text: Column, keys: Sequence[str], path: str) -> Column:
    """Whether ``path`` is an array of objects that all have these keys and no others; an empty array has."""
    held = F.from_json(F.get_json_object(text, path), "array<map<string,string>>")
    return F.coalesce(F.forall(held, lambda m: F.coalesce(F.array_sort(F.map_keys(m)) == F.array(*map(F.lit, sorted(keys))), F.lit(False))), F.lit(False))


def section(text: Column, title: str) -> Column:
    """What stands below the line ``## title`` up to the next such line, trimmed; null where there is no such line."""
    found = F.regexp_extract_all(text, F.lit(rf"(?ms)^## {re.escape(title)}[ \t]*$\n?(.*?)(?=^## |\z)"), F.lit(1))
    return F.trim(F.get(found, F.lit(0)), F.lit(" \t\n"))


def heading_blocks(text: Column, heading: str = "### Interest") -> Column:
    """Map of name to block for every line ``heading N: name``; of equal names the last counts."""
    pieces = F.filter(F.split(text, rf"(?m)(?=^{re.escape(heading)} \d+: )"), lambda p: p.rlike(rf"^{re.escape(heading)} \d+: "))
    entries = F.transform(pieces, lambda p: F.struct(F.regexp_extract(p, rf"^{re.escape(heading)} \d+: (.+)", 1).alias("key"), F.regexp_extract(p, r"(?s)^[^\n]*\n?(.*)$", 1).alias("value")))
    names = F.transform(entries, lambda e: e["key"])
    return F.map_from_entries(F.filter(entries, lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), e["key"])))


def existing_queries(block: Column) -> Column:
    """The ``  - query`` lines that directly follow ``- Existing queries:``, in order."""
    lines = F.split(F.regexp_extract(block, r"- Existing queries:[^\n]*\n((?:  - [^\n]*(?:\n|\z))*)", 1), "\n")
    return F.transform(F.filter(lines, lambda x: x != ""), lambda x: F.trim(F.substring(x, F.lit(5), F.length(x))))


def known_brands(block: Column) -> Column:
    """Brands of the line ``- Brands: a, b``, folded to lower case and in order."""
    line = F.regexp_extract(block, r"(?m)^- Brands: (.+)$", 1)
    return F.filter(F.transform(F.split(line, ","), lambda x: F.lower(F.trim(x))), lambda x: x != "")


def canonical_source(source: Column, known: Sequence[str]) -> Column:
    """The known spelling of a source in any case; unknown ones stay as they are."""
    out = source
    for name in known:
        out = F.when(F.lower(source) == name.lower(), name).otherwise(out)
    return out


def without_fields(items: Column, *names: str) -> Column:
    """An array of structs without some of their fields."""
    return F.transform(items, lambda x: x.dropFields(*names))


def softmax(logits: Column) -> Column:
    """Shares of an array of logits, safe for large ones."""
    top = F.array_max(logits)
    powers = F.transform(logits, lambda x: F.exp(x - top))
    whole = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda x: x / whole)


def best_class(logits: Column) -> Column:
    """Place (from 0) of the largest logit, the first of equal ones."""
    return (F.array_position(logits, F.array_max(logits)) - 1).cast("int")

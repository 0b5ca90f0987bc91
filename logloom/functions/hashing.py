"""Identifiers, bucket splits and seeded orders."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logloom.functions.text import collapse_space, fold


def short_id(x: Column) -> Column:
    """First 16 hexadecimal digits of SHA-256."""
    return F.substring(F.sha2(x.cast("string"), 256), 1, 16)


def bucket(x: Column, buckets: int = 10_000) -> Column:
    """The short id as a number, modulo ``buckets``."""
    return (F.conv(short_id(x), 16, 10).cast("decimal(20,0)") % F.lit(buckets)).cast("int")


def in_test(x: Column, ratio: float) -> Column:
    return bucket(x) < int(ratio * 10_000)


def seeded(seed: str | int, *keys: Column) -> Column:
    """A deterministic order that every engine can compute: the digest of seed and keys."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]), 256)


def request_seed(seed: int, *parts: Column) -> Column:
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.pmod(F.crc32(text.cast("binary")) + F.lit(seed), F.lit(2147483648))


def input_digest(signals: Column) -> Column:
    """Digest of the multiset of (source, folded action) of an array of signals; dates and numbers do not count."""
    pairs = F.transform(signals, lambda s: F.struct(F.coalesce(s["source"], F.lit("")).alias("s"), collapse_space(fold(F.coalesce(s["action"], F.lit("")))).alias("a")))
    return F.md5(F.to_json(F.array_sort(pairs)))


def canonical_json(text: Column) -> Column:
    """JSON with the keys of every object in order and without spaces; null where the text is no JSON or repeats a key.

    A variant keeps the fields of an object sorted by name, so writing it out again is the canonical form.
    """
    return F.to_json(F.try_parse_json(text))


def json_digest(text: Column) -> Column:
    """MD5 of the canonical form: equal for texts that differ in the order of keys and in spaces alone."""
    return F.md5(canonical_json(text))


def pairs_digest(pairs: Column, name: str, text: str) -> Column:
    """MD5 of an array of (name, text) in its order; texts without spaces that repeat, a last full stop or case. Null for an empty array."""
    clean = lambda p: F.struct(p[name].alias("n"), fold(F.regexp_replace(collapse_space(F.coalesce(p[text], F.lit(""))), r"\.+$", "")).alias("t"))
    return F.when(F.size(pairs) > 0, F.md5(F.to_json(F.transform(pairs, clean))))


def actions_uid(actions: Column) -> Column:
    return F.sha2(F.array_join(F.array_sort(actions), "\n"), 256)


@F.pandas_udf(T.IntegerType())
def fnv_bucket(texts: pd.Series) -> pd.Series:
    """FNV-1a over UTF-16 code units, modulo 16; null counts as empty."""

    def one(t: str | None) -> int:
        h = 2166136261
        raw = (t or "").encode("utf-16-le")
        for i in range(0, len(raw), 2):
            h = ((h ^ (raw[i] | raw[i + 1] << 8)) * 16777619) & 0xFFFFFFFF
        return h % 16

    return texts.map(one)


@F.pandas_udf(T.StringType())
def blake_order(texts: pd.Series) -> pd.Series:
    """Eight-byte BLAKE2b digest, in hexadecimal."""
    return texts.map(lambda t: hashlib.blake2b((t or "").encode(), digest_size=8).hexdigest())

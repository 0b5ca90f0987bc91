"""Array functions as Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(x: Column, use: Callable[[Column], Column]) -> Column:
    """``use(x)`` with ``x`` computed once, however often it is named: inside lambdas nothing else keeps a value."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def same_multiset(a: Column, b: Column) -> Column:
    return F.array_sort(a) == F.array_sort(b)


def same_set(a: Column, b: Column) -> Column:
    return (F.size(F.array_except(a, b)) == 0) & (F.size(F.array_except(b, a)) == 0)


def subset(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) == 0


def ordered_union(*arrays: Column) -> Column:
    return F.array_distinct(F.concat(*arrays))


def has_repeats(x: Column) -> Column:
    return F.size(F.array_distinct(x)) < F.size(x)


def last_n(x: Column, n: int) -> Column:
    return F.slice(x, F.greatest(F.size(x) - n + 1, F.lit(1)), n)


def index_percentile(values: Column, share: float) -> Column:
    """Element ``int(share * (n - 1))`` of the sorted values."""
    ordered = F.array_sort(values)
    return F.get(ordered, F.floor(F.lit(share) * (F.size(ordered) - 1)).cast("int"))


def chunks(x: Column, size: int) -> Column:
    """Near-equal contiguous chunks of at most ``size`` elements, the larger ones first."""
    n = F.size(x)
    k = F.greatest(F.ceil(n / size), F.lit(1)).cast("int")
    start = lambda i: (i * F.floor(n / k) + F.least(i, n % k) + 1).cast("int")
    return F.transform(F.sequence(F.lit(0), k - 1), lambda i: F.slice(x, start(i), start(i + 1) - start(i)))


def multiset_jaccard(a: Column, b: Column) -> Column:
    """Shared occurrences over all occurrences; two empty arrays are alike."""
    times = lambda x, k: F.size(F.filter(x, lambda v: v == k))

    def ratio(v: Column) -> Column:
        keys = F.array_distinct(F.concat(v["a"], v["b"]))
        both = F.transform(keys, lambda k: F.struct(times(v["a"], k).alias("a"), times(v["b"], k).alias("b")))
        counts = F.aggregate(both, F.struct(F.lit(0).alias("shared"), F.lit(0).alias("union")), lambda s, n: F.struct((s["shared"] + F.least(n["a"], n["b"])).alias("shared"), (s["union"] + F.greatest(n["a"], n["b"])).alias("union")))
        return once(counts, lambda n: F.when(n["union"] == 0, F.lit(1.0)).otherwise(n["shared"] / n["union"]))

    return once(F.struct(a.alias("a"), b.alias("b")), ratio)


def remap_evidence(evidence: Column, order: Column) -> Column:
    """Old numbers to their places in ``order``, distinct and sorted; numbers that are not there are dropped."""
    places = F.transform(F.array_distinct(evidence), lambda e: F.array_position(order, e).cast("int") - 1)
    return F.array_sort(F.filter(places, lambda p: p >= 0))

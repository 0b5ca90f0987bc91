"""Connected components of a graph that is held as a table of edges.

Large-star and small-star steps are repeated until no edge changes. An edge table is pre-aggregated by its distinct
pairs, a hub's neighbours are spread over tasks by salting the minimum, and every step is cut by a reliable checkpoint,
so a lost executor costs one step at most and the driver plans one step at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import checkpointed, shuffled

SALTS = 16


def lowest(salted: DataFrame) -> DataFrame:
    """(u, salt, m): the smallest of u and its neighbours, once for every salt; no task gathers all neighbours of a hub."""
    found = salted.groupBy("u", "salt").agg(F.min("v").alias("m")).groupBy("u").agg(F.least(F.min("m"), F.col("u")).alias("m"), F.collect_set("salt").alias("salts"))
    return found.select("u", F.explode("salts").alias("salt"), "m")


def star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u > v): link to the smallest neighbour the larger (or the other smaller) neighbours.

    Both ends of a row are made by one ``inline``: a union would have everything below it planned twice.
    """
    pair = lambda u, v: F.struct(F.col(u).alias("u"), F.col(v).alias("v"))
    both = edges.select(F.inline(F.array(pair("u", "v"), pair("v", "u")))) if large else edges
    salted = both.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    joined = salted.join(shuffled(lowest(salted)), ["u", "salt"])
    moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else joined.select(F.inline(F.array(pair("v", "m"), pair("u", "m"))))
    return moved.filter("u <> v").distinct()


def components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """(node, component) for every node with an edge; ``edges`` has columns u and v of one ordered type.

    Rounds grow with the logarithm of the number of nodes; ``rounds`` is far beyond that and only ends a run that would
    otherwise never end, with an error.
    """
    held = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    held = checkpointed(held)
    state = None
    for _ in range(rounds):
        held = checkpointed(star(checkpointed(star(held, large=True)), large=False))
        now = tuple(held.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return held.select(F.explode(F.array("u", "v")).alias("node"), F.col("v").alias("component")).distinct()

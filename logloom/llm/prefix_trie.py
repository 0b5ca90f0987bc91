"""Trie of conversation prefixes, with totals rolled up by centroid decomposition of its parent edges.

Every sequence of first turns (role, text) that some conversation starts with is a node; the textless root is the node of
depth 0. A node is known by 128 bits of a SHA-256 chain over its turns, so texts are hashed once and then left behind.

Totals over subtrees need no pass per level. A component is a connected part of the forest with one top. Its centroid is
the deepest node below which at least half of the component's weight lies (weights: turns of distinct conversations,
known for every node from one aggregation). Removing it leaves components of at most half the weight; what lies below the
centroid is summed and added to every node on the path from the centroid to the component's top. Components above
``local_weight`` are split by joins, a round for all of them at once, so rounds grow with the logarithm of the weight even
where one conversation is a chain of a third of all turns. Smaller components, of bounded size, are dealt to tasks,
which take many at a time through the same recursion in arrays.

Order and equality: turns are ordered by turn (null first), equal turns by role and then by digest of the turn; null roles
and texts are empty. Defined results: rows without a conversation id take no part; repeated rows are turns each; an
empty table has no node, any other has a root; other columns are ignored. No text is held beyond its row; ids that end at
a node are concatenated in pieces before they meet, so no task holds them all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import checkpointed, small, written

ROOT = hashlib.sha256(b"").digest()
ROOT_KEY = tuple(int(x) for x in np.frombuffer(ROOT[:16], "<i8"))
#: Words of a text are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Characters of joined ids in one row; rows of components that a task works on at a time.
PIECE, BUFFER = 1 << 16, 20_000


def turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, place from 1, n turns of the conversation, turn digest, words), without texts."""
    role, text = (F.coalesce(rows[c].cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    held = rows.filter(rows[conv_col].isNotNull()).select(rows[conv_col].cast("bigint").alias("conv"), rows[turn_col].alias("turn"), role.alias("role"), digest.alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"))
    place = F.expr("row_number() over (partition by conv order by turn asc nulls first, role, digest)")
    return held.select("conv", place.alias("place"), F.expr("count(*) over (partition by conv)").alias("n"), "digest", "words")


def graft(placed: DataFrame, base: Column, heads: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``heads`` turns are those of conversation ``base``: (their turns, (conv, length)).

    ``base`` and ``heads`` are functions of the column conv. A base that has fewer turns gives those it has, one that is
    not there gives none; the conversation's own turns follow after its first ``heads``.
    """
    convs = placed.filter("place = 1").select("conv", base.alias("base"), heads.alias("h"), F.col("n").alias("own"))
    bases = placed.filter("place = 1").select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn("lent", F.least("h", F.coalesce("base_n", F.lit(0)))).select("conv", "base", "h", "lent", (F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    own = placed.join(convs.select("conv", "h", "length"), "conv").filter("place > h").select("conv", F.lit(1).alias("part"), "place", "digest", "words", "length")
    most = convs.agg(F.max("h")).first()[0] or 0
    lent = placed.filter(F.col("place") <= most).select(F.col("conv").alias("base"), "place", "digest", "words").join(convs.filter("lent > 0"), "base").filter("place <= lent")
    return own.union(lent.select("conv", F.lit(0).alias("part"), "place", "digest", "words", "length")), convs.select("conv", "length")


def plain(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``graft``, of conversations as they are."""
    return placed.select("conv", F.lit(0).alias("part"), "place", "digest", "words", F.col("n").alias("length")), placed.filter("place = 1").select("conv", F.col("n").alias("length"))


def chained(sequences: DataFrame) -> DataFrame:
    """(conv, depth, key ka kb, parent's key pa pb, words, length): the node of every prefix of every conversation.

    Turns of a conversation stream through one task in order; it holds one digest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, depth = None, ROOT, 0
        for batch in batches:
            keys, parents, depths = [], [], []
            for conv, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if conv != last:
                    last, state, depth = conv, ROOT, 0
                parents.append(state[:16])
                state = hashlib.sha256(state + digest).digest()
                keys.append(state[:16])
                depth += 1
                depths.append(depth)
            key, parent = (np.frombuffer(b"".join(x), "<i8").reshape(-1, 2) for x in (keys, parents))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(depths, pa.int64()), *[pa.array(np.ascontiguousarray(x[:, i])) for x in (key, parent) for i in (0, 1)], batch.column(2), batch.column(3)], ["conv", "depth", "ka", "kb", "pa", "pb", "words", "length"])

    dealt = sequences.repartition("conv").sortWithinPartitions("conv", "part", "place")
    return dealt.select("conv", "digest", "words", F.col("length").cast("bigint").alias("length")).mapInArrow(run, "conv bigint, depth bigint, ka bigint, kb bigint, pa bigint, pb bigint, words bigint, length bigint")


def subtree_sums(parent: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over every node's subtree, by centroid decomposition of all trees of a forest together.

    ``parent`` is -1 for a top, ``weight`` the weight of a node's subtree, in which every node weighs more than nothing.
    """
    n = len(parent)
    every = np.arange(n)
    total, left = np.zeros_like(values), weight.copy()
    live = np.ones(n, bool)
    comp = nearest(parent, parent < 0)
    while live.any():
        at = np.flatnonzero(live)
        heavy = at[2 * left[at] >= left[comp[at]]]
        heavy = heavy[np.lexsort((left[heavy], comp[heavy]))]
        centroid = heavy[np.r_[True, comp[heavy][1:] != comp[heavy][:-1]]]
        top, below_weight = comp[centroid], left[centroid]
        removed = np.zeros(n, bool)
        removed[centroid] = True
        live[centroid] = False
        first = live & ((comp == every) | (removed[parent] & (parent >= 0)))
        now = np.where(live, nearest(parent, first | ~live), comp)
        sums = np.zeros_like(values)
        moved = live & (now != comp)
        np.add.at(sums, comp[moved], values[moved])
        kept = sums[top] + values[centroid]
        total[centroid] += kept
        comp = now
        on = np.flatnonzero(centroid != top)
        node = parent[centroid[on]]
        while len(on):
            total[node] += kept[on]
            left[node] -= below_weight[on]
            on, node = on[node != top[on]], node[node != top[on]]
            node = parent[node]
    return total


def nearest(parent: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The nearest of a node and its ancestors at which ``stop`` holds, by doubling the steps."""
    jump = np.where(stop, np.arange(len(parent)), parent)
    while True:
        further = jump[jump]
        if (further == jump).all():
            return jump
        jump = further


def joined_ids(ends: DataFrame) -> DataFrame:
    """(ka, kb, ends_sha256) of (ka, kb, conv): the digest of a node's ids in order, comma-joined.

    Ids are sorted over all tasks first and joined to pieces of bounded length there; only pieces meet, in order.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, held, size = None, None, [], 0
        for batch in batches:
            out = []
            for a, b, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (a, b) != key or size > PIECE:
                    if key is not None:
                        out.append((*key, first, ",".join(held)))
                    key, first, held, size = (a, b), conv, [], 0
                held.append(str(conv))
                size += len(held[-1])
            yield _piece_batch(out)
        if key is not None:
            yield _piece_batch([(*key, first, ",".join(held))])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for a, b, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if (a, b) == key:
                    state.update(b"," + text.encode())
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (a, b), hashlib.sha256(text.encode())
            yield _digest_batch(out)
        if key is not None:
            yield _digest_batch([(*key, state.hexdigest())])

    ordered = ends.select("ka", "kb", "conv").repartitionByRange("ka", "kb", "conv").sortWithinPartitions("ka", "kb", "conv")
    cut = ordered.mapInArrow(pieces, "ka bigint, kb bigint, first bigint, ids string")
    return cut.repartition("ka", "kb").sortWithinPartitions("ka", "kb", "first").mapInArrow(digests, "ka bigint, kb bigint, ends_sha256 string")


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    a, b, first, ids = zip(*rows, strict=True) if rows else ((), (), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(first, pa.int64()), pa.array(ids, pa.string())], ["ka", "kb", "first", "ids"])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    a, b, digest = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(digest, pa.string())], ["ka", "kb", "ends_sha256"])


def split(live: DataFrame, carriers: DataFrame, local_weight: int) -> tuple[DataFrame, DataFrame]:
    """One round over components above ``local_weight``: (their nodes in smaller components, their centroids with whole sums)."""
    large = small(live.filter("ka = ca and kb = cb").select("ca", "cb", F.col("left").alias("whole"), F.col("depth").alias("top_depth")))
    heavy = live.join(large, ["ca", "cb"]).filter(F.col("left") * 2 >= F.col("whole"))
    node = F.struct(F.col("ka").alias("xa"), F.col("kb").alias("xb"), F.col("carrier").alias("conv"), F.col("depth").alias("x_depth"), F.col("left").alias("x_left"))
    chosen = checkpointed(heavy.groupBy("ca", "cb").agg(F.min_by(node, "left").alias("x"), F.first("top_depth").alias("top_depth")).select("ca", "cb", "top_depth", "x.*"))
    few = small(chosen)
    children = carriers.join(few.select("ca", "cb", F.col("xa").alias("pa"), F.col("xb").alias("pb")), ["pa", "pb"]).select(F.col("conv").alias("carrier"), "ca", "cb", F.col("ka").alias("na"), F.col("kb").alias("nb"), (F.col("depth") - 1).alias("x_depth"))
    below = live.join(small(children), ["carrier", "ca", "cb"], "left").withColumn("below", F.coalesce(F.col("depth") > F.col("x_depth"), F.lit(False))).drop("x_depth")
    marked = below.join(few.select("ca", "cb", "xa", "xb"), ["ca", "cb"]).withColumn("centre", (F.col("ka") == F.col("xa")) & (F.col("kb") == F.col("xb")))
    marked = written(marked)
    sums = checkpointed(marked.filter("below or centre").groupBy("ca", "cb").agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saves")))
    known = chosen.join(small(sums), ["ca", "cb"])
    up = carriers.join(small(known), "conv").filter("depth >= top_depth and depth < x_depth").select("ka", "kb", "leaves", "saves", "x_left")
    root = known.filter("top_depth = 0 and x_depth > 0").select(F.lit(ROOT_KEY[0]).alias("ka"), F.lit(ROOT_KEY[1]).alias("kb"), "leaves", "saves", "x_left")
    path = up.union(root).select("ka", "kb", F.col("leaves").alias("add_leaves"), F.col("saves").alias("add_saves"), F.col("x_left").alias("minus"))
    moved = marked.join(small(checkpointed(path)), ["ka", "kb"], "left").join(small(sums), ["ca", "cb"])
    own = F.col("centre").cast("bigint")
    leaves = F.col("n_leaves") + F.coalesce("add_leaves", F.lit(0)) + own * F.col("leaves")
    saves = F.col("saved_tokens") + F.coalesce("add_saves", F.lit(0)) + own * F.col("saves")
    out = moved.select("ka", "kb", "pa", "pb", "depth", "carrier", F.when(F.col("below"), F.col("na")).otherwise(F.col("ca")).alias("ca"), F.when(F.col("below"), F.col("nb")).otherwise(F.col("cb")).alias("cb"), (F.col("left") - F.coalesce("minus", F.lit(0))).alias("left"), "leaf", "saved", leaves.alias("n_leaves"), saves.alias("saved_tokens"), "centre")
    out = written(out)
    return out.filter("not centre").drop("centre"), out.filter("centre").drop("centre")


def rolled_up(nodes: DataFrame, carriers: DataFrame, local_weight: int) -> DataFrame:
    """(ka, kb, n_leaves, saved_tokens) of every node's subtree."""
    live = nodes.select("ka", "kb", "pa", "pb", "depth", "carrier", F.lit(ROOT_KEY[0]).alias("ca"), F.lit(ROOT_KEY[1]).alias("cb"), "left", "leaf", "saved", F.lit(0).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"))
    done: list[DataFrame] = []
    ready: list[DataFrame] = []
    while True:
        heavy = live.filter((F.col("ka") == F.col("ca")) & (F.col("kb") == F.col("cb")) & (F.col("left") > local_weight)).select("ca", "cb")
        if heavy.isEmpty():
            ready.append(live)
            break
        held = small(checkpointed(heavy))
        ready.append(live.join(held, ["ca", "cb"], "left_anti"))
        live, centres = split(live.join(held, ["ca", "cb"], "left_semi"), carriers, local_weight)
        done.append(centres.select("ka", "kb", "n_leaves", "saved_tokens"))
    rest = ready[0]
    for more in ready[1:]:
        rest = rest.union(more.select(rest.columns))
    out = rest.repartition("ca", "cb").sortWithinPartitions("ca", "cb", "depth").select("ca", "cb", "ka", "kb", "pa", "pb", "left", "leaf", "saved", "n_leaves", "saved_tokens").mapInArrow(_local, "ka bigint, kb bigint, n_leaves bigint, saved_tokens bigint")
    for more in done:
        out = out.union(more)
    return out


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole components, as many as fill a buffer, through the decomposition; a component is never cut."""
    held: list[np.ndarray] = []
    size = 0
    for batch in batches:
        rows = np.stack([c.fill_null(0).to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)  # only the root's parent is null
        held.append(rows)
        size += len(rows)
        if size >= BUFFER:
            rows = np.concatenate(held)
            last = np.flatnonzero((rows[:, 0] != rows[-1, 0]) | (rows[:, 1] != rows[-1, 1]))
            if len(last):
                yield _solved(rows[: last[-1] + 1])
                rows = rows[last[-1] + 1 :]
            held, size = [rows], len(rows)
    if size:
        yield _solved(np.concatenate(held))


def _solved(rows: np.ndarray) -> pa.RecordBatch:
    where = {key: i for i, key in enumerate(map(tuple, rows[:, 2:4].tolist()))}
    is_top = (rows[:, 0] == rows[:, 2]) & (rows[:, 1] == rows[:, 3])
    parent = np.array([-1 if top else where[key] for top, key in zip(is_top.tolist(), map(tuple, rows[:, 4:6].tolist()), strict=True)], np.int64)
    total = subtree_sums(parent, rows[:, 6].copy(), rows[:, 7:9].copy()) + rows[:, 9:11]
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in (rows[:, 2], rows[:, 3], total[:, 0], total[:, 1])], ["ka", "kb", "n_leaves", "saved_tokens"])


def trie(sequences: DataFrame, convs: DataFrame, local_weight: int = 20_000) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 and key of every node.

    ``sequences`` has the turns of every conversation (conv, part, place, digest, words, length), ``convs`` its length; both
    as ``plain`` and ``graft`` give them. Components of up to ``local_weight`` are worked out in a task.
    """
    rows = written(chained(sequences))
    convs = written(convs)
    ends = rows.filter("depth = length").select("ka", "kb", "conv").union(convs.filter("length = 0").select(F.lit(ROOT_KEY[0]).alias("ka"), F.lit(ROOT_KEY[1]).alias("kb"), "conv"))
    chosen = ends.groupBy("ka", "kb").agg(F.min("conv").alias("conv")).select("conv")
    carriers = written(rows.join(chosen, "conv", "left_semi"))
    weights = carriers.groupBy("ka", "kb").agg(F.sum(F.col("length") - F.col("depth") + 1).alias("left"), F.min("conv").alias("carrier"))
    nodes = rows.groupBy("ka", "kb").agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("depth").alias("depth"), F.min("pa").alias("pa"), F.min("pb").alias("pb"), F.min("words").alias("words")).join(weights, ["ka", "kb"])
    every = convs.agg(F.min("conv"), F.count("*")).first()
    whole = convs.join(chosen, "conv", "left_semi").agg(F.coalesce(F.sum(F.col("length") + 1), F.lit(0)).alias("left"), F.min("conv").alias("carrier"))
    key = [F.lit(k) for k in ROOT_KEY]
    root = whole.filter(F.col("left") > 0).select(key[0].alias("ka"), key[1].alias("kb"), F.lit(every[0]).cast("bigint").alias("conv_id"), F.lit(every[1]).alias("n_convs"), F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("bigint").alias("pa"), F.lit(None).cast("bigint").alias("pb"), F.lit(0).cast("bigint").alias("words"), "left", "carrier")
    nodes = nodes.select(root.columns).union(root)
    fan = nodes.filter("depth > 0").groupBy("pa", "pb").agg(F.count("*").alias("n_children")).select(F.col("pa").alias("ka"), F.col("pb").alias("kb"), "n_children")
    nodes = nodes.join(fan, ["ka", "kb"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("bigint"))
    nodes = written(nodes.withColumn("leaf", (F.col("n_children") == 0).cast("bigint")).withColumn("saved", (F.col("n_convs") - 1) * F.col("words")))
    parents = nodes.filter("n_children > 0 and depth > 0").select(F.col("ka").alias("pa"), F.col("kb").alias("pb"), F.col("conv_id").alias("of"))
    above = F.when(F.col("depth") == 1, F.lit(every[0]).cast("bigint")).otherwise(F.col("of"))
    known = nodes.filter("depth <= 1").withColumn("of", F.lit(None).cast("bigint")).unionByName(nodes.filter("depth > 1").join(parents, ["pa", "pb"]))
    out = known.withColumn("parent_conv_id", above).drop("leaf", "saved", "left", "carrier").join(rolled_up(nodes, carriers, local_weight), ["ka", "kb"]).join(joined_ids(ends), ["ka", "kb"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"), "ka", "kb")

"""SimHash near-duplicates by pivot distance tables.

Equal fingerprints are one vertex. Fingerprints that differ in at most ``bits`` places agree on some ``blocks - bits``
of ``blocks`` groups of places, so each goes to one bucket for every such choice; no pair within ``bits`` is missed.
In a bucket every fingerprint has a row in the pivot table, its Hamming distances to fixed reference fingerprints. By
the triangle inequality a pair whose rows differ by more than ``bits`` in any coordinate is discarded; the others are
verified. A bucket gives the links that first connect its members, not all its pairs. Buckets with more than ``TILE``
members are cut to tiles by a hash, and pairs of tiles are dealt to different tasks.

Defined results: null, empty and wordless texts have fingerprint zero and link like any other; fewer words than a
shingle are one shingle; repeated rows have equal fingerprints; a row without an id takes part and gets the smallest id
of its component, null if it has none; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import FEW, checkpointed, shuffled, small, small_batches, tidy, written
from logloom.llm.components import SALTS, components

SEED = 42
TILE = 2048
PIVOTS = 24
#: Only these part words: the space and the ASCII controls from tab to carriage return.
SPACES = bytes(32 if 9 <= c <= 13 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return [w for w in text.encode().translate(SPACES).split(b" ") if w] if text else []


def fingerprint(words: list[bytes], size: int) -> int:
    """Majority of the bits of the shingles' hashes, repeats included."""
    if not words:
        return 0
    n = len(words) - size + 1
    if n <= 1:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.fromiter((digest(join(words[i : i + size]), SEED) for i in range(n)), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, 65536):
        ones += np.unpackbits(hashes[start : start + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fp (the 64 bits as a long); narrow, no shuffle."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(words_of(t), size) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(tidy(run), f"id {kind}, fp bigint").withColumnRenamed("id", id_col)


def masks(blocks: int, bits: int) -> list[int]:
    """For every choice of ``blocks - bits`` of the blocks, the mask of their places, as signed longs."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    each = [(1 << b) - (1 << a) for a, b in itertools.pairwise(edges)]
    found = [sum(c) for c in itertools.combinations(each, blocks - bits)]
    return [m - (1 << 64) if m >> 63 else m for m in found]


def blocks_for(n: int, bits: int) -> int:
    """Blocks such that keys have about as many bits as ``n`` distinct fingerprints need; the links do not depend on it."""
    wanted = math.log2(max(n, 2)) - 5
    return next((m for m in range(bits + 2, bits + 5) if 64 * (m - bits) / m >= wanted), bits + 4)


def pivots(count: int = PIVOTS) -> np.ndarray:
    return np.random.default_rng(3).integers(0, 2**64, count, dtype=np.uint64)


class Forest:
    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        p = self.parent
        while p[i] != i:
            p[i] = p[p[i]]
            i = p[i]
        return i

    def links(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Places of the pairs that connect what was apart."""
        out = []
        for k, (i, j) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            x, y = self.root(i), self.root(j)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                out.append(k)
        return out

    def flat(self) -> np.ndarray:
        """The root of every place, found for all at once."""
        while not np.array_equal(up := self.parent[self.parent], self.parent):
            self.parent = up
        return self.parent


def near(fp: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, bits: int) -> np.ndarray:
    """Which of the pairs (i, j) are within ``bits``: pivot coordinates first, survivors verified."""
    kept = np.arange(len(i))
    for start in range(0, table.shape[1], 6):
        a, b = table[i[kept], start : start + 6], table[j[kept], start : start + 6]
        kept = kept[(np.abs(a - b) <= bits).all(axis=1)]
    return kept[np.bitwise_count(fp[i[kept]] ^ fp[j[kept]]) <= bits]


def linked(group: np.ndarray, side: np.ndarray, fp: np.ndarray, refs: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Connecting pairs among rows of equal ``group``; rows stand together by group.

    ``side`` 0 and 1 are the two tiles of a pair, of which only mixed pairs are asked for; 2 pairs with all.
    """
    table = np.stack([np.bitwise_count(fp ^ r) for r in refs], axis=1).astype(np.int8) if len(fp) else np.zeros((0, len(refs)), np.int8)
    forest = Forest(len(fp))
    left, right = [], []
    found: list[np.ndarray] = []

    def connect() -> None:
        """Nearest pairs first, so a link that is refused later does not stand for closer ones."""
        if not found:
            return
        i, j, d = np.concatenate(found, axis=1)
        order = np.argsort(d, kind="stable")
        i, j = i[order], j[order]
        made = forest.links(i, j)
        left.append(i[made])
        right.append(j[made])
        found.clear()

    ends = np.append(np.flatnonzero(group[1:] != group[:-1]) + 1, len(group))
    last = ends[np.searchsorted(ends, np.arange(len(group)), side="right")] if len(group) else ends
    alive, step, waiting = np.arange(len(group)), 1, 0
    while len(alive):  # every row meets the row ``step`` places on, while that is in its group
        alive = alive[alive + step < last[alive]]
        i, j = alive, alive + step
        mixed = (side[i] == 2) | (side[i] != side[j])
        i, j = i[mixed], j[mixed]
        hit = near(fp, table, i, j, bits)
        i, j = i[hit], j[hit]
        found.append(np.stack([i, j, np.bitwise_count(fp[i] ^ fp[j])]))
        waiting += len(i)
        if waiting > 4_000_000:
            connect()
            waiting = 0
        step += 1
    connect()
    return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _scanner(refs: np.ndarray, bits: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def edges(rows: np.ndarray) -> pa.RecordBatch:
            a, b = linked(rows[0], rows[1], rows[2].view(np.uint64), refs, bits)
            return pa.RecordBatch.from_arrays([pa.array(rows[2][a]), pa.array(rows[2][b])], ["u", "v"])

        waiting = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([batch.column(c).to_numpy() for c in range(3)]))
            waiting += batch.num_rows
            if waiting < 100_000:
                continue
            rows = np.concatenate(held, axis=1)
            upto = int(np.searchsorted(rows[0], rows[0, -1], side="left"))  # the last bucket may go on
            if upto:
                yield edges(rows[:, :upto])
            held, waiting = [rows[:, upto:]], rows.shape[1] - upto
        if held:
            yield edges(np.concatenate(held, axis=1))

    return run


def link(prints: DataFrame, bits: int = 4) -> DataFrame:
    """(u, v): links between distinct fingerprints (column fp) that give the same components as all links within ``bits``."""
    n = prints.count()
    chosen = masks(blocks_for(n, bits), bits)
    spark = prints.sparkSession
    table = F.split(F.lit(",".join(map(str, chosen))), ",").cast("array<bigint>")
    keyed = prints.select("fp", F.posexplode(table).alias("t", "mask")).select(F.xxhash64("t", F.col("fp").bitwiseAND(F.col("mask"))).alias("key"), "fp")
    hot = checkpointed(keyed.groupBy("key").count().filter(F.col("count") > TILE).select("key", F.ceil(F.col("count") / TILE).cast("int").alias("tiles")))
    n_hot = hot.count()
    plain = keyed.withColumn("side", F.lit(2).cast("bigint"))
    if n_hot:
        hot = F.broadcast(hot) if n_hot <= 50_000 else hot  # two numbers a row
        plain = plain.join(hot, "key", "left_anti")
        tiled = keyed.join(hot, "key").withColumn("tile", F.pmod(F.xxhash64("fp", F.lit(1)), F.col("tiles")).cast("int"))
        pairs = tiled.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        low, high = F.least("tile", "other"), F.greatest("tile", "other")
        side = F.when(low == high, 2).otherwise((F.col("tile") == high).cast("int")).cast("bigint")
        plain = plain.union(pairs.select(F.xxhash64("key", low, high).alias("key"), "fp", side.alias("side")))
    rows = plain.select("key", "side", "fp").repartition("key").sortWithinPartitions("key", "side", "fp")
    small_batches(spark)
    return rows.mapInArrow(tidy(_scanner(pivots(), bits)), "u bigint, v bigint").distinct()


def cluster(docs: DataFrame, size: int = 4, bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fingerprint (hexadecimal), component_id (smallest id that links lead to).

    Documents carry only their fingerprint from here on; components are found among distinct fingerprints and joined
    back, so a group of copies, of any size, is one vertex.
    """
    held = checkpointed(fingerprints(docs, size, id_col, text_col))
    prints = held.groupBy("fp").agg(F.min(id_col).alias("least"))
    prints = checkpointed(prints)
    found = components(link(prints.select("fp"), bits))
    joined = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)))
    # only fingerprints with a link have a component to look up; salts spread the members of a large one
    smallest = joined.filter("component is not null").groupBy("component").agg(F.min("least").alias("component_id"))
    spread = smallest.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    linked_ones = joined.filter("component is not null").join(spread, ["component", "salt"]).select("fp", "component_id")
    of_print = linked_ones.union(joined.filter("component is null").select("fp", F.col("least").alias("component_id")))
    return held.join(of_print, "fp").select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shingle_sets(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(id, fp, hi, lo, shingles): sorted distinct 32-bit hashes of the shingles, packed, and 128 bits of hash of them; narrow."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, high, low, out = [], [], [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                cut = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
                packed = np.unique(np.fromiter((xxhash.xxh32_intdigest(c) for c in cut), dtype=np.uint32, count=len(cut))).tobytes()
                fps.append(fingerprint(words, size))
                high.append(xxhash.xxh64_intdigest(packed, 1))
                low.append(xxhash.xxh64_intdigest(packed, 2))
                out.append(packed)
            longs = [pa.array(np.array(x, dtype=np.uint64).view(np.int64)) for x in (fps, high, low)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *longs, pa.array(out, pa.binary())], ["id", "fp", "hi", "lo", "shingles"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(tidy(run), f"id {kind}, fp bigint, hi bigint, lo bigint, shingles binary")


def _similar(least: float):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
                shared = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(shared >= least * (len(a) + len(b) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) of vertices whose shingle sets have at least that Jaccard similarity."""
    small_batches(pairs.sparkSession)
    nodes = checkpointed(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    held = sets.join(small(nodes), "node", "left_semi")  # shingle sets are wide, and most of them are in no pair
    of_u, of_v = (held.select(F.col("node").alias(x), F.col("shingles").alias(y)) for x, y in (("u", "a"), ("v", "b")))
    return checkpointed(pairs.join(of_u, "u").join(of_v, "v").select("u", "v", "a", "b").mapInArrow(tidy(_similar(similarity)), "u bigint, v bigint"))


def frequent(sets: DataFrame, n: int, sample: int = 20_000, most: int = 20_000) -> np.ndarray:
    """Shingles that are frequent in a sample, the rarest first. They only order the prefixes; no result depends on them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found, count = np.unique(np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint32), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64)), pa.array(count.astype(np.int64))], ["h", "c"])

    part = sets.filter(F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1_000_000)) < math.ceil(1_000_000 * min(1.0, sample / max(n, 1))))
    counted = part.select("shingles").mapInArrow(tidy(run), "h bigint, c bigint").groupBy("h").agg(F.sum("c").alias("c")).filter("c > 2")
    return counted.orderBy(F.desc("c"), "h").limit(most).toPandas()["h"].to_numpy(dtype=np.uint32)[::-1].copy()


#: Bits of the map of keys that can give a pair: a fixed 8 MB, whatever the input.
MAP_BITS = 26


def key_map(keys: DataFrame) -> np.ndarray:
    """Which of ``2**MAP_BITS`` remainders the keys have, a bit each."""
    place = F.pmod(F.col("key"), F.lit(1 << MAP_BITS)) + 1
    found = keys.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros((1 << MAP_BITS) // 8, dtype=np.uint8)
    for r in found.collect():  # parts of 4 KB
        out[(r["part"] - 1) * 4096 :][: len(r["bits"])] = np.frombuffer(r["bits"], dtype=np.uint8)[: len(out)]
    return out


#: Longs of a sketch.
WIDE = 16
SKETCH = [f"s{k}" for k in range(WIDE)]


def sketch(shingles: np.ndarray, wide: int = WIDE) -> np.ndarray:
    """For each of ``64 * wide`` places, a power of two, whether an odd number of the set's hashes falls there.

    Every place in which two sketches differ takes a shingle that only one of the sets has, so the sets differ in at
    least as many shingles.
    """
    odd = (np.bincount(shingles >> np.uint32(32 - (64 * wide).bit_length() + 1), minlength=64 * wide) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64)


def prefixes(sets: DataFrame, similarity: float, last: np.ndarray, live: np.ndarray | None = None) -> DataFrame:
    """(key, node, component, n, place, sketch): of each set the shingles of which sets that similar must share one.

    Sets of n and m shingles with a Jaccard similarity of t share t * max(n, m) at least. With all shingles in one order,
    they then share one among the first n - ceil(t * n) + 1 of the one and the first m - ceil(t * m) + 1 of the other. Keys
    that are not in the map ``live`` are left out; those that are there by chance do no harm. Without a map the rows are
    only counted and carry no sketch.
    """
    spark = sets.sparkSession
    small_batches(spark)
    shared, kept = spark.sparkContext.broadcast(last), spark.sparkContext.broadcast(live)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(shared.value, kind="stable")
        known = shared.value[order]
        for batch in batches:
            parts: list[list[np.ndarray]] = []
            drawn: list[np.ndarray] = []
            for k, packed in enumerate(batch.column(2).to_pylist()):
                a = np.frombuffer(packed, np.uint32)
                if not len(a):
                    continue
                rank = np.zeros(len(a), dtype=np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, a), len(known) - 1)
                    rank = np.where(known[at] == a, order[at] + 1, 0)
                upto = len(a) - math.ceil(similarity * len(a) - 1e-9) + 1
                first = a[np.lexsort((a, rank))[:upto]]
                at = np.arange(len(first))
                if kept.value is not None:
                    low = first & np.uint32((1 << MAP_BITS) - 1)
                    at = np.flatnonzero((kept.value[low >> np.uint32(3)] >> (low & np.uint32(7)).astype(np.uint8)) & 1)
                    drawn.append(np.repeat(sketch(a)[:, None], len(at), axis=1))
                parts.append([np.full(len(at), k), first[at].astype(np.int64), np.full(len(at), len(a)), at])
            if parts:
                k, key, n, place = (np.concatenate(x) for x in zip(*parts, strict=True))
                found = [pa.array(key), batch.column(0).take(pa.array(k)), batch.column(1).take(pa.array(k)), pa.array(n), pa.array(place)]
                found += [pa.array(x) for x in np.concatenate(drawn, axis=1)] if drawn else []
                yield pa.RecordBatch.from_arrays(found, names)

    names = ["key", "node", "component", "n", "place"] + (SKETCH if live is not None else [])
    return sets.select("node", "component", "shingles").mapInArrow(tidy(run), ", ".join(f"{x} bigint" for x in names))


def _sharing(similarity: float):  # noqa: ANN202
    """Links between sets of one key that lie in different components and can still be as similar, by their sizes, places and sketches.

    A task gives the links that first connect its sets, fewer than it has sets, however many pairs there are.
    """

    def can_be(drawn: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs have sketches no farther apart than sets of that similarity; most fail on the first words."""
        kept, apart = np.arange(len(i)), np.zeros(len(i), dtype=np.int64)
        most = (1 - similarity) * (n[i] + n[j]) + 1e-6
        for word in drawn:
            apart = apart + np.bitwise_count(word[i[kept]] ^ word[j[kept]])
            still = (1 + similarity) * apart <= most[kept]
            kept, apart = kept[still], apart[still]
        return kept

    def pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        key, side, node, component, n, place = rows[:6]
        drawn = rows[6:].view(np.uint64)
        ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
        last = ends[np.searchsorted(ends, np.arange(len(key)), side="right")]
        names, vertex = np.unique(node, return_inverse=True)
        forest, found = Forest(len(names)), []
        alive, step, root = np.arange(len(key)), 1, forest.flat()
        while len(alive):
            alive = alive[alive + step < last[alive]]
            i, j = alive, alive + step
            hit = (component[i] != component[j]) & ((side[i] == 2) | (side[i] != side[j])) & (root[vertex[i]] != root[vertex[j]])
            i, j = i[hit], j[hit]
            most = np.minimum(n[i] - place[i], n[j] - place[j])
            hit = (1 + similarity) * most >= similarity * (n[i] + n[j]) - 1e-6
            i, j = i[hit], j[hit]
            hit = can_be(drawn, n, i, j)
            i, j = vertex[i[hit]], vertex[j[hit]]
            made = forest.links(i, j)
            if made:
                found.append(np.stack([names[i[made]], names[j[made]]]))
                root = forest.flat()
            step += 1
        if found:
            u, v = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        waiting = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([batch.column(c).to_numpy() for c in range(6 + WIDE)]))
            waiting += batch.num_rows
            if waiting < 100_000:
                continue
            rows = np.concatenate(held, axis=1)
            upto = int(np.searchsorted(rows[0], rows[0, -1], side="left"))  # the last key may go on
            if upto:
                yield from pairs(rows[:, :upto])
            held, waiting = [rows[:, upto:]], rows.shape[1] - upto
        if held:
            yield from pairs(np.concatenate(held, axis=1))

    return run


def sharing(sets: DataFrame, similarity: float, last: np.ndarray) -> DataFrame:
    """(u, v): links that connect all sets (node, component, shingles) of different components that can have that similarity.

    Both sets of every such pair are in one component of these links, which are not verified. Keys of one component are
    left out by an aggregate; of the others, those with more than ``TILE`` rows are tiled.
    """
    spark = sets.sparkSession
    counted = prefixes(sets, similarity, last).groupBy("key").agg(F.count("*").alias("count"), F.min("component").alias("a"), F.max("component").alias("b"))
    keys = written(counted.filter("a <> b").select("key", F.ceil(F.col("count") / TILE).cast("int").alias("tiles")))
    live = prefixes(sets, similarity, last, key_map(keys)).join(small(keys, FEW // 3), "key")
    tile = F.pmod(F.xxhash64("node", F.lit(1)), F.col("tiles")).cast("int")
    dealt = live.withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    low, high = F.least("tile", "other"), F.greatest("tile", "other")
    side = F.when(low == high, 2).otherwise((F.col("tile") == high).cast("int")).cast("bigint")
    dealt = dealt.select(F.xxhash64("key", low, high).alias("key"), side.alias("side"), "node", "component", "n", "place", *SKETCH)
    small_batches(spark)
    dealt = dealt.repartition("key").sortWithinPartitions("key", "side", "node")
    return checkpointed(dealt.mapInArrow(tidy(_sharing(similarity)), "u bigint, v bigint").distinct())


#: Bytes of shingles or sketches of a tile.
TILE_BYTES = 1 << 22


def _connecting(similarity: float, exact: bool):  # noqa: ANN202
    """Links that first connect the sets of one key; sides as in ``linked``. By shingles if ``exact``, else by sketches of equal width, which miss none."""

    def pairs(side: np.ndarray, n: np.ndarray, drawn: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
        ids = np.split(np.unique(np.concatenate(sets), return_inverse=True)[1], np.cumsum(n)[:-1]) if exact else []
        root, marks, places = np.arange(len(n)), np.zeros(int(n.sum()) if exact else 0, dtype=bool), np.arange(len(n))
        half = drawn.shape[1] // 2
        for i in range(len(n) - 1):
            fits = (np.minimum(n, n[i]) >= similarity * np.maximum(n, n[i]) - 1e-6) & ((side == 2) | (side != side[i]))
            j = np.flatnonzero((places > i) & (root != root[i]) & fits)
            apart = np.zeros(len(j), dtype=np.int64)
            for part in (slice(0, half), slice(half, None)):  # most fail on the first half
                apart = apart + np.bitwise_count(drawn[j, part] ^ drawn[i, part]).sum(axis=1, dtype=np.int64)
                still = (1 + similarity) * apart <= (1 - similarity) * (n[j] + n[i]) + 1e-6
                j, apart = j[still], apart[still]
            if exact and len(j):
                marks[ids[i]] = True
                shared = np.add.reduceat(marks[np.concatenate([ids[k] for k in j])], np.cumsum(n[j]) - n[j], dtype=np.int64)
                marks[ids[i]] = False
                j = j[shared >= similarity * (n[j] + n[i] - shared)]
            if len(j):
                met, at = np.unique(root[j], return_index=True)
                yield from ((i, int(k)) for k in j[at])
                root[np.isin(root, met)] = root[i]

    def links(held: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        side, node, n = (np.array(x, dtype=np.int64) for x in list(zip(*held, strict=True))[:3])
        sets = [np.frombuffer(r[3], np.uint32 if exact else np.uint64) for r in held]
        drawn = np.stack([sketch(a, width(n.mean())).view(np.uint64) for a in sets] if exact else sets)
        found = np.array(list(pairs(side, n, drawn, sets)), dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(node[found[:, 0]]), pa.array(node[found[:, 1]])], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        now = None
        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != now and held:
                    yield links(held)
                    held = []
                now = key
                held.append(tuple(row))
        if held:
            yield links(held)

    return run


def width(n: float) -> int:
    """Longs of a sketch that tells sets of some ``n`` shingles apart, ``WIDE`` at least."""
    return max(WIDE, 1 << (int(n) // 64).bit_length())


def connecting(held: DataFrame, similarity: float, exact: bool) -> DataFrame:
    """(u, v): links among the sets of each group of ``held`` (group, node, n, load); ``load`` has shingles if ``exact``, else sketches.

    Groups with more than ``TILE`` sets or ``TILE_BYTES`` of load are tiled. A task gives fewer links than it has sets.
    """
    wanted = F.greatest(F.count("*") / TILE, F.sum(F.octet_length("load")) / TILE_BYTES)
    tiles = held.groupBy("group").agg(F.ceil(wanted).cast("int").alias("tiles"))
    dealt = held.join(small(tiles), "group").withColumn("tile", F.pmod(F.xxhash64("node", F.lit(1)), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    low, high = F.least("tile", "other"), F.greatest("tile", "other")
    side = F.when(low == high, 2).otherwise((F.col("tile") == high).cast("int")).cast("bigint")
    dealt = dealt.select(F.xxhash64("group", low, high).alias("key"), side.alias("side"), "node", "n", "load")
    dealt = dealt.repartition("key").sortWithinPartitions("key", "side", "node")
    return checkpointed(dealt.mapInArrow(tidy(_connecting(similarity, exact)), "u bigint, v bigint"))


def _drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        wide, packed = batch.column(4).to_pylist(), batch.column(3).to_pylist()
        load = [sketch(np.frombuffer(a, np.uint32), w).tobytes() for a, w in zip(packed, wide, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(load, pa.binary())], ["group", "node", "n", "load"])


def proven(links: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(u, v): verified links with the same components as all pairs of that similarity among the sets that ``links`` connect.

    A component of ``links`` is one group, whose sets are compared where they lie together. Groups of more than ``TILE_BYTES``
    of shingles, as long texts with a common line give, are first cut to groups that sketches of their sets' width connect.
    """
    small_batches(links.sparkSession)
    sets = sets.select("node", (F.octet_length("shingles") / 4).cast("bigint").alias("n"), F.col("shingles").alias("load"))
    groups = components(links).withColumnRenamed("component", "group")
    sized = checkpointed(sets.select("node", "n").join(shuffled(groups), "node"))
    large = checkpointed(sized.groupBy("group").agg(F.sum("n").alias("all"), F.avg("n").alias("mean")).filter(F.col("all") * 4 > TILE_BYTES))
    if large.count():
        power = F.length(F.conv(F.floor(F.col("mean") / 64).cast("string"), 10, 2))
        wide = large.select("group", F.greatest(F.lit(WIDE), F.when(F.col("mean") < 64, 1).otherwise(F.pow(F.lit(2), power))).cast("bigint").alias("wide"))
        of = sized.join(F.broadcast(wide), "group").select("node", "group", "wide")  # groups of some MB each
        drawn = sets.join(small(of), "node").select("group", "node", "n", "load", "wide").mapInArrow(tidy(_drawn), "group bigint, node bigint, n bigint, load binary")
        finer = components(connecting(written(drawn), similarity, False)).withColumnRenamed("component", "group")
        sized = checkpointed(sized.join(F.broadcast(large), "group", "left_anti").select("node", "group").union(finer.select("node", "group")))
    held = sets.join(small(sized.select("node", "group")), "node").select("group", "node", "n", "load")
    return connecting(written(held), similarity, True)


#: Smallest shingle hashes of a set by which it looks for a representative.
LEAST = 4


def representatives(sets: DataFrame) -> DataFrame:
    """(u, v): for each set at most one other, the first of those that share one of its ``LEAST`` smallest shingle hashes.

    Similar sets share these far more often than not, so the members of a group of near copies name the same one, and a
    group costs its size and not the square of it. Nothing depends on whom a set names: pairs that stay apart are met later.
    """
    key = lambda k: F.conv(F.hex(F.substring("shingles", 4 * k + 1, 4)), 16, 10).cast("bigint")
    keys = sets.filter(F.octet_length("shingles") > 0).select("node", F.explode(F.array_compact(F.array(*[F.when(F.octet_length("shingles") > 4 * k, key(k)) for k in range(LEAST)]))).alias("key"))
    first = keys.groupBy("key").agg(F.min("node").alias("head"), F.count("*").alias("n")).filter("n > 1").select("key", "head")
    named_by = keys.join(first, "key").filter("node <> head").groupBy("node", "head").agg(F.count("*").alias("n"))
    return named_by.groupBy("node").agg(F.min_by("head", F.struct(-F.col("n"), F.col("head"))).alias("u")).select("u", F.col("node").alias("v"))


def gathered(edges: DataFrame, rounds: int = 3) -> DataFrame:
    """(node, component): every node of an edge with the smallest node that some ``rounds`` of looking around lead to.

    In a round a node takes the smallest label of itself and its neighbours, and then that node's label. Nodes of one label
    are connected, though not all connected ones need have one label yet.
    """
    both = checkpointed(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    points = both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("component"))
    for _ in range(rounds):
        points = checkpointed(points)
        around = both.join(shuffled(points.withColumnRenamed("node", "v")), "v").groupBy(F.col("u").alias("node")).agg(F.min("component").alias("m"))
        low = points.join(shuffled(around), "node").select("node", F.least("component", "m").alias("component"))
        points = low.join(shuffled(points.select(F.col("node").alias("component"), F.col("component").alias("to"))), "component").select("node", F.col("to").alias("component"))
    return checkpointed(points)


def named(sets: DataFrame, found: DataFrame) -> DataFrame:
    """``sets`` with the component of ``found`` (node, component), their own node where they have none."""
    return sets.join(small(found), "node", "left").withColumn("component", F.coalesce("component", "node"))


def keep_one(docs: DataFrame, size: int = 5, bits: int = 4, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row (smallest id) of each near-duplicate component.

    Components are those of all pairs whose shingle sets have at least that Jaccard ``similarity``. Equal sets are one
    vertex. Verified links between fingerprints within ``bits`` and to representatives come first and gather most copies; then
    sets that these leave apart and that can be as similar are grouped, and the groups searched for pairs that are, so the
    components depend on neither.
    Rows that share an id stay or go together, but for repeated rows, of which one stays; rows without an id are not
    compared and stay.
    """
    known = docs.filter(docs[id_col].isNotNull())
    found = shingle_sets(known, size, id_col, text_col).groupBy("hi", "lo").agg(F.min("id").alias("least"), F.min("fp").alias("fp"), F.first("shingles").alias("shingles"))
    sets = written(found.select(F.monotonically_increasing_id().alias("node"), "least", "fp", "shingles"))
    prints = checkpointed(sets.groupBy("fp").agg(F.min("node").alias("head")))
    near = checkpointed(link(prints.select("fp"), bits))
    near = near.join(prints.select(F.col("fp").alias("u"), F.col("head").alias("x")), "u").join(prints.select(F.col("fp").alias("v"), F.col("head").alias("y")), "v").select(F.col("x").alias("u"), F.col("y").alias("v"))
    near = near.union(sets.join(prints, "fp").filter("node <> head").select(F.col("head").alias("u"), F.col("node").alias("v"))).union(representatives(sets))
    near = near.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    edges = verified(checkpointed(near), sets, similarity)
    links = sharing(named(sets.select("node", "shingles"), gathered(edges)), similarity, frequent(sets, sets.count()))
    edges = edges.union(proven(links, sets, similarity))
    stay = named(sets.select("node", "least"), components(edges)).groupBy("component").agg(F.min("least").alias(id_col)).select(id_col).distinct()
    kept = known.join(small(checkpointed(stay)), id_col, "left_semi")
    if known.groupBy(id_col).count().filter("count > 1").limit(1).count():
        kept = kept.dropDuplicates([id_col, text_col])
    return kept.unionByName(docs.filter(docs[id_col].isNull()))

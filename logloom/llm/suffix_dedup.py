"""Suffix-array dedup: bytes that repeat an earlier passage of ``depth`` bytes are removed.

1. Every passage of ``depth`` bytes has an anchor that its bytes alone decide: the ``GRAM`` bytes in it whose hash is
   least. Neighbouring passages with one anchor are a run. Equal passages have equal anchors at equal offsets, so a run
   can share passages only with runs of its gram. Runs of equal bytes are aggregated first, in each chunk of documents
   and then by gram: all but the first repeat as a whole. Equal here means equal in three 64-bit hashes, of the gram and
   twice of the run under independent bases; runs that differ in one of them go on to 2, where bytes are compared.
2. Where runs of different bytes share a gram, the first of each is cut out of its text and dealt by gram to suffix
   buckets. Grams with very many contents are dealt by more of the bytes that their passages have in common (quarters of
   the offset, then whole passages, which a minimum by bytes settles), so no bucket grows with the number of places where a common line stands.
3. A task sorts one block of buckets at a time (``suffix_order``): equal passages stand together, all but the first by
   (id, place) are marked.
4. Marks go back to their documents.

A difference cover settles long ties inside a block; memory is bounded by the size of a block and of a chunk. A chunk is
at least a document: a very long text is anchored as a whole, at about ten numbers of eight bytes a byte of it.

Defined results: a null text is empty; texts shorter than ``depth`` lose nothing; a null id sorts before all others;
rows that share an id are ordered by a hash of their text, and rows that repeat id and text are one document with equal
results; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logloom.llm.common import small_batches, tidy, written
from logloom.llm.suffix_order import PERIOD, equal_neighbours, suffix_order

DEPTH, GRAM = 100, 32
#: Bytes of a chunk and of a block of buckets.
CHUNK, BLOCK = 1 << 20, 4 << 20
#: Contents of a gram beyond which its runs are dealt by more of their bytes, and within a chunk beyond which they are spread.
HEAVY_RUNS, LOCAL_HOT = 16384, 16
#: Bits of a place in its chunk; the rest of a word holds the gram's hash, and equal hashes go to the earlier place.
PLACE = np.uint64((1 << 32) - 1)
#: Odd bases of two independent rolling hashes.
BASE, SECOND = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
REPLY, MARK, CHECK, HEAVY, SPREAD = range(5)


class Hashes:
    """Rolling hashes of a flat array of bytes: multiplications modulo 2**64 with an odd base, which has an inverse."""

    def __init__(self, flat: np.ndarray, base: int = BASE) -> None:
        n = len(flat)
        self.inverse = self.powers(pow(base, -1, 1 << 64), n)
        terms = (flat.astype(np.uint64) + np.uint64(1)) * self.powers(base, n)
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(terms, out=self.prefix[1:])

    @staticmethod
    def powers(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, dtype=np.uint64)
        if n:
            out[0] = 1
            np.cumprod(out, out=out)
        return out

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return finish((self.prefix[end] - self.prefix[begin]) * self.inverse[begin])


def finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def anchors(flat: np.ndarray, sizes: np.ndarray, depth: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document, first start, number of starts, anchor, gram hash) of each run; places count from the chunk's begin."""
    none = tuple(np.zeros(0, dtype=np.int64) for _ in range(4)) + (np.zeros(0, dtype=np.uint64),)
    n, width = len(flat), depth - gram + 1
    if n < depth:
        return none
    places = np.arange(n - gram + 1)
    grams = Hashes(flat).of(places, places + gram)
    low = (grams & ~PLACE) | places.astype(np.uint64)
    covered = 1
    while covered * 2 <= width:
        low = np.minimum(low[:-covered], low[covered:])
        covered *= 2
    if covered < width:
        low = np.minimum(low[: covered - width], low[width - covered :])
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(sizes)), sizes)[: len(low)]
    valid = np.arange(len(low)) + depth <= ends[doc]
    start = np.flatnonzero(valid)
    if not len(start):
        return none
    anchor = (low[start] & PLACE).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(start) != 1) | (np.diff(doc[start]) != 0)])
    count = np.diff(np.append(first, len(start)))
    return doc[start[first]], start[first], count, anchor[first], grams[anchor[first]]


def chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK) -> Iterator[tuple[list, list, np.ndarray, np.ndarray]]:
    """Key columns, texts, sizes and the flat bytes of documents of about ``limit`` bytes together."""
    keys: list[tuple] = []
    texts: list[bytes] = []
    extra: list = []
    total = 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in range(batch.num_columns)]
        for row in zip(*columns, strict=True):
            text = row[2].encode() if row[2] else b""
            keys.append((row[0], row[1]))
            texts.append(text)
            extra.append(row[3:])
            total += len(text)
            if total >= limit:
                yield _chunk(keys, texts, extra)
                keys, texts, extra, total = [], [], [], 0
    if keys:
        yield _chunk(keys, texts, extra)


def columns_of(keys: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids (0 for null), which of them are null, and hashes."""
    return np.array([k[0] or 0 for k in keys], dtype=np.int64), np.array([k[0] is None for k in keys], dtype=bool), np.array([k[1] for k in keys], dtype=np.int64)


def _chunk(keys: list, texts: list, extra: list):  # noqa: ANN202
    order = sorted(range(len(keys)), key=lambda i: (keys[i][0] is not None, keys[i]))
    texts = [texts[i] for i in order]
    return [keys[i] for i in order], [extra[i] for i in order], np.fromiter(map(len, texts), np.int64, len(texts)), np.frombuffer(b"".join(texts), dtype=np.uint8)


def _runs(depth: int, gram: int, chunk: int, local_hot: int):  # noqa: ANN202
    """Runs of a chunk: the first of each content asks for a reply, the others repeat it and are marked at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, _, sizes, flat in chunks(batches, chunk):
            doc, start, count, anchor, g = anchors(flat, sizes, depth, gram)
            base = (np.cumsum(sizes) - sizes)[doc] if len(doc) else start
            offset = anchor - start
            u, w = (Hashes(flat, b).of(start, start + count - 1 + depth) ^ finish((offset * 256 + count).astype(np.uint64)) if len(doc) else g for b in (BASE, SECOND))
            pack = ((start - base) << 16) | (count << 8) | offset
            order = np.lexsort((u, g))  # stable: the first of equal runs stays first
            new_g = np.r_[True, g[order][1:] != g[order][:-1]][: len(g)]
            new_u = new_g | np.r_[True, (u[order][1:] != u[order][:-1]) | (w[order][1:] != w[order][:-1])][: len(g)]
            group = np.cumsum(new_g) - 1
            contents = np.bincount(group, new_u, minlength=1).astype(np.int64)
            kind = np.empty(len(g), dtype=np.int8)
            kind[order] = np.where(~new_u, MARK, np.where(contents[group] > local_hot, SPREAD, REPLY)) if len(g) else 0
            hot = np.flatnonzero(contents > local_hot)
            firsts = order[np.flatnonzero(new_g)[hot]]
            every = np.concatenate([np.arange(len(g)), firsts])
            owner, kind = doc[every], np.concatenate([kind, np.full(len(hot), HEAVY, dtype=np.int8)])
            ids, null, hashes = columns_of(keys)
            columns = [pa.array(x.view(np.int64)[every]) for x in (g, u, w)]
            number = np.concatenate([pack, contents[hot]])
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids[owner], mask=null[owner]), pa.array(hashes[owner]), pa.array(number), pa.array(kind)], ["g", "u", "w", "doc", "hash", "pack", "kind"])

    return run


def _replies(limit: int):  # noqa: ANN202
    """Marks of runs whose content stands earlier, first runs whose gram has other contents (CHECK), and a HEAVY row with
    the number of contents of every gram with more than ``limit``. Rows come sorted by gram, content and place."""

    def settle(rows: pa.Table) -> pa.RecordBatch:
        g, u, w, pack, kind = (rows.column(c).to_numpy() for c in ("g", "u", "w", "pack", "kind"))
        asks = (kind == REPLY) | (kind == SPREAD)
        group = np.cumsum(np.r_[True, g[1:] != g[:-1]]) - 1
        at = np.flatnonzero(asks)
        first = np.zeros(len(g), dtype=bool)
        first[at] = np.r_[True, (g[at][1:] != g[at][:-1]) | (u[at][1:] != u[at][:-1]) | (w[at][1:] != w[at][:-1])][: len(at)]
        contents = np.bincount(group, first & (kind == REPLY)).astype(np.int64) + np.bincount(group, np.where(kind == HEAVY, pack, 0)).astype(np.int64)
        state = np.where(asks & ~first, MARK, np.where(first & ((contents[group] > 1) | (kind == SPREAD)), CHECK, np.where(kind == MARK, MARK, 0)))
        keep = np.flatnonzero(state > 0)
        heavy = np.flatnonzero(np.r_[True, g[1:] != g[:-1]] & (contents[group] > limit))
        out = rows.take(pa.array(keep)).select(["g", "doc", "hash", "pack"]).append_column("kind", pa.array(state[keep].astype(np.int8)))
        notes = pa.table({"g": g[heavy], "doc": pa.nulls(len(heavy), pa.int64()), "hash": np.zeros(len(heavy), np.int64), "pack": contents[group[heavy]], "kind": np.full(len(heavy), HEAVY, np.int8)})
        merged = pa.concat_tables([out, notes]).combine_chunks()
        return merged.to_batches()[0] if len(merged) else pa.RecordBatch.from_pylist([], schema=merged.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        waiting = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            waiting += batch.num_rows
            if waiting < 200_000:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            g = rows.column("g").to_numpy()
            upto = int(np.searchsorted(g, g[-1], side="left"))
            if upto:
                yield settle(rows.slice(0, upto))
            held, waiting = rows.slice(upto).to_batches(), rows.num_rows - upto
        if held:
            yield settle(pa.Table.from_batches(held).combine_chunks())

    return run


def _pieces(depth: int, gram: int, chunk: int):  # noqa: ANN202
    """Documents with their repeated runs (packed numbers, gram hashes, levels) to pieces for the buckets, and to the
    marks that a chunk already knows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, extra, sizes, flat in chunks(batches, chunk):
            base = np.cumsum(sizes) - sizes
            doc = np.repeat(np.arange(len(keys)), [len(x[0]) for x in extra])
            packs = np.array([r["pack"] for x in extra for r in x[0]], dtype=np.int64)
            level = np.array([r["level"] for x in extra for r in x[0]], dtype=np.int64)
            g = np.array([r["g"] for x in extra for r in x[0]], dtype=np.int64)
            if not len(doc):
                continue
            order = np.lexsort((packs, doc))
            doc, packs, level, g = doc[order], packs[order], level[order], g[order]
            start, count, offset = base[doc] + (packs >> 16), (packs >> 8) & 255, packs & 255
            # level 0: the run; 1: cut where the offset of the anchor enters another quarter; 2: each passage
            width = np.array([depth, -(-(depth - gram + 1) // 4), 1])[level]
            low = (offset - count + 1) // width
            many = offset // width - low + 1
            step = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
            at = np.repeat(np.arange(len(doc)), many)
            quarter = (offset // width)[at] - step
            highest = np.minimum(offset[at], (quarter + 1) * width[at] - 1)
            lowest = np.maximum((offset - count + 1)[at], quarter * width[at])
            start, count, offset = start[at] + offset[at] - highest, highest - lowest + 1, highest
            doc, level, g = doc[at], level[at], g[at]
            end = start + count - 1 + depth
            h = Hashes(flat)
            content = h.of(start, end) ^ finish((offset * 256 + count).astype(np.uint64))
            # what all passages of the piece's quarter have in common with the anchor
            left = np.where(level == 1, quarter * width[at], 0)
            right = np.where(level == 1, depth - gram - np.minimum((quarter + 1) * width[at] - 1, depth - gram), 0)
            anchor = start + offset
            core = h.of(anchor - left, anchor + gram + right) ^ finish(quarter.astype(np.uint64))
            key = np.where(level == 2, finish(content).view(np.int64), np.where(level == 1, finish(core).view(np.int64), g))
            _, first = np.unique(content, return_index=True)
            raw = flat.tobytes()
            is_first = np.zeros(len(doc), dtype=bool)
            is_first[first] = True
            # equal hashes are held against the bytes of their first
            owner = first[np.searchsorted(content[first], content)] if len(first) else first
            for i in np.flatnonzero(~is_first):
                if raw[start[i] : end[i]] != raw[start[owner[i]] : end[owner[i]]]:
                    is_first[i] = True
            ids, null, hashes = columns_of(keys)
            local = start - base[doc]
            body = [raw[s:e] if f else None for s, e, f in zip(start.tolist(), end.tolist(), is_first.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(ids[doc], mask=null[doc]), pa.array(hashes[doc]), pa.array(local), pa.array(count), pa.array(offset), pa.array(body, pa.binary()), pa.array(level == 2)],
                ["key", "doc", "hash", "start", "count", "offset", "body", "single"],
            )

    return run


def _sorted_marks(depth: int, limit: int):  # noqa: ANN202
    """Pieces, sorted by key, to marked runs of starts (doc, hash, start, count)."""

    def marks(rows: list[tuple]) -> list[tuple]:
        """One block: pieces are laid out so that anchors stand at multiples of the period."""
        rows.sort(key=lambda r: (r[1] is not None, r[1], r[2], r[3]))
        bodies, places, at = [], [], 0
        for r in rows:
            lead = -(at + r[5]) % PERIOD
            bodies += [b"\0" * lead, r[6]]
            places.append(at + lead)
            at += lead + len(r[6])
        text = np.frombuffer(b"".join([*bodies, b"\0" * (2 * depth + 4 * PERIOD)]), dtype=np.uint8)
        count = np.array([r[4] for r in rows], dtype=np.int64)
        row = np.repeat(np.arange(len(rows)), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        starts = np.array(places, dtype=np.int64)[row] + step
        keys = np.unique(np.array([r[0] for r in rows], dtype=np.int64), return_inverse=True)[1]
        bucket = keys[row] * 256 + np.array([r[5] for r in rows], dtype=np.int64)[row] - step
        order = suffix_order(text, starts, depth, bucket)
        same = np.r_[False, equal_neighbours(text, starts, order, depth, bucket)] if len(order) else np.zeros(0, bool)
        group = np.cumsum(~same)
        least = np.minimum.reduceat(order, np.flatnonzero(~same)) if len(order) else order  # starts ascend by (doc, place)
        dup = np.zeros(len(starts), dtype=bool)
        dup[order] = order != least[group - 1]
        begin = np.flatnonzero(dup & np.r_[True, ~dup[:-1] | (row[1:] != row[:-1])])
        end = np.flatnonzero(dup & np.r_[~dup[1:] | (row[1:] != row[:-1]), True])
        return [(rows[row[i]][1], rows[row[i]][2], int(rows[row[i]][3] + step[i]), int(j - i + 1)) for i, j in zip(begin.tolist(), end.tolist(), strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []
        size, last = 0, None

        def out(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) if found else [(), (), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], ["doc", "hash", "start", "count"])

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in range(7)], strict=True):
                if size >= limit and row[0] != last:
                    yield out(marks(block))
                    block, size = [], 0
                block.append(row)
                size += len(row[6])
                last = row[0]
        if block:
            yield out(marks(block))

    return run


def whole_characters(raw: bytes, begin: int, end: int) -> tuple[int, int]:
    """The span without the bytes at its ends that belong to a character which is not all inside."""
    while begin < end and raw[begin] & 0xC0 == 0x80:
        begin += 1
    while end > begin and end < len(raw) and raw[end] & 0xC0 == 0x80:
        end -= 1
    return begin, end


def spans_of(marks: list[dict] | None, depth: int) -> list[list[int]]:
    """Maximal spans of bytes that the marked runs of passages cover."""
    out: list[list[int]] = []
    for begin, end in sorted((m["start"], m["start"] + m["count"] - 1 + depth) for m in marks or []):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


def without(raw: bytes, spans: list) -> bytes:
    pieces, last = [], 0
    for begin, end in spans:
        pieces.append(raw[last:begin])
        last = end
    return b"".join([*pieces, raw[last:]])


def _cut(depth: int):  # noqa: ANN202
    """(doc, n_bytes, n_removed, n_spans, kept bytes) from documents with their marked runs of starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(t.encode() if t else b"", spans_of(m, depth)) for t, m in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            columns = [[len(raw) for raw, _ in rows], [sum(e - b for b, e in s) for _, s in rows], [len(s) for _, s in rows]]
            kept = [without(raw, s) for raw, s in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in columns], pa.array(kept, pa.binary())], ["doc", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(doc, hash, text), and whether ids are unique: the hash of the text tells rows of one id apart, and is 0 where ids are unique."""
    rows = docs.select(docs[id_col].cast("bigint").alias("doc"), docs[text_col].cast("string").alias("text"))
    found = rows.groupBy("doc").agg(F.count("*").alias("n")).agg(F.max("n").alias("n"), F.max(F.col("doc").isNull()).alias("null")).first()
    plain = found["n"] in (None, 1) and not found["null"]
    return rows.select("doc", (F.lit(0).cast("bigint") if plain else F.coalesce(F.xxhash64("text"), F.lit(1))).alias("hash"), "text"), plain


def null_safe(a: DataFrame, b: DataFrame) -> Column:
    return a["doc"].eqNullSafe(b["doc"]) & (a["hash"] == b["hash"])


def marks_of(rows: DataFrame, unique: bool, depth: int = DEPTH, gram: int = GRAM, chunk: int = CHUNK, block: int = BLOCK, heavy: int = HEAVY_RUNS, local_hot: int = LOCAL_HOT) -> DataFrame:
    """(doc, hash, marks) of the documents (doc, hash, text) that lose something; marks are runs of passages that repeat."""
    if not 8 <= gram <= depth < gram + 255:
        raise ValueError("a run's offset and number of starts have eight bits each: depth has to be from gram to gram + 254")
    small_batches(rows.sparkSession)
    distinct = rows if unique else rows.dropDuplicates(["doc", "hash"])
    runs = distinct.mapInArrow(tidy(_runs(depth, gram, chunk, local_hot)), "g bigint, u bigint, w bigint, doc bigint, hash bigint, pack bigint, kind tinyint")
    dealt = F.when(F.col("kind") == MARK, F.xxhash64("doc", "hash", "pack")).when(F.col("kind") == SPREAD, F.xxhash64("g", "u")).otherwise(F.col("g"))
    ordered = runs.repartition(dealt).sortWithinPartitions("g", "u", "w", "doc", "hash", "pack")
    replies = written(ordered.mapInArrow(tidy(_replies(heavy)), "g bigint, doc bigint, hash bigint, pack bigint, kind tinyint"))
    levels = replies.filter(F.col("kind") == HEAVY).groupBy("g").agg(F.max("pack").alias("n")).select("g", F.when(F.col("n") > 16 * heavy, 2).otherwise(1).alias("level"))
    if levels.count() <= 500_000:  # two numbers a row
        levels = F.broadcast(levels)
    checked = replies.filter(F.col("kind") == CHECK).join(levels, "g", "left").select("doc", "hash", F.struct("pack", "g", F.coalesce("level", F.lit(0)).alias("level")).alias("run"))
    of_doc = checked.groupBy("doc", "hash").agg(F.collect_list("run").alias("runs"))
    cut = distinct.join(of_doc, null_safe(distinct, of_doc)).select(distinct["doc"], distinct["hash"], distinct["text"], of_doc["runs"])
    pieces = written(cut.mapInArrow(tidy(_pieces(depth, gram, chunk)), "key bigint, doc bigint, hash bigint, start bigint, count bigint, offset bigint, body binary, single boolean"))
    known = pieces.filter("body is null").select("doc", "hash", "start", "count")
    whole = replies.filter(F.col("kind") == MARK).select("doc", "hash", F.shiftright("pack", 16).alias("start"), F.shiftright("pack", 8).bitwiseAND(F.lit(255).cast("bigint")).alias("count"))
    # single passages need no order: the first place of equal bytes stays, found by a minimum with partial aggregation
    singles = pieces.filter("body is not null and single")
    first = singles.groupBy("body").agg(F.min(F.struct(F.col("doc").isNotNull().alias("known"), "doc", "hash", "start")).alias("f")).select("f.doc", "f.hash", "f.start")
    later = singles.join(first, null_safe(singles, first) & (singles["start"] == first["start"]), "left_anti").select("doc", "hash", "start", "count")
    ordered = pieces.filter("body is not null and not single").drop("single").repartition("key").sortWithinPartitions("key")
    found = ordered.mapInArrow(tidy(_sorted_marks(depth, block)), "doc bigint, hash bigint, start bigint, count bigint")
    return whole.union(known).union(later).union(found).groupBy("doc", "hash").agg(F.collect_list(F.struct("start", "count")).alias("marks"))


def dedup(docs: DataFrame, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id, n_bytes, n_removed, n_spans and kept (binary) of every row."""
    rows, unique = _keyed(docs, id_col, text_col)
    marks = marks_of(rows, unique, depth, **options)
    joined = rows.join(marks, null_safe(rows, marks), "left").select(rows["doc"], rows["text"], marks["marks"])
    return joined.mapInArrow(tidy(_cut(depth)), "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary").withColumnRenamed("doc", id_col)


def cut_texts(docs: DataFrame, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = "n_chars", **options) -> DataFrame:
    """``docs`` with the marked passages cut out of the texts, and ``count_col``, if there, counted again.

    A cut goes only through whole characters: one whose bytes are not all removed stays as it is.
    """
    rows, unique = _keyed(docs, id_col, text_col)
    marks = marks_of(rows, unique, depth, **options).select(F.col("doc").alias("__doc"), F.col("hash").alias("__hash"), "marks")
    same = docs[id_col].cast("bigint").eqNullSafe(marks["__doc"])
    joined = docs.join(marks, same if unique else same & (F.coalesce(F.xxhash64(docs[text_col].cast("string")), F.lit(1)) == marks["__hash"]), "left")
    names = docs.columns
    at = names.index(text_col)
    picked = joined.select(*[docs[c] for c in names], marks["marks"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, found in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                if text and found:
                    raw = text.encode()
                    spans = [whole_characters(raw, b, e) for b, e in spans_of(found, depth)]
                    text = without(raw, [(b, e) for b, e in spans if e > b]).decode()
                texts.append(text)
            columns = list(batch.columns)[:-1]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    out = picked.mapInArrow(tidy(run), docs.schema)
    return out.withColumn(count_col, F.length(text_col).cast(docs.schema[count_col].dataType)) if count_col in names else out


def digests(deduped: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return deduped.select(id_col, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

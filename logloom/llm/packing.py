"""Token-id output: best-fit-decreasing packing of documents into rows of one width.

Documents of a task are packed in blocks of about ``block_tokens`` tokens. Texts longer than a row are split into full
rows and a rest, without loss. Pieces go, longest first, to the row with the least room that still holds them, found in
a segment tree over capacities. A packed row carries its ids (little-endian, padded to the width), the cumulative
segment lengths, where positions start anew, and which part of which document each segment is.

Defined results: null and empty texts have no segment; repeated rows are packed each; a null id stays null in
``doc_ids``; an empty table gives no rows; other columns are ignored. Which documents share a row depends on how the
input is split into tasks, since a shuffle of all ids only to make rows independent of it would cost more than it gives;
it is the same whenever a lost task runs again.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.llm.bpe import encoder, grouped
from logloom.llm.common import small_batches, tidy

WIDTH = 2048
BLOCK_TOKENS = 1 << 20
SCHEMA = "shard string, row int, n_tokens int, input_ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<bigint>, doc_offsets array<bigint>"


class Capacities:
    """Segment tree over capacities: counts the rows that have each room left, and finds the least room that suffices."""

    def __init__(self, width: int) -> None:
        self.size = 1 << width.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        i = room + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of the fullest row with at least ``need`` left."""
        i = need + self.size
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.size
        while i:
            self.count[i] -= 1
            i >>= 1
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], width: int) -> list[list[int]]:
    """Rows of pieces (by number); every length is from 1 to ``width``."""
    rows: list[list[int]] = []
    open_rows = Capacities(width)
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        room, row = open_rows.take(lengths[i]) or (width, len(rows))
        if row == len(rows):
            rows.append([])
        rows[row].append(i)
        if room > lengths[i]:
            open_rows.add(room - lengths[i], row)
    return rows


def pack_block(shard: str, docs: list[tuple[int | None, np.ndarray]], width: int, pad: int) -> pa.RecordBatch:
    pieces = [(doc, at, ids[at : at + width]) for doc, ids in docs for at in range(0, len(ids), width)]
    out: dict[str, list] = {f.split(" ")[0]: [] for f in SCHEMA.split(", ")}
    for k, row in enumerate(best_fit([len(p[2]) for p in pieces], width)):
        ends = np.cumsum([len(pieces[i][2]) for i in row])
        ids = np.full(width, pad, dtype="<u4")
        ids[: ends[-1]] = np.concatenate([pieces[i][2] for i in row])
        out["shard"].append(shard)
        out["row"].append(k)
        out["n_tokens"].append(int(ends[-1]))
        out["input_ids"].append(ids.tobytes())
        out["cu_seqlens"].append([0, *ends.tolist()])
        out["position_resets"].append([0, *ends[:-1].tolist()])
        out["doc_ids"].append([pieces[i][0] for i in row])
        out["doc_offsets"].append([pieces[i][1] for i in row])
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))


def pack(docs: DataFrame, path: str, width: int = WIDTH, end: str | None = "<|endoftext|>", pad: int = 0, block_tokens: int = BLOCK_TOKENS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packed rows of all documents, each ended by the token ``end`` (none: no token); narrow, no shuffle."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        last = np.array([enc.merges.specials[end]] if end else [], dtype="<u4")
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        block: list[tuple[int | None, np.ndarray]] = []
        size = number = 0
        for batch in grouped(batches):
            ids, ends = enc.encode_batch(batch.column(1))
            for k, doc in enumerate(batch.column(0).to_pylist()):
                if ends[k] == ends[k + 1]:
                    continue
                block.append((doc, np.concatenate([ids[ends[k] : ends[k + 1]], last])))
                size += len(block[-1][1])
                if size >= block_tokens:
                    yield pack_block(f"{part:06d}-{number:06d}", block, width, pad)
                    block, size, number = [], 0, number + 1
        if block:
            yield pack_block(f"{part:06d}-{number:06d}", block, width, pad)

    return docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(tidy(run), SCHEMA)


def positions(packed: DataFrame) -> DataFrame:
    """``packed`` with ``position_ids``: from 0 on in every segment."""
    each = F.transform(F.col("position_resets"), lambda p, i: F.sequence(F.lit(0), F.element_at("cu_seqlens", (i + 2).cast("int")) - p - 1))
    return packed.withColumn("position_ids", F.flatten(each))


#: The files of a shard: the id matrix, the cumulative segment lengths and the position resets, each row after row.
PARTS = ("input_ids", "cu_seqlens", "position_resets")
MANIFEST = "shard string, rows bigint, width int, tokens bigint, segments bigint, input_ids string, cu_seqlens string, position_resets string, sha256 string"


def write_binary(packed: DataFrame, folder: str, width: int = WIDTH) -> DataFrame:
    """Write packed rows as raw little-endian files under ``folder``, a place that all executors reach; return the manifest.

    Every task writes three files: 32-bit unsigned ids (rows x width, which maps to memory as one matrix), 32-bit cumulative
    lengths and 32-bit resets. Cumulative lengths of a row begin with 0, so a row with n segments has n + 1 of them and
    n resets. A file has a name of its own task attempt, and only attempts that Spark commits are in ``folder``/manifest,
    so repeated and lost attempts do no harm. The matrix is never held as a whole: rows go out as they come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        context = TaskContext.get()
        name = f"{context.partitionId() if context else 0:06d}-{uuid.uuid4().hex}"
        files = [f"{name}.{p}.bin" for p in PARTS]
        out = [store.open_output_stream(f"{path}/{f}") for f in files]
        digest, rows, tokens, segments = hashlib.sha256(), 0, 0, 0
        for batch in batches:
            for k in range(batch.num_rows):
                ids = batch.column(1)[k].as_py()
                ends = np.array(batch.column(2)[k].as_py(), dtype="<u4")
                for stream, raw in zip(out, (ids, ends.tobytes(), ends[:-1].tobytes()), strict=True):
                    stream.write(raw)
                digest.update(ids)
                rows, tokens, segments = rows + 1, tokens + int(ends[-1]), segments + len(ends) - 1
        for stream in out:
            stream.close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([rows]), pa.array([width], pa.int32()), pa.array([tokens]), pa.array([segments]), *[pa.array([f]) for f in files], pa.array([digest.hexdigest()])], [c.split(" ")[0] for c in MANIFEST.split(", ")])
        else:
            for f in files:
                store.delete_file(f"{path}/{f}")

    manifest = f"{folder}/manifest"
    packed.select("shard", "input_ids", "cu_seqlens").mapInArrow(tidy(run), MANIFEST).write.mode("overwrite").parquet(manifest)
    return packed.sparkSession.read.parquet(manifest)


def filled_share(packed: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row: packed rows, tokens, and which share of all places the tokens fill."""
    return packed.agg(F.count("*").alias("rows"), F.sum("n_tokens").alias("tokens"), (F.sum("n_tokens") / (F.count("*") * width)).alias("filled"))


def unpack(packed: DataFrame) -> DataFrame:
    """(doc_id, ids): the token ids of every document again, in order; one group per document."""
    each = packed.select("input_ids", F.explode(F.arrays_zip(F.col("doc_ids").alias("doc"), F.col("doc_offsets").alias("at"), F.col("position_resets").alias("b"), F.slice("cu_seqlens", 2, F.size("doc_ids")).alias("e"))).alias("s"))
    piece = F.substring("input_ids", 4 * F.col("s.b") + 1, 4 * (F.col("s.e") - F.col("s.b")))
    parts = each.select(F.col("s.doc").alias("doc_id"), F.struct(F.col("s.at").alias("at"), F.hex(piece).alias("ids")).alias("p"))
    return parts.groupBy("doc_id").agg(F.unhex(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["ids"]), "")).alias("ids"))

"""The pipeline's rows, through ``run``, against brute force over every stage."""

import hashlib
import random
import struct

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from logloom.llm import decontaminate
from tests.llm.test_llm import brute_near_copies, brute_repeats

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, fp bigint, spans int"


def prose(rng, n):
    return " ".join("".join(rng.choices("abdeilmnorstu", k=rng.randrange(3, 9))) for _ in range(n))


def planted():
    """(documents, labels, benchmark items, ids of toxic documents)."""
    rng = random.Random(31)
    passage, items = prose(rng, 30), [prose(rng, 14), prose(rng, 25), prose(rng, 6)]
    rows, labels, toxic = [], [], []
    for i in range(60):
        bad = i % 2
        words = prose(rng, 24).split()
        if bad:
            toxic.append(i)
            for at in range(0, 24, 3):
                words[at] = rng.choice(["grubnak", "zorfidling", "vexmuck"])
        rows.append((i, " ".join(words)))
        labels.append((i, 0, bad))
    base = [prose(rng, 90) for _ in range(8)]
    rows += [(100 + k, t) for k, t in enumerate(base)]
    rows += [(120 + k, " ".join([*t.split()[:40], "other", *t.split()[41:]])) for k, t in enumerate(base[:4])]  # near copies
    rows += [(130, base[7]), (131, base[7])]  # copies
    rows += [(140, f"{prose(rng, 40)} {passage} {prose(rng, 20)}"), (141, f"{prose(rng, 50)} {passage} {prose(rng, 10)}"), (142, f"{passage} {passage}")]  # shared passages
    rows += [(150, f"{prose(rng, 40)} {items[0]} {prose(rng, 9)}"), (151, f"{items[1]} {prose(rng, 3)}"), (152, f"{prose(rng, 30)}, {items[2]}. {items[0][:60]}"), (153, items[2].upper() + " " + prose(rng, 12))]  # benchmark
    rows += [(160, None), (161, ""), (162, " \n "), (None, prose(rng, 15)), (170, base[5] + " "), (180, "one two"), (180, "one two")]
    return rows, labels, [(k, t) for k, t in enumerate(items)] + [(9, None)], set(toxic)


def brute(rows, items, toxic):
    """{doc_id: (n_tokens, digests)} of what is left."""
    rows = [r for r in dict.fromkeys(rows) if r[0] not in toxic]
    known = [(i, t or "") for i, t in rows if i is not None]
    stay = set(brute_near_copies(known))
    rows = [r for r in rows if r[0] is None or r[0] in stay]
    removed = {}
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: r[0])
    seen = set()
    for i, t in order:
        raw = (t or "").encode()
        marks = [False] * len(raw)
        for at in range(len(raw) - 99):
            if raw[at : at + 100] in seen:
                marks[at : at + 100] = [True] * 100
            seen.add(raw[at : at + 100])
        removed[i] = bytes(c for c, gone in zip(raw, marks, strict=True) if not gone).decode()
    rows = [(i, removed[i] if i is not None else t) for i, t in rows]
    rows = [(i, t) for i, t in rows if t]
    left = []
    windows = set()
    for _, t in items:
        words = decontaminate.words_of(t)
        width = min(10, len(words))
        windows |= {tuple(words[k : k + width]) for k in range(len(words) - width + 1) if width}
    for i, t in rows:
        words = decontaminate.words_of(t)
        hit = [False] * len(words)
        for w in windows:
            for k in range(len(words) - len(w) + 1):
                if tuple(words[k : k + len(w)]) == w:
                    hit[k : k + len(w)] = [True] * len(w)
        if sum(hit) > 0.5 * len(words):
            continue
        ends = [k for k in range(len(hit) + 1) if (k < len(hit) and hit[k]) != (k > 0 and hit[k - 1])]
        left.append((i, decontaminate.cut(t, list(zip(ends[::2], ends[1::2], strict=True)))))
    codec = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    codec.no_truncation()
    codec.no_padding()
    out = {}
    for i, t in left:
        ids = codec.encode(t, add_special_tokens=False).ids
        out[i] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(codec.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    return out


@pytest.fixture
def folder(spark, tmp_path):
    rows, labels, items, toxic = planted()
    docs = spark.createDataFrame([(i, t, "en", "web", None if t is None else len(t), "clash", 1, 2) for i, t in rows], DOCS)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_run_gives_the_rows_of_brute_force(spark, folder):
    rows, _, items, toxic = planted()
    want = brute(rows, items, toxic)
    assert len({i for i, _ in rows} - set(want)) > 40 and not {151, 130, 160, 161} & set(want) and {140, 141, 150, 152, None} <= set(want)
    got = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == want and len(got) == len(want)


def test_empty_tables_run_to_an_empty_result(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_every_stage_keeps_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").filter(F.col("doc_id") < 130)
    for name, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, folder).columns == docs.columns, name

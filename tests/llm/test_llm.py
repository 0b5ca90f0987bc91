"""Small tests of the numbered operators: against libraries, brute force, round trips and held-out accuracy."""

import hashlib
import itertools
import random
import re
import struct
import sys

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logloom.llm import bpe, decontaminate, langid, maxscore, packing, simhash, subwords, suffix_dedup, suffix_order, token_count, toxicity, url_filter
from logloom.llm.common import checkpointed
from logloom.llm.components import components
from logloom.llm.queries import ORACLE, QUERIES
from tests.oracle import assert_same, connect

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = [None, "", " ", "\n", "a", "  a\t\nb ", "İSTANBUL ΑΣ ß", "漢字 かな 🙂", "<|endoftext|>x<|startoftext|>", "<|", "'LL we've don't", "½ ٣ Ⅷ 12345", "a" * 700, "ab" * 3000, "e\u0301\u0300", "\x1c\x85\xa0\u2003x", "-" * 300 + " " * 300]
SCHEMA = "doc_id bigint, text string"


def frame(spark, texts, extra=True):
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    return df.withColumn("id", F.lit("clash")).withColumn("n_tokens", F.lit(0)).withColumn("marks", F.lit(1)) if extra else df


def by_id(df, *names):
    return {r["doc_id"]: tuple(r[n] for n in names) for r in df.collect()}


@pytest.fixture(scope="module")
def texts(spark, sf):
    return [r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()] + ODD


# 1


def test_url_rules_and_defined_cases(spark):
    urls = [None, "nope", "://", "http://A.ORG", "HTTP://x.ORG/a?b", "a://org/", "x://sub.example.org/en/12#f", "x://\u00c9.com/fr/://y", "x://" + "a" * 30000 + ".com/de/", "x://notorg/", "x://example.org/es/x", "x://EXAMPLE.org/es"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string").withColumn("host", F.lit("clash"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in url_filter.judge(df, [0.0] * 9).collect()}
    assert [got[i] for i in range(8)] == [("", "", None), ("", "", None), ("", "", None), ("a.org", "", None), ("x.org", "/a", "org/"), ("org", "/", "org/"), ("sub.example.org", "/en/12", "example.org/en/1"), ("\u00c9.com", "/fr/://y", "com/fr/")]
    assert got[8][2] == "com/de/" and got[9][2] is None and got[10][2] == "example.org/es/" and got[11][2] == "org/"


def test_url_classifier_learns_its_labels_natively(spark):
    labels = url_filter.default_labels(spark)
    judged = url_filter.judge(labels.withColumn("page_id", F.col("label")), url_filter.fit(labels), rules=())
    assert "Python" not in judged._jdf.queryExecution().toString() and "Arrow" not in judged._jdf.queryExecution().toString()
    rows = judged.collect()
    assert np.mean([(r["verdict"] == "block") == bool(r["page_id"]) for r in rows]) > 0.95
    assert url_filter.fit(labels.limit(0)) == [0.0] * 2049


def test_url_classifier_on_hosts_it_has_not_seen(spark):
    """A third of the labelled hosts at a time is left out of training."""
    rows = url_filter.labelled_urls()
    right = total = 0
    for fold in range(3):
        seen = [r for i, r in enumerate(rows) if i % 3 != fold]
        held = spark.createDataFrame([(k, *r) for k, r in enumerate(r for i, r in enumerate(rows) if i % 3 == fold)], "page_id int, url string, label int")
        weights = url_filter.fit(spark.createDataFrame(seen, "url string, label int"))
        for r in url_filter.judge(held, weights, rules=()).join(held.select("page_id", "label"), "page_id").collect():
            right += (r["verdict"] == "block") == bool(r["label"])
            total += 1
    assert total == len(rows) and right / total >= 0.75  # 0.78 when written: words of a host that no seen one shares tell nothing


def test_url_classifier_finds_the_spam_hosts_among_pages(spark):
    """By host kind: no host of the pages is in the labelled table, though its everyday words are."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    spam = F.col("host").rlike("casino-win|cheap-pills|free-bets|spam-farm|adult-x|ads-track")
    judged = QUERIES["op1_url_filter"](spark, "/root/testdata/sf0.01").filter("rule is null").withColumn("spam", spam)
    got = {r["spam"]: (r["n"], r["blocked"]) for r in judged.groupBy("spam").agg(F.count("*").alias("n"), F.count_if(F.col("verdict") == "block").alias("blocked")).collect()}
    listed = {u.split("//")[1].split("/")[0] for u, _ in url_filter.labelled_urls()}
    assert not listed & {r[0] for r in pages.select(url_filter.parts(F.col("url"))[0]).distinct().collect()}
    assert got[True][1] >= 0.9 * got[True][0] > 0 and got[False][1] <= 0.02 * got[False][0]


def test_url_repeated_rows_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "http://a.org/x", 2.5)] * 3 + [(None, None, 0.0)], "page_id int, url string, score double").withColumn("g", F.lit(1)).withColumn("m", F.lit(1))
    rows = url_filter.judge(df, [0.0] * 9).collect()
    assert len(rows) == 4 and len({tuple(r) for r in rows}) == 2 and url_filter.judge(df.limit(0), [0.0] * 9).count() == 0


def test_url_parts_and_rules_equal_sql(spark, sf):
    sql = r"""
    WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
    p AS (SELECT page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
    rules(name, prefix, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
    hit AS (SELECT page_id, name || prefix AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(name) + length(prefix) DESC) AS r
            FROM p JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, prefix))
    SELECT p.page_id, host, path, rule, hit.verdict AS ruled FROM p LEFT JOIN hit ON p.page_id = hit.page_id AND r = 1
    """
    judged = QUERIES["op1_url_filter"](spark, sf)
    ruled = F.when(F.col("rule").isNotNull(), F.col("verdict"))
    assert_same(judged.select("page_id", "host", "path", "rule", ruled.alias("ruled")), connect(sf), sql)


# 2, 3


def test_token_counts_equal_the_library(spark, texts):
    library = Tokenizer.from_file(WORD)
    got = by_id(token_count.count_tokens(frame(spark, texts), WORD, limit=300), "n_bytes", "n_tokens", "over_limit")
    for i, t in enumerate(texts):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert got[i] == (len((t or "").encode()), n, n > 300), repr(t)[:80]


def test_encoding_and_decoding_equal_the_library(spark, texts):
    library = Tokenizer.from_file(BYTE)
    got = by_id(bpe.encode_decode(frame(spark, texts), BYTE), "n_tokens", "ids_sha256", "decoded_sha256")
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()), repr(t)[:80]
    back = by_id(bpe.decode(bpe.encode(frame(spark, texts), BYTE), BYTE), "text")
    assert all(back[i] == (t or "",) for i, t in enumerate(texts))


def test_random_texts_equal_the_library():
    r = random.Random(3)
    parts = [" ", "  ", " \n", "\n ", "\n", "\t", "\x1c", "\u3000", "a", "B", "é", "Σ", "ß", "'s", "'ve", "123", "漢", "<|endoftext|>", "aaaa", "the", "there", "x" * 130, "ﬁ", "..."]
    enc, counter, b, w = bpe.Encoder(BYTE), token_count.Counter(WORD), Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
    made = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(400)]
    batches = [enc.encode_batch(pa.array(made[k : k + 50])) for k in range(0, 400, 50)]
    for t, ids in zip(made, [x[i:j].tobytes() for x, ends in batches for i, j in itertools.pairwise(ends)], strict=True):
        assert ids == enc.encode(t)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == b.encode(t, add_special_tokens=False).ids
        assert counter.count([t]) == [len(w.encode(t, add_special_tokens=False).ids)]


# 4, 10


def test_toxicity_generalises_to_held_out_misspellings(spark):
    r = random.Random(1)
    plain = ["".join(r.choice("aeioulmnrst") for _ in range(r.randint(3, 8))) for _ in range(300)]
    stem = lambda: "grumsk" + r.choice(plain)[:2]
    rows = []
    for i in range(800):
        words = [r.choice(plain) for _ in range(r.randint(20, 200))]
        if i % 4 == 0:
            for _ in range(2):
                words[r.randrange(len(words))] = stem()
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(docs, docs.filter("doc_id < 600").select("doc_id", "toxic"))
    scored = toxicity.score(docs, model).join(docs.select("doc_id", "toxic"), "doc_id").filter("doc_id >= 600").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in scored]) > 0.9
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    odd = by_id(toxicity.score(frame(spark, ODD), model), "score", "predicted")
    assert all(0 <= s <= 1 and p == int(s >= 0.5) for s, p in odd.values()) and len(odd) == len(ODD)
    empty = toxicity.fit(docs.limit(0), docs.select("doc_id", "toxic").limit(0))
    assert set(by_id(toxicity.score(docs.limit(3), empty), "predicted").values()) == {(0,)}


def test_languages_of_the_held_out_fold(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    model = langid.fit(docs.filter(fold != 2))
    held = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(fold == 2).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.9
    odd = by_id(langid.identify(frame(spark, ODD), model), "lang_pred", "score")
    for i, t in enumerate(ODD):
        assert (odd[i] == ("und", 0.0)) == (not t or not any(map(str.isalpha, t)))
    assert set(by_id(langid.identify(docs.limit(2), langid.fit(docs.limit(0))), "lang_pred").values()) == {("und",)}


def test_a_language_beyond_the_64_most_frequent_is_learnt(spark):
    r = random.Random(7)
    word = lambda k: "".join(chr(0x4E00 + 40 * k + r.randrange(30)) for _ in range(4))
    rows = [(100 * k + i, " ".join(word(k) for _ in range(30)), f"l{k:02}") for k in range(70) for i in range(8 if k < 64 else 6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = langid.identify(docs, langid.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert {x["lang_pred"] for x in got} == {x[2] for x in rows}
    assert np.mean([x["lang_pred"] == x["lang"] for x in got if x["lang"] >= "l64"]) > 0.9


def test_slices_of_a_long_text_count_as_the_whole(monkeypatch):
    texts = ["the cat sat on the mat " * 9, "x"]
    whole = langid.counts(texts)
    monkeypatch.setattr(langid, "GROUP", 7)
    assert np.array_equal(langid.counts(texts), whole)


def test_a_null_id_is_not_held_out(spark, tmp_path):
    rows = [(None, "some words here and there", "en", "s", 5), (1, "other words", "en", "s", 3)] * 6
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars int").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("op4_toxicity", "op10_language_id"):
        found = QUERIES[name](spark, str(tmp_path)).select("doc_id", "held_out").collect()
        assert len(found) == 12 and all(r["held_out"] is False for r in found if r["doc_id"] is None)


def test_subword_hashes_do_not_depend_on_neighbours():
    alone = {w: sorted(subwords.hashed([w], (3, 4, 5), 1 << 16)[1].tolist()) for w in (b"a", b"tea", "h\u00e9llo".encode())}
    owner, bucket = subwords.hashed(list(alone), (3, 4, 5), 1 << 16)
    assert [sorted(bucket[owner == i].tolist()) for i in range(3)] == list(alone.values())


# 5


def test_decontamination_equals_brute_force(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    more = spark.createDataFrame([(900, "the of"), (901, ""), (902, None), (None, "x y"), (900, "the of")], items.schema)
    items = items.unionByName(more)
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for r in items.filter("item_id is not null").collect():
        words = cut(r["text"])
        k = min(10, len(words))
        for j in range(len(words) - k + 1 if k else 0):
            windows.setdefault(tuple(words[j : j + k]), set()).add(str(r["item_id"]))
    sizes = {len(w) for w in windows}
    want = {}
    for r in docs.collect():
        words, hit, found = cut(r["text"]), set(), set()
        for k in sizes:
            for j in range(len(words) - k + 1):
                if tuple(words[j : j + k]) in windows:
                    hit |= set(range(j, j + k))
                    found |= windows[tuple(words[j : j + k])]
        want[r["doc_id"]] = (len(words), len(hit), len(found), decontaminate.digest(list(found)), bool(hit))
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert by_id(decontaminate.contamination(decontaminate.scan(docs, items)), *names) == want
    assert by_id(decontaminate.contamination(decontaminate.scan(docs, items, block_words=500)), *names) == want


def test_decontamination_cuts_words_and_keeps_the_rest(spark):
    docs = spark.createDataFrame([(1, "x A-b, c! y", 5), (2, None, 0), (3, "a b", 1)], "doc_id int, text string, spans int")
    items = spark.createDataFrame([(1, "a b c"), (2, "a b c")], "item_id int, text string")
    got = decontaminate.remove(docs, items, window=3, max_coverage=0.6)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == [(1, "x ! y", 5), (2, None, 0), (3, "a b", 1)]
    assert decontaminate.remove(docs, items.limit(0)).count() == 3 and decontaminate.scan(docs.limit(0), items).count() == 0


# 6


def brute_clusters(rows, size=4, bits=4):
    prints = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        h = [xxhash.xxh64_intdigest(" ".join(w[j : j + size]).encode(), seed=42) for j in range(max(1, len(w) - size + 1))] if w else []
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    f = np.array(prints, dtype=np.uint64)
    forest = simhash.Forest(len(f))
    for i in range(len(f)):
        near = np.flatnonzero(np.bitwise_count(f[i] ^ f[i + 1 :]) <= bits) + i + 1
        forest.links(np.full(len(near), i), near)
    root = [forest.root(i) for i in range(len(f))]
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root[i]] = min(least.get(root[i], d), d)
    return {(d, format(int(f[i]), "016x"), least[root[i]]) for i, (d, _) in enumerate(rows)}


def test_simhash_clusters_equal_brute_force(spark, texts):
    rows = [*enumerate(texts), (len(texts), texts[0]), (len(texts) + 1, texts[0] + " one")]
    got = {tuple(r) for r in simhash.cluster(spark.createDataFrame(rows, SCHEMA).withColumn("fp", F.lit(1))).collect()}
    assert got == brute_clusters(rows)
    assert simhash.cluster(spark.createDataFrame([], SCHEMA)).count() == 0


def test_links_survive_tiles_and_block_choices(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 32)
    r = random.Random(2)
    fps = set()
    for base in (r.getrandbits(64) for _ in range(3)):
        for _ in range(150):
            x = base
            for _ in range(r.randint(0, 8)):
                x ^= 1 << r.randrange(64)
            fps.add(x)
    f = np.array(sorted(fps), dtype=np.uint64)
    forest = simhash.Forest(len(f))
    for i in range(len(f)):
        near = np.flatnonzero(np.bitwise_count(f[i] ^ f[i + 1 :]) <= 4) + i + 1
        forest.links(np.full(len(near), i), near)
    signed = f.view(np.int64).tolist()
    want = {frozenset(s for j, s in enumerate(signed) if forest.root(j) == k) for k in {forest.root(i) for i in range(len(f))}}
    found = {r["node"]: r["component"] for r in components(simhash.link(spark.createDataFrame([(x,) for x in signed], "fp bigint"))).collect()}
    assert {frozenset(s for s in signed if found.get(s, s) == c) for c in {found.get(s, s) for s in signed}} == want


def test_near_copies_go_and_others_stay(spark, texts):
    long = [t for t in texts if t and len(t.split()) > 120][:20]
    near = [" ".join([*t.split()[:50], "changed", *t.split()[51:]]) for t in long]
    rows = [*enumerate(long), *((100 + i, t) for i, t in enumerate(near)), (200, None), (201, ""), (None, "x"), (None, "x")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("fp", F.lit(0))
    kept = simhash.keep_one(docs)
    ids = sorted(r["doc_id"] for r in kept.filter("doc_id is not null").collect())
    assert kept.columns == docs.columns and kept.filter("doc_id is null").count() == 2
    assert {i for i in ids if i < 100} == {r[2] for r in brute_clusters(rows[:20], 5, 0)} and len([i for i in ids if 100 <= i < 200]) <= 2 and 200 in ids and 201 not in ids


def brute_near_copies(rows, size=5, similarity=0.8):
    """The smallest id of each component of all pairs with that Jaccard similarity."""
    sets = [{tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} for w in (t.split() for _, t in rows)]
    forest = simhash.Forest(len(rows))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= similarity * len(a | sets[j]):
                forest.links(np.array([i]), np.array([j]))
    return sorted({min(rows[j][0] for j in range(len(rows)) if forest.root(j) == forest.root(i)) for i in range(len(rows))})


def with_filler(filler, count=40):
    """Prose of its own, a run of one word, and a copy of each with another word in it."""
    r = random.Random(8)
    rows = []
    for i in range(count):
        prose = [f"w{r.randrange(10**6)}" for _ in range(70)]
        rows += [(i, " ".join(prose + ["x"] * filler)), (1000 + i, " ".join(prose[:30] + ["other"] + prose[31:] + ["x"] * filler))]
    return rows


def test_a_refused_link_takes_no_other_pair_with_it(spark):
    rows = with_filler(16)
    kept = simhash.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r["doc_id"] for r in kept.collect()) == brute_near_copies(rows) == list(range(40))


def test_equal_fingerprints_of_other_texts_stay(spark):
    rows = with_filler(200)
    assert len({simhash.fingerprint(simhash.words_of(t), 5) for _, t in rows}) == 1
    kept = simhash.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r["doc_id"] for r in kept.collect()) == brute_near_copies(rows) == list(range(40))


@pytest.mark.parametrize("tile", [8, 2048])
def test_near_copies_equal_brute_force_from_the_threshold_up(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    r = random.Random(9)
    line, rows = [f"l{k}" for k in range(12)], []
    for i in range(60):
        prose = [f"w{r.randrange(10**6)}" for _ in range(r.randint(40, 90))] + line
        for k in range(4):  # similarities on both sides of 0.8
            words = list(prose)
            for at in r.sample(range(len(prose)), k):
                words[at] = f"n{i}.{k}.{at}"
            rows.append((4 * i + k if i % 2 else 4 * i + 3 - k, " ".join(words)))
    want = brute_near_copies(rows)
    assert 60 < len(want) < 200
    assert sorted(x["doc_id"] for x in simhash.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()) == want


def family(count, seed=12):
    """(id, text): copies of one text, each with words of its own in up to 3 of 200 places; similarities on both sides of 0.8."""
    r = random.Random(seed)
    prose = [f"w{r.randrange(10**6)}" for _ in range(200)]
    rows = []
    for k in range(count):
        words = list(prose)
        for at in r.sample(range(200), r.randint(1, 3) if k % 9 else 7):
            words[at] = f"n{k}.{at}"
        rows.append((k, " ".join(words)))
    return rows


@pytest.mark.parametrize("tile,tile_bytes", [(2048, 1 << 22), (16, 1 << 22), (2048, 20_000)])
def test_a_group_of_near_copies_gives_no_more_links_than_its_size(spark, monkeypatch, tile, tile_bytes):
    monkeypatch.setattr(simhash, "TILE", tile)
    monkeypatch.setattr(simhash, "TILE_BYTES", tile_bytes, raising=False)
    rows = family(90)
    texts = spark.createDataFrame(rows, SCHEMA)
    sets = simhash.shingle_sets(texts, 5, "doc_id", "text").select(F.col("id").alias("node"), F.col("id").alias("component"), "shingles").cache()
    links = simhash.sharing(sets, 0.8, np.zeros(0, np.uint32))
    tasks, tiles = spark.sparkContext.defaultParallelism, 1 if tile > 90 else -(-90 // tile)
    assert 0 < links.count() < tasks * 90 < 90 * 89 // 2 / 4
    edges = simhash.proven(links, sets.select("node", "shingles"), 0.8)
    assert 0 < edges.count() < 90 * (tiles if tile_bytes > 20_000 else 10)
    shingles = {r["node"]: set(np.frombuffer(r["shingles"], np.uint32).tolist()) for r in sets.collect()}
    assert all(len(shingles[u] & shingles[v]) >= 0.8 * len(shingles[u] | shingles[v]) for u, v in edges.collect())
    near = {r["node"]: r["component"] for r in components(edges).collect()}
    want = brute_near_copies(rows)
    assert sorted({min(k for k in range(90) if near.get(k, k) == c) for c in {near.get(k, k) for k in range(90)}}) == want and 1 < len(want) < 90


def test_the_driver_plans_components_in_small_steps_and_broadcasts_none(spark, monkeypatch):
    plans = []

    def held(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return checkpointed(df)

    monkeypatch.setattr(sys.modules["logloom.llm.components"], "checkpointed", held)
    chain = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (102, 101), (100, 100)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "u bigint, v bigint")).collect()}
    assert found == {k: 0 for k in range(41)} | {100: 100, 101: 100, 102: 100}
    assert max(p.count("Exchange") for p in plans) <= 6 and not any("Broadcast" in p for p in plans)


def test_gathered_labels_are_members_of_their_components(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(30)] + [(50, k) for k in range(51, 90)], "u bigint, v bigint")
    found = {r["node"]: r["component"] for r in simhash.gathered(edges).collect()}
    assert sorted(found) == [*range(31), *range(50, 90)]
    assert all(found[k] <= k for k in range(31)) and found[8] == 0 and {found[k] for k in range(50, 90)} == {50}


def test_sketches_are_no_farther_apart_than_the_sets():
    draw = np.random.default_rng(1)
    for _ in range(100):
        pool = np.unique(draw.integers(0, 2**32, draw.integers(2, 900), dtype=np.uint32))
        a, b = (pool[draw.random(len(pool)) < 0.8] for _ in range(2))
        x, y = (simhash.sketch(s).view(np.uint64) for s in (a, b))
        assert len(x) == simhash.WIDE and np.bitwise_count(x ^ y).sum() <= len(np.setxor1d(a, b))


# 7


def test_packing_is_lossless_and_best_fit(spark, texts):
    docs = frame(spark, texts)
    packed = packing.pack(docs, BYTE, width=64, block_tokens=5000)
    rows = packed.collect()
    assert all(r["cu_seqlens"][-1] == r["n_tokens"] <= 64 and len(r["input_ids"]) == 256 and r["position_resets"] == r["cu_seqlens"][:-1] for r in rows)
    ids = by_id(bpe.encode(docs, BYTE), "ids")
    want = {i: bytes(x[0]) + struct.pack("<I", 50256) for i, x in ids.items() if x[0]}
    assert {r["doc_id"]: bytes(r["ids"]) for r in packing.unpack(packed).collect()} == want
    assert packing.positions(packed).filter("size(position_ids) <> n_tokens").count() == 0
    assert packing.pack(docs.limit(0), BYTE).count() == 0
    assert packing.best_fit([5, 3, 6, 2, 4], 8) == [[2, 3], [0, 1], [4]]


def test_binary_files_hold_the_packed_rows(spark, texts, tmp_path):
    packed = packing.pack(frame(spark, texts).repartition(3, "doc_id"), BYTE, width=64, block_tokens=5000).persist()
    folder = f"file://{tmp_path}/packed"
    manifest = packing.write_binary(packed, folder, width=64).collect()
    got = []
    for m in manifest:
        ids, ends, resets = (np.fromfile(f"{tmp_path}/packed/{m[p]}", "<u4") for p in packing.PARTS)
        ids = ids.reshape(m["rows"], m["width"])
        assert hashlib.sha256(ids.tobytes()).hexdigest() == m["sha256"] and len(ends) == m["segments"] + m["rows"] and len(resets) == m["segments"]
        begin = np.flatnonzero(ends == 0)
        rows = np.split(ends, begin[1:])
        assert sum(r[-1] for r in rows) == m["tokens"] and [x for r in rows for x in r[:-1]] == resets.tolist()
        got += [(i.tobytes(), r.tolist()) for i, r in zip(ids, rows, strict=True)]
    assert sorted(got) == sorted((bytes(r["input_ids"]), r["cu_seqlens"]) for r in packed.collect())
    assert packing.write_binary(packed.limit(0), f"{folder}-empty").count() == 0
    assert packing.filled_share(packed, 64).first()["filled"] > 0.97


def test_best_fit_equals_a_plain_search():
    r = random.Random(4)
    for count in (1, 40, 300):
        lengths = [r.randint(1, 50) for _ in range(count)]
        room: list[int] = []
        for i in sorted(range(count), key=lambda k: (-lengths[k], k)):
            least = min((x for x in room if x >= lengths[i]), default=None)
            if least is None:
                room.append(50)
                least = 50
            room[room.index(least)] -= lengths[i]
        rows = packing.best_fit(lengths, 50)
        assert sorted(i for row in rows for i in row) == list(range(count))
        assert sorted(50 - sum(lengths[i] for i in row) for row in rows) == sorted(room)  # the rooms left, whatever row of a room is taken


# 8


def brute_repeats(rows, depth=100):
    seen, out = set(), {}
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        b = (t or "").encode()
        m = bytearray(len(b))
        for k in range(len(b) - depth + 1):
            w = b[k : k + depth]
            if w in seen:
                m[k : k + depth] = b"\1" * depth
            seen.add(w)
        out[i] = (len(b), sum(m), sum(1 for k in range(len(b)) if m[k] and not (k and m[k - 1])), hashlib.sha256(bytes(x for x, y in zip(b, m, strict=True) if not y)).hexdigest())
    return out


def repeats(count=150):
    r = random.Random(5)
    w = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    shared = [w(r.randint(90, 400)) for _ in range(8)]
    rows = [(i, w(r.randint(0, 150)) + "".join(r.choice(shared)[r.randint(0, 60) :] + w(r.randint(0, 90)) for _ in range(r.randint(0, 4)))) for i in range(count)]
    odd = [None, "", "a" * 1000, "ab" * 600, "a" * 99, "a" * 100, rows[5][1], "é" * 300, ("abc" * 50 + "Q") * 8]
    return rows + [(count + i, t) for i, t in enumerate(odd)]


@pytest.mark.parametrize("limits", [{}, {"chunk": 3000, "block": 5000, "heavy": 3, "local_hot": 2}, {"chunk": 3000, "block": 3000, "heavy": 0, "local_hot": 1}])
def test_suffix_dedup_equals_brute_force(spark, limits):
    rows = repeats()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("hash", F.lit("clash"))
    got = by_id(suffix_dedup.digests(suffix_dedup.dedup(docs, **limits)), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute_repeats(rows)


def test_suffix_dedup_defined_cases(spark):
    docs = spark.createDataFrame([(1, "z" * 150), (1, "z" * 150), (None, "z" * 120), (2, "z" * 130), (2, "y" * 130)], SCHEMA)
    got = sorted(((r["doc_id"] or 0, r["n_removed"]) for r in suffix_dedup.dedup(docs).collect()))
    assert got[:3] == [(0, 119), (1, 150), (1, 150)] and {x for i, x in got if i == 2} == {129, 130}
    assert suffix_dedup.dedup(docs.limit(0)).count() == 0
    for depth in (20, 300):
        with pytest.raises(ValueError):
            suffix_dedup.dedup(docs, depth=depth)
    cut = suffix_dedup.cut_texts(spark.createDataFrame([(1, "é" * 120, 7), (2, "xé" + "é" * 119, 8)], "doc_id int, text string, n_chars int"))
    assert [(r["doc_id"], r["n_chars"], len(r["text"])) for r in cut.orderBy("doc_id").collect()] == [(1, 1, 1), (2, 1, 1)]


def test_suffix_order_settles_ties_of_any_residue():
    r = random.Random(6)
    text = np.frombuffer(("".join(r.choice("ab") for _ in range(50)) * 12 + "\0" * 400).encode(), dtype=np.uint8)
    starts = np.arange(400)
    order = suffix_order.suffix_order(text, starts, 100, np.zeros(400, dtype=np.int64))
    cut = [text[i : i + 100].tobytes() for i in order]
    assert cut == sorted(cut)
    held = set(suffix_order.cover())
    assert all(any((a + d) % 32 in held and (b + d) % 32 in held for d in range(32)) for a in range(32) for b in range(32))


# 9


def test_top_k_equals_brute_force(spark, monkeypatch):
    r = np.random.default_rng(1)
    rows = [(i, r.integers(-3, 4, 6).astype(float).tolist()) for i in range(300)]
    rows += [(900, None), (950, [float("nan")] * 6), (1000, [float("inf")] + [0.0] * 5), (1050, []), (1100, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1150, [1.0, 2.0]), (1200, [3.0, 1.0]), (None, [1.0] * 6), (250, [9.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("dim", F.lit(0))
    got = sorted(map(tuple, maxscore.top_k(df, df.filter("vec_id % 50 = 0")).collect()))
    good = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in good:
        if q % 50 == 0:
            pairs = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in good if i != q and len(w) == len(v)))[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(pairs)]
    one = [w for w in want if w[0] != 250]
    assert [g for g in got if g[0] != 250] == sorted(one)
    assert [g[1] for g in got if g[0] == 250] == [1, 2, 3, 4, 5]
    asked = df.filter("vec_id % 50 = 0 and vec_id <> 250")
    again = sorted(map(tuple, maxscore.top_k(df, asked.union(asked)).collect()))
    assert again == sorted(one)  # repeated queries have one answer
    monkeypatch.setattr(maxscore, "PASS", 1)
    monkeypatch.setattr(maxscore, "BLOCK", 2)
    monkeypatch.setattr(maxscore, "SHARD", 16)
    assert sorted(map(tuple, maxscore.top_k(df, asked).collect())) == sorted(one)
    assert maxscore.top_k(df.limit(0), df.limit(0)).count() == 0


# queries


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_gives_the_rows_of_its_sql(spark, sf, name):
    assert_same(QUERIES[name](spark, sf), connect(sf), ORACLE[name])


def test_query_columns(spark, sf):
    want = {
        "op1": ["page_id", "host", "path", "rule", "verdict"], "op2": ["doc_id", "n_bytes", "n_tokens", "over_limit"], "op3": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        "op4": ["doc_id", "held_out", "score", "predicted"], "op5": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"], "op6": ["doc_id", "fingerprint", "component_id"],
        "op8": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], "op9": ["query_id", "rank", "vec_id", "score"], "op10": ["doc_id", "held_out", "lang_pred", "score"],
    }
    documents = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name, query in QUERIES.items():
        df = query(spark, sf)
        if (key := name.split("_")[0]) in want:
            assert df.columns[: len(want[key])] == want[key]
        n = df.count()
        assert n == documents if df.columns[0] == "doc_id" else n > 0


# pipeline


def test_pipeline_stages_do_what_their_operators_decide(spark, sf):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES][0] == "toxicity" and len(p.STAGES) == 5
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    kept = docs
    for name, stage in p.STAGES[:4]:
        before = {r["doc_id"]: r["text"] for r in kept.collect()}
        after_df = stage(spark, kept, sf)
        assert after_df.columns == names, name
        after = {r["doc_id"]: r["text"] for r in after_df.collect()}
        assert set(after) <= set(before) and len(after) > 0.7 * len(before), name
        if name == "suffix_array_dedup":
            removed = brute_repeats(list(before.items()))
            assert all(len((after.get(i) or "").encode()) >= n - gone for i, (n, gone, _, _) in removed.items())
            assert all(after.get(i, "") == (t or "") for i, t in before.items() if not removed[i][1])
            assert all(abs(len((after.get(i) or "").encode()) - (n - gone)) <= 6 * (spans + 1) for i, (n, gone, spans, _) in removed.items())
        kept = spark.createDataFrame(after_df.collect(), docs.schema)
    assert p.run(spark, sf).count() > 0

"""Small tests of chat formatting, the prefix trie and ranked search: against SQL, brute force and exact round trips."""

import hashlib
import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from logloom.llm import chat_format, lexical, prefix_trie
from logloom.llm.queries import ORACLE, QUERIES
from tests.oracle import assert_same, connect

CHAT = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("name", ["op11_chat_format", "op12_prefix_trie", "op13_ranked_search"])
def test_rows_equal_the_sql(spark, sf, name):
    assert_same(QUERIES[name](spark, sf), connect(sf), ORACLE[name])


# 11


def test_template_round_trip_of_hostile_texts():
    t = chat_format.Template()
    marks = [t.begin, t.head, t.end, t.escape, *t.also, "<", "[", "/", "s", "\n", "é🙂", "", "<<s>", "\\<\\s>"]
    rng = random.Random(5)
    for _ in range(2000):
        turns = [("".join(rng.choices(marks, k=rng.randrange(4))), "".join(rng.choices(marks, k=rng.randrange(7)))) for _ in range(rng.randrange(4))]
        made = "".join(t.render(r, x)[0] for r, x in turns)
        assert [(r, x) for r, x, _, _ in t.read_back(made)] == turns
        for _, x in turns:
            assert not any(m in t.escaped(x) for m in (t.begin, t.end, *t.also))
    for bad in ({"escape": "<"}, {"head": ""}, {"end": "aba"}, {"also": ("x",)}, {"also": ("]x",)}):
        with pytest.raises(ValueError):
            chat_format.Template(**bad)


def plain_fold(events):
    """(message, kind, role, text) in order, to {message: (role, text)}."""
    held, roles = {}, {}
    for m, kind, role, text in events:
        if m is None or kind not in chat_format.KINDS:
            continue
        if role is not None:
            roles[m] = role
        if kind == "regenerate":
            held = {k: v for k, v in held.items() if k <= m}
        held[m] = held.get(m, "") + (text or "") if kind == "delta" else text or ""
    return {m: (roles.get(m, ""), x) for m, x in held.items()}


@pytest.mark.parametrize("hot", [10_000, 5, 0])
def test_log_of_edits_and_regenerations_folds_like_brute_force(spark, hot):
    rng = random.Random(11)
    rows, want = [], {}
    for conv in [None, 1, 2, 3, 4]:
        log = []
        for seq in range(rng.choice([3, 40, 200])):
            event = (rng.choice([*"abcdefgh", None]), rng.choices([*chat_format.KINDS, "noise", None], [3, 8, 2, 1, 1, 1])[0], rng.choice([None, None, "user", "assistant"]), rng.choice([None, "", "x ", "</s>", "é" * 50]))
            log.append(event)
            rows.append((conv, seq, *event, "clash"))
        want[conv] = plain_fold(log)
    df = spark.createDataFrame(rows, "conv bigint, seq int, message string, kind string, role string, text string, piece string").repartition(7)
    t = chat_format.Template()
    got = defaultdict(list)
    usual, long = chat_format.format_log(df, order=("seq",), hot_events=hot)
    for r in [*usual.collect(), *sorted(long.collect(), key=lambda r: r["part"])]:
        turns = t.read_back(r["formatted"])
        got[r["conv"]] += [(a, b) for a, b, _, _ in turns]
        assert [(s["begin"], s["end"]) for s in r["loss"]] == [(x, y) for role, _, x, y in turns if role == "assistant"]
    assert got == {c: [m[k] for k in sorted(m)] for c, m in want.items() if m}
    assert usual.count() == sum(hot > 100 or len([r for r in rows if r[0] == c and r[2] and r[3] in chat_format.KINDS]) <= hot for c in want)


def test_chat_defined_cases(spark):
    rows = [(1, None, "user", None), (1, 0, None, "b"), (1, 1, "assistant", ""), (1, 2, "assistant", "é🙂" * 2500), (None, 1, "user", "n"), (2, 1, "user", "same"), (2, 1, "user", "same"), (3, -5, "user", "first"), (3, 2, "user", "then")]
    df = spark.createDataFrame(rows, CHAT).withColumn("message", F.lit(1)).withColumn("conv", F.lit("x"))
    log = chat_format.replayed(df)
    got = {r["conv_id"]: r for r in chat_format.digests(chat_format.format_log(log)).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got[1]["turns_sha256"] == sha("user\n\n\nb\nassistant\n\nassistant\n" + "é🙂" * 2500 + "\n") and got[1]["n_turns"] == 4
    assert (got[1]["loss_chars"], got[1]["loss_sha256"]) == (5000, sha("é🙂" * 2500))
    assert got[2]["n_turns"] == 2 and got[None]["turns_sha256"] == sha("user\nn\n") and got[3]["turns_sha256"] == sha("user\nfirst\nuser\nthen\n")
    cut = {r["conv_id"]: tuple(r) for r in chat_format.digests(chat_format.format_log(log, hot_events=1)).collect()}
    assert cut == {k: tuple(v) for k, v in got.items()}
    empty = chat_format.digests(chat_format.format_log(chat_format.replayed(df.limit(0))))
    assert empty.count() == 0 and empty.columns == list(got[1].asDict())


# 12


def trie_by_hand(sequences):
    """{prefix: (smallest, n_convs, n_children, n_leaves, saved, ends)} of {conv: [(role, text)]}."""
    members = defaultdict(list)
    for c in sorted(sequences):
        for d in range(len(sequences[c]) + 1):
            members[tuple(sequences[c][:d])].append(c)
    out = {}
    for p, cs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        kids = sum(len(q) == len(p) + 1 for q in below)
        leaves = sum(not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below) for q in below)
        saved = sum((len(members[q]) - 1) * len(re.findall(prefix_trie.WORD, q[-1][1])) for q in below if q)
        ends = ",".join(str(c) for c in cs if len(sequences[c]) == len(p))
        out[cs[0], len(p)] = (members[p[:-1]][0] if p else None, len(cs), kids, leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def assert_trie(df, sequences):
    names = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    rows = df.collect()
    assert {(r["conv_id"], r["depth"]): tuple(r[n] for n in names) for r in rows} == trie_by_hand(sequences) and len(rows) == len(trie_by_hand(sequences))


@pytest.mark.parametrize("local_weight", [20_000, 12])
def test_trie_equals_brute_force_whatever_is_split_by_joins(spark, local_weight):
    rng = random.Random(local_weight)
    sequences = {}
    for c in range(40):
        seq = [(rng.choice(["user", ""]), rng.choice(["a", "b b", ""])) for _ in range(rng.randrange(1, 6))]
        sequences[c] = seq if rng.random() < 0.7 else list(sequences[rng.randrange(c)]) if c else seq
    sequences[40] = [("user", "deep")] * 40
    sequences[41] = sequences[40][:25] + [("user", "turn off here")]
    rows = [(c, i, *t, "clash") for c, seq in sequences.items() for i, t in enumerate(seq)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, CHAT + ", depth string")
    assert_trie(prefix_trie.trie(*prefix_trie.plain(prefix_trie.turns(df)), local_weight=local_weight), sequences)


def test_grafted_heads_and_defined_cases(spark):
    rows = [(20, None, "user", "base"), (20, 1, None, None), (21, 0, "user", "x"), (21, 0, "user", "x"), (21, 3, "user", "tail"), (22, 0, "user", "gone"), (45, 5, "user", "no base"), (45, 6, "user", "kept"), (None, 0, "user", "no id"), (-3, 0, "user", "negative")]
    df = spark.createDataFrame(rows, CHAT)
    placed = prefix_trie.turns(df)
    conv = F.col("conv")
    got = prefix_trie.trie(*prefix_trie.graft(placed, conv - conv % 20, F.lit(1)))
    assert_trie(got, {20: [("user", "base"), ("", "")], 21: [("user", "base"), ("user", "x"), ("user", "tail")], 22: [("user", "base")], 45: [("user", "kept")], -3: []})
    assert prefix_trie.trie(*prefix_trie.plain(prefix_trie.turns(df.limit(0)))).count() == 0
    alone = prefix_trie.trie(*prefix_trie.graft(placed.filter("conv = -3"), conv - conv % 20, F.lit(1))).collect()
    assert [(r["conv_id"], r["depth"], r["n_convs"], r["n_leaves"], r["saved_tokens"]) for r in alone] == [(-3, 0, 1, 1, 0)]


def test_subtree_sums_of_random_forests():
    rng = np.random.default_rng(3)
    for shape in ("bush", "chain", "star"):
        n = 500
        parent = np.array([-1 if i % 200 == 0 else int(rng.integers(i // 200 * 200, i)) if shape == "bush" else i - 1 if shape == "chain" else i // 200 * 200 for i in range(n)])
        values = rng.integers(0, 9, (n, 2))
        want, weight = values.copy(), np.ones(n, np.int64)
        for i in range(n - 1, -1, -1):
            if parent[i] >= 0:
                want[parent[i]] += want[i]
                weight[parent[i]] += weight[i]
        order = rng.permutation(n)
        place = np.argsort(order)
        moved = np.where(parent[order] >= 0, place[parent[order]], -1)
        assert (prefix_trie.subtree_sums(moved, weight[order], values[order]) == want[order]).all()


# 13


def terms_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def search_by_hand(docs, items, k):
    held = [(i, terms_of(t)) for i, t in docs]
    n_all, l_all = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    df = defaultdict(int)
    for _, t in held:
        for w in set(t):
            df[w] += 1
    wanted = defaultdict(set)
    for i, t in items:
        wanted[None if i is None else str(i)] |= set(terms_of(t))
    out = []
    for item, terms in wanted.items():
        found = []
        for doc, words in held:
            score = 0
            for w in terms & set(words):
                m = 10 + 90 * len(words) * n_all // l_all
                tf = words.count(w)
                score += math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[w] + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, doc) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_terms", [100_000, 20])
def test_search_equals_brute_force_in_one_block_or_many(spark, block_terms):
    rng = random.Random(block_terms)
    words = [f"w{int(rng.paretovariate(0.6))}" for _ in range(80)] + ["Über", "ÜBER", "x1", "漢字"]
    make = lambda n: " ".join(rng.choices(words, k=rng.randrange(n))) + rng.choice(["", "...", "\n"])
    docs = [(i, make(60)) for i in range(120)] + [(7, "w1 w2"), (7, "w1 w2"), (None, "w1 w3 x1"), (300, None), (301, ""), (302, "?!")]
    items = [(i, make(25)) for i in range(25)] + [(3, "w1"), (90, None), (91, "..."), (None, "x1 w1"), (5, "w2 w2")]
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item", F.lit("clash")).withColumn("score", F.lit(1))
    q = spark.createDataFrame(items, "item_id bigint, text string").withColumn("block", F.lit(0))
    got = sorted((tuple(r) for r in lexical.search(d.repartition(5), q, k=4, block_terms=block_terms).collect()), key=repr)
    assert got == search_by_hand(docs, items, 4)
    assert lexical.search(d.limit(0), q).count() == 0 and lexical.search(d, q.limit(0)).count() == 0


def test_shared_terms_are_summed_once():
    common = [f"c{i}".encode() for i in range(30)]
    plan = lexical.Plan([(str(k), common[: 10 + k % 3 * 10] + [f"own{k}".encode()]) for k in range(60)])
    assert len(plan.parts) + len(plan.left) < 200 < sum(11 + k % 3 * 10 for k in range(60))
    added = np.arange(1, len(plan.vocab) + 1)
    got = plan.scores(np.arange(len(plan.vocab)), np.zeros(len(plan.vocab), int), added, 1)[:, 0]
    assert got.tolist() == [sum(added[plan.vocab[t]] for t in [*common[: 10 + k % 3 * 10], f"own{k}".encode()]) for k in range(60)]

"""One query per numbered operator, over the whole of its table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import bpe, chat_format, decontaminate, langid, lexical, maxscore, packing, prefix_trie, simhash, suffix_dedup, token_count, toxicity, url_filter


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page: the rules', else the classifier's."""
    weights = url_filter.fit(url_filter.default_labels(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), weights)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document as word_bpe_49k.json counts them."""
    return token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded as byte_bpe_50k.json does it, as digests."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def fold(modulus: int) -> Column:
    """crc32 of the id as text, by a modulus; null for a null id."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of the held-out fold are not learnt from."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(fold(5) != 0))
    return toxicity.score(docs, model).select("doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a window of a benchmark item."""
    return decontaminate.contamination(decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.cluster(table(spark, sf_dir, "documents"))


def op7_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed id rows of all documents, 2048 wide."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of 100 bytes that stand earlier."""
    return suffix_dedup.digests(suffix_dedup.dedup(table(spark, sf_dir, "documents")))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all vectors for every vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings")
    return maxscore.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; languages of the held-out fold are not learnt from."""
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(fold(4) != 2))
    return langid.identify(docs, model).select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, and of one that spells control strings, as read back from the formatted text."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.createDataFrame([(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id bigint, turn bigint, role string, text string")
    return chat_format.digests(chat_format.format_log(chat_format.replayed(rows.union(hostile))))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of conversations, each of which begins as the first of its twenty does."""
    conv = F.col("conv")
    placed = prefix_trie.turns(table(spark, sf_dir, "conversations"))
    sequences, convs = prefix_trie.graft(placed, conv - conv % 20, F.pmod(F.crc32(conv.cast("string").cast("binary")), F.lit(4)))
    return prefix_trie.trie(sequences, convs).drop("ka", "kb")


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all documents for every benchmark item."""
    found = lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").cast("bigint").alias("item_id"), "rank", "doc_id", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_token_counts": op2_token_counts,
    "op3_bpe_codec": op3_bpe_codec,
    "op4_toxicity": op4_toxicity,
    "op5_decontamination": op5_decontamination,
    "op6_simhash_dedup": op6_simhash_dedup,
    "op7_token_packing": op7_token_packing,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_language_id": op10_language_id,
    "op11_chat_format": op11_chat_format,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE: dict[str, str] = {
    "op5_decontamination": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE text IS NOT NULL
), windows AS (
  SELECT DISTINCT item, least(10, len(words)) AS width, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS win
  FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 8, 2))) AS i FROM b WHERE len(words) > 0)
), places AS (
  SELECT doc_id, i, width, array_to_string(words[i:i + width - 1], ' ') AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w), (SELECT DISTINCT width FROM windows)
  WHERE i + width - 1 <= len(words)
), hits AS (SELECT p.doc_id, p.i, p.width, v.item FROM places p JOIN windows v USING (width, win)
), n_hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + width)) AS j FROM hits) GROUP BY doc_id
), found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN n_hit USING (doc_id) LEFT JOIN found USING (doc_id)
""",
    "op9_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON len(q.e) = len(c.e) AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
""",
    "op11_chat_format": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(role) + len(regexp_extract_all(role, '\\|\]|\[INST role=|</?s>|\[/?INST\]|<</?SYS>>|<\|im_start\|>|<\|im_end\|>'))
    + length(text) + len(regexp_extract_all(text, '\\|\[INST role=|</?s>|\[/?INST\]|<</?SYS>>|<\|im_start\|>|<\|im_end\|>')) + 24 AS chars FROM c
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""",
    "op12_prefix_trie": r"""
WITH n AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i, struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS t FROM conversations WHERE conv_id IS NOT NULL
), l AS (SELECT c, list(t ORDER BY i) AS own FROM n GROUP BY c
), bits AS (
  SELECT c, own, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(range(1, length(CAST(c AS VARCHAR)) + 1), lambda k: [CAST(ascii(substr(CAST(c AS VARCHAR), CAST(k AS INTEGER), 1)) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS r FROM l
), h AS (SELECT c, own, CAST(xor(r, 4294967295) & 3 AS INTEGER) AS h FROM bits
), s AS (SELECT x.c, list_concat(coalesce(list_slice(b.own, 1, x.h), []), list_slice(x.own, x.h + 1, len(x.own))) AS s FROM h x LEFT JOIN l b ON b.c = x.c - x.c % 20
), p AS (SELECT c, s, d, list_slice(s, 1, d) AS k FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM s)
), node AS (
  SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(s) = d), '')) AS ends_sha256,
    CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(k[d].text, '[^\x20\x09-\x0D]+')) END AS words FROM p GROUP BY k, d
), kids AS (SELECT list_slice(k, 1, d - 1) AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1
), full_node AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (k)
), sums AS (
  SELECT p.k, sum(CASE WHEN y.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((y.n_convs - 1) * y.words) AS saved FROM full_node y JOIN p ON p.c = y.conv_id AND p.d <= y.d GROUP BY p.k
)
SELECT x.conv_id, x.d AS depth, u.conv_id AS parent_conv_id, x.n_convs, x.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, x.ends_sha256
FROM full_node x JOIN sums ON sums.k = x.k LEFT JOIN node u ON x.d > 0 AND u.k = list_slice(x.k, 1, x.d - 1)
""",
    "op13_ranked_search": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents
), t AS (SELECT CAST(count(*) AS BIGINT) AS all_n, CAST(sum(len(words)) AS BIGINT) AS all_l FROM d WHERE len(words) > 0
), f AS (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM d), tf AS (SELECT doc_id, n, term, count(*) AS tf FROM f GROUP BY ALL
), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE text IS NOT NULL
), s AS (
  SELECT item_id, doc_id, CAST(sum(CAST(floor(1000 * ln((2 * all_n + 2) / (2 * df + 1))) AS BIGINT) * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_n) // all_l)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term), t GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER w AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
WINDOW w AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER w <= 10
""",
}

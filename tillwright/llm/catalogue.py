"""The registered queries of this folder and the SQL they are checked with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import quality, toxicity
from tillwright.llm.centroids import cluster
from tillwright.llm.chat_format import chat_format, digest
from tillwright.llm.common import keep, table
from tillwright.llm.decontaminate import decontaminate
from tillwright.llm.exact_dedup import exact_dedup
from tillwright.llm.html_extract import extract_pages
from tillwright.llm.langid import held_out, learn, predict
from tillwright.llm.packing import pack
from tillwright.llm.prefix_trie import prefix_trie
from tillwright.llm.simhash import hex_print, near_duplicates
from tillwright.llm.substring_dedup import substring_dedup
from tillwright.llm.token_counts import token_counts

#: The vocabulary file that op9 and the pipeline encode with.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: The ranks that op5 counts with.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"), words=3, distance=3)
    return found.select("doc_id", hex_print().alias("fingerprint"), "component_id")


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup(table(spark, folder, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def language_training_rows(docs: DataFrame) -> DataFrame:
    """Rows the language network may learn from."""
    return docs.where(~held_out(F.col("doc_id"), 4, 2)).select("doc_id", "text", "lang")


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    network = learn(language_training_rows(docs))
    return docs.select(
        "doc_id",
        held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        predict(network, F.col("text")).alias("found"),
    ).select(
        "doc_id",
        "held_out",
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.col("found.label_bytes").alias("label_bytes"),
    )


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), RANKS)


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_pages(table(spark, folder, "pages"))


def _judged(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All documents, and the labels that may be learned from."""
    labels = table(spark, folder, "labels")
    return table(spark, folder, "documents"), labels.where(~held_out(F.col("doc_id"), 3, 1))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _judged(spark, folder)
    scorer = quality.train(docs.select("doc_id", "text"), labels)
    found = docs.select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        quality.score(scorer, F.col("text")).alias("score"),
    )
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"))


def op9_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), TOKENIZER, capacity=4096)


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _judged(spark, folder)
    judge = toxicity.train(docs.select("doc_id", "text"), labels)
    found = docs.select(
        "doc_id",
        held_out(F.col("doc_id"), 3, 1).alias("held_out"),
        toxicity.score(judge, F.col("text")).alias("found"),
    )
    return found.select(
        "doc_id",
        "held_out",
        F.col("found.score").alias("score"),
        (F.col("found.score") >= 0.7).cast("int").alias("predicted"),
        F.col("found.passages").alias("passages"),
    )


def op11_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return cluster(table(spark, folder, "embeddings"), dim=64, k=40, rounds=5, seed=2)[0]


def op12_conversation_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(table(spark, folder, "conversations"))


#: Its texts hold what the template itself writes.
OWN_CONVERSATION = [(-7, [("user", r"\### Assistant: </turn> ok"), ("assistant", r"\### Assistant: </turn> ok")])]
OWN_LAYOUT = "conv_id long, messages array<struct<role string, content string>>"


def op13_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    own = spark.createDataFrame(OWN_CONVERSATION, OWN_LAYOUT)
    formatted = chat_format(table(spark, folder, "conversations"), own)
    # The digest sees the written texts and masks, nothing else.
    return digest(keep(formatted.select("conv_id", "formatted", "loss_spans"), "formatted"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_substring_dedup,
        op3_benchmark_decontamination,
        op4_language_id,
        op5_token_counts,
        op6_html_extraction,
        op7_quality_classifier,
        op8_exact_dedup,
        op9_best_fit_packing,
        op10_toxicity,
        op11_centroid_clustering,
        op12_conversation_prefix_trie,
        op13_chat_formatting,
    )
}

OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bs AS (SELECT item_id, w, least(len(w), 10) AS size FROM b WHERE len(w) > 0),
bw AS (
  SELECT DISTINCT item_id, size, array_to_string(w[s : s + size - 1], ' ') AS win
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM bs)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT rid, s, size, array_to_string(w[s : s + size - 1], ' ') AS win
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM d, sizes WHERE len(w) >= size)),
hit AS (SELECT rid, s, dw.size, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
n AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT rid, unnest(range(s, s + size)) AS p FROM hit) GROUP BY rid),
it AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN it USING (rid)
"""

OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS h
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
       row_number() OVER best = 1 AS kept, h AS text_sha256
FROM d WINDOW best AS (PARTITION BY h ORDER BY n DESC, doc_id NULLS LAST)
"""



def _op11_sql(dim: int = 64, k: int = 40, rounds: int = 5) -> str:
    """Every round as two common table expressions, in long form (one row per component)."""
    parts = [
        f"""v AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS ints
  FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
x AS (SELECT rid, unnest(ints) AS val, unnest(range(1, {dim + 1})) AS place FROM v),
c0 AS (
  SELECT number, unnest(ints) AS val, unnest(range(1, {dim + 1})) AS place
  FROM (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, ints) - 1 AS number, ints FROM v)
  WHERE number < {k})"""
    ]
    for i in range(rounds + 1):
        parts.append(f"""a{i} AS (
  SELECT rid, arg_min(number, dist * {k} + number) AS number, min(dist) AS dist
  FROM (SELECT rid, number, CAST(sum((x.val - c.val) * (x.val - c.val)) AS BIGINT) AS dist
        FROM x JOIN c{i} c USING (place) GROUP BY rid, number) GROUP BY rid)""")
        if i < rounds:
            parts.append(f"""c{i + 1} AS (
  SELECT number, place, coalesce(moved, val) AS val
  FROM c{i} LEFT JOIN (
    SELECT number, place, CAST((sum(val) - ((sum(val) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS moved
    FROM a{i} JOIN x USING (rid) GROUP BY number, place) m USING (number, place))""")
    return "WITH " + ",\n".join(parts) + f""",
h AS (SELECT number, sha256(string_agg(CAST(val AS VARCHAR), ',' ORDER BY place)) AS sha FROM c{rounds} GROUP BY number)
SELECT vec_id, CAST(number AS INTEGER) AS cluster, dist AS distance,
       CAST(sum(dist) OVER (PARTITION BY number) AS BIGINT) AS cluster_inertia,
       CAST(sum(dist) OVER () AS BIGINT) AS inertia, sha AS centroid_sha256
FROM a{rounds} JOIN v USING (rid) JOIN h USING (number)"""


# DuckDB has no CRC-32: it is worked out bit by bit over the id's digits.
OP12_SQL = r"""
WITH RECURSIVE c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
t AS (
  SELECT conv_id, sha, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha) AS place
  FROM (SELECT *, sha256(length(role) || ':' || role || text) AS sha FROM c)),
crc(conv_id, digits, bit, value) AS (
  SELECT conv_id, CAST(conv_id AS VARCHAR), 0, CAST(4294967295 AS BIGINT) FROM (SELECT DISTINCT conv_id FROM c)
  UNION ALL
  SELECT conv_id, digits, bit + 1, xor(fed >> 1, CAST(CASE WHEN fed & 1 = 1 THEN 3988292384 ELSE 0 END AS BIGINT))
  FROM (SELECT conv_id, digits, bit,
               CASE WHEN bit % 8 = 0 THEN xor(value, CAST(ascii(substr(digits, bit // 8 + 1, 1)) AS BIGINT)) ELSE value END AS fed
        FROM crc WHERE bit < 8 * length(digits))),
p AS (
  SELECT crc.conv_id, crc.conv_id - crc.conv_id % 20 AS opener, (4294967295 - value) % 4 AS h
  FROM crc WHERE bit = 8 * length(digits)),
r AS (
  SELECT p.conv_id, 0 AS part, place, sha, words FROM p JOIN t ON t.conv_id = p.opener AND place <= h
  UNION ALL
  SELECT p.conv_id, 1, place, sha, words FROM p JOIN t ON t.conv_id = p.conv_id AND place > h),
s AS (
  SELECT conv_id, words, row_number() OVER w AS depth, string_agg(sha, '') OVER w AS seq
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, place ROWS UNBOUNDED PRECEDING)),
m AS (
  SELECT conv_id, words, depth, seq FROM s
  UNION ALL
  SELECT conv_id, 0, 0, '' FROM p),
n AS (
  SELECT seq, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
         CASE WHEN depth > 0 THEN substr(seq, 1, 64 * (depth - 1)) END AS above
  FROM m GROUP BY seq, depth),
k AS (SELECT above AS seq, count(*) AS n_children FROM n WHERE above IS NOT NULL GROUP BY above),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (seq)),
u AS (
  SELECT a.seq, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved_tokens
  FROM f a JOIN f b ON b.depth >= a.depth AND substr(b.seq, 1, 64 * a.depth) = a.seq GROUP BY a.seq),
e AS (
  SELECT seq, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends
  FROM (SELECT conv_id, arg_max(seq, depth) AS seq FROM m GROUP BY conv_id) GROUP BY seq)
SELECT f.conv_id, CAST(f.depth AS BIGINT) AS depth, g.conv_id AS parent_conv_id, f.n_convs, f.n_children,
       u.n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM f LEFT JOIN f g ON g.seq = f.above JOIN u ON u.seq = f.seq LEFT JOIN e ON e.seq = f.seq
"""

OP13_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
w AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>') AS body,
         replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '<\/turn>'), ': ', ':\ ') AS head
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ' || head || ': ' || body || '</turn>') + 1) AS BIGINT) AS formatted_chars
FROM w GROUP BY conv_id
"""

CHECKS: dict[str, str] = {
    "op3_benchmark_decontamination": OP3_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op11_centroid_clustering": _op11_sql(),
    "op12_conversation_prefix_trie": OP12_SQL,
    "op13_chat_formatting": OP13_SQL,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def checks() -> dict[str, str]:
    return dict(CHECKS)

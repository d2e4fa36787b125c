"""The operators over the given tables, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lauter.llm import decontaminate, toxicity
from lauter.llm.common import crc_mod, table
from lauter.llm.divergence import source_divergence
from lauter.llm.exact_dedup import exact_dedup
from lauter.llm.fingerprint import neighbour_likeness
from lauter.llm.html_text import extract
from lauter.llm.language import label_languages, learnable
from lauter.llm.mixing import mix
from lauter.llm.near_dedup import near_duplicates
from lauter.llm.prefix_trie import conversations, prefix_trie, with_shared_heads
from lauter.llm.suffix_dedup import remove_repeats
from lauter.llm.tokens import token_counts
from lauter.llm.warc import read_warc, write_warc
from lauter.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents")).drop("bucket")


ORACLES["op1_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM d
"""


@query
def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    write_warc(table(spark, folder, "pages"), path)
    return read_warc(spark, path).drop("url", "payload")


# base32 of the digest's hex digits: 40 of them are 32 characters, 5 digits are 4
ORACLES["op2_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (
  SELECT page_id, b, hex, min(page_id) OVER (PARTITION BY hex, octet_length(b)) AS first,
         row_number() OVER (PARTITION BY hex, octet_length(b) ORDER BY page_id) AS nth FROM p)
SELECT page_id, octet_length(b) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + CAST((('0x' || substr(hex, 1 + 5 * CAST(i // 4 AS INT), 5))::INT >> (15 - 5 * CAST(i % 4 AS INT))) & 31 AS INT), 1)), '')
         AS payload_digest,
       CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN nth > 1 THEN first END AS refers_to
FROM f
"""


@query
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op4_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))


@query
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    labels = toxicity.learnable(table(spark, folder, "labels"))
    found = toxicity.toxicity(table(spark, folder, "documents"), labels)
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).drop("source", "copies")


@query
def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents")).drop("key")


@query
def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        "contaminated",
    )


# windows joined to the documents' windows of the same length
ORACLES["op8_decontamination"] = r"""
WITH w AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i : i + least(len(ws), 13) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, 2 + greatest(len(ws) - 13, 0))) AS i FROM w WHERE len(ws) > 0)),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
p AS (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
m AS (
  SELECT p.r, p.i, k.n, win.item_id
  FROM p, (SELECT DISTINCT n FROM win) k, win
  WHERE p.i + k.n - 1 <= len(p.ws) AND win.n = k.n AND win.win = array_to_string(p.ws[p.i : p.i + k.n - 1], ' ')),
hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM m) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""


@query
def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeats(table(spark, folder, "documents")).drop("spans")


@query
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = label_languages(docs, learnable(docs, "doc_id", 4, 2))
    held_out = F.coalesce(crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op11_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return source_divergence(table(spark, folder, "documents"))


ORACLES["op11_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
t AS (SELECT r, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
l AS (SELECT lang, coalesce(sum(n), 0) AS total, count(term) AS v
      FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
cn AS (SELECT lang, source, sum(n) AS total FROM c GROUP BY lang, source),
g AS (SELECT lang, source, coalesce(cn.total, 0) AS total, l.v
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN cn USING (lang, source) JOIN l USING (lang)),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
             1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)::HUGEINT) // (g.total + g.v)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (kept.n + 1)::HUGEINT) // (l.total + l.v)::HUGEINT AS q
      FROM g JOIN l USING (lang) JOIN kept ON kept.lang = g.lang
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
      GROUP BY a.lang, a.source, b.source),
both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM both_parts QUALIFY part = 'pair' OR rank <= 200
"""


@query
def op12_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return neighbour_likeness(table(spark, folder, "documents"))


@query
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(with_shared_heads(conversations(table(spark, folder, "conversations"))))


# crc32 bit by bit: h is what a conversation takes from the first of its twenty
ORACLES["op13_prefix_trie"] = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
h AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
             lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
               lambda a, z: xor(a >> 1, (a & 1) * 3988292384::BIGINT))), 4294967295::BIGINT) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT h.conv_id, t.i, t.role, t.text FROM h JOIN t ON t.conv_id = h.base AND t.i <= h.h
  UNION ALL SELECT h.conv_id, t.i, t.role, t.text FROM h JOIN t ON t.conv_id = h.conv_id AND t.i > h.h),
c AS (
  SELECT h.conv_id, coalesce(ks, []) AS ks, coalesce(ws, []) AS ws FROM h LEFT JOIN (
    SELECT conv_id, list(sha256(length(role) || ':' || role || text) ORDER BY i) AS ks,
           list(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) ORDER BY i) AS ws FROM r GROUP BY conv_id) USING (conv_id)),
x AS (SELECT conv_id, ks, ws, unnest(range(0, len(ks) + 1)) AS d FROM c),
p AS (
  SELECT conv_id, d, sha256(array_to_string(ks[1:d], ',')) AS k, d = len(ks) AS ends,
         CASE WHEN d > 0 THEN sha256(array_to_string(ks[1:d - 1], ',')) END AS parent,
         CASE WHEN d > 0 THEN ws[d] ELSE 0 END AS w FROM x),
n AS (
  SELECT d, k, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n, any_value(w) AS w,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends) AS ids FROM p GROUP BY d, k),
kids AS (SELECT d - 1 AS d, parent AS k, count(*) AS kids FROM n WHERE d > 0 GROUP BY d, parent),
full_node AS (SELECT n.*, coalesce(kids, 0) AS kids FROM n LEFT JOIN kids USING (d, k)),
sub AS (
  SELECT p.d, p.k, sum(CASE WHEN y.kids = 0 THEN 1 ELSE 0 END) AS leaves, sum((y.n - 1) * y.w) AS saved
  FROM full_node y JOIN p ON p.conv_id = y.conv_id AND p.d <= y.d GROUP BY p.d, p.k)
SELECT a.conv_id, a.d::BIGINT AS depth, b.conv_id AS parent_conv_id, a.n::BIGINT AS n_convs, a.kids::BIGINT AS n_children,
       leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(a.ids, '')) AS ends_sha256
FROM full_node a JOIN sub USING (d, k) LEFT JOIN full_node b ON b.d = a.d - 1 AND b.k = a.parent
"""

"""Registered queries of the subpackage: each operator over its whole table, in the agreed columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailsync.llm.exact_dedup import exact_dedup
from mailsync.llm.frames import documents
from mailsync.llm.language import predict_languages
from mailsync.llm.license_scan import scan_licenses, scan_sql
from mailsync.llm.line_dedup import apply_bitmaps, line_bitmaps
from mailsync.llm.mixing import mix, mix_sql
from mailsync.llm.near_dup import near_duplicates
from mailsync.llm.packing import pack_documents
from mailsync.llm.personal_data import personal_data
from mailsync.llm.prefix_trie import prefix_trie
from mailsync.llm.quality import quality_rules
from mailsync.llm.simhash import simhash_duplicates
from mailsync.llm.spelling import spelling_variants
from mailsync.llm.tokens import count_tokens

TOKEN_LIMIT = 512


def op1_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_languages(documents(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score", "n_spans", "spans")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return apply_bitmaps(docs, line_bitmaps(docs)).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op4_streaming_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "class_distance", "word_distance")


def op7_hamming_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op8_rake_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(documents(spark, sf_dir))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(documents(spark, sf_dir))


def op11_centroid_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_sorted_list_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


def op13_pigeonring_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_spans": op1_language_spans,
    "op2_token_counts": op2_token_counts,
    "op3_line_dedup": op3_line_dedup,
    "op4_streaming_exact_dedup": op4_streaming_exact_dedup,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_quality_divergence": op6_quality_divergence,
    "op7_hamming_near_duplicates": op7_hamming_near_duplicates,
    "op8_rake_mixture": op8_rake_mixture,
    "op9_personal_data": op9_personal_data,
    "op10_license_scan": op10_license_scan,
    "op11_centroid_prefix_trie": op11_centroid_prefix_trie,
    "op12_sorted_list_spelling": op12_sorted_list_spelling,
    "op13_pigeonring_simhash": op13_pigeonring_simhash,
}


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 of a DuckDB string, bit by bit."""
    bits = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    hexed = f"hex(encode({text}))"
    octets = (f"list_transform(range(octet_length(encode({text}))), "
              f"lambda k: ('0x' || substr({hexed}, 2 * k + 1, 2))::BIGINT)")
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: {bits}), 4294967295)"


ORACLES: dict[str, str] = {
    "op3_line_dedup": r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
flat AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS n FROM split),
keyed AS (
    SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
    FROM flat),
frequent AS (
    SELECT line_key, max(doc_id) AS top FROM keyed WHERE length(line_key) >= 20
    GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (f.top IS NOT NULL AND k.doc_id <> f.top) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (f.top IS NULL OR k.doc_id = f.top), '')) AS kept_sha256
FROM keyed k LEFT JOIN frequent f USING (line_key) GROUP BY k.doc_id""",
    "op4_streaming_exact_dedup": r"""
WITH t AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept,
       text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)""",
    "op8_rake_mixture": mix_sql(),
    "op10_license_scan": scan_sql(),
    "op11_centroid_prefix_trie": rf"""
WITH RECURSIVE t AS MATERIALIZED (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS r
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, count(*) AS own_turns FROM t GROUP BY c),
convs AS MATERIALIZED (
    SELECT o.c, o.c - o.c % 20 AS base, o.own_turns, {crc32_sql("o.c::VARCHAR")} % 4 AS h, coalesce(b.own_turns, 0) AS base_turns
    FROM own o LEFT JOIN own b ON b.c = o.c - o.c % 20),
turns AS MATERIALIZED (
    SELECT k.c, t.r AS d, role, text FROM convs k JOIN t ON t.c = k.base AND t.r <= k.h
    UNION ALL
    SELECT k.c, t.r - k.h + least(k.h, k.base_turns), role, text FROM convs k JOIN t ON t.c = k.c AND t.r > k.h),
places AS (
    SELECT c, 0::BIGINT AS d, '' AS node, NULL::VARCHAR AS parent, 0::BIGINT AS words FROM convs
    UNION ALL
    SELECT p.c, t.d, md5(p.node || '/' || md5(t.role) || md5(t.text)), p.node, len(regexp_extract_all(t.text, '[^\x20\x09-\x0D]+'))
    FROM places p JOIN turns t ON t.c = p.c AND t.d = p.d + 1),
kept AS MATERIALIZED (SELECT * FROM places),
nodes AS MATERIALIZED (
    SELECT node, any_value(parent) AS parent, any_value(d) AS depth, any_value(words) AS words, min(c) AS rep, count(*) AS n_convs
    FROM kept GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
worth AS (SELECT n.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * words AS saved FROM nodes n LEFT JOIN kids USING (node)),
sums AS (
    SELECT k.node, sum((w.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(w.saved)::BIGINT AS saved_tokens
    FROM worth w JOIN kept k ON k.c = w.rep AND k.d <= w.depth GROUP BY k.node),
ends AS (
    SELECT node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS digest
    FROM (SELECT *, max(d) OVER (PARTITION BY c) AS last_d FROM kept) WHERE d = last_d GROUP BY node)
SELECT w.rep AS conv_id, w.depth, p.rep AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens,
       coalesce(e.digest, sha256('')) AS ends_sha256
FROM worth w JOIN sums s USING (node) LEFT JOIN ends e USING (node) LEFT JOIN nodes p ON p.node = w.parent""",
    "op12_sorted_list_spelling": rf"""
WITH RECURSIVE runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents),
each_run AS MATERIALIZED (
    SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, n, {crc32_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM each_run),
hurt AS (
    SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM hurt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
less AS MATERIALIZED (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS MATERIALIZED (
    SELECT DISTINCT l.word AS a, w.word AS b FROM less l JOIN words w ON w.word = l.rest
    UNION SELECT DISTINCT w.word, l.word FROM less l JOIN words w ON w.word = l.rest
    UNION SELECT x.word, y.word FROM less x JOIN less y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word),
best AS (
    SELECT a AS word, count(*) AS n_near, first({{'w': b, 'n': n}} ORDER BY n DESC, encode(b)) AS top
    FROM pairs JOIN words ON word = b GROUP BY a),
judged AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top.n >= 10 * w.n THEN top.w END AS form,
           CASE WHEN top.n >= 10 * w.n THEN top.n END AS form_n
    FROM words w LEFT JOIN best USING (word)),
walk AS (
    SELECT word, word AS at, form AS next FROM judged
    UNION ALL
    SELECT walk.word, j.word, j.form FROM walk JOIN judged j ON j.word = walk.next)
SELECT j.word, j.form, walk.at AS root, j.n, j.n_near, j.form_n FROM judged j JOIN walk ON walk.word = j.word AND walk.next IS NULL""",
}

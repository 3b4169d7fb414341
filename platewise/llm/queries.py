"""One registered query per operator, over the whole of its tables, and the reference SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from platewise.llm import op1_fingerprint, op2_secrets, op3_token_files, op4_licenses, op5_decontaminate, op6_near_duplicates, op7_line_dedup, op8_byte_bpe, op9_toxicity, op10_pii, op11_search, op12_whitening, op13_suffix_dedup

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_fingerprint_(spark: SparkSession, folder: str) -> DataFrame:
    return op1_fingerprint.report(_table(spark, folder, "documents"))


def op2_secrets_(spark: SparkSession, folder: str) -> DataFrame:
    return op2_secrets.report(_table(spark, folder, "documents"))


def op3_token_files_(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return op3_token_files.written_and_read(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN, end_id=2)


def op4_licenses_(spark: SparkSession, folder: str) -> DataFrame:
    return op4_licenses.report(_table(spark, folder, "documents"))


def op5_decontaminate_(spark: SparkSession, folder: str) -> DataFrame:
    return op5_decontaminate.report(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op6_near_duplicates_(spark: SparkSession, folder: str) -> DataFrame:
    return op6_near_duplicates.near_duplicates(_table(spark, folder, "documents"), words=4, percent=80)


def op7_line_dedup_(spark: SparkSession, folder: str) -> DataFrame:
    return op7_line_dedup.decide(_table(spark, folder, "documents"))


def op8_byte_bpe_(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return op8_byte_bpe.round_trip(_table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


def op9_toxicity_(spark: SparkSession, folder: str) -> DataFrame:
    return op9_toxicity.score(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_pii_(spark: SparkSession, folder: str) -> DataFrame:
    return op10_pii.report(_table(spark, folder, "documents"))


def op11_search_(spark: SparkSession, folder: str) -> DataFrame:
    return op11_search.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op12_whitening_(spark: SparkSession, folder: str) -> DataFrame:
    return op12_whitening.whiten(_table(spark, folder, "embeddings"))


def op13_suffix_dedup_(spark: SparkSession, folder: str) -> DataFrame:
    return op13_suffix_dedup.judge(_table(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_fingerprint": op1_fingerprint_,
        "op2_secrets": op2_secrets_,
        "op3_token_files": op3_token_files_,
        "op4_licenses": op4_licenses_,
        "op5_decontaminate": op5_decontaminate_,
        "op6_near_duplicates": op6_near_duplicates_,
        "op7_line_dedup": op7_line_dedup_,
        "op8_byte_bpe": op8_byte_bpe_,
        "op9_toxicity": op9_toxicity_,
        "op10_pii": op10_pii_,
        "op11_search": op11_search_,
        "op12_whitening": op12_whitening_,
        "op13_suffix_dedup": op13_suffix_dedup_,
    }


_OP5 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL
), bw AS (
  SELECT item_id, least(len(w), 13) AS n, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i, w FROM b WHERE len(w) > 0
), win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM bw
), lengths AS (
  SELECT DISTINCT n FROM win
), dp AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n
), hit AS (
  SELECT p.doc_id, p.i, p.n, win.item_id FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS k FROM dp) p
  JOIN win ON win.k = p.k AND win.n = p.n
), words AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP11 = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, row_number() OVER () AS q, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)
), wanted AS (
  SELECT q, term, count(*) AS times FROM (SELECT q, unnest(w) AS term FROM b) GROUP BY q, term
), tf AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM wanted) GROUP BY r, term
), corpus AS (
  SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0
), weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, corpus GROUP BY term, n
), shares AS (
  SELECT tf.r, d.doc_id, term, weight.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(d.w) * n) // l))) AS share
  FROM tf JOIN weight USING (term) JOIN d ON d.r = tf.r, corpus WHERE d.doc_id IS NOT NULL
), scores AS (
  SELECT q, r, doc_id, CAST(sum(times * share) AS BIGINT) AS score FROM wanted JOIN shares USING (term) GROUP BY q, r, doc_id
), ranked AS (
  SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
)
SELECT b.item_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked JOIN b USING (q) WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_decontaminate": _OP5, "op11_search": _OP11}

"""The registered queries of this subpackage, each over its whole tables, and
the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    fingerprints,
    line_dedup,
    lm_scoring,
    near_dedup,
    packing,
    pii,
    prefix_trie,
    quality,
    simhash_dedup,
    spelling_variants,
    substring_dedup,
    token_counts,
)
from .common import read_table


#: For the registered query only; a real run brings its own secret key.
PII_KEY = b"registered-query"


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_counts.token_counts(docs, _tokenizer("piece_bpe_32k.model"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.lm_scores(read_table(spark, sf_dir, "documents"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=2)


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.fingerprints(read_table(spark, sf_dir, "documents"), cover=True)
    return found.withColumn("edited_sha256", F.sha2("edited_text", 256)).drop("edited_text")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.pack(docs, _tokenizer("word_bpe_49k.json"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(read_table(spark, sf_dir, "documents"), PII_KEY)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.remove_repeated_lines(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.spelling_variants(read_table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


def op13_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.similar_documents(read_table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), start AS (
  SELECT doc_id, len(w) AS n, w, unnest(range(1, len(w) - 11)) AS s FROM d WHERE len(w) >= 13
), win AS (
  SELECT doc_id, s, array_to_string(w[s:s + 12], ' ') AS g FROM start
), first AS (
  SELECT g, min(doc_id) AS m FROM win GROUP BY g
), gone AS (
  SELECT DISTINCT doc_id, s + i AS p
  FROM (SELECT doc_id, s, unnest(range(0, 13)) AS i FROM win JOIN first USING (g) WHERE m < doc_id)
), word AS (
  SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d
), kept AS (
  SELECT word.doc_id, count(*) AS n_kept, string_agg(x, ' ' ORDER BY p) AS kept
  FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY word.doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


OP10_SQL = r"""
WITH line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS p
  FROM documents WHERE text IS NOT NULL
), often AS (
  SELECT x FROM line GROUP BY x HAVING count(*) > 1
), rep AS (
  SELECT line.* FROM line SEMI JOIN often USING (x)
), pair AS (  -- the same line at an earlier place
  SELECT a.doc_id, a.p, b.doc_id AS d2, a.p - b.p AS diag, length(a.x) + 1 AS chars
  FROM rep a JOIN rep b ON a.x = b.x AND (b.doc_id < a.doc_id OR (b.doc_id = a.doc_id AND b.p < a.p))
), island AS (  -- consecutive lines that match consecutive lines
  SELECT *, p - row_number() OVER (PARTITION BY doc_id, d2, diag ORDER BY p) AS i FROM pair
), sized AS (
  SELECT doc_id, p, sum(chars) OVER (PARTITION BY doc_id, d2, diag, i) AS total FROM island
), gone AS (
  SELECT DISTINCT doc_id, p FROM sized WHERE total >= 60
), kept AS (
  SELECT line.doc_id, count(*) AS n_kept, string_agg(x, chr(10) ORDER BY p) AS kept
  FROM line ANTI JOIN gone USING (doc_id, p) GROUP BY line.doc_id
)
SELECT doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(string_split(text, chr(10))), 0) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       CASE WHEN text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_token_counts, op2_substring_dedup, op3_decontamination, op4_lm_scoring, op5_near_dedup,
        op6_fingerprints, op7_packing, op8_pii, op9_quality, op10_line_dedup, op11_spelling_variants,
        op12_prefix_trie, op13_simhash_dedup)}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_substring_dedup": OP2_SQL,
        "op10_line_dedup": OP10_SQL,
    }

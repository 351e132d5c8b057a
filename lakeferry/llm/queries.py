"""Registered queries of the text operators: each over its whole table with the production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.llm import compression, language, lempel_ziv, licenses, mixing, simhash, spelling, suffixes, supervision, syncmers, tokens, whitening, wrapper
from lakeferry.llm.common import table
from lakeferry.sinks.storage import shared_path

#: One in so many runs of letters, by hash, loses a letter before words are counted.
CUT_ONE_IN = 199


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that repeat a benchmark item, and the items."""
    found = suffixes.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    return licenses.license_notices(table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written in doc_id order and read back from the files."""
    path = shared_path(spark, "tokens")
    tokens.write_tokens(table(spark, sf_dir, "documents"), path)
    return tokens.read_tokens(spark, path)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    found = supervision.judged(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "good"
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the windows that a document with a smaller id has."""
    return lempel_ziv.removed(table(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return wrapper.extracted(table(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return language.identified(table(spark, sf_dir, "documents"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain membership and rate of every document."""
    found = mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    shares = [F.col("p")[k].alias(f"p_{name}") for k, name in enumerate(mixing.DOMAINS)]
    return found.select("doc_id", "n_tokens", *shares, "rate")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return compression.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leading whitened components of every embedding."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they and the next document's are."""
    return syncmers.compared(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, with the query's planted misspellings."""
    words = spelling.word_counts(table(spark, sf_dir, "documents"), cut_one_in=CUT_ONE_IN)
    return spelling.grouped(words).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_license_scan": op3_license_scan,
    "op4_token_files": op4_token_files,
    "op5_quality_rules": op5_quality_rules,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_html_extraction": op7_html_extraction,
    "op8_language_id": op8_language_id,
    "op9_source_mixing": op9_source_mixing,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_spelling_variants": op13_spelling_variants,
}
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: SQL that gives the same rows, where SQL can: the other operators have trained models, tokenizers or hashes of their own.
ORACLES: dict[str, str] = {
    "op2_benchmark_decontamination": rf"""
    WITH docs AS (SELECT doc_id, {_ITEM_WORDS} AS ws FROM documents),
    items AS (SELECT item_id, ws, least(10, len(ws)) AS n FROM (SELECT item_id, {_ITEM_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
    item_windows AS (
      SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS g
      FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM items)
    ),
    doc_windows AS (
      SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
      FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
            FROM docs, (SELECT DISTINCT n FROM items) WHERE len(ws) >= n)
    ),
    found AS (SELECT doc_id, i, d.n AS n, item_id FROM doc_windows d JOIN item_windows USING (g)),
    hits AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY 1),
    named AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY 1
    )
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op6_substring_dedup": r"""
    WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    windows AS (
      SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM docs WHERE len(ws) >= 50)
    ),
    firsts AS (SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h),
    gone AS (
      SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM windows JOIN firsts USING (h) WHERE first_id < doc_id
    ),
    every AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS k FROM docs),
    kept AS (
      SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS words FROM every ANTI JOIN gone USING (doc_id, k) GROUP BY 1
    )
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(words, '')) AS kept_sha256
    FROM docs LEFT JOIN kept USING (doc_id)
    """,
}

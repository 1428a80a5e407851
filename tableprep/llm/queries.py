"""Registered queries of the training-data operators and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import decontaminate, hard_negatives, hmm_lm, html_extract, langid, packing, quality, secret_scan, sharding, simhash, token_align, toxicity, warc
from .common import id_remainder, table

QUERIES, ORACLES = {}, {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return html_extract.extract_main_text(table(spark, sf_dir, "pages"))


@_query
def op3_secret_scans(spark, sf_dir):
    """Secret spans of every document."""
    return secret_scan.digest_columns(table(spark, sf_dir, "documents"))


@_query
def op5_benchmark_decontamination(spark, sf_dir):
    """Benchmark windows in every document."""
    return decontaminate.digest(decontaminate.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


@_query
def op9_quality_rules(spark, sf_dir):
    """Measures and verdict of every document."""
    return quality.digest_columns(table(spark, sf_dir, "documents")).drop("rejected_by")


ORACLES["op9_quality_rules"] = r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, [x FOR x IN regexp_split_to_array(text, '[ \x09-\x0D]+') IF x <> ''] AS words,
             [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^ \x09-\x0D]')] AS lines FROM t),
g AS (SELECT r, i, list_slice(words, i, i + 2) AS k
      FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
d AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM g) WHERE n > 1),
c AS (SELECT r, count(DISTINCT i + j) AS n FROM d, (SELECT unnest([0, 1, 2]) AS j) GROUP BY r),
m AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
             (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
             len(lines)::BIGINT AS n_lines,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN c USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 20 * n_words
            OR 100 * n_dup_lines > 50 * n_lines OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM m
"""


@_query
def op10_simhash_near_dedup(spark, sf_dir):
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@_query
def op4_best_fit_packing(spark, sf_dir):
    """Every piece of every document in its sequence."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@_query
def op7_sharding(spark, sf_dir):
    """Shard and slot of every document."""
    return sharding.shard(table(spark, sf_dir, "documents"))


@_query
def op8_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    return toxicity.held_out_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op6_language_id(spark, sf_dir):
    """Language of every document."""
    return langid.held_out_predictions(table(spark, sf_dir, "documents"))


@_query
def op2_lm_scoring(spark, sf_dir):
    """Unigram and hidden-Markov score of every document."""
    return hmm_lm.score(table(spark, sf_dir, "documents"), id_remainder("doc_id", 7) != 2)


@_query
def op11_hard_negatives(spark, sf_dir):
    """Hard negatives of every anchor and positive."""
    vec_id, label = F.col("vec_id"), F.col("label")
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), vec_id % 50 == 0,
                               label=F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))


@_query
def op12_token_alignment(spark, sf_dir):
    """Groups and links of two tokenizers in every document."""
    return token_align.link_figures(table(spark, sf_dir, "documents"))


@_query
def op13_warc(spark, sf_dir):
    """Archive of all pages, read back as capture histories; the pages have no time, so the id makes one."""
    found = warc.capture_histories(table(spark, sf_dir, "pages"), date=F.timestamp_seconds(1_700_000_000 + F.col("page_id")))
    first = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return found.select(*first, *[c for c in found.columns if c not in first])

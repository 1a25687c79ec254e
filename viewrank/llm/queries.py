"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewrank.llm import (
    best_fit_packing,
    context_mixing,
    feast_whitening,
    filter_audit,
    hash_forest,
    language_id,
    license_scan,
    line_dedup,
    quality_rules,
    sentencepiece_codec,
    simhash_dedup,
    substring_dedup,
    weighted_fingerprints,
)

TOKENIZER_FOLDER = "/opt/tokenizers"
PIECES = "piece_bpe_32k.model"


def vocabulary(folder: str = TOKENIZER_FOLDER) -> bytes:
    """The public vocabulary file, read on the driver and sent with the job."""
    return Path(folder, PIECES).read_bytes()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(divisor: int) -> Column:
    """True where crc32 of the id as text leaves 2."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor == 2


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return context_mixing.score_texts(docs, remainder(7), F.col("lang"), borders=True).drop("text_hash")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.count_deleted(table(spark, sf_dir, "documents")).drop("text_hash")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("dice", F.round("dice", 9))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.count_repeats(table(spark, sf_dir, "documents")).drop("text_hash")


def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_forest.neighbours_of(table(spark, sf_dir, "embeddings"), every=100)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trips(table(spark, sf_dir, "documents"), vocabulary())


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.predict_languages(docs, vocabulary(), remainder(4)).drop("text_hash")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = best_fit_packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.drop("source", "cluster")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feast_whitening.whiten(table(spark, sf_dir, "embeddings"), most=32)


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_fingerprints.with_neighbours(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_quality_rules,
            op2_lm_scoring,
            op3_line_dedup,
            op4_license_scan,
            op5_substring_dedup,
            op6_simhash_dedup,
            op7_nearest_neighbours,
            op8_sentencepiece,
            op9_language_id,
            op10_best_fit_packing,
            op11_filter_audit,
            op12_embedding_whitening,
            op13_document_fingerprints,
        )
    }


_WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

_SUBSTRINGS = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
windows AS (
    SELECT r, i, array_to_string(w[i:i + 34], ' ') AS words
    FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)),
often AS (SELECT words FROM windows GROUP BY words HAVING count(*) > 1),
gone AS (
    SELECT r, list(DISTINCT i + k) AS places
    FROM (SELECT r, i FROM windows SEMI JOIN often USING (words)), range(35) offsets(k) GROUP BY r),
places AS (SELECT r, unnest(places) AS place FROM gone),
words AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM docs),
kept AS (
    SELECT r, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n
    FROM words ANTI JOIN places USING (r, place) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""


def _licenses() -> str:
    rows = [
        f"('{name}', [{', '.join(repr(b) for b in sorted(license_scan.bigrams(text)))}])"
        for name, text in sorted(license_scan.TEMPLATES.items())
    ]
    return rf"""
WITH templates(license, own) AS (VALUES {', '.join(rows)}),
units AS (
    SELECT doc_id, text AS body, 0 AS unit FROM documents
    UNION ALL
    SELECT doc_id, unnest(lines), unnest(range(1, len(lines) + 1))
    FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE contains(text, chr(10)))),
words AS (SELECT doc_id, unit, regexp_extract_all(lower(body), '[a-z0-9]+') AS w FROM units),
sets AS (
    SELECT doc_id, unit, list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) AS b
    FROM words WHERE len(w) > 1),
compared AS (
    SELECT doc_id, unit, license, 2.0::DOUBLE * len(list_intersect(b, own)) / (len(b) + len(own)) AS dice
    FROM sets, templates WHERE len(b) * 3 >= len(own) * 1.9 AND len(own) * 3 >= len(b) * 1.9)
SELECT doc_id, unit::INTEGER AS unit, license, round(dice, 9) AS dice
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, unit ORDER BY dice DESC, license) AS place
    FROM compared WHERE dice >= 0.8) WHERE place = 1
"""


_FILTER_AUDIT = rf"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
named AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
failed AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]+', '', 'g')) > 10 * length(body) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY body) THEN 'E' ELSE '' END AS f
    FROM docs LEFT JOIN named USING (doc_id)),
cells AS (
    SELECT part, f, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS t
    FROM failed GROUP BY part, f),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
    SELECT filter_order, step, filter_order[step] AS letter,
        CASE WHEN step = 1 THEN '^$a' ELSE '[' || filter_order[1:step - 1] || ']' END AS before
    FROM orders, range(1, 6) numbers(step)),
rows AS (
    SELECT part, filter_order, step, letter, n, g, t, contains(f, letter) AS fails,
        regexp_matches(f, before) AS gone, f = letter AS only_here
    FROM cells, steps),
counted AS (
    SELECT part, filter_order, step, letter,
        sum(n) FILTER (NOT gone AND NOT fails) AS kept, sum(n) FILTER (fails AND NOT gone) AS removed,
        sum(n) FILTER (fails AND gone) AS redundant, sum(n) FILTER (only_here) AS unique_fails,
        sum(g) FILTER (fails AND NOT gone) AS good_lost, sum(t) FILTER (fails AND NOT gone) AS toxic_lost
    FROM rows GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept,
    coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
    coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
    coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
    coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::BIGINT AS shapley
FROM counted
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_license_scan": _licenses(),
        "op5_substring_dedup": _SUBSTRINGS,
        "op11_filter_audit": _FILTER_AUDIT,
    }

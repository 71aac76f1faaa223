"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import alignment, ann, langid, mixing, neardup, ngrams, packing, periods, quality, suffixes, tokens, topk, warc
from ledgerlens.llm.common import n_words


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(table(spark, sf_dir, "documents"), tokenizer_path()).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def op3_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op4_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.learn_and_score(table(spark, sf_dir, "documents"), min_count=ngrams.ALL)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", n_words(F.col("text")).alias("n_words"))
    return packing.pack(docs, "n_words")


def op7_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op8_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(table(spark, sf_dir, "documents"), with_text=True)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.with_quality(
        table(spark, sf_dir, "documents").select("doc_id", "text", "source"), table(spark, sf_dir, "labels"))
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = langid.fit(docs, langid.held_out_column())
    return langid.identify(docs.select("doc_id", "text"), models).select(
        "doc_id", langid.held_out_column().alias("held_out"),
        F.col("predicted.lang").alias("lang_pred"), F.col("predicted.score").alias("score"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digest(table(spark, sf_dir, "documents"))


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.digest(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_token_files": op2_token_files,
    "op3_permutation_index": op3_permutation_index,
    "op4_ngram_trie": op4_ngram_trie,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_packing": op6_packing,
    "op7_threshold_topk": op7_threshold_topk,
    "op8_suffix_repeats": op8_suffix_repeats,
    "op9_mixing": op9_mixing,
    "op10_language_id": op10_language_id,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_quality": op13_quality,
}

OP1_SQL = r"""
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest
    FROM pages
), f AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest)
              ELSE page_id END AS first
    FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""

OP7_SQL = r"""
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
    FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP9_SQL = r"""
WITH best AS (
    SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), sized AS (
    SELECT d.doc_id, d.source,
           CAST(coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           -ln((CAST('0x' || substr(md5(CAST(d.doc_id AS VARCHAR) || '|7'), 1, 13) AS BIGINT) + 0.5)
               / 4503599627370496.0::DOUBLE)
             / CASE WHEN b.quality = 1 THEN 2.0 WHEN b.quality = 0 THEN 0.5 ELSE 1.0 END::DOUBLE AS k
    FROM documents d LEFT JOIN best b USING (doc_id)
), per AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS n FROM per
), capped AS (
    SELECT *, CASE (n - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS w,
           3 * source_size AS cap FROM weighed
), levels AS (
    SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER f, 0))::DOUBLE
              / (sum(w) OVER () - coalesce(sum(w) OVER f, 0))::DOUBLE AS level
    FROM capped
    WINDOW f AS (ORDER BY cap / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), final AS (
    SELECT arg_min(level, cap / w) AS level FROM levels WHERE level * w <= cap
), targets AS (
    SELECT c.source, c.source_size, least(c.cap::DOUBLE, final.level * c.w) AS target
    FROM capped c, final
), placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.target,
           coalesce(floor(t.target / nullif(t.source_size, 0)), 0) AS epochs,
           sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (epochs + CASE WHEN 2 * upto - size <= 2 * (target - epochs * source_size)
                             THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

ORACLES: dict[str, str] = {"op1_warc": OP1_SQL, "op7_threshold_topk": OP7_SQL, "op9_mixing": OP9_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    return dict(ORACLES)

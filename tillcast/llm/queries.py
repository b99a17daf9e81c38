"""The operators as queries over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm import (
    bagminhash,
    bytebpe,
    extract,
    langid,
    lexical,
    mixing,
    negatives,
    pii,
    piece,
    quality,
    topk,
    toxicity,
    warc,
)
from tillcast.llm.common import table

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_RANKS = "byte_bpe_50k.tiktoken"


def piece_model() -> bytes:
    import public_tokenizers

    return piece.read_model(public_tokenizers.path(PIECE_MODEL))


def q_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_report(table(spark, sf_dir, "documents"))


def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, sf_dir, "pages"))


def q_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract_text(table(spark, sf_dir, "pages"))


def q_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def q_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece.encode_digests(table(spark, sf_dir, "documents"), piece_model())


def q_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_classes(table(spark, sf_dir, "documents"))


def q_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def q_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def q_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def q_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved))


def q_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def q_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bytebpe.read_ranks(public_tokenizers.path(BYTE_RANKS))
    return bytebpe.encode_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": q_pii,
    "op2_warc": q_warc,
    "op3_quality": q_quality,
    "op4_extract": q_extract,
    "op5_sentencepiece": q_sentencepiece,
    "op6_bagminhash": q_near_duplicates,
    "op7_language": q_language,
    "op8_topk": q_topk,
    "op9_mixing": q_mixing,
    "op10_toxicity": q_toxicity,
    "op11_negatives": q_negatives,
    "op12_lexical": q_lexical,
    "op13_byte_bpe": q_byte_bpe,
}

MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    coalesce(md5(text), '') AS digest
  FROM documents
), keyed AS (
  SELECT *, md5(concat(coalesce(doc_id::VARCHAR, ''), ':', size::VARCHAR, ':', digest)) AS key FROM sized
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0 ELSE 2.0 END AS weight,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn
  FROM per_source
), ranked AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS ratio,
    sum(source_size) OVER () * 1.5::DOUBLE AS total
  FROM weighed
), leveled AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM ranked
), final AS (
  SELECT *, max(CASE WHEN level <= ratio THEN level END) OVER () AS lvl FROM leveled
), targets AS (
  SELECT source, source_size, turn, (CASE WHEN lvl IS NULL THEN cap ELSE least(cap, lvl * weight) END)::DOUBLE AS target FROM final
), placed AS (
  SELECT k.doc_id, k.size, t.source_size, t.target, t.turn,
    coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS whole
  FROM keyed k JOIN targets t ON k.source IS NOT DISTINCT FROM t.source
), dealt AS (
  SELECT *, (whole * size + greatest(0, least(size, floor(target)::BIGINT - whole * source_size - before)))::BIGINT AS taken FROM placed
), passed AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE ceil(taken / size) END AS passes,
    CASE turn WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 1.0 ELSE 1.5 END AS w0,
    CASE turn WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 1.0 ELSE 0.5 END AS w1 FROM dealt
), shares AS (
  -- share of the source's demand met at the middle of the first and of the last pass
  SELECT *, least(1, (before + size / 2) / target)::DOUBLE AS s0,
    least(1, ((passes - 1) * source_size + before + size / 2) / target)::DOUBLE AS s1
  FROM passed
)
SELECT doc_id, size, source_size, target, taken,
  -- the weight runs linearly from w0 to w1, so its integral is quadratic in time
  CASE WHEN passes > 0 THEN round(CASE WHEN turn = 1 THEN s0 ELSE (sqrt(w0 * w0 + (w1 * w1 - w0 * w0) * s0) - w0) / (w1 - w0) END, 9) END AS first_position,
  CASE WHEN passes > 0 THEN round(CASE WHEN turn = 1 THEN s1 ELSE (sqrt(w0 * w0 + (w1 * w1 - w0 * w0) * s1) - w0) / (w1 - w0) END, 9) END AS last_position
FROM shares
"""

WARC_SQL = """
WITH held AS (
  SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages
), firsts AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload) AS first FROM held
)
SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM firsts
"""

TOPK_SQL = """
WITH usable AS (
  SELECT vec_id, row_number() OVER () AS uid, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, uid, unnest(range(len(embedding))) AS i, unnest(embedding) AS x FROM usable
), whole AS (
  SELECT vec_id, uid, i, floor(256 * x::DOUBLE)::BIGINT AS n FROM parts
), scored AS (
  SELECT q.vec_id AS query_id, q.uid AS query_uid, c.vec_id, c.uid, sum(q.n * c.n)::BIGINT AS score
  FROM whole q JOIN whole c ON q.i = c.i AND q.uid <> c.uid
  WHERE q.vec_id % 50 = 0 GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_uid ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

NEGATIVES_SQL = """
WITH usable AS (
  SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
    row_number() OVER () AS uid, embedding
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT uid, unnest(range(len(embedding))) AS i, unnest(embedding) AS x FROM usable
), whole AS (
  SELECT uid, i, floor(256 * x::DOUBLE)::BIGINT AS n FROM parts
), products AS (
  SELECT a.uid AS a_uid, c.uid AS c_uid, sum(q.n * w.n)::BIGINT AS score
  FROM usable a JOIN whole q ON q.uid = a.uid JOIN whole w ON w.i = q.i AND w.uid <> q.uid JOIN usable c ON c.uid = w.uid
  WHERE a.vec_id % 100 = 0 GROUP BY ALL
), scored AS (
  SELECT p.*, a.vec_id AS anchor_id, a.label AS a_label, c.vec_id, c.label
  FROM products p JOIN usable a ON a.uid = p.a_uid JOIN usable c ON c.uid = p.c_uid
), positives AS (
  SELECT *, row_number() OVER (PARTITION BY a_uid ORDER BY score DESC, vec_id) AS nth FROM scored WHERE label = a_label
), negatives AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, n.vec_id AS negative_id, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.a_uid, p.nth ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positives p JOIN scored n ON n.a_uid = p.a_uid AND n.label <> n.a_label
  WHERE p.nth <= 5 AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""

LEXICAL_SQL = r"""
WITH doc_rows AS (
  SELECT row_number() OVER () AS uid, doc_id, text FROM documents
), doc_terms AS (
  SELECT uid, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM doc_rows
), item_rows AS (
  SELECT row_number() OVER () AS item, item_id, text FROM benchmark
), item_terms AS (
  SELECT item, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM item_rows
), lengths AS (
  SELECT uid, doc_id, count(*) AS n FROM doc_terms GROUP BY ALL
), totals AS (
  SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM lengths
), counts AS (
  SELECT uid, term, count(*) AS tf FROM doc_terms GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, totals GROUP BY term
), gains AS (
  SELECT c.uid, c.term, (w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * big_n) // big_l))))::BIGINT AS gain
  FROM counts c JOIN weights USING (term) JOIN lengths USING (uid), totals
), scored AS (
  SELECT i.item, i.item_id, g.uid, sum(g.gain)::BIGINT AS score FROM item_terms i JOIN gains g USING (term) GROUP BY ALL
), ranked AS (
  SELECT s.item_id, l.doc_id, s.score, row_number() OVER (PARTITION BY s.item ORDER BY s.score DESC, l.doc_id NULLS LAST) AS rank
  FROM scored s JOIN lengths l USING (uid) WHERE s.score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op2_warc": WARC_SQL,
    "op8_topk": TOPK_SQL,
    "op9_mixing": MIXING_SQL,
    "op11_negatives": NEGATIVES_SQL,
    "op12_lexical": LEXICAL_SQL,
}

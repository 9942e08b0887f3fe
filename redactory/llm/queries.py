"""The registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from redactory.session import scratch_path

from .byte_bpe import encode_digests
from .common import table
from .context_trees import score_texts
from .lexical_search import ranked_search
from .mixing import mix
from .personal_data import personal_data, texts_of
from .quality import quality
from .simhash import near_duplicates
from .suffix_dedup import remove_repeats
from .token_alignment import align_tokenizers
from .token_counts import count_tokens
from .token_files import token_index, write_tokens
from .top_k import top_k
from .toxicity import toxicity

CONTEXT = 1024
END_ID = 2


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), length=100).drop("kept")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), radius=2, words_each=3)
    return found.select("doc_id", "fingerprint", "component_id")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_digests(documents, ranks, public_tokenizers.PATTERN)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, taken = mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5)
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return count_tokens(
        documents, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, limit=CONTEXT
    )


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), k=10, is_query="vec_id % 100 = 0")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_email",
        "n_ip",
        "n_card",
        "n_phone",
        F.sha2(F.expr(texts_of("base")), 256).alias("base_sha256"),
        F.expr(texts_of("spans")).alias("spans"),
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), folder, END_ID)
    return token_index(spark, folder)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align_tokenizers(table(spark, sf_dir, "documents"), *files)


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 10 == 0
    return score_texts(table(spark, sf_dir, "documents"), held_out)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_simhash": op2_simhash,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_mixing": op4_mixing,
    "op5_token_counts": op5_token_counts,
    "op6_top_k": op6_top_k,
    "op7_personal_data": op7_personal_data,
    "op8_token_files": op8_token_files,
    "op9_toxicity": op9_toxicity,
    "op10_quality": op10_quality,
    "op11_token_alignment": op11_token_alignment,
    "op12_language_model": op12_language_model,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL = {
    "op4_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS no
  FROM d GROUP BY source
), w AS (
  SELECT *, CAST([3, 1, 2][1 + (no - 1) % 3] AS DOUBLE) AS weight, CAST(source_size AS DOUBLE) * 2 AS cap FROM s
), l AS (
  SELECT *, ((SELECT sum(source_size) FROM s) * 1.5::DOUBLE
    - coalesce(sum(cap) OVER (ORDER BY cap / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), t AS (
  SELECT source, source_size, CASE WHEN cap < level * weight THEN cap ELSE weight *
    (SELECT arg_min(level, (cap / weight, no)) FROM l WHERE NOT cap < level * weight) END AS target
  FROM l
), p AS (
  SELECT doc_id, size, source_size, target, least(CAST(floor(target + 0.5) AS BIGINT), 2 * source_size) AS quota,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, CAST(greatest(0, least(a + size, quota) - a)
  + greatest(0, least(a + size, quota - source_size) - a) AS BIGINT) AS taken
FROM p
""",
    "op6_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
""",
    "op13_lexical_search": r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS terms
  FROM documents
), q AS (
  SELECT item_id, row_number() OVER () AS item, list_distinct(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+')) AS terms
  FROM benchmark
), c AS (
  SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d WHERE len(terms) > 0
), f AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM d) GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM f, c GROUP BY term, docs
), s AS (
  SELECT item, row, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len(d.terms) * docs) // total)))) AS BIGINT) AS score
  FROM (SELECT item, unnest(terms) AS term FROM q) JOIN f USING (term) JOIN w USING (term) JOIN d USING (row), c
  GROUP BY item, row
), r AS (
  SELECT item, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
  FROM s JOIN d USING (row) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r JOIN q USING (item) WHERE rank <= 10
""",
}

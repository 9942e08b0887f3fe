"""A training corpus from ``documents``: stages that each call one operator of ``redactory.llm``.

For every stage: null texts are empty, texts of any length are handled whole, ids may be null, repeated or of any type
that sorts, every row is a document of its own, further columns stay as they are, and an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from redactory.llm import simhash
from redactory.llm.byte_bpe import encode_bytes
from redactory.llm.common import fresh, keyed, table, written
from redactory.llm.mixing import mix
from redactory.llm.personal_data import masked, personal_data
from redactory.llm.toxicity import fit, learning_rows, score


def packed(docs: DataFrame) -> DataFrame:
    """``_key, doc_id, text, source, doc``: whole rows as structs, so no column of theirs meets one that a stage adds."""
    return keyed(docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 stay, empty ones too. A score depends on the text alone, so rows of equal texts stay
    or go together; without labels of both kinds no document goes, unless all labels are toxic."""
    model = fit(learning_rows(docs, table(spark, sf_dir, "labels"), "toxic"))
    name = fresh(docs, "score")
    return score(docs, model, keep=docs.columns, name=name).where(F.col(name) < 0.5).drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents whose fingerprints of three-word shingles hang together by two differing bits or fewer, the one of
    smallest id stays; null and repeated ids are ordered as in ``keyed``. Texts without words are one group."""
    rows = packed(docs)
    found = simhash.near_duplicates(rows, radius=2, words_each=3, key="_key")
    gone = written(found.where("component_id <> _key").select("_key"), "gone")
    return rows.join(gone, "_key", "left_anti").select("doc.*")


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to the name of their kind in angle brackets; ``n_chars`` follows the new text. Documents
    without any, null texts among them, stay as they are."""
    rows = packed(docs)
    found = personal_data(rows, keep_columns=("_key",)).where(F.size("spans") > 0).select("_key", "spans")
    rows = rows.join(written(found, "found"), "_key", "left")
    rows = rows.withColumn("clean", F.expr(f"CASE WHEN spans IS NOT NULL THEN {masked('text', 'spans')} END"))
    changed = F.col("doc").withField("text", F.col("clean")).withField("n_chars", F.length("clean").cast("long"))
    return rows.select(F.when(F.col("clean").isNull(), F.col("doc")).otherwise(changed).alias("doc")).select("doc.*")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once for each turn in which the mix takes words of it; documents that it does not reach, and
    those without words, go. Documents are not cut, so a source is over its target by less than one document a turn."""
    rows = packed(docs)
    _, taken = mix(rows, key="_key")
    turns = taken.where("taken > 0").select("_key", F.ceil(F.col("taken") / F.col("size")).alias("turns"))
    # A merge at every size: a few turns would be broadcast, many would not, and the stage would not grow with its input.
    rows = rows.join(written(turns, "turns").hint("merge"), "_key")
    return rows.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("turns")))).select("doc.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, token_ids, n_tokens``."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_bytes(docs, ranks, public_tokenizers.PATTERN).drop("decoded")


STAGES = [
    ("toxicity", toxicity),
    ("simhash", near_duplicates),
    ("personal_data", private),
    ("mixing", mixing),
    ("byte_bpe", tokens),
]
#: SQL cannot express a trained classifier; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what each one keeps is written as Parquet and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

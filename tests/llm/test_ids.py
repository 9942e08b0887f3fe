"""Ids that are not whole numbers: no row is lost, order is that of the ids."""

import random
from decimal import Decimal

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from redactory.llm.common import written
from redactory.llm.personal_data import personal_data
from redactory.llm.simhash import near_duplicates
from redactory.llm.suffix_dedup import remove_repeats
from redactory.llm.token_files import token_index, write_tokens
from redactory.session import scratch_path

TEXT = "".join(random.Random(1).choices("abcdefgh ", k=300))
IDS = {
    "double": [1.2, 1.7, 2.0],
    "decimal(5,1)": [Decimal("1.2"), Decimal("1.7"), Decimal("2.0")],
    "string": ["a", "b", "c"],
    "decimal(30,0)": [Decimal(10**25), Decimal(10**25 + 1), Decimal(10**26)],
}


@pytest.fixture(params=IDS)
def docs(spark, request):
    ids = IDS[request.param]
    rows = list(zip(ids, [TEXT, TEXT, "write to ann@example.org now"], ["s", "s", None]))
    schema = f"doc_id {request.param}, text string, source string"
    return ids, spark.createDataFrame(rows, schema).withColumn("n_chars", F.length("text").cast("long"))


def test_operators(spark, docs):
    ids, df = docs
    removed = {r["doc_id"]: r["n_removed"] for r in remove_repeats(df).collect()}
    assert removed == {ids[0]: 0, ids[1]: 300, ids[2]: 0}
    linked = {r["doc_id"]: r["component_id"] for r in near_duplicates(df, words_each=3).collect()}
    assert linked == {ids[0]: ids[0], ids[1]: ids[0], ids[2]: ids[2]}
    assert {r["doc_id"]: r["n_email"] for r in personal_data(df).collect()} == {ids[0]: 0, ids[1]: 0, ids[2]: 1}
    folder = scratch_path(spark, "tokens")
    write_tokens(df, public_tokenizers.path("word_bpe_49k.json"), folder, 2)
    starts = {r["doc_id"]: r["start"] for r in token_index(spark, folder).collect()}
    assert starts.keys() == set(ids) and starts[ids[0]] == 0 < starts[ids[1]] < starts[ids[2]]


def test_stages(spark, docs, tmp_path):
    ids, df = docs
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    labels.withColumn("doc_id", F.lit(None).cast(df.schema["doc_id"].dataType)).write.parquet(f"{tmp_path}/labels.parquet")
    clean = written(corpus_pipeline.toxicity(spark, df, str(tmp_path)), "t")
    assert {r["doc_id"] for r in clean.collect()} == set(ids)
    single = written(corpus_pipeline.near_duplicates(spark, clean, str(tmp_path)), "t")
    assert {r["doc_id"] for r in single.collect()} == {ids[0], ids[2]}
    private = written(corpus_pipeline.private(spark, single, str(tmp_path)), "t")
    assert {r["doc_id"]: r["text"] for r in private.collect()} == {ids[0]: TEXT, ids[2]: "write to <email> now"}
    mixed = written(corpus_pipeline.mixing(spark, private, str(tmp_path)), "t")
    assert {r["doc_id"] for r in mixed.collect()} <= {ids[0], ids[2]} and mixed.count()
    assert corpus_pipeline.tokens(spark, mixed, str(tmp_path)).count() == mixed.count()

"""Lists of a million bytes and more in streams, streams of files that were dealt out before, texts with few and many terms."""

import re

from pyspark.sql import functions as F

from redactory import Policy
from redactory.functions.listed import FEW
from redactory.operators import detect
from redactory.operators.findings import findings
from redactory.session import dealt
from redactory.streaming.jobs import anonymize_stream, file_stream


def test_stream_with_a_list_of_over_four_megabytes(spark, tmp_path):
    n = 130_000
    lexicon = spark.range(n).select(
        F.format_string("Supplier#%09d", "id").alias("term"), F.lit("ORG").alias("entity"), F.lit(0.85).alias("score")
    )
    assert n * (18 + 16) > 4 << 20
    rows = [(1, f"from Supplier#{n - 1:09d} and Supplier#000000007."), (2, f"from Supplier#{n:09d}"), (3, None)]
    spark.createDataFrame(rows, "n int, t string").write.parquet(f"{tmp_path}/in")
    policy = Policy.default().only().with_listed(lexicon)
    out = f"{tmp_path}/out"
    anonymize_stream(file_stream(spark, f"{tmp_path}/in", "*.parquet"), policy, out, f"{tmp_path}/state").awaitTermination()
    got = {r["n"]: r["t"] for r in spark.read.parquet(out).collect()}
    masked = got.pop("1")
    assert got == {"2": rows[1][1], "3": None}
    assert "000129999" not in masked and "000000007" not in masked and masked.startswith("from ")


def test_stream_of_files_dealt_out_by_the_same_key(spark, tmp_path):
    dealt(spark.range(800), "id").write.parquet(f"{tmp_path}/in")
    n_files = len(list((tmp_path / "in").glob("part-*")))
    stream, out = dealt(file_stream(spark, f"{tmp_path}/in", "*.parquet", files_per_batch=1), "id"), f"{tmp_path}/out"
    writer = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/state")
    writer.trigger(availableNow=True).start(out).awaitTermination()
    rows = spark.read.parquet(out)
    assert sorted(r.id for r in rows.collect()) == list(range(800))
    # Before, the rows of a file met in one task.
    assert rows.selectExpr("input_file_name() AS f").distinct().count() > 2 * n_files


def test_few_and_many_terms_are_found_alike(spark):
    terms = {"Ann Lee": 0.9, "Lee": 0.8, "#7": 0.7, "é": 0.6}
    one = "Ann Lee, Lee #7 é - x Leeé Ann  Lee \U0001f600 "
    texts = [one * k + "end" for k in (1, 2, 3, FEW, 40)] + [" Lee" * (FEW + d) for d in (-1, 0, 1)] + ["no one", "", None]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = findings(frame, ["id"], "text", [detect.Recognizer("X", terms=tuple(terms.items()))]).collect()
    longest = "|".join(map(re.escape, sorted(terms, key=len, reverse=True)))
    want = [
        (i, m.start(), m.end(), terms[m.group()], m.group())
        for i, t in enumerate(texts) for m in re.finditer(rf"(?<!\w)(?:{longest})(?!\w)", t or "")
    ]
    assert sorted((r["id"], r["start"], r["end"], r["score"], r["value"]) for r in rows) == sorted(want)

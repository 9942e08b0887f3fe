"""The lexicon join beyond the broadcast limit: what is shuffled, and how hot words are dealt out."""

from pyspark.sql import functions as F

from redactory.operators import lexicon as L
from redactory.operators.lexicon import lexicon_findings, possible_words, split_join


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_possible_words_pass(spark):
    words = spark.range(50_000).selectExpr("id", "concat('w', id % 20000) AS head")
    terms = spark.range(2_000).selectExpr("concat('w', id * 7) AS head")
    kept = possible_words(words, terms, 2_000)
    listed = words.join(terms, "head", "left_semi").select(*words.columns)
    assert listed.exceptAll(kept).count() == 0
    assert kept.count() < listed.count() + 0.06 * words.count()
    shuffles = [line for line in plan(kept).splitlines() if "Exchange hashpartitioning" in line]
    assert all("__block" in line for line in shuffles) and "BroadcastHashJoin" in plan(kept)
    assert possible_words(words, terms.limit(0), 0).count() == 0


def test_few_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_BLOCKS", 2)
    words = spark.range(3_000).selectExpr("concat('w', id) AS head")
    terms = spark.range(1_000).selectExpr("concat('w', id * 3) AS head")
    assert words.join(terms, "head", "left_semi").exceptAll(possible_words(words, terms, 1_000)).count() == 0


def test_hot_words_are_split(spark):
    hot = F.expr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('w', id) END")
    words = spark.range(9_000).select("id", F.lit(0).alias("start"), hot.alias("head"))
    terms = spark.createDataFrame([("hot", 1), ("hot", 2), ("w1", 3)], "head string, n int")
    joined = split_join(words, terms, ["id"], split_rows=400)
    assert joined.count() == 6_001 and joined.where("head = 'hot'").select("id").distinct().count() == 3_000
    assert "salt" in plan(joined) and "salt" not in plan(split_join(words, terms, ["id"]))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # small partitions would be put together again
    sizes = split_join(words, terms, ["id"], split_rows=400).where("head = 'hot' AND n = 1").groupBy(F.spark_partition_id()).count().collect()
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) >= 4 and max(r["count"] for r in sizes) < 1_600


def test_split_and_whole_joins_agree(spark):
    texts = ["Al met Al and Ann Lee of Oslo" for _ in range(60)] + ["nobody", "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    terms = [("Al", "P", 0.5), ("Al", "P", 0.9), ("Ann Lee", "P", 0.8), ("Oslo", "L", 1.0), ("Rome", "L", 1.0)]
    lexicon = spark.createDataFrame(terms, "term string, entity string, score double")
    rows = lambda **options: sorted(map(tuple, lexicon_findings(df, ["id"], "text", lexicon, **options).collect()))
    assert rows() == rows(broadcast_limit=0) == rows(broadcast_limit=0, split_rows=7) and len(rows()) == 240

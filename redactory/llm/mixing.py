"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame expressions only.

Every source is a stream of words: its documents in an order shuffled by a hash, one after the other, begun
again when it ends. The stream is cut into blocks of equally many words. The mix is a row of slots; van der
Corput points, mapped through the cumulative numbers of blocks, say which source fills a slot: bit reversal is
a permutation of the slots, so each source gets exactly its blocks, spread as evenly as the points are. The
r-th slot of a source takes its r-th block, and blocks are joined with the pieces of documents that they hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, text_or_empty, written

BLOCK_WORDS = 1_024
#: Slots, and documents, that are ranked together.
RANKED = 65_536
#: A source never gives more than this many times its words.
REPEATS = 2


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(f"{WORD}+"))


def targets(sources: DataFrame, weights: Sequence[float], share: float) -> DataFrame:
    """``source, source_no, source_size, target`` from ``source, source_size``.

    Sources in the order of code points, null last, take the weights in turn and share ``share`` of all words.
    No target is above ``REPEATS`` times the source's words; the excess goes to the others by weight until
    none is above. Sources are capped in the order of size per weight, so one pass in that order finds all:
    a source is capped if what those before it leave, dealt out by weight to it and those after, is too much.
    One row per source is ranked in one place.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*[F.lit(float(w)) for w in weights])[(F.col("source_no") - 1) % len(weights)]
    rows = sources.withColumn("source_no", F.row_number().over(named)).withColumn("weight", turn)
    rows = rows.withColumn("cap", F.col("source_size").cast("double") * REPEATS)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything)
    rows = rows.withColumn("level", (total * share - before) / left)
    rows = rows.withColumn("capped", F.col("cap") < F.col("level") * F.col("weight"))
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "source_no", "level"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(level["level"] * F.col("weight"))
    return rows.select("source", "source_no", "source_size", target.alias("target"))


def streams(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` (with ``source_no, size``) and ``first``, the place of their first word in the stream of their source.

    Documents are dealt out by the beginning of a hash of their key; sums over these parts shift the ranks
    inside them, so no source is ranked in one place.
    """
    n = docs.count()
    digits = 1
    while 16**digits * RANKED < n * 16 and digits < 12:
        digits += 1
    hashed = docs.withColumn("_hash", F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")))
    hashed = hashed.withColumn("_part", F.substring("_hash", 1, digits))
    inner = Window.partitionBy("source_no", "_part").orderBy("_hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy("source_no").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = hashed.groupBy("source_no", "_part").agg(F.sum("size").alias("_n"))
    shifts = shifts.select("source_no", "_part", F.coalesce(F.sum("_n").over(outer), F.lit(0)).alias("_shift"))
    placed = hashed.withColumn("_inner", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    placed = placed.join(shifts, ["source_no", "_part"]).withColumn("first", F.col("_inner") + F.col("_shift"))
    return placed.drop("_hash", "_part", "_inner", "_shift")


def schedule(quotas: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """``slot, source_no, block_no``: every slot of the mix, from ``source_no, quota`` (words)."""
    ahead = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    blocks = quotas.where("quota > 0").withColumn("blocks", F.ceil(F.col("quota") / block))
    blocks = blocks.withColumn("low", F.coalesce(F.sum("blocks").over(ahead), F.lit(0)))
    total = blocks.agg(F.coalesce(F.sum("blocks"), F.lit(0))).first()[0]
    bits = max(1, int(total - 1).bit_length() if total else 1)
    stretch = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1, F.lit(RANKED).cast("long")))
    stretches = blocks.withColumn("at", stretch).repartition("source_no", "at")
    within = F.sequence(F.col("at"), F.least(F.col("at") + RANKED, F.col("blocks")) - 1)
    points = stretches.select("source_no", "low", F.explode(within).alias("block"))
    point = F.bin(F.col("low") + F.col("block"))
    reverse = F.conv(F.reverse(F.lpad(point, bits, "0")), 2, 10).cast("long")
    slots = points.select("source_no", reverse.alias("order"))
    slots = slots.withColumn("part", F.floor(F.col("order") / RANKED))
    counts = slots.groupBy("source_no", "part").agg(F.count("*").alias("n"))
    outer = Window.partitionBy("source_no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("source_no", "part", F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("shift"))
    rank = F.row_number().over(Window.partitionBy("source_no", "part").orderBy("order"))
    ranked = slots.withColumn("rank", rank).join(shifts, ["source_no", "part"])
    return ranked.select(
        F.col("order").alias("slot"), "source_no", (F.col("rank") + F.col("shift") - 1).cast("long").alias("block_no")
    )


def pieces(docs: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """What each document (``source_no, first, size``, its source's ``source_size, quota``) has in each block:
    ``source_no, block_no, first, from_word, words``; words beyond the quota are left out."""
    turns = F.explode(F.array(*[F.lit(i) for i in range(REPEATS)]))
    rows = docs.where("size > 0").withColumn("_turn", turns)
    rows = rows.withColumn("_a", F.col("first") + F.col("_turn") * F.col("source_size"))
    rows = rows.withColumn("_b", F.least(F.col("_a") + F.col("size"), F.col("quota"))).where("_a < _b")
    blocks = F.sequence(F.floor(F.col("_a") / block), F.floor((F.col("_b") - 1) / block))
    rows = rows.withColumn("block_no", F.explode(blocks))
    low, high = F.greatest(F.col("_a"), F.col("block_no") * block), F.least(F.col("_b"), (F.col("block_no") + 1) * block)
    return rows.select("source_no", "block_no", "first", (low - F.col("_a")).alias("from_word"), (high - low).alias("words"))


def mix(
    df: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """The mix, and what it takes of every document.

    First: ``slot, source_no, block_no, first, from_word, words``, the pieces of documents in the order of
    slots. Second, for every row of ``df``: ``key, source, source_no, size, source_size, target, first, taken``.
    Size is the number of words (null text: 0). A source gives its target, rounded to whole words, so sources
    of a few words come as near as whole words allow; no row gives more than ``REPEATS`` times its size. The
    order depends on keys only (of equal keys, on sizes): reruns agree. Keys and sources may be null, keys may
    be repeated. Rows without words are not taken. An empty table gives an empty mix.
    """
    sizes = df.select(F.col(key).alias("_key"), F.col(source).alias("source"), word_count(text).cast("long").alias("size"))
    sizes = written(sizes, "sizes")
    sources = targets(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share)
    quota = F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * REPEATS)
    sources = written(sources.withColumn("quota", quota), "sources")
    named = sources.withColumnRenamed("source", "_source")
    docs = sizes.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    docs = written(streams(docs, "_key"), "streams")
    schedule_ = schedule(sources.select("source_no", "quota"))
    # Both sides grow with the table; the hint keeps Spark from broadcasting one on the size of its compressed files.
    mixed = written(schedule_.join(pieces(docs).hint("merge"), ["source_no", "block_no"]), "mix")
    taken = mixed.groupBy("source_no", "first").agg(F.sum("words").alias("_taken"))
    taken = taken.withColumnsRenamed({"source_no": "_no", "first": "_first"})
    matches = (F.col("source_no") == F.col("_no")) & (F.col("first") == F.col("_first")) & (F.col("size") > 0)
    rows = docs.join(taken.hint("merge"), matches, "left").withColumn("taken", F.coalesce("_taken", F.lit(0)))
    columns = ["source", "source_no", "size", "source_size", "target", "first", "taken"]
    return mixed, rows.select(F.col("_key").alias(key), *[c for c in columns if c != key])

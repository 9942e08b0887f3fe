"""Word and phrase lists held in tables: names, places, deny lists of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.spans import NO_SPANS, read_around, regex_spans
from ..functions.text import Sql, case, each, let, lit, struct
from ..functions.text import column as quoted
from ..session import written
from .detect import WORD

BROADCAST_LIMIT = 64 * 1024 * 1024
#: Blocks of the filter of possible words, 64 bits each: at most 16 MB of bits, whatever the list.
MAX_BLOCKS = 1 << 21
HEADS_PER_BLOCK = 6
#: Occurrences of one word that a partition of the join should get at most, and words that may be split.
SPLIT_ROWS = 1_000_000
MOST_SPLIT = 256


def _tokens(text: Sql, reach: int, back: int) -> Sql:
    """Every word of the text as ``struct<start, ahead, behind>``: its offset, the ``reach`` characters
    that start at it, and the ``back`` characters before it."""

    def ahead(words: Sql) -> Sql:
        # Stretched, so that the piece of text read for a block reaches beyond its last word.
        stretched = each(words, lambda w: struct(start=f"{w}.start", end=f"{w}.end + {reach}"))
        first = lambda start: f"greatest(0, {start} - {back})"
        body = lambda s, i, piece, offset: struct(
            start=f"{s}.start",
            ahead=f"substring({piece}, {s}.start - {offset} + 1, {reach})",
            behind=f"substring({piece}, {first(f'{s}.start')} - {offset} + 1, least({s}.start, {back}))",
        )
        return let(stretched, lambda w: read_around(text, w, lambda at: first(f"get({w}, {at}).start"), body))

    empty = "cast(array() AS array<struct<start:int,ahead:string,behind:string>>)"
    return let(regex_spans(text, "", WORD, 0.0), lambda words: case(f"size({words}) > 0", ahead(words), empty))


def possible_words(words: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """The rows of ``words`` whose ``head`` may be one of the heads of ``terms``: all that are, and a few per cent of the
    others (more, where the list has over ``MAX_BLOCKS * HEADS_PER_BLOCK`` heads).

    A Bloom filter in blocks: a head sets four bits in the 64 of its block. The blocks are a relation of bounded size,
    so they are broadcast, and the words are filtered before anything of them is shuffled.
    """
    n_blocks = min(MAX_BLOCKS, n_terms // HEADS_PER_BLOCK + 1)
    block = F.pmod(F.xxhash64("head"), F.lit(n_blocks)).alias("__block")
    bits = " | ".join(f"shiftleft(1L, cast(shiftright(xxhash64(head, 1), {6 * i}) & 63 AS int))" for i in range(4))
    filled = terms.select(block, F.expr(bits).alias("__bits")).groupBy("__block").agg(F.bit_or("__bits").alias("__set"))
    asked = words.select("*", block, F.expr(bits).alias("__bits"))
    return asked.join(F.broadcast(filled), "__block").where("__set & __bits = __bits").select(*words.columns)


def split_join(words: DataFrame, terms: DataFrame, keys: Sequence[str], split_rows: int = SPLIT_ROWS) -> DataFrame:
    """``words`` joined with ``terms`` on ``head`` by shuffle. Words that occur more than ``split_rows`` times, told by a
    sketch, are dealt out over as many partitions as that takes, and their terms repeated; all others stay together."""
    counted = words.agg(F.expr(f"approx_top_k(head, {MOST_SPLIT}, {40 * MOST_SPLIT})").alias("top")).first()["top"]
    splits = {row["item"]: -(-row["count"] // split_rows) for row in counted or [] if row["count"] > split_rows}
    if not splits:
        return words.join(terms.hint("merge"), "head")
    dealt = ", ".join(f"{lit(head)}, {n}" for head, n in splits.items())
    parts = F.expr(f"coalesce(try_element_at(map({dealt}), head), 1)")
    salted = words.withColumn("salt", F.pmod(F.xxhash64(*keys, "start"), parts).cast("int"))
    repeated = terms.withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1)))
    return salted.join(repeated.hint("merge"), ["head", "salt"]).drop("salt")


def lexicon_findings(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    lexicon: DataFrame,
    broadcast_limit: int = BROADCAST_LIMIT,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Findings of the entries of ``lexicon(term, entity, score)`` as whole words in ``column``.

    The texts are cut into words, which are joined with the first word of each term; the rest of a
    longer term, and what it has before that word, are compared afterwards; of repeated terms the
    highest score counts. The lexicon is measured first. Up to ``broadcast_limit`` bytes it is broadcast
    and the texts are not shuffled. A larger one is joined by shuffle: a filter keeps the words that may be
    in the list, these are written to the shared scratch folder with key, offset and the few characters
    that a term can span, and words that occur often are split before the join.
    """
    terms = lexicon.groupBy("term", "entity").agg(F.max(F.col("score").cast("double")).alias("score"))
    terms = terms.withColumn("head", F.regexp_extract("term", WORD, 0))
    terms = terms.withColumn("lead", F.substring("term", F.lit(1), F.expr("locate(head, term) - 1")))
    terms = terms.withColumn("rest", F.expr("substring(term, locate(head, term))"))
    size = terms.agg(
        F.coalesce(F.sum(F.octet_length("term") * 2 + F.octet_length("entity") + 48), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(F.length("rest")), F.lit(0)).alias("longest"),
        F.coalesce(F.max(F.length("lead")), F.lit(0)).alias("lead"),
        F.count_if(F.col("head") == "").alias("wordless"),
        F.count("*").alias("terms"),
    ).first()
    if size["wordless"]:
        raise ValueError(f"{size['wordless']} terms have no letter or digit")
    tokens = _tokens(quoted(column), size["longest"] + 1, size["lead"])
    words = df.select(*keys, F.expr(f"inline({tokens})")).withColumn(
        "head", F.regexp_extract("ahead", WORD, 0)
    )
    if size["bytes"] <= broadcast_limit:
        joined = words.join(F.broadcast(terms), "head")
    else:
        possible = written(possible_words(words, terms, size["terms"]), "words")
        joined = split_join(possible, terms, keys, split_rows)
    after = F.substring(F.col("ahead"), F.length("rest") + 1, F.lit(1))
    whole_word = F.col("ahead").startswith(F.col("rest")) & F.col("behind").endswith(F.col("lead")) & ~after.rlike(WORD)
    return joined.filter(whole_word).select(
        *keys,
        "entity",
        (F.col("start") - F.length("lead")).alias("start"),
        (F.col("start") + F.length("rest")).alias("end"),
        "score",
        F.col("term").alias("value"),
    )


def attach(df: DataFrame, keys: Sequence[str], spans: DataFrame, name: str = "spans") -> DataFrame:
    """Join collected spans back to their rows; rows without any get an empty array."""
    return df.join(spans, list(keys), "left").withColumn(name, F.expr(f"coalesce({quoted(name)}, {NO_SPANS})"))

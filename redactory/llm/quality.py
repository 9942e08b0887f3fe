"""Quality rules whose cutoffs bound the share of good documents that they reject, in DataFrame expressions only.

Fixed limits come first. Further rules compare a measure of the text with a cutoff. For every stratum, rule and
cutoff, labelled documents give the number of good ones and of those among them that the cutoff would reject.
A cutoff is proven if a share of false rejections as high as allowed would make so few rejections improbable,
by the exact binomial distribution; the allowed error is divided by the number of all tests (Bonferroni). The
strictest proven cutoff is used; a rule without one is not used in the stratum.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, text_or_empty, written

WINDOW_WORDS = 8
KIND_WORDS = 200
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Rejects if ``measure`` (an expression over the columns of :func:`measures`) is above a cutoff; cutoffs from
    strict to lenient."""

    name: str
    measure: str
    cutoffs: tuple[float, ...]


RULES = (
    Rule("symbols", "try_divide(n_symbols, word_chars)", (0.02, 0.05, 0.1, 0.2)),
    Rule("marks", "try_divide(n_marks, word_chars)", (0.1, 0.15, 0.2, 0.3)),
    Rule("repeats", "try_divide(n_repeat_words, n_words)", (0.05, 0.1, 0.2)),
    Rule("lines", "try_divide(n_dup_lines, n_lines)", (0.05, 0.1, 0.2, 0.3)),
    Rule("upper", "try_divide(n_upper, word_chars)", (0.2, 0.3, 0.5)),
    Rule("long_words", "try_divide(word_chars, n_words)", (8.0, 10.0, 12.0, 15.0)),
    Rule("few_kinds", "1 - try_divide(n_kinds, n_words)", (0.5, 0.6, 0.7, 0.8)),
)
#: Share of good documents of a stratum that all rules together may reject, and the probability that they reject more.
RISK, ERROR = 0.05, 0.1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def repeat_words(words: Column, size: int = WINDOW_WORDS) -> Column:
    """Words in windows of ``size`` words that the list holds twice or more. Windows are compared by a 64-bit hash;
    they are sorted, so the cost grows with n log n, and only if there is a repeat at all."""
    step = lambda at: F.xxhash64(F.slice(words, at + 1, size))
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - size), step)

    def covered(hashes: Column) -> Column:
        def places(ordered: Column) -> Column:
            def twin(x: Column, i: Column) -> Column:
                before = (i > 0) & (F.get(ordered, i - 1)["h"] == x["h"])
                after = F.get(ordered, i + 1)["h"] == x["h"]
                return F.when(before | F.coalesce(after, F.lit(False)), x["at"])

            return F.sort_array(F.filter(F.transform(ordered, twin), lambda at: at.isNotNull()))

        def add(state: Column, at: Column) -> Column:
            stop = (at + size).cast("int")
            new = (stop - F.greatest(at, state["stop"])).cast("int")
            return F.struct(stop.alias("stop"), (state["words"] + new).alias("words"))

        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
        start = F.struct(F.lit(0).alias("stop"), F.lit(0).alias("words"))
        found = F.aggregate(let(F.sort_array(pairs), places), start, add, lambda state: state["words"])
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(found)

    return F.when(F.size(words) >= size, let(hashes, covered)).otherwise(F.lit(0)).cast("long")


def measures(text: str = "text") -> dict[str, Column]:
    """Counts over a whole text; a null text counts as empty. Different words are counted in blocks of ``KIND_WORDS``
    words, the last one included, so that their share does not fall with the length of a text."""
    whole = text_or_empty(text)
    words = F.regexp_extract_all(whole, F.lit(f"{WORD}+"), F.lit(0))
    visible = F.length(without(whole, " \t\n\v\f\r"))
    lines = F.filter(F.split(whole, "\n", -1), lambda line: F.regexp(line, F.lit(WORD)))

    def of_words(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w), F.lit(1)), F.lit(KIND_WORDS))
        kinds = F.transform(starts, lambda at: F.size(F.array_distinct(F.slice(w, at, KIND_WORDS))))
        kinds = F.aggregate(kinds, F.lit(0), lambda total, n: total + n)
        return F.struct(F.size(w).alias("n"), kinds.alias("kinds"), repeat_words(w).alias("repeats"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again"))

    found, line = let(words, of_words), let(lines, of_lines)
    return {
        "_words": found,
        "_lines": line,
        "word_chars": visible.cast("long"),
        "n_symbols": (F.length(whole) - F.length(without(whole, SYMBOLS))).cast("long"),
        "n_marks": F.length(F.regexp_replace(whole, r"[\x20\x09-\x0D\p{L}\p{N}]+", "")).cast("long"),
        "n_upper": F.length(F.regexp_replace(whole, r"[^\p{Lu}]+", "")).cast("long"),
    }


def measured(df: DataFrame, key: str, stratum: str, text: str = "text") -> DataFrame:
    """``key, stratum`` and the measures of every row."""
    rows = df.select(F.col(key).alias("_key"), F.col(stratum).cast("string").alias("stratum"), *[
        column.alias(name) for name, column in measures(text).items()
    ])
    return rows.select(
        "_key",
        "stratum",
        F.col("_words.n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("_lines.again").cast("long").alias("n_dup_lines"),
        F.col("_words.repeats").alias("n_repeat_words"),
        F.col("_words.kinds").alias("n_kinds"),
        F.col("_lines.n").alias("n_lines"),
        "n_marks",
        "n_upper",
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def rejections_allowed(n: Column, risk: float, error: float) -> Column:
    """The most rejections k among ``n`` with P(Binomial(n, risk) <= k) <= error; -1 if even none proves nothing.

    Terms are summed in logarithms from k = 0 on, up to the mean, where the probability is beyond any error.
    """
    odds = math.log(risk / (1 - risk))
    start = F.struct(
        (n * math.log1p(-risk)).cast("double").alias("term"), F.lit(float("-inf")).alias("sum"), F.lit(-1).cast("long").alias("k")
    )

    def add(state: Column, i: Column) -> Column:
        top = F.greatest(state["sum"], state["term"])
        both = top + F.log(F.exp(state["sum"] - top) + F.exp(state["term"] - top))
        following = state["term"] + F.log((n - i) / (i + 1)) + odds
        k = F.when(both <= math.log(error), i).otherwise(state["k"])
        return F.struct(following.cast("double").alias("term"), both.alias("sum"), k.cast("long").alias("k"))

    steps = F.sequence(F.lit(0).cast("long"), F.floor(n * risk).cast("long"))
    allowed = F.aggregate(steps, start, add, lambda state: state["k"])
    return F.when(n > 0, allowed).otherwise(F.lit(-1).cast("long"))


def value(rule: Rule) -> Column:
    """The measure of a row; a share of nothing is 0."""
    return F.coalesce(F.expr(rule.measure), F.lit(0.0))


def cutoffs(rows: DataFrame, labels: DataFrame, key: str, label: str, rules=RULES, risk=RISK, error=ERROR) -> DataFrame:
    """``stratum`` and for each rule its proven cutoff (null: none), from rows that pass the fixed limits and are
    labelled good. Labels that are null or of unknown keys are passed over; of repeated labels the highest counts."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("label"))
    good = rows.where(~base_failed()).join(known.where("label = 1").select("_key"), "_key", "left_semi")
    rejected = [
        F.count_if(value(rule) > cutoff).alias(f"{rule.name}_{i}") for rule in rules for i, cutoff in enumerate(rule.cutoffs)
    ]
    counts = written(good.groupBy("stratum").agg(F.count("*").alias("n"), *rejected), "holdouts")
    tests = max(1, counts.count() * len(rejected))
    allowed = counts.withColumn("allowed", rejections_allowed(F.col("n"), risk / len(rules), error / tests))

    def strictest(rule: Rule) -> Column:
        proven = [
            F.when(F.col(f"{rule.name}_{i}") <= F.col("allowed"), F.lit(cutoff)) for i, cutoff in enumerate(rule.cutoffs)
        ]
        return F.coalesce(*proven, F.lit(None).cast("double")).alias(rule.name)

    return allowed.select("stratum", "n", "allowed", *map(strictest, rules))


def quality(
    df: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    label: str = "quality",
    rules=RULES,
    risk: float = RISK,
    error: float = ERROR,
) -> DataFrame:
    """``key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept`` for every row.

    ``kept`` is false if the fixed limits fail or a rule rejects the row by the cutoff of its stratum (null is a
    stratum of its own). Null texts count as empty and fail. Keys may be null or repeated; labels say 1 for good.
    Without labels no cutoff is proven and only the fixed limits decide.
    """
    rows = written(measured(df, key, stratum, text), "measures")
    proven = written(cutoffs(rows, labels, key, label, rules, risk, error), "cutoffs")
    proven = proven.select(F.col("stratum").alias("_stratum"), *[F.col(r.name).alias(f"_{r.name}") for r in rules])
    judged = rows.join(proven, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    passes = [F.coalesce(value(rule) <= F.col(f"_{rule.name}"), F.lit(True)) for rule in rules]
    fine = ~base_failed()
    for passed in passes:
        fine = fine & passed
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(F.col("_key").alias(key), *counts, base_failed().alias("base_failed"), fine.alias("kept"))

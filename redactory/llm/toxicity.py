"""Toxicity classifier that is regularised by counterfactuals.

Features are the presence of words and of word beginnings. A logistic model is fitted to labelled texts; for
each of them that mentions a group, the mention is swapped for another one of the same kind, and the squared
change of the score is penalised. Weight that the labels would put on a mere mention of a group moves to the
words that make a text toxic.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, text_or_empty

#: Labelled rows that are learned from, at most; taken in the order of a hash of their ids.
MAX_ROWS = 12_000
#: Features that are kept, at most, and rows that must have one.
MAX_FEATURES = 2_000
MIN_ROWS = 4
BEGINNINGS = (4, 5, 6)
RIDGE, FAIRNESS, STEPS = 3e-5, 1.0, 800
WORD = re.compile(r"[^\W\d_]+")

#: Mentions of groups that are swapped for each other.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("female", "male"), ("mother", "father"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("immigrant", "native"), ("immigrants", "natives"), ("disabled", "blind", "deaf"), ("old", "young"),
    ("frau", "mann"), ("frauen", "männer"), ("femme", "homme"), ("femmes", "hommes"),
    ("mujer", "hombre"), ("mujeres", "hombres"),
)


def features_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


def features(words: set[str]) -> set[str]:
    return {feature for word in words for feature in features_of(word)}


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def swapped(words: set[str], groups: Sequence[Sequence[str]]) -> set[str]:
    """The words with every mention replaced by the next one of its group."""
    following = {a: g[(i + 1) % len(g)] for g in groups for i, a in enumerate(g)}
    return {following.get(word, word) for word in words}


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def scores(self, texts: Iterator[list[str]]) -> Iterator[list[list[float]]]:
        """Probability of label 1. A text of no known feature, empty ones too, gets the score of the bias."""
        known: dict[str, tuple[str, ...]] = {}
        for batch in texts:
            out = []
            for text in batch:
                words = words_of(text)
                for word in words.difference(known):
                    known[word] = tuple(f for f in features_of(word) if f in self.weights)
                found = {feature for word in words for feature in known[word]}
                z = self.bias + math.fsum(self.weights[f] for f in found)
                out.append(1 / (1 + math.exp(-max(min(z, 50.0), -50.0))))
            if len(known) > 500_000:
                known.clear()
            yield [out]


def fit_logistic(
    rows: Sequence[Sequence[int]], changed: Sequence[Sequence[int]], labels: Sequence[int], width: int
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise mean log loss + RIDGE |w|^2 + FAIRNESS mean (w (x - x'))^2."""
    x = np.zeros((len(rows), width), np.float32)
    for line, own in zip(x, rows):
        line[list(own)] = 1
    y = np.asarray(labels, np.float32)
    moved = [i for i, (own, other) in enumerate(zip(rows, changed)) if set(own) != set(other)]
    delta = np.zeros((len(moved), width), np.float32)
    for line, i in zip(delta, moved):
        line[list(rows[i])] += 1
        line[list(changed[i])] -= 1
    w, bias = np.zeros(width, np.float32), 0.0
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, STEPS + 1):
        residual = 1 / (1 + np.exp(-np.clip(x @ w + bias, -50, 50))) - y
        slope = x.T @ residual / max(len(y), 1) + 2 * RIDGE * w
        if len(moved):
            slope = slope + 2 * FAIRNESS * (delta.T @ (delta @ w)) / len(moved)
        slope = np.append(slope, residual.mean() if len(y) else 0.0)
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        move = 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1].astype(np.float32), bias - float(move[-1])
    return w, bias


def learning_rows(
    df: DataFrame, labels: DataFrame, label: str, text: str = "text", key: str = "doc_id", max_rows: int = MAX_ROWS
) -> DataFrame:
    """``_text, label`` of at most ``max_rows`` labelled rows whose crc32(key) mod 5 is not 0. Labels of ids that ``df``
    does not have take no place."""
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    known = known.join(df.select(key), key, "left_semi")
    known = known.groupBy(key).agg(F.max(label).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64(key), key).limit(max_rows)
    rows = df.select(F.col(key), text_or_empty(text).alias("_text"))
    return rows.join(F.broadcast(chosen), key).select("_text", "label")  # max_rows rows at most are broadcast


def held_out(key: str = "doc_id") -> Column:
    """Whether the row takes no part in learning; a null id counts as empty text and is held out."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(rows: DataFrame, identity: Sequence[Sequence[str]] = IDENTITY_TERMS) -> Model:
    """Learn from ``_text, label``, a bounded set of rows; without rows of both labels the model has only a bias."""

    def words(texts: Iterator[list[str]]) -> Iterator[list[list[list[str]]]]:
        for batch in texts:
            own = [words_of(text) for text in batch]
            yield [[sorted(features(w)) for w in own], [sorted(features(swapped(w, identity))) for w in own]]

    split = map_texts(rows, ["label"], "_text", words, "own array<string>, other array<string>")
    n, positive = split.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < positive < n:
        return Model({}, 5.0 if n and positive else -5.0)
    counts = (
        split.select("label", F.explode(F.array_union("own", "other")).alias("feature"))
        .groupBy("feature")
        .agg(F.count("*").alias("rows"), F.sum("label").alias("hits"))
        .where(F.col("rows") >= MIN_ROWS)
    )
    expected = F.col("rows") * F.lit(positive / n)
    strength = (F.col("hits") - expected) ** 2 / (expected * F.lit(1 - positive / n))
    best = counts.orderBy(strength.desc(), "feature").limit(MAX_FEATURES)
    mentions = {feature for group in identity for word in group for feature in features_of(word)}
    named = sorted({row["feature"] for row in best.collect()} | mentions)
    number = {feature: i for i, feature in enumerate(named)}

    def numbers(column: str) -> Column:
        return F.array_intersect(F.col(column), F.array(*map(F.lit, named)))

    learned = split.select("label", numbers("own").alias("own"), numbers("other").alias("other")).collect()
    rows_ = [[number[f] for f in row["own"]] for row in learned]
    changed = [[number[f] for f in row["other"]] for row in learned]
    weights, bias = fit_logistic(rows_, changed, [row["label"] for row in learned], len(named))
    return Model({f: float(w) for f, w in zip(named, weights) if w}, float(bias))


def score(
    df: DataFrame, model: Model, text: str = "text", keep: Sequence[str] = ("doc_id",), name: str = "score"
) -> DataFrame:
    """One row per row of ``df``: columns ``keep`` and the score (null text: empty). No shuffle."""
    return map_texts(df, list(keep), text, model.scores, f"`{name}` double")


def toxicity(df: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, held_out, score, predicted`` for every row, learned from ``labels.toxic`` of the rows that are not
    held out. Ids and labels are no inputs of a score; null texts count as empty; ids may be null or repeated;
    labels that are null or repeated (the highest counts) or of unknown ids do no harm. Without labels of both
    kinds all rows get one score. Broadcasts ``MAX_ROWS`` ids and labels at most, collects as many sets of
    features."""
    model = fit(learning_rows(df, labels, "toxic", text, key))
    scored = score(df, model, text, [key])
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return scored.select(key, held_out(key).alias("held_out"), "score", predicted.alias("predicted"))

"""Hook for a user-supplied entity model. No model is shipped and none is called by default."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.spans import SPANS_TYPE

Predict = Callable[[pd.Series], list[list[tuple[str, int, int, float]]]]


def with_model_spans(
    df: DataFrame, column: str, load: Callable[[], Predict], into: str = "model_spans", errors: str | None = None
) -> DataFrame:
    """Add the spans a model finds in ``column``; only that column goes through Python.

    ``load`` runs once per task and returns a function from a batch of texts to one list of
    (entity, start, end, score) per text. Feed the column to ``anonymize(..., extra_spans=...)``. An error of the model
    fails the job; with ``errors``, texts at which it fails get no spans, and the reason goes to that column.
    """

    @F.pandas_udf(f"struct<spans:{SPANS_TYPE},error:string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = load()

        def rows(texts: pd.Series) -> list[tuple[list, str | None]]:
            try:
                found = predict(texts)
            except Exception as error:
                if errors is None:
                    raise
                if len(texts) == 1:
                    return [([], f"{type(error).__name__}: {error}")]
                return [rows(pd.Series([text]))[0] for text in texts]
            return [
                ([{"entity": e, "start": a, "end": b, "score": float(p), "value": text[a:b]} for e, a, b, p in spans], None)
                for text, spans in zip(texts, found)
            ]

        for texts in batches:
            yield pd.DataFrame(rows(texts.fillna("")), columns=["spans", "error"])

    found = df.withColumn("__model", run(F.col(f"`{column}`")))
    found = found.withColumn(into, F.col("__model.spans"))
    return (found.withColumn(errors, F.col("__model.error")) if errors else found).drop("__model")

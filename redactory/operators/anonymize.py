"""Anonymizing columns and tables: one shuffle-free projection over the input."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.masks import Mask, PythonMask, build_mask
from ..functions.spans import NO_SPANS, resolve_spans, rewrite
from ..functions.text import Sql, column, each, fn, let, lit
from ..plans.eligibility import ColumnPlan, plan_columns
from ..policy import Policy, PolicyError, TablePolicy
from ..session import written
from .detect import compile_recognizers, detect

SPANS = "__spans"
TEXTS = "__texts"
RESOLVED = "__resolved"
MASKED = "__masked"
ERRORS = "__errors"
#: Tables with so few inspected columns get expressions of their own per column, so that whoever selects one output
#: column reads one input column. Wider tables share expressions, which keeps their plans small.
APART = 4
ERROR_TYPE = "struct<column:string,entity:string,error:string>"


def masks_for(policy: Policy) -> dict[str, Mask | PythonMask]:
    return {e.entity: build_mask(e.strategy, e.entity, e.params, policy.defaults) for e in policy.active()}


def mask_span(policy: Policy, masks: Mapping[str, Mask | PythonMask]) -> Callable[[Sql], Sql]:
    """Choose the mask by the entity of a span; other entities get the default replacement."""

    def apply(span: Sql) -> Sql:
        branches = [
            f"WHEN {lit(entity)} THEN {mask(f'{span}.value')}"
            for entity, mask in masks.items()
            if not isinstance(mask, PythonMask)
        ]
        default = lit(policy.default_replacement)
        return f"CASE {span}.entity {' '.join(branches)} ELSE {default} END" if branches else default

    return apply


def guarded_by(on_error: str) -> Callable[[Callable[[pd.Series], pd.Series], pd.Series], pd.Series]:
    """A function of a mask and values that gives ``(masked, error)`` of each value; a closure, so that workers need no copy
    of this module.

    A call of a mask costs about the same for one value as for many. Of values of which some fail, runs are masked together,
    as long as half of the runs may be expected to hold no failure; a run that fails is halved until values stand alone.
    """

    def guarded(body: Callable[[pd.Series], pd.Series], values: pd.Series) -> pd.Series:
        try:
            return body(values).map(lambda masked: (masked, None))
        except Exception:
            if on_error == "fail":
                raise
        pairs: list[tuple[str | None, str | None]] = []
        failed = 0

        def one(value: str) -> tuple[str | None, str | None]:
            try:
                return body(pd.Series([value])).iloc[0], None
            except Exception as error:
                masked = {"keep": value, "redact": "<ERROR>"}.get(on_error)
                return masked, f"{type(error).__name__}: {error}"

        def settle(part: pd.Series, fails: bool) -> bool:
            nonlocal failed
            if len(part) == 1:
                pairs.append(one(part.iloc[0]))
                failed += pairs[-1][1] is not None
                return pairs[-1][1] is not None
            if not fails:
                try:
                    masked = body(part)
                    if masked.index.equals(part.index):
                        pairs.extend((m, None) for m in masked)
                        return False
                except Exception:
                    pass
            half = len(part) // 2
            first = settle(part.iloc[:half], False)
            return settle(part.iloc[half:], not first) or first

        while len(pairs) < len(values):
            at = len(pairs)
            room = int(0.7 * at / failed) if failed else max(2 * at, 16)
            settle(values.iloc[at : at + (room if room > 3 else 1)], False)
        return pd.Series(pairs, index=values.index)

    return guarded


def _python_masked(entities: Sql, values: Sql, masks: Mapping[str, Mask | PythonMask], on_error: str) -> Column:
    """Masked values of spans with Python masks, and the errors of those that failed, aligned with ``spans``; NULL for
    all others. What happens to a value that fails is up to ``on_error``."""
    bodies = {e: m.body for e, m in masks.items() if isinstance(m, PythonMask)}

    guarded = guarded_by(on_error)

    @F.pandas_udf("array<struct<masked:string,error:string>>")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for entities, values in batches:
            flat = pd.DataFrame({"entity": entities.explode(), "value": values.explode()}).reset_index()
            flat["masked"] = [(None, None)] * len(flat)
            for entity, body in bodies.items():
                own = flat["entity"] == entity
                if own.any():
                    flat.loc[own, "masked"] = guarded(body, flat.loc[own, "value"])
            done = iter([{"masked": masked, "error": error} for masked, error in flat["masked"]])
            cells = [[next(done) for _ in range(max(len(v), 1))] for v in values]  # an empty cell has a row in ``flat``
            yield pd.Series([cell if len(v) else [] for cell, v in zip(cells, values)])

    return run(F.expr(entities), F.expr(values))


@dataclass(frozen=True)
class Prepared:
    """A table with its spans: the input columns plus a column with the spans of every inspected column or, for tables
    of more than ``APART`` of them, one array of all, in the order of ``inspected``."""

    frame: DataFrame
    columns: list[ColumnPlan]
    policy: Policy

    @property
    def inspected(self) -> list[ColumnPlan]:
        return [c for c in self.columns if c.recognizers]

    @property
    def eligible(self) -> list[ColumnPlan]:
        return [c for c in self.columns if c.eligible]

    @property
    def apart(self) -> bool:
        return len(self.inspected) <= APART

    def spans(self, index: int) -> Sql:
        return f"{SPANS}{index}" if self.apart else f"{SPANS}[{index}]"

    def entities(self) -> list[str]:
        return sorted({r.entity for c in self.inspected for r in c.recognizers})

    def metrics(self) -> list[Column]:
        """Aggregates over ``frame`` that make up the report; no row is exploded or shuffled.

        ``rows``, ``anonymized_rows``, per inspected column i ``hits_i`` and, per entity j it may
        hold, ``found_i_j``.
        """
        hits = [f"size({self.spans(i)}) > 0" for i in range(len(self.inspected))]
        found = ["count(1) AS rows", f"count_if({' OR '.join(hits) or 'false'}) AS anonymized_rows"]
        for i, c in enumerate(self.inspected):
            found.append(f"count_if({hits[i]}) AS hits_{i}")
            possible = {r.entity for r in c.recognizers}
            for j, entity in enumerate(self.entities()):
                if entity in possible:
                    named = f"{self.spans(i)}.entity"  # a field of all spans: compiled, unlike a filter
                    own = f"size({named}) - size(array_remove({named}, {lit(entity)}))"
                    own = f"size({self.spans(i)})" if len(possible) == 1 else f"CASE WHEN {hits[i]} THEN {own} END"
                    found.append(f"coalesce(sum({own}), 0L) AS found_{i}_{j}")
        return [F.expr(f) for f in found]

    def result(self) -> DataFrame:
        """The anonymized table, in the column order of the input."""
        return self._rewritten().select(*self._outputs())

    def separated(self) -> tuple[DataFrame, DataFrame]:
        """The anonymized rows, and the rows of the input of which a mask failed, with ``errors``. Written to the shared
        scratch folder in between, so that masks run once; it holds the values of rows that failed, and of no other."""
        frame = self._rewritten()
        if ERRORS not in frame.columns:
            frame = frame.withColumn(ERRORS, F.expr(f"cast(array() AS array<{ERROR_TYPE}>)"))
        failed = F.expr(f"coalesce(size({ERRORS}), 0) > 0")
        whole = F.struct(*[F.col(f"`{c.name.replace('`', '``')}`") for c in self.columns])
        kept = frame.select(
            F.when(~failed, F.struct(*self._outputs())).alias("row"),
            F.when(failed, whole).alias("failed"),
            F.when(failed, F.col(ERRORS)).alias("errors"),
        )
        kept = written(kept, "separated")
        return kept.where("row IS NOT NULL").select("row.*"), kept.where("failed IS NOT NULL").select("failed.*", "errors")

    def _outputs(self) -> list[Column]:
        position = {c.name: i for i, c in enumerate(self.inspected)}
        python = any(isinstance(m, PythonMask) for m in masks_for(self.policy).values())
        texts = lambda i: f"{TEXTS}{i}" if self.apart and not python else f"{TEXTS}[{i}]"

        def output(c: ColumnPlan) -> Sql:
            if c.name in position:
                return texts(position[c.name])
            return f"cast({column(c.name)} AS string)" if c.eligible else column(c.name)

        return [F.expr(output(c)).alias(c.name) for c in self.columns]

    def _rewritten(self) -> DataFrame:
        """The frame with the rewritten texts of the inspected columns."""
        if not self.inspected:
            return self.frame
        masks = masks_for(self.policy)
        choose = mask_span(self.policy, masks)
        one = lambda c: f"cast({column(c.name)} AS string)"
        texts = f"array({', '.join(map(one, self.inspected))})"
        if not any(isinstance(m, PythonMask) for m in masks.values()):
            masked = lambda t, s: rewrite(t, resolve_spans(s), lambda span, i: choose(span))
            if self.apart:
                own = {f"{TEXTS}{i}": F.expr(masked(one(c), self.spans(i))) for i, c in enumerate(self.inspected)}
                return self.frame.withColumns(own)
            return self.frame.withColumn(TEXTS, F.expr(f"zip_with({texts}, {SPANS}, {fn(masked)})"))
        # Python masks run on the resolved values, one Arrow column per inspected column.
        spans = f"array({', '.join(map(self.spans, range(len(self.inspected))))})" if self.apart else SPANS
        frame = self.frame.withColumn(RESOLVED, F.expr(each(spans, resolve_spans)))
        cells = [f"{RESOLVED}[{i}]" for i in range(len(self.inspected))]
        frame = frame.withColumns(
            {
                f"{MASKED}{i}": _python_masked(f"{cell}.entity", f"{cell}.value", masks, self.policy.on_error)
                for i, cell in enumerate(cells)
            }
        )
        done = ", ".join(f"{MASKED}{i}" for i in range(len(cells)))
        paired = f"zip_with({texts}, {RESOLVED}, (t, s) -> struct(t, s))"
        zipped = f"zip_with({paired}, array({done}), (c, m) -> struct(c.t AS t, c.s AS s, m AS m))"
        body = lambda c: rewrite(f"{c}.t", f"{c}.s", lambda span, i: f"coalesce(get({c}.m, {i}).masked, {choose(span)})")
        failed = ", ".join(
            f"transform(filter(zip_with({cell}, {MASKED}{i}, (s, m) -> struct(s.entity AS entity, m.error AS error)), "
            f"x -> x.error IS NOT NULL), x -> named_struct('column', {lit(self.inspected[i].name)}, 'entity', x.entity, 'error', x.error))"
            for i, cell in enumerate(cells)
        )
        return frame.withColumns({TEXTS: F.expr(each(zipped, body)), ERRORS: F.expr(f"concat({failed})")})


def prepare_table(
    df: DataFrame,
    policy: Policy,
    table_policy: TablePolicy | None = None,
    language_column: str | None = None,
) -> Prepared:
    """Add the spans of every column that can hold personal data under ``policy``. Recognizers and patterns that
    are bound to languages apply row by row where a column (here or in ``table_policy``) holds the language.

    Columns that need the same recognizers share one expression over the array of their values, so
    the plan grows with the number of different column policies, not with the number of columns.
    """
    language_column = language_column or (table_policy.language_column if table_policy else None)
    columns = plan_columns(df.schema, policy, table_policy, by_language=language_column is not None)
    language = column(language_column) if language_column else None
    inspected = [c for c in columns if c.recognizers]
    if len(inspected) <= APART:
        own = {
            f"{SPANS}{i}": F.expr(detect(f"cast({column(c.name)} AS string)", c.recognizers, language))
            for i, c in enumerate(inspected)
        }
        return Prepared(df.withColumns(own) if own else df, columns, policy)
    groups: dict[tuple, list[int]] = {}
    for i, c in enumerate(inspected):
        groups.setdefault(c.recognizers, []).append(i)
    place, parts = {}, []
    for recognizers, members in groups.items():
        texts = ", ".join(f"cast({column(inspected[i].name)} AS string)" for i in members)
        for i in members:
            place[i] = len(place)
        parts.append(each(f"array({texts})", partial(detect, recognizers=recognizers, language=language)))
    found = f"concat({', '.join(parts)})"
    if list(place.values()) != sorted(place.values()) or list(place) != sorted(place):
        order = ", ".join(str(place[i]) for i in range(len(inspected)))
        found = let(found, lambda f: each(f"array({order})", lambda i: f"{f}[{i}]"))
    return Prepared(df.withColumn(SPANS, F.expr(found)), columns, policy)


def anonymize_table(
    df: DataFrame,
    policy: Policy,
    table_policy: TablePolicy | None = None,
    language_column: str | None = None,
) -> DataFrame:
    """Every eligible column anonymized and cast to string; all other columns untouched.

    The result is a projection: as many tasks as the scan has splits, no shuffle, no Python. Of tables with at most
    ``APART`` inspected columns, only the columns are read whose results are selected afterwards.
    """
    if not policy.enabled or (table_policy is not None and not table_policy.enabled):
        return df
    return prepare_table(df, policy, table_policy, language_column).result()


def anonymize_separated(
    df: DataFrame, policy: Policy, table_policy: TablePolicy | None = None
) -> tuple[DataFrame, DataFrame]:
    """``anonymize_table`` for a policy with ``on_error="quarantine"``: the rows that could be anonymized, and those of
    which a Python mask failed, as they came, with ``errors(column, entity, error)``. No row is in both or in neither."""
    if policy.on_error != "quarantine":
        raise PolicyError("rows are separated for on_error='quarantine' only")
    if not policy.enabled or (table_policy is not None and not table_policy.enabled):
        return df, df.limit(0).withColumn("errors", F.expr(f"cast(array() AS array<{ERROR_TYPE}>)"))
    return prepare_table(df, policy, table_policy).separated()


def anonymize(df: DataFrame, name: str, policy: Policy, extra_spans: str | None = None) -> DataFrame:
    """Detect and anonymize one text column, whatever its name. ``extra_spans`` names a span column
    with further findings, e.g. those of a lexicon join or of a model. Masks and the global switch
    work as for whole tables."""
    if not policy.enabled:
        return df
    text, masks = column(name), masks_for(policy)
    spans = detect(text, compile_recognizers(policy))
    if extra_spans is not None:
        spans = f"concat({spans}, coalesce({column(extra_spans)}, {NO_SPANS}))"
    choose = mask_span(policy, masks)
    frame = df.withColumn(SPANS, F.expr(spans)).withColumn(RESOLVED, F.expr(resolve_spans(SPANS)))
    mask = lambda s, i: choose(s)
    if any(isinstance(m, PythonMask) for m in masks.values()):
        masked = _python_masked(f"{RESOLVED}.entity", f"{RESOLVED}.value", masks, policy.on_error)
        frame = frame.withColumn(MASKED, masked)
        mask = lambda s, i: f"coalesce(get({MASKED}, {i}).masked, {choose(s)})"
    return frame.withColumn(name, F.expr(rewrite(text, RESOLVED, mask))).drop(SPANS, RESOLVED, MASKED)


def process_table(df: DataFrame, rows: Callable, schema: str | None = None) -> DataFrame:
    """Apply a user function to a table: ``DataFrame -> DataFrame``, or with ``schema`` a function
    over batches of pandas frames."""
    return df.transform(rows) if schema is None else df.mapInPandas(rows, schema)

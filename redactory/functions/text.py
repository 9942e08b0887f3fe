"""Writing SQL expressions: literals, lambdas, bindings, and a few text functions.

Expressions are composed as SQL text and parsed once per column. Building the same trees object by
object costs a round trip to the JVM for every node, seconds per table for a full policy.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from inspect import signature

Sql = str

_names = itertools.count(1)


def lit(value: str | bool | int | float | None) -> Sql:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column(name: str) -> Sql:
    return "`" + name.replace("`", "``") + "`"


def fn(body: Callable[..., Sql]) -> Sql:
    """A SQL lambda with fresh parameter names, so that nested lambdas never hide each other."""
    names = [f"v{next(_names)}" for p in signature(body).parameters.values() if p.kind is p.POSITIONAL_OR_KEYWORD]
    head = names[0] if len(names) == 1 else f"({', '.join(names)})"
    return f"{head} -> {body(*names)}"


def let(value: Sql, body: Callable[[Sql], Sql]) -> Sql:
    """Bind ``value`` once and use it many times inside ``body``.

    Expressions below a higher-order function are interpreted, without common-subexpression
    elimination, so an expensive value must be bound before it is referenced repeatedly. Bound as the start of a fold
    over nothing: an element of a transformed array would be copied, and its type be told anew, at every evaluation.
    """
    return f"aggregate(array(), {value}, {fn(lambda bound, nothing: bound)}, {fn(body)})"


def each(array: Sql, body: Callable[..., Sql]) -> Sql:
    return f"transform({array}, {fn(body)})"


def keep(array: Sql, condition: Callable[..., Sql]) -> Sql:
    return f"filter({array}, {fn(condition)})"


def fold(array: Sql, start: Sql, step: Callable[[Sql, Sql], Sql], finish: Callable[[Sql], Sql]) -> Sql:
    return f"aggregate({array}, {start}, {fn(step)}, {fn(finish)})"


def struct(**fields: Sql) -> Sql:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def case(condition: Sql, yes: Sql, no: Sql) -> Sql:
    return f"CASE WHEN {condition} THEN {yes} ELSE {no} END"


def strip(text: Sql) -> Sql:
    """Remove white space at both ends (``trim`` removes blanks only)."""
    return f"regexp_replace({text}, {lit(r'^\s+|\s+$')}, '')"


def worth_analysing(text: Sql) -> Sql:
    """True if at least two characters remain after stripping white space; NULL for NULL.

    Written as a search that stops at the first two adjacent visible characters, so long texts
    are not copied just to be measured.
    """
    return f"({text} RLIKE {lit(r'(?s)\S(?:\S|.*\S)')})"


def star_after(text: Sql, shown: int, char: str = "*") -> Sql:
    """Keep the first ``shown`` characters and mask the rest."""
    return f"concat(left({text}, {shown}), repeat({lit(char)}, length({text}) - {shown}))"

"""Recognizers and their compilation to one span column per text column."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import types as T

from ..functions.listed import WORD, WORD_HERE, FiledWords, TermIndex, listed_spans, located_words
from ..functions.regexes import SHAPE, SHAPED, first_class, min_width, required_shape
from ..functions.spans import NO_SPANS, at_least, boost_by_context, distinct_spans, locate, whole_value_span
from ..functions.text import Sql, case, each, fn, keep, let, lit, struct, worth_analysing
from ..policy import ColumnPolicy, Pattern, Policy, PolicyError
from ..policy_defaults import ADDRESS_CONTEXT, ADDRESS_PATTERNS

# Word edges by look-around: unlike \b they do not depend on what the JVM takes for a letter, so a
# number that directly follows an accented letter is found as well.
EDGE_BEFORE = r"(?<![0-9A-Za-z_])"
EDGE_AFTER = r"(?![0-9A-Za-z_])"

TEXT = "text"
ALL_KINDS = frozenset({TEXT, "integer", "decimal", "real", "date", "timestamp"})


def kind_of(data_type: T.DataType) -> str | None:
    """The class of values a type holds; None for types that are never inspected."""
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return TEXT
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(data_type, T.DecimalType):
        return "decimal"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "real"
    if isinstance(data_type, T.DateType):
        return "date"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    return None


def max_width(data_type: T.DataType) -> int | None:
    """The most characters the text form of a value can have; None if unknown."""
    fixed = {T.ByteType: 4, T.ShortType: 6, T.IntegerType: 11, T.LongType: 20, T.FloatType: 15, T.DoubleType: 25}
    if isinstance(data_type, T.DecimalType):
        return data_type.precision + 3
    return fixed.get(type(data_type))


@dataclass(frozen=True)
class Recognizer:
    """Finds one entity in a text.

    ``needs`` is a literal every match contains; it only serves to skip texts cheaply. ``check``
    names a rule of ``CHECKS`` that scores the matched values. ``kinds`` are the value classes whose text form
    can match at all, so numeric columns cost nothing for patterns that need letters. ``terms`` are listed
    words and phrases with their scores, found by look-up instead of patterns.
    """

    entity: str
    patterns: tuple[Pattern, ...] = ()
    terms: tuple[tuple[str, float], ...] = ()
    whole: bool = False
    needs: str | None = None
    kinds: frozenset[str] = frozenset({TEXT})
    languages: frozenset[str] | None = None
    context: tuple[str, ...] = ()
    threshold: float | None = None
    check: str = ""


def luhn_valid(value: Sql) -> Sql:
    """Checksum of payment card numbers; everything but digits is ignored."""

    def check(digits: Sql) -> Sql:
        def share(i: Sql) -> Sql:
            digit = f"cast(substring({digits}, {i}, 1) AS int)"
            twice = case(f"{digit} > 4", f"2 * {digit} - 9", f"2 * {digit}")
            return case(f"(length({digits}) - {i}) % 2 = 1", twice, digit)

        shares = each(f"sequence(1, length({digits}))", share)
        total = f"aggregate({shares}, 0, {fn(lambda a, b: f'{a} + {b}')})"
        return f"CASE WHEN {digits} = '' THEN false ELSE {total} % 10 = 0 END"

    return let(f"regexp_replace({value}, '[^0-9]', '')", check)


def octets_fit(value: Sql) -> Sql:
    return f"forall(split({value}, '[.]'), {fn(lambda o: f'cast({o} AS int) <= 255')})"


# Scores of matched values: (value, score of the pattern) -> score, NULL to discard the match.
CHECKS: dict[str, Callable[[Sql, Sql], Sql]] = {
    "luhn": lambda value, score: case(luhn_valid(value), score, "0.3D"),
    "octets": lambda value, score: case(octets_fit(value), score, "NULL"),
}


def _edged(body: str) -> str:
    return EDGE_BEFORE + body + EDGE_AFTER


EMAIL = Pattern(
    "email",
    EDGE_BEFORE + r"(?=[A-Za-z0-9_])[A-Za-z0-9._%+\-]+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]++)++",
    1.0,
)
PHONE = Pattern("phone", r"(?:\+\d{1,3}[ \-])?\(?" + _edged(r"\d{3}\)?[\s.\-]\d{3}[\s.\-]\d{4}"), 0.7)
SSN = Pattern("ssn", _edged(r"\d{3}-\d{2}-\d{4}"), 0.9)
CARD = Pattern("card_digits", _edged(r"\d{16}"), 1.0)
IP = Pattern("ipv4", _edged(r"\d{1,3}(?:\.\d{1,3}){3}"), 0.95)
URL = Pattern("url", r"https?://[^\s\"'<>]+", 0.7)
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
DATES = (
    Pattern("iso_date", _edged(r"\d{4}-\d{2}-\d{2}(?:[ T]\d{2}:\d{2}(?::\d{2})?)?"), 0.85),
    Pattern("slash_date", _edged(r"\d{1,2}/\d{1,2}/\d{2,4}"), 0.75),
    Pattern("month_name", EDGE_BEFORE + rf"(?:{MONTHS})\s\d{{1,2}},\s\d{{4}}" + EDGE_AFTER, 0.85),
)
MONEY = (
    Pattern("symbol_amount", r"[$€£]\s?\d[\d,]*(?:\.\d{1,2})?" + EDGE_AFTER, 0.85),
    Pattern("amount_code", _edged(r"\d[\d,]*(?:\.\d{1,2})?\s(?:USD|EUR|GBP)"), 0.85),
)
IBAN = Pattern("iban", _edged(r"[A-Z]{2}\d{2}[A-Z0-9]{11,30}"), 0.9)
ADDRESSES = tuple(Pattern(*p) for p in ADDRESS_PATTERNS)


def built_in() -> tuple[Recognizer, ...]:
    """Recognizers that need no policy entry beyond enabling their entity."""
    return (
        Recognizer("EMAIL_ADDRESS", (EMAIL,), needs="@"),
        Recognizer("PHONE_NUMBER", (PHONE,), languages=frozenset({"en"})),
        Recognizer("US_SSN", (SSN,), languages=frozenset({"en"})),
        Recognizer(
            "CREDIT_CARD", (CARD,), kinds=frozenset({TEXT, "integer", "decimal"}), check="luhn"
        ),
        Recognizer("LOCATION", ADDRESSES, context=ADDRESS_CONTEXT, languages=frozenset({"en"})),
        Recognizer("IP_ADDRESS", (IP,), check="octets"),
        Recognizer("URL", (URL,), needs="://"),
        Recognizer("DATE_TIME", DATES, kinds=frozenset({TEXT, "date", "timestamp"})),
        Recognizer("MONEY", MONEY),
        Recognizer("IBAN_CODE", (IBAN,)),
    )


#: From so many entries on, a list is looked up word by word instead of searched as one alternation.
LOOK_UP_FROM = 64


def deny_recognizer(entity: str, words: Sequence[str], score: float = 1.0) -> Recognizer:
    """Listed words and phrases, whole words only, leftmost and longest. A short list and entries without letters and
    digits become an alternation, longest entry first; a long list is looked up word by word, which does not slow
    down with the list. Both find the same. Lists of many thousands of entries belong in a table: see
    ``Policy.with_listed`` and ``lexicon_findings``."""
    listed = sorted(set(words), key=lambda w: (-len(w), w))
    if not all(w and not w.isspace() for w in listed):
        raise PolicyError(f"empty entry in the deny list of {entity}")
    looked_up = [w for w in listed if WORD_HERE.search(w)] if len(listed) >= LOOK_UP_FROM else []
    rest = [w for w in listed if not looked_up or not WORD_HERE.search(w)]
    body = "|".join(re.sub(r"([^0-9A-Za-z_\u0080-\uffff])", r"\\\1", w) for w in rest)
    regex = rf"(?<![\p{{L}}\p{{N}}_])(?:{body})(?![\p{{L}}\p{{N}}_])"
    patterns = (Pattern("deny_list", regex, score),) if rest else ()
    return Recognizer(entity, patterns, tuple((w, score) for w in looked_up), kinds=ALL_KINDS)


def compile_recognizers(
    policy: Policy,
    column: ColumnPolicy | None = None,
    data_type: T.DataType = T.StringType(),
    by_language: bool = False,
) -> list[Recognizer]:
    """The recognizers one column needs, with context words and thresholds filled in.

    Entities outside the allow-list of the column, recognizers of other languages and patterns
    that cannot occur in this kind of value are left out of the plan. With ``by_language`` all
    languages are kept, to be routed row by row.
    """
    column = column or ColumnPolicy()
    kind, room = kind_of(data_type), max_width(data_type)
    chosen: list[Recognizer] = []
    for entity in policy.active():
        if column.entities and entity.entity not in column.entities:
            continue
        found = [r for r in built_in() if r.entity == entity.entity]
        for languages in dict.fromkeys(p.languages for p in entity.patterns):
            own = tuple(p for p in entity.patterns if p.languages == languages)
            bound = frozenset(languages) or None
            found.append(Recognizer(entity.entity, own, kinds=ALL_KINDS, languages=bound))
        if entity.deny:
            found.append(deny_recognizer(entity.entity, entity.deny))
        if entity.listed:
            found.append(Recognizer(entity.entity, terms=entity.listed))
        for recognizer in found:
            fitting = tuple(p for p in recognizer.patterns if room is None or min_width(p.regex) <= room)
            terms = tuple((t, s) for t, s in recognizer.terms if room is None or len(t) <= room)
            if kind not in recognizer.kinds or not fitting and not terms:
                continue
            if not by_language and recognizer.languages and column.language not in recognizer.languages:
                continue
            chosen.append(
                replace(
                    recognizer,
                    patterns=fitting,
                    terms=terms,
                    context=tuple(dict.fromkeys(recognizer.context + entity.context)),
                    threshold=policy.threshold(entity, column),
                )
            )
    if column.holds:
        chosen.append(Recognizer(column.holds, whole=True, kinds=ALL_KINDS))
    return chosen


def _first(recognizer: Recognizer) -> str | None:
    """The characters the matches of a recognizer start with, if that is known and selective."""
    classes = [first_class(p.regex) for p in recognizer.patterns]
    return "".join(dict.fromkeys(classes)) if classes and all(classes) else None


def _guarded(regex: str) -> str:
    """The same pattern, tried only where a match can start."""
    first = first_class(regex)
    return f"(?=[{first}])(?:{regex})" if first else regex


def _candidates(text: Sql, group: Sequence[Recognizer]) -> Sql:
    """One struct per pattern that matches in ``text``: its settings and its matches. The settings are a constant of the
    plan, so patterns without a match cost their search and no more; those of which the shape of the text lacks a run of
    digits and marks, which each of their matches holds, are not searched."""
    settings = [
        struct(
            entity=lit(r.entity),
            regex=lit(_guarded(p.regex)),
            score=lit(float(p.score)),
            rule=lit(r.check),
            threshold=lit(float(r.threshold or 0.0)),
            context=_context(r),
        )
        for r in group
        for p in r.patterns
    ]
    regexes = [p.regex for r in group for p in r.patterns]

    def matching(shape: Sql | None) -> Sql:
        def hits(regex: str) -> Sql:
            needed = required_shape(regex) if shape else None
            search = f"regexp_extract_all({text}, {lit(_guarded(regex))}, 0)"
            return f"CASE WHEN contains({shape}, {lit(needed)}) THEN {search} END" if needed else search

        paired = fn(lambda c, h: f"CASE WHEN size({h}) > 0 THEN {struct(settings=c, hits=h)} END")
        return f"zip_with(array({', '.join(settings)}), array({', '.join(map(hits, regexes))}), {paired})"

    # One look at the shape is worth it if it spares several searches.
    shaped = sum(required_shape(x) is not None for x in regexes) > 1
    found = let(f"translate({text}, {lit(SHAPED)}, {lit(SHAPE)})", matching) if shaped else matching(None)
    return keep(found, lambda c: f"{c} IS NOT NULL")


def _context(r: Recognizer) -> Sql:
    return f"cast(array({', '.join(lit(w.lower()) for w in r.context)}) AS array<string>)"


def _listed(text: Sql, group: Sequence[Recognizer]) -> Sql:
    """The spans of recognizers with listed terms; the words of the text are taken out and located once for all of them."""
    indexes = [TermIndex.of(r.terms) for r in group]
    words = FiledWords.of(indexes)

    def of(r: Recognizer, located: Sql, index: TermIndex, slots: Sql) -> Sql:
        spans = listed_spans(text, located, r.entity, index, slots)
        if r.context:
            boosted = lambda s: case(f"size({s}) > 0", boost_by_context(text, s, _context(r)), s)
            spans = let(spans, boosted)
        return at_least(spans, r.threshold)

    def bound(slots: list[Sql]) -> Sql:
        if len(slots) < len(group):
            return let(indexes[len(slots)].value(), lambda s: bound([*slots, s]))
        every = lambda w: f"concat({', '.join(of(r, w, i, s) for r, i, s in zip(group, indexes, slots))})"
        found = lambda w: case(f"size({w}) > 0", every(w), NO_SPANS)
        located = lambda all_words, filed: let(located_words(text, all_words, lambda w: words.has(filed, w)), found)
        here = f"regexp_extract_all({text}, {lit(WORD)}, 0)"
        return let(words.value(), lambda filed: let(here, lambda all_words: located(all_words, filed)))

    return bound([])


def _spans_of(text: Sql, c: Sql, checks: set[str]) -> Sql:
    """The spans of one candidate: located, scored, boosted by context, cut at the threshold."""

    def score_of(value: Sql) -> Sql:
        branches = [f"WHEN {lit(name)} THEN {CHECKS[name](value, f'{c}.settings.score')}" for name in sorted(checks)]
        return f"CASE {c}.settings.rule {' '.join(branches)} ELSE {c}.settings.score END" if branches else f"{c}.settings.score"

    spans = locate(text, f"{c}.settings.regex", f"{c}.hits", f"{c}.settings.entity", score_of)
    kept = lambda s: keep(s, lambda one: f"{one}.score IS NOT NULL") if checks else s
    context = f"{c}.settings.context"
    raised = lambda s: let(kept(s), lambda k: case(f"size({k}) > 0", boost_by_context(text, k, context), k))
    boosted = let(spans, lambda s: case(f"size({context}) > 0", raised(s), s))
    # A discarded match has no score, which reaches no threshold.
    return keep(boosted, lambda s: f"{s}.score >= {c}.settings.threshold")


def _gates(text: Sql, group: Sequence[Recognizer]) -> list[Sql]:
    """Cheap conditions that every text with a match fulfils, cheapest first."""
    regexes = [p.regex for r in group for p in r.patterns]
    gates = [f"octet_length({text}) >= {min(map(min_width, regexes))}"]
    if group[0].needs:
        gates.append(f"contains({text}, {lit(group[0].needs)})")
    elif len(regexes) > 1 and not any(re.search(r"\\[1-9k]|\(\?<[A-Za-z]", x) for x in regexes):
        union = "|".join(f"(?:{x})" for x in regexes)
        firsts = [_first(r) for r in group]
        start = f"(?=[{''.join(dict.fromkeys(firsts))}])" if all(firsts) else ""
        gates.append(f"{text} RLIKE {lit(f'{start}(?:{union})')}")
    return gates


def detect(text: Sql, recognizers: Sequence[Recognizer], language: Sql | None = None) -> Sql:
    """``array<span>`` of everything the recognizers find in ``text``; empty for NULL.

    Recognizers that share a gate are searched together: one scan of the text decides whether any
    of their patterns occurs, and only then is each of them searched. Matches of all patterns are
    located by one piece of the plan, which keeps plans of many patterns and columns small. With ``language``, a
    recognizer that is bound to languages applies to rows of these languages only.
    """
    whole = [r for r in recognizers if r.whole]
    terms: dict[object, list[Recognizer]] = {}
    for r in recognizers:
        if r.terms:
            terms.setdefault(r.languages if language is not None else None, []).append(r)
    groups: dict[object, list[Recognizer]] = {}
    for r in recognizers:
        if r.patterns:
            bound = r.languages if language is not None else None
            groups.setdefault((bound, r.needs or ("first" if _first(r) else (r.entity, r.patterns))), []).append(r)

    def search(t: Sql) -> Sql:
        parts = [whole_value_span(t, r.entity, 1.0) for r in whole]
        for bound, group in terms.items():
            parts.append(case(f"{language} IN ({', '.join(map(lit, sorted(bound)))})", _listed(t, group), NO_SPANS) if bound else _listed(t, group))
        listed = []
        for (bound, _), group in groups.items():
            conditions = [f"{language} IN ({', '.join(map(lit, sorted(bound)))})"] if bound else []
            conditions += _gates(t, group)
            candidates = f"CASE WHEN {' AND '.join(conditions)} THEN {_candidates(t, group)} END"
            listed.append(f"coalesce({candidates}, array())")
        if listed:
            checks = {r.check for r in recognizers if r.check}
            found = f"concat({', '.join(listed)})"
            parts.append(f"flatten({each(found, lambda c: _spans_of(t, c, checks))})")
        every = f"concat({', '.join(parts)})"
        widths = [min([*(min_width(p.regex) for p in r.patterns), *(len(x) for x, _ in r.terms), *[1] * r.whole]) for r in recognizers]
        worth = f"octet_length({t}) >= {max(2, min(widths))} AND {worth_analysing(t)}"
        return case(worth, distinct_spans(every), NO_SPANS)

    return let(text, search) if recognizers else NO_SPANS

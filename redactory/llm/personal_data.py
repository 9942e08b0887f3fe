"""Personal data by fixed patterns and by bootstrapped contexts, in DataFrame expressions only.

Fixed patterns find e-mail addresses, IP addresses, payment cards and phone numbers. They are the seeds of a
graph of values and lexical patterns (the words around a value). In every round a pattern is scored by the share
of its different values that are known to be of a kind, a value by the patterns that it occurs in; patterns and
values of high confidence are kept and feed the next round. Values that look like identifiers and are reached
this way become spans, whatever their form.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from redactory.functions.spans import running
from redactory.functions.text import Sql, case, each, fn, fold, keep, let, lit, struct

from .common import text_or_empty, written

#: Code points on either side of a span that its context is read from.
CONTEXT = 64
ROUNDS = 3
#: Different known values that a pattern needs, and least confidence of a pattern and of a value.
SUPPORT, PATTERN_CONFIDENCE, VALUE_CONFIDENCE = 3, 0.7, 0.8


@dataclass(frozen=True)
class Kind:
    """``pattern`` finds what the plain pattern of the kind finds, in time linear in the text: it starts only where
    a run of its first characters starts, or where the last match ended, and never gives characters back.
    ``present`` tells cheaply whether a text can hold one; ``valid`` (SQL of ``{}``, the match) decides."""

    name: str
    pattern: str
    present: str
    valid: str


def digits(value: Sql) -> Sql:
    return f"regexp_replace({value}, '[^0-9]', '')"


def luhn(value: Sql) -> Sql:
    """Whether a string of digits passes the check: every second digit from the right counts double."""

    def total(d: Sql) -> Sql:
        place = lambda i: f"cast(substring({d}, length({d}) - {i}, 1) AS int)"
        doubled = lambda x: case(f"{x} > 4", f"{x} * 2 - 9", f"{x} * 2")
        one = lambda acc, i: f"{acc} + " + let(place(i), lambda x: case(f"{i} % 2 = 1", doubled(x), x))
        return fold(f"sequence(0, length({d}) - 1)", "0", one, lambda acc: f"{acc} % 10 = 0")

    return let(value, total)


def small_parts(value: Sql) -> Sql:
    part = lambda p: f"(length(ltrim('0', {p})) < 3 OR length(ltrim('0', {p})) = 3 AND ltrim('0', {p}) <= '255')"
    return f"forall(split({value}, '[.]'), {fn(part)})"


KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "contains({}, '@')",
        "true",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"{} RLIKE '[0-9][.][0-9]++[.][0-9]++[.][0-9]'",
        "small_parts",
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"{} RLIKE '[0-9](?:[\\x20-]?[0-9]){{13}}'", "card"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "contains({}, '+')", "phone"),
)
VALID = {
    "true": lambda v: "true",
    "small_parts": small_parts,
    "card": lambda v: let(digits(v), lambda d: case(f"length({d}) BETWEEN 14 AND 19", luhn(d), "false")),
    "phone": lambda v: f"length({digits(v)}) BETWEEN 10 AND 15",
}
#: What looks like an identifier: letters, digits and joints, with four digits at least.
CANDIDATE = r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])[A-Za-z0-9]++(?:[._@+/-][A-Za-z0-9]++)*+"
SPAN = "struct<start:int,end:int,kind:int,value:string,before:string,after:string>"


def located(text: Sql, pattern: str, number: int, valid) -> Sql:
    """Valid matches as ``array<SPAN>``: places from the gaps between matches, contexts from their ends."""

    def spans(hits: Sql) -> Sql:
        def placed(gaps: Sql) -> Sql:
            advance = f"zip_with(slice({gaps}, 1, size({hits})), {hits}, {fn(lambda g, h: f'length({g}) + length({h})')})"

            def one(ends: Sql):
                return each(
                    hits,
                    lambda h, i: struct(
                        start=f"get({ends}, {i}) - length({h})",
                        end=f"get({ends}, {i})",
                        kind=str(number),
                        value=h,
                        before=f"right(get({gaps}, {i}), {CONTEXT})",
                        after=f"left(get({gaps}, {i} + 1), {CONTEXT})",
                    ),
                )

            return let(running(advance, 0, lambda total, n: f"{total} + {n}"), one)

        return let(f"split({text}, {lit(pattern)}, -1)", placed)

    none = f"cast(array() AS array<{SPAN}>)"
    found = let(
        f"regexp_extract_all({text}, {lit(pattern)}, 0)", lambda hits: case(f"size({hits}) > 0", spans(hits), none)
    )
    return keep(found, lambda s: valid(f"{s}.value"))


def base_spans(text: Sql) -> list[Sql]:
    none = f"cast(array() AS array<{SPAN}>)"
    return [
        case(kind.present.format(text), located(text, kind.pattern, i, VALID[kind.valid]), none) for i, kind in enumerate(KINDS)
    ]


def candidates(text: Sql) -> Sql:
    none = f"cast(array() AS array<{SPAN}>)"
    many = lambda v: f"length({digits(v)}) >= 4"
    return case(f"{text} RLIKE '[0-9]'", located(text, CANDIDATE, -1, many), none)


# --- values and patterns ---


def occurrences(found: DataFrame) -> DataFrame:
    """``_row, start, end, kind (-1: not known), value, pattern`` of base spans and of candidates beside them; one
    row per pattern: the two words before, and the word before with the word after."""
    spans = found.select("_row", F.explode(F.concat("base", "candidates")).alias("s")).select("_row", "s.*")
    before = Window.partitionBy("_row").orderBy("start", F.col("kind").desc()).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("_row").orderBy("start", F.col("kind").desc()).rowsBetween(1, Window.unboundedFollowing)
    known = F.col("kind") >= 0
    spans = spans.withColumn("_end", F.max(F.when(known, F.col("end"))).over(before))
    spans = spans.withColumn("_next", F.min(F.when(known, F.col("start"))).over(after))
    free = F.coalesce(F.col("_end") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("_next") >= F.col("end"), F.lit(True))
    spans = spans.where(known | free)
    words = r"([^\x20\x09-\x0D]+[\x20\x09-\x0D]*){0}$"
    last = F.lower(F.regexp_extract("before", words.format("{1}"), 0))
    last_two = F.lower(F.regexp_extract("before", words.format("{2}"), 0))
    following = F.lower(F.regexp_extract("after", r"^[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", 0))
    none = F.lit(None).cast("string")
    patterns = F.array(
        F.when(last_two != "", F.concat(F.lit("2|"), last_two)).otherwise(none),
        F.when((last != "") & (following != ""), F.concat(F.lit("1|"), last, F.lit("|"), following)).otherwise(none),
    )
    rows = spans.select("_row", "start", "end", "kind", "value", F.explode(F.array_compact(patterns)).alias("pattern"))
    return rows.withColumn("pattern", F.xxhash64("pattern"))


def discovered(seen: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``value, kind`` of values that patterns of high confidence reach. Counts are combined before they are
    shuffled and joined back by pattern or value, so common words and values are split like other skewed keys."""
    links = written(seen.select("pattern", "value", "kind").distinct(), "links")
    facts = written(links.where("kind >= 0").select("value", "kind").distinct(), "facts")
    all_values = links.select("pattern", "value").distinct()
    totals = written(all_values.groupBy("pattern").agg(F.count("*").alias("n")), "patterns")
    fresh = facts
    for _ in range(rounds):
        hits = all_values.join(facts, "value").groupBy("pattern", "kind").agg(F.count("*").alias("known"))
        hits = hits.where(F.col("known") >= SUPPORT).join(totals, "pattern")
        scored = hits.withColumn("confidence", F.col("known") / (F.col("n") + 1))
        scored = scored.where(F.col("confidence") >= PATTERN_CONFIDENCE).select("pattern", "kind", "confidence")
        doubt = F.exp(F.sum(F.log(1 - F.col("confidence"))))
        reached = all_values.join(scored, "pattern").groupBy("value", "kind").agg((1 - doubt).alias("confidence"))
        reached = reached.where(F.col("confidence") >= VALUE_CONFIDENCE)
        best = reached.groupBy("value").agg(F.max(F.struct("confidence", (-F.col("kind")).alias("k"))).alias("b"))
        fresh = best.select("value", (-F.col("b.k")).alias("kind")).join(facts.select("value").distinct(), "value", "left_anti")
        fresh = written(fresh, "found")
        if fresh.limit(1).count() == 0:
            break
        facts = written(facts.union(fresh), "facts")
    return facts


def texts_of(spans: str) -> str:
    name = "element_at(array(" + ", ".join(lit(k.name) for k in KINDS) + "), {} + 1)"
    one = lambda s: f"concat_ws(':', {name.format(s + '.kind')}, {s}.start, {s}.end)"
    return f"array_join(transform({spans}, {fn(one)}), ',')"


def personal_data(df: DataFrame, text: str = "text", keep_columns: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """For every row of ``df`` its ``keep_columns`` and: ``n_email, n_ip, n_card, n_phone`` (by the fixed patterns),
    ``base`` and ``spans`` (``array<struct<start,end,kind>>`` by start, then kind; code points, end exclusive):
    spans of the fixed patterns, and all spans.

    A null text counts as empty; keys may be null or repeated. The text is searched once, and its spans are
    written to the shared folder before they are scored.
    """
    rows = df.select(*keep_columns, text_or_empty(text).alias("_text"))
    found = rows.selectExpr(
        *[f"`{c}`" for c in keep_columns],
        "monotonically_increasing_id() AS _row",
        *[f"{expression} AS _{kind.name}" for kind, expression in zip(KINDS, base_spans("_text"))],
        f"{candidates('_text')} AS candidates",
    )
    names = [f"_{kind.name}" for kind in KINDS]
    found = found.withColumn("base", F.concat(*names))
    counts = [F.size(name).cast("long").alias(f"n{name}") for name in names]
    found = written(found.select(*keep_columns, "_row", *counts, "base", "candidates"), "spans")
    seen = written(occurrences(found.where(F.size("base") + F.size("candidates") > 0)), "occurrences")
    facts = discovered(seen)
    new = seen.where("kind < 0").select("_row", "start", "end", "value").distinct().join(facts, "value", "inner")
    new = new.groupBy("_row").agg(F.collect_list(F.struct("start", "end", facts["kind"])).alias("_new"))
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    by_start = "array_sort({}, (a, b) -> CASE WHEN a.start <> b.start THEN a.start - b.start ELSE a.kind - b.kind END)"
    result = found.join(new, "_row", "left").withColumn("base", plain)
    result = result.withColumn("spans", F.expr(by_start.format("concat(base, coalesce(_new, slice(base, 1, 0)))")))
    result = result.withColumn("base", F.expr(by_start.format("base")))
    return result.select(*keep_columns, *[f"n{name}" for name in names], "base", "spans")


def masked(text: Sql, spans: Sql) -> Sql:
    """The text with each span (sorted by start) replaced by its kind in angle brackets; what an earlier span
    covers already is not replaced again."""
    name = "element_at(array(" + ", ".join(lit(k.name) for k in KINDS) + "), {} + 1)"

    def rewritten(ends: Sql) -> Sql:
        """``ends``: the furthest end of the spans before each one."""

        def one(s: Sql, i: Sql) -> Sql:
            gap = f"substring({text}, get({ends}, {i}) + 1, {s}.start - get({ends}, {i}))"
            return case(f"{s}.start >= get({ends}, {i})", f"concat({gap}, '<', {name.format(s + '.kind')}, '>')", "''")

        rest = f"substring({text}, get({ends}, size({spans})) + 1)"
        return f"concat(array_join({each(spans, one)}, ''), {rest})"

    advance = lambda last, n: f"greatest({last}, {n})"
    ends = running(f"concat(array(0), {each(spans, lambda s: f'{s}.end')})", 0, advance)
    return let(ends, rewritten)

"""Spans: building them from regular expressions, resolving overlaps, rewriting text.

A span is ``struct<entity,start,end,score,value>`` with 0-based code-point offsets and an
exclusive end; a cell carries ``array<span>``. Every function takes and returns SQL expressions.

Cost per cell grows linearly with its hits: Spark copies an array on every append and walks a
string from its beginning on every ``substring``, so long folds and reads work block by block.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from .text import Sql, case, each, fn, fold, keep, let, lit, struct

SPAN_TYPE = "struct<entity:string,start:int,end:int,score:double,value:string>"
SPANS_TYPE = f"array<{SPAN_TYPE}>"
NO_SPANS = f"cast(array() AS {SPANS_TYPE})"
BLOCK = 128
PIECE = 64


def make_span(entity: Sql, start: Sql, end: Sql, score: Sql, value: Sql) -> Sql:
    return struct(entity=entity, start=start, end=end, score=score, value=value)


def scan(
    values: Sql, start: Sql, step: Callable[[Sql, Sql], Sql], out: Callable[[Sql], Sql], out_type: str
) -> Sql:
    """``out`` of the state after each element of a non-empty array, as ``array<out_type>``.

    ``step`` takes the state and an element and gives the next state. The results are collected block by block.
    """

    def one_block(outer: Sql, block: Sql) -> Sql:
        advance = lambda acc, v: let(
            step(f"{acc}.state", v), lambda n: struct(state=n, seen=f"array_append({acc}.seen, {out(n)})")
        )
        finish = lambda acc: struct(state=f"{acc}.state", blocks=f"array_append({outer}.blocks, {acc}.seen)")
        return fold(block, struct(state=f"{outer}.state", seen=f"cast(array() AS array<{out_type}>)"), advance, finish)

    def blocks(bound: Sql) -> Sql:
        cut = each(f"sequence(1, size({bound}), {BLOCK})", lambda first: f"slice({bound}, {first}, {BLOCK})")
        begin = struct(state=start, blocks=f"cast(array() AS array<array<{out_type}>>)")
        return f"flatten({fold(cut, begin, one_block, lambda acc: f'{acc}.blocks')})"

    return let(values, blocks)


def running(values: Sql, zero: int, step: Callable[[Sql, Sql], Sql]) -> Sql:
    """Running fold of a non-empty ``array<int>``: element i is the fold of elements 0..i."""
    return scan(values, str(zero), step, lambda state: state, "int")


def locate(text: Sql, regex: Sql, hits: Sql, entity: Sql, score_of: Callable[[Sql], Sql]) -> Sql:
    """Spans of ``hits``, the non-empty list of all matches of ``regex`` in ``text``.

    Offsets follow from the gaps between the matches, so only texts with a match are searched a
    second time. ``score_of`` maps a matched value to its score.
    """
    gaps = f"slice(split({text}, {regex}, -1), 1, size({hits}))"
    advance = f"zip_with({gaps}, {hits}, {fn(lambda gap, hit: f'length({gap}) + length({hit})')})"
    as_span = lambda hit, end: make_span(entity, f"{end} - length({hit})", end, score_of(hit), hit)
    searched = f"length(split({text}, {regex}, 2)[0]) + length({hits}[0])"
    # A matched value that the text holds once is where it stands, which needs no second search for the pattern.
    once = lambda at: f"{at} > 0 AND locate({hits}[0], {text}, {at} + 1) = 0"
    first = let(f"instr({text}, {hits}[0])", lambda at: case(once(at), f"{at} - 1 + length({hits}[0])", searched))
    ends = running(advance, 0, lambda total, n: f"{total} + {n}")
    alone = f"array({let(first, lambda end: as_span(f'{hits}[0]', end))})"
    return case(f"size({hits}) = 1", alone, f"zip_with({hits}, {ends}, {fn(as_span)})")


def regex_spans(text: Sql, entity: str, regex: str, score: float) -> Sql:
    """All non-overlapping matches of one regular expression as spans in text order."""
    found = lambda hits: locate(text, lit(regex), hits, lit(entity), lambda value: lit(float(score)))
    return let(
        f"regexp_extract_all({text}, {lit(regex)}, 0)", lambda hits: case(f"size({hits}) > 0", found(hits), NO_SPANS)
    )


def whole_value_span(text: Sql, entity: str, score: float) -> Sql:
    """The complete value as one span."""
    return f"array({make_span(lit(entity), '0', f'length({text})', lit(float(score)), text)})"


def read_around(text: Sql, spans: Sql, first_char: Callable[[Sql], Sql], body: Callable[[Sql, Sql, Sql, Sql], Sql]) -> Sql:
    """``transform`` over sorted, non-empty spans for bodies that read the text around each span.

    Each block of spans gets its own piece of the text: ``body(span, i, piece, offset)``, where
    ``offset`` is the position of the piece and ``first_char(i)`` tells where the piece of the
    block that starts with span ``i`` must begin. It ends where the last span of the block ends.
    """

    def one_block(at: Sql) -> Sql:
        block = f"slice({spans}, {at} + 1, {PIECE})"
        until = f"get({spans}, least({at} + {PIECE}, size({spans})) - 1).end"
        cut = lambda first: struct(piece=f"substring({text}, {first} + 1, {until} - {first})", offset=first)
        within = lambda w: each(block, lambda s, i: body(s, f"({at} + {i})", f"{w}.piece", f"{w}.offset"))
        return let(let(first_char(at), cut), within)

    return f"flatten({each(f'sequence(0, size({spans}) - 1, {PIECE})', one_block)})"


def boost_by_context(text: Sql, spans: Sql, words: Sql, window: int = 60, boost: float = 0.35) -> Sql:
    """Raise the score of spans preceded, within ``window`` characters, by one of ``words``, an
    array of lower-case strings. ``spans`` must be in text order and not empty.
    """
    opening = lambda start: f"greatest({start} - {window}, 0)"

    def rescored(span: Sql, i: Sql, piece: Sql, offset: Sql) -> Sql:
        first = opening(f"{span}.start")
        ahead = f"lower(substring({piece}, {first} - {offset} + 1, {span}.start - {first}))"
        near = lambda a: f"exists({words}, {fn(lambda w: f'contains({a}, {w})')})"
        raised = f"least(1.0D, {span}.score + {lit(boost)})"
        score = let(ahead, lambda a: case(near(a), raised, f"{span}.score"))
        return make_span(f"{span}.entity", f"{span}.start", f"{span}.end", score, f"{span}.value")

    def boosted(s: Sql) -> Sql:
        alone = each(s, lambda span: rescored(span, "0", text, "0"))
        return case(
            f"size({s}) = 1", alone, read_around(text, s, lambda at: opening(f"get({s}, {at}).start"), rescored)
        )

    return let(spans, boosted)


def at_least(spans: Sql, threshold: float | None) -> Sql:
    """Confidence filter; no threshold (or 0) keeps everything."""
    return keep(spans, lambda s: f"{s}.score >= {lit(float(threshold))}") if threshold else spans


def only_entities(spans: Sql, entities: Sequence[str]) -> Sql:
    """Entity allow-list; an empty list keeps everything."""
    listed = ", ".join(map(lit, entities))
    return keep(spans, lambda s: f"{s}.entity IN ({listed})") if entities else spans


def distinct_spans(spans: Sql) -> Sql:
    """Sort by (entity, start, end) and keep the best score of identical spans."""

    def dedupe(ordered: Sql) -> Sql:
        def differs(s: Sql, i: Sql) -> Sql:
            same = lambda n: f"coalesce({n}.entity = {s}.entity AND {n}.start = {s}.start AND {n}.end = {s}.end, false)"
            return "NOT " + let(f"get({ordered}, {i} + 1)", same)

        return keep(ordered, differs)

    return let(spans, lambda s: case(f"size({s}) > 1", let(f"sort_array({s})", dedupe), s))


def _placed(start: Sql, end: Sql, entity: Sql, score: Sql, value: Sql) -> Sql:
    """A span with the offset first, so that natural order is text order."""
    return struct(start=start, end=end, entity=entity, score=score, value=value)


def _groups(ordered: Sql) -> Sql:
    """Cut spans in text order into runs that do not overlap each other: ``array<array<span>>``."""

    def cut(reach: Sql) -> Sql:
        opens = lambda i: f"{i} = 0 OR get({ordered}, {i}).start >= get({reach}, {i} - 1)"
        heads = keep(f"sequence(0, size({ordered}) - 1)", opens)
        until = lambda first, i: f"coalesce(get({first}, {i} + 1), size({ordered}))"
        # Element by element: ``slice`` walks the whole array for every piece.
        piece = lambda at, end: each(f"sequence({at}, {end} - 1)", lambda k: f"get({ordered}, {k})")
        run = lambda first: each(first, lambda at, i: piece(at, until(first, i)))
        return let(heads, run)

    ends = each(ordered, lambda s: f"{s}.end")
    return let(running(ends, 0, lambda far, end: f"greatest({far}, {end})"), cut)


def _hulls(spans: Sql) -> Sql:
    """Merge overlapping spans of one entity into their hull, keeping the best score."""

    def hull(group: Sql) -> Sql:
        def extend(acc: Sql, s: Sql) -> Sql:
            return let(
                f"greatest({s}.end - {acc}.end, 0)",
                lambda new: struct(
                    end=f"{acc}.end + {new}",
                    value=f"concat({acc}.value, right({s}.value, {new}))",
                    score=f"greatest({acc}.score, {s}.score)",
                ),
            )

        head = f"{group}[0]"
        start = struct(end=f"{head}.end", value=f"{head}.value", score=f"{head}.score")
        finish = lambda a: _placed(f"{head}.start", f"{a}.end", f"{head}.entity", f"{a}.score", f"{a}.value")
        return case(f"size({group}) = 1", head, fold(group, start, extend, finish))

    of_entity = lambda entity: let(
        keep(spans, lambda s: f"{s}.entity = {entity}"), lambda own: each(_groups(own), hull)
    )
    return f"flatten({each(f'array_distinct({each(spans, lambda s: f"{s}.entity")})', of_entity)})"


def _claim(group: Sql) -> Sql:
    """Give every character of an overlapping group to the strongest span that covers it.

    Strength is (score desc, length desc, start asc, entity asc). This equals placing the spans
    greedily in that order and clipping each to what is still uncovered, so no detected
    character is left out.
    """
    rank = lambda s: struct(
        worst=f"-{s}.score", shortest=f"{s}.start - {s}.end", start=f"{s}.start", entity=f"{s}.entity", value=f"{s}.value"
    )
    edges = f"concat({each(group, lambda s: f'{s}.start')}, {each(group, lambda s: f'{s}.end')})"
    # Spans of one entity do not overlap any more, so at most ``most`` of them begin, or are open, at any edge.
    most = f"size(array_distinct({each(group, lambda s: f'{s}.entity')}))"

    def owners(lefts: Sql, width: Sql) -> Sql:
        """The strongest span open at each edge: a sweep over the edges that keeps the spans that are open."""

        def advance(state: Sql, left: Sql) -> Sql:
            ahead = each(f"sequence({state}.next, {state}.next + {width} - 1)", lambda k: f"get({group}, {k})")
            begun = keep(ahead, lambda s: f"coalesce({s}.start <= {left}, false)")
            still = keep(f"{state}.open", lambda s: f"{s}.end > {left}")
            return let(begun, lambda b: struct(next=f"{state}.next + size({b})", open=f"concat({still}, {b})"))

        begin = struct(next="0", open=f"slice({group}, 1, 0)")
        strongest = lambda state: f"array_min({each(f'{state}.open', rank)})"
        return scan(lefts, begin, advance, strongest, "struct<worst:double,shortest:int,start:int,entity:string,value:string>")

    def pieces(cuts: Sql) -> Sql:
        lefts = f"slice({cuts}, 1, size({cuts}) - 1)"
        paired = fn(lambda left, owner: struct(left=left, owner=owner))
        owned = let(most, lambda width: f"zip_with({lefts}, {owners(lefts, width)}, {paired})")

        def merged(segments: Sql) -> Sql:
            changes = keep(segments, lambda s, i: f"{i} = 0 OR get({segments}, {i} - 1).owner != {s}.owner")

            def piece(runs: Sql, s: Sql, i: Sql) -> Sql:
                right = f"coalesce(get({runs}, {i} + 1).left, element_at({cuts}, -1))"
                own = f"{s}.owner"
                cut = lambda r: _placed(
                    f"{s}.left", r, f"{own}.entity", f"-{own}.worst",
                    f"substring({own}.value, {s}.left - {own}.start + 1, {r} - {s}.left)",
                )
                return let(right, cut)

            return let(changes, lambda runs: each(runs, lambda s, i: piece(runs, s, i)))

        return let(owned, merged)

    return let(f"sort_array(array_distinct({edges}))", pieces)


def resolve_spans(spans: Sql) -> Sql:
    """Disjoint spans in text order that cover exactly the characters covered by ``spans``.

    Overlaps of one entity become their hull; overlaps of different entities go to the stronger
    span, the weaker one keeping its uncovered part. Cells without overlaps only pay a sort.
    """
    placed = each(spans, lambda s: _placed(f"{s}.start", f"{s}.end", f"{s}.entity", f"{s}.score", f"{s}.value"))

    def settle(ordered: Sql) -> Sql:
        collide = fn(lambda i: f"get({ordered}, {i}).start < get({ordered}, {i} - 1).end")
        overlapping = f"size({ordered}) > 1 AND exists(sequence(1, size({ordered}) - 1), {collide})"
        disjoint = lambda groups: f"flatten({each(groups, lambda g: case(f'size({g}) = 1', g, _claim(g)))})"
        settled = let(f"sort_array({_hulls(ordered)})", lambda hulls: let(_groups(hulls), disjoint))
        return case(overlapping, settled, ordered)

    final = each(
        let(f"sort_array({placed})", settle),
        lambda s: make_span(f"{s}.entity", f"{s}.start", f"{s}.end", f"{s}.score", f"{s}.value"),
    )
    return f"CASE WHEN size({spans}) > 1 THEN {final} WHEN size({spans}) = 1 THEN {spans} ELSE {NO_SPANS} END"


def rewrite(text: Sql, resolved: Sql, mask: Callable[[Sql, Sql], Sql]) -> Sql:
    """Replace each resolved span by ``mask(span, index)``; text without spans is returned as is."""

    def assemble(spans: Sql) -> Sql:
        end_before = lambda i: f"coalesce(get({spans}, {i} - 1).end, 0)"

        def piece(span: Sql, i: Sql, part: Sql, offset: Sql) -> Sql:
            gap = lambda last: f"substring({part}, {last} - {offset} + 1, {span}.start - {last})"
            return f"concat({let(end_before(i), gap)}, {mask(span, i)})"

        tail = f"substring({text}, element_at({spans}, -1).end + 1)"
        body = f"concat(array_join({read_around(text, spans, end_before, piece)}, ''), {tail})"
        return case(f"size({spans}) > 0", body, text)

    return let(resolved, assemble)

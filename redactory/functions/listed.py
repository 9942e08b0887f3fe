"""Listed terms inside a text, without a join: the list is a value of the plan, dealt out by hash.

Every term is filed under one of its words, the one that fewest terms share, in ``array<string>``: a word of a text looks
into the slot of its CRC-32, a text of some entries, and meets only terms that hold it. The filed words of all lists lie in
one more such value, so a word costs one look-up, however many lists there are; the surroundings of the words that are filed
are compared with the rest of their terms. Slots are texts because a plan with an object for every part of every term would be
many times as large as the list.
"""

from __future__ import annotations

import itertools
import json
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from .spans import NO_SPANS, locate, make_span, read_around, running
from .text import Sql, case, each, fn, keep, let, lit, struct

#: What a word is made of, for Spark and for Python.
WORD = r"[\p{L}\p{N}_]+"
WORD_HERE = re.compile(r"\w+")
#: So many filed words of a text are placed one by one; for more, all words of the text are located in one go.
FEW = 8


#: Entries that a slot holds on average.
SLOT_ENTRIES = 2


def _slots(filed: Sequence[tuple[str, str]], mark: str) -> tuple[str, ...]:
    """Entries by the slot of their word, each between two ``mark``."""
    slots: list[list[str]] = [[] for _ in range(len(filed) // SLOT_ENTRIES + 1)]
    for word, entry in filed:
        slots[zlib.crc32(word.encode()) % len(slots)].append(entry)
    return tuple(mark + mark.join(own) + mark if own else "" for own in slots)


def _constant(slots: Sequence[str]) -> Sql:
    return f"from_json({lit(json.dumps(slots, ensure_ascii=False))}, 'array<string>')"


def _slot_of(slots: Sql, word: Sql, n: int) -> Sql:
    return f"get({slots}, cast(crc32({word}) % {n} AS int))"


def _marks(terms: Iterable[str], n: int) -> list[str]:
    """Characters that no term holds and that mean nothing in a pattern."""
    used = set().union(*map(set, terms)) if terms else set()
    free = (chr(i) for i in (*range(1, 9), *range(0xE000, 0xF900), *range(0xF0000, 0xFFFFE)))
    return list(itertools.islice((c for c in free if c not in used), n))


@dataclass(frozen=True)
class TermIndex:
    """Terms with their scores, filed by word. ``ahead`` and ``behind`` are the most characters that a term has from that
    word on and before it. An entry is the term from that word on, what it has before, and its score."""

    slots: tuple[str, ...]
    marks: tuple[str, str]
    words: tuple[str, ...]
    ahead: int
    behind: int

    @classmethod
    def of(cls, terms: Sequence[tuple[str, float]]) -> TermIndex:
        words = {term: WORD_HERE.findall(term) for term, _ in terms}
        shared = Counter(word for own in words.values() for word in set(own))
        part, entry = _marks(words, 2)
        filed, ahead, behind = [], 0, 0
        for term, score in terms:
            if not words[term]:
                raise ValueError(f"a listed term needs a letter or digit: {term!r}")
            place = min(WORD_HERE.finditer(term), key=lambda m: (shared[m.group()], -len(m.group()), m.start()))
            lead, rest = term[: place.start()], term[place.start() :]
            filed.append((place.group(), part.join((rest, lead, repr(float(score))))))
            ahead, behind = max(ahead, len(rest)), max(behind, len(lead))
        return cls(_slots(filed, entry), (part, entry), tuple(sorted({w for w, _ in filed})), ahead, behind)

    def value(self) -> Sql:
        """The slots as a constant of the plan; Spark reads the text once, when it optimizes the plan."""
        return _constant(self.slots)

    def filed(self, slots: Sql, word: Sql) -> Sql:
        """The entries under ``word``, and under longer words of its slot that begin with it, as ``array<array<string>>``;
        the latter do not stand at a whole ``word``."""
        part, entry = map(lit, self.marks)
        entries = lambda s: f"regexp_extract_all({s}, concat('[^', {entry}, ']+'), 0)"
        own = lambda s: keep(entries(s), lambda e: f"startswith({e}, {word})")
        parts = lambda s: each(own(s), lambda e: f"array({', '.join(f'split_part({e}, {part}, {i})' for i in (1, 2, 3))})")
        found = lambda s: case(f"contains({s}, concat({entry}, {word}))", parts(s), "cast(array() AS array<array<string>>)")
        return let(_slot_of(slots, word, len(self.slots)), found)

    def has(self, slots: Sql, word: Sql) -> Sql:
        """Whether ``filed`` gives entries."""
        return f"contains({_slot_of(slots, word, len(self.slots))}, concat({lit(self.marks[1])}, {word}))"


@dataclass(frozen=True)
class FiledWords:
    """The words under which the terms of some lists are filed; none holds a line end."""

    slots: tuple[str, ...]

    @classmethod
    def of(cls, indexes: Sequence[TermIndex]) -> FiledWords:
        return cls(_slots([(w, w) for w in sorted({w for index in indexes for w in index.words})], "\n"))

    def value(self) -> Sql:
        return _constant(self.slots)

    def has(self, slots: Sql, word: Sql) -> Sql:
        return f"contains({_slot_of(slots, word, len(self.slots))}, concat('\\n', {word}, '\\n'))"


def located_words(text: Sql, words: Sql, filed: Callable[[Sql], Sql]) -> Sql:
    """The words of ``text`` that are filed, in place. ``words`` are all matches of ``WORD``, ``filed`` tells whether terms
    are filed under a word. A word costs one look-up; a few filed words are placed by what stands before them, and for
    more all words are located, once for however many lists."""

    def placed(hits: Sql) -> Sql:
        def one(gaps: Sql, at: Sql) -> Sql:
            before = f"length(array_join(slice({gaps}, 1, {at} + 1), '')) + length(array_join(slice({words}, 1, {at}), ''))"
            word = f"get({words}, {at})"
            return let(before, lambda b: make_span(lit(""), b, f"{b} + length({word})", "0D", word))

        few = let(f"split({text}, {lit(WORD)}, -1)", lambda gaps: each(hits, lambda at: one(gaps, at)))
        located = locate(text, lit(WORD), words, lit(""), lambda value: "0D")
        many = let(located, lambda every: each(hits, lambda at: f"get({every}, {at})"))
        return f"CASE WHEN size({hits}) = 0 THEN {NO_SPANS} WHEN size({hits}) <= {FEW} THEN {few} ELSE {many} END"

    hits = keep(f"sequence(0, size({words}) - 1)", lambda at: filed(f"get({words}, {at})"))
    return case(f"size({words}) > 0", let(hits, placed), NO_SPANS)


def listed_spans(text: Sql, located: Sql, entity: str, index: TermIndex, slots: Sql) -> Sql:
    """Whole-word occurrences of the terms, leftmost first and the longest of those that start alike; a term inside
    another occurrence is not reported. ``located`` are the words of ``text`` that are filed, here or in other lists, and
    ``slots`` is the bound value of ``index``."""
    around = index.behind + 1
    opening = lambda start: f"greatest(0, {start} - {around})"

    def found(hit: Sql, own: Sql, piece: Sql, offset: Sql) -> Sql:
        """The terms of ``own`` that stand around ``hit``; ``piece`` is the text from ``offset`` on."""
        first = opening(f"{hit}.start")
        ahead = f"substring({piece}, {hit}.start - {offset} + 1, {index.ahead + 1})"
        behind = f"substring({piece}, {first} - {offset} + 1, {hit}.start - {first})"

        def whole_terms(a: Sql, b: Sql) -> Sql:
            after = lambda e: f"substring({a}, length({e}[0]) + 1, 1)"
            before = lambda e: f"right(left({b}, length({b}) - length({e}[1])), 1)"
            whole = lambda e: (
                f"startswith({a}, {e}[0]) AND endswith({b}, {e}[1]) AND NOT {after(e)} RLIKE {lit(WORD)}"
                f" AND NOT {before(e)} RLIKE {lit(WORD)}"
            )
            placed = lambda e: struct(
                start=f"{hit}.start - length({e}[1])",
                shortest=f"-{hit}.start - length({e}[0])",
                score=f"cast({e}[2] AS double)",
                value=f"concat({e}[1], {e}[0])",
            )
            return each(keep(own, whole), placed)

        return let(ahead, lambda a: let(behind, lambda b: whole_terms(a, b)))

    def one_by_one(hits: Sql) -> Sql:
        """For a few hits: each reads its surroundings from the text itself, if this list has terms for it."""
        none = "cast(array() AS array<struct<start:int,shortest:int,score:double,value:string>>)"
        terms = lambda s: let(
            index.filed(slots, f"{s}.value"), lambda own: case(f"size({own}) > 0", found(s, own, text, "0"), none)
        )
        return f"flatten({each(hits, terms)})"

    def by_pieces(hits: Sql) -> Sql:
        # Stretched, so that the piece of text read for a block reaches beyond its last word.
        stretched = each(
            hits, lambda s: struct(start=f"{s}.start", end=f"{s}.end + {index.ahead}", value=f"{s}.value")
        )
        body = lambda hit, i, piece, offset: found(hit, index.filed(slots, f"{hit}.value"), piece, offset)
        read = lambda h: f"flatten({read_around(text, h, lambda at: opening(f'get({h}, {at}).start'), body)})"
        return let(stretched, read)

    settled = lambda matches: let(f"sort_array({matches})", leftmost)

    def among_many(hits: Sql) -> Sql:
        return case(f"size({hits}) > 0", settled(by_pieces(hits)), NO_SPANS)

    def leftmost(m: Sql) -> Sql:
        """Of matches in order, those that do not start inside one that was taken before."""
        free = lambda until, i: case(f"get({m}, {i}).start >= {until}", f"-get({m}, {i}).shortest", until)
        until = running(f"sequence(0, size({m}) - 1)", 0, free)
        taken = let(until, lambda u: keep(m, lambda s, i: f"{s}.start >= coalesce(get({u}, {i} - 1), 0)"))
        span = lambda s: make_span(lit(entity), f"{s}.start", f"-{s}.shortest", f"{s}.score", f"{s}.value")
        kept = lambda t: each(t, span)
        return f"CASE WHEN size({m}) = 1 THEN {kept(m)} WHEN size({m}) > 1 THEN {kept(taken)} ELSE {NO_SPANS} END"

    own_hits = keep(located, lambda s: index.has(slots, f"{s}.value"))
    return case(f"size({located}) <= {FEW}", settled(one_by_one(located)), let(own_hits, among_many))

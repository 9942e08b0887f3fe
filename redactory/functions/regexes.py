"""Facts about regular expressions that allow texts to be skipped without searching them."""

from __future__ import annotations

import re
from functools import lru_cache


@lru_cache(maxsize=4096)
def min_width(regex: str) -> int:
    """The least number of characters a match has; 1 if that cannot be told."""
    tree = _tree(regex)
    return max(1, tree.getwidth()[0]) if tree is not None else 1


@lru_cache(maxsize=4096)
def first_class(regex: str) -> str | None:
    """The characters a match can start with, as the inside of a character class.

    Only told for a few characters: a class full of letters skips nothing.
    """
    tree = _tree(regex)
    if tree is None or tree.state.flags & re.IGNORECASE:
        return None
    found, complete = _starts(list(tree))
    if not complete or len(found) > 16:
        return None
    digits = "".join(sorted(c for c in found if c.isdigit()))
    others = "".join(re.escape(c) for c in sorted(found) if not c.isdigit())
    return ("0-9" if digits == "0123456789" else digits) + others


#: What ``required_shape`` is told about: digits are all 0, white space is all blank.
SHAPED, SHAPE = "123456789\t\n\x0b\f\r", "000000000     "
#: Syntax that Java and Python read differently.
FOREIGN = re.compile(r"&&|\\Q|\[[^\]]*\[|\(\?[a-zA-Z]*[Ux]")


@lru_cache(maxsize=4096)
def required_shape(regex: str) -> str | None:
    """The longest run of digits (as 0), white space (as blanks) and marks that every match holds; None if there is none
    of two characters or more. A text without it, translated from ``SHAPED`` to ``SHAPE``, holds no match."""
    tree = None if FOREIGN.search(regex) else _tree(regex)
    if tree is None:
        return None
    runs = [""]
    _walk(list(tree), runs)
    longest = max(runs, key=len)
    return longest if len(longest) > 1 else None


def _walk(items: list, runs: list[str]) -> None:
    """Append what the items hold to the last run; whatever is not known begins a new one."""
    for op, arg in items:
        name, one = str(op), _shape_of(op, arg)
        if name in ("AT", "ASSERT", "ASSERT_NOT"):
            continue
        if one is not None:
            runs[-1] += one
        elif name == "SUBPATTERN":
            _walk(list(arg[-1]), runs)
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] > 0:
            least, most, body = arg[0], arg[1], list(arg[2])
            for _ in range(min(least, 32)):
                _walk(body, runs)
            if most != least or least > 32:
                alike = _shape_of(*body[0]) if len(body) == 1 else None
                runs.append((alike or "") * min(least, 32))
        else:
            runs.append("")


def _shape_of(op, arg) -> str | None:
    """The one character that stands for everything an item of one character matches."""
    if str(op) == "LITERAL":
        return _shaped(chr(arg))
    if str(op) != "IN":
        return None
    found = set()
    for kind, value in arg:
        if str(kind) == "LITERAL":
            found.add(_shaped(chr(value)))
        elif str(kind) == "RANGE" and chr(value[0]).isascii() and "0" <= chr(value[0]) <= chr(value[1]) <= "9":
            found.add("0")
        elif str(kind) == "CATEGORY" and str(value) in ("CATEGORY_DIGIT", "CATEGORY_SPACE"):
            found.add("0" if str(value) == "CATEGORY_DIGIT" else " ")
        else:
            return None
    return found.pop() if len(found) == 1 else None


def _shaped(c: str) -> str | None:
    if not c.isascii() or c.isalpha():
        return None
    return SHAPE[SHAPED.index(c)] if c in SHAPED else c


def _tree(regex: str):
    try:
        return re._parser.parse(regex)
    except (re.error, AttributeError, OverflowError):  # a dialect Python does not read
        return None


def _starts(items: list) -> tuple[set[str], bool]:
    """The possible first characters, and whether every match starts with one of them."""
    found: set[str] = set()
    for op, arg in items:
        name = str(op)
        if name in ("AT", "ASSERT", "ASSERT_NOT"):
            continue
        if name == "LITERAL":
            return found | {chr(arg)}, True
        if name == "IN":
            members = _members(arg)
            return (found | members, True) if members is not None else (found, False)
        if name in ("MAX_REPEAT", "POSSESSIVE_REPEAT"):
            inner, complete = _starts(list(arg[2]))
            if not complete:
                return found, False
            found |= inner
            if arg[0] > 0:
                return found, True
            continue
        if name == "SUBPATTERN":
            if arg[1] or arg[2]:  # flags of its own, for example another case
                return found, False
            inner, complete = _starts(list(arg[-1]))
            return found | inner, complete
        if name == "BRANCH":
            for branch in arg[1]:
                inner, complete = _starts(list(branch))
                if not complete:
                    return found, False
                found |= inner
            return found, True
        return found, False
    return found, False


def _members(items: list) -> set[str] | None:
    found: set[str] = set()
    for op, arg in items:
        name = str(op)
        if name == "LITERAL":
            found.add(chr(arg))
        elif name == "RANGE" and arg[1] - arg[0] < 128:
            found |= {chr(c) for c in range(arg[0], arg[1] + 1)}
        elif name == "CATEGORY" and str(arg) == "CATEGORY_DIGIT":
            found |= set("0123456789")
        else:
            return None
    return found

"""Masking strategies as functions from SQL expression to SQL expression, and their registry.

Lengths count code points; white space, letters and digits are the ASCII classes. Use
``F.expr(mask_email("email"))`` to mask a column directly.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Sql, case, column, each, keep, let, lit, star_after, strip, struct

Mask = Callable[[Sql], Sql]

# Street suffixes that an address mask leaves readable.
STREET_SUFFIXES = ("st", "ave", "rd", "dr", "ln", "blvd", "way", "ct", "pl")


def replace_with(new_value: str) -> Mask:
    return lambda value: lit(new_value)


def mask_chars(count: int, from_end: bool = True, char: str = "*") -> Mask:
    """Mask ``count`` characters at one end; a shorter value is masked completely."""

    def apply(value: Sql) -> Sql:
        hidden = f"least(length({value}), {int(count)})"
        stars = f"repeat({lit(char)}, {hidden})"
        if from_end:
            return f"concat(left({value}, length({value}) - {hidden}), {stars})"
        return f"concat({stars}, substring({value}, {hidden} + 1))"

    return apply


def hash_with(hash_type: str = "sha256") -> Mask:
    hashes: dict[str, Mask] = {
        "sha256": lambda v: f"sha2({v}, 256)",
        "sha512": lambda v: f"sha2({v}, 512)",
        "md5": lambda v: f"md5({v})",
    }
    if hash_type not in hashes:
        raise ValueError(f"unknown hash_type {hash_type!r}; known: {sorted(hashes)}")
    return hashes[hash_type]


def encrypt_with(key: str, mode: str = "GCM") -> Mask:
    """AES, hex-encoded. GCM draws a new IV per value; ECB is deterministic and can be joined on.

    The key becomes a literal of the plan: set ``spark.sql.redaction.string.regex`` to keep it out
    of plan displays and event logs.
    """
    _check_key(key)
    return lambda value: f"hex(aes_encrypt(cast({value} AS binary), cast({lit(key)} AS binary), {lit(mode)}))"


def decrypt_with(key: str, mode: str = "GCM") -> Mask:
    _check_key(key)
    return lambda value: f"cast(aes_decrypt(unhex({value}), cast({lit(key)} AS binary), {lit(mode)}) AS string)"


#: The column in which ``with_keys`` puts the keys of its table.
KEYS = "__keys"


def with_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    """``df`` with the table ``keys(name, key)`` in a column that ``encrypt_by_name`` and ``decrypt_by_name`` read. All
    executors get the few keys as a broadcast; plans name the table only. Names must be unique, null names have no key."""
    held = F.map_from_entries(F.collect_list(F.struct("name", "key")))
    return df.crossJoin(F.broadcast(keys.where("name IS NOT NULL").agg(held.alias(KEYS))))


def _named_key(name: Sql, keys: str | None) -> Sql:
    """A key that executors hold themselves, in a property of their JVM or in a column of ``with_keys``; the plan holds
    its name only."""
    if keys is None:
        return f"cast(reflect('java.lang.System', 'getProperty', {name}) AS binary)"
    return f"cast(coalesce(try_element_at({column(keys)}, {name}), raise_error(concat('no key named ', {name}))) AS binary)"


def encrypt_by_name(key_name: str, key_id: str, mode: str = "GCM", keys: str | None = None) -> Mask:
    """AES under the key in the property ``<key_name>.<key_id>`` of the executors (``spark.executor.extraJavaOptions``, or
    a properties file of theirs), or of that name in the column ``keys`` that ``with_keys`` adds: no plan, event log or
    display holds the key. Properties that the driver sets in its own JVM do not reach executors. The result is
    ``<key_id>:<hex>``, so keys can be changed and older values still be read. A missing or unfit key fails the job."""
    if not key_name or not key_id or ":" in key_id:
        raise ValueError("a named key needs a name and an id without a colon")
    key = _named_key(lit(f"{key_name}.{key_id}"), keys)
    prefix = lit(f"{key_id}:")
    return lambda value: f"concat({prefix}, hex(aes_encrypt(cast({value} AS binary), {key}, {lit(mode)})))"


def decrypt_by_name(key_name: str, mode: str = "GCM", keys: str | None = None) -> Mask:
    """The inverse for every key id."""

    def apply(value: Sql) -> Sql:
        # A NULL value has no key id and stays NULL.
        name = f"concat({lit(f'{key_name}.')}, substring_index({value}, ':', 1))"
        opened = f"aes_decrypt(unhex(substring_index({value}, ':', -1)), {_named_key(name, keys)}, {lit(mode)})"
        return f"cast({opened if keys is None else case(f'{value} IS NOT NULL', opened, 'NULL')} AS string)"

    return apply


def _check_key(key: str) -> None:
    if not key or len(key.encode()) not in (16, 24, 32):
        raise ValueError("encryption needs a key of 16, 24 or 32 bytes")


def redact(value: Sql) -> Sql:
    return "''"


def mask_email(value: Sql) -> Sql:
    """Two characters of the user, one of the first domain label, and the last label stay."""
    short_or = lambda v, shown: case(f"length({v}) <= 2", v, star_after(v, shown))

    def address(p: Sql) -> Sql:
        host = f"concat({short_or(f'{p}.labels[0]', 1)}, '.', element_at({p}.labels, -1))"
        return f"concat({short_or(f'{p}.user', 2)}, '@', {case(f'size({p}.labels) > 1', host, f'{p}.labels[0]')})"

    user = f"substring_index({value}, '@', 1)"
    labels = f"split(substring({value}, length({user}) + 2), '[.]', -1)"
    return case(f"contains({value}, '@')", let(struct(user=user, labels=labels), address), value)


def mask_person(value: Sql) -> Sql:
    """Two characters of every word stay; words of at most two characters stay whole."""
    words = keep(f"split({value}, {lit(r'\s+')})", lambda w: f"{w} != ''")
    return f"array_join({each(words, lambda w: case(f'length({w}) <= 2', w, star_after(w, 2)))}, ' ')"


def mask_location(value: Sql) -> Sql:
    """One character of every word or number stays, short words and street suffixes stay whole."""
    suffixes = ", ".join(map(lit, STREET_SUFFIXES))

    def word(w: Sql) -> Sql:
        readable = case(
            f"{w} RLIKE '^[0-9]+$'", f"length({w}) = 1", f"length({w}) <= 2 OR lower({w}) IN ({suffixes})"
        )
        return case(readable, w, star_after(w, 1))

    parts = keep(each(f"split({value}, ',')", strip), lambda p: f"{p} != ''")
    part = lambda p: f"array_join({each(f'split({p}, {lit(r"\s+")})', word)}, ' ')"
    return f"array_join({each(parts, part)}, ', ')"


@dataclass(frozen=True)
class PythonMask:
    """A mask with a Python body, run on Arrow batches: ``body(Series[str]) -> Series[str]``."""

    body: Callable[[pd.Series], pd.Series]


NAMED_MASKS: dict[str, Mask | PythonMask] = {
    "mask_email": mask_email,
    "mask_person": mask_person,
    "mask_location": mask_location,
}


def register_mask(name: str, mask: Mask | str) -> None:
    """Offer a mask to policies as ``custom`` with ``lambda: name``.

    ``mask`` is a SQL template such as ``"concat(left({value}, 1), '***')"`` or a function from SQL
    expression to SQL expression.
    """
    NAMED_MASKS[name] = (lambda value: mask.format(value=value)) if isinstance(mask, str) else mask


def register_python_mask(name: str, body: Callable[[pd.Series], pd.Series]) -> None:
    """Offer a Python function over batches of values as a custom mask. Prefer ``register_mask``."""
    NAMED_MASKS[name] = PythonMask(body)


def build_mask(strategy: str, entity: str, params: Mapping[str, Any], defaults: Mapping[str, Any]) -> Mask | PythonMask:
    """Resolve a strategy and its parameters to a mask when the plan is built."""
    if strategy == "replace":
        return replace_with(params.get("new_value", f"<{entity}>"))
    if strategy == "mask":
        if "chars_to_mask" not in params:
            raise ValueError(f"{entity}: strategy 'mask' needs chars_to_mask")
        return mask_chars(
            int(params["chars_to_mask"]),
            bool(params.get("from_end", defaults.get("mask_from_end", True))),
            params.get("masking_char", defaults.get("mask_char", "*")),
        )
    if strategy == "hash":
        return hash_with(params.get("hash_type", defaults.get("hash_type", "sha256")))
    if strategy == "encrypt" and "key_name" in params:
        return encrypt_by_name(params["key_name"], params.get("key_id", "1"), params.get("mode", "GCM"))
    if strategy == "encrypt":
        return encrypt_with(params.get("key") or defaults.get("encryption_key") or "", params.get("mode", "GCM"))
    if strategy == "redact":
        return redact
    if strategy == "custom":
        name = params.get("lambda")
        if name not in NAMED_MASKS:
            raise ValueError(f"{entity}: unknown custom mask {name!r}; known: {sorted(NAMED_MASKS)}")
        return NAMED_MASKS[name]
    raise ValueError(f"{entity}: unknown strategy {strategy!r}")

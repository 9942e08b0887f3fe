"""Policies: what to look for, how sure to be, and how to mask it.

Policies are small driver-side values, resolved against schemas while a plan is built; nothing
of them is evaluated per row.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .policy_defaults import DEFAULT_POLICY


#: Bytes of listed terms that may become part of a plan; every task reads the plan.
LISTED_BYTES = 32 << 20


class PolicyError(ValueError):
    """The policy cannot be applied safely."""


@dataclass(frozen=True)
class Pattern:
    name: str
    regex: str
    score: float = 0.8
    languages: tuple[str, ...] = ()  # empty: every language

    def __post_init__(self) -> None:
        check_regex(self.regex)


@dataclass(frozen=True)
class EntityPolicy:
    entity: str
    enabled: bool = True
    threshold: float = 0.5
    context: tuple[str, ...] = ()
    deny: tuple[str, ...] = ()
    patterns: tuple[Pattern, ...] = ()
    listed: tuple[tuple[str, float], ...] = ()  # terms and scores from a table, see ``Policy.with_listed``
    strategy: str = "replace"
    params: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class ColumnPolicy:
    """Overrides for one column. Empty ``entities`` and a zero threshold mean "no override"."""

    enabled: bool = True
    entities: tuple[str, ...] = ()
    language: str = "en"
    threshold: float | None = None
    holds: str | None = None  # the whole value is one entity of this type, e.g. PERSON


@dataclass(frozen=True)
class TablePolicy:
    enabled: bool = True
    columns: Mapping[str, ColumnPolicy] = field(default_factory=dict)
    language_column: str | None = None  # holds the language of each row; without it columns state theirs


@dataclass(frozen=True)
class Policy:
    entities: tuple[EntityPolicy, ...] = ()
    enabled: bool = True
    default_strategy: str = "replace"
    default_replacement: str = "<REDACTED>"
    defaults: Mapping[str, Any] = field(default_factory=dict)
    languages: tuple[str, ...] = ("en",)
    legacy_thresholds: bool = False  # ignore the thresholds of entities, obey only those of columns
    on_error: str = "fail"  # failing Python masks: "fail", "redact", "keep", or "quarantine" (see ``anonymize_separated``)

    # ---- construction -------------------------------------------------------------------------

    @classmethod
    def from_dict(cls, data: Mapping[str, Any], **options: Any) -> Policy:
        entities = []
        for item in data.get("entities", {}).values():
            entities.append(
                EntityPolicy(
                    entity=item["entity_type"],
                    enabled=item.get("enabled", True),
                    threshold=float(item.get("confidence_threshold", 0.5)),
                    context=tuple(item.get("context_words", ())),
                    deny=tuple(item.get("deny_list", ())),
                    patterns=tuple(
                        _read_pattern(item["entity_type"], i, p) for i, p in enumerate(item.get("regex_patterns", ()))
                    ),
                    strategy=item.get("anonymization_strategy", "replace"),
                    params=dict(item.get("anonymization_params", {})),
                )
            )
        settings = dict(data.get("anonymization", {}))
        return cls(
            entities=tuple(entities),
            enabled=data.get("enabled", True),
            default_strategy=settings.pop("default_strategy", "replace"),
            default_replacement=settings.pop("default_replacement", "<REDACTED>"),
            defaults=settings,
            languages=tuple(data.get("nlp", {}).get("supported_languages", ("en",))),
            **options,
        )

    @classmethod
    def from_json(cls, text: str, **options: Any) -> Policy:
        return cls.from_dict(json.loads(text), **options)

    @classmethod
    def load(cls, spark: SparkSession, path: str, **options: Any) -> Policy:
        """Read a JSON policy from any file system Spark can reach."""
        return cls.from_json(spark.read.text(path, wholetext=True).first()[0], **options)

    @classmethod
    def default(cls, **options: Any) -> Policy:
        return cls.from_dict(DEFAULT_POLICY, **options)

    # ---- look-up ------------------------------------------------------------------------------

    def enabled_entities(self) -> list[str]:
        return [e.entity for e in self.entities if e.enabled]

    def active(self) -> tuple[EntityPolicy, ...]:
        """Enabled entities; if there are none, all of them."""
        return tuple(e for e in self.entities if e.enabled) or self.entities

    def entity(self, name: str) -> EntityPolicy | None:
        return next((e for e in self.entities if e.entity == name), None)

    def with_entity(self, changed: EntityPolicy) -> Policy:
        """A copy in which ``changed`` replaces, or is added to, the entities."""
        if self.entity(changed.entity) is None:
            return replace(self, entities=self.entities + (changed,))
        return replace(self, entities=tuple(changed if e.entity == changed.entity else e for e in self.entities))

    def with_listed(self, lexicon: DataFrame, limit: int = LISTED_BYTES) -> Policy:
        """A copy that also finds the terms of ``lexicon(term, entity, score)`` in every text, and enables their entities.

        The list becomes part of every plan, so that tables, streams and reports need no join; it is measured first and
        refused beyond ``limit`` bytes, where ``lexicon_findings`` joins it instead. Of repeated terms the highest
        score counts; rows without a term or entity are left out.
        """
        terms = lexicon.where("term IS NOT NULL AND entity IS NOT NULL AND trim(term) <> ''").groupBy("term", "entity")
        terms = terms.agg(F.coalesce(F.max(F.col("score").cast("double")), F.lit(1.0)).alias("score"))
        size = terms.agg(F.coalesce(F.sum(F.octet_length("term") + 16), F.lit(0))).first()[0]
        if size > limit:
            raise PolicyError(f"a list of {size} bytes is too large for a plan; join it with lexicon_findings")
        policy, found = self, {}
        for row in terms.orderBy("term").collect():
            found.setdefault(row["entity"], []).append((row["term"], row["score"]))
        for entity, listed in sorted(found.items()):
            wordless = [term for term, _ in listed if not re.search(r"\w", term)]
            if wordless:
                raise PolicyError(f"terms without a letter or digit: {wordless[:5]}")
            known = policy.entity(entity) or EntityPolicy(entity)
            policy = policy.with_entity(replace(known, listed=tuple(listed), enabled=True))
        return policy

    def only(self, *names: str) -> Policy:
        """A copy in which exactly the named entities are enabled."""
        return replace(self, entities=tuple(replace(e, enabled=e.entity in names) for e in self.entities))

    def threshold(self, entity: EntityPolicy, column: ColumnPolicy) -> float | None:
        if column.threshold:
            return column.threshold
        return None if self.legacy_thresholds else entity.threshold

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per entity, for joins with findings."""
        rows = [
            (
                e.entity,
                e.enabled,
                e.threshold,
                list(e.context),
                list(e.deny),
                [(p.name, p.regex, p.score) for p in e.patterns],
                e.strategy,
                {k: str(v) for k, v in e.params.items()},
            )
            for e in self.entities
        ]
        return spark.createDataFrame(
            rows,
            "entity string, enabled boolean, threshold double, context array<string>, deny array<string>, "
            "patterns array<struct<name:string,regex:string,score:double>>, strategy string, "
            "params map<string,string>",
        )


def _read_pattern(entity: str, position: int, item: Any) -> Pattern:
    if isinstance(item, str):
        item = {"name": f"{entity.lower()}_{position}", "regex": item}
    regex = item["regex"].replace("(?P<", "(?<")
    return Pattern(item["name"], regex, float(item.get("score", 0.8)), tuple(item.get("languages", ())))


def check_regex(regex: str) -> None:
    """Refuse patterns that can exhaust the regex stack on long texts or match nothing at all.

    java.util.regex recurses once per round of a repeated group, so ``(...)*``, ``(...)+`` and
    ``(...){n,}`` overflow the stack on long inputs. ``(...){0,50}`` and possessive groups are accepted.
    """
    bare = re.sub(r"\\.", "..", regex)
    bare = re.sub(r"\[\^?\]?[^\]]*\]", lambda m: "." * len(m.group()), bare)
    if re.search(r"\)(?:[*+]|\{\d+,\})(?!\+)", bare):
        raise PolicyError(f"unbounded repetition of a group; give it an upper bound: {regex!r}")
    try:
        matches_nothing = re.search(regex, "") is not None
    except re.error:  # dialect differences are left to Spark
        matches_nothing = False
    if matches_nothing:
        raise PolicyError(f"pattern matches the empty string: {regex!r}")


def policies_of(tables: Mapping[str, TablePolicy] | None) -> Iterable[tuple[str, str]]:
    """The (table, column) pairs named by table policies; column '' for the table itself."""
    for table, policy in (tables or {}).items():
        yield table, ""
        for column in policy.columns:
            yield table, column

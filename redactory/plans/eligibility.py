"""Which columns are inspected, and with which recognizers. Decided while a plan is built."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from ..operators.detect import Recognizer, compile_recognizers, kind_of
from ..policy import ColumnPolicy, Policy, TablePolicy
from ..policy_defaults import ID_COLUMNS, ID_SUFFIX


@dataclass(frozen=True)
class ColumnPlan:
    name: str
    data_type: T.DataType
    eligible: bool
    recognizers: tuple[Recognizer, ...] = ()


def looks_like_id(name: str) -> bool:
    return name.lower() in ID_COLUMNS or name.lower().endswith(ID_SUFFIX)


def is_eligible(field: T.StructField, table_policy: TablePolicy | None = None) -> bool:
    """Type and name rules come first: a policy can switch a column off, never back on."""
    if kind_of(field.dataType) is None or looks_like_id(field.name):
        return False
    if table_policy is None:
        return True
    return table_policy.enabled and table_policy.columns.get(field.name, ColumnPolicy()).enabled


def plan_columns(
    schema: T.StructType, policy: Policy, table_policy: TablePolicy | None = None, by_language: bool = False
) -> list[ColumnPlan]:
    plans = []
    for field in schema.fields:
        eligible = policy.enabled and is_eligible(field, table_policy)
        column = (table_policy.columns if table_policy else {}).get(field.name)
        recognizers = (
            compile_recognizers(policy, column, field.dataType, by_language) if eligible else []
        )
        plans.append(ColumnPlan(field.name, field.dataType, eligible, tuple(recognizers)))
    return plans

"""Anonymizing a whole set of tables, with its report from the same pass."""

from __future__ import annotations

import time
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.anonymize import anonymize_separated, anonymize_table, prepare_table
from ..operators.report import Run, by_table, empty_profile, profile_from_metrics, profile_tables, report, write_report
from ..policy import Policy, PolicyError, TablePolicy, policies_of
from ..sources.tables import TableSet, append


def anonymize_tables(
    tables: TableSet, policy: Policy, policies: Mapping[str, TablePolicy] | None = None
) -> TableSet:
    """The same tables, lazily anonymized."""
    frames = {n: anonymize_table(f, policy, (policies or {}).get(n)) for n, f in tables.frames.items()}
    return TableSet(tables.spark, frames, tables.keys)


def database_report(
    tables: TableSet, policy: Policy, policies: Mapping[str, TablePolicy] | None = None
) -> DataFrame:
    """What anonymizing the tables would find, without writing them."""
    return report(profile_tables(dict(tables.frames), policy, dict(policies or {})), policy)


def refuse_unknown(tables: TableSet, policies: Mapping[str, TablePolicy]) -> None:
    unknown = [
        f"{table}.{column}" if column else table
        for table, column in policies_of(policies)
        if table not in tables.frames or column and column not in tables.frames[table].columns
    ]
    if unknown:
        raise PolicyError(f"policies for unknown tables or columns: {unknown}")


def append_anonymized(
    df: DataFrame, path: str, policy: Policy, table_policy: TablePolicy | None = None
) -> None:
    """Anonymize a batch and append it to a table that was written anonymized."""
    append(anonymize_table(df, policy, table_policy), path)


def write_separated(
    df: DataFrame, path: str, quarantine: str, policy: Policy, table_policy: TablePolicy | None = None
) -> DataFrame:
    """Write the rows that can be anonymized to ``path`` and those of which a mask failed, as they came and with their
    errors, to ``quarantine``. Returns the failures counted: ``column, entity, error, n_rows``."""
    clean, failed = anonymize_separated(df, policy, table_policy)
    clean.write.parquet(path)
    failed.write.parquet(quarantine)
    found = df.sparkSession.read.schema(failed.schema).parquet(quarantine).select(F.explode(F.array_distinct("errors")).alias("e"))
    return found.select("e.*").groupBy("column", "entity", "error").agg(F.count(F.lit(1)).alias("n_rows"))


def write_anonymized(
    tables: TableSet,
    path: str,
    policy: Policy,
    policies: Mapping[str, TablePolicy] | None = None,
    mode: str = "errorifexists",
    concurrent: int = 4,
    on_table_error: str = "raise",
    report_path: str | None = None,
) -> DataFrame:
    """Write every table anonymized to ``{path}/{name}.parquet`` and return the report.

    The counters are observed while the rows are written, so no text is searched twice, and each
    write is one stage without a shuffle: counters of lost or repeated tasks are not added.
    Small tables do not fill a cluster, hence a few writes run side by side. The first error is
    raised; with ``on_table_error="report"`` all other tables are written, and the report names the failed ones and
    counts progress in rows that were written. ``report_path`` takes the report as a JSON file. Table policies that name unknown tables or columns are refused before anything is written.
    """
    refuse_unknown(tables, policies or {})
    started = time.monotonic()

    def write(name: str) -> DataFrame:
        df, table_policy = tables.frames[name], (policies or {}).get(name)
        prepared = prepare_table(df, policy, table_policy)
        observation = Observation(f"{name}-metrics")
        watched = type(prepared)(prepared.frame.observe(observation, *prepared.metrics()), prepared.columns, policy)
        out = watched.result() if policy.enabled else watched.frame
        out.write.mode(mode).parquet(f"{path}/{name}.parquet")
        return profile_from_metrics(tables.spark, name, prepared, observation.get)

    if on_table_error not in ("raise", "report"):
        raise PolicyError(f"on_table_error is 'raise' or 'report', not {on_table_error!r}")
    failures: dict[str, str] = {}

    def attempt(name: str) -> DataFrame | None:
        try:
            return write(name)
        except Exception as error:
            if on_table_error == "raise":
                raise
            failures[name] = f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}"
            return None

    with ThreadPoolExecutor(max_workers=concurrent) as pool:
        profiles = [p for p in pool.map(attempt, tables.frames) if p is not None]
    seconds = time.monotonic() - started
    rows = {n: 0 for n in failures}  # a table that cannot be read has no count of its own
    for name in failures:
        try:
            rows[name] = tables.frames[name].count()
        except Exception:
            failures[name] += " (rows not counted)"
    profile = reduce(DataFrame.unionByName, profiles) if profiles else empty_profile(tables.spark)
    rows |= {row["table"]: row["n_rows"] for row in by_table(profile).collect()}
    full = report(profile, policy, Run(rows, failures, seconds))
    if report_path:
        write_report(full, report_path)
    return full

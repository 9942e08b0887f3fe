"""The anonymization report as aggregates."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import keep, lit, struct
from ..policy import Policy, TablePolicy
from .anonymize import Prepared, prepare_table

#: The columns of a report.
REPORT = (
    "processing_stats struct<total_tables:bigint,processed_tables:bigint,total_rows:bigint,processed_rows:bigint,"
    "anonymized_rows:bigint,elapsed_time:double,rows_per_second:double,progress_percent:double,failed_tables:map<string,string>>, "
    "anonymization_stats struct<total_values_processed:bigint,total_values_anonymized:bigint,anonymization_rate:double,"
    "entities_found:map<string,bigint>,tables_processed:map<string,bigint>,columns_processed:map<string,bigint>>, "
    "policy struct<enabled_entities:array<string>,supported_languages:array<string>>"
)
NO_COUNTS = "cast(map() AS map<string,bigint>)"


def profile_table(
    df: DataFrame, table: str, policy: Policy, table_policy: TablePolicy | None = None
) -> DataFrame:
    """One row per eligible column: values seen, values anonymized, detections per entity.

    Row counts belong to the table and repeat on each of its rows; a table without eligible
    columns keeps one row with a NULL column. One partial aggregate row per task is shuffled.
    """
    prepared = prepare_table(df, policy, table_policy)
    return _unfold(prepared.frame.agg(*prepared.metrics()), table, prepared)


def profile_from_metrics(spark, table: str, prepared: Prepared, values: dict) -> DataFrame:
    """The same rows from metrics that were observed while the table was written. The counters are constants of the plan:
    a frame made from local rows would start a Python process per core for each table."""
    counters = ", ".join(f"cast({lit(value)} AS bigint) AS `{name}`" for name, value in values.items())
    return _unfold(spark.sql(f"SELECT {counters}"), table, prepared)


def _unfold(metrics: DataFrame, table: str, prepared: Prepared) -> DataFrame:
    """From one row of counters to one row per eligible column."""
    available = set(metrics.columns)
    position = {c.name: i for i, c in enumerate(prepared.inspected)}
    entities = list(enumerate(prepared.entities()))
    items = []
    for c in prepared.eligible or [None]:
        i = position.get(c.name) if c else None
        counts = [struct(key=lit(e), value=f"found_{i}_{j}") for j, e in entities if f"found_{i}_{j}" in available]
        found = keep(f"array({', '.join(counts)})", lambda kv: f"{kv}.value > 0")
        items.append(
            struct(
                column=lit(c.name) if c else "cast(NULL AS string)",
                values_processed="rows" if c else "0L",
                values_anonymized=f"hits_{i}" if i is not None else "0L",
                entities=f"map_from_entries({found})" if counts else NO_COUNTS,
            )
        )
    return metrics.selectExpr(
        f"{lit(table)} AS `table`", "rows AS n_rows", "anonymized_rows", f"inline(array({', '.join(items)}))"
    ).select("table", "column", "n_rows", "anonymized_rows", "values_processed", "values_anonymized", "entities")


def empty_profile(spark: SparkSession) -> DataFrame:
    """The profile of no table."""
    return spark.createDataFrame(
        [], "`table` string, `column` string, n_rows bigint, anonymized_rows bigint, values_processed bigint, "
        "values_anonymized bigint, entities map<string,bigint>"
    )


def profile_tables(
    frames: dict[str, DataFrame], policy: Policy, tables: dict[str, TablePolicy] | None = None
) -> DataFrame:
    parts = [profile_table(df, name, policy, (tables or {}).get(name)) for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def by_table(profile: DataFrame) -> DataFrame:
    return profile.groupBy("table").agg(
        F.max("n_rows").alias("n_rows"),
        F.max("anonymized_rows").alias("anonymized_rows"),
        F.sum("values_processed").alias("values_processed"),
        F.sum("values_anonymized").alias("values_anonymized"),
    )


def totals(profile: DataFrame) -> DataFrame:
    return by_table(profile).agg(
        F.count(F.lit(1)).alias("total_tables"),
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("anonymized_rows"), F.lit(0)).alias("anonymized_rows"),
        F.coalesce(F.sum("values_processed"), F.lit(0)).alias("values_processed"),
        F.coalesce(F.sum("values_anonymized"), F.lit(0)).alias("values_anonymized"),
        _rate(F.sum("values_anonymized"), F.sum("values_processed")).alias("anonymization_rate"),
    )


def entities_found(profile: DataFrame) -> DataFrame:
    return (
        profile.select(F.explode("entities").alias("entity", "n"))
        .groupBy("entity")
        .agg(F.sum("n").alias("n_found"))
    )


@dataclass(frozen=True)
class Run:
    """What a run was to do and what became of it: all tables with their rows, the failures with their reasons, and the
    wall-clock seconds it took."""

    rows: Mapping[str, int]
    failures: Mapping[str, str]
    seconds: float


def report(profile: DataFrame, policy: Policy, run: Run | None = None) -> DataFrame:
    """The nested report as one row. ``profile`` holds the tables that were processed; ``run`` adds the wall clock, the
    tables that were to be processed but failed, and from both the progress. Without it the profile is all there is."""
    fact = lambda kind, key, n: F.struct(F.lit(kind).alias("kind"), key.alias("key"), n.alias("n"))
    # Names that hold a dot are quoted, so that no two columns share a key.
    named = lambda n: F.when(F.col(n).contains("."), F.concat(F.lit("`"), n, F.lit("`"))).otherwise(F.col(n))
    place = F.concat_ws(".", named("table"), named("column"))
    facts = profile.select(
        F.inline(
            F.concat(
                F.array(
                    fact("table", F.col("table"), F.col("n_rows")),
                    fact("table hit", F.col("table"), F.col("anonymized_rows")),
                    fact("column", F.when(F.col("column").isNotNull(), place), F.col("values_processed")),
                    fact("column hit", F.when(F.col("column").isNotNull(), place), F.col("values_anonymized")),
                ),
                F.transform(F.map_entries("entities"), lambda kv: fact("entity", kv["key"], kv["value"])),
            )
        )
    )
    # Figures of a table repeat on the rows of its columns, all other facts add up.
    settled = (
        facts.filter("key is not null")
        .groupBy("kind", "key")
        .agg(F.max("n").alias("largest"), F.sum("n").alias("total"))
        .select("kind", "key", F.when(F.col("kind").startswith("table"), F.col("largest")).otherwise(F.col("total")).alias("n"))
    )
    is_kind = lambda kind: F.col("kind") == kind
    add = lambda kind: F.coalesce(F.sum(F.when(is_kind(kind), F.col("n"))), F.lit(0))
    mapped = lambda kind: F.map_from_entries(
        F.sort_array(F.collect_list(F.when(is_kind(kind), F.struct("key", "n"))))
    )
    one = settled.agg(
        F.count_if(is_kind("table")).alias("tables"),
        add("table").alias("rows"),
        add("table hit").alias("anonymized_rows"),
        add("column").alias("processed"),
        add("column hit").alias("anonymized"),
        mapped("entity").alias("entities_found"),
        mapped("table").alias("tables_processed"),
        mapped("column").alias("columns_processed"),
    )
    seconds = F.lit(run.seconds if run else None).cast("double")
    total_tables = F.lit(len(run.rows)).cast("bigint") if run else F.col("tables")
    total_rows = F.lit(sum(run.rows.values())).cast("bigint") if run else F.col("rows")
    failures = F.lit(json.dumps(dict(run.failures if run else {})))
    return one.select(
        F.struct(
            total_tables.alias("total_tables"),
            F.col("tables").alias("processed_tables"),
            total_rows.alias("total_rows"),
            F.col("rows").alias("processed_rows"),
            F.col("anonymized_rows"),
            seconds.alias("elapsed_time"),
            (F.col("rows") / F.nullif(seconds, F.lit(0.0))).alias("rows_per_second"),
            F.coalesce(F.col("rows") * 100.0 / F.nullif(total_rows, F.lit(0)), F.lit(100.0)).alias("progress_percent"),
            F.from_json(failures, "map<string,string>").alias("failed_tables"),
        ).alias("processing_stats"),
        F.struct(
            F.col("processed").alias("total_values_processed"),
            F.col("anonymized").alias("total_values_anonymized"),
            _rate(F.col("anonymized"), F.col("processed")).alias("anonymization_rate"),
            F.col("entities_found"),
            F.col("tables_processed"),
            F.col("columns_processed"),
        ).alias("anonymization_stats"),
        F.struct(
            F.array(*[F.lit(e) for e in policy.enabled_entities()]).alias("enabled_entities"),
            F.array(*[F.lit(x) for x in policy.languages]).alias("supported_languages"),
        ).alias("policy"),
    )


def _rate(part: Column, whole: Column) -> Column:
    return F.coalesce(part.cast("double") * 100 / F.nullif(whole, F.lit(0)), F.lit(0.0))


def write_report(full: DataFrame, path: str) -> None:
    """The report as one JSON document in the folder ``path``, replacing an earlier one."""
    report_json(full).coalesce(1).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A report that was written, as one row with the columns of ``report``."""
    return spark.read.schema(REPORT).json(path)


def report_json(full: DataFrame) -> DataFrame:
    return full.select(F.to_json(F.struct("*")).alias("report"))

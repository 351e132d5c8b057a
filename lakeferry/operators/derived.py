"""Derived tables: lifecycles, freshness, coverage, job metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.text import name_part


def lifecycle(
    df: DataFrame,
    keys: Sequence[str],
    action: str,
    at: str,
    created: str = "CREATED",
    deleted: str = "DELETED",
) -> DataFrame:
    """First creation and last deletion per key; null where there is none."""
    return df.groupBy(*keys).agg(
        F.min(F.when(F.col(action) == created, F.col(at))).alias("created_at"),
        F.max(F.when(F.col(action) == deleted, F.col(at))).alias("deleted_at"),
    )


def freshness(
    tables: Mapping[str, tuple[DataFrame, str]],
    now: datetime,
    warn_after_s: int,
    error_after_s: int,
    execution_date: date | None = None,
    conditions: Mapping[str, str] | None = None,
) -> DataFrame:
    """Newest timestamp, age and status per table (``name -> (rows, timestamp column)``).

    Names are ``dataset.model``. ``conditions`` holds optional SQL filters by name.
    """
    conditions = conditions or {}

    def one(name: str, df: DataFrame, column: str) -> DataFrame:
        condition = conditions.get(name)
        rows = df if condition is None else df.filter(condition)
        dataset, model = name.split(".", 1)
        newest = rows.agg(F.max(column).alias("max_timestamp_in_table"))
        return newest.select(
            F.lit(dataset).alias("dataset_name"),
            F.lit(model).alias("model_name"),
            utc_instant(newest, "max_timestamp_in_table").alias("max_timestamp_in_table"),
            F.lit(condition).cast("string").alias("filter_condition"),
        )

    newest = reduce(DataFrame.unionByName, [one(n, df, c) for n, (df, c) in tables.items()])
    return with_age(newest, "max_timestamp_in_table", now, warn_after_s, error_after_s).select(
        F.lit(execution_date or now.date()).alias("execution_date"),
        "dataset_name",
        "model_name",
        "status",
        "max_timestamp_in_table",
        "max_timestamp_time_ago_in_s",
        "filter_condition",
    )


def utc_instant(df: DataFrame, column: str) -> Column:
    """Timestamp of a column; dates and times without a zone are UTC."""
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampType):
        return value
    return F.concat(value.cast("timestamp_ntz").cast("string"), F.lit("Z")).cast("timestamp")


def with_age(df: DataFrame, at: str, now: datetime, warn_after_s: int, error_after_s: int) -> DataFrame:
    """Add the age in seconds against a fixed time and its status; times without a zone are UTC."""
    fixed = F.lit(now.isoformat() + ("Z" if now.tzinfo is None else "")).cast("timestamp")
    micros = F.unix_micros(fixed) - F.unix_micros(utc_instant(df, at))
    age = micros / F.lit(1e6)
    status = (
        F.when(age.isNull(), "runtime error")
        .when(age > error_after_s, "error")
        .when(age > warn_after_s, "warn")
        .otherwise("pass")
    )
    return df.withColumn("max_timestamp_time_ago_in_s", age).withColumn("status", status)


def freshness_results(artifact: DataFrame, execution_date: date) -> DataFrame:
    """Rows of a freshness artifact (a document with a ``results`` list)."""
    r = F.col("r")
    return artifact.select(F.explode("results").alias("r")).select(
        F.lit(execution_date).alias("execution_date"),
        name_part(r["unique_id"], 2).alias("dataset_name"),
        name_part(r["unique_id"], 3).alias("model_name"),
        r["status"].alias("status"),
        r["max_loaded_at"].alias("max_timestamp_in_table"),
        r["max_loaded_at_time_ago_in_s"].alias("max_timestamp_time_ago_in_s"),
        r["criteria"]["filter"].alias("filter_condition"),
    )


# Datasets of the coverage report.
COVERAGE_DATASETS = ("core", "dim", "metrics", "marketing", "finance")


def coverage_tables(artifact: DataFrame) -> DataFrame:
    """Rows (name, covered, total) of a coverage artifact (a document with a ``tables`` list)."""
    return artifact.select(F.inline("tables"))


def coverage_report(
    tests: DataFrame,
    docs: DataFrame,
    execution_date: date,
    datasets: Sequence[str] = COVERAGE_DATASETS,
) -> DataFrame:
    """Test and documentation coverage per table of the given datasets, plus a row of totals.

    Both inputs have ``name`` (``dataset.table``) and ``covered``, ``docs`` also ``total``.
    """

    def named(df: DataFrame) -> DataFrame:
        keyed = df.withColumns({"dataset_name": name_part(F.col("name"), 0), "table_name": name_part(F.col("name"), 1)})
        return keyed.filter(F.col("dataset_name").isin(*datasets))

    keys = ["dataset_name", "table_name"]
    rows = (
        named(tests)
        .select(*keys, F.col("covered").alias("tests_covered"))
        .join(
            named(docs).select(*keys, F.col("covered").alias("docs_covered"), F.col("total").alias("columns_total")),
            keys,
            "left",
        )
    )
    return with_total_row(rows, keys, ["tests_covered", "docs_covered", "columns_total"]).select(
        F.lit(execution_date).alias("execution_date"), *keys, "tests_covered", "docs_covered", "columns_total"
    )


def with_total_row(rows: DataFrame, labels: Sequence[str], sums: Sequence[str], label: str = "all") -> DataFrame:
    """Append one row with the sums of the given columns, labelled ``all``."""
    total = rows.agg(*[F.sum(c).alias(c) for c in sums]).withColumns({c: F.lit(label) for c in labels})
    return rows.select(*labels, *sums).unionByName(total.select(*labels, *sums))


# Columns of the job metadata table, in order; the second list is kept as text.
TASK_COLUMNS = (
    "task_id dag_id run_id start_date end_date duration state try_number hostname unixname job_id pool queue "
    "priority_weight operator queued_dttm pid max_tries queued_by_job_id external_executor_id trigger_id "
    "trigger_timeout"
).split()
TASK_TEXT_TIMES = ("start_date", "end_date")


def task_metadata(tasks: DataFrame, excluded_job: str) -> DataFrame:
    """Job metadata without one excluded job; start and end are text."""
    return tasks.filter(F.col("dag_id") != excluded_job).select(
        *[
            F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) if c in TASK_TEXT_TIMES else F.col(c)
            for c in TASK_COLUMNS
        ]
    )


def over_threshold(value: Column, name: Column, limits: Mapping[str, float], default: float) -> Column:
    """Is the value over the limit of its name (or over the default limit)?"""
    limit = F.lit(float(default))
    for key, other in limits.items():
        limit = F.when(name == key, F.lit(float(other))).otherwise(limit)
    return value > limit


def long_running_tasks(
    tasks: DataFrame,
    today: date,
    excluded_job: str,
    minutes: float = 300,
    minutes_by_task: Mapping[str, float] | None = None,
) -> DataFrame:
    """Number of tasks started since yesterday that ran longer than their limit."""
    too_long = over_threshold(F.col("duration") / 60, F.col("task_id"), minutes_by_task or {}, minutes)
    since_yesterday = F.col("start_date") > F.date_sub(F.lit(today), 1)
    return tasks.filter((F.col("dag_id") != excluded_job) & too_long & since_yesterday).agg(
        F.count("task_id").alias("num_of_tasks")
    )

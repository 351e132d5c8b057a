"""Metadata jobs: job runs, coverage and freshness reports, lifecycle table, drift information."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.operators.derived import (
    COVERAGE_DATASETS,
    coverage_report,
    coverage_tables,
    freshness_results,
    lifecycle,
    long_running_tasks,
    task_metadata,
)
from lakeferry.operators.guards import contract_columns, drift_summary, schema_drift, value_check
from lakeferry.sinks.tables import DAY, beside, checked_rows, publish, reload_day, write_ndjson, write_report_csv
from lakeferry.sources.files import MAX_BAD_ROWS, COVERAGE_ARTIFACT, FRESHNESS_ARTIFACT, read_artifact, read_csv
from lakeferry.spec import TableSpec


def load_task_metadata(spark: SparkSession, tasks: DataFrame, excluded_job: str, root: str, view: str) -> None:
    """Replace the table of job runs, partitioned by start day."""
    rows = task_metadata(tasks, excluded_job)
    publish(spark, rows.withColumn(DAY, F.to_date("start_date")), view, root, [DAY])


def check_long_tasks(
    tasks: DataFrame, today: date, excluded_job: str, minutes: float = 300, minutes_by_task: Mapping[str, float] | None = None
) -> None:
    """Fail when a recent task ran longer than its limit."""
    value_check(long_running_tasks(tasks, today, excluded_job, minutes, minutes_by_task), 0)


def write_coverage(
    spark: SparkSession,
    tests: str,
    docs: str,
    execution_date: date,
    path: str,
    datasets: Sequence[str] = COVERAGE_DATASETS,
) -> None:
    """Coverage report out of the two artifacts."""
    parts = [coverage_tables(read_artifact(spark, p, COVERAGE_ARTIFACT)) for p in (tests, docs)]
    write_report_csv(coverage_report(*parts, execution_date, datasets), path)


def write_freshness(spark: SparkSession, artifact: str, execution_date: date, path: str) -> None:
    """Freshness report out of its artifact."""
    write_report_csv(freshness_results(read_artifact(spark, artifact, FRESHNESS_ARTIFACT), execution_date), path)


def load_report_day(
    spark: SparkSession,
    csv: str,
    schema: T.StructType,
    path: str,
    day_column: str,
    day: date,
    max_bad_rows: int = MAX_BAD_ROWS,
) -> int:
    """Replace one day of a report table with a written report; returns the number of bad rows.

    Bad rows are left out and kept beside the table, unless there are too many: then the old day stays.
    """
    rows, bad = checked_rows(read_csv(spark, csv, schema, header_rows=1), beside(path), max_bad_rows)
    reload_day(spark, rows, path, day_column, day)
    return bad


def rebuild_lifecycle(
    spark: SparkSession, log: DataFrame, keys: Sequence[str], action: str, at: str, root: str, view: str
) -> None:
    """Rebuild the lifecycle table from its log."""
    publish(spark, lifecycle(log, keys, action, at), view, root)


def write_table_info(spark: SparkSession, specs: Iterable[TableSpec], catalog: DataFrame, path: str) -> DataFrame:
    """Compare the contracts with the live catalog and keep the result as JSON; returns the differences."""
    contract = contract_columns(spark, specs)
    drift = schema_drift(contract, catalog)
    write_ndjson(drift_summary(contract, drift), path)
    return drift

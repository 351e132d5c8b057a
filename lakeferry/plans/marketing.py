"""Daily load of advertising reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeferry.operators.marketing import (
    APPLE_SCHEMA,
    SNAPCHAT_SCHEMA,
    TIKTOK_SCHEMA,
    apple_rows,
    snapchat_rows,
    tiktok_rows,
)
from lakeferry.sinks.tables import beside, checked_rows, replace_partitions
from lakeferry.sources.files import CORRUPT, MAX_BAD_ROWS, read_ndjson_flagged


def landed_reports(spark: SparkSession, landing: str, schema: str, path: str, max_bad_rows: int) -> DataFrame:
    """Reports that fit; too many that do not stop the load before the table changes."""
    rows, _ = checked_rows(read_ndjson_flagged(spark, landing, schema), beside(path), max_bad_rows)
    return rows.drop(CORRUPT)


def load_apple(spark: SparkSession, landing: str, path: str, max_bad_rows: int = MAX_BAD_ROWS) -> None:
    rows = apple_rows(landed_reports(spark, landing, APPLE_SCHEMA, path, max_bad_rows))
    replace_partitions(rows, path, ["date"])


def load_snapchat(spark: SparkSession, landing: str, path: str, max_bad_rows: int = MAX_BAD_ROWS) -> None:
    rows = snapchat_rows(landed_reports(spark, landing, SNAPCHAT_SCHEMA, path, max_bad_rows))
    replace_partitions(rows, path, ["date"])


def load_tiktok(spark: SparkSession, landing: str, path: str, max_bad_rows: int = MAX_BAD_ROWS) -> None:
    """Replace by day and account country; the country from the campaign name is plain data."""
    rows = tiktok_rows(landed_reports(spark, landing, TIKTOK_SCHEMA, path, max_bad_rows))
    days = rows.withColumn("day", rows["date"].cast("date"))
    replace_partitions(days, path, ["day", "account_country"])

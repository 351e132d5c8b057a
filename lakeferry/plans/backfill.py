"""Backfill: load beside the table, compare counts with the source, then promote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeferry.operators.guards import require_passed, row_count_check, table_counts
from lakeferry.sinks.tables import DAY, switch, with_day, write_snapshot
from lakeferry.spec import TableSpec


def target_layer(spec: TableSpec) -> str:
    """A daily table is promoted to the raw layer and refined from there, others straight to clean."""
    return "clean" if spec.ignore_daily else "raw"


def promote(
    spark: SparkSession,
    rows: DataFrame,
    spec: TableSpec,
    source_counts: DataFrame,
    root: str,
    view: str,
    tolerance: float = 0.001,
) -> str:
    """Write a backfill, check it and let readers see it.

    The written files are the backup: they become the table without another copy, and
    when the check fails readers keep the old table. They have the layout of the layer
    that they are promoted to, so that daily loads go on from there.
    """
    path = write_in_layout(rows, spec, root)
    if not spec.ignore_sanity_check:
        loaded = table_counts({spec.name: spark.read.parquet(path)})
        expected = source_counts.filter(source_counts["table_name"] == spec.name)
        require_counted(expected, spec)
        require_passed(row_count_check(expected, loaded, tolerance))
    switch(spark, view, path)
    return path


def write_in_layout(rows: DataFrame, spec: TableSpec, root: str) -> str:
    """Raw tables by the contract's day, clean ones by creation day and key, as the daily jobs write them."""
    if target_layer(spec) == "raw":
        day = spec.partition_column if spec.ts_column else None
        return write_snapshot(with_day(rows, day), root, [DAY]) if day else write_snapshot(rows, root)
    cluster_by = [spec.key] if spec.key in rows.columns else []
    if "created_at" in rows.columns:
        return write_snapshot(with_day(rows, "created_at"), root, [DAY], cluster_by)
    return write_snapshot(rows, root, (), cluster_by)


def require_counted(expected: DataFrame, spec: TableSpec) -> None:
    if expected.isEmpty():
        raise ValueError(f"no source count for {spec.name}")


def copy_table(spark: SparkSession, source: DataFrame, root: str, view: str) -> str:
    """Copy a table as it is now; the copy replaces the older copy."""
    path = write_snapshot(source, root)
    switch(spark, view, path)
    return path

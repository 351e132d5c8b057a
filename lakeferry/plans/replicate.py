"""Daily replication: source rows -> raw versions -> clean table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.functions.json_documents import POLICY_FIELDS, JsonField, project_json
from lakeferry.functions.normalize import normalize_rows, with_ingested_ts
from lakeferry.operators.latest import latest_per_key
from lakeferry.sinks.tables import DAY, append_to, clustered, current_path, publish, reload_day, switch, with_day
from lakeferry.spec import INGESTED_TS, TableSpec


def landed(source: DataFrame, spec: TableSpec, run_ts: datetime | str, joined_lists: bool = False) -> DataFrame:
    """Source rows in landed types with the run timestamp."""
    return with_ingested_ts(normalize_rows(source, spec, joined_lists), run_ts)


def load_raw(
    spark: SparkSession,
    source: DataFrame,
    spec: TableSpec,
    run_ts: datetime | str,
    root: str,
    view: str,
    backfill: bool = False,
) -> None:
    """Append the run's rows, or replace the raw table (full reload or backfill).

    A table without a timestamp column is read in full every time, so it is replaced.
    """
    rows = landed(source, spec, run_ts)
    day_column = spec.partition_column if spec.ts_column else None
    path = current_path(spark, view)
    if spec.ts_column and not backfill and path is not None:
        append_to(spark, rows, view, day_column)
    elif day_column is not None:
        publish(spark, with_day(rows, day_column), view, root, [DAY])
    else:
        publish(spark, rows, view, root)


def load_raw_day(
    spark: SparkSession, source: DataFrame, spec: TableSpec, run_ts: datetime | str, view: str, day_column: str, day: date
) -> None:
    """Reload one day of a raw table; running it again gives the same table."""
    path = current_path(spark, view)
    if path is None:
        raise ValueError(f"there is no table {view}")
    rows = landed(source, spec, run_ts)
    reload_day(spark, rows, path, day_column, day)
    if set(rows.columns) - set(spark.table(view).columns):
        switch(spark, view, path, grown=True)


def refined(
    raw: DataFrame, spec: TableSpec, documents: dict[str, Sequence[JsonField]] | None = None, ties: str = "all"
) -> DataFrame:
    """Current version per key, with JSON documents projected to columns."""
    return with_documents(current_rows(raw, spec, ties), documents)


def current_rows(raw: DataFrame, spec: TableSpec, ties: str = "all") -> DataFrame:
    """Current versions; copies of one version, as a repeated run leaves them, count once."""
    tie_break = [] if ties == "all" else [F.xxhash64("*")]
    return latest_per_key(raw, [spec.key], INGESTED_TS, ties, tie_break).distinct()


def with_documents(rows: DataFrame, documents: dict[str, Sequence[JsonField]] | None) -> DataFrame:
    for column, fields in (documents or {}).items():
        rows = project_json(rows, column, fields)
    return rows


def build_clean(
    spark: SparkSession,
    raw: DataFrame,
    spec: TableSpec,
    root: str,
    view: str,
    documents: dict[str, Sequence[JsonField]] | None = None,
) -> None:
    """Rebuild the clean table, partitioned by creation day and clustered by key.

    Documents are projected after the rows are laid out: the sampling of key ranges does
    not parse them, and the shuffle does not carry the extra columns. Sensitive tables
    have a raw layer only.
    """
    if spec.gdpr_sensitive:
        raise ValueError(f"{spec.name} is sensitive and has no clean layer")
    rows = current_rows(raw.drop(DAY), spec)
    partition_by = []
    if "created_at" in rows.columns:
        rows, partition_by = with_day(rows, "created_at"), [DAY]
    rows = with_documents(clustered(rows, partition_by, [spec.key]), documents)
    publish(spark, rows, view, root, partition_by, keep_layout=True)


POLICY_DOCUMENT = {"main_policy": POLICY_FIELDS}

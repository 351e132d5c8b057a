"""Replication by runs: raw and clean tables with a ledger (``sinks.ledger``).

A run that is repeated replaces what it loaded before, so a raw table has every row version once and a clean table has
one row per key and version without comparing whole rows. A clean table is brought up to date from the loads that its
raw table has gained or lost since: only the days with keys of these loads are written again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import asdict, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.functions.json_documents import JsonField
from lakeferry.operators.guards import require_passed, row_count_check, table_counts
from lakeferry.operators.latest import latest_per_key
from lakeferry.plans.backfill import require_counted, target_layer
from lakeferry.plans.replicate import landed, with_documents
from lakeferry.sinks.ledger import LOAD, NO_DAY, Ledger, commit, ledger_of, load_rows, merge_rows, replace_days, source_of, write_load
from lakeferry.sinks.tables import DAY, require_value, with_day
from lakeferry.spec import INGESTED_TS, TableSpec


def dated(rows: DataFrame, column: str | None) -> DataFrame:
    """Rows with the column of the day; a table without such a column has no days."""
    return with_day(rows, column) if column else rows.withColumn(DAY, F.lit(None).cast("date"))


def load_run(
    spark: SparkSession, source: DataFrame | Iterable[DataFrame], spec: TableSpec, run_ts: str, root: str, view: str
) -> Ledger:
    """Load a run into a raw table; the same run again replaces its rows, also those that the source no longer has.

    A table without a timestamp column is read in full every time, so it is replaced. A source in several parts, as
    ``read_waves`` gives it, is loaded part by part and shown at once.
    """
    column = spec.partition_column if spec.ts_column else None
    if isinstance(source, DataFrame):
        return load_rows(spark, dated(landed(source, spec, run_ts), column), view, root, run_ts, whole=not spec.ts_column)
    before = ledger_of(spark, view) or Ledger(root)
    again = [n for n, r in enumerate(before.runs, 1) if r == run_ts]
    gone = again if spec.ts_column else range(1, before.next_load)
    ledger = before
    for part in source:
        ledger = write_load(spark, dated(landed(part, spec, run_ts), column), ledger, run_ts)
    known = set(before.every_row(spark).columns) if before.runs else set()
    grown = before.grown or bool(known) and not set(ledger.every_row(spark).columns) <= known
    ledger = replace(ledger, hidden=tuple(sorted({*before.hidden, *gone})), grown=grown)
    commit(spark, view, ledger)
    return ledger


def load_run_day(spark: SparkSession, source: DataFrame, spec: TableSpec, run_ts: str, view: str, day: date) -> Ledger:
    """Replace one day of a raw table by what the source has now; fails at a row of another day."""
    rows = dated(landed(source, spec, run_ts), spec.partition_column)
    return replace_days(spark, require_value(rows, DAY, F.lit(day)), view, [day.isoformat()], run_ts)


def promote_run(
    spark: SparkSession, rows: DataFrame, spec: TableSpec, source_counts: DataFrame, run_ts: str, root: str, view: str, tolerance: float = 0.001
) -> Ledger:
    """Write a backfill as a load that is not seen yet, check its row count and let it replace the table.

    Nothing is copied, and when the check fails readers keep what they saw. ``rows`` are in landed types.
    """
    before = ledger_of(spark, view) or Ledger(root)
    column = "created_at" if target_layer(spec) == "clean" else spec.partition_column if spec.ts_column else None
    written = write_load(spark, dated(rows, column if column in rows.columns else None), before, run_ts)
    if not spec.ignore_sanity_check:
        expected = source_counts.filter(source_counts["table_name"] == spec.name)
        require_counted(expected, spec)
        own = written.every_row(spark).where(F.col(LOAD) == len(written.runs))
        require_passed(row_count_check(expected, table_counts({spec.name: own}), tolerance))
    gone = tuple(range(1, before.next_load))
    written = replace(written, hidden=gone, days={}, files=(), grown=before.grown or bool(before.runs))
    commit(spark, view, written)
    return written


def merge_run(spark: SparkSession, source: DataFrame, view: str, keys: Sequence[str], run_ts: str, day_column: str | None = None) -> int:
    """Upsert rows into a table; only files that hold one of their keys are written again. Returns how many these are."""
    return merge_rows(spark, source, view, keys, run_ts, lambda df: dated(df, day_column))


def versions(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Current versions: rows of the newest run of their key. A run is in a raw table once, so no copies arise."""
    return latest_per_key(raw, [spec.key], INGESTED_TS)


def build_clean_run(
    spark: SparkSession,
    raw_view: str,
    spec: TableSpec,
    root: str,
    view: str,
    documents: dict[str, Sequence[JsonField]] | None = None,
) -> Ledger:
    """Build the clean table of a raw table from all its rows."""
    source, ledger = _raw(spark, raw_view, spec), ledger_of(spark, view) or Ledger(root)
    known = set(ledger.every_row(spark).columns) if ledger.runs else None
    rows = with_documents(_by_day(versions(source.rows(spark).drop(DAY, LOAD), spec)), documents)
    gone = tuple(range(1, ledger.next_load))
    grown = known is not None and (ledger.grown or not set(rows.columns) <= known)
    written = write_load(spark, rows, ledger, _last_run(source), [spec.key])
    written = replace(written, hidden=gone, days={}, files=(), grown=grown, source=asdict(source))
    commit(spark, view, written)
    return written


def refresh_clean(
    spark: SparkSession,
    raw_view: str,
    spec: TableSpec,
    root: str,
    view: str,
    documents: dict[str, Sequence[JsonField]] | None = None,
) -> list[str]:
    """Bring the clean table up to date with its raw table; returns the days that were written again.

    Keys of raw rows that were added or taken away since the last time are looked up in the clean table, which tells the
    days to write; rows of other keys in these days are copied as they are, so documents are projected for changed keys
    alone. If all that was added is of later runs, its newest versions are the current ones; else the versions of the
    changed keys are sought in the whole raw table. The result is that of ``build_clean_run``.
    """
    raw, ledger = _raw(spark, raw_view, spec), ledger_of(spark, view)
    old = source_of(ledger) if ledger else None
    if old is None or old.root != raw.root:
        build_clean_run(spark, raw_view, spec, root, view, documents)
        return _days(ledger_of(spark, view).rows(spark))
    if (old.filter(), old.runs) == (raw.filter(), raw.runs):
        return []
    seen, was = (f"coalesce({x.filter()}, false)" for x in (raw, old))
    changed = raw.every_row(spark).where(f"{seen} <> {was}").drop(DAY)
    keys = changed.where(F.col(spec.key).isNotNull()).select(F.col(spec.key).alias("__key")).distinct()
    if _only_later(old, raw):
        fresh = versions(changed.drop(LOAD), spec)
    else:
        every = raw.rows(spark).drop(DAY, LOAD)
        fresh = versions(every.join(keys, every[spec.key] == keys["__key"], "left_semi"), spec)
    fresh = with_documents(_by_day(fresh), documents)
    clean = ledger.rows(spark).drop(LOAD)
    is_touched = clean[spec.key] == keys["__key"]
    days = sorted({*_days(clean.join(keys, is_touched, "left_semi")), *_days(fresh)})
    iso = [d for d in days if d != NO_DAY]
    of_days = F.col(DAY).cast("string").isin(iso) | (F.col(DAY).isNull() if NO_DAY in days else F.lit(False))
    rows = clean.where(of_days).join(keys, is_touched, "left_anti").unionByName(fresh, allowMissingColumns=True)
    replace_days(spark, rows, view, days, _last_run(raw), [spec.key], source=asdict(raw))
    return days


def _raw(spark: SparkSession, raw_view: str, spec: TableSpec) -> Ledger:
    if spec.gdpr_sensitive:
        raise ValueError(f"{spec.name} is sensitive and has no clean layer")
    ledger = ledger_of(spark, raw_view)
    if ledger is None:
        raise ValueError(f"there is no table {raw_view}")
    return ledger


def _by_day(rows: DataFrame) -> DataFrame:
    return dated(rows, "created_at" if "created_at" in rows.columns else None)


def _last_run(ledger: Ledger) -> str:
    return ledger.runs[-1]


def _only_later(old: Ledger, new: Ledger) -> bool:
    """Whether the new ledger only adds loads, all of later runs than the old one has."""
    added = new.runs[len(old.runs) :]
    same = (old.hidden, old.days, old.files) == (new.hidden, new.days, new.files)
    return same and bool(added) and min(added) > max(old.runs, default="")


def _days(rows: DataFrame) -> list[str]:
    """The days of some rows; there is one for each day of the table at most."""
    return [NO_DAY if r[0] is None else r[0] for r in rows.select(F.col(DAY).cast("string")).distinct().collect()]

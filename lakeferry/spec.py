"""Table contracts: which columns a replicated table has and how it is loaded."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

from lakeferry.functions.types import spark_type

INGESTED_TS = "_ingested_ts"


@dataclass(frozen=True)
class SourceSpec:
    """One source database."""

    name: str
    instance: str
    database: str
    destination: str

    @property
    def raw_schema(self) -> str:
        return f"{self.clean_schema}_staging"

    @property
    def clean_schema(self) -> str:
        # a staging copy of a database lands in the same schema of another destination
        return self.name.removesuffix("-staging").replace("-", "_")


@dataclass(frozen=True)
class TableSpec:
    """One replicated table. ``columns`` holds (unquoted name, declared type) pairs."""

    source_name: str
    columns: tuple[tuple[str, str], ...]
    ts_column: str | None = None
    partition_column: str | None = None
    backfill_method: str | None = None
    chunk_mode: str | None = None
    chunk_rows: int = 50_000
    chunk_column: str = "id"
    ignore_sanity_check: bool = False
    ignore_daily: bool = False
    gdpr_sensitive: bool = False
    key: str = "id"

    @classmethod
    def from_contract(cls, name: str, body: Mapping) -> TableSpec:
        """Build a spec from one entry of a contract file."""
        query_by = body.get("query_by")
        # the two spellings of the chunk size both occur; step_size counts rows only for row ranges
        rows = body.get("chunk_size", body.get("chunksize"))
        if query_by == "offset":
            rows = body.get("step_size", rows)
        return cls(
            source_name=name,
            columns=tuple((c.strip('"'), t) for c, t in body["schema"].items()),
            ts_column=body.get("ts_column"),
            partition_column=body.get("bq_partition_column"),
            backfill_method=body.get("backfill_method"),
            chunk_mode=None if query_by is None else "range" if query_by == "offset" else "day",
            chunk_rows=int(rows) if rows else 50_000,
            chunk_column=_usable(body.get("ordered_by")) or "id",
            ignore_sanity_check=bool(body.get("ignore_sanity_check", False)),
            ignore_daily=bool(body.get("ignore_daily", False)),
            gdpr_sensitive=bool(body.get("gdpr_sensitive", False)),
            key=body.get("key", "id").strip('"'),
        )

    @property
    def name(self) -> str:
        """Table name without the schema prefix and quotes."""
        return self.source_name.split(".")[-1].strip('"')

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def declared(self) -> dict[str, str]:
        return dict(self.columns)

    @property
    def timestamp_columns(self) -> list[str]:
        return [c for c, t in self.columns if "timestamp" in t]

    def spark_schema(self, ingested: bool = True) -> T.StructType:
        """Schema of the landed table; every column is nullable."""
        fields = [T.StructField(c, spark_type(t)) for c, t in self.columns]
        if ingested:
            fields.append(T.StructField(INGESTED_TS, T.TimestampType()))
        return T.StructType(fields)


def _usable(name: str | None) -> str | None:
    # "_" stands for "no column" in contracts that are read by day
    return None if name in (None, "", "_") else name


def load_specs(path: str) -> dict[str, TableSpec]:
    """Read a contract file (table name -> contract)."""
    with open(path, encoding="utf-8") as f:
        return parse_specs(json.load(f))


def parse_specs(contracts: Mapping[str, Mapping]) -> dict[str, TableSpec]:
    return {name: TableSpec.from_contract(name, body) for name, body in contracts.items()}


def daily_tables(specs: Iterable[TableSpec]) -> list[TableSpec]:
    """Tables of the daily raw load; personal-data tables are loaded raw as well."""
    return [s for s in specs if not s.ignore_daily]


def clean_tables(specs: Iterable[TableSpec]) -> list[TableSpec]:
    """Tables that get a clean layer: daily ones that are not marked as sensitive."""
    return [s for s in daily_tables(specs) if not s.gdpr_sensitive]


def backfill_tables(specs: Iterable[TableSpec], method: str) -> list[TableSpec]:
    return [s for s in specs if s.backfill_method == method]


def counted_tables(specs: Iterable[TableSpec]) -> list[TableSpec]:
    """Exported tables whose row count is compared with the source."""
    return [
        s
        for s in specs
        if s.backfill_method in ("direct_export", "nested_export") and not s.ignore_sanity_check
    ]

"""Checks around a load: schema drift, row counts, single values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.functions.types import WIDER, type_class
from lakeferry.spec import TableSpec


class CheckFailed(Exception):
    """A guard found a problem."""


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row (table_name, num_rows) per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("num_rows")).select(F.lit(name).alias("table_name"), "num_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def row_count_check(expected: DataFrame, loaded: DataFrame, tolerance: float = 0.001) -> DataFrame:
    """Compare counts per table; a table passes when at most ``tolerance`` of its rows are missing.

    More rows than expected pass. A table that was not loaded does not.
    """
    e = expected.select("table_name", F.col("num_rows").alias("expected_rows"))
    a = loaded.select("table_name", F.col("num_rows").alias("loaded_rows"))
    needed = F.col("expected_rows") * F.lit(1 - tolerance)
    return e.join(a, "table_name", "left").withColumn(
        "passed", F.coalesce(needed <= F.col("loaded_rows"), F.lit(False))
    )


def require_passed(check: DataFrame) -> None:
    """Fail when a row of a check (one row per table of the contract) did not pass; every failed table is named."""
    failed = check.filter("not passed").collect()
    if failed:
        raise CheckFailed("; ".join(str(r.asDict()) for r in failed))


def value_check(df: DataFrame, pass_value) -> None:
    """Fail unless the single value of a one-row, one-column DataFrame is ``pass_value``."""
    rows = df.limit(2).collect()
    found = rows[0][0] if len(rows) == 1 else [r[0] for r in rows]
    if found != pass_value:
        raise CheckFailed(f"expected {pass_value!r}, found {found!r}")


def contract_columns(spark: SparkSession, specs: Iterable[TableSpec]) -> DataFrame:
    """Contract as rows (table_name, column_name, data_type)."""
    rows = [(s.name, c, t) for s in specs for c, t in s.columns]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def schema_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Live schemas as rows (table_name, column_name, data_type)."""
    rows = [(n, f.name, f.dataType.simpleString()) for n, df in tables.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


def document_columns(df: DataFrame, table_name: str, column: str) -> DataFrame:
    """Columns that really occur in landed JSON rows, with how many rows have them.

    The key lists are folded before they are spread out, so only distinct lists are exploded.
    """
    return (
        df.select(F.json_object_keys(column).alias("keys"))
        .groupBy("keys")
        .agg(F.count(F.lit(1)).alias("n"))
        # the outer form keeps Spark from testing the lists once more in front of the grouping
        .select(F.explode_outer("keys").alias("column_name"), "n")
        .filter("column_name is not null")
        .groupBy("column_name")
        .agg(F.sum("n").alias("num_rows"))
        .select(F.lit(table_name).alias("table_name"), "column_name", "num_rows")
    )


def bare_name(name: Column) -> Column:
    """Name without quotes and without a schema prefix."""
    return F.replace(F.element_at(F.split(name, r"\."), -1), F.lit('"'), F.lit(""))


def schema_drift(contract: DataFrame, catalog: DataFrame, compare_types: bool = True) -> DataFrame:
    """Differences between contract and catalog per column.

    ``missing`` columns are only in the contract, ``extra`` ones only in the catalog,
    ``type_changed`` ones differ in their declared type.
    """
    keys = ["table_name", "column_name"]

    def named(df: DataFrame, type_name: str) -> DataFrame:
        dtype = F.col("data_type") if "data_type" in df.columns else F.lit(None).cast("string")
        return df.select(*[bare_name(F.col(k)).alias(k) for k in keys], dtype.alias(type_name), F.lit(True).alias(f"in_{type_name}"))

    both = named(contract, "contract_type").join(named(catalog, "catalog_type"), keys, "full_outer")
    status = F.when(F.col("in_catalog_type").isNull(), "missing").when(F.col("in_contract_type").isNull(), "extra")
    if compare_types:
        status = status.when(F.col("contract_type") != F.col("catalog_type"), "type_changed")
    return both.withColumn("status", status).filter("status is not null").select(
        *keys, "status", "contract_type", "catalog_type"
    )


def drift_summary(contract: DataFrame, drift: DataFrame) -> DataFrame:
    """Per contract table: can it be extracted, and which columns are in the way."""
    names = F.array_join(F.array_sort(F.collect_set("column_name")), ", ")
    bad = drift.groupBy("table_name").agg(names.alias("drifted_columns"))
    tables = contract.select(bare_name(F.col("table_name")).alias("table_name")).distinct()
    return tables.join(bad, "table_name", "left").withColumn("extract", F.col("drifted_columns").isNull())


def column_listing(catalog: DataFrame) -> DataFrame:
    """Columns of every table as one text ``name:type, name:type``."""
    pair = F.concat_ws(":", "column_name", "data_type")
    return catalog.groupBy("table_name").agg(
        F.array_join(F.array_sort(F.collect_list(pair)), ", ").alias("columns")
    )


def tables_to_load(specs: Iterable[TableSpec], drift: DataFrame, on_drift: str = "warn") -> list[TableSpec]:
    """Apply the drift result: ``warn`` loads all, ``skip`` leaves drifted tables out, ``fail`` stops."""
    specs = list(specs)
    drifted = {r.table_name for r in drift.select("table_name").distinct().collect()}
    if on_drift == "fail" and drifted:
        raise CheckFailed(f"schema drift in {', '.join(sorted(drifted))}")
    if on_drift == "skip":
        return [s for s in specs if s.name not in drifted]
    if on_drift not in ("warn", "fail"):
        raise ValueError(f"unknown on_drift {on_drift!r}")
    return specs


def observed_types(df: DataFrame, table_name: str, column: str) -> DataFrame:
    """Columns of landed JSON rows with the narrowest type that holds all their values, as (table_name, column_name,
    data_type). The types of rows are merged map-side, so one row leaves each task. Texts that are no JSON do not count."""
    merged = df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(column)))).first()[0] or ""
    rows = [(table_name, name, kind) for name, kind in _fields(merged)]
    return df.sparkSession.createDataFrame(rows, "table_name string, column_name string, data_type string")


def _fields(merged: str) -> list[tuple[str, str]]:
    """Names and types of an object type such as ``OBJECT<a: BIGINT, b: ARRAY<STRING>>``."""
    if not merged.startswith("OBJECT<"):
        return []
    inner, parts, depth = merged[len("OBJECT<") : -1], [""], 0
    for c in inner:
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            parts.append("")
        else:
            parts[-1] += c
    pairs = [p.strip().split(": ", 1) for p in parts if p.strip()]
    return [(name.strip("`"), kind.lower()) for name, kind in pairs]


def type_drift(contract: DataFrame, found: DataFrame) -> DataFrame:
    """What to do with each column of a contract and of the types that were found.

    ``keep``: the contract's type holds what was found. ``widen``: the type found holds all values of the contract's, and
    ``new_type`` is its name. ``refuse``: neither holds the other. ``add``: the contract lacks the column. ``missing``: it
    was not found. A column without values keeps its type.
    """
    keys = ["table_name", "column_name"]

    def named(df: DataFrame, type_name: str) -> DataFrame:
        return df.select(*[bare_name(F.col(k)).alias(k) for k in keys], F.lower("data_type").alias(type_name))

    both = named(contract, "contract_type").join(named(found, "found_type"), keys, "full_outer")
    old, new = type_class(F.col("contract_type")), type_class(F.col("found_type"))
    wider = F.create_map(*[x for k, v in WIDER.items() for x in (F.lit(k), F.array(*map(F.lit, v)).cast("array<string>"))])
    decision = (
        F.when(F.col("found_type").isNull(), "missing")
        .when(F.col("contract_type").isNull(), "add")
        .when((F.col("found_type") == "void") | (old == new) | F.array_contains(wider[new], old), "keep")
        .when(F.array_contains(wider[old], new), "widen")
        .otherwise("refuse")
    )
    decided = both.withColumn("decision", decision)
    return decided.withColumn("new_type", F.when(F.col("decision").isin("widen", "add"), new))


def grown_contract(spec: TableSpec, drift: DataFrame) -> TableSpec:
    """The contract with widened types and added columns; fails at a column whose type neither holds nor is held."""
    rows = [r for r in drift.filter("decision in ('widen', 'add', 'refuse')").orderBy("column_name").collect() if r["table_name"] == spec.name]
    refused = [r["column_name"] for r in rows if r["decision"] == "refuse"]
    if refused:
        raise CheckFailed(f"{spec.name}: types changed beyond widening in {', '.join(refused)}")
    widened = {r["column_name"]: r["new_type"] for r in rows if r["decision"] == "widen"}
    added = tuple((r["column_name"], r["new_type"]) for r in rows if r["decision"] == "add")
    return replace(spec, columns=tuple((c, widened.get(c, t)) for c, t in spec.columns) + added)

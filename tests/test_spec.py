from pyspark.sql import types as T

from lakeferry.functions.types import spark_type
from lakeferry.spec import (
    SourceSpec,
    backfill_tables,
    clean_tables,
    counted_tables,
    daily_tables,
    load_specs,
    parse_specs,
)

CONTRACTS = {
    "visits": {
        "schema": {"id": "text", "created_at": "timestamp with time zone", "policy": "jsonb", "score": "numeric"},
        "ts_column": "greatest(made_at, seen_at)",
        "bq_partition_column": "created_at",
        "backfill_method": "beam_export",
        "query_by": "timestamp",
        "step_size": "1",
        "ordered_by": "_",
        "chunksize": "5000",
    },
    "clinic.entries": {
        "schema": {"id": "integer", '"order"': "integer", '"from"': "character varying", "tags": "ARRAY"},
        "backfill_method": "nested_export",
        "query_by": "offset",
        "step_size": "3000",
        "ordered_by": "id",
        "chunk_size": "50",
    },
    "transactions": {"schema": {"id": "bigint"}, "backfill_method": "direct_export", "ignore_daily": True},
    "notes": {"schema": {"id": "bigint"}, "gdpr_sensitive": True},
    "unchecked": {"schema": {"id": "uuid"}, "backfill_method": "direct_export", "ignore_sanity_check": True},
}


def test_types_of_declared_columns():
    assert spark_type("bigint") == T.LongType() == spark_type("integer")
    assert spark_type("timestamp without time zone") == T.TimestampType()
    assert spark_type("numeric") == T.DecimalType(38, 9)
    assert spark_type("ARRAY") == T.ArrayType(T.StringType())
    assert {spark_type(t) for t in ("jsonb", "json", "uuid", "text", "character varying", "character")} == {T.StringType()}


def test_names_and_quotes():
    spec = parse_specs(CONTRACTS)["clinic.entries"]
    assert spec.name == "entries" and spec.source_name == "clinic.entries"
    assert spec.column_names == ["id", "order", "from", "tags"]
    schema = spec.spark_schema()
    assert schema.names[-1] == "_ingested_ts" and all(f.nullable for f in schema.fields)
    assert "_ingested_ts" not in spec.spark_schema(ingested=False).names


def test_chunk_settings():
    specs = parse_specs(CONTRACTS)
    assert (specs["visits"].chunk_mode, specs["visits"].chunk_rows) == ("day", 5000)
    assert specs["visits"].chunk_column == "id"
    assert (specs["clinic.entries"].chunk_mode, specs["clinic.entries"].chunk_rows) == ("range", 3000)
    assert specs["transactions"].chunk_mode is None and specs["transactions"].chunk_rows == 50_000


def test_selection_by_flags(tmp_path):
    import json

    path = tmp_path / "contract.json"
    path.write_text(json.dumps(CONTRACTS))
    specs = load_specs(str(path)).values()
    assert "transactions" not in [s.name for s in daily_tables(specs)]
    assert "notes" in [s.name for s in daily_tables(specs)]
    assert [s.name for s in clean_tables(specs)] == ["visits", "entries", "unchecked"]
    assert [s.name for s in backfill_tables(specs, "beam_export")] == ["visits"]
    assert [s.name for s in counted_tables(specs)] == ["entries", "transactions"]


def test_source_schemas():
    assert SourceSpec("main", "i", "main", "p").raw_schema == "main_staging"
    assert SourceSpec("main-staging", "i", "main", "q").clean_schema == "main"

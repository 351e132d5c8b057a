"""Tables with a ledger: repeated runs, refreshed clean tables, merges that leave other files alone."""

import glob
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeferry.functions.json_documents import JsonField
from lakeferry.operators import guards
from lakeferry.operators.guards import CheckFailed, table_counts
from lakeferry.plans import runs
from lakeferry.plans.replicate import landed, refined
from lakeferry.sinks import ledger
from lakeferry.spec import TableSpec

RUN_1, RUN_2, RUN_3 = "2024-02-01 00:00:00", "2024-02-02 00:00:00", "2024-02-03 00:00:00"
SPEC = TableSpec.from_contract(
    "t",
    {
        "schema": {"id": "bigint", "created_at": "timestamp without time zone", "note": "text", "doc": "jsonb"},
        "ts_column": "created_at",
        "bq_partition_column": "created_at",
    },
)
DOCUMENTS = {"doc": [JsonField("doc_n", ("$.n",), "integer")]}


def source(spark, ids, note="a", day=None):
    made = [(i, None if day == 0 else datetime(2024, 1, day or 1 + i % 9, 5), note, f'{{"n": {i}}}') for i in ids]
    return spark.createDataFrame(made, "id long, created_at timestamp_ntz, note string, doc string")


@pytest.fixture
def load(spark, tmp_path, view):
    return lambda df, run, spec=SPEC: runs.load_run(spark, df, spec, run, str(tmp_path / "raw"), view)


def notes(spark, view):
    return sorted((r["id"], r["note"]) for r in spark.table(view).collect())


def test_a_repeated_run_replaces_its_rows(spark, load, view):
    load(source(spark, range(5)), RUN_1)
    load(source(spark, [2, 3, 20], "b"), RUN_2)
    assert len(notes(spark, view)) == 8
    load(source(spark, [2, 21], "c"), RUN_2)
    assert notes(spark, view) == [(0, "a"), (1, "a"), (2, "a"), (2, "c"), (3, "a"), (4, "a"), (21, "c")]
    load(source(spark, []), RUN_1)
    assert notes(spark, view) == [(2, "c"), (21, "c")]
    current = runs.versions(spark.table(view), SPEC)
    assert rows(current.select("id", "note")) == [(2, "c"), (21, "c")]


def test_failed_loads_are_not_seen(spark, load, view, tmp_path):
    load(source(spark, [1]), RUN_1)
    broken = source(spark, range(2, 60)).withColumn("note", F.when(F.col("id") < 50, "x").otherwise(F.raise_error(F.lit("no")).cast("string")))
    with pytest.raises(Exception, match="no"):
        load(broken, RUN_2)
    # as a load leaves it that stops between its files and its ledger
    ledger.write_load(spark, runs.dated(source(spark, [7]), "created_at").withColumn("_ingested_ts", F.lit(RUN_2).cast("timestamp")), ledger.ledger_of(spark, view), RUN_2)
    assert notes(spark, view) == [(1, "a")]
    load(source(spark, [2]), RUN_2)
    assert notes(spark, view) == [(1, "a"), (2, "a")]


def test_parts_of_a_run_are_shown_at_once(spark, load, view):
    def parts():
        for i in range(3):
            assert not spark.catalog.tableExists(view)
            yield source(spark, [i])

    load(parts(), RUN_1)
    assert [i for i, _ in notes(spark, view)] == [0, 1, 2]
    load([source(spark, [5], "b"), source(spark, [6], "b")], RUN_1)
    assert notes(spark, view) == [(5, "b"), (6, "b")]


def test_tables_without_a_timestamp_are_replaced(spark, tmp_path, view):
    spec = TableSpec.from_contract("u", {"schema": {"id": "bigint"}})
    for n in (3, 2):
        runs.load_run(spark, spark.range(n), spec, RUN_1, str(tmp_path), view)
    assert spark.table(view).count() == 2 and spark.table(view).columns == ["id", "_ingested_ts"]


def test_a_day_is_replaced(spark, load, view):
    load(source(spark, range(18)), RUN_1)
    runs.load_run_day(spark, source(spark, [100], "new", day=3), SPEC, RUN_2, view, date(2024, 1, 3))
    assert [i for i, _ in notes(spark, view)] == [i for i in range(18) if i % 9 != 2] + [100]
    load(source(spark, [101], day=3), RUN_3)
    assert {100, 101} < {i for i, _ in notes(spark, view)}
    runs.load_run_day(spark, source(spark, []), SPEC, RUN_3, view, date(2024, 1, 3))
    assert [i for i, _ in notes(spark, view)] == [i for i in range(18) if i % 9 != 2]
    with pytest.raises(Exception, match="unexpected _day"):
        runs.load_run_day(spark, source(spark, [1], day=4), SPEC, RUN_3, view, date(2024, 1, 3))


def test_columns_that_join_later(spark, load, view):
    narrow = TableSpec(**{**SPEC.__dict__, "columns": SPEC.columns[:2]})
    load(source(spark, [1]), RUN_1, narrow)
    load(source(spark, [2]), RUN_2)
    assert rows(spark.table(view).select("id", "note")) == [(1, None), (2, "a")]


def files_of(root):
    return {p.split("/data/")[1] for p in glob.glob(f"{root}/data/**/*.parquet", recursive=True)}


def visible_files(spark, name):
    found = ledger.ledger_of(spark, name).rows(spark).select(F.col("_metadata.file_path")).distinct().collect()
    return {r[0].split("/data/")[1] for r in found}


def test_refreshed_clean_table(spark, load, view, tmp_path):
    clean, whole, root = view + "_clean", view + "_whole", str(tmp_path / "clean")

    def refresh():
        before = visible_files(spark, clean) if spark.catalog.tableExists(clean) else set()
        days = runs.refresh_clean(spark, view, SPEC, root, clean, DOCUMENTS)
        runs.build_clean_run(spark, view, SPEC, str(tmp_path / "whole"), whole, DOCUMENTS)
        assert rows(spark.table(clean).select(*spark.table(whole).columns)) == rows(spark.table(whole))
        want = refined(spark.table(view), SPEC, DOCUMENTS)
        assert rows(spark.table(clean).select(*want.columns)) == rows(want)
        # files of other days keep their names
        other = {f for f in before if not any(f"_day={d}/" in f or (d == ledger.NO_DAY and "HIVE" in f) for d in days)}
        assert other <= visible_files(spark, clean)
        return days, other

    load(source(spark, range(90)), RUN_1)
    assert len(refresh()[0]) == 9
    assert refresh() == ([], visible_files(spark, clean))
    # later versions, a new key, a key that moves to another day, one without a day and a null key
    load(source(spark, [3, 93], "b").union(source(spark, [5], "moved", day=1)).union(source(spark, [8], "none", day=0)), RUN_2)
    moved = ["2024-01-01", "2024-01-04", "2024-01-06", "2024-01-09", "null"]
    days, other = refresh()
    assert days == moved and len(other) >= 5
    # the run is repeated without some of its rows
    load(source(spark, [5], "b"), RUN_2)
    assert refresh()[0] == moved
    assert {r["id"]: (r["note"], r["doc_n"]) for r in spark.table(clean).collect()}[5] == ("b", 5)
    load(source(spark, [8], "none", day=0), RUN_3)
    assert refresh()[0] == ["2024-01-09", "null"]
    # a repeated older run loses rows and changes others
    load(source(spark, [8, 40], "again"), RUN_2)
    refresh()
    # days of the raw table that are read again
    runs.load_run_day(spark, source(spark, [0, 9], "day"), SPEC, "2024-02-04 00:00:00", view, date(2024, 1, 1))
    refresh()
    load(source(spark, range(200, 260)), "2024-02-05 00:00:00")
    refresh()
    sensitive = TableSpec(**{**SPEC.__dict__, "gdpr_sensitive": True})
    with pytest.raises(ValueError, match="sensitive"):
        runs.refresh_clean(spark, view, sensitive, root, clean)


def test_merge_rewrites_hit_files_alone(spark, tmp_path, view):
    root = str(tmp_path / "t")
    spec = TableSpec.from_contract("t", {"schema": {"id": "bigint", "note": "text"}, "ts_column": "x"})
    parts = [spark.createDataFrame([(i, "a") for i in range(k * 100, k * 100 + 100)], "id long, note string").coalesce(1) for k in range(6)]
    runs.load_run(spark, parts, spec, RUN_1, root, view)
    before = visible_files(spark, view)
    assert len(before) == 6
    change = spark.createDataFrame([(150, "b"), (199, "b"), (450, "b"), (1000, "new")], "id long, note string").withColumn("_ingested_ts", F.lit(RUN_2).cast("timestamp"))
    assert runs.merge_run(spark, change, view, ["id"], RUN_2) == 2
    after = {r["id"]: r["note"] for r in spark.table(view).collect()}
    assert spark.table(view).count() == 601 and {i for i, n in after.items() if n != "a"} == {150, 199, 450, 1000}
    assert len(before & visible_files(spark, view)) == 4
    only_new = change.where("id = 1000").withColumn("id", F.lit(-5).cast("long"))
    assert runs.merge_run(spark, only_new, view, ["id"], RUN_3) == 0
    assert spark.table(view).count() == 602
    with pytest.raises(Exception, match="more than one row"):
        runs.merge_run(spark, change.union(change), view, ["id"], RUN_3)
    assert spark.table(view).count() == 602
    wider = change.withColumn("extra", F.lit(1))
    assert runs.merge_run(spark, wider, view, ["id"], RUN_3) >= 1
    assert spark.table(view).where("extra = 1").count() == 4 and spark.table(view).count() == 602


def test_a_promoted_backfill_is_not_copied(spark, load, view, tmp_path):
    load(source(spark, range(5)), RUN_1)
    full = landed(source(spark, range(30), "full"), SPEC, RUN_2)
    root = str(tmp_path / "raw")
    with pytest.raises(CheckFailed):
        runs.promote_run(spark, full.where("id < 9"), SPEC, table_counts({"t": full}), RUN_2, root, view)
    assert len(notes(spark, view)) == 5
    with pytest.raises(ValueError, match="no source count"):
        runs.promote_run(spark, full, SPEC, table_counts({"u": full}), RUN_2, root, view)
    before = files_of(tmp_path / "raw")
    runs.promote_run(spark, full, SPEC, table_counts({"t": full}), RUN_2, root, view)
    assert notes(spark, view) == [(i, "full") for i in range(30)]
    # the files of the load that failed the check are replaced, those of older loads stay
    kept = {f for f in before if f.startswith("_load=1/")}
    assert kept <= files_of(tmp_path / "raw") and visible_files(spark, view) == files_of(tmp_path / "raw") - kept
    load(source(spark, [99], "later"), RUN_3)
    assert len(notes(spark, view)) == 31


def test_counts_read_no_columns(spark, load, view):
    load(source(spark, range(50)), RUN_1)
    counts = table_counts({"t": spark.table(view)})
    assert [r["num_rows"] for r in counts.collect()] == [50]
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_types_are_widened(spark, load, view, tmp_path):
    load(source(spark, range(5)), RUN_1)
    load(source(spark, [1, 7], "b"), RUN_2)
    runs.load_run_day(spark, source(spark, [100], day=2), SPEC, RUN_2, view, date(2024, 1, 2))
    before = notes(spark, view)
    found = spark.createDataFrame([("t", "id", "numeric"), ("t", "created_at", "date"), ("t", "note", "void"), ("t", "extra", "boolean")], "table_name string, column_name string, data_type string")
    drift = guards.type_drift(guards.contract_columns(spark, [SPEC]), found)
    assert {r["column_name"]: r["decision"] for r in drift.collect()} == {"id": "widen", "created_at": "keep", "note": "keep", "doc": "missing", "extra": "add"}
    grown = guards.grown_contract(SPEC, drift)
    assert grown.declared["id"] == "numeric" and grown.column_names[-1] == "extra"
    wide = source(spark, [5]).withColumns({"id": F.lit("12.5").cast("decimal(38,9)"), "extra": F.lit(True)})
    with pytest.raises(ValueError, match="id was bigint and is decimal"):
        load(wide, RUN_3, grown)
    ledger.widen(spark, view, {"id": grown.spark_schema()["id"].dataType.simpleString()})
    assert [(int(i), n) for i, n in notes(spark, view)] == before
    load(wide, RUN_3, grown)
    assert [float(i) for i, _ in notes(spark, view)] == sorted([i for i, _ in before] + [12.5])
    # both loads of the second run are replaced; the day it read again keeps what it had hidden
    again = source(spark, [2]).withColumns({"id": F.col("id").cast("decimal(38,9)"), "extra": F.lit(None).cast("boolean")})
    load(again, RUN_2, grown)
    assert [float(i) for i, _ in notes(spark, view)] == [0, 2, 2, 3, 4, 12.5]
    refused = found.withColumn("data_type", F.when(F.col("column_name") == "id", "boolean").otherwise(F.col("data_type")))
    with pytest.raises(CheckFailed, match="id"):
        guards.grown_contract(SPEC, guards.type_drift(guards.contract_columns(spark, [SPEC]), refused))


def test_copies_move_no_rows(spark, load, view, tmp_path):
    load(source(spark, range(5)), RUN_1)
    before = files_of(tmp_path / "raw")
    ledger.copy_table(spark, view, view + "_copy")
    assert files_of(tmp_path / "raw") == before
    load(source(spark, [9]), RUN_2)
    assert spark.table(view).count() == 6 and spark.table(view + "_copy").count() == 5
    with pytest.raises(ValueError, match="takes no loads"):
        runs.load_run(spark, source(spark, [1]), SPEC, RUN_3, str(tmp_path / "raw"), view + "_copy")
    with pytest.raises(ValueError, match="no table"):
        ledger.copy_table(spark, view + "_x", view + "_y")
    spark.range(3).write.saveAsTable(view + "_plain")
    with pytest.raises(ValueError, match="no table with a ledger"):
        ledger.copy_table(spark, view + "_plain", view + "_y")
    spark.sql(f"drop table {view}_plain")

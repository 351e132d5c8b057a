import random
import re
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeferry.operators import chunks, guards
from lakeferry.operators.derived import (
    TASK_COLUMNS,
    coverage_report,
    freshness,
    freshness_results,
    lifecycle,
    long_running_tasks,
    task_metadata,
)
from lakeferry.operators.features import FEATURE_SETS, OUTCOMES, risk_dataset
from lakeferry.operators.latest import latest_per_key
from lakeferry.operators.merge import apply_diff, delete_insert, table_diff, unique_rows, upsert
from lakeferry.spec import parse_specs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def versions(spark):
    """A third of all rows have the same key, and many of those share its newest version."""
    r = random.Random(7)
    data = [(1, 5 if i % 2 else i % 5, i) for i in range(1000)]
    data += [(r.randint(2, 300), r.randint(0, 9), i) for i in range(1000, 3000)]
    data += [(None, 9, 3000), (7, None, 3001)]
    return spark.createDataFrame(data, "id int, v int, n int").repartition(7), data


def test_latest_keeps_ties(spark):
    df, data = versions(spark)
    newest = {}
    for k, v, _ in data:
        if k is not None and v is not None:
            newest[k] = max(newest.get(k, v), v)
    want = sorted([d for d in data if d[0] is not None and d[1] is not None and newest[d[0]] == d[1]], key=str)
    got = latest_per_key(df, ["id"], "v")
    assert rows(got) == want
    assert got.columns == df.columns
    assert rows(latest_per_key(got, ["id"], "v")) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = plan(latest_per_key(df, ["id"], "v"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # rows are spread by key and version, so a hot key does not gather in one task
    assert "partial_max(v" in shown and "Window" not in shown
    assert re.search(r"hashpartitioning\(id#\d+, v#\d+", shown)


def test_latest_one_row_per_key(spark):
    df, data = versions(spark)
    want = {}
    for k, v, n in data:
        if k is not None and v is not None:
            want[k] = max(want.get(k, (v, n)), (v, n))
    got = latest_per_key(df, ["id"], "v", "one", [F.desc("n")])
    assert rows(got) == sorted([(k, v, n) for k, (v, n) in want.items()], key=str)
    # every map task forwards at most one row of a key
    assert "row_number(), 1, Partial" in plan(got)
    with pytest.raises(ValueError):
        latest_per_key(df, ["id"], "v", "some")


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    once = upsert(target, source, ["k"])
    assert rows(once) == sorted([(1, "a"), (2, None), (3, "c"), (None, "n")], key=str)
    assert rows(upsert(once, source, ["k"])) == rows(once)
    with pytest.raises(Exception, match="more than one row for key"):
        upsert(target, source.union(source), ["k"]).collect()


def test_unique_rows_keeps_values(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 5, None)], "k int, a int, b string")
    assert rows(unique_rows(df, ["k"])) == rows(df)


def test_delete_insert_keeps_rows_without_a_value(spark):
    df = spark.createDataFrame([(1, "d"), (2, None)], "k int, day string")
    new = spark.createDataFrame([(9, "d")], "k int, day string")
    assert rows(delete_insert(df, new, F.col("day") == "d")) == [(2, None), (9, "d")]


@pytest.mark.parametrize("seed", range(4))
def test_diff_applied_gives_the_new_table(spark, seed):
    r = random.Random(seed)

    def state():
        return [(k, r.choice([None, 1, 2]), r.choice([None, "x", "y"])) for k in r.sample(range(40), 25)]

    schema = "k int, a int, b string"
    old_rows, new_rows = state(), state()
    old, new = spark.createDataFrame(old_rows, schema), spark.createDataFrame(new_rows, schema)
    diff = table_diff(old, new, ["k"])
    o, n = {x[0]: x for x in old_rows}, {x[0]: x for x in new_rows}
    want = (
        [("insert", *n[k]) for k in n.keys() - o.keys()]
        + [("delete", *o[k]) for k in o.keys() - n.keys()]
        + [("update", *n[k]) for k in n.keys() & o.keys() if o[k] != n[k]]
    )
    assert rows(diff) == sorted(want, key=str)
    assert rows(apply_diff(old, diff, ["k"])) == sorted(new_rows, key=str)
    assert table_diff(new, new, ["k"]).count() == 0


def test_diff_refuses_copies_of_a_key(spark):
    df = spark.createDataFrame([(1, 1)] * 50 + [(2, 2)], "k int, v int")
    with pytest.raises(Exception, match="occurs twice"):
        table_diff(df, df.limit(0), ["k"]).collect()


@pytest.mark.parametrize("lower, upper, size, most", [(0, 99, 10, None), (0, 99, 10, 100), (5, 5, 10, 100), (-7, 31, 4, 3), (0, 10, 11, 9)])
def test_range_chunks_cover_every_row_once(spark, lower, upper, size, most):
    values = [*range(lower - 3, upper + 4), None]
    df = spark.createDataFrame([(v,) for v in values], "id int")
    predicates = chunks.range_predicates("id", lower, upper, size, most)
    assert most is None or len(predicates) <= most
    got = df.select("id", *[F.expr(p).alias(f"p{i}") for i, p in enumerate(predicates)])
    step = max(size, -(-(upper - lower + 1) // most) if most else 1)
    for row in got.collect():
        at = 0 if row["id"] is None else min(max((row["id"] - lower) // step, 0), len(predicates) - 1)
        assert [i for i, hit in enumerate(row[1:]) if hit] == [at]


@pytest.mark.parametrize("most", [None, 100, 3])
def test_day_chunks_cover_every_row_once(spark, most):
    first, last = date(2024, 2, 27), date(2024, 3, 5)
    times = [datetime(2024, 2, d, h) for d in range(25, 30) for h in (0, 23)]
    times += [datetime(2024, 3, d, h) for d in range(1, 8) for h in (0, 23)] + [None]
    df = spark.createDataFrame([(t,) for t in times], "at timestamp_ntz")
    predicates = chunks.day_predicates("at", first, last, most)
    got = df.select("at", *[F.expr(p).alias(f"p{i}") for i, p in enumerate(predicates)])
    width = 3 if most == 3 else 1
    for row in got.collect():
        offset = -1 if row["at"] is None else (row["at"].date() - first).days
        at = offset // width if 0 <= offset <= (last - first).days else len(predicates) - 1
        assert [i for i, hit in enumerate(row[1:]) if hit] == [at]
    assert len(chunks.day_predicates("at", first, last, most, other_days=False)) == len(predicates) - 1
    with pytest.raises(ValueError):
        chunks.day_predicates("at", last, first)


def test_row_counts(spark):
    schema = "table_name string, num_rows long"
    source = spark.createDataFrame([("a", 1000), ("b", 1000), ("c", 10), ("d", 0)], schema)
    loaded = spark.createDataFrame([("a", 999), ("b", 998), ("d", 5)], schema)
    check = guards.row_count_check(source, loaded)
    assert {r["table_name"]: r["passed"] for r in check.collect()} == {"a": True, "b": False, "c": False, "d": True}
    with pytest.raises(guards.CheckFailed, match="'b'"):
        guards.require_passed(check)
    guards.require_passed(check.filter("passed"))
    guards.value_check(source.filter("num_rows < 0").agg(F.count("*")), 0)
    with pytest.raises(guards.CheckFailed):
        guards.value_check(source.agg(F.count("*")), 0)


def test_schema_drift(spark):
    specs = parse_specs(
        {
            "users": {"schema": {"id": "integer", '"order"': "text", "gone": "text"}},
            "pay.outs": {"schema": {"id": "uuid"}},
            "absent": {"schema": {"id": "uuid"}},
        }
    )
    live = [("users", "id", "bigint"), ("users", "order", "text"), ("users", "more", "text"), ("outs", "id", "uuid")]
    catalog = spark.createDataFrame(live, "table_name string, column_name string, data_type string")
    contract = guards.contract_columns(spark, specs.values())
    drift = guards.schema_drift(contract, catalog)
    assert rows(drift.select("table_name", "column_name", "status")) == [
        ("absent", "id", "missing"), ("users", "gone", "missing"), ("users", "id", "type_changed"), ("users", "more", "extra"),
    ]
    assert [s.name for s in guards.tables_to_load(specs.values(), drift, "skip")] == ["outs"]
    assert len(guards.tables_to_load(specs.values(), drift)) == 3
    with pytest.raises(guards.CheckFailed, match="absent, users"):
        guards.tables_to_load(specs.values(), drift, "fail")
    summary = {r["table_name"]: (r["drifted_columns"], r["extract"]) for r in guards.drift_summary(contract, drift).collect()}
    assert summary == {"users": ("gone, id, more", False), "outs": (None, True), "absent": ("id", False)}
    assert rows(guards.column_listing(catalog))[0] == ("outs", "id:uuid")


def test_schema_columns(spark):
    found = guards.schema_columns(spark, {"t": spark.range(1)})
    assert rows(found) == [("t", "id", "bigint")]


def test_lifecycle(spark):
    log = [("w1", "CREATED", 1), ("w1", "CREATED", 3), ("w1", "DELETED", 5), ("w1", "DELETED", 4), ("w2", "CREATED", 2)]
    df = spark.createDataFrame(log, "w string, action string, at int")
    assert rows(lifecycle(df, ["w"], "action", "at")) == [("w1", 1, 5), ("w2", 2, None)]


def test_coverage(spark):
    tests = spark.createDataFrame([("core.a", 2), ("core.b", 0), ("other.c", 9)], "name string, covered long")
    docs = spark.createDataFrame([("core.a", 1, 4), ("dim.z", 5, 5)], "name string, covered long, total long")
    day = date(2024, 1, 1)
    assert rows(coverage_report(tests, docs, day)) == sorted(
        [(day, "all", "all", 2, 1, 4), (day, "core", "a", 2, 1, 4), (day, "core", "b", 0, None, None)], key=str
    )


def test_freshness_of_tables(spark):
    now = datetime(2024, 7, 1, 12)
    zoned = spark.sql("select timestamp'2024-07-01 11:00:00Z' as at union all select null")
    plain = spark.sql("select timestamp_ntz'2024-06-30 12:00:00' as at, 1 as n union all select timestamp_ntz'2024-07-01 12:00:00', 2")
    tables = {"a.zoned": (zoned, "at"), "a.plain": (plain, "at"), "b.empty": (zoned.filter("at is null"), "at"), "b.days": (spark.sql("select date'2024-06-01' as at"), "at")}
    got = freshness(tables, now, 7200, 86_400, conditions={"a.plain": "n = 1"})
    assert rows(got.select("model_name", "status", "max_timestamp_time_ago_in_s", "filter_condition")) == [
        ("days", "error", 30.5 * 86_400, None),
        ("empty", "runtime error", None, None),
        ("plain", "warn", 86_400.0, "n = 1"),
        ("zoned", "pass", 3600.0, None),
    ]
    assert got.first()["execution_date"] == date(2024, 7, 1)


def test_freshness_results(spark):
    from lakeferry.sources.files import FRESHNESS_ARTIFACT

    text = '{"results":[{"unique_id":"source.p.set.model","status":"pass","max_loaded_at":"2024","max_loaded_at_time_ago_in_s":1.5,"criteria":{"filter":null}}]}'
    artifact = spark.createDataFrame([(text,)], "t string").select(F.from_json("t", FRESHNESS_ARTIFACT).alias("a")).select("a.*")
    assert rows(freshness_results(artifact, date(2024, 1, 1))) == [
        (date(2024, 1, 1), "set", "model", "pass", "2024", 1.5, None)
    ]


def tasks(spark, data):
    schema = ", ".join(
        f"{c} {'timestamp' if c in ('start_date', 'end_date') else 'double' if c == 'duration' else 'string'}" for c in TASK_COLUMNS
    )
    return spark.createDataFrame([tuple(d.get(c) for c in TASK_COLUMNS) for d in data], schema)


def test_tasks(spark):
    day = datetime(2024, 5, 2, 12)
    base = {"task_id": "t", "dag_id": "d", "start_date": day, "duration": 301 * 60.0}
    df = tasks(
        spark,
        [
            base, {**base, "task_id": "slow"}, {**base, "task_id": "slow", "duration": 601 * 60.0},
            {**base, "dag_id": "watch"}, {**base, "start_date": datetime(2024, 5, 1)}, {**base, "duration": 300 * 60.0},
        ],
    )
    assert long_running_tasks(df, date(2024, 5, 2), "watch", 300, {"slow": 600}).first()[0] == 2
    shown = task_metadata(df, "watch")
    assert shown.count() == 5 and shown.columns == TASK_COLUMNS
    assert shown.first()["start_date"] == "2024-05-02 12:00:00.000000" and shown.first()["end_date"] is None


def test_risk_dataset_rows(spark):
    lookups = spark.sql(
        """
        select s as submission_id, 1 as customer_id, loan_ids,
               named_struct('timestamp', 't', 'lookup_id', 1, 'submission_id', s, 'loans', s) as internal_lookup_features,
               case when s <> 4 then named_struct('lookup_id', nullif(s, 3), 'timestamp', 't', 'uc', s) end as uc_features,
               named_struct('lookup_id', 1, 'timestamp', 't', 'submission_id', s, 'external_lookup_id', 2, 'room', s) as capacity
        from values (1, array(7)), (2, array()), (3, array(7)), (4, array(7)), (5, null), (6, array(7, 8)) as t(s, loan_ids)
        """
    )
    facts = spark.createDataFrame([(1, 1, *[0.5] * 9), (2, 1, *[0.5] * 9), (6, 2, *[0.5] * 9)],
                                  "submission_id int, customer_id int, " + ", ".join(f"{c} double" for c in OUTCOMES))
    got = risk_dataset(lookups, facts, FEATURE_SETS["se"])
    assert got.columns == ["submission_id", "customer_id", "loans", "uc", "room", *OUTCOMES]
    assert rows(got.select("submission_id", "loans", "uc", "room", "dpoint_fpd")) == [(1, 1, 1, 1, 0.5), (6, 6, 6, 6, None)]


SKEW_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def skew_settings(spark):
    for k, v in SKEW_SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k in SKEW_SETTINGS:
        spark.conf.unset(k)


def hot(spark, n=120_000):
    """A third of all rows share one key and its newest version."""
    key = F.when(F.col("n") % 3 == 0, 1).otherwise(F.col("n") % 997 + 2)
    version = F.when(F.col("n") % 3 == 0, 9).otherwise(F.col("n") % 5)
    return spark.range(n).toDF("n").repartition(6).select(key.alias("id"), version.alias("v"), "n", F.sha2(F.col("n").cast("string"), 256).alias("t"))


def final_plan(df):
    df.collect()
    return plan(df)


def test_hot_ties_are_split_over_tasks(spark, skew_settings):
    got = latest_per_key(hot(spark), ["id"], "v")
    assert "skew=true" in final_plan(got)
    want = hot(spark).filter("v = 9 or id <> 1").groupBy("id").agg(F.max("v").alias("m"))
    assert got.filter("id = 1").count() == 40_000
    assert got.count() == hot(spark).join(want, "id").filter("v = m").count()


def test_hot_customer_is_split_over_tasks(spark, skew_settings):
    from lakeferry.plans.subject_report import requested

    requests = spark.range(1, 500).toDF("customer_id").repartition(3)
    got = requested(hot(spark), requests, "id")
    assert "skew=true" in final_plan(got)
    assert got.filter("id = 1").count() == 40_000


def test_hot_target_key_of_an_upsert(spark, skew_settings):
    source = spark.range(2, 401).repartition(3).select("id", F.lit(0).cast("long").alias("v"), F.col("id").alias("n"), F.lit("t").alias("t"))
    got = upsert(hot(spark), source, ["id"])
    assert "skew=true" in final_plan(got)
    assert got.filter("id = 1").count() == 40_000 and got.filter("id = 5").count() == 1
    assert got.columns == ["id", "v", "n", "t"]

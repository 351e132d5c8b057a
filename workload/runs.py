"""Tables with a ledger: repeated runs, refreshed clean tables, merges into files, balanced chunks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lakeferry.operators.chunks import balanced_predicates, chunk_numbers, chunk_starts
from lakeferry.plans.runs import load_run, load_run_day, merge_run, refresh_clean, versions
from lakeferry.sinks.ledger import copy_table
from lakeferry.sinks.storage import shared_path
from lakeferry.spec import TableSpec
from workload.common import new_view, plain_times, registry, table

QUERIES, ORACLES, register = registry()

RUN_1, RUN_2, RUN_3, RUN_4 = (f"2024-02-0{n} 03:00:00" for n in range(1, 5))
TRACKED = TableSpec.from_contract(
    "tracking.events",
    {
        "schema": {
            "id": "bigint",
            "created_at": "timestamp without time zone",
            "user_id": "bigint",
            "kind": "text",
            "value": "real",
        },
        "ts_column": "created_at",
        "bq_partition_column": "created_at",
    },
)
ORDERS = TableSpec.from_contract(
    "orders",
    {
        "schema": {"id": "bigint", "customer_id": "bigint", "status": "text", "total": "real"},
        "ts_column": "id",
    },
)


def _tracked(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("ts").alias("created_at"), "user_id", F.col("event_type").alias("kind"), "value"
    )


@register(
    """
    SELECT event_id AS id, ts AS created_at, user_id, event_type AS kind,
           CASE WHEN ts >= TIMESTAMP '2024-01-15' AND event_id % 3 = 0 THEN value * 2 ELSE value END AS value,
           CASE WHEN ts >= TIMESTAMP '2024-01-15' AND event_id % 3 = 0 THEN TIMESTAMP '2024-02-02 03:00:00'
                ELSE TIMESTAMP '2024-02-01 03:00:00' END AS _ingested_ts
    FROM events WHERE ts < TIMESTAMP '2024-01-20' OR event_id % 3 = 0
    """
)
def rerun_changed(spark, sf_dir):
    """A run that is repeated after its source changed: values, and fewer rows than at first."""
    root, view = shared_path(spark, "rerun_changed"), new_view("events_raw")
    events = _tracked(spark, sf_dir)
    late = events.filter("created_at >= timestamp_ntz'2024-01-15'")
    load_run(spark, events.filter("created_at < timestamp_ntz'2024-01-20'"), TRACKED, RUN_1, root, view)
    load_run(spark, late.withColumn("value", F.col("value") + 1), TRACKED, RUN_2, root, view)
    load_run(spark, late.filter("id % 3 = 0").withColumn("value", F.col("value") * 2), TRACKED, RUN_2, root, view)
    return plain_times(versions(spark.table(view), TRACKED))


@register(
    """
    WITH raw AS (
      SELECT event_id AS id, ts AS created_at, user_id, event_type AS kind, value, TIMESTAMP '2024-02-01 03:00:00' AS _ingested_ts
      FROM events WHERE event_id % 10 <> 0 AND CAST(ts AS DATE) <> DATE '2024-01-05'
      UNION ALL
      SELECT event_id, ts, user_id, event_type, value * 3, TIMESTAMP '2024-02-02 03:00:00'
      FROM events WHERE event_id % 10 = 0 AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11'
      UNION ALL
      SELECT event_id, ts + INTERVAL 1 DAY, user_id, event_type, value + 1, TIMESTAMP '2024-02-03 03:00:00'
      FROM events WHERE event_id % 7 = 0 AND CAST(ts AS DATE) = DATE '2024-01-20'
      UNION ALL
      SELECT event_id, ts, user_id, event_type, -value, TIMESTAMP '2024-02-04 03:00:00'
      FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05'
    )
    SELECT r.* FROM raw r JOIN (SELECT id, max(_ingested_ts) AS m FROM raw GROUP BY 1) n ON r.id = n.id AND r._ingested_ts = n.m
    """
)
def clean_refresh(spark, sf_dir):
    """A clean table brought up to date after every load: new rows, rows that move to another day, a repeated run that
    lost rows, and a raw day that is read again."""
    root, raw, clean = shared_path(spark, "clean_refresh"), new_view("tracked_raw"), new_view("tracked")
    events = _tracked(spark, sf_dir)
    day = F.to_date("created_at")
    moved = events.filter((day == "2024-01-20") & (F.col("id") % 7 == 0)).withColumns(
        {"created_at": F.col("created_at") + F.expr("interval 1 day"), "value": F.col("value") + 1}
    )
    tenth = events.filter((day == "2024-01-10") & (F.col("id") % 10 == 0)).withColumn("value", F.col("value") * 3)
    steps = [
        (events.filter("id % 10 <> 0"), RUN_1),
        (tenth.union(events.filter("id % 1000 = 1")), RUN_2),
        (moved, RUN_3),
        (tenth, RUN_2),
    ]
    for rows, run in steps:
        load_run(spark, rows, TRACKED, run, f"{root}/raw", raw)
        refresh_clean(spark, raw, TRACKED, f"{root}/clean", clean)
    again = events.filter(day == "2024-01-05").withColumn("value", -F.col("value"))
    load_run_day(spark, again, TRACKED, RUN_4, raw, date(2024, 1, 5))
    refresh_clean(spark, raw, TRACKED, f"{root}/clean", clean)
    return plain_times(spark.table(clean))


@register(
    """
    SELECT o_orderkey AS id, o_custkey AS customer_id, CASE WHEN o_orderkey % 5000 < 3 THEN 'X' ELSE o_orderstatus END AS status,
           o_totalprice AS total,
           CASE WHEN o_orderkey % 5000 < 3 THEN TIMESTAMP '2024-02-02 03:00:00' ELSE TIMESTAMP '2024-02-01 03:00:00' END AS _ingested_ts
    FROM orders
    UNION ALL
    SELECT -o_orderkey, o_custkey, 'N', o_totalprice, TIMESTAMP '2024-02-02 03:00:00' FROM orders WHERE o_orderkey % 5000 = 7
    """
)
def merge_files(spark, sf_dir):
    """A few changed and new rows merged into a table whose other files stay as they are; a copy keeps the state before."""
    root, view = shared_path(spark, "merge_files"), new_view("orders")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
    )
    load_run(spark, orders.repartitionByRange("id"), ORDERS, RUN_1, root, view)
    copy_table(spark, view, f"{view}_before")
    at = F.lit(RUN_2).cast("timestamp")
    changed = orders.filter("id % 5000 < 3").withColumns({"status": F.lit("X"), "_ingested_ts": at})
    new = orders.filter("id % 5000 = 7").withColumns({"id": -F.col("id"), "status": F.lit("N"), "_ingested_ts": at})
    merge_run(spark, changed.union(new), view, ["id"], RUN_2)
    return plain_times(spark.table(view))


@register(
    """
    SELECT place // 1000 AS chunk, count(*) AS num_rows, min(k) AS lowest, max(k) AS highest
    FROM (SELECT CAST(o_orderkey AS BIGINT) * o_orderkey * o_orderkey AS k,
                 row_number() OVER (ORDER BY CAST(o_orderkey AS BIGINT) * o_orderkey * o_orderkey) - 1 AS place FROM orders)
    GROUP BY 1
    """
)
def chunked_balanced(spark, sf_dir):
    """Rows per predicate of a backfill over sparse keys that lie denser and denser: every chunk has the same number.

    The keys are cubes: bigint as long as all of them fit, else decimal(38,0).
    """
    orders = table(spark, sf_dir, "orders")
    largest = max((abs(x) for x in orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first() if x is not None), default=0)
    root = F.col("o_orderkey").cast("bigint" if largest**3 < 1 << 63 else "decimal(19,0)")
    keys = orders.select((root * root * root).alias("k"))
    starts = chunk_starts(keys, ["k"], 1000).toLocalIterator()
    chunks = chunk_numbers(keys, "k", balanced_predicates(["k"], starts))
    return chunks.groupBy("chunk").agg(F.count("*").alias("num_rows"), F.min("k").alias("lowest"), F.max("k").alias("highest"))

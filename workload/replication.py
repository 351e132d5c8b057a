"""Replication: scans, chunks, day reloads, raw to clean."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from lakeferry.functions.normalize import export_text, normalize_rows
from lakeferry.operators.chunks import chunk_numbers, day_predicates, range_predicates
from lakeferry.operators.derived import TASK_COLUMNS, task_metadata
from lakeferry.operators.guards import table_counts
from lakeferry.operators.latest import latest_per_key
from lakeferry.plans.backfill import promote
from lakeferry.plans.replicate import build_clean, landed, load_raw, load_raw_day, refined
from lakeferry.sinks.storage import shared_path
from lakeferry.sinks.tables import DAY
from lakeferry.spec import TableSpec
from workload.common import new_view, plain_times, registry, table

QUERIES, ORACLES, register = registry()

EVENTS = TableSpec.from_contract(
    "events",
    {
        "schema": {
            "event_id": "bigint",
            "ts": "timestamp without time zone",
            "user_id": "bigint",
            "event_type": "text",
            "value": "real",
            "props": "jsonb",
        },
        "ts_column": "ts",
        "bq_partition_column": "ts",
        "query_by": "timestamp",
    },
)
CUSTOMERS = TableSpec.from_contract(
    "customer",
    {
        "schema": {
            "c_custkey": "bigint",
            "c_name": "character varying",
            "c_nationkey": "integer",
            "c_acctbal": "real",
            "c_mktsegment": "text",
        }
    },
)
RUN_1, RUN_2 = "2024-02-01 03:00:00", "2024-02-02 03:00:00"


@register(
    """
    SELECT event_id, ts, user_id, event_type, value, props, TIMESTAMP '2024-02-01 03:00:00' AS _ingested_ts
    FROM events WHERE ts >= TIMESTAMP '2024-01-15'
    """
)
def incremental_events(spark, sf_dir):
    """Rows since a watermark, in landed types with the run timestamp."""
    changed = table(spark, sf_dir, "events").filter("ts >= timestamp_ntz'2024-01-15'")
    return plain_times(landed(changed, EVENTS, RUN_1))


@register(
    "SELECT *, TIMESTAMP '2024-02-01 03:00:00' AS _ingested_ts FROM customer"
)
def full_reload(spark, sf_dir):
    """A table without a timestamp column is read in full and replaces its raw table."""
    path = shared_path(spark, "full_reload")
    source = table(spark, sf_dir, "customer")
    view = new_view("customer_raw")
    load_raw(spark, source, CUSTOMERS, RUN_1, path, view)
    load_raw(spark, source, CUSTOMERS, RUN_1, path, view)
    return plain_times(spark.table(view)).withColumn("c_nationkey", F.col("c_nationkey").cast("int"))


@register(
    """
    SELECT event_id, ts, user_id, event_type,
           CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN value * 2 ELSE value END AS value, props,
           CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN TIMESTAMP '2024-02-02 03:00:00'
                ELSE TIMESTAMP '2024-02-01 03:00:00' END AS _ingested_ts
    FROM events
    """
)
def day_reload(spark, sf_dir):
    """One day of a raw table is read again (half-open day range) and replaced, twice."""
    path = shared_path(spark, "day_reload")
    events = table(spark, sf_dir, "events")
    view = new_view("events_raw")
    load_raw(spark, events, EVENTS, RUN_1, path, view)
    day = events.filter("ts >= timestamp_ntz'2024-01-10' and ts < timestamp_ntz'2024-01-11'")
    for _ in range(2):
        again = day.withColumn("value", F.col("value") * 2)
        load_raw_day(spark, again, EVENTS, RUN_2, view, "ts", date(2024, 1, 10))
    return plain_times(spark.table(view).drop(DAY))


@register(
    """
    SELECT event_id, ts, user_id, event_type,
           CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN value * 2 ELSE value END AS value, props,
           CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' OR ts >= TIMESTAMP '2024-01-20'
                THEN TIMESTAMP '2024-02-02 03:00:00' ELSE TIMESTAMP '2024-02-01 03:00:00' END AS _ingested_ts
    FROM events
    """
)
def promote_then_append(spark, sf_dir):
    """A promoted backfill to which later days are appended and in which one day is read again."""
    path = shared_path(spark, "promote_then_append")
    events = table(spark, sf_dir, "events")
    view = new_view("events_raw")
    early = events.filter("ts < timestamp_ntz'2024-01-20'")
    promote(spark, landed(early, EVENTS, RUN_1), EVENTS, table_counts({"events": early}), path, view)
    load_raw(spark, events.filter("ts >= timestamp_ntz'2024-01-20'"), EVENTS, RUN_2, path, view)
    day = events.filter("ts >= timestamp_ntz'2024-01-10' and ts < timestamp_ntz'2024-01-11'")
    load_raw_day(spark, day.withColumn("value", F.col("value") * 2), EVENTS, RUN_2, view, "ts", date(2024, 1, 10))
    return plain_times(spark.table(view))


@register(
    """
    SELECT event_id, ts, user_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN value + 1 ELSE value END AS value,
           props, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN TIMESTAMP '2024-02-02 03:00:00'
                       ELSE TIMESTAMP '2024-02-01 03:00:00' END AS _ingested_ts
    FROM events
    """
)
def rerun_same_run(spark, sf_dir):
    """Overlapping runs, each of them loaded twice: every row has one current version."""
    path = shared_path(spark, "rerun_same_run")
    events = table(spark, sf_dir, "events")
    spec = TableSpec(**{**EVENTS.__dict__, "key": "event_id"})
    view = new_view("events_raw")
    early = events.filter("ts < timestamp_ntz'2024-01-20'")
    late = events.filter("ts >= timestamp_ntz'2024-01-15'").withColumn("value", F.col("value") + 1)
    for rows, run in ((early, RUN_1), (early, RUN_1), (late, RUN_2), (late, RUN_2)):
        load_raw(spark, rows, spec, run, path, view)
    return plain_times(refined(spark.table(view), spec))


@register(
    """
    SELECT event_id, ts, user_id, event_type, value, CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN props END AS props,
           CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN TIMESTAMP '2024-02-02 03:00:00'
                ELSE TIMESTAMP '2024-02-01 03:00:00' END AS _ingested_ts
    FROM events
    """
)
def contract_growth(spark, sf_dir):
    """A column that joins the contract later is shown, null in the rows loaded before."""
    path = shared_path(spark, "contract_growth")
    events = table(spark, sf_dir, "events")
    columns = tuple(c for c in EVENTS.columns if c[0] != "props")
    narrow = TableSpec(**{**EVENTS.__dict__, "columns": columns})
    view = new_view("events_raw")
    load_raw(spark, events.filter("ts < timestamp_ntz'2024-01-15'"), narrow, RUN_1, path, view)
    load_raw(spark, events.filter("ts >= timestamp_ntz'2024-01-15'"), EVENTS, RUN_2, path, view)
    return plain_times(spark.table(view))


def _chunk(predicates):
    """Number of the predicate that a row meets; the predicates are those of the reader."""
    hits = [F.when(F.expr(p), F.lit(i).cast("bigint")) for i, p in enumerate(predicates)]
    return F.coalesce(*hits)


@register(
    """
    SELECT CASE WHEN ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-23'
                THEN date_diff('day', DATE '2024-01-03', CAST(ts AS DATE)) ELSE 20 END AS chunk,
           count(*) AS num_rows
    FROM events GROUP BY 1
    """
)
def chunked_by_day(spark, sf_dir):
    """Rows per day predicate of a backfill; the last one takes all other days."""
    chunk = _chunk(day_predicates("ts", date(2024, 1, 3), date(2024, 1, 22)))
    return table(spark, sf_dir, "events").groupBy(chunk.alias("chunk")).agg(F.count("*").alias("num_rows"))


@register(
    """
    SELECT CAST(floor((o_orderkey - lo) / 1000.0) AS BIGINT) AS chunk, count(*) AS num_rows
    FROM orders, (SELECT min(o_orderkey) AS lo FROM orders) GROUP BY 1
    """
)
def chunked_by_range(spark, sf_dir):
    """Rows per key-range predicate of a backfill, with bounds from one aggregate row."""
    orders = table(spark, sf_dir, "orders")
    lo, hi = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    chunks = chunk_numbers(orders.select("o_orderkey"), "o_orderkey", range_predicates("o_orderkey", lo, hi, 1000))
    return chunks.groupBy("chunk").agg(F.count("*").alias("num_rows"))


@register(
    """
    SELECT e.* FROM events e
    JOIN (SELECT user_id, max(ts) AS max_ts FROM events GROUP BY 1) m ON e.user_id = m.user_id AND e.ts = m.max_ts
    """
)
def dedup_latest(spark, sf_dir):
    """Newest row per key, ties kept."""
    return latest_per_key(table(spark, sf_dir, "events"), ["user_id"], "ts")


@register(
    """
    SELECT l.* FROM lineitem l
    JOIN (SELECT l_suppkey, max(l_shipdate) AS d FROM lineitem GROUP BY 1) m
      ON l.l_suppkey = m.l_suppkey AND l.l_shipdate = m.d
    """
)
def dedup_latest_ties(spark, sf_dir):
    """Newest rows per supplier where many rows share the newest day."""
    return latest_per_key(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_shipdate")


@register(
    """
    SELECT event_id, ts, user_id, event_type, value, props FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
    ) WHERE rn = 1
    """
)
def dedup_latest_one(spark, sf_dir):
    """Exactly one newest row per key."""
    return latest_per_key(table(spark, sf_dir, "events"), ["user_id"], "ts", "one", [F.desc("event_id")])


@register(
    """
    WITH raw AS (
      SELECT event_id, ts, user_id, event_type, value, props, TIMESTAMP '2024-02-01 03:00:00' AS _ingested_ts
      FROM events WHERE ts < TIMESTAMP '2024-01-20'
      UNION ALL
      SELECT event_id, ts, user_id, event_type, value + 1, props, TIMESTAMP '2024-02-02 03:00:00'
      FROM events WHERE ts >= TIMESTAMP '2024-01-15'
    )
    SELECT r.* FROM raw r JOIN (SELECT event_id, max(_ingested_ts) AS m FROM raw GROUP BY 1) n
      ON r.event_id = n.event_id AND r._ingested_ts = n.m
    """
)
def replicate_events(spark, sf_dir):
    """Two overlapping daily loads appended to raw, then the current version of every row."""
    path = shared_path(spark, "replicate_events")
    events = table(spark, sf_dir, "events")
    spec = TableSpec(**{**EVENTS.__dict__, "key": "event_id"})
    view = new_view("events_raw")
    load_raw(spark, events.filter("ts < timestamp_ntz'2024-01-20'"), spec, RUN_1, path, view)
    late = events.filter("ts >= timestamp_ntz'2024-01-15'").withColumn("value", F.col("value") + 1)
    load_raw(spark, late, spec, RUN_2, path, view)
    return plain_times(refined(spark.table(view).drop(DAY), spec))


CLEAN = TableSpec.from_contract(
    "tracking.events",
    {
        "schema": {
            "id": "bigint",
            "created_at": "timestamp without time zone",
            "user_id": "bigint",
            '"order"': "text",
            "value": "numeric",
        },
        "ts_column": "created_at",
        "bq_partition_column": "created_at",
    },
)


@register(
    """
    SELECT event_id AS id, ts AS created_at, user_id, event_type AS "order",
           CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value, TIMESTAMP '2024-02-01 03:00:00' AS _ingested_ts
    FROM events
    """
)
def clean_table(spark, sf_dir):
    """Raw table rebuilt as a clean one: current versions, partitioned by day, clustered by key."""
    path = shared_path(spark, "clean_table")
    source = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").alias("created_at"),
        "user_id",
        F.col("event_type").alias("order"),
        F.col("value").cast("decimal(18,2)").alias("value"),
    )
    raw, clean = new_view("tracked_raw"), new_view("tracked")
    load_raw(spark, source, CLEAN, RUN_1, f"{path}/raw", raw)
    build_clean(spark, spark.table(raw), CLEAN, f"{path}/clean", clean)
    return plain_times(spark.table(clean).drop(DAY)).withColumn("value", F.col("value").cast("double"))


NORMALIZED = TableSpec.from_contract(
    "orders",
    {
        "schema": {
            "id": "bigint",
            "placed": "text",
            "price": "numeric",
            "customer": "jsonb",
            "notes": "jsonb",
            "tags": "ARRAY",
            "raw_status": "text",
        }
    },
)


@register(
    """
    SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS placed,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
           '{"id":' || o_custkey || ',"status":"' || o_orderstatus || '"}' AS customer,
           '[{"priority":"' || o_orderpriority || '"},{"status":"' || o_orderstatus || '"}]' AS notes,
           o_orderstatus || '|' || o_custkey AS tags, o_orderstatus AS raw_status
    FROM orders
    """
)
def normalize_row(spark, sf_dir):
    """Dates to text, objects and lists to JSON text, numbers in arrays to text, bytes to text."""
    source = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.to_date("o_orderdate").alias("placed"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        F.struct(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status")).alias("customer"),
        F.array(
            F.create_map(F.lit("priority"), F.col("o_orderpriority")),
            F.create_map(F.lit("status"), F.col("o_orderstatus")),
        ).alias("notes"),
        F.array(F.col("o_orderstatus"), F.col("o_custkey").cast("string")).alias("tags"),
        F.encode("o_orderstatus", "UTF-8").alias("raw_status"),
    )
    rows = normalize_rows(source, NORMALIZED)
    return rows.withColumns({"tags": F.array_join("tags", "|"), "price": F.col("price").cast("double")})


@register(
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, strftime(ts, '%Y-%m-%d') AS day, value
    FROM events
    """
)
def result_text(spark, sf_dir):
    """Dates and times in the fixed export layouts, other columns as they are."""
    rows = table(spark, sf_dir, "events").select("event_id", "ts", F.to_date("ts").alias("day"), "value")
    return export_text(rows)


@register(
    """
    SELECT 'task ' || o_orderpriority AS task_id, CASE o_orderstatus WHEN 'F' THEN 'nightly' WHEN 'O' THEN 'hourly' END AS dag_id,
           CAST(o_orderkey AS VARCHAR) AS run_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS start_date,
           CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S.%f') END AS end_date,
           o_totalprice AS duration, o_orderstatus AS state, o_custkey AS try_number
    FROM orders WHERE o_orderstatus <> 'P'
    """
)
def job_metadata(spark, sf_dir):
    """Job runs without the monitoring job, start and end as text."""
    tasks = _tasks(table(spark, sf_dir, "orders"))
    wanted = "task_id dag_id run_id start_date end_date duration state try_number".split()
    return task_metadata(tasks, "monitoring").select(*wanted)


def _tasks(orders):
    """Orders in the columns of the job metadata table."""
    known = {
        "task_id": F.concat(F.lit("task "), F.col("o_orderpriority")),
        "dag_id": F.when(F.col("o_orderstatus") == "F", "nightly")
        .when(F.col("o_orderstatus") == "O", "hourly")
        .otherwise("monitoring"),
        "run_id": F.col("o_orderkey").cast("string"),
        "start_date": F.col("o_orderdate"),
        "end_date": F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate") + F.expr("interval 1 day")),
        "duration": F.col("o_totalprice"),
        "state": F.col("o_orderstatus"),
        "try_number": F.col("o_custkey"),
    }
    return orders.select(*[known.get(c, F.lit(None).cast("string")).alias(c) for c in TASK_COLUMNS])

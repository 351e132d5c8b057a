"""Guards and metadata: counts, promotion, drift, coverage, freshness, long tasks."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from lakeferry.operators.derived import (
    coverage_report,
    coverage_tables,
    freshness,
    freshness_results,
    long_running_tasks,
    with_age,
)
from lakeferry.operators.guards import (
    column_listing,
    contract_columns,
    document_columns,
    drift_summary,
    observed_types,
    row_count_check,
    schema_drift,
    table_counts,
    type_drift,
)
from lakeferry.plans.backfill import promote
from lakeferry.sinks.storage import shared_path
from lakeferry.sinks.tables import write_report_csv
from lakeferry.sources.files import COVERAGE_ARTIFACT, FRESHNESS_ARTIFACT
from lakeferry.spec import parse_specs
from workload.common import new_view, registry, table
from workload.replication import CUSTOMERS, _tasks

QUERIES, ORACLES, register = registry()


@register(
    """
    WITH e AS (
      SELECT 'orders' AS table_name, count(*) AS expected_rows FROM orders
      UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'customer', count(*) FROM customer
      UNION ALL SELECT 'part', count(*) FROM part
    ), a AS (
      SELECT 'orders' AS table_name, count(*) AS loaded_rows FROM orders WHERE o_totalprice > 1100
      UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_quantity > 2
      UNION ALL SELECT 'customer', count(*) FROM customer
    )
    SELECT e.table_name, expected_rows, loaded_rows,
           coalesce(expected_rows * CAST(0.999 AS DOUBLE) <= loaded_rows, false) AS passed
    FROM e LEFT JOIN a ON e.table_name = a.table_name
    """,
    name="row_count_check",
)
def row_counts(spark, sf_dir):
    """Row counts of source and loaded tables, compared with a tolerance."""
    names = ["orders", "lineitem", "customer", "part"]
    source = {n: table(spark, sf_dir, n) for n in names}
    loaded = {
        "orders": source["orders"].filter("o_totalprice > 1100"),
        "lineitem": source["lineitem"].filter("l_quantity > 2"),
        "customer": source["customer"],
    }
    return row_count_check(table_counts(source), table_counts(loaded))


@register("SELECT * FROM customer")
def promote_backfill(spark, sf_dir):
    """Backfill written beside the table, counted against the source and then shown to readers."""
    customer = table(spark, sf_dir, "customer")
    path = shared_path(spark, "promote_backfill")
    view = new_view("promote_backfill")
    promote(spark, customer, CUSTOMERS, table_counts({"customer": customer}), path, view)
    return spark.table(view)


def _landed_documents(lineitem):
    """Line items as JSON documents that do not all have the same columns."""
    return lineitem.select(
        F.to_json(
            F.struct(
                "l_orderkey",
                "l_partkey",
                F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("rebate"),
                F.when(F.col("l_returnflag") == "R", F.col("l_shipdate").cast("string")).alias("returned_at"),
            )
        ).alias("document")
    )


@register(
    """
    SELECT 'lines' AS table_name, column_name, n AS num_rows FROM (
      SELECT 'l_orderkey' AS column_name, count(l_orderkey) AS n FROM lineitem
      UNION ALL SELECT 'l_partkey', count(l_partkey) FROM lineitem
      UNION ALL SELECT 'rebate', count(*) FROM lineitem WHERE l_discount > 0
      UNION ALL SELECT 'returned_at', count(*) FROM lineitem WHERE l_returnflag = 'R'
    ) WHERE n > 0
    """
)
def observed_columns(spark, sf_dir):
    """Columns that occur in landed JSON documents, with their row counts."""
    return document_columns(_landed_documents(table(spark, sf_dir, "lineitem")), "lines", "document")


CONTRACT = parse_specs(
    {
        "sales.lines": {
            "schema": {"l_orderkey": "bigint", '"l_partkey"': "bigint", "l_tax": "numeric", "returned_at": "date"}
        }
    }
)


@register(
    """
    SELECT 'lines' AS table_name, 'l_tax' AS column_name, 'missing' AS status
    UNION ALL SELECT 'lines', 'rebate', 'extra' WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_discount > 0)
    """,
    name="schema_drift",
)
def schema_drift_documents(spark, sf_dir):
    """Differences between a contract and the columns of landed documents."""
    found = document_columns(_landed_documents(table(spark, sf_dir, "lineitem")), "lines", "document")
    drift = schema_drift(contract_columns(spark, CONTRACT.values()), found, compare_types=False)
    return drift.select("table_name", "column_name", "status")


@register("SELECT 'lines' AS table_name, 'l_tax, rebate' AS drifted_columns, false AS extract")
def drift_per_table(spark, sf_dir):
    """Which tables can be extracted, and which columns are in the way."""
    found = document_columns(_landed_documents(table(spark, sf_dir, "lineitem")), "lines", "document")
    contract = contract_columns(spark, CONTRACT.values())
    return drift_summary(contract, schema_drift(contract, found, compare_types=False))


@register(
    """
    SELECT o_orderpriority AS table_name,
           string_agg(o_orderstatus || ':' || n, ', ' ORDER BY o_orderstatus || ':' || n) AS columns
    FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1
    """
)
def column_listings(spark, sf_dir):
    """Per group, its parts as one sorted text."""
    counts = table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
    return column_listing(
        counts.select(
            F.col("o_orderpriority").alias("table_name"),
            F.col("o_orderstatus").alias("column_name"),
            F.col("n").alias("data_type"),
        )
    )


def _coverage_artifact(df, covered, total):
    """Counts per language and source as one coverage document per row."""
    counts = df.groupBy("lang", "source").agg(covered.alias("covered"), total.alias("total"))
    entry = F.struct(F.concat_ws(".", "lang", "source").alias("name"), "covered", "total")
    text = F.to_json(F.struct(F.array(entry).alias("tables")))
    return counts.select(F.from_json(text, COVERAGE_ARTIFACT).alias("a")).select("a.*")


@register(
    """
    WITH t AS (SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2),
    d AS (
      SELECT lang, source, sum(quality) AS covered, count(*) AS total
      FROM documents JOIN labels USING (doc_id) GROUP BY 1, 2
    ), r AS (
      SELECT lang AS dataset_name, source AS table_name, n AS tests_covered,
             CAST(covered AS BIGINT) AS docs_covered, total AS columns_total
      FROM t LEFT JOIN d USING (lang, source) WHERE lang IN ('en', 'de', 'fr')
    )
    SELECT DATE '2024-03-01' AS execution_date, * FROM r
    UNION ALL
    SELECT DATE '2024-03-01', 'all', 'all', CAST(sum(tests_covered) AS BIGINT), CAST(sum(docs_covered) AS BIGINT),
           CAST(sum(columns_total) AS BIGINT) FROM r
    """
)
def coverage_total(spark, sf_dir):
    """Two coverage artifacts joined per table, with a row of totals."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    labelled = documents.join(table(spark, sf_dir, "labels"), "doc_id")
    tests = _coverage_artifact(documents, F.count("*"), F.count("*"))
    docs = _coverage_artifact(labelled, F.sum("quality"), F.count("*"))
    return coverage_report(
        coverage_tables(tests), coverage_tables(docs), date(2024, 3, 1), datasets=("en", "de", "fr")
    )


@register(
    """
    SELECT event_type, max(ts) AS newest,
           date_diff('microsecond', max(ts), TIMESTAMP '2024-01-30 12:00:00') / 1000000.0 AS max_timestamp_time_ago_in_s,
           CASE WHEN date_diff('microsecond', max(ts), TIMESTAMP '2024-01-30 12:00:00') > 43500 * 1000000::BIGINT THEN 'error'
                WHEN date_diff('microsecond', max(ts), TIMESTAMP '2024-01-30 12:00:00') > 43210 * 1000000::BIGINT THEN 'warn'
                ELSE 'pass' END AS status
    FROM events GROUP BY 1
    """,
    name="freshness",
)
def freshness_by_type(spark, sf_dir):
    """Newest time, age against a fixed time and status per event type."""
    newest = table(spark, sf_dir, "events").groupBy("event_type").agg(F.max("ts").alias("newest"))
    return with_age(newest, "newest", datetime(2024, 1, 30, 12), 43_210, 43_500)


@register(
    """
    WITH m AS (
      SELECT 'shop' AS dataset_name, 'orders' AS model_name, max(o_orderdate) AS newest, CAST(NULL AS VARCHAR) AS filter_condition FROM orders
      UNION ALL SELECT 'shop', 'lines', max(l_shipdate), 'l_quantity > 10' FROM lineitem WHERE l_quantity > 10
      UNION ALL SELECT 'web', 'events', max(ts), NULL FROM events
    )
    SELECT DATE '2024-01-31' AS execution_date, dataset_name, model_name,
           CASE WHEN newest IS NULL THEN 'runtime error' WHEN age > 864000 THEN 'error' WHEN age > 86400 THEN 'warn' ELSE 'pass' END AS status,
           newest AS max_timestamp_in_table, age AS max_timestamp_time_ago_in_s, filter_condition
    FROM (SELECT *, date_diff('microsecond', newest, TIMESTAMP '2024-01-31 00:00:00') / 1000000.0 AS age FROM m)
    """
)
def freshness_tables(spark, sf_dir):
    """Newest time, age and status of several tables, one with a filter."""
    tables = {
        "shop.orders": (table(spark, sf_dir, "orders"), "o_orderdate"),
        "shop.lines": (table(spark, sf_dir, "lineitem"), "l_shipdate"),
        "web.events": (table(spark, sf_dir, "events"), "ts"),
    }
    rows = freshness(tables, datetime(2024, 1, 31), 86_400, 864_000, conditions={"shop.lines": "l_quantity > 10"})
    utc = F.to_utc_timestamp("max_timestamp_in_table", F.current_timezone()).cast("timestamp_ntz")
    return rows.withColumn("max_timestamp_in_table", utc)


@register(
    """
    SELECT DATE '2024-03-01' AS execution_date, event_type AS dataset_name, 'u' || user_id AS model_name,
           CASE WHEN value > 20 THEN 'warn' ELSE 'pass' END AS status, strftime(ts, '%Y-%m-%d') AS max_timestamp_in_table,
           value AS max_timestamp_time_ago_in_s, CASE WHEN value > 50 THEN 'x > 1' END AS filter_condition
    FROM events
    """
)
def freshness_artifacts(spark, sf_dir):
    """Rows out of freshness artifacts (nested JSON text)."""
    result = F.struct(
        F.concat_ws(".", F.lit("source"), F.lit("shop"), "event_type", F.concat(F.lit("u"), F.col("user_id"))).alias("unique_id"),
        F.when(F.col("value") > 20, "warn").otherwise("pass").alias("status"),
        F.date_format("ts", "yyyy-MM-dd").alias("max_loaded_at"),
        F.col("value").alias("max_loaded_at_time_ago_in_s"),
        F.struct(F.when(F.col("value") > 50, "x > 1").alias("filter")).alias("criteria"),
    )
    text = F.to_json(F.struct(F.array(result).alias("results")))
    artifacts = table(spark, sf_dir, "events").select(F.from_json(text, FRESHNESS_ARTIFACT).alias("a")).select("a.*")
    return freshness_results(artifacts, date(2024, 3, 1))


@register(
    """
    SELECT count(*) AS num_of_tasks FROM orders
    WHERE o_orderstatus <> 'P' AND o_orderdate > TIMESTAMP '1998-05-31'
      AND o_totalprice / 60 > CASE WHEN o_orderpriority = '1-URGENT' THEN 6000 ELSE 3000 END
    """
)
def long_tasks(spark, sf_dir):
    """Number of recent tasks over their time limit."""
    tasks = _tasks(table(spark, sf_dir, "orders"))
    return long_running_tasks(tasks, date(1998, 6, 1), "monitoring", 3000, {"task 1-URGENT": 6000})


@register(
    """
    SELECT n_name AS segment, CAST(count(*) AS VARCHAR) AS customers
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
    """
)
def csv_report(spark, sf_dir):
    """Small report written as CSV with headers and read back."""
    path = shared_path(spark, "csv_report")
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    counts = (
        customer.groupBy("c_nationkey")
        .agg(F.count("*").alias("customers"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("n_name").alias("segment"), "customers")
    )
    write_report_csv(counts, path)
    return spark.read.option("header", True).schema("segment string, customers string").csv(path)


TYPED = parse_specs(
    {
        "sales.lines": {
            "schema": {
                "orderkey": "bigint",
                "quantity": "integer",
                "discount": "numeric",
                '"flag"': "boolean",
                "partkey": "text",
                "shipped": "bigint",
                "empty": "date",
                "tax": "real",
            }
        }
    }
)


@register(
    """
    WITH found AS (
      SELECT count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS returned FROM lineitem
    )
    SELECT 'lines' AS table_name, column_name, decision, new_type FROM found, (VALUES
      ('orderkey', 'keep', NULL), ('quantity', 'widen', 'numeric'), ('discount', 'keep', NULL), ('flag', 'widen', 'text'),
      ('partkey', 'keep', NULL), ('shipped', 'refuse', NULL), ('empty', 'keep', NULL), ('tax', 'missing', NULL)
    ) AS v(column_name, decision, new_type) WHERE n > 0
    UNION ALL SELECT 'lines', 'returned', 'add', 'text' FROM found WHERE returned > 0
    """,
    name="type_drift",
)
def types_found(spark, sf_dir):
    """Types of a contract against those that the values of landed JSON documents have."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.to_json(
            F.struct(
                F.col("l_orderkey").alias("orderkey"),
                (F.col("l_quantity") + 0.25).alias("quantity"),
                F.when(F.col("l_linenumber") > 1, F.col("l_discount")).alias("discount"),
                F.col("l_returnflag").alias("flag"),
                F.col("l_partkey").alias("partkey"),
                (F.col("l_linestatus") == "F").alias("shipped"),
                F.when(F.col("l_returnflag") == "R", F.col("l_shipdate").cast("string")).alias("returned"),
            )
        ).alias("document"),
    )
    documents = rows.select(F.concat(F.lit('{"empty": null, '), F.substring("document", 2, 1 << 20)).alias("document"))
    drift = type_drift(contract_columns(spark, TYPED.values()), observed_types(documents, "lines", "document"))
    return drift.select("table_name", "column_name", "decision", "new_type")

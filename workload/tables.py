"""Table operations: export files, snapshots, upserts, reloads, diffs, feature datasets, derived tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.operators.derived import lifecycle
from lakeferry.operators.features import FEATURE_SETS, risk_dataset
from lakeferry.operators.merge import apply_diff, delete_insert, table_diff, upsert
from lakeferry.plans.backfill import copy_table
from lakeferry.plans.exports import export_changes
from lakeferry.sinks.storage import shared_path
from lakeferry.sinks.tables import csv_to_ndjson, publish_checked, replace_partitions, write_ndjson, write_report_csv
from lakeferry.sources.files import CORRUPT, read_csv, read_ndjson, read_ndjson_flagged
from lakeferry.spec import TableSpec
from workload.common import cents, money_sum, new_view, registry, table

QUERIES, ORACLES, register = registry()

ALL_CUSTOMERS = "SELECT * FROM customer"


@register(ALL_CUSTOMERS)
def csv_roundtrip(spark, sf_dir):
    """CSV with a header written and loaded back in its schema."""
    path = shared_path(spark, "csv_roundtrip")
    view = new_view("csv_roundtrip")
    customer = table(spark, sf_dir, "customer")
    write_report_csv(customer, f"{path}/csv")
    rows = read_csv(spark, f"{path}/csv", customer.schema, header_rows=1, quoted_newlines=False)
    publish_checked(spark, rows, view, f"{path}/table", max_bad_rows=0)
    return spark.table(view)


@register(
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name || chr(10) || c_mktsegment END AS name, c_acctbal AS balance,
           CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_nationkey END AS nation
    FROM customer WHERE NOT (c_acctbal >= 0 AND c_mktsegment = 'MACHINERY' AND c_nationkey = 1)
    """
)
def csv_dirty_load(spark, sf_dir):
    """CSV with short rows, surplus fields, quoted newlines and bad numbers; bad rows are counted and left out."""
    path = shared_path(spark, "csv_dirty_load")
    view = new_view("csv_dirty_load")
    customer = table(spark, sf_dir, "customer")
    bad = "c_acctbal >= 0 and c_mktsegment = 'MACHINERY' and c_nationkey = 1"
    name = F.concat(F.lit('"'), "c_name", F.lit("\n"), "c_mktsegment", F.lit('"'))
    line = F.concat_ws(
        ",",
        F.when(F.expr(bad), "not a number").otherwise(F.col("c_custkey").cast("string")),
        F.when(F.col("c_acctbal") < 0, "").otherwise(name),
        F.col("c_acctbal").cast("string"),
        # rows of one segment are short, those of another have surplus fields
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey").cast("string")),
        F.when(F.col("c_mktsegment") == "FURNITURE", "surplus,fields"),
    )
    customer.select(line.alias("value")).write.text(f"{path}/csv")
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("name", T.StringType()),
            T.StructField("balance", T.DoubleType()),
            T.StructField("nation", T.IntegerType()),
        ]
    )
    allowed = customer.filter(bad).count()
    publish_checked(spark, read_csv(spark, f"{path}/csv", schema), view, f"{path}/table", allowed)
    return spark.table(view)


NESTED = TableSpec.from_contract(
    "part", {"schema": {"p_partkey": "bigint", "tags": "ARRAY", "price": "numeric", '"from"': "date"}}
)


@register(
    """
    SELECT p_partkey, p_type || '|' || p_name || ', ' || p_brand AS tags, CAST(p_retailprice AS DECIMAL(18,2))::DOUBLE AS price,
           DATE '2024-01-31' AS "from", CAST(NULL AS TIMESTAMP) AS _ingested_ts
    FROM part
    """
)
def csv_to_nested_json(spark, sf_dir):
    """CSV export with array text rewritten as JSON with real arrays and exact decimals."""
    path = shared_path(spark, "csv_to_nested_json")
    tags = F.concat(F.lit('"{'), "p_type", F.lit(',""'), "p_name", F.lit(", "), "p_brand", F.lit('""}"'))
    line = F.concat_ws(",", F.col("p_partkey").cast("string"), tags, F.col("p_retailprice").cast("decimal(18,2)").cast("string"), F.lit("2024-01-31"))
    table(spark, sf_dir, "part").select(line.alias("value")).write.text(f"{path}/csv")
    csv_to_ndjson(spark, f"{path}/csv", f"{path}/json", NESTED)
    rows = read_ndjson(spark, f"{path}/json", NESTED.spark_schema())
    return rows.withColumns(
        {
            "tags": F.array_join("tags", "|"),
            "price": F.col("price").cast("double"),
            "_ingested_ts": F.col("_ingested_ts").cast("timestamp_ntz"),
        }
    )


@register(ALL_CUSTOMERS)
def ndjson_roundtrip(spark, sf_dir):
    """Table exported as newline-delimited JSON and read back."""
    path = shared_path(spark, "ndjson_roundtrip")
    customer = table(spark, sf_dir, "customer")
    write_ndjson(customer, path)
    return read_ndjson(spark, path, customer.schema)


@register(ALL_CUSTOMERS)
def snapshot_copy(spark, sf_dir):
    """Table copied twice; readers see the newer copy."""
    path = shared_path(spark, "snapshot_copy")
    view = new_view("snapshot_copy")
    customer = table(spark, sf_dir, "customer")
    copy_table(spark, customer.filter("c_acctbal > 0"), path, view)
    copy_table(spark, customer, path, view)
    return spark.table(view)


@register(
    """
    SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
           c_mktsegment FROM customer
    UNION ALL
    SELECT c_custkey + 1000000000000, c_name, c_nationkey, c_acctbal + 100, 'NEW' FROM customer WHERE c_mktsegment = 'BUILDING'
    """,
    name="upsert",
)
def upsert_rows(spark, sf_dir):
    """Changed and new rows merged into a table by key."""
    customer = table(spark, sf_dir, "customer")
    building = customer.filter("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") + 100)
    new = building.withColumns(
        {"c_custkey": F.col("c_custkey") + 1_000_000_000_000, "c_mktsegment": F.lit("NEW")}
    )
    return upsert(customer, building.unionByName(new), ["c_custkey"])


@register(
    """
    SELECT * FROM lineitem WHERE l_shipdate <> TIMESTAMP '1998-06-01'
    UNION ALL
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity + 1, l_extendedprice, l_discount, l_tax, 'X', l_linestatus, l_shipdate
    FROM lineitem WHERE l_shipdate = TIMESTAMP '1998-06-01'
    """
)
def delete_insert_day(spark, sf_dir):
    """One ship day deleted and its new rows inserted."""
    lineitem = table(spark, sf_dir, "lineitem")
    day = F.col("l_shipdate") == F.lit("1998-06-01").cast("timestamp_ntz")
    rows = lineitem.filter(day).withColumns({"l_quantity": F.col("l_quantity") + 1, "l_returnflag": F.lit("X")})
    return delete_insert(lineitem, rows, day)


@register(
    """
    SELECT event_id, ts, user_id, CASE WHEN event_type IN ('signup', 'view') THEN value + 1 ELSE value END AS value, props, event_type
    FROM events
    """
)
def replace_by_partition(spark, sf_dir):
    """Table partitioned by two columns; a reload replaces only the partitions it brings, twice the same."""
    path = shared_path(spark, "replace_by_partition")
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    keys = ["day", "event_type"]
    replace_partitions(events, path, keys)
    again = events.filter("event_type in ('signup', 'view')").withColumn("value", F.col("value") + 1)
    replace_partitions(again, path, keys)
    replace_partitions(again, path, keys)
    replace_partitions(again.limit(0), path, keys)
    return spark.read.parquet(path).drop("day")


def _altered(orders):
    """Orders after some time: one status is gone, one changed, and new keys came."""
    kept = orders.filter("o_orderstatus <> 'P' or o_totalprice > 250000")
    changed = kept.withColumn(
        "o_orderpriority",
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300_000), F.lit(None)).otherwise(F.col("o_orderpriority")),
    )
    new = orders.filter("o_orderpriority = '1-URGENT'").withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000_000)
    return changed.unionByName(new)


@register(
    """
    SELECT 'delete' AS change, o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderstatus = 'P' AND o_totalprice <= 250000
    UNION ALL
    SELECT 'update', o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL
    FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 300000
    UNION ALL
    SELECT 'insert', o_orderkey + 1000000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderpriority = '1-URGENT'
    """,
    name="table_diff",
)
def table_diff_rows(spark, sf_dir):
    """Inserted, updated and deleted rows between two states of a table."""
    orders = table(spark, sf_dir, "orders")
    return table_diff(orders, _altered(orders), ["o_orderkey"])


@register(
    """
    SELECT 'delete' AS change, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer WHERE c_acctbal < -500
    UNION ALL
    SELECT 'update', c_custkey, c_name, c_nationkey, c_acctbal + 1, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal >= -500
    """
)
def changes_export(spark, sf_dir):
    """Changes since the last exported state of a table, written as JSON and read back."""
    path, view = shared_path(spark, "changes_export"), new_view("changes_export")
    customer = table(spark, sf_dir, "customer")
    balance = F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    later = customer.filter("c_acctbal >= -500").withColumn("c_acctbal", balance)
    for state, name in ((customer, "first"), (later, "second")):
        export_changes(spark, state, ["c_custkey"], view, f"{path}/table", f"{path}/{name}")
    return read_ndjson(spark, f"{path}/second", "change string, " + ", ".join(f"{c} {t}" for c, t in customer.dtypes))


@register(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           CASE WHEN o_orderstatus = 'F' AND o_totalprice > 300000 THEN NULL ELSE o_orderpriority END AS o_orderpriority
    FROM orders WHERE o_orderstatus <> 'P' OR o_totalprice > 250000
    UNION ALL
    SELECT o_orderkey + 1000000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderpriority = '1-URGENT'
    """
)
def diff_applied(spark, sf_dir):
    """A diff applied to the old state gives the new one."""
    orders = table(spark, sf_dir, "orders")
    return apply_diff(orders, table_diff(orders, _altered(orders), ["o_orderkey"]), ["o_orderkey"])


@register(
    """
    SELECT user_id, min(CASE WHEN event_type = 'signup' THEN ts END) AS created_at,
           max(CASE WHEN event_type = 'purchase' THEN ts END) AS deleted_at
    FROM events GROUP BY 1
    """,
    name="lifecycle",
)
def lifecycle_table(spark, sf_dir):
    """First and last action per key."""
    return lifecycle(table(spark, sf_dir, "events"), ["user_id"], "event_type", "ts", "signup", "purchase")


def _facts(lineitem, orders):
    """Order facts with the columns of the outcome table."""
    from lakeferry.operators.features import OUTCOMES

    lines = lineitem.groupBy("l_orderkey").agg(
        F.count("*").alias("n"), money_sum("l_extendedprice").alias("total"), F.max("l_quantity").alias("top")
    )
    values = {"dpoint_30_1m": F.col("n"), "dpoint_30_3m": F.col("total"), "dpoint_fpd": F.col("top")}
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"]).select(
        F.col("o_orderkey").alias("submission_id"),
        F.col("o_custkey").alias("customer_id"),
        *[values.get(c, F.lit(None).cast("double")).alias(c) for c in OUTCOMES],
    )


def _lookups(orders):
    """Orders as lookups with nested feature structs."""
    status = F.col("o_orderstatus")
    ids = [F.lit("2024-01-01").alias("timestamp"), F.col("o_orderkey").alias("lookup_id")]

    def features(prefix: str, *more):
        # urgent orders have no lookup id
        lookup = F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderkey")).alias("lookup_id")
        return F.struct(ids[0], lookup, F.lit(1).alias("pit"), cents("o_totalprice").alias(f"{prefix}_amount"), *more)

    no_text = F.lit(None).cast("string")
    loans = F.when(status == "F", F.array("o_orderkey", "o_custkey")).when(status == "O", F.array().cast("array<bigint>"))
    return orders.select(
        F.col("o_orderkey").alias("submission_id"),
        F.col("o_custkey").alias("customer_id"),
        loans.alias("loan_ids"),
        F.struct(*ids, F.col("o_orderkey").alias("submission_id"), F.col("o_custkey").alias("num_loans")).alias(
            "internal_lookup_features"
        ),
        features("schufa", F.col("o_orderpriority").alias("error_message")).alias("schufa_features"),
        features("ccis").alias("ccis_features"),
        features("delta", no_text.alias("error_message")).alias("delta_features"),
        F.struct(*ids, cents("o_totalprice").alias("uc_amount"), status.alias("uc_status")).alias("uc_features"),
        F.when(F.col("o_totalprice") > 100_000, F.struct(no_text.alias("error_message"), F.col("o_custkey").alias("score"))).alias(
            "crif_parser"
        ),
        F.struct(
            *ids,
            F.col("o_orderkey").alias("external_lookup_id"),
            F.col("o_orderkey").alias("submission_id"),
            F.lit("none").alias("error_message"),
            F.array(F.lit("a")).alias("flags"),
            F.lit("i").alias("inputs"),
            F.lit("o").alias("outputs"),
            F.col("o_orderkey").alias("ccis_lookup_id"),
            F.col("o_orderkey").alias("delta_lookup_id"),
            (cents("o_totalprice") * 2).alias("capacity_amount"),
        ).alias("capacity"),
    )


_FACTS_SQL = """
    WITH o AS (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS price FROM orders),
    f AS (
      SELECT l_orderkey, count(*) AS dpoint_30_1m, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS dpoint_30_3m,
             max(l_quantity) AS dpoint_fpd
      FROM lineitem GROUP BY 1
    )
    SELECT o_orderkey AS submission_id, o_custkey AS customer_id, {features}, dpoint_30_1m, dpoint_30_3m, dpoint_fpd
    FROM o LEFT JOIN f ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' {more}
"""
_NOT_URGENT = "AND o_orderpriority <> '1-URGENT'"


def _risk(spark, sf_dir, country, dropped=()):
    orders = table(spark, sf_dir, "orders")
    facts = _facts(table(spark, sf_dir, "lineitem"), orders)
    rows = risk_dataset(_lookups(orders), facts, FEATURE_SETS[country])
    # outcome columns that the order facts do not fill are not compared
    empty = [c for c in rows.columns if c.startswith("dpoint_") and c not in ("dpoint_30_1m", "dpoint_30_3m", "dpoint_fpd")]
    return rows.drop(*empty, *dropped)


@register(
    _FACTS_SQL.format(
        features="""o_orderpriority AS schufa_error_message, CAST(NULL AS VARCHAR) AS crif_error_message,
        'none' AS capacity_error_message, CASE WHEN o_totalprice > 100000 THEN o_custkey END AS num_crif_score,
        o_custkey AS num_loans, price AS schufa_amount, o_orderkey AS ccis_lookup_id, o_orderkey AS delta_lookup_id,
        price * 2 AS capacity_amount""",
        more=_NOT_URGENT,
    )
)
def risk_dataset_de(spark, sf_dir):
    """Model dataset with three feature structs and single picked values."""
    return _risk(spark, sf_dir, "de")


@register(
    _FACTS_SQL.format(
        features="""o_custkey AS num_loans, price AS ccis_amount, price AS delta_amount, price * 2 AS capacity_amount,
        o_orderkey AS external_lookup_id, 'none' AS error_message""",
        more=_NOT_URGENT,
    )
)
def risk_dataset_fi(spark, sf_dir):
    """Model dataset that needs two lookups."""
    return _risk(spark, sf_dir, "fi", ("flags", "inputs", "outputs"))


@register(
    _FACTS_SQL.format(
        features="""o_custkey AS num_loans, price AS uc_amount, o_orderstatus AS uc_status, price * 2 AS capacity_amount,
        o_orderkey AS ccis_lookup_id, o_orderkey AS delta_lookup_id, 'none' AS error_message""",
        more="",
    )
)
def risk_dataset_se(spark, sf_dir):
    """Model dataset with one external lookup."""
    return _risk(spark, sf_dir, "se", ("flags", "inputs", "outputs"))


RATE_MONTH = date(1998, 6, 1)


@register(
    """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS exchange_month, o_orderpriority AS currency_code,
           CASE WHEN date_trunc('month', o_orderdate) >= TIMESTAMP '1998-06-01' THEN CAST(max(o_custkey) AS DOUBLE)
                ELSE CAST(count(*) AS DOUBLE) END AS value
    FROM orders GROUP BY 1, 2, date_trunc('month', o_orderdate)
    """
)
def upsert_rates(spark, sf_dir):
    """Rates by month and currency: newer months replaced, others kept."""
    keys = ["exchange_month", "currency_code"]
    by_month = table(spark, sf_dir, "orders").groupBy(
        F.trunc("o_orderdate", "MM").alias("exchange_month"), F.col("o_orderpriority").alias("currency_code")
    )
    old = by_month.agg(F.count("*").cast("double").alias("value"))
    new = by_month.agg(F.max("o_custkey").cast("double").alias("value")).filter(F.col("exchange_month") >= F.lit(RATE_MONTH))
    return upsert(old, new, keys)


@register(
    """
    SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey <> 3
    """
)
def ndjson_dirty_load(spark, sf_dir):
    """JSON lines of which some are cut off and some have text for a number: bad ones are counted and kept apart."""
    path = shared_path(spark, "ndjson_dirty_load")
    view = new_view("ndjson_dirty_load")
    customer = table(spark, sf_dir, "customer")
    good = F.to_json(F.struct("c_custkey", "c_name", "c_acctbal"))
    bad = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit('{"c_custkey":'), "c_custkey")).otherwise(
        F.replace(good, F.concat(F.lit('"c_custkey":'), F.col("c_custkey").cast("string")), F.lit('"c_custkey":"none"'))
    )
    lines = customer.select(F.when(F.col("c_nationkey") == 3, bad).otherwise(good).alias("value"))
    lines.write.text(f"{path}/json")
    allowed = customer.filter("c_nationkey = 3").count()
    rows = read_ndjson_flagged(spark, f"{path}/json", "c_custkey bigint, c_name string, c_acctbal double")
    publish_checked(spark, rows.drop(CORRUPT), view, f"{path}/table", allowed)
    return spark.table(view)

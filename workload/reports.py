"""Personal-data report sections, with the given tables in the roles of the section's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeferry.plans import subject_report as report
from lakeferry.sinks.storage import shared_path
from workload.common import registry, table

QUERIES, ORACLES, register = registry()

# the requests: all customers with a negative balance
REQUESTED = "(SELECT c_custkey FROM customer WHERE c_acctbal < 0)"


def _requests(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("customer_id"))


def _text(value: str | None = None):
    return F.lit(value).cast("string")


def _accounts(spark, sf_dir):
    """Customers as subjects with addresses."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lit("Street "), F.col("c_nationkey")).alias("address_street"),
        F.col("c_mktsegment").alias("address_city"),
        _text().alias("address_postcode"),
        _text().alias("birthdate"),
        _text().alias("gender"),
        F.col("c_nationkey"),
    )


@register(
    f"""
    SELECT c_custkey AS customer_id, c_name AS full_name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'P' || c_custkey END AS personal_identifier,
           'Street ' || c_nationkey AS address_street, CAST(NULL AS VARCHAR) AS address_postcode, c_mktsegment AS address_city,
           CAST(NULL AS VARCHAR) AS birthdate, CAST(NULL AS VARCHAR) AS gender
    FROM customer WHERE c_custkey IN {REQUESTED}
    """
)
def subject_general(spark, sf_dir):
    """Customers with their personal identity, where they have one."""
    identities = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "PERSONAL_ID").otherwise("OTHER").alias("type"),
        F.concat(F.lit("P"), F.col("c_custkey")).alias("value"),
    )
    tables = {"customers": _accounts(spark, sf_dir), "customer_identities": identities}
    return report.general_customer_details(tables, _requests(spark, sf_dir))


@register(
    f"""
    SELECT o_custkey AS customer_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS created_at, l_returnflag AS type,
           'part ' || l_partkey AS value, l_discount > 0 AS is_active
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_custkey IN {REQUESTED}
    """
)
def subject_contacts(spark, sf_dir):
    """Contact channels of the requested customers."""
    tables = {
        "customer_channels": table(spark, sf_dir, "orders").select(
            F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("channel_id")
        ),
        "channels": table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("id"),
            F.col("l_shipdate").alias("created_at"),
            F.col("l_returnflag").alias("type"),
            F.concat(F.lit("part "), F.col("l_partkey")).alias("value"),
            (F.col("l_discount") > 0).alias("is_active"),
        ),
    }
    return report.contact_details(tables, _requests(spark, sf_dir))


@register(
    f"""
    SELECT o_custkey AS customer_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS created_at, o_orderpriority AS source,
           'line ' || l_linenumber AS customer_name, CAST(NULL AS VARCHAR) AS customer_street, CAST(NULL AS VARCHAR) AS customer_postal,
           CASE WHEN s_acctbal > 0 THEN s_name END AS lender, l_extendedprice AS loan_balance, 'SEK' AS currency_code,
           l_partkey AS payment_account, l_linenumber AS payment_reference, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS reject_reason,
           l_linestatus AS external_status, c_mktsegment AS application_status
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN customer ON o_custkey = c_custkey WHERE o_custkey IN {REQUESTED}
    """
)
def subject_applications(spark, sf_dir):
    """Applications with their statements, lenders and assessments."""
    tables = {
        "applications": table(spark, sf_dir, "orders").select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderkey").alias("external_statement_id"),
            F.col("o_custkey").alias("assessment_id"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderpriority").alias("source"),
            F.lit("SEK").alias("currency_code"),
            F.col("o_orderstatus").alias("status"),
            _text().alias("reject_reason"),
        ),
        "external_statements": table(spark, sf_dir, "lineitem").select(
            F.col("l_orderkey").alias("id"),
            F.col("l_suppkey").alias("lender_id"),
            F.concat(F.lit("line "), F.col("l_linenumber")).alias("customer_name"),
            _text().alias("customer_street"),
            _text().alias("customer_postal"),
            F.col("l_extendedprice").alias("loan_balance"),
            F.col("l_partkey").alias("payment_account"),
            F.col("l_linenumber").alias("payment_reference"),
            F.col("l_linestatus").alias("status"),
        ),
        "lenders": table(spark, sf_dir, "supplier")
        .filter("s_acctbal > 0")
        .select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("display_name")),
        "assessments": table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("status")
        ),
    }
    return report.application_details(tables, _requests(spark, sf_dir))


@register(
    f"""
    SELECT o_custkey AS customer_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS created_at, 'P' || o_custkey AS personal_identifier,
           o_orderkey AS account_number, o_orderstatus AS status
    FROM orders WHERE o_custkey IN {REQUESTED}
    """
)
def subject_autogiro(spark, sf_dir):
    """Payment authorisations of the requested customers."""
    authorizations = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("created_at"),
        F.concat(F.lit("P"), F.col("o_custkey")).alias("personal_identifier"),
        F.col("o_orderkey").alias("account_number"),
        F.col("o_orderstatus").alias("status"),
    )
    return report.autogiro({"autogiro_authorizations": authorizations}, _requests(spark, sf_dir))


@register(
    f"""
    SELECT doc_id AS customer_id, CAST(NULL AS VARCHAR) AS created_at, 'Name ' || source AS signee_name, 'P' || doc_id AS signee_pno,
           CAST(NULL AS VARCHAR) AS signee_ip, text AS signed_text, lang AS platform, CAST(NULL AS VARCHAR) AS user_ip,
           'agent ' || n_chars AS user_agent
    FROM documents WHERE doc_id IN {REQUESTED}
    """
)
def subject_signatures(spark, sf_dir):
    """Signatures with the signed text decoded, over whole texts."""
    xml = F.concat(
        F.lit('<a:Signature xmlns:a="http://www.w3.org/2000/09/xmldsig#"><a:Object><b:bankIdSignedData '),
        F.lit('xmlns:b="http://www.bankid.com/signature/v1.0.0/types"><b:usrVisibleData>'),
        F.base64(F.encode("text", "UTF-8")),
        F.lit("</b:usrVisibleData></b:bankIdSignedData></a:Object></a:Signature>"),
    )
    content = F.to_json(
        F.struct(
            F.struct(
                F.concat(F.lit("Name "), F.col("source")).alias("name"),
                F.concat(F.lit("P"), F.col("doc_id")).alias("personalNumber"),
            ).alias("user"),
            F.base64(F.encode(xml, "UTF-8")).alias("signature"),
        )
    )
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("customer_id"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        content.alias("content"),
        F.col("lang").alias("platform"),
        _text().alias("user_ip"),
        F.concat(F.lit("agent "), F.col("n_chars")).alias("user_agent"),
    )
    return report.signatures({"signatures": rows}, _requests(spark, sf_dir))


@register(
    f"""
    SELECT o_custkey AS customer_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS created_at, o_orderpriority AS spar_id,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS spar_ts, CAST(o_orderkey AS VARCHAR) AS uc_id, CAST(NULL AS VARCHAR) AS uc_ts
    FROM orders WHERE o_custkey IN {REQUESTED}
    """
)
def subject_lookups(spark, sf_dir):
    """Registry lookups named in policy documents."""
    policy = F.to_json(
        F.struct(
            F.struct(
                F.struct(
                    F.col("o_orderpriority").alias("_id"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("_ts")
                ).alias("ReverseLookup"),
                F.struct(F.col("o_orderkey").alias("_id"), F.lit("no time").alias("_ts")).alias("UCLookup"),
            ).alias("data")
        )
    )
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderdate").alias("created_at"), policy.alias("main_policy")
    )
    return report.external_lookup_listings({"assessments": rows}, _requests(spark, sf_dir))


@register(
    f"""
    SELECT turn AS id, CAST(NULL AS VARCHAR) AS created_at, role AS created_by, text AS content, conv_id AS customer_id,
           CAST(NULL AS VARCHAR) AS application_id, '[' || turn || ']' AS files, role AS type
    FROM conversations WHERE conv_id IN {REQUESTED}
    """
)
def subject_notes(spark, sf_dir):
    """Notes about the requested customers, over whole texts."""
    notes = table(spark, sf_dir, "conversations").select(
        F.col("turn").alias("id"),
        F.lit(None).cast("timestamp_ntz").alias("created_at"),
        F.col("role").alias("created_by"),
        F.col("text").alias("content"),
        F.col("conv_id").alias("customer_id"),
        _text().alias("application_id"),
        F.array("turn").alias("files"),
        F.col("role").alias("type"),
    )
    return report.internal_notes({"notes": notes}, _requests(spark, sf_dir))


@register(
    f"""
    SELECT c_custkey AS customer_id, c_custkey AS id, CASE WHEN n_regionkey > 1 THEN n_name END AS provider, 'A' || c_custkey AS account_number,
           c_name AS name, c_mktsegment AS type, CAST(0 AS DOUBLE) AS available_credit, c_acctbal AS balance, 'SEK' AS currency_code,
           '{{"segment":"' || c_mktsegment || '"}}' AS metadata, CAST(NULL AS VARCHAR) AS updated_at
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey IN {REQUESTED}
    """
)
def subject_accounts(spark, sf_dir):
    """Bank accounts with their provider, where it is known."""
    tables = {
        "accounts": table(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("user_id"),
            F.col("c_custkey").alias("id"),
            F.col("c_nationkey").alias("provider_id"),
            F.concat(F.lit("A"), F.col("c_custkey")).alias("account_number"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("type"),
            F.lit(0.0).alias("available_credit"),
            F.col("c_acctbal").alias("balance"),
            F.lit("SEK").alias("currency_code"),
            F.to_json(F.struct(F.col("c_mktsegment").alias("segment"))).alias("metadata"),
            F.lit(None).cast("timestamp_ntz").alias("updated_at"),
        ),
        "providers": table(spark, sf_dir, "nation")
        .filter("n_regionkey > 1")
        .select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("display_name")),
    }
    return report.bank_accounts(tables, _requests(spark, sf_dir))


def _transactions(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("account_id"),
        "user_id",
        F.col("ts").alias("date"),
        F.col("event_type").alias("description"),
        F.col("value").alias("amount"),
        F.lit("SEK").alias("currency_code"),
        F.col("event_type").alias("type"),
        _text().alias("category_metadata"),
        F.col("props").alias("metadata"),
        F.col("ts").alias("updated_at"),
    )


_TRANSACTIONS = f"""
    SELECT {{customer}} AS customer_id, event_id AS account_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS date, event_type AS description,
           value AS amount, 'SEK' AS currency_code, event_type AS type, CAST(NULL AS VARCHAR) AS category_metadata, props AS metadata,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS updated_at
    FROM events WHERE user_id IN {REQUESTED}
"""


@register(_TRANSACTIONS.format(customer="user_id"))
def subject_transactions(spark, sf_dir):
    """Transactions of the requested customers."""
    return report.bank_transactions({"transactions": _transactions(spark, sf_dir)}, _requests(spark, sf_dir))


@register(
    f"""
    SELECT o_custkey AS customer_id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS scheduled_at, o_orderstatus AS status,
           o_orderpriority AS type, 'r' || o_custkey AS recipient, '{{"total":' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) || '}}' AS content
    FROM orders WHERE o_custkey IN {REQUESTED}
    """
)
def subject_communications(spark, sf_dir):
    """Messages sent to the requested customers."""
    total = (F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("bigint")
    sendouts = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("scheduled_at"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("type"),
        F.concat(F.lit("r"), F.col("o_custkey")).alias("recipient"),
        F.to_json(F.struct(total.alias("total"))).alias("content"),
    )
    return report.communications({"sendouts": sendouts}, _requests(spark, sf_dir))


@register(
    f"""
    SELECT user_id AS customer, CAST(event_id AS VARCHAR) AS account_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS date,
           CAST(user_id AS VARCHAR) AS user_id, event_type AS description, props AS metadata
    FROM events WHERE user_id IN {REQUESTED}
    """
)
def subject_files(spark, sf_dir):
    """A whole section written per customer and read back."""
    path = shared_path(spark, "subject_files")
    tables = {"transactions": _transactions(spark, sf_dir)}
    name = "bank_transactions"
    section = report.SECTIONS[name]
    report.write_report(tables, _requests(spark, sf_dir), path, {name: section})
    schema = ", ".join(f"{c} string" for c in section.header) + f", {report.FOLDER} bigint"
    written = spark.read.option("header", True).option("escape", '"').schema(schema).csv(f"{path}/{name}")
    return written.select(F.col(report.FOLDER).alias("customer"), "account_id", "date", "user_id", "description", "metadata")

"""Personal-data reports: every section for all requested customers in one job."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.functions.xml import signed_text
from lakeferry.sinks.storage import shared_path
from lakeferry.sinks.tables import CSV_LAYOUT, laid_out

SUBJECT = "customer_id"
TIME_LAYOUT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
Tables = Mapping[str, DataFrame]


def time_text(column: Column) -> Column:
    return F.date_format(column, TIME_LAYOUT)


def policy_value(path: str) -> Column:
    return F.get_json_object("main_policy", path)


def policy_time(path: str) -> Column:
    return time_text(policy_value(path).try_cast("timestamp"))


def requested(df: DataFrame, requests: DataFrame, column: str = SUBJECT) -> DataFrame:
    """Rows of the requested customers, with the customer as ``customer_id``."""
    ids = requests.select(F.col(SUBJECT).alias("__requested"))
    return df.join(ids, df[column] == ids["__requested"], "left_semi")


def contact_details(t: Tables, requests: DataFrame) -> DataFrame:
    own = requested(t["customer_channels"], requests).select(SUBJECT, "channel_id")
    ch = t["channels"]
    return own.join(ch, own["channel_id"] == ch["id"]).select(
        SUBJECT, time_text(ch["created_at"]).alias("created_at"), ch["type"], ch["value"], ch["is_active"]
    )


def application_details(t: Tables, requests: DataFrame) -> DataFrame:
    a = requested(t["applications"], requests).alias("a")
    joined = (
        a.join(t["external_statements"].alias("es"), F.col("a.external_statement_id") == F.col("es.id"))
        .join(t["lenders"].alias("l"), F.col("es.lender_id") == F.col("l.id"), "left")
        .join(t["assessments"].alias("ass"), F.col("a.assessment_id") == F.col("ass.id"), "left")
    )
    return joined.select(
        "a.customer_id",
        time_text(F.col("a.created_at")).alias("created_at"),
        "a.source",
        "es.customer_name",
        "es.customer_street",
        "es.customer_postal",
        F.col("l.display_name").alias("lender"),
        "es.loan_balance",
        "a.currency_code",
        "es.payment_account",
        "es.payment_reference",
        "a.status",
        "a.reject_reason",
        F.col("es.status").alias("external_status"),
        F.col("ass.status").alias("application_status"),
    )


def general_customer_details(t: Tables, requests: DataFrame) -> DataFrame:
    c = requested(t["customers"], requests, "id").alias("c")
    ci = t["customer_identities"].filter("type = 'PERSONAL_ID'").alias("ci")
    return c.join(ci, F.col("c.id") == F.col("ci.customer_id"), "left").select(
        F.col("c.id").alias(SUBJECT),
        "c.full_name",
        F.col("ci.value").alias("personal_identifier"),
        "c.address_street",
        "c.address_postcode",
        "c.address_city",
        "c.birthdate",
        "c.gender",
    )


def autogiro(t: Tables, requests: DataFrame) -> DataFrame:
    return requested(t["autogiro_authorizations"], requests).select(
        SUBJECT, time_text(F.col("created_at")).alias("created_at"), "personal_identifier", "account_number", "status"
    )


def signatures(t: Tables, requests: DataFrame) -> DataFrame:
    def content(path: str) -> Column:
        return F.get_json_object("content", path)

    return requested(t["signatures"], requests).select(
        SUBJECT,
        time_text(F.col("created_at")).alias("created_at"),
        content("$.user.name").alias("signee_name"),
        content("$.user.personalNumber").alias("signee_pno"),
        content("$.device.ipAddress").alias("signee_ip"),
        signed_text(content("$.signature")).alias("signed_text"),
        "platform",
        "user_ip",
        "user_agent",
    )


def external_lookup_listings(t: Tables, requests: DataFrame) -> DataFrame:
    return requested(t["assessments"], requests).select(
        SUBJECT,
        time_text(F.col("created_at")).alias("created_at"),
        policy_value("$.data.ReverseLookup._id").alias("spar_id"),
        policy_time("$.data.ReverseLookup._ts").alias("spar_ts"),
        policy_value("$.data.UCLookup._id").alias("uc_id"),
        policy_time("$.data.UCLookup._ts").alias("uc_ts"),
    )


def internal_notes(t: Tables, requests: DataFrame) -> DataFrame:
    return requested(t["notes"], requests).select(
        "id",
        time_text(F.col("created_at")).alias("created_at"),
        "created_by",
        "content",
        SUBJECT,
        "application_id",
        F.col("files").cast("string").alias("files"),
        "type",
    )


def bank_accounts(t: Tables, requests: DataFrame) -> DataFrame:
    a = requested(t["accounts"], requests, "user_id").alias("a")
    p = t["providers"].alias("p")
    return a.join(p, F.col("a.provider_id") == F.col("p.id"), "left").select(
        F.col("a.user_id").alias(SUBJECT),
        "a.id",
        F.col("p.display_name").alias("provider"),
        "a.account_number",
        "a.name",
        "a.type",
        "a.available_credit",
        "a.balance",
        "a.currency_code",
        F.col("a.metadata").cast("string").alias("metadata"),
        time_text(F.col("a.updated_at")).alias("updated_at"),
    )


def bank_transactions(t: Tables, requests: DataFrame) -> DataFrame:
    return requested(t["transactions"], requests, "user_id").select(
        F.col("user_id").alias(SUBJECT),
        "account_id",
        "user_id",
        time_text(F.col("date")).alias("date"),
        "description",
        "amount",
        "currency_code",
        "type",
        F.col("category_metadata").cast("string").alias("category_metadata"),
        F.col("metadata").cast("string").alias("metadata"),
        time_text(F.col("updated_at")).alias("updated_at"),
    )


def communications(t: Tables, requests: DataFrame) -> DataFrame:
    return requested(t["sendouts"], requests).select(
        SUBJECT,
        time_text(F.col("scheduled_at")).alias("scheduled_at"),
        "status",
        "type",
        "recipient",
        F.col("content").cast("string").alias("content"),
    )


@dataclass(frozen=True)
class Section:
    """One part of the report: its rows, header (in order) and row order."""

    rows: Callable[[Tables, DataFrame], DataFrame]
    header: tuple[str, ...]
    order: tuple[str, ...] = ()


# Sections and their headers.
SECTIONS = {
    "contact_details": Section(contact_details, ("created_at", "type", "value", "is_active")),
    "application_details": Section(
        application_details,
        (
            "created_at",
            "source",
            "customer_name",
            "customer_street",
            "customer_postal",
            "lender",
            "loan_balance",
            "currency_code",
            "payment_account",
            "payment_reference",
            "status",
            "reject_reason",
            "external_status",
            "application_status",
        ),
    ),
    "general_customer_details": Section(
        general_customer_details,
        (
            "full_name",
            "personal_identifier",
            "address_street",
            "address_postcode",
            "address_city",
            "birthdate",
            "gender",
        ),
    ),
    "autogiro": Section(autogiro, ("created_at", "personal_identifier", "account_number", "status")),
    "signatures": Section(
        signatures,
        (
            "created_at",
            "signee_name",
            "signee_pno",
            "signee_ip",
            "signed_text",
            "platform",
            "user_ip",
            "user_agent",
        ),
    ),
    "external_lookup_listings": Section(
        external_lookup_listings, ("created_at", "spar_id", "spar_ts", "uc_id", "uc_ts")
    ),
    "internal_notes": Section(
        internal_notes,
        ("id", "created_at", "created_by", "content", "customer_id", "application_id", "files", "type"),
    ),
    "bank_accounts": Section(
        bank_accounts,
        (
            "id",
            "provider",
            "account_number",
            "name",
            "type",
            "available_credit",
            "balance",
            "currency_code",
            "metadata",
            "updated_at",
        ),
    ),
    "bank_transactions": Section(
        bank_transactions,
        (
            "account_id",
            "user_id",
            "date",
            "description",
            "amount",
            "currency_code",
            "type",
            "category_metadata",
            "metadata",
            "updated_at",
        ),
        ("account_id", "date"),
    ),
    "communications": Section(
        communications, ("scheduled_at", "status", "type", "recipient", "content"), ("scheduled_at",)
    ),
}

FOLDER = "_customer"
#: Folders with a header alone that one task writes: their cost is in files, not in bytes, which Spark sizes tasks by.
FOLDERS_PER_TASK = 200


def write_report(tables: Tables, requests: DataFrame, path: str, sections: Mapping[str, Section] = SECTIONS) -> None:
    """Write all sections as CSV with headers, one folder per section and customer.

    Only the folders of the requested customers are replaced. A customer without rows in a
    section gets a file with the header alone.

    Rows are laid out in ranges of customer and row order: the rows of one customer stay
    sorted over their files, and a customer with very many rows is written by many tasks.
    The requests are written once, so that ten sections do not compute them ten times. The
    headers alone are dealt to tasks by their number.
    """
    spark = requests.sparkSession
    ids = shared_path(spark, "requests")
    requests.select(SUBJECT).distinct().write.parquet(ids)
    requests = spark.read.parquet(ids)
    tasks = max(-(-requests.count() // FOLDERS_PER_TASK), 1)
    for name, section in sections.items():
        rows = section.rows(tables, requests)
        order = [F.col(FOLDER), *[F.asc_nulls_last(c) for c in section.order]]
        folder = f"{path.rstrip('/')}/{name}"
        only = {"partitionOverwriteMode": "dynamic"}
        (
            laid_out(rows.withColumn(FOLDER, F.col(SUBJECT)).select(FOLDER, *section.header), order)
            .write.mode("overwrite")
            .options(**CSV_LAYOUT, **only)
            .partitionBy(FOLDER)
            .csv(folder)
        )
        without = requests.join(rows.select(SUBJECT).distinct(), SUBJECT, "left_anti")
        header = without.select(F.col(SUBJECT).alias(FOLDER), F.lit(",".join(section.header)).alias("value"))
        header.repartition(tasks, FOLDER).write.mode("overwrite").options(**only).partitionBy(FOLDER).text(folder)

"""Documents: JSON projection, lenient times, array text, XML, HTML, signatures, advertising reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeferry.functions.html import inner_parts, row_cells
from lakeferry.functions.json_documents import (
    POLICY_DOCUMENTS,
    POLICY_FIELDS,
    JsonField,
    lenient_timestamp,
    project_json,
)
from lakeferry.functions.normalize import array_from_text
from lakeferry.functions.text import country_prefix, name_part
from lakeferry.functions.xml import signed_text
from lakeferry.operators.marketing import (
    APPLE_SCHEMA,
    SNAPCHAT_SCHEMA,
    TIKTOK_SCHEMA,
    apple_rows,
    snapchat_rows,
    tiktok_rows,
)
from lakeferry.operators.rates import (
    index_message,
    index_outcomes,
    index_values,
    monthly_rates,
    response_faults,
    response_series,
)
from lakeferry.sinks.messages import messages, write_messages
from lakeferry.sinks.storage import shared_path
from lakeferry.sources.files import read_ndjson
from workload.common import TEXT_TIME, cents, plain_times, registry, table

QUERIES, ORACLES, register = registry()


@register(
    """
    SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, props->>'$.k' AS k_text,
           '{"k":' || (props->>'$.k') || '}' AS whole, CAST(NULL AS VARCHAR) AS missing,
           CAST(props->>'$.k' AS BIGINT) AS fallback, CAST(NULL AS BOOLEAN) AS wrong_type, 'wrong_type' AS rejects
    FROM events
    """
)
def json_project(spark, sf_dir):
    """Document, scalar, fallback, missing and ill-typed columns from one parse per row."""
    fields = [
        JsonField("k", ("$.k",), "integer"),
        JsonField("k_text", ("$.k",), "text"),
        JsonField("whole", ("$",)),
        JsonField("missing", ("$.data.none",)),
        JsonField("fallback", ("$.none", "$.k"), "integer"),
        JsonField("wrong_type", ("$.k",), "boolean"),
    ]
    events = table(spark, sf_dir, "events").select("event_id", "props")
    shown = project_json(events, "props", fields, rejects="rejects").drop("props")
    return shown.withColumn("rejects", F.array_join("rejects", "|"))


def _policies(orders):
    """Orders as policy documents."""
    price = cents("o_totalprice")
    rfc = F.concat(F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    done = F.col("o_orderstatus") == "F"
    limit = F.when(
        done, F.struct(price.alias("limit"), F.lit("model").alias("limit_source"), F.lit(None).cast("bigint").alias("suggested_limit"), F.lit(None).cast("string").alias("customer_type"))
    ).otherwise(
        F.struct(F.lit(None).cast("bigint").alias("limit"), F.lit(None).cast("string").alias("limit_source"), (price + 1).alias("suggested_limit"), F.col("o_orderpriority").alias("customer_type"))
    )
    data = F.struct(
        F.struct(F.col("o_orderstatus").alias("state")).alias("Rdm"),
        F.lit("text").alias("Request"),
        F.struct(price.alias("loanBalance")).alias("request"),
        limit.alias("Limit"),
        F.struct(
            F.struct(price.alias("monthlyPayment")).alias("new"),
            F.struct(F.col("o_orderpriority").alias("monthlyPayment")).alias("old"),
        ).alias("Pricing"),
        F.struct(done.alias("returning")).alias("Customer"),
        F.struct(
            F.when(done, iso).otherwise(rfc).alias("_ts"),
            F.array(
                F.struct(
                    price.alias("credit_used_blanco"),
                    F.col("o_custkey").alias("credit_used_account"),
                    F.lit("n/a").alias("credit_used_instalment"),
                )
            ).alias("credit_history"),
        ).alias("UCLookup"),
        F.struct(F.array("o_orderstatus", "o_orderpriority").alias("reasons")).alias("response"),
        F.struct(
            F.col("o_orderkey").alias("_id"), price.alias("exposure"), F.lit("12 kSEK").alias("customer_provided_income_gross")
        ).alias("InternalLookup"),
        F.struct(F.col("o_orderpriority").alias("_id")).alias("SCLookup"),
    )
    document = F.to_json(F.struct(data.alias("data"), F.struct(F.lit("v7").alias("scorecard_version")).alias("response")))
    return orders.select("o_orderkey", document.alias("main_policy"))


# JSON texts of the documents that the orders have; the other documents of the policy are null.
_KNOWN_DOCUMENTS = {
    "rdm": """'{"state":"' || o_orderstatus || '"}'""",
    "request_schema": """'"text"'""",
    "request": """'{"loanBalance":' || price || '}'""",
    "limit": """CASE WHEN o_orderstatus = 'F' THEN '{"limit":' || price || ',"limit_source":"model"}'
        ELSE '{"customer_type":"' || o_orderpriority || '","suggested_limit":' || (price + 1) || '}' END""",
    "pricing": """'{"new":{"monthlyPayment":' || price || '},"old":{"monthlyPayment":"' || o_orderpriority || '"}}'""",
    "customer": """'{"returning":' || CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END || '}'""",
    "uc_lookup": """'{"_ts":"' || CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
        ELSE strftime(o_orderdate, '%a, %d %b %Y %H:%M:%S GMT') END || '","credit_history":[{"credit_used_account":' || o_custkey
        || ',"credit_used_blanco":' || price || ',"credit_used_instalment":"n/a"}]}'""",
    "response": """'{"reasons":["' || o_orderstatus || '","' || o_orderpriority || '"]}'""",
    "internal_lookup": """'{"_id":' || o_orderkey || ',"customer_provided_income_gross":"12 kSEK","exposure":' || price || '}'""",
    "sc_lookup": """'{"_id":"' || o_orderpriority || '"}'""",
}
_DOCUMENT_TEXTS = ", ".join(
    f"{_KNOWN_DOCUMENTS.get(name, 'CAST(NULL AS VARCHAR)')} AS {name}" for name in POLICY_DOCUMENTS
)


@register(
    f"""
    WITH o AS (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS price FROM orders)
    SELECT o_orderkey, {_DOCUMENT_TEXTS},
           CAST(price AS DOUBLE) AS exposure, CAST(price AS DOUBLE) AS loan_balance, o_orderstatus = 'F' AS is_returning,
           price AS uc_credit_used_blanco, o_custkey AS uc_credit_used_account,
           CAST(NULL AS BIGINT) AS uc_credit_used_instalment, o_orderdate AS uc_created_at,
           o_orderstatus || '|' || o_orderpriority AS response_reasons,
           '"12 kSEK"' AS customer_provided_income_gross, CAST(price AS VARCHAR) AS new_monthly_payment,
           o_orderpriority AS old_monthly_payment, 'v7' AS scorecard_version, o_orderkey AS internal_lookup_id,
           CAST(CASE WHEN o_orderstatus = 'F' THEN price ELSE price + 1 END AS VARCHAR) AS suggested_limit,
           CASE WHEN o_orderstatus = 'F' THEN 'model' ELSE o_orderpriority END AS customer_type,
           CAST(NULL AS VARCHAR) AS asiakastieto_lookup_id, CAST(NULL AS VARCHAR) AS asiakastieto_ccis_lookup_id,
           '"' || o_orderpriority || '"' AS schufa_lookup_id, CAST(NULL AS VARCHAR) AS crif_buergel_lookup_id,
           'uc_credit_used_instalment' AS rejects
    FROM o
    """
)
def policy_projection(spark, sf_dir):
    """All 55 policy columns, typed ones and documents, out of one JSON text per order."""
    policies = _policies(table(spark, sf_dir, "orders"))
    rows = project_json(policies, "main_policy", POLICY_FIELDS, rejects="rejects").drop("main_policy")
    utc = F.to_utc_timestamp("uc_created_at", F.current_timezone()).cast("timestamp_ntz")
    return rows.withColumns(
        {
            "uc_created_at": utc,
            "exposure": F.col("exposure").cast("double"),
            "loan_balance": F.col("loan_balance").cast("double"),
            "response_reasons": F.array_join("response_reasons", "|"),
            "rejects": F.array_join("rejects", "|"),
        }
    )


@register(
    """
    SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN ts WHEN 'click' THEN ts
           WHEN 'signup' THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END AS at
    FROM events
    """,
    name="lenient_timestamp",
)
def lenient_times(spark, sf_dir):
    """Times in ISO and mail layouts, dates, and text that is no time."""
    day, stamp = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", TEXT_TIME)
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("at "), stamp))
        .when(F.col("event_type") == "view", stamp)
        .when(F.col("event_type") == "click", F.concat(F.replace(stamp, F.lit(" "), F.lit("T")), F.lit("Z")))
        .when(F.col("event_type") == "signup", day)
        .otherwise(F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
    )
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    utc = F.to_utc_timestamp(lenient_timestamp(F.col("text")), F.current_timezone())
    return rows.select("event_id", utc.cast("timestamp_ntz").alias("at"))


@register(
    """
    SELECT p_partkey, CASE WHEN p_size < 10 THEN 0 ELSE 3 END AS items,
           CASE WHEN p_size < 10 THEN '' ELSE p_type || '/' || p_name || ', ' || p_brand || '/?' END AS text
    FROM part
    """
)
def array_text(spark, sf_dir):
    """Array text with quoted commas, nulls and empty arrays."""
    text = F.when(F.col("p_size") < 10, "{}").otherwise(
        F.concat(F.lit("{"), "p_type", F.lit(' , "'), "p_name", F.lit(", "), "p_brand", F.lit('",NULL}'))
    )
    items = array_from_text(text)
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.size(items).alias("items"), F.array_join(items, "/", "?").alias("text")
    )


@register(
    """
    SELECT c_custkey, c_mktsegment AS dataset, CAST(c_nationkey AS VARCHAR) AS model, CAST(NULL AS VARCHAR) AS further
    FROM customer
    """
)
def name_split(spark, sf_dir):
    """Parts of dotted names."""
    name = F.concat_ws(".", F.lit("source"), F.lit("project"), "c_mktsegment", "c_nationkey")
    rows = table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"))
    return rows.select(
        "c_custkey",
        name_part(F.col("name"), 2).alias("dataset"),
        name_part(F.col("name"), -1).alias("model"),
        name_part(F.col("name"), 4).alias("further"),
    )


@register(
    """
    SELECT p_partkey, CASE WHEN upper(substr(p_name, 1, 2)) IN ('SM', 'RE', 'BL') THEN upper(substr(p_name, 1, 2))
           ELSE 'SM' END AS country_code
    FROM part
    """
)
def country_from_name(spark, sf_dir):
    """Country code from a name prefix, with a default."""
    return table(spark, sf_dir, "part").select(
        "p_partkey", country_prefix(F.col("p_name"), ["SM", "RE", "BL"], "SM").alias("country_code")
    )


def _responses(orders):
    """Orders as rate responses: three series each, or a fault."""

    def series(name: str, unit, value):
        return F.concat(
            F.lit(f"<series><seriesid>{name}1</seriesid><seriesname>{name}</seriesname><unit>"),
            unit.cast("string"),
            F.lit("</unit><ultimo>"),
            value.cast("string"),
            F.lit("</ultimo></series>"),
        )

    unit = F.when(F.col("o_orderstatus") == "O", 100).otherwise(1)
    good = F.concat(
        F.lit('<soap:Envelope xmlns:soap="http://www.w3.org/2003/05/soap-envelope"><soap:Body><groups>'),
        series("USD", unit, cents("o_totalprice")),
        series("GBP", F.lit(1), F.col("o_custkey")),
        series("EUR", F.lit(1), F.col("o_custkey")),
        F.lit("</groups></soap:Body></soap:Envelope>"),
    )
    fault = F.concat(
        F.lit('<SOAP-ENV:Envelope xmlns:SOAP-ENV="http://www.w3.org/2003/05/soap-envelope"><SOAP-ENV:Body>'),
        F.lit("<SOAP-ENV:Fault><SOAP-ENV:Reason><SOAP-ENV:Text>no rate for "),
        F.col("o_orderpriority"),
        F.lit("</SOAP-ENV:Text></SOAP-ENV:Reason></SOAP-ENV:Fault></SOAP-ENV:Body></SOAP-ENV:Envelope>"),
    )
    return orders.select(
        "o_orderkey", F.col("o_orderdate").alias("day"), F.when(F.col("o_orderstatus") == "P", fault).otherwise(good).alias("body")
    )


@register(
    """
    SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS exchange_month, currency_code,
           CASE currency_code WHEN 'EUR' THEN CAST(o_custkey AS DOUBLE)
                ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS DOUBLE) / CASE WHEN o_orderstatus = 'O' THEN 100.0 ELSE 1.0 END
           END AS value
    FROM orders, (VALUES ('USD'), ('EUR')) c(currency_code) WHERE o_orderstatus <> 'P'
    """
)
def xml_rates(spark, sf_dir):
    """Rates per unit out of XML responses, wanted currencies only."""
    series = response_series(_responses(table(spark, sf_dir, "orders")))
    rates = monthly_rates(series, F.col("day"))
    return rates.withColumn("value", F.col("value").cast("double")).drop("day")


@register(
    """
    SELECT o_orderkey, o_orderdate AS day, 'no rate for ' || o_orderpriority AS fault
    FROM orders WHERE o_orderstatus = 'P'
    """
)
def xml_faults(spark, sf_dir):
    """Fault responses with their reason."""
    return response_faults(_responses(table(spark, sf_dir, "orders")))


@register(
    """
    WITH lists AS (
      SELECT page_id, unnest(regexp_extract_all(html, '(?is)<ul(?:\\s[^>]*)?>(.*?)</ul\\s*>', 1)) AS list FROM pages
    ), cells AS (
      SELECT page_id, unnest(list_concat(regexp_extract_all(list, '(?is)<a(?:\\s[^>]*)?>(.*?)</a\\s*>', 1),
                                         regexp_extract_all(list, '(?is)<li(?:\\s[^>]*)?>(.*?)</li\\s*>', 1))) AS raw
      FROM lists
    ), texts AS (
      SELECT page_id, trim(replace(replace(replace(replace(replace(replace(regexp_replace(raw, '(?s)<[^>]*>', '', 'g'),
             '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'),
             chr(160) || ' ' || chr(9) || chr(10) || chr(13)) AS cell
      FROM cells
    )
    SELECT page_id, cell, count(*) AS n FROM texts WHERE cell <> '' GROUP BY 1, 2
    """
)
def html_cells(spark, sf_dir):
    """Texts of list items and of their links, over whole pages."""
    rows = table(spark, sf_dir, "pages").select("page_id", F.explode(inner_parts(F.col("html"), "ul")).alias("row"))
    cells = rows.select("page_id", F.explode(row_cells(F.col("row"), "li", None)).alias("cell"))
    return cells.groupBy("page_id", "cell").agg(F.count("*").alias("n"))


def _index_pages(orders):
    """Orders as pages with a rate table."""

    def row(*cells):
        return F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>\n"))

    title = F.when(F.col("o_orderstatus") == "P", "Another index").otherwise(
        "Euribor 3 months"
    )
    rate = F.concat(F.col("o_custkey").cast("string"), F.lit(".25 %"))
    html = F.concat(
        F.lit('<html><table class="menu"><tr><td>1</td></tr></table>\n<table class="table table-striped">\n<tr><th></th><th> '),
        F.date_format("o_orderdate", "M/d/yyyy"),
        F.lit(" </th></tr>"),
        row(F.lit('<a href="/1">1 week</a>'), F.lit("1 %")),
        row(F.lit("1 month"), F.lit("2 %")),
        row(title, rate),
        F.lit("</table></html>"),
    )
    return orders.select("o_orderkey", html.alias("html"))


@register(
    """
    SELECT o_orderkey, '{"dateFrom":"' || strftime(o_orderdate, '%Y-%m-%d') || '","countryCode":"FI","type":"EURIBOR_3M","value":'
           || o_custkey || '.25}' AS value
    FROM orders WHERE o_orderstatus <> 'P' AND dayofweek(o_orderdate) NOT IN (0, 6)
    """
)
def rate_message(spark, sf_dir):
    """Index value out of HTML tables, as JSON messages, on weekdays."""
    found = index_values(_index_pages(table(spark, sf_dir, "orders")))
    return found.select("o_orderkey", index_message(F.col("day"), F.col("value")).alias("value"))


@register(
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
           CASE WHEN o_orderstatus <> 'P' AND dayofweek(o_orderdate) NOT IN (0, 6) THEN o_custkey + 0.25 END::DOUBLE AS value,
           CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 'not a banking day' WHEN o_orderstatus = 'P' THEN 'not found'
                ELSE 'found' END AS outcome
    FROM orders
    """
)
def index_outcome(spark, sf_dir):
    """Each page with its outcome: value found, renamed row, or weekend."""
    orders = table(spark, sf_dir, "orders")
    pages = _index_pages(orders).join(orders.select("o_orderkey", F.to_date("o_orderdate").alias("fetched")), "o_orderkey")
    found = index_outcomes(pages, F.col("fetched")).drop("fetched")
    return found.withColumn("value", F.col("value").cast("double"))


@register(
    """
    SELECT '{"dateFrom":"' || strftime(o_orderdate, '%Y-%m-%d') || '","countryCode":"FI","type":"TOTAL","value":' || o_custkey || '.0}' AS value
    FROM orders WHERE dayofweek(o_orderdate) NOT IN (0, 6)
    """
)
def message_sink(spark, sf_dir):
    """Messages written one per line and read back."""
    path = shared_path(spark, "message_sink")
    weekdays = table(spark, sf_dir, "orders").filter("dayofweek(o_orderdate) not in (1, 7)")
    write_messages(messages(weekdays, index_message(F.col("o_orderdate"), F.col("o_custkey"), "TOTAL")), path)
    return spark.read.text(path)


@register("SELECT doc_id, text AS signed_text FROM documents")
def signature_decode(spark, sf_dir):
    """Signed text out of base64 XML signatures, over whole texts."""
    documents = table(spark, sf_dir, "documents")
    signature = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><Signature xmlns="http://www.w3.org/2000/09/xmldsig#"><Object>'),
        F.lit('<bankIdSignedData xmlns="http://www.bankid.com/signature/v1.0.0/types"><usrVisibleData charset="UTF-8">'),
        F.base64(F.encode("text", "UTF-8")),
        F.lit("</usrVisibleData></bankIdSignedData></Object></Signature>"),
    )
    signed = documents.select("doc_id", F.base64(F.encode(signature, "UTF-8")).alias("signature"))
    return signed.select("doc_id", signed_text(F.col("signature")).alias("signed_text"))


def _landed(spark, reports, name, schema):
    """Report texts written as landed files, packed, and read in the layout of the report."""
    path = shared_path(spark, name)
    write_messages(reports, path, "lz4")
    return read_ndjson(spark, path, schema)


@register(
    """
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, l_orderkey AS campaign_id, 'SEARCH' AS ad_channel_type,
           '{"appName":"app ' || l_linenumber || '","adamId":' || l_partkey || '}' AS app_dict,
           'campaign ' || l_suppkey AS campaign_name, CAST(NULL AS VARCHAR) AS campaign_status,
           l_linestatus || ',' || l_returnflag AS countries, false AS deleted, 'RUNNING' AS display_status,
           CAST(NULL AS VARCHAR) AS modification_time, CAST(NULL AS VARCHAR) AS serving_status,
           l_extendedprice AS total_budget, CAST(0 AS DOUBLE) AS total_remaining_budget,
           CAST(l_quantity AS BIGINT) AS impressions, l_discount AS local_spend, 'EUR' AS currency_code,
           CAST(0 AS BIGINT) AS new_downloads, CAST(0 AS BIGINT) AS redownloads, l_suppkey AS taps
    FROM lineitem WHERE l_discount <> 0
    """
)
def apple_ads(spark, sf_dir):
    """Campaign reports (nested JSON text) to flat rows with spend."""
    report = F.to_json(
        F.struct(
            F.struct(
                F.col("l_orderkey").alias("campaignId"),
                F.lit("SEARCH").alias("adChannelType"),
                F.struct(
                    F.concat(F.lit("app "), F.col("l_linenumber")).alias("appName"), F.col("l_partkey").alias("adamId")
                ).alias("app"),
                F.concat(F.lit("campaign "), F.col("l_suppkey")).alias("campaignName"),
                F.array("l_linestatus", "l_returnflag").alias("countriesOrRegions"),
                F.lit("RUNNING").alias("displayStatus"),
                F.struct(F.col("l_extendedprice").alias("amount")).alias("totalBudget"),
            ).alias("metadata"),
            F.array(
                F.struct(
                    F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
                    F.col("l_quantity").cast("bigint").alias("impressions"),
                    F.struct(F.col("l_discount").cast("string").alias("amount"), F.lit("EUR").alias("currency")).alias("localSpend"),
                    F.col("l_suppkey").alias("taps"),
                )
            ).alias("granularity"),
        )
    )
    reports = table(spark, sf_dir, "lineitem").select(report.alias("value"))
    return apple_rows(_landed(spark, reports, "apple_ads", APPLE_SCHEMA))


@register(
    """
    WITH days AS (
      SELECT *, CASE WHEN n = 1 THEN value ELSE value - 20 END AS v, n FROM events, (VALUES (1), (2)) d(n)
    )
    SELECT CAST(ts + INTERVAL 1 HOUR AS DATE) AS date, 'ad' || event_id AS ad_id,
           event_type AS ad_name, CAST(NULL AS VARCHAR) AS ad_squad_id, CAST(NULL AS VARCHAR) AS creative_id,
           'c' || user_id AS campaign_id, substr(event_type, 1, 2) || '_' || user_id AS campaign_name,
           upper(substr(event_type, 1, 2)) AS country_code, v * 1000000 / 1000000 * 1.25 AS spend, 'EUR' AS currency_code,
           event_id AS impressions, CAST(n AS BIGINT) AS swipes, CAST(NULL AS DOUBLE) AS swipe_up_percent,
           CAST(0 AS BIGINT) AS view_time_millis, CAST(0 AS BIGINT) AS screen_time_millis,
           CAST(0 AS BIGINT) AS video_views, CAST(0 AS BIGINT) AS android_installs, CAST(0 AS BIGINT) AS ios_installs,
           user_id AS uniques
    FROM days WHERE v > 0
    """
)
def snapchat_ads(spark, sf_dir):
    """Campaigns -> advertisements -> daily stats (nested JSON text) to flat rows with spend."""

    def stats(value, n: int):
        return F.struct(
            F.struct(
                (value * 1_000_000).alias("spend"),
                F.col("event_id").alias("impressions"),
                F.lit(n).cast("bigint").alias("swipes"),
                F.col("user_id").alias("uniques"),
            ).alias("stats")
        )

    campaign = F.struct(
        F.struct(
            F.concat(F.lit("c"), F.col("user_id")).alias("id"),
            F.concat_ws("_", F.substring("event_type", 1, 2), "user_id").alias("name"),
        ).alias("campaign"),
        F.array(
            F.struct(
                F.struct(F.concat(F.lit("ad"), F.col("event_id")).alias("id"), F.col("event_type").alias("name")).alias("ad"),
                F.array(stats(F.col("value"), 1), stats(F.col("value") - 20, 2)).alias("timeseries"),
            )
        ).alias("ads"),
    )
    at = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    report = F.to_json(F.struct(at.alias("execution_ts"), F.array(campaign).alias("campaigns")))
    reports = table(spark, sf_dir, "events").select(report.alias("value"))
    return snapchat_rows(_landed(spark, reports, "snapchat_ads", SNAPCHAT_SCHEMA))


@register(
    """
    SELECT date_trunc('day', ts) AS date, event_id AS ad_id,
           CASE WHEN event_type IN ('signup', 'error') THEN CASE event_type WHEN 'signup' THEN 'FI' ELSE 'DE' END ELSE 'SE' END AS country_code,
           'SEK' AS currency_code, event_type AS ad_name, user_id AS campaign_id,
           CASE event_type WHEN 'signup' THEN 'fi_' WHEN 'error' THEN 'De ' ELSE 'xx ' END || user_id AS campaign_name,
           value * 1.25 AS spend, CAST(event_id AS BIGINT) AS clicks, CAST(NULL AS BIGINT) AS follows, 'NO' AS account_country
    FROM events WHERE value > 20
    """
)
def tiktok_ads(spark, sf_dir):
    """Dimension and metric lists (nested JSON text) to flat rows with spend and a derived country."""
    name = F.concat(
        F.when(F.col("event_type") == "signup", "fi_").when(F.col("event_type") == "error", "De ").otherwise("xx "),
        F.col("user_id").cast("string"),
    )
    # values of at most 20 have spend 0
    spend = F.when(F.col("value") > 20, F.col("value")).otherwise(0.0).cast("string")
    report = F.to_json(
        F.struct(
            F.lit("NO").alias("account_country"),
            F.array(
                F.struct(
                    F.struct(
                        F.date_format("ts", "yyyy-MM-dd 00:00:00").alias("stat_time_day"), F.col("event_id").alias("ad_id")
                    ).alias("dimensions"),
                    F.struct(
                        F.col("event_type").alias("ad_name"),
                        F.col("user_id").alias("campaign_id"),
                        name.alias("campaign_name"),
                        spend.alias("spend"),
                        F.col("event_id").alias("clicks"),
                    ).alias("metrics"),
                )
            ).alias("list"),
        )
    )
    reports = table(spark, sf_dir, "events").select(report.alias("value"))
    landed = _landed(spark, reports, "tiktok_ads", TIKTOK_SCHEMA)
    return plain_times(tiktok_rows(landed)).select(
        "date", "ad_id", "country_code", "currency_code", "ad_name", "campaign_id", "campaign_name", "spend", "clicks",
        "follows", "account_country",
    )

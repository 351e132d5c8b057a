"""Reference rates from landed responses and pages."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.functions.html import first_table, inner_parts, row_cells
from lakeferry.functions.xml import fault_text

# Currencies that are kept, and the published index.
CURRENCIES = ("USD", "NOK", "EUR")
INDEX_TITLE = "Euribor 3 months"
INDEX_TYPE = "EURIBOR_3M"
INDEX_COUNTRY = "FI"
INDEX_TABLE_CLASS = "table table-striped"

SERIES_COLUMNS = ("seriesname", "unit", "ultimo")
SERIES_SCHEMA = ", ".join(f"{c} string" for c in SERIES_COLUMNS)
VALUE_TYPE = "decimal(38,9)"


def response_series(responses: DataFrame, body: str = "body") -> DataFrame:
    """One row per ``series`` element of the responses, whatever it is nested in."""
    others = [c for c in responses.columns if c != body]
    elements = F.regexp_extract_all(F.col(body), F.lit(r"(?s)<series(?:\s[^>]*)?>.*?</series\s*>"), F.lit(0))
    return (
        responses.select(*others, F.explode(elements).alias("__series"))
        .select(*others, F.from_xml("__series", SERIES_SCHEMA).alias("__s"))
        .select(*others, "__s.*")
    )


def response_faults(responses: DataFrame, body: str = "body") -> DataFrame:
    """Responses that report an error, with its text."""
    return responses.withColumn("fault", fault_text(F.col(body))).filter("fault is not null").drop(body)


def without_faults(responses: DataFrame, body: str = "body") -> DataFrame:
    """Same responses, but the job fails with the error text of a fault response."""
    fault = fault_text(F.col(body))
    checked = F.when(fault.isNull(), F.col(body)).otherwise(
        F.raise_error(F.concat(F.lit("failed to fetch rates: "), fault)).cast("string")
    )
    return responses.withColumn(body, checked)


def monthly_rates(series: DataFrame, day: Column, currencies: Sequence[str] = CURRENCIES) -> DataFrame:
    """Rate of one unit per month and currency; other columns are kept."""
    others = [c for c in series.columns if c not in SERIES_COLUMNS]
    value = F.col("ultimo").cast("double") / F.col("unit").cast("double")
    return series.filter(F.col("seriesname").isin(*currencies)).select(
        *others,
        F.trunc(day, "MM").alias("exchange_month"),
        F.col("seriesname").alias("currency_code"),
        value.cast(VALUE_TYPE).alias("value"),
    )


def index_values(
    pages: DataFrame,
    html: str = "html",
    title: str = INDEX_TITLE,
    table_class: str = INDEX_TABLE_CLASS,
    fetch_day: date | Column | None = None,
) -> DataFrame:
    """Index value per landed page: date in the first cell, value in the fourth row.

    A page without the expected title or without a number, of another day than
    ``fetch_day`` or of a weekend day gives no row.
    """
    others = [c for c in pages.columns if c != html]
    head, rate = F.col("__cells.head"), F.col("__cells.rate")
    # only the two rows that matter are taken apart, step by step, so that no step is repeated
    found = (
        pages.select(*others, first_table(F.col(html), table_class).alias("__table"))
        .select(*others, inner_parts(F.col("__table"), "tr").alias("__rows"))
        .select(*others, F.get("__rows", F.lit(0)).alias("__head"), F.get("__rows", F.lit(3)).alias("__rate"))
        # exploding an array of one item keeps the filter below from moving in front of this
        .select(
            *others,
            F.explode_outer(
                F.array(F.struct(row_cells(F.col("__head")).alias("head"), row_cells(F.col("__rate")).alias("rate")))
            ).alias("__cells"),
        )
        .select(
            *others,
            F.try_to_timestamp(F.get(head, F.lit(0)), F.lit("M/d/yyyy")).cast("date").alias("day"),
            F.get(rate, F.lit(0)).alias("__title"),
            F.substring_index(F.get(rate, F.lit(1)), " ", 1).try_cast("decimal(18,6)").alias("value"),
        )
        .filter((F.col("__title") == title) & is_weekday(F.col("day")) & F.col("value").isNotNull())
        .drop("__title")
    )
    if fetch_day is not None:
        found = found.filter(F.col("day") == (fetch_day if isinstance(fetch_day, Column) else F.lit(fetch_day)))
    return found


# What a page gave for the day it was fetched on.
FOUND, NOT_FOUND, CLOSED = "found", "not found", "not a banking day"


def index_outcomes(
    pages: DataFrame, fetch_day: date | Column, html: str = "html", title: str = INDEX_TITLE, table_class: str = INDEX_TABLE_CLASS
) -> DataFrame:
    """One row per page: day, value and outcome, so that a page without a value is told from a weekend."""
    day = fetch_day if isinstance(fetch_day, Column) else F.lit(fetch_day)
    rows = inner_parts(first_table(F.col(html), table_class), "tr")
    head, rate = row_cells(F.get(rows, F.lit(0))), row_cells(F.get(rows, F.lit(3)))
    shown = F.try_to_timestamp(F.get(head, F.lit(0)), F.lit("M/d/yyyy")).cast("date")
    number = F.substring_index(F.get(rate, F.lit(1)), " ", 1).try_cast("decimal(18,6)")
    fits = (F.get(rate, F.lit(0)) == title) & (shown == day)
    value = F.when(is_weekday(day) & F.coalesce(fits, F.lit(False)), number)
    outcome = F.when(~is_weekday(day), CLOSED).when(value.isNull(), NOT_FOUND).otherwise(FOUND)
    return pages.select(
        *[c for c in pages.columns if c != html], day.alias("day"), value.alias("value"), outcome.alias("outcome")
    )


def is_weekday(day: Column) -> Column:
    return ~F.dayofweek(day).isin(1, 7)


def index_message(
    day: Column, value: Column, index_type: str = INDEX_TYPE, country: str = INDEX_COUNTRY
) -> Column:
    """JSON message for one index value; the value is a number."""
    return F.to_json(
        F.struct(
            F.date_format(day, "yyyy-MM-dd").alias("dateFrom"),
            F.lit(country).alias("countryCode"),
            F.lit(index_type).alias("type"),
            value.cast("double").alias("value"),
        )
    )

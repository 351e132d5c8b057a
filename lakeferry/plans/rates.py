"""Loads of monthly currency rates and of the daily index."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.operators.guards import CheckFailed
from lakeferry.operators.merge import upsert
from lakeferry.operators.rates import (
    CLOSED,
    FOUND,
    index_message,
    index_outcomes,
    index_values,
    monthly_rates,
    response_series,
    without_faults,
)
from lakeferry.sinks.messages import messages
from lakeferry.sinks.tables import publish

RATE_KEYS = ("exchange_month", "currency_code")


def load_rates(spark: SparkSession, responses: DataFrame, day: date, rates_view: str, root: str) -> bool:
    """Merge the rates of landed responses into the rate table; False when there are none."""
    new = monthly_rates(response_series(without_faults(responses)), F.lit(day)).select(*RATE_KEYS, "value")
    if new.isEmpty():
        return False
    if spark.catalog.tableExists(rates_view):
        new = upsert(spark.table(rates_view), new, RATE_KEYS)
    publish(spark, new, rates_view, root)
    return True


def require_index(pages: DataFrame, fetch_day: date) -> str:
    """Outcome of the day's fetch; fails when it is a banking day and no page has the value."""
    outcomes = {r["outcome"] for r in index_outcomes(pages, fetch_day).select("outcome").distinct().collect()}
    if FOUND in outcomes or outcomes == {CLOSED}:
        return FOUND if FOUND in outcomes else CLOSED
    raise CheckFailed(f"no index value for {fetch_day}")


def index_messages(pages: DataFrame, fetch_day: date) -> DataFrame:
    """Message for the day's index value; empty on weekends and when the page has no value for the day."""
    found = index_values(pages, fetch_day=fetch_day)
    return messages(found, index_message(F.col("day"), F.col("value")))

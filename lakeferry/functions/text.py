"""Small text helpers for names and report rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_part(name: Column, index: int) -> Column:
    """Part of a dotted name, counted from 0 (negative: from the end); null when it is missing."""
    return F.try_element_at(F.split(name, r"\."), F.lit(index + 1 if index >= 0 else index))


def leading_word(name: Column, separator: str = "_") -> Column:
    """Upper-cased text in front of the first separator (the whole text without one)."""
    return F.upper(F.substring_index(name, separator, 1))


def country_prefix(name: Column, allowed: Sequence[str], default: str) -> Column:
    """First two letters as a country code; the default when they are not an allowed country."""
    code = F.upper(F.substring(name, 1, 2))
    return F.when(code.isin(*allowed), code).otherwise(F.lit(default))


def local_day(instant: Column, zone: str) -> Column:
    """Calendar day of a timestamp in a zone, right on clock-change days as well."""
    return F.to_date(F.convert_timezone(None, F.lit(zone), instant.cast("timestamp_ntz")))

"""Instants and days in UTC, whatever the session zone is."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ZONE = r":[\d.]+\s*(Z|UTC|GMT|[+-]\d{1,2}(:?\d{2})?|[A-Za-z]+/[A-Za-z_/]+)$"


def zoned_text(text: Column) -> Column:
    """The text of a date or time with a zone: ``Z`` is added where none is given, midnight where there is no time."""
    text = F.trim(text)
    with_time = F.when(text.rlike(r"\d:\d"), text).otherwise(F.concat(text, F.lit(" 00:00:00")))
    return F.when(with_time.rlike(_ZONE), with_time).otherwise(F.concat(with_time, F.lit("Z")))


def instant(column: Column, dtype: T.DataType, lenient: bool = False) -> Column:
    """Timestamp of a text, date or time without a zone, which are read as UTC; ``lenient`` gives null for bad text."""
    if isinstance(dtype, T.TimestampType):
        return column
    if isinstance(dtype, T.StringType):
        text = zoned_text(column)
    elif isinstance(dtype, T.TimestampNTZType | T.DateType):
        text = zoned_text(column.cast("string"))
    else:
        text = column
    return text.try_cast("timestamp") if lenient else text.cast("timestamp")


def instant_literal(value: datetime | str) -> Column:
    """A fixed instant; without a zone it is UTC."""
    if isinstance(value, datetime):
        value = (value if value.tzinfo else value.replace(tzinfo=UTC)).isoformat(sep=" ")
    return instant(F.lit(value), T.StringType())


def day_of(column: Column, dtype: T.DataType) -> Column:
    """Day of a date or time; of an instant the day in UTC."""
    if isinstance(dtype, T.TimestampType):
        return F.date_from_unix_date(F.floor(F.unix_micros(column) / F.lit(86_400_000_000)).cast("int"))
    return F.to_date(column)

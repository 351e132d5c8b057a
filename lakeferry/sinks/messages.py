"""Messages: one JSON text per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame


def messages(df: DataFrame, message: Column) -> DataFrame:
    """The one-column form that message sinks take."""
    return df.select(message.alias("value"))


def publish_messages(rows: DataFrame, topic: str, options: Mapping[str, str]) -> None:
    """Send the rows to a topic; ``options`` name the brokers."""
    rows.write.format("kafka").options(**options).option("topic", topic).save()


#: Messages in a packed file, which is read by one task.
PACKED_MESSAGES = 250_000


def write_messages(rows: DataFrame, path: str, compression: str | None = None) -> None:
    """Write the rows as text files, one message per line; packed ones are of bounded size, as they are not split."""
    writer = rows.write.mode("overwrite")
    if compression:
        writer = writer.options(compression=compression, maxRecordsPerFile=PACKED_MESSAGES)
    writer.text(path)

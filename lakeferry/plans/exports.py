"""Export of what changed in a table since the last export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lakeferry.operators.merge import table_diff
from lakeferry.sinks.tables import current_path, switch, write_ndjson, write_snapshot


def export_changes(
    spark: SparkSession, table: DataFrame, keys: Sequence[str], previous: str, root: str, path: str
) -> None:
    """Write the changes since the previous state as JSON, then keep this state as the previous one.

    The state that is compared is the copy that is kept, so rows that arrive during the
    export are in the next one.
    """
    older = current_path(spark, previous)
    before = table.limit(0) if older is None else spark.read.parquet(older)
    copy = write_snapshot(table, root)
    write_ndjson(table_diff(before, spark.read.parquet(copy), keys), path)
    switch(spark, previous, copy)


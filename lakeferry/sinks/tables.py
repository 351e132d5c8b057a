"""Parquet tables: append, day reload, and snapshots that replace a table at once."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeferry.functions.normalize import quoted
from lakeferry.functions.times import day_of
from lakeferry.operators.guards import CheckFailed
from lakeferry.sources.files import BAD_ROW, MAX_BAD_ROWS, read_csv
from lakeferry.spec import TableSpec

DAY = "_day"
PATH_PROPERTY = "current_path"
GROWN_PROPERTY = "grown"
#: Folder beside the versions of a table for rows that did not fit.
REJECTS = "rejects"
# Layout of written CSV: header, quotes doubled inside quotes, texts not trimmed.
CSV_LAYOUT = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def with_day(df: DataFrame, column: str) -> DataFrame:
    """Add the partition day of a date or timestamp column, in UTC."""
    return df.withColumn(DAY, day_of(F.col(quoted(column)), df.schema[column].dataType))


def append_raw(df: DataFrame, path: str, day_column: str | None) -> None:
    """Append row versions, partitioned by day.

    Spark balances the write: a day with very many rows is split into several files
    and small days do not make one file per task.
    """
    if day_column is None:
        df.write.mode("append").parquet(path)
    else:
        balanced(with_day(df, day_column), [DAY]).write.mode("append").partitionBy(DAY).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions that occur in ``df``; no rows, no change."""
    (
        balanced(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def require_value(df: DataFrame, column: str, expected: Column) -> DataFrame:
    """Same rows, but the job fails at a row whose ``column`` is another value."""
    ok = F.coalesce(F.col(column) == expected, F.lit(False))
    text = F.concat(F.lit(f"unexpected {column}: "), F.coalesce(F.col(column).cast("string"), F.lit("null")))
    kind = df.schema[column].dataType
    return df.withColumn(column, F.when(ok, F.col(column)).otherwise(F.raise_error(text).cast(kind)))


def reload_day(spark: SparkSession, df: DataFrame, path: str, day_column: str, day: date) -> None:
    """Replace one day of an existing day-partitioned table; a day without rows becomes empty.

    Fails when the table is absent or a row is of another day.
    """
    known = spark.read.parquet(path).columns
    if DAY not in known:
        raise ValueError(f"the table at {path} is not partitioned by day")
    rows = require_value(with_day(df, day_column), DAY, F.lit(day))
    missing = [c for c in known if c not in rows.columns]
    rows = rows.withColumns({c: F.lit(None).cast(spark.read.parquet(path).schema[c].dataType) for c in missing})
    # the rows are counted by the write itself
    seen = Observation()
    replace_partitions(rows.observe(seen, F.count(F.lit(1)).alias("rows")), path, [DAY])
    if not observed(seen, "rows"):
        rows.drop(DAY).limit(0).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{DAY}={day.isoformat()}")


def observed(seen: Observation, name: str) -> int:
    """Number that a write has counted."""
    try:
        return seen.get[name]
    except Py4JJavaError:
        # Spark leaves no numbers of a plan that it knows to be empty
        return 0


def clustered(df: DataFrame, partition_by: Sequence[str], cluster_by: Sequence[str]) -> DataFrame:
    """Lay rows out by partition and cluster columns.

    Ranges over both spread a large day over many tasks, each with its own range of
    keys, so file statistics let readers skip by key.
    """
    return laid_out(df, [F.col(quoted(c)) for c in [*partition_by, *cluster_by]])


def laid_out(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-partition and sort rows.

    The task that a row comes from is the last part of its range, so rows that are equal
    in all order columns, even copies of one row, are still spread over several tasks.
    """
    return (
        df.withColumn("__task", F.spark_partition_id())
        .repartitionByRange(*order, F.col("__task"))
        .sortWithinPartitions(*order)
        .drop("__task")
    )


def write_snapshot(
    df: DataFrame,
    root: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    keep_layout: bool = False,
) -> str:
    """Write a new version of a table beside the older ones and return its path.

    ``keep_layout`` is for rows that are laid out already.
    """
    path = f"{root.rstrip('/')}/version={uuid.uuid4().hex}"
    if keep_layout:
        rows = df
    else:
        rows = clustered(df, partition_by, cluster_by) if cluster_by else balanced(df, partition_by)
    rows.write.partitionBy(*partition_by).parquet(path)
    try:
        df.sparkSession.read.parquet(path)
    except AnalysisException:
        # a partitioned write without rows leaves no file that holds the schema
        df.limit(0).write.mode("append").parquet(path)
    return path


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Let Spark even out the files of a partitioned write: large partitions are split, small ones joined."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def switch(spark: SparkSession, name: str, path: str, grown: bool = False) -> None:
    """Let readers of ``name`` see the version at ``path`` from now on.

    The view is replaced in one catalog step, so readers see the old or the new
    version, and a failed write changes nothing. The partition day is not shown.
    ``grown``: files of the version differ in their columns; a column that a file
    lacks is null in its rows. Only such a version has all its file footers read.
    """
    options = " with ('mergeSchema' = 'true')" if grown else ""
    rows = spark.sql(f"select * from parquet.`{path}`{options}")
    columns = ", ".join(quoted(c) for c in rows.columns if c != DAY)
    properties = f"'{PATH_PROPERTY}' = '{path}', '{GROWN_PROPERTY}' = '{str(grown).lower()}'"
    spark.sql(f"create or replace view {name} tblproperties ({properties}) as select {columns} from parquet.`{path}`{options}")


def current_path(spark: SparkSession, name: str) -> str | None:
    """Path of the version that readers of ``name`` see; None when there is no such table.

    A table that was not published here has no such path and is refused.
    """
    if not spark.catalog.tableExists(name):
        return None
    path = _properties(spark, name).get(PATH_PROPERTY)
    if path is None:
        raise ValueError(f"{name} is no table of this toolkit")
    return path


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"show tblproperties {name}").collect()}


def append_to(spark: SparkSession, df: DataFrame, name: str, day_column: str | None) -> None:
    """Append row versions to a table and show the columns that came with them."""
    path = current_path(spark, name)
    if path is None:
        raise ValueError(f"there is no table {name}")
    append_raw(df, path, day_column)
    if set(df.columns) - set(spark.table(name).columns):
        switch(spark, name, path, grown=True)


def drop_old_versions(spark: SparkSession, name: str, root: str, keep: int = 1) -> list[str]:
    """Delete the versions below ``root`` but the one readers see and the ``keep`` newest others; returns their paths.

    Nothing runs this by itself: a version may still be read by a running job.
    """
    current = current_path(spark, name)
    if current is None:
        raise ValueError(f"there is no table {name}")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s for s in store.listStatus(folder) if s.getPath().getName().startswith("version=")]
    others = [s for s in found if s.getPath().getName() != current.rstrip("/").rsplit("/", 1)[-1]]
    others.sort(key=lambda s: s.getModificationTime(), reverse=True)
    dropped = [s.getPath() for s in others[keep:]]
    for path in dropped:
        store.delete(path, True)
    return [p.toString() for p in dropped]


def publish(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    root: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    keep_layout: bool = False,
) -> str:
    """Replace a table; ``df`` may read the version that is replaced."""
    path = write_snapshot(df, root, partition_by, cluster_by, keep_layout)
    switch(spark, name, path)
    return path


def checked_rows(rows: DataFrame, root: str, max_bad_rows: int) -> tuple[DataFrame, int]:
    """The good rows of a file read and the number of bad ones, both written below ``root``.

    The source is read once. Bad rows are kept in ``root``/rejects with their flag, whatever the outcome. Beyond the
    limit the load fails, and nothing that readers see has changed.
    """
    path = f"{root.rstrip('/')}/checked={uuid.uuid4().hex}"
    seen = Observation()
    flagged = rows.observe(seen, F.count_if(BAD_ROW).alias("bad_rows"))
    flagged.write.partitionBy(BAD_ROW).parquet(path)
    found = observed(seen, "bad_rows")
    back = rows.sparkSession.read.schema(rows.schema).parquet(path)
    if found:
        back.filter(BAD_ROW).write.mode("append").parquet(f"{root.rstrip('/')}/{REJECTS}")
    if found > max_bad_rows:
        raise CheckFailed(f"{found} bad rows, at most {max_bad_rows} are allowed")
    return back.filter(f"not {BAD_ROW}").drop(BAD_ROW), found


def publish_checked(spark: SparkSession, rows: DataFrame, name: str, root: str, max_bad_rows: int) -> int:
    """Replace a table with the good rows of a file read, unless too many rows are bad.

    The bad rows are counted by the write itself and kept in ``root``/rejects. Beyond the
    limit the load fails and readers keep the old version. Returns the number of bad rows.
    """
    seen = Observation()
    bad = F.count_if(BAD_ROW)
    good = rows.observe(seen, bad.alias("bad_rows")).filter(f"not {BAD_ROW}").drop(BAD_ROW)
    path = write_snapshot(good, root)
    found = observed(seen, "bad_rows")
    if found:
        rows.filter(BAD_ROW).write.mode("append").parquet(f"{root.rstrip('/')}/{REJECTS}")
    if found > max_bad_rows:
        raise CheckFailed(f"{found} bad rows, at most {max_bad_rows} are allowed")
    switch(spark, name, path)
    return found


def csv_to_ndjson(
    spark: SparkSession,
    source: str,
    target: str,
    spec: TableSpec,
    header_rows: int = 0,
    max_bad_rows: int = MAX_BAD_ROWS,
) -> int:
    """Rewrite a CSV export as JSON with real arrays and exact decimals, in as many files as tasks.

    Bad rows are left out and kept beside the target, unless there are too many: then the target stays as it was.
    """
    rows = read_csv(spark, source, spec.spark_schema(), header_rows)
    good, bad = checked_rows(rows, beside(target), max_bad_rows)
    write_ndjson(good, target)
    return bad


def beside(path: str) -> str:
    """Folder for what belongs to the loads of the table at ``path``."""
    return f"{path.rstrip('/')}.load"


def write_ndjson(df: DataFrame, path: str) -> None:
    """Newline-delimited JSON; null fields are written."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """CSV with a header line per file; blanks at the ends of texts are kept."""
    df.write.mode("overwrite").options(**CSV_LAYOUT).csv(path)


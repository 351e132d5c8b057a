"""Upsert, delete-then-insert and table diff on plain DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Same rows, but the job fails when a key occurs twice.

    Copies of a key are folded map-side, so a key with very many copies does not
    gather in one task before the failure is raised.
    """
    values = [c for c in df.columns if c not in keys]
    folded = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.max(F.struct(F.lit(0), *values)).alias("__row")
    )
    once = F.col("__n") == 1
    key_text = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    checked = F.when(
        F.when(once, F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("more than one row for key "), key_text)).cast("boolean")
        ),
        F.col("__row"),
    )
    folded = folded.withColumn("__row", checked)
    return folded.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the source, plus all source rows.

    Keys must be unique in the source. A small source is broadcast by Spark on its
    measured size, and then the target is not shuffled at all.
    """
    source = source.select(*target.columns)
    return without_keys(target, source, keys).unionByName(unique_rows(source, keys))


def without_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``."""
    right = other.select(*[F.col(k).alias(f"__other_{k}") for k in keys])
    return df.join(right, _and([df[k] == right[f"__other_{k}"] for k in keys]), "left_anti")


def delete_insert(target: DataFrame, rows: DataFrame, deleted: Column) -> DataFrame:
    """Target without the rows where ``deleted`` holds, plus the new rows."""
    return target.filter(~F.coalesce(deleted, F.lit(False))).unionByName(rows)


def table_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that were inserted, updated or deleted between two states of a table.

    Returns ``change`` and the columns of ``new`` (of ``old`` for deleted rows).
    Values are compared null-safe. Both states go through one shuffle on the key and
    are sorted once, after it: at most two rows have a key, so nothing could be folded
    before. A key that occurs twice in one state fails the job.
    """
    columns = new.columns
    values = [c for c in columns if c not in keys]
    row = F.struct(F.lit(0).alias("__some"), *values).alias("__row")
    is_old = F.col("__is_old")
    # the old row of a key comes first, so it is the one before the new row
    old_first = Window.partitionBy(*keys).orderBy(is_old.desc())
    same_key = old_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sides = (
        old.select(*keys, row, F.lit(True).alias("__is_old"))
        .unionByName(new.select(*keys, row, F.lit(False).alias("__is_old")))
        .withColumns(
            {
                "__n_old": F.count_if(is_old).over(same_key),
                "__n_new": F.count_if(~is_old).over(same_key),
                "__before": F.lag("__row").over(old_first),
            }
        )
        # one row stands for the key: the new one, or the old one of a deleted key
        .filter(~is_old | (F.col("__n_new") == 0))
    )
    change = (
        F.when(
            (F.col("__n_old") > 1) | (F.col("__n_new") > 1),
            F.raise_error(F.lit("a key occurs twice in one table state")).cast("string"),
        )
        .when(F.col("__n_old") == 0, F.lit("insert"))
        .when(F.col("__n_new") == 0, F.lit("delete"))
        .when(~F.col("__before").eqNullSafe(F.col("__row")), F.lit("update"))
    )
    changed = sides.select(*keys, change.alias("change"), "__row").filter("change is not null")
    return changed.select("change", *[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in columns])


def apply_diff(old: DataFrame, diff: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New table state from the old one and a diff."""
    kept = without_keys(old, diff, keys)
    return kept.unionByName(diff.filter("change <> 'delete'").drop("change"))


def _and(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)

"""Latest version per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def newest_versions(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Newest version value per key; null keys are left out."""
    return (
        df.filter(_all_present(df, keys))
        .groupBy(*keys)
        .agg(F.max(version).alias(version))
        .filter(F.col(version).isNotNull())
    )


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    version: str,
    ties: str = "all",
    tie_break: Sequence[Column] = (),
) -> DataFrame:
    """Rows with the newest ``version`` of their key; rows with a null key are dropped.

    ``ties="all"`` keeps every row that shares the newest version. The newest
    versions are aggregated map-side and the rows are matched on key *and*
    version, which spreads a key with very many versions over the cluster.

    ``ties="one"`` keeps one row per key, chosen by ``tie_break``. Spark cuts each
    map task to one row per key before the shuffle, so a hot key stays small.
    """
    if ties == "one":
        order = [F.desc(version), *tie_break]
        ranked = df.filter(_all_present(df, [*keys, version])).withColumn(
            "__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        )
        return ranked.filter("__rank = 1").drop("__rank")
    if ties != "all":
        raise ValueError(f"ties must be 'all' or 'one', not {ties!r}")
    names = [*keys, version]
    newest = newest_versions(df, keys, version).toDF(*[f"__newest_{n}" for n in names])
    same = reduce(lambda a, b: a & b, [df[n] == newest[f"__newest_{n}"] for n in names])
    return df.join(newest, same, "left_semi")


def _all_present(df: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [df[n].isNotNull() for n in names])

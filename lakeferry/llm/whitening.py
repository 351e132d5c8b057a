"""Whitening of embeddings: a distributed covariance, its leading components, and every vector projected on them.

Sums and products are taken in the tasks, one total for each partition, and added up in two shuffles of a fixed number
of rows for each partition. The driver holds one matrix of dimensions x dimensions, whose size does not depend on the
number of vectors; the tasks get the mean and the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeferry.llm import eigen
from lakeferry.llm.common import landed

COMPONENTS = 8
#: An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Entries are whole numbers up to this size, which doubles hold exactly; larger ones count as this.
_MOST = 1 << 53
_LONG = 1 << 63
_HALF = 26
_SALTS = 64
#: Eigenvalues up to this share of the largest, times the dimensions, are rounding errors of zero.
_NOISE = 64 * np.finfo(float).eps

_RESULT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def _entries(column: pa.Array, size: int) -> np.ndarray:
    """Whole-number entries of a batch of vectors, one row each."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    scaled = np.clip(np.floor(np.clip(flat, -_MOST, _MOST) * SCALE), -_MOST, _MOST - OFFSET)
    return (scaled.astype(np.int64) + OFFSET).reshape(-1, size)


def _sums(vectors: DataFrame, size: int) -> tuple[int, list[int]]:
    """(n, exact sums by dimension)."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            x = _entries(batch.column("embedding"), size)
            n += len(x)
            # in two halves, so that no sum of a partition leaves 64 bits
            high += (x >> _HALF).sum(axis=0)
            low += (x & ((1 << _HALF) - 1)).sum(axis=0)
        if n:
            columns = [np.arange(size, dtype=np.int32), np.full(size, n, np.int64), high, low]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["place", "n", "high", "low"])

    parts = vectors.select("embedding").mapInArrow(partial, "place int, n bigint, high bigint, low bigint")
    exact = [F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("n", "high", "low")]
    rows = parts.groupBy("place").agg(*exact).orderBy("place").collect()
    return int(rows[0]["n"]), [(int(r["high"]) << _HALF) + int(r["low"]) for r in rows]


def _covariance(vectors: DataFrame, size: int, n: int, mean: np.ndarray) -> np.ndarray:
    """Mean of the products of the centred entries."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part, some = np.zeros((size, size)), TaskContext.get().partitionId(), False
        for batch in batches:
            x = _entries(batch.column("embedding"), size) - mean
            total += x.T @ x
            some = some or len(x) > 0
        if some:
            line = pa.ListArray.from_arrays(pa.array(np.arange(0, size * size + 1, size), pa.int32()), pa.array(total.ravel()))
            keys = [pa.array(np.arange(size, dtype=np.int32)), pa.array(np.full(size, part % _SALTS, np.int32))]
            yield pa.RecordBatch.from_arrays([*keys, line], ["line", "salt", "products"])

    def added(group: pa.Table) -> pa.Table:
        whole = group["products"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size).sum(axis=0)
        keys = [group[c].slice(0, 1) for c in ("line", "salt")]
        return pa.table([*keys, pa.array([whole], pa.list_(pa.float64()))], ["line", "salt", "products"])

    schema = "line int, salt int, products array<double>"
    parts = vectors.select("embedding").mapInArrow(partial, schema)
    lines = parts.groupBy("line", "salt").applyInArrow(added, schema).groupBy("line").applyInArrow(added, schema)
    matrix = np.empty((size, size))
    for row in lines.toLocalIterator():
        matrix[row["line"]] = row["products"]
    return (matrix + matrix.T) / (2 * n)


def _projection(size: int, n: int, sums: list[int], mean: np.ndarray, directions: np.ndarray):
    """Column function of a vector: its exact deviation and its whitened components."""
    most = max(map(abs, sums))

    def deviations(x: np.ndarray) -> list[int | None]:
        if not len(x):
            return []
        if n * int(np.abs(x).max()) + most < _LONG:
            y = n * x - np.array(sums)
        else:
            y = n * x.astype(object) - np.array(sums, object)
        rough = (y.astype(float) ** 2).sum(axis=1)
        if y.dtype != object and (rough < _LONG / 2).all():
            return (y * y).sum(axis=1).tolist()
        near = [sum(int(v) ** 2 for v in row) if r < 2 * _LONG else _LONG for row, r in zip(y, rough, strict=True)]
        return [w if w < _LONG else None for w in near]

    @F.arrow_udf("struct<deviation:bigint,parts:array<double>>")
    def projected(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            x = _entries(column, size)
            parts = np.ascontiguousarray((x - mean) @ directions.T)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(directions))
            lists = pa.ListArray.from_arrays(offsets, pa.array(parts.ravel()))
            yield pa.StructArray.from_arrays([pa.array(deviations(x), pa.int64()), lists], ["deviation", "parts"])

    return projected


def _identity_error(rows: DataFrame, n: int, used: int) -> float | None:
    """Largest entry of the covariance of the first ``used`` whitened components, minus the identity."""
    if not used:
        return None
    part = [F.col("parts")[k] for k in range(used)]
    means = rows.agg(*(F.avg(p) for p in part)).first()
    pairs = [(i, j) for i in range(used) for j in range(i + 1)]
    centred = [p - F.lit(m) for p, m in zip(part, means, strict=True)]
    found = rows.agg(*(F.sum(centred[i] * centred[j]) for i, j in pairs)).first()
    return max(abs(s / n - (i == j)) for s, (i, j) in zip(found, pairs, strict=True))


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every vector and leading component.

    Vectors that are null or empty or have null, infinite or not-a-number entries are dropped, and so are those that do
    not have as many entries as most vectors (ties: the larger number). Repeated rows and ids count one by one and null
    ids are ids like others; other columns are ignored. Entries beyond 2^53 count as 2^53. ``deviation`` is null where
    it does not fit a long. There are as many components as dimensions at most; one without variance (zero but for
    rounding errors) has null ``whitened``, and ``identity_error`` leaves it out, null if there is no
    other. No vectors give no rows.
    """
    usable = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", "embedding").where("size(embedding) > 0").where(usable)
    most = rows.groupBy(F.size("embedding").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    if most is None:
        return vectors.sparkSession.createDataFrame([], f"vec_id {id_type}, {_RESULT}")
    size = most["size"]
    rows = rows.where(F.size("embedding") == size)
    n, sums = _sums(rows, size)
    mean = np.array([s / n for s in sums])
    covariance = _covariance(rows, size, n, mean)
    values, directions = eigen.leading(covariance, min(components, size))
    trace, least = float(np.trace(covariance)), _NOISE * size * max(float(values[0]), 0.0)
    used = int((values > least).sum())
    scaled = directions[:used] / np.sqrt(values[:used])[:, None]
    found = rows.select("vec_id", _projection(size, n, sums, mean, scaled)("embedding").alias("x"))
    found = landed(found.select("vec_id", "x.*"), "whitened")
    error = _identity_error(found, n, used)
    shares = [float(v) / trace if k < used else 0.0 for k, v in enumerate(values)]
    by_component = [
        F.struct(
            F.lit(k + 1).alias("component"),
            (F.col("parts")[k] if k < used else F.lit(None).cast("double")).alias("whitened"),
            F.lit(share).alias("explained"),
        )
        for k, share in enumerate(shares)
    ]
    return found.select("vec_id", "deviation", F.explode(F.array(*by_component)).alias("c")).select(
        "vec_id",
        "c.component",
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "c.whitened",
        "c.explained",
        F.lit(error).cast("double").alias("identity_error"),
    )

"""Split a table into ranges or days, each one predicate of a parallel read."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from datetime import date, datetime, timedelta
from itertools import batched, pairwise

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.sinks.storage import shared_path

#: Predicates that the driver holds at a time when rows are numbered by them.
WAVE_PREDICATES = 10_000


class Predicate(str):
    """Text of a chunk's predicate, with the first key of the chunk and of the next one; None is open."""

    low: tuple | None
    high: tuple | None

    def __new__(cls, text: str, low: Sequence | None = None, high: Sequence | None = None):
        made = super().__new__(cls, text)
        made.low, made.high = (None if b is None else tuple(b) for b in (low, high))
        return made


def range_predicates(
    column: str, lower: int, upper: int, rows_per_chunk: int, max_chunks: int | None = None
) -> list[Predicate]:
    """Predicates over a whole-number column that together cover every row exactly once.

    Chunks have the contract's size; only a caller that gives ``max_chunks`` gets wider ones.

    The first chunk also takes smaller values and nulls, the last one larger values,
    so rows that arrive while the read runs are not lost.
    """
    span = max(upper - lower + 1, 1)
    step = max(rows_per_chunk, -(-span // max_chunks) if max_chunks else 1)
    starts = list(range(lower + step, upper + 1, step))
    if not starts:
        return [Predicate("1 = 1")]
    return (
        [Predicate(f"({column} < {starts[0]} or {column} is null)", None, (starts[0],))]
        + [Predicate(f"({column} >= {a} and {column} < {b})", (a,), (b,)) for a, b in pairwise(starts)]
        + [Predicate(f"{column} >= {starts[-1]}", (starts[-1],))]
    )


def day_predicates(
    column: str, first: date, last: date, max_chunks: int | None = None, other_days: bool = True
) -> list[str]:
    """Half-open day ranges from ``first`` to ``last``, both included.

    Days are UTC. They are grouped only if the caller gives ``max_chunks``. With ``other_days``
    one more predicate takes the rows outside the range and those without a date.
    """
    days = (last - first).days + 1
    if days < 1:
        raise ValueError("the last day is before the first day")
    width = -(-days // max_chunks) if max_chunks else 1
    starts = [first + timedelta(days=i) for i in range(0, days, width)]
    end = last + timedelta(days=1)
    bounds = [*starts, end]
    predicates = [
        f"({column} >= '{midnight(a)}' and {column} < '{midnight(b)}')" for a, b in zip(bounds, bounds[1:])
    ]
    if other_days:
        predicates.append(
            f"({column} < '{midnight(first)}' or {column} >= '{midnight(end)}' or {column} is null)"
        )
    return predicates


def midnight(day: date) -> str:
    """Start of a day in UTC; databases drop the zone for columns without one."""
    return f"{day.isoformat()} 00:00:00+00"


def starts_text(columns: Sequence[str], table: str, rows_per_chunk: int, where: str | None = None) -> str:
    """Query for the first key of every chunk: the bounds of an equi-depth histogram, which the database computes.

    ``columns`` are a key, or a key and a unique column that orders rows of one key. An index on them gives the order.
    Rows without a key belong to the first chunk.
    """
    listed = ", ".join(columns)
    present = f"{columns[0]} is not null" + (f" and ({where})" if where else "")
    numbered = f"select {listed}, row_number() over (order by {listed}) as place from {table} where {present}"
    return f"select {listed} from ({numbered}) n where mod(place - 1, {rows_per_chunk}) = 0 order by {listed}"


def chunk_starts(df: DataFrame, columns: Sequence[str], rows_per_chunk: int) -> DataFrame:
    """The rows of ``starts_text`` for a DataFrame, without an order of all rows in one task.

    Keys are dealt into ranges and written once; a key's place is its place in its range and the size of the ranges
    before it, of which there is one row each.
    """
    ranged = _ranged(df.select(*columns).where(df[columns[0]].isNotNull()), columns, "chunk-keys")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__rows"))
    ahead = sizes.select(F.col("__range").alias("__own"), F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__ahead"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*columns)) - 1 + F.col("__ahead")
    placed = ranged.join(ahead, ranged["__range"] == ahead["__own"]).withColumn("__place", place)
    return placed.where(F.col("__place") % rows_per_chunk == 0).orderBy("__place").select(*columns)


def _ranged(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Rows dealt into ranges of the columns, with the number of their range; written once, so that it stays."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    dealt = df.withColumn("__task", F.spark_partition_id()).repartitionByRange(*columns, "__task").drop("__task")
    dealt.withColumn("__range", F.spark_partition_id()).write.parquet(path)
    return spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__range", T.IntegerType())])).parquet(path)


def chunk_numbers(df: DataFrame, column: str, predicates: Iterable[Predicate], name: str = "chunk") -> DataFrame:
    """Rows with the number of the predicate that they meet, out of those that cover a column one after the other.

    The predicates' bounds are written in waves and sorted in among the rows; a row's chunk is the last one that begins
    at its key or before. So neither the driver nor a plan holds all predicates, and their number costs no comparisons.
    """
    spark = df.sparkSession
    path = shared_path(spark, "chunk-bounds")
    kind = T.StructType([T.StructField(column, df.schema[column].dataType), T.StructField(name, T.LongType())])
    for wave in batched(_begins(predicates), WAVE_PREDICATES):
        spark.createDataFrame(list(wave), kind).write.mode("append").parquet(path)
    begins = spark.read.schema(kind).parquet(path)
    # what begins at a key comes before the rows of the key; null keys come first and are the first chunk's
    marked = df.withColumns({name: F.lit(None).cast("bigint"), "__row": F.lit(1)})
    marked = marked.unionByName(begins.withColumn("__row", F.lit(0)), allowMissingColumns=True)
    order = [column, "__row"]
    ranged = _ranged(marked, order, "chunk-rows")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ends = ranged.groupBy("__range").agg(F.max(name).alias("__last"))
    ahead = ends.select(F.col("__range").alias("__own"), F.max("__last").over(before).alias("__ahead"))
    upto = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = ranged.withColumn(name, F.last(name, ignorenulls=True).over(upto)).where("__row = 1")
    found = found.join(ahead, found["__range"] == ahead["__own"])
    return found.withColumn(name, F.coalesce(name, "__ahead", F.lit(0).cast("bigint"))).select(*df.columns, name)


def _begins(predicates: Iterable[Predicate]) -> Iterator[tuple]:
    """First key and number of each chunk; the first chunk is open, so its key is null."""
    end = None
    for i, p in enumerate(predicates):
        if p.low != end or (i > 0 and end is None) or any(b is not None and len(b) > 1 for b in (p.low, p.high)):
            raise ValueError("the predicates do not cover one column one after the other")
        yield (p.low and p.low[0], i)
        end = p.high
    if end is not None:
        raise ValueError("the last predicate has an end")


def balanced_predicates(columns: Sequence[str], starts: Iterable[Sequence]) -> Iterator[Predicate]:
    """Predicates between the first keys of chunks, one by one as the starts come; together they cover every row once.

    The first chunk also takes smaller keys and nulls, the last one larger keys, so rows that arrive while the read runs
    are not lost. Equal starts, of a key that fills several chunks and has no second column, are one chunk.
    """
    column = columns[0]
    # the first start is open, so only the others are bounds
    bounds = (b for a, b in pairwise(starts) if tuple(a) != tuple(b))
    low = None
    for high in bounds:
        text = f"({_before(columns, high)} or {column} is null)" if low is None else f"({_from(columns, low)} and {_before(columns, high)})"
        yield Predicate(text, low, high)
        low = high
    yield Predicate("1 = 1" if low is None else _from(columns, low), low)


def _before(columns: Sequence[str], bound: Sequence) -> str:
    key, value = columns[0], _literal(bound[0])
    if len(columns) == 1:
        return f"{key} < {value}"
    return f"({key} < {value} or ({key} = {value} and {columns[1]} < {_literal(bound[1])}))"


def _from(columns: Sequence[str], bound: Sequence) -> str:
    key, value = columns[0], _literal(bound[0])
    if len(columns) == 1:
        return f"{key} >= {value}"
    return f"({key} > {value} or ({key} = {value} and {columns[1]} >= {_literal(bound[1])}))"


def _literal(value) -> str:
    if isinstance(value, datetime):
        return f"timestamp '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"date '{value.isoformat()}'"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)

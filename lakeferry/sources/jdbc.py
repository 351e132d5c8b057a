"""Parallel reads of a relational database.

Every function returns the options of ``spark.read`` or reads with them; the filter
text runs inside the database.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from datetime import date, datetime, timedelta
from itertools import batched

from pyspark.sql import DataFrame, SparkSession

from lakeferry.operators.chunks import balanced_predicates, day_predicates, midnight, range_predicates, starts_text
from lakeferry.spec import TableSpec

FETCH_ROWS = 10_000
#: Chunks of equal key width are used up to this number of them; keys spread wider are split by their histogram.
EQUAL_CHUNKS = 10_000
#: Chunks of one read; larger tables are read in waves.
MOST_CHUNKS = 100_000
WAVE_CHUNKS = 10_000


def source_column(name: str) -> str:
    """Column name as the database wants it; reserved and mixed-case names are quoted."""
    plain = name.isidentifier() and name == name.lower() and name not in _RESERVED
    return name if plain else '"' + name.replace('"', '""') + '"'


# Reserved words that occur as column names.
_RESERVED = {"order", "from", "to", "user", "group", "default", "end", "start", "limit", "offset", "table"}


def select_text(spec: TableSpec, where: str | None = None) -> str:
    """Select of the contract's columns."""
    columns = ", ".join(source_column(c) for c in spec.column_names)
    return f"select {columns} from {spec.source_name}" + (f" where {where}" if where else "")


def since(spec: TableSpec, start: date) -> str | None:
    """Watermark filter of the daily load; the timestamp may be an expression. No upper end."""
    return f"{spec.ts_column} >= '{start.isoformat()} 00:00:00+00'" if spec.ts_column else None


def of_day(column: str, day: date) -> str:
    """Half-open range of one day in UTC, which an index on the column can serve."""
    return f"{column} >= '{midnight(day)}' and {column} < '{midnight(day + timedelta(days=1))}'"


def subquery(sql: str) -> str:
    return f"({sql}) q"


def read_query(spark: SparkSession, connection: Mapping[str, str], sql: str) -> DataFrame:
    """One query, one task: for one day of a table, row counts and the catalog."""
    return spark.read.format("jdbc").options(**_base(connection), dbtable=subquery(sql)).load()


def read_chunks(
    spark: SparkSession, connection: Mapping[str, str], sql: str, predicates: Sequence[str]
) -> DataFrame:
    """One query, one task per predicate."""
    options = _base(connection)
    url = options.pop("url")
    return spark.read.jdbc(url, subquery(sql), predicates=list(predicates), properties=options)


def read_incremental(
    spark: SparkSession,
    connection: Mapping[str, str],
    spec: TableSpec,
    start: date,
    end: date | None = None,
    bounds: tuple[int, int] | None = None,
    max_tasks: int | None = None,
) -> DataFrame:
    """Rows changed since ``start``, without an upper end.

    ``bounds`` (smallest and largest key) splits the read by key range, which also evens out
    a busy day; ``end`` splits it by day of change. Rows outside them are read as well. With
    neither the database is asked for the bounds. ``max_tasks`` widens the contract's chunks.
    """
    where = since(spec, start)
    if where is None:
        return read_full(spark, connection, spec, bounds, max_tasks=max_tasks)
    sql = select_text(spec, where)
    if bounds is None and end is None:
        bounds = key_bounds(spark, connection, spec, where)
    if bounds is not None:
        predicates = _key_chunks(spark, connection, spec, bounds, where, max_tasks)
    elif end is not None:
        # the watermark may be an expression over columns that are not in the contract
        predicates = day_predicates(spec.ts_column, start, end, max_tasks)
        return read_chunks_of_table(spark, connection, spec, [f"({where}) and {p}" for p in predicates])
    else:
        return read_query(spark, connection, sql)
    return read_chunks(spark, connection, sql, predicates)


def read_chunks_of_table(
    spark: SparkSession, connection: Mapping[str, str], spec: TableSpec, predicates: Sequence[str]
) -> DataFrame:
    """Contract columns of a table, one task per predicate; predicates may use any of its columns."""
    options = _base(connection)
    url = options.pop("url")
    rows = spark.read.jdbc(url, spec.source_name, predicates=list(predicates), properties=options)
    return rows.select(*[rows[f"`{c}`"] for c in spec.column_names])


def read_full(
    spark: SparkSession,
    connection: Mapping[str, str],
    spec: TableSpec,
    bounds: tuple[int, int] | None = None,
    days: tuple[date, date] | None = None,
    max_tasks: int | None = None,
) -> DataFrame:
    """Whole table, split by key range or by creation day.

    ``bounds`` are the smallest and largest key, ``days`` the first and last day;
    rows outside them are read as well. With neither the database is asked for the
    bounds of a whole-number key, else of the day column; a table without both is one
    task. ``max_tasks`` widens the contract's chunks.
    """
    sql = select_text(spec)
    if bounds is None and days is None:
        bounds = key_bounds(spark, connection, spec)
        days = day_bounds(spark, connection, spec) if bounds is None else None
    if bounds is not None:
        predicates = _key_chunks(spark, connection, spec, bounds, None, max_tasks)
    elif days is not None:
        predicates = day_predicates(source_column(spec.partition_column or "created_at"), *days, max_tasks)
    else:
        return read_query(spark, connection, sql)
    return read_chunks(spark, connection, sql, predicates)


def _key_chunks(
    spark: SparkSession,
    connection: Mapping[str, str],
    spec: TableSpec,
    bounds: tuple[int, int],
    where: str | None,
    max_tasks: int | None,
) -> list[str]:
    """Chunks of equal key width, which hold the contract's number of rows at most; of keys that are spread so wide that
    these would be many and nearly empty, chunks of as many rows by the database's histogram."""
    if max_tasks or (bounds[1] - bounds[0]) // spec.chunk_rows < EQUAL_CHUNKS:
        return range_predicates(source_column(spec.chunk_column), *bounds, spec.chunk_rows, max_tasks)
    predicates: list[str] = []
    for wave in batched(key_chunks(spark, connection, spec, where), WAVE_CHUNKS):
        predicates += wave
        if len(predicates) > MOST_CHUNKS:
            raise ValueError(f"{spec.name} has over {MOST_CHUNKS} chunks: read it in waves, or give max_tasks")
    return predicates


def chunk_key(spec: TableSpec) -> list[str]:
    """Columns that order a table for its chunks: the chunk column, and the key if that is another."""
    return [source_column(c) for c in dict.fromkeys((spec.chunk_column, spec.key)) if c in spec.declared]


def key_chunks(spark: SparkSession, connection: Mapping[str, str], spec: TableSpec, where: str | None = None) -> Iterator[str]:
    """Predicates for chunks of the contract's size whatever the keys look like, one by one as the database gives the
    bounds. A table without a chunk column is one chunk."""
    columns = chunk_key(spec)
    if spec.chunk_column not in spec.declared:
        return iter(["1 = 1"])
    sql = starts_text(columns, spec.source_name, spec.chunk_rows, where)
    return balanced_predicates(columns, read_query(spark, connection, sql).toLocalIterator())


def read_waves(
    spark: SparkSession, connection: Mapping[str, str], spec: TableSpec, start: date | None = None, chunks: int = WAVE_CHUNKS
) -> Iterator[DataFrame]:
    """A table, or its rows changed since ``start``, as reads of up to ``chunks`` chunks of the contract's size each.

    The driver holds the chunks of one wave; ``load_run`` takes the waves as parts of a run.
    """
    where = None if start is None else since(spec, start)
    sql = select_text(spec, where)
    for wave in batched(key_chunks(spark, connection, spec, where), chunks):
        yield read_chunks(spark, connection, sql, wave)


WHOLE_NUMBERS = ("integer", "bigint", "smallint")


def key_bounds(
    spark: SparkSession, connection: Mapping[str, str], spec: TableSpec, where: str | None = None
) -> tuple[int, int] | None:
    """Smallest and largest key, from one row the database computes; None without rows or a whole-number key."""
    if spec.declared.get(spec.chunk_column) not in WHOLE_NUMBERS:
        return None
    row = read_query(spark, connection, bounds_text(spec, spec.chunk_column, where)).first()
    return None if row is None or row["lo"] is None else (int(row["lo"]), int(row["hi"]))


def day_bounds(spark: SparkSession, connection: Mapping[str, str], spec: TableSpec) -> tuple[date, date] | None:
    """First and last day of the day column; None without rows or such a column."""
    column = spec.partition_column or "created_at"
    if column not in spec.declared:
        return None
    row = read_query(spark, connection, bounds_text(spec, column)).first()
    return None if row is None or row["lo"] is None else (_day(row["lo"]), _day(row["hi"]))


def bounds_text(spec: TableSpec, column: str, where: str | None = None) -> str:
    name = source_column(column)
    return f"select min({name}) as lo, max({name}) as hi from {spec.source_name}" + (f" where {where}" if where else "")


def _day(value: date | datetime) -> date:
    return value.date() if isinstance(value, datetime) else value


def day_text(spec: TableSpec, column: str, day: date) -> str:
    """Select of one day of a table."""
    return select_text(spec, of_day(column, day))


def counts_text(specs: Iterable[TableSpec]) -> str:
    """Row counts of many tables in one query."""
    return " union all ".join(
        f"select '{s.name}' as table_name, count(*) as num_rows from {s.source_name}" for s in specs
    )


def catalog_text(specs: Iterable[TableSpec]) -> str:
    """Columns of the given tables in the live catalog."""
    names = ", ".join(f"'{s.name}'" for s in specs)
    return (
        "select table_name, column_name, data_type from information_schema.columns "
        f"where table_name in ({names})"
    )


def _base(connection: Mapping[str, str]) -> dict[str, str]:
    return {"fetchsize": str(FETCH_ROWS), **connection}

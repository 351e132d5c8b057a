"""Raw rows to landed types: projections, casts, documents to text, array text to arrays."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.times import instant, instant_literal
from lakeferry.functions.types import spark_type
from lakeferry.spec import INGESTED_TS, TableSpec


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def project(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Keep the contract's columns, in contract order."""
    return df.select(*[F.col(quoted(c)) for c in spec.column_names])


def with_ingested_ts(df: DataFrame, run_ts: datetime | str) -> DataFrame:
    """Stamp every row with the time of the run, so that a rerun gives the same rows."""
    return df.withColumn(INGESTED_TS, instant_literal(run_ts))


def cast_timestamps(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Cast the columns declared as timestamps."""
    casts = {c: instant(F.col(quoted(c)), df.schema[c].dataType) for c in spec.timestamp_columns if c in df.columns}
    return df.withColumns(casts) if casts else df


def document_text(column: Column, dtype: T.DataType, joined_lists: bool = False) -> Column:
    """JSON text of a struct, map or array column.

    With ``joined_lists`` a list of objects becomes the objects joined by ", "
    (which is not valid JSON) instead of a JSON array.
    """
    if joined_lists and isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, T.StructType | T.MapType):
        return F.array_join(F.transform(column, lambda x: F.to_json(x)), ", ")
    return F.to_json(column)


def landed_column(name: str, declared: str, dtype: T.DataType, joined_lists: bool = False) -> Column:
    """Expression that turns one source column into its landed type."""
    column = F.col(quoted(name))
    target = spark_type(declared)
    if declared == "ARRAY":
        if isinstance(dtype, T.StringType):
            return array_from_text(column)
        # nested items keep their JSON form, null items stay null
        item = getattr(dtype, "elementType", None)
        if isinstance(item, T.StructType | T.MapType | T.ArrayType):
            return F.transform(column, lambda x: F.to_json(x))
        return column.cast(target)
    if isinstance(dtype, T.StructType | T.MapType | T.ArrayType):
        return document_text(column, dtype, joined_lists)
    if isinstance(dtype, T.BinaryType):
        column, dtype = F.decode(column, "UTF-8"), T.StringType()
    return instant(column, dtype) if target == T.TimestampType() else column.cast(target)


def normalize_rows(df: DataFrame, spec: TableSpec, joined_lists: bool = False) -> DataFrame:
    """Bring source rows to the landed schema of the contract (without the run timestamp)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[landed_column(c, t, types[c], joined_lists).alias(c) for c, t in spec.columns]
    )


def array_from_text(column: Column) -> Column:
    """Parse database array text such as ``{a,"b,c",NULL}``.

    Items are trimmed, quoted items keep commas and blanks, an unquoted NULL is a
    null item and ``{}`` is an empty array.
    """
    inner = F.regexp_replace(F.trim(column), r"^\{|\}$", "")
    # every item is matched together with the comma in front of it
    items = F.regexp_extract_all(
        F.concat(F.lit(","), inner), F.lit(r',(\s*"(?:[^"\\]|\\.)*"\s*|[^,]*)'), F.lit(1)
    )

    def item(x: Column) -> Column:
        text = F.trim(x)
        body = F.regexp_replace(F.substring(text, F.lit(2), F.length(text) - 2), r"\\(.)", "$1")
        return F.when(text.startswith('"'), body).when(F.upper(text) != "NULL", text)

    parsed = F.transform(items, item)
    return F.when(F.trim(inner) == "", F.array().cast("array<string>")).otherwise(parsed)


# Text layouts of exported dates and times (24-hour clock).
DATE_LAYOUT = "yyyy-MM-dd"
DATETIME_LAYOUT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TIMESTAMP_LAYOUT = "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"


def export_text(df: DataFrame) -> DataFrame:
    """Render date and time columns in the fixed export layouts; other columns are kept."""
    layouts = {
        T.DateType: DATE_LAYOUT,
        T.TimestampNTZType: DATETIME_LAYOUT,
        T.TimestampType: TIMESTAMP_LAYOUT,
    }
    texts = {
        f.name: F.date_format(F.col(quoted(f.name)), layouts[type(f.dataType)])
        for f in df.schema.fields
        if type(f.dataType) in layouts
    }
    return df.withColumns(texts) if texts else df

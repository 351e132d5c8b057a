"""Export files: CSV with dirt, newline-delimited JSON, landed reports and artifacts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakeferry.functions.normalize import array_from_text, quoted
from lakeferry.functions.times import instant
from lakeferry.spec import TableSpec

BAD_ROW = "_bad_row"
#: Files with quoted newlines up to this size are read by one task each.
UNSPLIT_BYTES = 128 << 20
CORRUPT = "_corrupt"
#: Bad rows that a load of an export may have.
MAX_BAD_ROWS = 10
# a line that ends in an open quoted value: only quotes at the start of a value open one
_LEFT_OPEN = r'^(?:(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+|),)*+"[^"]*+(?:""[^"]*+)*+$'
# what a quoted empty text is read as, to tell it from a missing value
_EMPTY = "\u0000"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    header_rows: int = 0,
    quoted_newlines: bool = True,
    max_file_bytes: int = UNSPLIT_BYTES,
) -> DataFrame:
    """Rows of a CSV export in the given schema, plus ``_bad_row``.

    Short rows are filled with null and surplus fields are dropped. A row is bad when
    one of its values does not fit its column. Columns are read as text and cast by
    the plan, so the width of a row never counts as a fault.

    Large files are split. Where values may hold newlines, files over ``max_file_bytes``
    are read line by line and the lines of a row are joined again: a line starts a row if
    no quoted value is open before it. Smaller files are one task each; both ways give the
    same rows. Quotes inside an unquoted value are characters, empty lines are no rows, lines
    of blanks are. A file that ends in an open quoted value fails the load, whatever its
    size, since the rows after the quote would be lost.
    """
    if header_rows not in (0, 1):
        raise ValueError("a CSV export has no or one header row")
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    layout = {"mode": "PERMISSIVE", "escape": '"', "emptyValue": _EMPTY}
    if quoted_newlines and _by_lines(spark, path, max_file_bytes):
        ddl = ", ".join(f"{quoted(f.name)} string" for f in text.fields)
        raw = _csv_records(spark, path, header_rows).select(F.from_csv("record", ddl, layout).alias("r")).select("r.*")
    else:
        raw = (
            spark.read.schema(text)
            .options(**layout)
            .option("header", header_rows == 1)
            .option("enforceSchema", True)
            .option("multiLine", quoted_newlines)
            .csv(path)
        )
    values = {f.name: _value(F.col(quoted(f.name)), f.dataType) for f in schema.fields}
    faults = [
        (F.col(quoted(f.name)) != _EMPTY) & values[f.name].isNull()
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    bad = F.coalesce(reduce(lambda a, b: a | b, faults, F.lit(False)), F.lit(False))
    return raw.select(*[v.alias(n) for n, v in values.items()], bad.alias(BAD_ROW))


def _csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with ``reset`` and ``swaps``: what a line does to the state (1 inside a quoted value, else 0).

    Most lines leave it or set it whatever it was; one that turns it around is a swap.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )
    plain = F.regexp_replace("value", r"\r$", "")
    outside = F.when(F.instr("value", '"') == 0, 0).otherwise(F.rlike(plain, F.lit(_LEFT_OPEN)).cast("int"))
    inside = F.when(F.instr("value", '"') == 0, 1).otherwise(F.rlike(F.concat(F.lit('"'), plain), F.lit(_LEFT_OPEN)).cast("int"))
    lines = lines.select("*", outside.alias("outside"), inside.alias("inside"))
    return lines.select(
        "file",
        "block",
        "size",
        "line",
        "value",
        F.when(F.col("outside") == F.col("inside"), F.col("outside")).alias("reset"),
        (F.col("outside") > F.col("inside")).cast("int").alias("swap"),
    )


def _csv_splits(lines: DataFrame) -> DataFrame:
    """Splits with the state before and after them: one small row each, whose lines that change it are folded in order."""
    change = F.when(F.col("reset").isNotNull() | (F.col("swap") == 1), F.struct("line", "reset", "swap"))
    none = F.struct(F.lit(None).cast("int").alias("set"), F.lit(0).alias("swaps"))

    def step(state: Column, x: Column) -> Column:
        swaps = state["swaps"] + x["swap"]
        return F.struct(F.coalesce((x["reset"] + swaps) % 2, state["set"]).alias("set"), swaps.alias("swaps"))

    # the state after a line is the last reset, turned around by the swaps since
    splits = lines.groupBy("file", "block").agg(
        F.aggregate(F.array_sort(F.collect_list(change)), none, step).alias("x"),
        F.max("size").alias("size"),
        F.bool_or(F.endswith("value", F.lit("\r"))).alias("returns"),
    )
    splits = splits.select("file", "block", "size", "returns", "x.*")
    every = Window.partitionBy("file").orderBy("block")
    ahead = every.rowsBetween(Window.unboundedPreceding, 0)
    splits = splits.withColumn("all", F.sum("swaps").over(ahead))
    fixed = F.last(F.when(F.col("set").isNotNull(), (F.col("set") + F.col("all") - F.col("swaps")) % 2), ignorenulls=True).over(ahead)
    splits = splits.withColumn("after", (F.coalesce(fixed, F.lit(0)) + F.col("all")) % 2)
    return splits.withColumn("ahead", F.coalesce(F.lag("after").over(every), F.lit(0)))


def _csv_states(lines: DataFrame) -> DataFrame:
    """Lines with the state before them, counted within their split."""
    inside = Window.partitionBy("file", "block").orderBy("line")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    counted = lines.withColumn("swaps", F.sum("swap").over(upto))
    counted = counted.withColumn("set", F.last(F.when(F.col("reset").isNotNull(), (F.col("reset") + F.col("swaps")) % 2), ignorenulls=True).over(upto))
    known = counted.join(_csv_splits(lines).select("file", "block", "ahead"), ["file", "block"])
    after = (F.coalesce("set", "ahead") + F.col("swaps")) % 2
    return known.withColumn("odd", F.coalesce(F.lag(after).over(inside), F.col("ahead")))


def _by_lines(spark: SparkSession, path: str, max_file_bytes: int) -> bool:
    """Whether files are read line by line: a large one, or carriage returns, of which the parser of whole files would
    have to guess whether they end lines. Fails at a file that ends in an open value."""
    files = _csv_splits(_csv_lines(spark, path)).groupBy("file").agg(
        F.max_by("after", "block").alias("after"), F.max("size").alias("size"), F.bool_or("returns").alias("returns")
    )
    found = files.agg(F.min(F.when(F.col("after") == 1, F.col("file"))), F.max("size"), F.bool_or("returns")).first()
    if found[0]:
        raise ValueError(f"{found[0]} ends in an open quoted value")
    return (found[1] or 0) > max_file_bytes or bool(found[2])


def _csv_records(spark: SparkSession, path: str, header_rows: int) -> DataFrame:
    """Texts of the rows of CSV files whose values may hold newlines; the files are read in splits.

    Lines are counted within their split, and what crosses splits is one small row for each of them: the state before
    it and the last row start before it. Only rows of several lines are put together.
    """
    counted = _csv_states(_csv_lines(spark, path))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file", "block").orderBy("line")
    # lines are in order within a split, and splits in the order of their blocks
    own_start = F.when(F.col("odd") == 0, F.struct("block", "line"))
    started = counted.withColumn("start", F.last(own_start, ignorenulls=True).over(inside))
    ends = started.groupBy("file", "block").agg(F.max("start").alias("last"))
    ends = ends.select("file", "block", F.last("last", ignorenulls=True).over(before).alias("carried"))
    whole = started.join(ends, ["file", "block"]).withColumn("start", F.coalesce("start", "carried"))
    joined = whole.groupBy("file", "start").agg(
        F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("lines")
    )
    record = F.regexp_replace(F.array_join(F.transform("lines", lambda x: x["value"]), "\n"), r"\r$", "")
    # a header is the first row that is not empty; empty lines are no rows, lines of blanks are
    rows = joined.select("file", "start", record.alias("record")).where("record <> ''")
    if header_rows:
        first = rows.groupBy("file").agg(F.min("start").alias("head"))
        rows = rows.join(first, "file").where("start > head")
    return rows.select("record")


def _value(column: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.when(column == _EMPTY, "").otherwise(column)
    column = F.nullif(column, F.lit(_EMPTY))
    if isinstance(dtype, T.ArrayType):
        return array_from_text(column)
    if isinstance(dtype, T.TimestampType):
        return instant(column, T.StringType(), lenient=True)
    return F.trim(column).try_cast(dtype)


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Newline-delimited JSON with an explicit schema; files are split. A line that does not fit fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_ndjson_flagged(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Newline-delimited JSON plus ``_bad_row``, and ``_corrupt`` with the text of bad lines.

    A line is bad when it is no JSON object or one of its values does not fit.
    """
    fields = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    wide = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    rows = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
    return rows.withColumn(BAD_ROW, F.col(CORRUPT).isNotNull())


def read_artifact(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents that span lines, one row per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


# Layouts of the artifacts.
COVERAGE_ARTIFACT = "tables array<struct<name: string, covered: bigint, total: bigint>>"
FRESHNESS_ARTIFACT = (
    "results array<struct<unique_id: string, status: string, max_loaded_at: string, "
    "max_loaded_at_time_ago_in_s: double, criteria: struct<filter: string>>>"
)


def read_xml_series(spark: SparkSession, path: str, schema: str, row_tag: str = "series") -> DataFrame:
    """Elements of landed XML responses, one row each."""
    return spark.read.format("xml").schema(schema).option("rowTag", row_tag).load(path)

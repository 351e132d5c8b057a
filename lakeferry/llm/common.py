"""Pieces that several text operators use."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.sinks.storage import shared_path

#: Columns of a documents table.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def landed(df: DataFrame, name: str) -> DataFrame:
    """The rows as written to the shared folder: later steps read the files and do not compute them again."""
    spark = df.sparkSession
    path = shared_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(text: Column) -> Column:
    """Key of a text in joins: equal texts of one document have equal results."""
    return F.xxhash64(text)


def part_of_id(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo the number of parts; null ids are in no part."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def byte_texts(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of each text of a batch; null is empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def pieces(column: pa.Array, most_bytes: int) -> Iterator[pa.Array]:
    """The batch cut into runs of rows of about ``most_bytes`` bytes of text, at least one row each."""
    start, size = 0, 0
    lengths = pc.binary_length(column).fill_null(0).to_pylist()
    for i, length in enumerate(lengths):
        if i > start and size + length > most_bytes:
            yield column.slice(start, i - start)
            start, size = i, 0
        size += length
    if start < len(column):
        yield column.slice(start)

"""Near-duplicate documents: SimHash fingerprints linked by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.llm.common import byte_texts, fold, landed
from lakeferry.llm.components import components

BITS = 64
SHINGLE_WORDS = 4
HASH_SEED = 42
RADIUS = 4
#: Largest bucket whose members are compared with each other in one task; larger ones are linked through midpoints.
BUCKET_ROWS = 4096
_CHUNK = 1 << 15


def covering_masks(radius: int = RADIUS) -> list[int]:
    """2^(radius+1) - 1 bit masks such that any ``radius`` bits are all clear in at least one of them.

    Bit i has a nonzero code of radius + 1 bits; mask v has the bits whose code has an odd overlap with v. ``radius``
    codes leave at least one v that overlaps evenly with all of them.
    """
    size = 2 ** (radius + 1) - 1
    codes = [i % size + 1 for i in range(BITS)]
    return [sum(1 << i for i, c in enumerate(codes) if (c & v).bit_count() % 2) for v in range(1, size + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text, unsigned; a text without words has zero."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle_words)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, HASH_SEED) for s in shingles), "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        bits = np.unpackbits(hashes[at : at + _CHUNK].view(np.uint8), bitorder="little").reshape(-1, BITS)
        ones += np.add.reduce(bits, axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


@F.arrow_udf(T.LongType())
def fingerprints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Column of fingerprints as signed longs; null texts have none of the words and so zero."""
    for column in texts:
        found = np.fromiter((fingerprint(t) for t in byte_texts(column)), np.uint64, count=len(column))
        yield pa.array(found.view(np.int64))


def hex_digits(column: Column) -> Column:
    return F.lpad(F.lower(F.hex(column)), BITS // 4, "0")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, text_key, fp, component_id) for every row: the group of documents linked by near fingerprints.

    Fingerprints with ``radius`` or fewer differing bits are linked; component_id is the smallest doc_id reachable.
    Copies are folded into their fingerprint before any comparison, so the work depends on distinct fingerprints.
    Rows with equal doc_id count one by one. Null texts and texts without words share fingerprint zero. A null doc_id
    is never a component_id unless the whole group has null ids. Other columns are ignored; no rows give no rows.
    """
    rows = landed(docs.select("doc_id", fold(F.col("text")).alias("text_key"), fingerprints("text").alias("fp")), "fingerprints")
    firsts = landed(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "firsts")
    roots = components(near_pairs(firsts.select("fp"), radius, bucket_rows))
    rooted = landed(
        firsts.join(roots, firsts["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")),
        "rooted",
    )
    # written, so that a root of very many fingerprints can be split in the join
    ids = landed(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "component-ids")
    named = rooted.join(ids, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "text_key", "fp", "component_id")


def near_pairs(fps: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect exactly what pairs within ``radius`` bits connect.

    A bucket of two is compared at once; the members of a larger one are linked to the smallest member of their local
    component. Buckets above ``bucket_rows`` are never gathered: their members are linked through the points halfway
    between them, at a fixed number of rows a fingerprint. For that the radius must be even.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    masks = [F.lit(_signed(m)) for m in covering_masks(radius)]
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(m)) for i, m in enumerate(masks)])
    spread = fps.select("fp", F.explode(keys).alias("bucket"))
    buckets = landed(
        spread.groupBy("bucket")
        .agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .where("n > 1"),
        "buckets",
    )
    pairs = buckets.where("n = 2").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b")
    groups = spread.join(buckets.where(f"n > 2 and n <= {bucket_rows}").select("bucket"), "bucket")

    def linked(group: pa.Table) -> pa.Table:
        found = _local_links(group["fp"].to_numpy(), radius)
        return pa.table({"a": pa.array(found[0], pa.int64()), "b": pa.array(found[1], pa.int64())})

    local = groups.groupBy("bucket").applyInArrow(linked, "a bigint, b bigint")
    hot = spread.join(buckets.where(f"n > {bucket_rows}").select("bucket"), "bucket").select("fp").distinct()
    return pairs.union(local).union(_midpoint_links(hot, radius))


def _local_links(fps: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Spanning links of one bucket: breadth-first, each member is visited once."""
    rest = np.sort(fps)
    a: list[int] = []
    b: list[int] = []
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        queue = [root]
        while queue and len(rest):
            near = np.bitwise_count((rest ^ queue.pop()).view(np.uint64)) <= radius
            if near.any():
                queue.extend(rest[near])
                b.extend(rest[near].tolist())
                a.extend([int(root)] * int(near.sum()))
                rest = rest[~near]
    return a, b


def _midpoint_links(fps: DataFrame, radius: int) -> DataFrame:
    """Links within ``radius``: two such fingerprints share a point at half that distance from both."""
    half = radius // 2
    flips = [sum(1 << i for i in c) for k in range(half + 1) for c in combinations(range(BITS), k)]
    steps = F.lit([_signed(f) for f in flips])
    spread = fps.select("fp", F.explode(steps).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    ends = spread.groupBy("point").agg(F.min("fp").alias("a"), F.max("fp").alias("z")).where("a < z")
    return spread.join(ends, "point").where("fp > a").select("a", F.col("fp").alias("b")).distinct()


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with one document of each near-duplicate group: the one with the smallest doc_id.

    Rows that repeat the kept document (same doc_id) stay with it. A group of null ids stays whole.
    """
    kept = near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "text_key").distinct()
    kept = kept.select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"))
    same = docs["doc_id"].eqNullSafe(kept["kept_id"]) & (fold(docs["text"]) == kept["kept_key"])
    return docs.join(kept, same, "left_semi")

"""Document fingerprints of closed syncmers.

A run of ``K`` code points is a closed syncmer if the smallest (by hash) of its inner runs of ``S`` is its first or its
last one. That depends on the run alone, so texts that share a passage choose the same anchors in it, whatever stands
around. Texts are padded at both ends, so that every text that is not empty has an anchor. A fingerprint keeps the
``ANCHORS`` anchors with the smallest hashes, each with the first place where it stands; fingerprints are compared by
the anchors that both have at places that go together.

Everything is a column expression. Long texts are read in pieces that overlap by a run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeferry.llm.common import landed

K = 16
S = 5
ANCHORS = 64
#: Places go together if their shift differs from the usual one by no more than this and a share of the text's length.
SLACK, SLACK_SHARE = 64, 0.25
#: Code points read at once.
PIECE = 1 << 17
#: Bytes of text in a bucket of neighbours, and the most buckets: their bounds are a constant of the plan.
BUCKET_BYTES = 8 << 20
MOST_BUCKETS = 1 << 16
_WINDOW = K - S + 1
_START, _END = "\u0002" * (K - 1), "\u0003" * (K - 1)
_NONE = "array<struct<p:int,h:bigint>>"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once."""
    return F.transform(F.array(value), then)[0]


def _piece_anchors(text: Column) -> Column:
    """(p, h) of every closed syncmer of a piece: its place from 0 on, and its hash in 48 bits."""
    # each code point is consumed alone and seen with the next ones
    inner = F.transform(F.regexp_extract_all(text, F.lit(f"(?s)(?=({'.' * S}))."), 1), lambda g: F.xxhash64(g))

    def least(hashes: Column, width: int, then: Callable[[Column, int], Column]) -> Column:
        """The smallest of as many following hashes as the largest power of 2 that fits between the edges."""
        if 2 * width > _WINDOW - 2:
            return then(hashes, width)
        wider = F.transform(hashes, lambda x, i: F.least(x, F.get(hashes, i + width)))
        return _let(wider, lambda w: least(w, 2 * width, then))

    def chosen(hashes: Column) -> Column:
        starts = F.when(F.size(hashes) >= _WINDOW, F.sequence(F.lit(0), F.size(hashes) - _WINDOW))
        edge = lambda i: F.least(F.get(hashes, i), F.get(hashes, i + (_WINDOW - 1)))
        return least(
            hashes,
            1,
            lambda low, width: F.filter(
                starts, lambda i: edge(i) <= F.least(F.get(low, i + 1), F.get(low, i + (_WINDOW - 1 - width)))
            ),
        )

    def whole(hashes: Column, i: Column) -> Column:
        parts = [F.get(hashes, i + k) for k in (*range(0, K - S, S), K - S)]
        return F.shiftrightunsigned(F.xxhash64(*parts), 16)

    return _let(
        inner,
        lambda hashes: F.transform(chosen(hashes), lambda i: F.struct(i.alias("p"), whole(hashes, i).alias("h"))),
    )


def _anchors(padded: Column) -> Column:
    """Anchors of a text that has its ends on; null and shorter texts have none."""

    def piece(start: Column) -> Column:
        found = _piece_anchors(F.substring(padded, start + 1, F.lit(PIECE + K - 1)))
        return F.transform(found, lambda a: F.struct((a["p"] + start).alias("p"), a["h"].alias("h")))

    starts = F.sequence(F.lit(0), F.greatest(F.char_length(padded) - 1, F.lit(0)), F.lit(PIECE))
    return F.coalesce(F.flatten(F.filter(F.transform(starts, piece), lambda x: x.isNotNull())), F.array().cast(_NONE))


def anchors(text: Column) -> Column:
    """(p, h) of the closed syncmers of a text with its ends; null and empty texts have none."""
    padded = F.concat(F.lit(_START), text, F.lit(_END))
    return F.when(F.char_length(text) > 0, _let(padded, _anchors)).otherwise(F.array().cast(_NONE))


def sketch(found: Column, most: int = ANCHORS) -> Column:
    """The ``most`` smallest distinct hashes of some anchors in rising order, each with its first place."""

    def first(found: Column, hashes: Column, h: Column) -> Column:
        return F.struct(h.alias("h"), F.get(found, F.array_position(hashes, h).cast("int") - 1)["p"].alias("p"))

    def smallest(found: Column, hashes: Column) -> Column:
        low = F.slice(F.sort_array(F.array_distinct(hashes)), 1, most)
        return F.transform(low, lambda h: first(found, hashes, h))

    return _let(found, lambda own: _let(F.transform(own, lambda a: a["h"]), lambda hashes: smallest(own, hashes)))


def fingerprint(text: Column, most: int = ANCHORS) -> Column:
    """Fingerprint of a text: (h, p) of up to ``most`` anchors. Null and empty texts have an empty one."""
    return sketch(anchors(text), most)


def as_text(fp: Column) -> Column:
    """A fingerprint as ``hash@place`` after ``hash@place``, hashes with 12 hex digits."""
    return F.array_join(F.transform(fp, lambda a: F.concat(F.lpad(F.lower(F.hex(a["h"])), 12, "0"), F.lit("@"), a["p"])), " ")


def likeness(one: Column, other: Column, most: int = ANCHORS) -> Column:
    """How much of two texts is alike by their fingerprints, from 0 to 1; equal ones have 1, an empty one and another 0.

    Of the smallest hashes of both, those that both have at places shifted alike are counted. Their share j of all
    estimates common to either; 2 j / (1 + j) is common to the mean of both.
    """

    def compared_hashes(x: Column, y: Column, a: Column, b: Column) -> Column:
        place = lambda fp, own, h: F.get(fp, F.array_position(own, h).cast("int") - 1)["p"]
        seen = F.slice(F.sort_array(F.array_union(a, b)), 1, most)
        both = _let(F.array_max(seen), lambda top: F.filter(F.array_intersect(a, b), lambda h: h <= top))
        shifts = F.sort_array(F.transform(both, lambda h: place(x, a, h) - place(y, b, h)))
        last = F.greatest(*(F.coalesce(F.array_max(F.transform(fp, lambda e: e["p"])), F.lit(0)) for fp in (x, y)))
        slack = SLACK + SLACK_SHARE * last
        return _let(shifts, lambda found: _let(F.size(near(found, slack)) / F.size(seen), lambda j: 2 * j / (1 + j)))

    def near(found: Column, slack: Column) -> Column:
        usual = F.get(found, F.floor(F.size(found) / 2).cast("int"))
        return _let(F.struct(usual.alias("usual"), slack.alias("slack")), lambda c: F.filter(found, lambda s: F.abs(s - c["usual"]) <= c["slack"]))

    def of_both(x: Column, y: Column) -> Column:
        hashes = [F.transform(fp, lambda e: e["h"]) for fp in (x, y)]
        shared = _let(hashes[0], lambda a: _let(hashes[1], lambda b: compared_hashes(x, y, a, b)))
        return F.when((F.size(x) == 0) & (F.size(y) == 0), F.lit(1.0)).otherwise(shared)

    return _let(one, lambda x: _let(other, lambda y: of_both(x, y)))


def _neighbours(docs: DataFrame, bucket_bytes: int) -> tuple[DataFrame, Window]:
    """(doc_id, text, ghost, bucket) and a window in which the next row is the next document by falling doc_id.

    Documents are dealt into ranges of (doc_id, hash of the text), and the first document of each range also goes to the
    range before it as a ghost, that of the first range to the last, so that every text is shuffled once. Only the
    bounds of the ranges leave the tasks, as one row of at most ``MOST_BUCKETS`` bounds.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.struct("doc_id", F.xxhash64("text").alias("text_key"))
    keys = landed(rows.select(key.alias("key"), F.octet_length("text").alias("size")), "keys")
    size = keys.agg(F.sum("size")).first()[0] or 0
    parts = min(max(-(-size // bucket_bytes), 1), MOST_BUCKETS)
    ranges = keys.select("key").repartitionByRange(parts, "key").groupBy(F.spark_partition_id().alias("range"))
    bounds = landed(ranges.agg(F.min("key").alias("first"), F.max("key").alias("last")), "bounds").coalesce(1)
    listed = bounds.agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("bounds"))
    # ranges without a key have no bounds, and there may be more ranges than were asked for
    buckets = max(bounds.count(), 1)
    steps = [1 << k for k in reversed(range(buckets.bit_length()))]

    def placed(bounds: Column, own: Column) -> Column:
        """The bucket by binary search, and the next one too for the last document of a bucket."""
        step = lambda at, s: F.when(F.get(bounds, at + s)["first"] <= own, at + s).otherwise(at)
        at = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)
        home = lambda b: F.struct(b.alias("bucket"), F.lit(False).alias("ghost"))
        away = lambda b: F.struct(((b + 1) % F.size(bounds)).alias("bucket"), F.lit(True).alias("ghost"))
        return _let(at, lambda b: F.when(F.get(bounds, b)["last"] == own, F.array(home(b), away(b))).otherwise(F.array(home(b))))

    keyed = rows.select("doc_id", "text", key.alias("key"), listed.scalar().alias("bounds"))
    dealt = keyed.select("doc_id", "text", "key", F.explode(_let(F.col("bounds"), lambda b: placed(b, F.col("key")))).alias("x"))
    dealt = dealt.select("doc_id", "text", "key", "x.*").repartition(buckets, "bucket")
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc("key"))
    return dealt, order


def compared(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every document.

    The next document is that with the next smaller doc_id, after the smallest the one with the largest; null ids come
    last, documents of one id go by a hash of their text, and a repeated row is followed by its copy. The edited text
    has its last third (rounded down) replaced by as many first code points of the next text, or all if it has fewer. ``near_edited`` and
    ``near_next`` are the ``likeness`` of the document's fingerprint to those of the edited and of the next text. Null
    texts are empty. Other columns are ignored; one document is its own next; no documents give no rows.
    """
    dealt, order = _neighbours(docs, bucket_bytes)
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    with_next = dealt.withColumn("next_text", F.lead("text").over(order))
    cut = with_next.select(
        "doc_id",
        "bucket",
        "ghost",
        "key",
        "text",
        n.alias("n"),
        (n - third).alias("start"),
        F.left("text", n - third).alias("head"),
        F.left(F.coalesce("next_text", F.lit("")), third).alias("tail"),
    )
    prints = cut.select(
        "doc_id",
        "bucket",
        "ghost",
        "key",
        F.col("n").cast("bigint").alias("n_chars"),
        F.sha2(F.concat("head", "tail").cast("binary"), 256).alias("edited_sha256"),
        _let(
            anchors(F.col("text")),
            lambda own: F.struct(sketch(own).alias("fp"), sketch(_edited_anchors(own)).alias("edited_fp")),
        ).alias("x"),
    ).select("doc_id", "bucket", "ghost", "key", "n_chars", "edited_sha256", "x.*")
    followed = prints.withColumn("next_fp", F.lead("fp").over(order)).where("not ghost")
    return followed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("fp")).alias("fingerprint"),
        as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def _edited_anchors(own: Column) -> Column:
    """Anchors of ``head`` and ``tail`` together, from those of the whole text that ``head`` begins.

    An anchor depends on its own run alone, so those within the head stay; only runs that reach the tail are read.
    """
    rest = F.concat(F.right(F.concat(F.lit(_START), "head"), F.lit(K - 1)), F.col("tail"), F.lit(_END))

    def joined(start: Column) -> Column:
        moved = F.transform(_let(rest, _anchors), lambda a: F.struct((a["p"] + start).alias("p"), a["h"].alias("h")))
        return F.concat(F.filter(own, lambda a: a["p"] < start), moved)

    return F.when(F.col("n") > 0, _let(F.col("start"), joined)).otherwise(F.array().cast(_NONE))

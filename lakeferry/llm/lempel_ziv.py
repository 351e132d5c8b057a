"""Repeated passages by anchored blocks and an index of all documents, in place of greedy relative Lempel-Ziv factoring.

Each document is a row of words, and every window of ``WINDOW_WORDS`` of them has one anchor: its smallest run of
``SEED_WORDS`` words by hash. Windows in a row with the same anchor form a block, so a document is parsed into blocks
at places that depend on nothing but the words around them, and equal passages are parsed alike. The reference index
holds the blocks of all documents, spread by hash: looking a block up replaces scanning the reference blocks one by one,
which would compare all documents with all others.

A block that a document with a smaller id also has is a factor as a whole; factors in a row are joined. At the ends of
factors the blocks differ although their anchors are the same, because the passage ends or was edited there: the
windows of such blocks are looked up one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.llm.common import byte_texts, fold, landed, pieces

WINDOW_WORDS = 50
SEED_WORDS = 8
_PIECE_BYTES = 1 << 20
#: Odd factors of the word and window hashes. Fixed values.
_FACTOR = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_MODULUS = 1 << 64

_BLOCKS = T.ArrayType(T.StructType().add("g", "long").add("q", "long").add("lo", "integer").add("n", "integer"))
_WINDOWS = T.ArrayType(T.StructType().add("pos", "integer").add("g", "long").add("w", "long"))
_SPANS = T.ArrayType(T.StructType().add("start", "integer").add("length", "integer"))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the factor and of its inverse, as many as were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            inverse = pow(_FACTOR, -1, _MODULUS)
            steps = np.full(size, _FACTOR, np.uint64)
            steps[0] = 1
            self.up = np.multiply.accumulate(steps)
            steps[1:] = inverse
            self.down = np.multiply.accumulate(steps)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


class Words:
    """Hashes of the words of some texts, and of any run of them."""

    def __init__(self, texts: list[bytes]):
        split = [t.split() for t in texts]
        self.sizes = np.array([len(s) for s in split], np.int64)
        self.ends = np.cumsum(self.sizes)
        digest = xxhash.xxh64_intdigest
        total = int(self.sizes.sum())
        hashes = np.fromiter((digest(w) for s in split for w in s), np.uint64, count=total)
        up, self.down = _POWERS.of(total + 1)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * up[:total], dtype=np.uint64)))

    def run(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words from ``start`` to before ``end``."""
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start])


def parse(words: Words, window: int = WINDOW_WORDS, seed: int = SEED_WORDS) -> tuple[np.ndarray, ...]:
    """(text, g, q, lo, n) of the blocks: ``n`` windows from word ``lo`` on with anchor ``g``; ``q`` is the hash of the
    words of these windows with the place of the anchor."""
    total = int(words.sizes.sum())
    none = np.empty(0, np.int64)
    if total < window:
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    at = np.arange(total - seed + 1)
    seeds = words.run(at, at + seed)
    best, place, width, span = seeds, at, 1, window - seed + 1
    while width < span:
        step = min(width, span - width)
        left, right = best[:-step], best[step:]
        later = right < left
        best = np.where(later, right, left)
        place = np.where(later, place[step:], place[:-step])
        width += step
    text = np.repeat(np.arange(len(words.sizes)), words.sizes)[: len(best)]
    valid = np.flatnonzero(np.arange(len(best)) + window <= words.ends[text])
    if not len(valid):
        return none, none.astype(np.uint64), none.astype(np.uint64), none, none
    anchors = place[valid]
    first = np.concatenate(([True], (anchors[1:] != anchors[:-1]) | (valid[1:] != valid[:-1] + 1)))
    begin = np.flatnonzero(first)
    lo, anchor = valid[begin], anchors[begin]
    n = np.diff(np.append(begin, len(valid)))
    shape = ((anchor - lo) * (window + 1) + n).astype(np.uint64)
    q = _mixed(words.run(lo, lo + n - 1 + window) ^ (shape * np.uint64(_FACTOR)))
    owner = text[lo]
    return owner, seeds[anchor], q, lo - (words.ends - words.sizes)[owner], n


def _lists(owner: np.ndarray, size: int, fields: dict[str, pa.Array]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=size))))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([*fields.values()], [*fields]))


@F.arrow_udf(_BLOCKS)
def text_blocks(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in texts:
        found = []
        for piece in pieces(column, _PIECE_BYTES):
            owner, g, q, lo, n = parse(Words([*byte_texts(piece)]))
            fields = {
                "g": pa.array(g.view(np.int64)),
                "q": pa.array(q.view(np.int64)),
                "lo": pa.array(lo, pa.int32()),
                "n": pa.array(n, pa.int32()),
            }
            found.append(_lists(owner, len(piece), fields))
        yield pa.concat_arrays(found) if found else _lists(np.empty(0, int), 0, {k: pa.array([], t) for k, t in (("g", pa.int64()), ("q", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()))})


@F.arrow_udf(_WINDOWS)
def open_windows(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Hashes of the windows in the given blocks (g, lo, n) of each text."""
    for column, blocks in texts:
        out = []
        for text, own in zip(byte_texts(column), blocks.to_pylist(), strict=True):
            if not own:
                out.append([])
                continue
            words = Words([text])
            start = np.concatenate([np.arange(b["lo"], b["lo"] + b["n"]) for b in own])
            g = np.repeat([b["g"] for b in own], [b["n"] for b in own])
            w = words.run(start, start + WINDOW_WORDS).view(np.int64)
            out.append([{"pos": p, "g": a, "w": h} for p, a, h in zip(start.tolist(), g.tolist(), w.tolist(), strict=True)])
        yield pa.array(out, pa.list_(pa.struct([("pos", pa.int32()), ("g", pa.int64()), ("w", pa.int64())])))


def covered(size: int, spans: list[dict] | None) -> np.ndarray:
    """Which of ``size`` words lie in a span."""
    depth = np.zeros(size + 1, np.int64)
    for s in spans or ():
        depth[s["start"]] += 1
        depth[min(s["start"] + s["length"], size)] -= 1
    return np.cumsum(depth[:-1]) > 0


_KEPT = T.StructType().add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")


@F.arrow_udf(_KEPT)
def kept_digest(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Digest of a text without the words in its spans."""
    for column, spans in texts:
        rows = []
        for text, own in zip(byte_texts(column), spans.to_pylist(), strict=True):
            words = text.split()
            kept = words
            if own:
                gone = covered(len(words), own)
                kept = [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
            digest = hashlib.sha256(b" ".join(kept)).hexdigest()
            rows.append({"n_words": len(words), "n_removed": len(words) - len(kept), "kept_sha256": digest})
        yield pa.array(rows, pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]))


@F.arrow_udf(T.StringType())
def kept_words(texts: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """A text without the words in its spans, the others joined by one space; texts without spans stay as they are."""
    for column, spans in texts:
        rows = []
        for text, own in zip(column.to_pylist(), spans.to_pylist(), strict=True):
            if own and text is not None:
                words = text.encode().split()
                gone = covered(len(words), own)
                text = b" ".join(w for w, x in zip(words, gone.tolist(), strict=True) if not x).decode()
            rows.append(text)
        yield pa.array(rows, pa.string())


def duplicate_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans): the words of a document in windows that also start in a document with a smaller id.

    Only documents with such windows have a row. Texts are told apart by id and text, so repeated rows share theirs;
    documents with the same id do not count against each other. Null ids and texts take no part; neither do texts of
    fewer words than a window.
    """
    named = docs.where("doc_id is not null").select("doc_id", "text", fold(F.col("text")).alias("text_key"))
    blocks = landed(
        named.select("doc_id", "text_key", F.explode(text_blocks("text")).alias("b")).select("doc_id", "text_key", "b.*"),
        "blocks",
    )
    # the index: each distinct block with its first document; anchors of one document only lead nowhere
    index = blocks.groupBy("g", "q").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    # what is joined on its own key is written first: Spark splits a very common key only between plain shuffles
    shared = landed(
        index.groupBy("g")
        .agg(F.count("*").alias("contexts"), F.min("first_id").alias("f"), F.max("last_id").alias("l"))
        .where("f < l")
        .select("g", "contexts"),
        "shared",
    )
    useful = index.join(shared, "g").where("contexts > 1 or first_id < last_id")
    useful = useful.select("g", "q", "first_id", (F.col("contexts") > 1).alias("edge"))
    looked_up = landed(
        blocks.join(useful, ["g", "q"]).where("first_id < doc_id or edge").withColumn("factor", F.col("first_id") < F.col("doc_id")),
        "factors",
    )
    span = F.struct(F.col("lo").alias("start"), (F.col("n") - 1 + WINDOW_WORDS).cast("int").alias("length"))
    factors = looked_up.where("factor").select("doc_id", "text_key", span.alias("span"))

    # windows at the ends of factors: one document stands for all that have the same block
    edges = looked_up.where("not factor").distinct().groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("g", "lo", "n")).alias("own"))
    opened = named.join(edges, ["doc_id", "text_key"]).select(
        "doc_id", "text_key", F.explode(open_windows("text", "own")).alias("x")
    )
    opened = landed(opened.select("doc_id", "text_key", "x.*"), "windows")
    firsts = opened.groupBy("g", "w").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("first_id < last_id")
    late = opened.join(landed(firsts.select("g", "w", "first_id"), "first-windows"), ["g", "w"]).where("first_id < doc_id")
    late = late.select(
        "doc_id", "text_key", F.struct(F.col("pos").alias("start"), F.lit(WINDOW_WORDS).alias("length")).alias("span")
    )
    return factors.union(late).groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("span")).alias("spans"))


def with_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text, spans) of every document; spans is null where nothing is repeated."""
    spans = duplicate_spans(docs).select(F.col("doc_id").alias("span_id"), F.col("text_key").alias("span_key"), "spans")
    rows = docs.select("doc_id", "text")
    same = (rows["doc_id"] == spans["span_id"]) & (fold(rows["text"]) == spans["span_key"])
    return rows.join(spans, same, "left").select("doc_id", "text", "spans")


def removed(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document without its repeated passages."""
    return with_spans(docs).select("doc_id", kept_digest("text", "spans").alias("k")).select("doc_id", "k.*")


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of every document without its repeated passages; texts without any are unchanged."""
    return with_spans(docs).select("doc_id", kept_words("text", "spans").alias("text"))

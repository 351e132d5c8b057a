"""Token files: documents as token ids in doc_id order, packed in 64-bit words.

A file row is a segment: documents in a row with their ids, replaced by ranks of frequency in the segment (``ranks``
has the id of each rank) and packed by ``simple8b``. ``offsets`` has the first word of each block of 1024 ids, so any
block can be decoded without the ones before it. Parquet is only the container: Spark commits whole files, so a lost
executor leaves none half-written.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeferry.llm import simple8b
from lakeferry.llm.common import fold, pieces

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
SEGMENT_IDS = 1 << 20
#: Parts of words whose ids a worker remembers; others are encoded again in each batch.
REMEMBERED_WORDS = 600_000
#: Bytes of text in a range of documents, and in what is encoded at once.
PART_BYTES = 128 << 20
_PIECE_BYTES = 4 << 20

_SEGMENT = (
    "part int, seq int, n_ids bigint, doc_ids array<bigint>, doc_tokens array<bigint>, "
    "ranks binary, offsets binary, escapes binary, words binary"
)


#: Words of these characters alone are the same after normalising, but for lower case.
_SIMPLE = "^[\\x00-\\x7fÀ-ÖØ-öø-ÿ]*$"
#: How the tokenizer parts them: its own pattern, in which these characters need no properties.
_PARTS = "('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+)"
_SPECIAL = "<|"
_WORD_END = "</w>"
_JOINED_PARTS = 2048


class WordEncoder:
    """Ids of texts by the words between ASCII white space.

    The tokenizer drops white space and neither normalises nor joins characters across ASCII white space, so a text has
    the ids of its words one after the other. Words of ASCII and precomposed Latin letters alone have the ids of their
    parts; all others, and those that may hold one of the tokenizer's special strings, go to the tokenizer as they
    stand. Each distinct part of a batch is encoded once, and the ids of parts seen before are kept in one array, of
    ``REMEMBERED_WORDS`` at most.
    """

    def __init__(self, name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if not os.path.isabs(name):
            import public_tokenizers

            name = public_tokenizers.path(name)
        self.tokenizer = Tokenizer.from_file(name)
        self.known: dict[str, int] = {}
        self.kept = _Ragged()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        self.ends[[i for word, i in vocabulary.items() if word.endswith(_WORD_END)]] = True

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        ids, sizes = self.encode_column(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
        return np.split(ids, np.cumsum(sizes)[:-1]) if len(sizes) else []

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each); null texts have none."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        words = split.flatten().dictionary_encode()
        parts = _parts_of(words.dictionary)
        units = parts.flatten().dictionary_encode()
        starts, sizes, flat = self._places(units.dictionary.to_pylist())
        # words become parts, and parts become ids
        part_starts = parts.offsets.to_numpy().astype(np.int64)
        part_starts -= part_starts[0]
        codes = words.indices.to_numpy()
        at, part_ends = _ragged(part_starts[:-1][codes], np.diff(part_starts)[codes])
        own = units.indices.to_numpy()[at]
        at, ends = _ragged(starts[own], sizes[own])
        bounds = split.offsets.to_numpy().astype(np.int64)
        return flat[at], np.diff(ends[part_ends[bounds - bounds[0]]])

    def _encoded(self, parts: list[str]) -> list[bytes]:
        simple = pc.and_(pc.match_substring_regex(pa.array(parts, pa.string()), _SIMPLE), pc.invert(pc.match_substring(pa.array(parts, pa.string()), _SPECIAL)))
        simple = simple.to_pylist()
        joined = iter(self._tokenized_parts([p for p, s in zip(parts, simple, strict=True) if s and p]))
        others = iter(self._tokenized([p for p, s in zip(parts, simple, strict=True) if not s]))
        return [next(others) if not s else next(joined) if p else b"" for p, s in zip(parts, simple, strict=True)]

    def _tokenized_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of parts, many at a time: the last id of each has the ending of words."""
        found: list[bytes] = []
        lists = [parts[k : k + _JOINED_PARTS] for k in range(0, len(parts), _JOINED_PARTS)]
        joined = self.tokenizer.encode_batch_fast([" ".join(x) for x in lists], add_special_tokens=False) if lists else []
        for own, e in zip(lists, joined, strict=True):
            ids = array("I", e.ids)
            cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist() if len(self.ends) else []
            if len(cuts) == len(own):
                raw = ids.tobytes()
                found += [raw[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]
            else:
                found += self._tokenized(own)
        return found

    def _tokenized(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [array("I", e.ids).tobytes() for e in found]

    def _places(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, size) of each part's ids in an array, and the array."""
        place = self.known.get
        places = np.fromiter((place(p, -1) for p in parts), np.int64, count=len(parts))
        fresh = np.flatnonzero(places < 0)
        if not len(fresh):
            return self.kept.starts[places], self.kept.sizes[places], self.kept.flat
        encoded = self._encoded([parts[k] for k in fresh])
        room = max(REMEMBERED_WORDS - len(self.known), 0)
        for k in fresh[:room].tolist():
            places[k] = self.known[parts[k]] = len(self.known)
        self.kept.extend(encoded[:room])
        # parts beyond that are forgotten after the batch
        other = _Ragged()
        other.extend(encoded[room:])
        places[fresh[room:]] = self.kept.count + np.arange(other.count)
        starts = np.concatenate((self.kept.starts[: self.kept.count], other.starts[: other.count] + self.kept.used))
        sizes = np.concatenate((self.kept.sizes[: self.kept.count], other.sizes[: other.count]))
        flat = np.concatenate((self.kept.flat[: self.kept.used], other.flat[: other.used])) if other.count else self.kept.flat
        return starts[places], sizes[places], flat


def _parts_of(words: pa.Array) -> pa.ListArray:
    """The parts of each word; a word that is not simple is one part."""
    simple = pc.and_(pc.match_substring_regex(words, _SIMPLE), pc.invert(pc.match_substring(words, _SPECIAL)))
    spaced = pc.replace_substring_regex(pc.utf8_lower(words), _PARTS, r"\1 ")
    return pc.ascii_split_whitespace(pc.ascii_rtrim_whitespace(pc.if_else(simple, spaced, words)))


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of runs that begin at ``starts``, one run after the other, and where each run begins and the last ends."""
    ends = np.concatenate(([0], np.cumsum(sizes)))
    return np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1]), ends


class _Ragged:
    """Lists of ids end to end in one growing array."""

    def __init__(self):
        self.flat = np.empty(0, "<u4")
        self.starts = self.sizes = np.empty(0, np.int64)
        self.used = self.count = 0

    def extend(self, lists: list[bytes]) -> None:
        sizes = np.fromiter(map(len, lists), np.int64, count=len(lists)) // 4
        total = int(sizes.sum())
        self.flat = _with_room(self.flat, self.used, total)
        self.starts, self.sizes = (_with_room(x, self.count, len(lists)) for x in (self.starts, self.sizes))
        self.flat[self.used : self.used + total] = np.frombuffer(b"".join(lists), "<u4")
        own = slice(self.count, self.count + len(lists))
        self.sizes[own] = sizes
        self.starts[own] = self.used + np.cumsum(sizes) - sizes
        self.used += total
        self.count += len(lists)


def _with_room(array: np.ndarray, used: int, more: int) -> np.ndarray:
    if used + more <= len(array):
        return array
    grown = np.empty(max(used + more, 2 * len(array)), array.dtype)
    grown[:used] = array[:used]
    return grown


@lru_cache(maxsize=2)
def _encoder(name: str) -> WordEncoder:
    return WordEncoder(name)


def _segment(part: int, seq: int, doc_ids: list, ids: list[np.ndarray]) -> pa.RecordBatch:
    every = np.concatenate(ids).astype(np.int64)
    counts = np.bincount(every)
    ranks = np.argsort(-counts, kind="stable")[: int((counts > 0).sum())]
    rank_of = np.zeros(len(counts), np.int64)
    rank_of[ranks] = np.arange(len(ranks))
    words, offsets, escapes = simple8b.pack(rank_of[every])
    row = {
        "part": part,
        "seq": seq,
        "n_ids": len(every),
        "doc_ids": doc_ids,
        "doc_tokens": [len(x) for x in ids],
        "ranks": ranks.astype("<u4").tobytes(),
        "offsets": offsets.astype("<u4").tobytes(),
        "escapes": escapes.astype("<u8").tobytes(),
        "words": words.astype("<u8").tobytes(),
    }
    return pa.RecordBatch.from_pylist([row], _SEGMENT_SCHEMA)


_SEGMENT_SCHEMA = pa.schema(
    [
        ("part", pa.int32()),
        ("seq", pa.int32()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("doc_tokens", pa.list_(pa.int64())),
        ("ranks", pa.binary()),
        ("offsets", pa.binary()),
        ("escapes", pa.binary()),
        ("words", pa.binary()),
    ]
)


def segment_ids(row: dict) -> np.ndarray:
    """All token ids of a segment."""
    ranks = np.frombuffer(row["ranks"], "<u4")
    packed = (np.frombuffer(row[k], t) for k, t in (("words", "<u8"), ("offsets", "<u4"), ("escapes", "<u8")))
    return ranks[simple8b.unpack(*packed, row["n_ids"]).astype(np.int64)]


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Writes the ids of every text, each document with ``end_id`` after it, in ascending doc_id order.

    Null texts are empty: they have the end id alone. Null ids come first. Rows with the same doc_id are ordered by a
    hash of their text and each is written; they may be dealt over several tasks. No rows give no segments. Other
    columns are not written. A document is never cut, so a segment holds at least one whole document. The number of
    files follows the size of the texts.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seq, size = _encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        doc_ids: list = []
        held: list[np.ndarray] = []
        for batch in batches:
            at = 0
            for piece in pieces(batch.column("text"), _PIECE_BYTES):
                ids, sizes = encoder.encode_column(piece)
                ends = np.cumsum(sizes)
                own = np.split(np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1))
                for doc_id, tokens in zip(batch.column("doc_id").slice(at, len(piece)).to_pylist(), own):
                    doc_ids.append(doc_id)
                    held.append(tokens)
                    size += len(tokens)
                    if size >= segment_ids:
                        yield _segment(part, seq, doc_ids, held)
                        doc_ids, held, size, seq = [], [], 0, seq + 1
                at += len(piece)
        if held:
            yield _segment(part, seq, doc_ids, held)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", fold(F.col("text")).alias("text_key"))
    parts = _parts(docs)
    ordered = rows.repartitionByRange(parts, "doc_id", "text_key").sortWithinPartitions("doc_id", "text_key")
    ordered.select("doc_id", "text").mapInArrow(encode, _SEGMENT).write.parquet(path)


def _parts(docs: DataFrame) -> int:
    """Number of ranges: by the size of all texts, and enough of them to keep all cores busy with less."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-size // PART_BYTES), min(-(-size // _PIECE_BYTES), 3 * cores))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files; start counts the ids before it in all files."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                ids = segment_ids(row)
                ends = np.cumsum(np.array(row["doc_tokens"], np.int64))
                starts = ends - np.array(row["doc_tokens"], np.int64)
                crcs = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([row["part"]] * len(ends), pa.int32()),
                        "seq": pa.array([row["seq"]] * len(ends), pa.int32()),
                        "doc_id": pa.array(row["doc_ids"], pa.int64()),
                        "offset": pa.array(starts),
                        "n_tokens": pa.array(row["doc_tokens"], pa.int64()),
                        "ids_crc32": pa.array(crcs, pa.int64()),
                    }
                )

    segments = spark.read.parquet(path)
    read = segments.mapInArrow(
        decode, "part int, seq int, doc_id bigint, offset bigint, n_tokens bigint, ids_crc32 bigint"
    )
    sizes = segments.select("part", "seq", "n_ids")
    ahead = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n_ids")).select("part", F.coalesce(ahead, F.lit(0)).alias("base"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", "seq", F.coalesce(within, F.lit(0)).alias("ahead")).join(parts, "part")
    return read.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("ahead") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, ids) of every document in the files, the end id included."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                sizes = np.array(row["doc_tokens"], np.int64)
                ids = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(segment_ids(row).astype(np.int64))
                )
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), ids], ["doc_id", "ids"])

    return spark.read.parquet(path).mapInArrow(decode, "doc_id bigint, ids array<bigint>")

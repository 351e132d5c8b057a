"""Spelling variants: words one edit apart, found with a bit-sliced position index.

The index of a bucket of words has, for each place and letter, the set of words with that letter there, as the bits of
one integer. A word is looked up letter by letter: a few and/or operations take the sets of all words that agree so far
with no error or with one replaced, missing or extra letter to the next place, for all words of the bucket at once.

Words of which one edit makes the other share their first or their last half, so the vocabulary is dealt out by such
halves; no task has the whole vocabulary. A bucket with too many words is dealt out again by the halves of what its
words do not share yet, until two letters at most are open.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.common import byte_texts, landed

LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A near word is the form of a word if it is at least so many times as frequent.
FORM_FACTOR = 5
#: Words that share a bucket; where more do, they are dealt out by more letters.
BUCKET_WORDS = 1 << 14
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 1 << 19
_BATCH = 1 << 16

#: ASCII letters in lower case, and the bytes of U+00C0 to U+00FF; all else separates.
_RUNS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c == 0xC3 or 0x80 <= c <= 0xBF else 0x20 for c in range(256)
)
#: Characters of several bytes that are no letters.
_OTHERS = re.compile(rb"[\xc2\xc4-\xf4][\x80-\xbf]+")

_COUNT = pa.schema([("word", pa.string()), ("n", pa.int64())])
_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def runs(text: bytes) -> list[bytes]:
    """Maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case."""
    return (text if text.isascii() else _OTHERS.sub(b" ", text)).translate(_RUNS).split()


def _cut(run: bytes, doc_id: int, one_in: int, seen: int) -> bytes:
    """The run, without one letter if ``one_in`` divides the crc32 of id and run."""
    h = zlib.crc32(run, seen)
    if h % one_in:
        return run
    letters = run.decode()
    k = h % len(letters)
    return (letters[:k] + letters[k + 1 :]).encode()


def _length(word: bytes) -> int:
    return len(word) - word.count(b"\xc3")


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, cut_one_in: int = 0) -> DataFrame:
    """(word, n): the words of all texts with at least ``least_length`` letters and ``least_count`` occurrences.

    Words are ``runs``. If ``cut_one_in`` is not 0, a run of a document loses the letter crc32 % length where that number
    divides the crc32 of ``<doc_id>:<run>``; documents with a null id lose none. Null texts have no words; repeated rows
    count one by one. Other columns are ignored.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text")), strict=True):
                own = Counter(runs(text))
                if cut_one_in and doc_id is not None:
                    seen = zlib.crc32(f"{doc_id}:".encode())
                    for run, n in own.items():
                        total[_cut(run, doc_id, cut_one_in, seen)] += n
                else:
                    total.update(own)
                if len(total) > HELD_WORDS:
                    yield from handed_on(total)
                    total.clear()
        yield from handed_on(total)

    def handed_on(total: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        items = [(w, n) for w, n in total.items() if _length(w) >= least_length]
        for at in range(0, len(items), _BATCH):
            words, counts = zip(*items[at : at + _BATCH], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], schema=_COUNT)

    counts = docs.select("doc_id", "text").mapInArrow(counted, "word string, n bigint")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class PositionIndex:
    """Words by place and letter; the word of rank k is bit k of every set."""

    def __init__(self, words: list[str]):
        self.all = (1 << len(words)) - 1
        width = len(words) // 8 + 1
        places: list[dict[str, bytearray]] = [{} for _ in range(max(map(len, words), default=0))]
        lengths: dict[int, bytearray] = {}
        for k, word in enumerate(words):
            byte, bit = k >> 3, 1 << (k & 7)
            lengths.setdefault(len(word), bytearray(width))[byte] |= bit
            for place, letter in zip(places, word):
                if letter not in place:
                    place[letter] = bytearray(width)
                place[letter][byte] |= bit
        self.places = [{c: int.from_bytes(b, "little") for c, b in p.items()} for p in places]
        self.places.append({})
        self.lengths = {n: int.from_bytes(b, "little") for n, b in lengths.items()}

    def near(self, word: str, apart: int | None = None) -> tuple[int, int, int]:
        """Sets of the words that ``word`` becomes by one replaced, one deleted and one inserted letter.

        Words that share the first ``apart`` letters with it are left out.
        """
        places = self.places
        # words that agree so far: without error, and with one of each kind behind
        same, replaced, deleted, inserted = self.all, 0, 0, 0
        left = self.all if apart is None else 0
        for i, c in enumerate(word):
            if i == apart:
                left = self.all ^ same
            here = places[i].get(c, 0) if i < len(places) else 0
            before = places[i - 1].get(c, 0) if 0 < i <= len(places) else 0
            after = places[i + 1].get(c, 0) if i + 1 < len(places) else 0
            agree = same & here
            replaced = (replaced & here) | (same ^ agree)
            deleted = (deleted & before) | same
            inserted = (inserted | same) & after
            same = agree
            if not (same or replaced or deleted or inserted):
                return 0, 0, 0
        if apart is not None and apart >= len(word):
            left = self.all ^ (same if apart == len(word) else 0)
        size, none = len(word), 0
        return (
            replaced & self.lengths.get(size, none) & left,
            deleted & self.lengths.get(size - 1, none) & left,
            (inserted | same) & self.lengths.get(size + 1, none) & left,
        )


def _bucket_near(key: str, members: list[tuple[str, int]]) -> Iterator[tuple[str, int, int, str]]:
    """(word, number of near words, the largest n and its first word) in a bucket of words of m or m + 1 letters.

    Pairs of two words of m + 1 letters belong to another bucket.
    """
    m, _, _, apart, *_ = key.split(" ")
    shorter = int(m)
    if len(members) < 2 or min(len(w) for w, _ in members) > shorter:
        return
    members.sort(key=lambda x: (-x[1], x[0]))
    index = PositionIndex([w for w, _ in members])
    limit = int(apart) if int(apart) >= 0 else None
    for word, _ in members:
        replaced, deleted, inserted = index.near(word, limit)
        found = replaced | inserted if len(word) == shorter else deleted
        if found:
            best, n = members[(found & -found).bit_length() - 1]
            yield word, found.bit_count(), n, best


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words bucket by bucket; rows come sorted by key."""
    out: list[tuple] = []

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _NEAR, strict=True)], schema=_NEAR)

    for key, members in _buckets(batches):
        out.extend(_bucket_near(key, members))
        if len(out) >= _BATCH:
            yield packed(out)
            out = []
    if out:
        yield packed(out)


def _buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, list[tuple[str, int]]]]:
    open_key, members = None, []
    for batch in batches:
        for key, word, n in zip(*(batch.column(c).to_pylist() for c in ("key", "word", "n")), strict=True):
            if key != open_key:
                if members:
                    yield open_key, members
                open_key, members = key, []
            members.append((word, n))
    if members:
        yield open_key, members


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds the key: what the words of a bucket share. ``apart`` is -1, or the first letters that no pair shares."""
    head, tail = F.expr("left(word, lo)"), F.expr("right(word, hi)")
    return rows.where("apart < 0 or lo < apart").withColumn("key", F.concat_ws(" ", "m", "lo", "hi", "apart", head, tail))


def _halves(rows: DataFrame) -> DataFrame:
    """Every row twice: with the first and with the last half of its open letters shared."""
    half = F.expr("int((m - lo - hi) div 2)")
    apart = F.when(F.col("apart") < 0, F.col("lo") + half).otherwise(F.least("apart", F.col("lo") + half))
    first = F.struct((F.col("lo") + half).alias("lo"), F.col("hi"), F.col("apart"))
    last = F.struct(F.col("lo"), (F.col("hi") + half).alias("hi"), apart.alias("apart"))
    return _keyed(rows.select("word", "n", "m", F.explode(F.array(first, last)).alias("x")).select("word", "n", "m", "x.*"))


def near_words(words: DataFrame, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) for every word of ``words`` (word, n) that has near words, exactly one edit away.

    ``best`` is the near word with the largest n (ties: the smallest). Words are distinct and of two letters or more.
    Every pair is found in one bucket alone; a bucket of more than ``bucket_words`` words is dealt out by more letters
    while that separates any, so that no bucket is larger than the number of strings of two letters.
    """
    lengths = F.sequence(F.length("word") - 1, F.length("word"))
    rows = words.select("word", "n", F.explode(lengths).alias("m")).where("m > 1")
    rows = landed(_halves(rows.selectExpr("*", "0 as lo", "0 as hi", "-1 as apart")), "words")
    found = None
    while True:
        sizes = rows.groupBy("key", (F.col("m") - F.col("lo") - F.col("hi") > 1).alias("open")).agg(F.count("*").alias("words"))
        large = landed(sizes.where(F.col("open") & (F.col("words") > bucket_words)).select("key"), "large-buckets")
        more = not large.isEmpty()
        own = rows.join(large, "key", "left_anti") if more else rows
        near = own.select("key", "word", "n").repartition("key").sortWithinPartitions("key").mapInArrow(
            _search, "word string, n_near bigint, best_n bigint, best string"
        )
        found = near if found is None else found.union(near)
        if not more:
            break
        rows = landed(_halves(rows.join(large, "key", "left_semi")), "words")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("x")).select(
        "word", "n_near", (-F.col("x.less")).alias("best_n"), "x.best"
    )


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of every word with a form: the end of its chain. Each round follows twice as many forms at once.

    Counts rise by ``FORM_FACTOR`` with every form, so chains are short. Both sides of the join are written tables, so
    that Spark can split a form which very many words have.
    """
    links = landed(links.select("word", F.col("form").alias("root")), "forms")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = landed(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def grouped(words: DataFrame, form_factor: int = FORM_FACTOR, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """(word, n, form, form_n, n_near, root) for every word of ``words`` (word, n).

    Words are near if they differ by exactly one inserted, deleted or replaced letter. The form of a word is its near
    word of largest n (ties: the smallest in code-point order) if that is at least ``form_factor`` times its own n, else
    null; its root is what one reaches by following forms. Words are distinct, not null and of two letters or more. No
    words give no rows.
    """
    words = landed(words.select("word", "n"), "vocabulary")
    near = landed(near_words(words, bucket_words), "near-words")
    is_form = F.col("best_n") >= form_factor * F.col("n")
    named = landed(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.when(is_form, F.col("best")).alias("form"),
            F.when(is_form, F.col("best_n")).alias("form_n"),
            F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        ),
        "named-words",
    )
    roots = _roots(named.where("form is not null"))
    return named.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))

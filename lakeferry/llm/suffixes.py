"""Benchmark decontamination with suffix arrays over shards of the documents.

The suffixes of a shard are ranked together with the suffixes of the items by prefix doubling, so that equal ranks mean
equal words and places can be compared without their words. Every distinct window of the items is searched in the sorted
ranks of the shard; what a place has in common with the items is then the longest of its two neighbours among the sorted
item suffixes. Work and output follow the number of places, however often a window repeats in either text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.common import byte_texts, fold, pieces

WINDOW_WORDS = 10
#: Bytes of document text in one shard, and of item text in one block of test suffixes.
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 4 << 20
#: Bytes of item text that are sent to the tasks for one scan of the documents.
PASS_BYTES = 64 << 20

#: Other bytes than digits, letters and those of non-ASCII characters separate words; A-Z becomes a-z.
_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)
_SPAN = "start:bigint,length:bigint,item_id:bigint,match_start:bigint,match_length:bigint"
_FOUND = f"struct<n_words:bigint,spans:array<struct<{_SPAN}>>,item_ids:array<bigint>>"
_SPAN_FIELDS = ("start", "length", "item_id", "match_start", "match_length")


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class TestSuffixes:
    """The items of one block as numbers of the words that occur in the block; every item ends in a word of its own.

    ``places`` has for each length of a window where such windows of the items begin, and ``owners`` the item of each.
    """

    def __init__(self, items: list[tuple[int | None, bytes]], window: int):
        self.window = window
        self.numbers: dict[bytes, int] = {}
        self.ids: list[int | None] = []
        split = [(item_id, own) for item_id, text in items if (own := words(text))]
        tokens: list[int] = []
        places: dict[int, list[np.ndarray]] = {}
        owners: dict[int, list[np.ndarray]] = {}
        self.longest = max((len(own) for _, own in split), default=0)
        for k, (item_id, own) in enumerate(split):
            size = min(window, len(own))
            begins = len(tokens) + np.arange(len(own) - size + 1)
            places.setdefault(size, []).append(begins)
            owners.setdefault(size, []).append(np.full(len(begins), k))
            tokens += [self.numbers.setdefault(w, len(self.numbers)) for w in own]
            tokens.append(-1)
            self.ids.append(item_id)
        self.tokens = np.array(tokens, np.int64)
        self.places = {n: np.concatenate(p) for n, p in places.items()}
        self.owners = {n: np.concatenate(o) for n, o in owners.items()}
        self.shortest = min(self.places, default=0)


class Shard:
    """The words of some texts one after the other, each text followed by a place of its own."""

    def __init__(self, texts: list[bytes]):
        split = [words(t) for t in texts]
        self.sizes = np.array([len(s) for s in split], np.int64)
        self.begins = np.concatenate(([0], np.cumsum(self.sizes + 1)))
        self.words = split

    def numbers(self, known: dict[bytes, int]) -> np.ndarray:
        """Numbers of all words; -1 for words that are not known and for the ends of texts."""
        get = known.get
        every = (n for own in self.words for n in (*(get(w, -1) for w in own), -1))
        return np.fromiter(every, np.int64, count=int(self.begins[-1]))

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, places, side="right") - 1


class SuffixRanks:
    """Ranks of all suffixes of the items and of the parts of a shard in which every word occurs in the items.

    No match contains another word, so such words only separate parts; parts shorter than the shortest window are left
    out. ``levels[k]`` ranks the suffixes by their first 2^k words. ``origin`` has the place in the shard.
    """

    def __init__(self, numbers: np.ndarray, tests: TestSuffixes):
        known = np.concatenate(([False], numbers >= 0, [False]))
        begins, ends = np.flatnonzero(known[1:] & ~known[:-1]), np.flatnonzero(known[:-1] & ~known[1:])
        fits = ends - begins >= tests.shortest
        begins, ends = begins[fits], ends[fits]
        sizes = ends - begins + 1
        self.origin = np.repeat(begins - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        own = np.concatenate((numbers, [-1]))[self.origin]
        self.items = len(tests.tokens)
        tokens = np.concatenate((tests.tokens, own))
        ends = np.flatnonzero(tokens < 0)
        tokens[ends] = len(tests.numbers) + np.arange(len(ends))
        self.levels = [tokens]
        width = 1
        while len(own) and width < tests.longest:
            rank = self.levels[-1]
            _, wider = np.unique(rank * (int(rank.max()) + 2) + self._at(rank, width), return_inverse=True)
            self.levels.append(wider.astype(np.int64))
            width *= 2
            if int(wider.max()) + 1 == len(tokens):
                break

    @staticmethod
    def _at(rank: np.ndarray, ahead: int) -> np.ndarray:
        """One more than the rank so many words ahead, 0 beyond the end."""
        moved = np.zeros(len(rank), np.int64)
        moved[: len(rank) - ahead] = rank[ahead:] + 1
        return moved

    def prefixes(self, size: int) -> np.ndarray:
        """A number for the first ``size`` words of every suffix."""
        level = min(size.bit_length() - 1, len(self.levels) - 1)
        rank = self.levels[level]
        # an early end of doubling means that no two suffixes share more words
        ahead = size - (1 << level) if size < 2 << level else 0
        return rank * (int(rank.max()) + 2) + (self._at(rank, ahead) if ahead else 0)

    def common(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Number of first words that suffixes share, pair by pair."""
        length = np.zeros(len(one), np.int64)
        for k in reversed(range(len(self.levels))):
            # a match ends before the end of its item, so this ends at the last place at most
            rank = self.levels[k]
            a, b = one + length, other + length
            inside = (a < len(rank)) & (b < len(rank))
            same = inside.copy()
            same[inside] = rank[a[inside]] == rank[b[inside]]
            length[same] += 1 << k
        return length


def matches(shard: Shard, tests: TestSuffixes) -> tuple[np.ndarray, ...]:
    """(place, length, item) of the longest match at each place of the shard, and (text, item) of the items found.

    A match is a window of an item at least. Items are numbers in the block.
    """
    none = np.empty(0, np.int64)
    ranks = SuffixRanks(shard.numbers(tests.numbers), tests)
    if not len(ranks.origin):
        return (none,) * 5
    place, length, item, texts, found = [], [], [], [], []
    for size, begins in tests.places.items():
        keys = ranks.prefixes(size)
        order = np.argsort(keys[ranks.items :], kind="stable")
        own = keys[ranks.items :][order]
        windows, kind = np.unique(keys[begins], return_inverse=True)
        low, high = np.searchsorted(own, windows, "left"), np.searchsorted(own, windows, "right")
        counts = high - low
        window = np.repeat(np.arange(len(windows)), counts)
        if not len(window):
            continue
        at = order[np.arange(len(window)) - np.repeat(np.cumsum(counts) - counts, counts) + low[window]]
        first = np.full(len(windows), len(tests.ids))
        np.minimum.at(first, kind, tests.owners[size])
        longest, owner = np.full(len(at), size), first[window]
        if size == tests.window:
            longest, owner = _longest(ranks, at + ranks.items, begins, tests.owners[size])
        place.append(ranks.origin[at])
        length.append(longest)
        item.append(owner)
        hit_texts, hit_items = _items_found(shard.text_of(ranks.origin[at]), window, kind, tests.owners[size])
        texts.append(hit_texts)
        found.append(hit_items)
    if not place:
        return (none,) * 5
    return tuple(map(np.concatenate, (place, length, item, texts, found)))


def _longest(ranks: SuffixRanks, at: np.ndarray, begins: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Length and item of the longest match of each suffix: one of its neighbours among the sorted item suffixes."""
    rank = ranks.levels[-1]
    order = np.argsort(rank[begins], kind="stable")
    begins, owners = begins[order], owners[order]
    after = np.searchsorted(rank[begins], rank[at])
    near = [np.clip(after + d, 0, len(begins) - 1) for d in (-1, 0)]
    lengths = [ranks.common(at, begins[n]) for n in near]
    second = lengths[1] > lengths[0]
    return np.where(second, lengths[1], lengths[0]), owners[np.where(second, near[1], near[0])]


def _items_found(texts: np.ndarray, window: np.ndarray, kind: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, item) for every item of which a text has a window, each once. Windows of the same items count as one."""
    pairs = np.unique(np.stack((kind, owners)), axis=1)
    cuts = np.flatnonzero(np.diff(pairs[0], prepend=-1))
    sets: dict[bytes, int] = {}
    group = np.array([sets.setdefault(own.tobytes(), len(sets)) for own in np.split(pairs[1], cuts[1:])])
    items = [np.frombuffer(own, np.int64) for own in sets]
    hits = np.unique(np.stack((texts, group[window])), axis=1)
    sizes = np.array([len(x) for x in items])[hits[1]]
    every = np.concatenate([items[g] for g in hits[1].tolist()])
    pairs = np.unique(np.stack((np.repeat(hits[0], sizes), every)), axis=1)
    return pairs[0], pairs[1]


def merged(place: np.ndarray, length: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, length, item, match_start, match_length) of the runs of words that matches cover, with the longest match
    of each run (ties: the first) and its item."""
    order = np.lexsort((item, -length, place))
    place, length, item = place[order], length[order], item[order]
    end = np.maximum.accumulate(place + length)
    new = np.concatenate(([True], place[1:] > end[:-1]))
    run = np.cumsum(new) - 1
    last = np.append(np.flatnonzero(new)[1:], len(place)) - 1
    best = np.lexsort((item, place, -length, run))[np.flatnonzero(new)]
    start = place[new]
    return start, end[last] - start, item[best], place[best], length[best]


def shard_matches(texts: list[bytes], blocks: list[TestSuffixes]) -> pa.StructArray:
    """n_words, spans and item_ids of each text of a shard; positions in spans are word numbers within the text."""
    shard = Shard(texts)
    ids: list[int | None] = []
    parts = []
    for tests in blocks:
        place, length, item, hit_texts, hit_items = matches(shard, tests)
        parts.append((place, length, item + len(ids), hit_texts, hit_items + len(ids)))
        ids += tests.ids
    place, length, item, hit_texts, hit_items = (np.concatenate(p) for p in zip(*parts, strict=True))
    size = len(texts)
    start, covered, owner, at, longest = merged(place, length, item) if len(place) else (place,) * 5
    text = shard.text_of(start)
    named = pa.array(ids, pa.int64())
    columns = [start - shard.begins[text], covered, named.take(pa.array(owner)), at - shard.begins[text], longest]
    spans = pa.StructArray.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], _SPAN_FIELDS)
    # items of one id are one item
    distinct = {x: k for k, x in enumerate(dict.fromkeys(ids))}
    same = np.array([distinct[x] for x in ids], np.int64)
    pairs = np.unique(np.stack((hit_texts, same[hit_items])), axis=1) if len(hit_texts) else np.empty((2, 0), np.int64)
    found = pa.array([*distinct], pa.int64()).take(pa.array(pairs[1]))
    lists = [pa.ListArray.from_arrays(_offsets(t, size), v) for t, v in ((text, spans), (pairs[0], found))]
    return pa.StructArray.from_arrays([pa.array(shard.sizes), *lists], ["n_words", "spans", "item_ids"])


def _offsets(texts: np.ndarray, size: int) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum(np.bincount(texts, minlength=size)))), pa.int32())


def shard_spans(texts: list[bytes], tests: TestSuffixes) -> Iterator[tuple[int, list[dict]]]:
    """(words, spans) of each text of a shard for one block of items."""
    for found in shard_matches(texts, [tests]).to_pylist():
        yield found["n_words"], [{k: s[k] for k in _SPAN_FIELDS[:3]} for s in found["spans"]]


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items in blocks of bounded size: the driver holds the blocks of one scan at a time."""
    block, size = [], 0
    for row in items.select("item_id", "text").toLocalIterator():
        text = (row["text"] or "").encode()
        if block and size + len(text) > block_bytes:
            yield block
            block, size = [], 0
        block.append((row["item_id"], text))
        size += len(text)
    yield block


def _search(sent, shard_bytes: int):
    """Column function that gives the words, spans and items of a text for some blocks of items."""

    @F.arrow_udf(_FOUND)
    def search(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            found = [shard_matches([*byte_texts(p)], sent.value) for p in pieces(column, shard_bytes)]
            yield pa.concat_arrays(found) if found else shard_matches([], sent.value)

    return search


def _searches(docs: DataFrame, items: DataFrame, window: int, shard_bytes: int, block_bytes: int) -> Iterator:
    """One search for each scan of the documents: as many blocks as are sent at once."""
    context = docs.sparkSession.sparkContext
    held: list[TestSuffixes] = []
    size = 0
    for block in _blocks(items, block_bytes):
        own = sum(len(text) for _, text in block)
        if held and size + own > PASS_BYTES:
            yield _search(context.broadcast(held), shard_bytes)
            held, size = [], 0
        held.append(TestSuffixes(block, window))
        size += own
    yield _search(context.broadcast(held), shard_bytes)


def benchmark_spans(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW_WORDS,
    shard_bytes: int = SHARD_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, text_key, n_words, spans, item_ids) for every document: where it repeats the items word for word.

    A span (start, length, item_id, match_start, match_length) is a run of words that matches cover, with the longest
    match in it and an item that has it. A match is the longest run of words that an item and a place of a document have
    in common, at least ``window`` words or the whole of a shorter item; positions and lengths count words. ``item_ids``
    are the items of which the document has a window, each once. Words are runs of digits, letters and non-ASCII
    characters, A-Z in lower case. Null or empty texts have no words and no spans; items with a null id are searched
    like others and stand in ``item_ids`` as one null; items without words match nothing; repeated items count once,
    repeated rows one by one. Other columns are ignored. No documents give no rows, no items give documents without
    spans.

    The items are sent in blocks of at most ``block_bytes`` (or one item), ``PASS_BYTES`` of them for one scan of the
    documents; larger benchmarks scan the documents again.
    """
    passes = [
        docs.select("doc_id", fold(F.col("text")).alias("text_key"), search("text").alias("found"))
        for search in _searches(docs, items, window, shard_bytes, block_bytes)
    ]
    if len(passes) == 1:
        return passes[0].select("doc_id", "text_key", "found.*")
    every = passes[0]
    for one in passes[1:]:
        every = every.unionByName(one)
    # equal rows have equal results, so copies of a row are told apart by their number alone
    whole = every.groupBy("doc_id", "text_key").agg(
        F.max("found.n_words").alias("n_words"),
        F.array_distinct(F.flatten(F.collect_list("found.spans"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("found.item_ids"))).alias("item_ids"),
        (F.count("*") / len(passes)).cast("int").alias("copies"),
    )
    return whole.select("doc_id", "text_key", "n_words", "spans", "item_ids", F.explode(F.sequence(F.lit(1), "copies"))).drop("col")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, n_items, item_ids, contaminated) for every document; see ``benchmark_spans``.

    n_hit counts the words inside any span, n_items the items found (those with a null id are one); item_ids are their
    ids but null, in the order of their texts.
    """
    found = benchmark_spans(docs, items, window)
    # spans sorted by start: each adds its words beyond the furthest end so far
    step = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("hit")),
        lambda s, x: F.struct(
            F.greatest(s["end"], x["start"] + x["length"]).alias("end"),
            (s["hit"] + F.greatest(F.lit(0).cast("bigint"), x["start"] + x["length"] - F.greatest(s["end"], x["start"]))).alias("hit"),
        ),
        lambda s: s["hit"],
    )
    ids = F.array_sort(F.transform(F.filter("item_ids", lambda x: x.isNotNull()), lambda x: x.cast("string")))
    return found.select(
        "doc_id",
        "text_key",
        "n_words",
        step.alias("n_hit"),
        F.size("item_ids").cast("bigint").alias("n_items"),
        ids.alias("item_ids"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """The documents that repeat no window of any item, with all their columns, whatever these are called.

    Null and empty texts stay, repeated rows stay or go together; no documents give no rows, no items keep all.
    """
    for search in _searches(docs, items, window, SHARD_BYTES, BLOCK_BYTES):
        docs = docs.where(F.size(search(F.col("text"))["spans"]) == 0)
    return docs

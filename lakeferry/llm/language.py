"""Language identification by prediction by partial matching: the language whose model codes a text in fewest bits."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.llm.common import byte_texts, part_of_id, pieces

HELD_OUT_PART, PARTS = 1, 3
UNKNOWN = "und"
#: Longest context in bytes.
ORDER = 3
#: The fit uses about this many documents of each language, chosen by a hash of their id, and this many bytes of them.
FIT_DOCS = 400
FIT_BYTES = 1 << 20
_PIECE_BYTES = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
#: A-Z as a-z, digits as 0, control characters as spaces; byte 0 stands for the start of a text.
_FOLD = bytes(
    0x20 if c < 0x20 else c + 32 if 0x41 <= c <= 0x5A else 0x30 if 0x30 <= c <= 0x39 else c for c in range(256)
)


@dataclass
class LanguageModel:
    """Byte context trees of all languages over one set of nodes, with their code lengths.

    A node is a string of bytes seen in some language: ``child[k]`` leads from a node of k bytes, by the next byte, to
    one of k + 1 (0 where there is none). ``cost[k]`` has the bits that each language pays for the last byte of a node
    of k + 1 bytes after the others, ``escape[k]`` those for leaving a context of k bytes.
    """

    languages: list[str]
    symbols: np.ndarray = field(default_factory=lambda: np.zeros(256, np.int64))
    child: list[np.ndarray] = field(default_factory=list)
    cost: list[np.ndarray] = field(default_factory=list)
    escape: list[np.ndarray] = field(default_factory=list)

    def bits(self, texts: list[bytes], chunk: int = _PIECE_BYTES) -> np.ndarray:
        """Exact code length of each text (rows) in each language (columns).

        Long texts are coded in chunks, each after as many bytes of the one before it as a context has; what these cost
        by themselves is taken off again.
        """
        order = max(len(self.cost) - 1, 0)
        total = self._bits([t[:chunk] for t in texts])
        for row, text in zip(total, texts, strict=True):
            for at in range(chunk, len(text), chunk):
                own, before = self._bits([text[at - order : at + chunk], text[at - order : at]])
                row += own - before
        return total

    def _bits(self, texts: list[bytes]) -> np.ndarray:
        total = np.zeros((len(texts), len(self.languages)))
        if not texts or not self.languages:
            return total
        joined = np.frombuffer(b"\0".join([b"", *(t.translate(_FOLD) for t in texts)]), np.uint8)
        x = self.symbols[joined]
        starts = np.flatnonzero(joined == 0)
        nodes = [np.zeros(len(x), np.int64)]
        for k in range(len(self.child)):
            before = np.concatenate(([0], nodes[k][:-1])) if k else nodes[0]
            nodes.append(self.child[k][before, x].astype(np.int64))
            if not k:
                nodes[1][starts] = 0
            else:
                # a context ends at the start of a text: the nodes before it are those of the last text
                nodes[k + 1][before == 0] = 0
        paid = np.zeros((len(x), len(self.languages)), np.float32)
        left = np.arange(len(x))
        for k in reversed(range(len(self.cost))):
            node = nodes[k + 1][left]
            hit = node > 0
            paid[left[hit]] += self.cost[k][node[hit]]
            left = left[~hit]
            if k:
                context = nodes[k][left - 1]
                inside = (left > 0) & (context > 0)
                paid[left[inside]] += self.escape[k][context[inside]]
        paid[left] += self.escape[0][0] + np.float32(8)
        paid[starts] = 0
        return np.add.reduceat(paid, starts, axis=0, dtype=np.float64)


def train(texts: dict[str, list[bytes]], order: int = ORDER) -> LanguageModel:
    """Counts the contexts of each language and fixes their code lengths (escapes by method C)."""
    languages = sorted(texts)
    if not languages:
        return LanguageModel([])
    counts: list[dict[bytes, np.ndarray]] = []
    for k in range(order + 1):
        level: dict[bytes, np.ndarray] = {}
        for at, language in enumerate(languages):
            grams: Counter = Counter()
            for text in texts[language]:
                own = text.translate(_FOLD).replace(b"\0", b" ")
                grams.update(own[i : i + k + 1] for i in range(len(own) - k))
            for gram, n in grams.items():
                level.setdefault(gram, np.zeros(len(languages)))[at] = n
        counts.append(level)
    seen = sorted({g[0] for g in counts[0]})
    model = LanguageModel(languages)
    model.symbols[seen] = np.arange(1, len(seen) + 1)
    number: dict[bytes, int] = {b"": 0}
    contexts = {b"": sum(counts[0].values(), np.zeros(len(languages)))}
    lower: dict[bytes, np.ndarray] = {}
    for level in counts:
        child = np.zeros((max(number.values()) + 1, len(seen) + 1), np.int32)
        kinds: dict[bytes, np.ndarray] = {}
        for gram, n in level.items():
            kinds.setdefault(gram[:-1], np.zeros(len(languages)))[:] += n > 0
        size = max(number.values()) + 1
        escape = np.zeros((size, len(languages)), np.float32)
        for context, total in contexts.items():
            if context in number and context in kinds:
                d = kinds[context]
                with np.errstate(divide="ignore", invalid="ignore"):
                    escape[number[context]] = np.where(d > 0, np.log2((total + d) / d), 0)
        fresh, costs = {}, [np.zeros(len(languages), np.float32)]
        for gram, n in level.items():
            fresh[gram] = len(costs)
            child[number[gram[:-1]], model.symbols[gram[-1]]] = len(costs)
            d, total = kinds[gram[:-1]], contexts[gram[:-1]]
            without = escape[number[gram[:-1]]] + (lower[gram[1:]] if len(gram) > 1 else 8)
            with np.errstate(divide="ignore"):
                costs.append(np.where(n > 0, np.log2((total + d) / np.maximum(n, 1)), without).astype(np.float32))
        model.child.append(child)
        model.escape.append(escape)
        model.cost.append(np.stack(costs))
        number, contexts = fresh, {}
        lower = {gram: costs[at] for gram, at in fresh.items()}
        following = counts[len(model.child)] if len(model.child) < len(counts) else {}
        for gram, n in following.items():
            contexts.setdefault(gram[:-1], np.zeros(len(languages)))[:] += n
    return model


def fit_languages(docs: DataFrame, most_docs: int = FIT_DOCS, most_bytes: int = FIT_BYTES) -> LanguageModel:
    """Learns from documents outside the held-out part that have a language.

    The bound is on the fit alone: of each language about ``most_docs`` documents, of at most a sixteenth of
    ``most_bytes`` each and ``most_bytes`` together. Null ids and texts teach nothing.
    """
    part = part_of_id(F.col("doc_id"), PARTS)
    known = docs.where((part != HELD_OUT_PART) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.where(F.octet_length("text") <= most_bytes // 16)
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().toLocalIterator()}
    if not sizes:
        return LanguageModel([])
    grain = 1_000_000
    shares = [x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(-(-grain * most_docs // n)))]
    drawn = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(grain)) < F.create_map(*shares)[F.col("lang")])
    texts: dict[str, list[bytes]] = {lang: [] for lang in sizes}
    used = Counter()
    for row in drawn.select("lang", "text").orderBy(F.xxhash64("doc_id"), "doc_id", "text").toLocalIterator():
        text = row["text"].encode()
        if used[row["lang"]] + len(text) <= most_bytes:
            used[row["lang"]] += len(text)
            texts[row["lang"]].append(text)
    return train({lang: found for lang, found in texts.items() if found})


def identified(docs: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every document.

    The language with the shortest code wins, the first by name in a tie; the score is its posterior if all languages
    are equally likely beforehand. Texts without a letter and null texts are ``und`` with score 0, and so is everything
    if nothing could be learned. Null ids count as held out. Other columns are not read; no documents give no rows.
    """
    model = fit_languages(docs) if model is None else model
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.StructType().add("lang", "string").add("score", "double"))
    def identify(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = sent.value
        for column in texts:
            langs: list[str] = []
            scores: list[float] = []
            for piece in pieces(column, _PIECE_BYTES):
                found = [*byte_texts(piece)]
                bits = own.bits(found)
                lettered = np.array([bool(_LETTER.search(t.decode())) for t in found])
                best = bits.argmin(1) if own.languages else np.zeros(len(found), int)
                for text_bits, at, has in zip(bits, best, lettered, strict=True):
                    if has and own.languages:
                        langs.append(own.languages[at])
                        scores.append(float(1 / np.exp2(-(np.minimum(text_bits - text_bits[at], 1000))).sum()))
                    else:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    held_out = F.coalesce(part_of_id(F.col("doc_id"), PARTS) == HELD_OUT_PART, F.lit(True))
    found = docs.select("doc_id", held_out.alias("held_out"), identify("text").alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")

"""Quality score from compressed sizes: text like the good labelled text compresses better with the good dictionary."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.llm.common import byte_texts, part_of_id

HELD_OUT_PART, PARTS = 0, 5
THRESHOLD = 0.3
#: The fit uses at most this many labelled rows, chosen by a hash of their id, and this many bytes of their texts.
FIT_ROWS = 8_000
FIT_BYTES = 16 << 20
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
#: Texts are compressed in chunks of about this size, each fresh against the dictionaries.
CHUNK_BYTES = 1 << 12
_HEADER_BYTES = 20
_RIDGE = 0.1


@dataclass
class QualityModel:
    """Two dictionaries and the calibration of their compressed sizes; ``constant`` if only one label was seen."""

    good: bytes = b""
    bad: bytes = b""
    weights: np.ndarray | None = None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    constant: float | None = None

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        if not texts:
            return np.empty(0)
        z = (_features(_sizes(texts, *_compressors(self.good, self.bad))) - self.mean) / self.scale @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _compressors(good: bytes, bad: bytes):
    made = []
    for content in (good, bad):
        dictionary = zstandard.ZstdCompressionDict(content)
        dictionary.precompute_compress(level=LEVEL)
        made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False))
    return made


def _chunks(text: bytes) -> list[bytes]:
    """Parts of nearly equal size, at most CHUNK_BYTES each; an empty text is one."""
    count = max(1, -(-len(text) // CHUNK_BYTES))
    return [text[len(text) * k // count : len(text) * (k + 1) // count] for k in range(count)]


def _sizes(texts: list[bytes], good, bad) -> np.ndarray:
    """(good, bad, bytes, chunks) of each text, the compressed sizes summed over its chunks."""
    rows = []
    for text in texts:
        parts = _chunks(text)
        rows.append((sum(len(good.compress(c)) for c in parts), sum(len(bad.compress(c)) for c in parts), len(text), len(parts)))
    return np.array(rows, float)


def _features(sizes: np.ndarray) -> np.ndarray:
    """The size difference, normalised by text length and by compressed size, with the ratio itself, and products: all
    of the mean chunk, so that long texts are like those of the fit."""
    good, bad, n = (sizes[:, :3] / sizes[:, 3:]).T
    n = n + _HEADER_BYTES
    base = np.stack([(bad - good) / n, (bad - good) / (bad + good), good / n, np.log(good / n), 1 / np.sqrt(n)], 1)
    products = [base[:, [i]] * base[:, i:] for i in range(base.shape[1])]
    return np.concatenate([base, *products, np.ones((len(base), 1))], 1)


def _dictionary(texts: list[bytes]) -> bytes:
    """Trained on the texts; where there are too few, the texts themselves."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[:DICTIONARY_BYTES] + bytes(8)


def _calibrated(features: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps, damped so that the loss falls."""
    mean, scale = features.mean(0), features.std(0) + 1e-9
    mean[-1], scale[-1] = 0, 1
    z, w = (features - mean) / scale, np.zeros(features.shape[1])

    def loss(w):
        m = z @ w
        return np.logaddexp(0, -np.where(labels == 1, m, -m)).sum() + _RIDGE / 2 * w @ w

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - labels) + _RIDGE * w
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + _RIDGE * np.eye(len(w)), slope)
        size = 1.0
        while size > 1e-3 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w, mean, scale


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, most_bytes: int = FIT_BYTES) -> QualityModel:
    """Learns from labelled documents outside the held-out part, at most ``rows`` and ``most_bytes`` of them.

    The bound is on the fit alone: the dictionaries and the calibration have a fixed size. Two of three rows make the
    dictionaries, the third calibrates. Null ids, null labels and null texts teach nothing; the higher of several labels
    of one document counts. With one label only, the score is constant: 1 or 0 as that label says, and 0.5 without any.
    """
    part = part_of_id(F.col("doc_id"), PARTS)
    chosen = (
        labels.where(part != HELD_OUT_PART)
        .where("quality is not null")
        .groupBy("doc_id")
        .agg(F.max("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.octet_length("text") <= most_bytes // 16))
    # rows are collected in the order of the hash until the bytes are used up
    held = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    found = held.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows).toLocalIterator()
    learnt: dict[int, list[bytes]] = {0: [], 1: []}
    held_sizes: list[tuple[bytes, int]] = []
    used = 0
    for k, row in enumerate(found):
        text = row["text"].encode()
        used += len(text)
        if used > most_bytes:
            break
        if k % 3 == 2:
            held_sizes.append((text, row["label"]))
        else:
            learnt[1 if row["label"] == 1 else 0].append(text)
    if not (learnt[0] and learnt[1]) or len({label for _, label in held_sizes}) < 2:
        seen = [*[0] * len(learnt[0]), *[1] * len(learnt[1]), *(label for _, label in held_sizes)]
        return QualityModel(constant=0.5 if not seen else 1.0 if 2 * sum(seen) >= len(seen) else 0.0)
    good, bad = _dictionary(learnt[1]), _dictionary(learnt[0])
    sizes = _sizes([t for t, _ in held_sizes], *_compressors(good, bad))
    weights, mean, scale = _calibrated(_features(sizes), np.array([label for _, label in held_sizes], float))
    return QualityModel(good, bad, weights, mean, scale)


def quality_score(docs: DataFrame, model: QualityModel, text: Column) -> Column:
    """Column from 0 to 1, higher for text like the good labels; null is scored as the empty text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            parts = [sent.value.scores([*byte_texts(column.slice(at, 512))]) for at in range(0, len(column), 512)]
            yield pa.array(np.concatenate(parts) if parts else np.empty(0), pa.float64())

    return score(text)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document.

    Repeated rows have equal scores; null ids count as held out. Other columns are ignored; no documents give no rows.
    """
    model = fit_quality(docs, labels)
    found = docs.select("doc_id", quality_score(docs, model, F.col("text")).alias("score"))
    held_out = F.coalesce(part_of_id(F.col("doc_id"), PARTS) == HELD_OUT_PART, F.lit(True))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns."""
    return docs.where(quality_score(docs, fit_quality(docs, labels), F.col("text")) >= threshold)

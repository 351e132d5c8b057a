"""Quality verdicts by weak supervision: rules vote or abstain, and their reliability is estimated without labels."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.llm.common import byte_texts, landed

WINDOW_WORDS = 5
SYMBOLS = b"#*$%&|<>"
KEEP_FROM = 0.5
#: Bounds on what is estimated: a rule that votes says bad of at least this share of bad documents, and wrongly of at most
#: that share of good ones. Without them the two classes may settle on any other split, such as short and long.
LEAST_RIGHT, MOST_WRONG = 0.05, 0.005
#: Documents of more words find their repeated windows by sorting numbers, to bound memory.
_MANY_WORDS = 50_000
_SPACES = b" \t\n\r\x0b\x0c"
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_top_word", "n_upper", "n_lower", "n_stops")


def repeated_words(words: list[bytes], window: int = WINDOW_WORDS) -> int:
    """Words that lie in a window of words found twice or more in the list."""
    size = len(words) - window + 1
    if size < 2:
        return 0
    if len(words) <= _MANY_WORDS:
        grams = [*zip(*(words[k:] for k in range(window)), strict=False)]
        if len(set(grams)) == size:
            return 0
        counts = Counter(grams)
        again = np.fromiter((counts[g] > 1 for g in grams), bool, count=size)
    else:
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, count=len(words))
        key = ids[:size]
        for k in range(1, window):
            _, key = np.unique(key * len(numbers) + ids[k : k + size], return_inverse=True)
        again = np.bincount(key)[key] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(again), 1)
    np.add.at(covered, np.flatnonzero(again) + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def text_counts(text: bytes) -> tuple[int, ...]:
    """The counts named in ``COUNTS``."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    chars = len(text.translate(None, bytes(range(0x80, 0xC0)) + _SPACES))
    return (
        len(words),
        chars,
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        max(Counter(words).values(), default=0),
        len(text) - len(text.translate(None, _UPPER)),
        len(text) - len(text.translate(None, _LOWER)),
        sum(text.count(s) for s in (b".", b"!", b"?", "。".encode())),
    )


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))
def counted(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in texts:
        found = np.array([text_counts(t) for t in byte_texts(column)], np.int64).reshape(-1, len(COUNTS))
        yield pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(len(COUNTS))], [*COUNTS])


def rules() -> dict[str, Column]:
    """Votes by name: 1 for good, -1 for bad, 0 to abstain, from the counts of a document."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    letters = F.greatest(F.col("n_upper") + F.col("n_lower"), F.lit(1))
    mean_word = F.col("word_chars") / n

    def vote(good: Column, bad: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    return {
        "length": vote(n >= 50, n < 10),
        "word_length": vote(mean_word.between(3, 9), (mean_word < 2) | (mean_word > 14)),
        "symbols": vote(F.col("n_symbols") / n < 0.02, F.col("n_symbols") / n > 0.1),
        "duplicate_lines": vote(
            (F.col("n_lines") >= 4) & (F.col("n_dup_lines") == 0),
            (F.col("n_lines") >= 4) & (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)) > 0.3),
        ),
        "repeated_windows": vote(F.col("n_repeat_words") / n < 0.02, F.col("n_repeat_words") / n > 0.3),
        "top_word": vote((n >= 20) & (F.col("n_top_word") / n < 0.12), (n >= 20) & (F.col("n_top_word") / n > 0.2)),
        "capitals": vote(F.col("n_upper") / letters < 0.12, (n >= 5) & (F.col("n_upper") / letters > 0.3)),
        "sentences": vote(
            (F.col("n_stops") > 0) & (n / F.greatest(F.col("n_stops"), F.lit(1)) < 60) & (F.col("n_stops") / n < 0.3),
            (n >= 20) & ((F.col("n_stops") == 0) | (F.col("n_stops") / n > 0.6)),
        ),
    }


@dataclass
class VoteModel:
    """How often the rules that do vote are right of good and of bad documents, and the share of good documents."""

    share: float
    #: by class (bad, good), rule and vote (-1, 0, 1); abstaining tells nothing and has rate 1
    rates: np.ndarray

    def good(self, votes: np.ndarray) -> np.ndarray:
        """Posterior probability of good for rows of votes."""
        logs = np.log(self.rates)
        rule = np.arange(votes.shape[1])
        bad = np.log(1 - self.share) + logs[0][rule, votes + 1].sum(1)
        good = np.log(self.share) + logs[1][rule, votes + 1].sum(1)
        return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> VoteModel:
    """Expectation-maximisation over vote patterns; it starts from good = no rule says bad."""
    good = np.where((votes < 0).any(1), 0.1, 0.9)
    model = VoteModel(0.5, np.ones((2, votes.shape[1], 3)))
    for _ in range(rounds):
        share = float(np.clip((good * counts).sum() / max(counts.sum(), 1), 1e-3, 1 - 1e-3))
        rates = np.ones_like(model.rates)
        for k, weight in enumerate(((1 - good) * counts, good * counts)):
            says_bad = ((votes < 0) * weight[:, None]).sum(0)
            says_good = ((votes > 0) * weight[:, None]).sum(0)
            rates[k, :, 0] = (says_bad + 0.5) / (says_bad + says_good + 1)
        rates[0, :, 0] = np.maximum(rates[0, :, 0], LEAST_RIGHT)
        rates[1, :, 0] = np.minimum(rates[1, :, 0], MOST_WRONG)
        rates[:, :, 2] = 1 - rates[:, :, 0]
        model = VoteModel(share, rates)
        now = model.good(votes)
        if np.abs(now - good).max(initial=0) < 1e-9:
            break
        good = now
    return model


def judged(docs: DataFrame) -> DataFrame:
    """(doc_id, the counts, votes, good, base_failed, kept) for every document.

    The votes of all documents are counted by pattern (at most 3 to the number of rules); the estimate sees nothing
    else. ``base_failed``: fewer than 10 words, or over a fifth of them in repeated windows. ``kept``: not failed, and a
    posterior probability of good of a half or more. Null and empty texts have no words and fail; repeated rows count
    each; other columns are not read; no documents give no rows.
    """
    columns = [vote.cast("int").alias(name) for name, vote in rules().items()]
    counts = landed(docs.select("doc_id", counted("text").alias("c")).select("doc_id", "c.*"), "counts")
    voted = counts.withColumn("votes", F.array(*columns))
    patterns = voted.groupBy("votes").count().orderBy("votes").collect()
    votes = np.array([r["votes"] for r in patterns], int).reshape(-1, len(columns))
    numbers = np.array([r["count"] for r in patterns], float)
    model = estimate(votes, numbers)
    # the posterior is a sum over rules, so it is a plain expression
    gains = np.log(model.rates[1]) - np.log(model.rates[0])
    odds = F.lit(float(np.log(model.share / (1 - model.share))))
    for k in range(len(columns)):
        odds = odds + F.element_at(F.array(*[F.lit(float(g)) for g in gains[k]]), F.col("votes")[k] + 2)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    good = 1 / (1 + F.exp(-odds))
    return voted.withColumns({"good": good, "base_failed": failed}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("good") >= KEEP_FROM)
    )

"""Mixing documents to target weights with soft domain membership.

A classifier trained on the labelled table gives each document a probability of every domain; rates between zero and
a most are then fitted by projected gradient steps, so that the expected tokens of each domain meet the targets. All
steps are DataFrame expressions and ``pyspark.ml`` stages; there is no Python on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.common import fold, landed

DOMAINS = ("clean", "low", "toxic")
#: Wanted shares of tokens. The total is what makes the first domain come in whole.
TARGETS = {"clean": 0.96, "low": 0.03, "toxic": 0.01}
MOST_RATE = 1.0
#: The fit uses at most this many labelled documents, chosen by a hash of their id.
FIT_ROWS = 8_000
#: Terms that the classifier may use, those in most documents of the fit; a term must be in some of them.
TERMS, LEAST_DOCUMENTS = 1 << 14, 5
#: Penalty on the sum of weights: most terms get none, so chance words of single documents do not count.
PENALTY, RIDGE = 0.003, 0.0003
STEPS = 40
#: Gradient steps are part of one expression; after so many of them the rates are written and read again.
STEPS_A_PLAN = 8
TOLERANCE = 1e-4
_SPACE = r"[\x20\x09-\x0D]+"


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPACE), lambda w: w != "")


def _steps(share: Column, name: str) -> Column:
    """The share in words: its power of two, so that it can be counted like a word."""
    return F.concat(F.lit(f"\x01{name}"), F.when(share <= 0, "none").otherwise(F.round(F.log2(share)).cast("string")))


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_tokens, terms): distinct words in lower case and words for the shape of the text."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", fold(F.col("text")).alias("text_key"), text.alias("text"), tokens(F.col("text")).alias("words"))
    rows = rows.select("doc_id", "text_key", "text", F.size("words").alias("n"), F.array_distinct("words").alias("words"))
    size = F.greatest(F.char_length("text"), F.lit(1))
    symbols = (F.char_length("text") - F.char_length(F.translate("text", "#*$%&|<>", ""))) / size
    capitals = (F.char_length("text") - F.char_length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) / size
    n = F.greatest(F.col("n"), F.lit(1))
    shapes = F.array(
        _steps(symbols, "symbols"), _steps(capitals, "capitals"), _steps(F.size("words") / n, "distinct"), _steps(size / n, "length"), _steps(n, "words")
    )
    plain = F.transform("words", lambda w: F.rtrim(F.lower(w), F.lit(".,!?;:")))
    return rows.select("doc_id", "text_key", F.col("n").cast("bigint").alias("n_tokens"), F.concat(plain, shapes).alias("terms"))


@dataclass
class DomainModel:
    """Classifier of domains and the terms that have weight in it."""

    stages: PipelineModel
    terms: list[str]


def fit_domains(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DomainModel | None:
    """Classifier of domains: toxic, else low if the quality label is 0, else clean; None if there is nothing to tell.

    The bound is on the fit alone. Null ids and labels teach nothing; the worst of several labels of a document counts.
    """
    domain = F.when(F.max("toxic") == 1, 2.0).when(F.min("quality") == 0, 1.0).when(F.min("quality").isNotNull(), 0.0)
    chosen = labels.where("doc_id is not null").groupBy("doc_id").agg(domain.alias("label")).where("label is not null")
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    known = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    terms = features(known).join(F.broadcast(chosen), "doc_id").select("label", "terms")
    fit = landed(terms.repartition(16), "domain-fit")
    sizes = [r["count"] for r in fit.groupBy("label").count().collect()]
    if len(sizes) < 2:
        return None
    # with few documents a chance word cannot be told from a telling one by its count
    least = LEAST_DOCUMENTS if sum(sizes) >= 20 * LEAST_DOCUMENTS else 1
    counts = CountVectorizer(inputCol="terms", outputCol="features", vocabSize=TERMS, minDF=float(least), binary=True).fit(fit)
    sparse = LogisticRegression(family="multinomial", regParam=PENALTY, elasticNetParam=1.0, maxIter=30)
    chosen = sparse.fit(counts.transform(fit)).coefficientMatrix.toArray()
    used = [counts.vocabulary[k] for k in np.flatnonzero(np.abs(chosen).sum(0))]
    if not used:
        return None
    # the penalty has made its choice; fitted again without it, the probabilities are not drawn together
    counts = CountVectorizerModel.from_vocabulary(used, inputCol="terms", outputCol="features")
    counts.setBinary(True)
    plain = LogisticRegression(family="multinomial", regParam=RIDGE, maxIter=40)
    return DomainModel(PipelineModel([counts, plain.fit(counts.transform(fit))]), used)


def posteriors(docs: DataFrame, model: DomainModel | None) -> DataFrame:
    """(doc_id, text_key, n_tokens, p) of every document; ``p`` has a probability for each of ``DOMAINS``."""
    rows = features(docs)
    if model is None:
        return rows.select("doc_id", "text_key", "n_tokens", F.array(*[F.lit(x) for x in (1.0, 0.0, 0.0)]).alias("p"))
    p = vector_to_array("probability")
    # domains that the sample has not are not predicted
    every = F.array(*[F.coalesce(F.get(p, F.lit(k)), F.lit(0.0)) for k in range(len(DOMAINS))])
    # terms without weight change nothing and need not be looked up
    used = F.array_intersect("terms", F.lit(model.terms))
    return model.stages.transform(rows.withColumn("terms", used)).select("doc_id", "text_key", "n_tokens", every.alias("p"))


def fitted_rates(members: DataFrame, targets: dict[str, float], most_rate: float = MOST_RATE) -> DataFrame:
    """``members`` with the column rate.

    Minimises the squared relative distance of the domains' expected tokens from their targets over rates from 0 to
    ``most_rate``. A step moves every rate against the gradient per token and projects it back; only one row of sums
    reaches the driver each time. Steps shrink with the largest eigenvalue of the domains' overlap. Without tokens, or
    without any of the first domain, the rates stay as they start: at ``most_rate`` or 1, whichever is less.
    """
    names = list(DOMAINS)
    weight = np.array([max(targets.get(d, 0.0), 0.0) for d in names])
    count = len(names)

    def totals(df: DataFrame, rate: Column) -> np.ndarray:
        sums = [F.sum(rate * F.col("n_tokens") * F.col("p")[k]) for k in range(count)]
        return np.array([x or 0.0 for x in df.agg(*sums).first()])

    start = min(1.0, most_rate)
    rows, rate = members.withColumn("rate", F.lit(start)), F.lit(start)
    natural = totals(rows, F.lit(1.0))
    if not natural[0] or not weight[0]:
        return rows
    target = natural[0] / weight[0] * weight
    scale = np.where(natural > 0, natural, 1.0)
    overlaps = [F.sum(F.col("n_tokens") * F.col("p")[i] * F.col("p")[j]) for i in range(count) for j in range(count)]
    overlap = np.array([x or 0.0 for x in members.agg(*overlaps).first()]).reshape(count, count)
    largest = np.linalg.eigvalsh(overlap / np.sqrt(np.outer(scale, scale)))[-1]
    before = None
    for step in range(STEPS):
        now = totals(rows, rate)
        slope = (now - target) / scale / max(largest, 1e-12)
        if before is not None and np.abs((now - before) / scale).max() < TOLERANCE:
            break
        before = now
        moved = rate
        for k in range(count):
            moved = moved - F.lit(float(slope[k])) * F.col("p")[k]
        rate = F.greatest(F.lit(0.0), F.least(F.lit(float(most_rate)), moved))
        if step % STEPS_A_PLAN == STEPS_A_PLAN - 1:
            rows, rate = landed(rows.withColumn("rate", rate), "rates"), F.col("rate")
    return rows.withColumn("rate", rate)


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """(doc_id, text_key, n_tokens, p, rate) of every document.

    Null and empty texts have no tokens, so their rate follows their membership alone; repeated rows count each; null
    ids are mixed like others; other columns are not read. No documents give no rows.
    """
    members = landed(posteriors(docs, fit_domains(docs, labels)), "members")
    return fitted_rates(members, TARGETS if targets is None else targets)


def sampled(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The documents drawn at their rates, with all their columns: each by a hash of its id and text, so a rerun draws
    the same. A rate of 1 keeps the document; above 1 its whole part gives copies. Columns may have any names."""
    drawn = mixed(docs, labels, targets)
    chance = F.pmod(F.xxhash64(F.lit("mix"), "doc_id", "text_key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor(F.col("rate") + chance).cast("int")
    copies = F.when(F.col("rate") >= 1 - 1e-9, F.greatest(copies, F.lit(1))).otherwise(copies)
    drawn = drawn.withColumn("copies", copies).where("copies > 0")
    drawn = drawn.groupBy(F.col("doc_id").alias("drawn_id"), F.col("text_key").alias("drawn_key")).agg(F.max("copies").alias("mix_copies"))
    same = docs["doc_id"].eqNullSafe(drawn["drawn_id"]) & (fold(docs["text"]) == drawn["drawn_key"])
    row = F.struct(*[docs[c] for c in docs.columns])
    return docs.join(drawn, same).select(F.explode(F.array_repeat(row, drawn["mix_copies"])).alias("row")).select("row.*")

"""Licence notices: a trained paragraph classifier over word n-grams, confirmed by comparison with templates.

All steps are DataFrame expressions and ``pyspark.ml`` stages; there is no Python on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, IndexToString
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.llm.common import landed

UNKNOWN = "unknown"
#: What the negative examples of the corpus weigh together in the fit, whatever their number; few of them weigh one each.
FIT_NEGATIVES = 2_000
#: A prediction needs this probability and this share of the word pairs of a template of its family.
LEAST_PROBABILITY, LEAST_CONTAINMENT = 0.5, 0.6
#: Share of the negative examples that may reach the probability; it is raised until they do not.
MOST_FALSE = 0.01
MOST_WORDS = 2

# Usual wordings of licence notices by family.
TEMPLATES = {
    "mit": (
        "released under the mit license",
        "licensed under the mit license",
        "this project is licensed under the terms of the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software",
        "spdx-license-identifier mit",
    ),
    "apache": (
        "licensed under the apache license version 2.0",
        "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license",
        "released under the apache license 2.0",
        "spdx-license-identifier apache-2.0",
    ),
    "gpl": (
        "this work is licensed under the gnu general public license version 3",
        "this work is licensed under the gnu general public license version 2",
        "licensed under the gnu gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license",
        "under the terms of the gnu general public license as published by the free software foundation",
        "spdx-license-identifier gpl-3.0-only",
    ),
    "lgpl": (
        "licensed under the gnu lesser general public license",
        "under the terms of the gnu lesser general public license as published by the free software foundation",
    ),
    "bsd": (
        "licensed under the bsd license",
        "released under the 3-clause bsd license",
        "redistribution and use in source and binary forms with or without modification are permitted",
        "spdx-license-identifier bsd-3-clause",
    ),
    "mpl": (
        "this source code form is subject to the terms of the mozilla public license",
        "licensed under the mozilla public license 2.0",
    ),
    "cc-by": (
        "licensed under cc by 4.0",
        "this work is licensed under a creative commons attribution 4.0 international license",
        "available under the creative commons attribution license",
    ),
    "cc-by-sa": (
        "licensed under cc by-sa 4.0",
        "this work is licensed under a creative commons attribution-sharealike 4.0 international license",
    ),
    "cc-by-nc": (
        "licensed under cc by-nc 4.0",
        "this work is licensed under a creative commons attribution-noncommercial 4.0 international license",
    ),
    "cc0": (
        "released under cc0 1.0",
        "to the extent possible under law the author has waived all copyright and related rights to this work",
        "this work is dedicated to the public domain",
    ),
    "proprietary": (
        "all rights reserved",
        "copyright all rights reserved",
        "no part of this publication may be reproduced without the prior written permission of the publisher",
    ),
}
#: Sentences with the words of notices that are none.
OTHER = (
    "the driving license of the driver was checked",
    "general public access to the work is free of charge",
    "the license fee is due every year under the terms of the contract",
    "human rights are reserved to all",
    "copyright law is a part of civil law",
    "the version of the software was released to the public",
    "under the terms of the treaty the use of force is permitted",
    "a copy of this report is available",
    "all seats are reserved",
    "the apache helicopter",
    "the rights of the author",
    "this work is free",
)
#: What a notice must have where families share nearly all of their wording.
NEEDED = {"gpl": ("gnu general", "gnu gpl", "spdx-license-identifier gpl-3.0-only"), "lgpl": ("lesser general",)}
#: Words too common to tell a notice from other text. Fixed values.
COMMON = frozenset(
    "a all an and any as are at be by for form forms free from in is it may no not of on or part person possible prior "
    "project source subject terms that the this to under use version with without work you 2 3 2.0 3.0 4.0 1.0".split()
)


def words(text: Column) -> Column:
    """Words in lower case: letters, digits and what joins them; version numbers stay whole."""
    return F.filter(
        F.transform(F.split(F.lower(text), r"[^\p{L}\p{N}.+-]+"), lambda w: F.trim(w, F.lit(".-+"))), lambda w: w != ""
    )


def ngrams(column: Column) -> Column:
    """Single words and pairs of words, each once."""
    pairs = F.zip_with(F.slice(column, F.lit(1), F.greatest(F.size(column) - 1, F.lit(0))), F.slice(column, 2, 1 << 30), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(column, pairs))


def pairs_of(column: Column) -> Column:
    return F.filter(ngrams(column), lambda g: g.contains(" "))


def _grams(text: str) -> list[str]:
    own = text.split()
    return list(dict.fromkeys([*own, *(f"{a} {b}" for a, b in zip(own, own[1:], strict=False))]))


def _fixed(values: list[str]) -> Column:
    """The values as one constant, which keeps plans short."""
    return F.split(F.lit("\n".join(values)), "\n")


def telling_words() -> list[str]:
    return sorted({w for texts in TEMPLATES.values() for t in texts for w in t.split()} - COMMON)


def vocabulary() -> list[str]:
    return sorted({g for texts in [*TEMPLATES.values(), OTHER] for t in texts for g in _grams(t)})


@dataclass
class LicenseModel:
    """Vocabulary, classifier and the probability that a prediction needs."""

    stages: PipelineModel
    families: list[str]
    threshold: float


def paragraphs(docs: DataFrame) -> DataFrame:
    """(row, doc_id, paragraph, last, grams, beyond) of lines, and of lines joined with those that follow them.

    A notice that starts in a line ends within the longest template's words of its end, so a line is taken alone, with
    one and with two more lines, and with that many words; comment marks are no words. ``grams`` are those of the
    templates and other sentences, ``beyond`` those that are there without the first line. Joins are kept where they
    have a pair that the line has not. Only what shares a telling word with a template is kept; no other can be
    confirmed. ``row`` tells repeated rows apart.
    """
    most = max(len(t.split()) for texts in TEMPLATES.values() for t in texts) - 1
    known = _fixed(sorted({w for g in vocabulary() for w in g.split()}))
    telling = _fixed(telling_words())
    text = F.regexp_replace("text", r"(?im)^[ \t]*(?:dnl|rem)[ \t]", " ")
    lines = docs.where("text is not null").select("doc_id", F.transform(F.split(text, "\n"), words).alias("lines"))
    lines = lines.where(F.exists("lines", lambda own: F.arrays_overlap(own, telling)))
    # words that no template has stand apart as empty ones
    short = F.transform("lines", lambda own: F.transform(own, lambda w: F.when(F.array_contains(known, w), w).otherwise("")))
    lines = lines.select(F.monotonically_increasing_id().alias("row"), "doc_id", short.alias("lines"))

    def joined(own: Column, k: Column) -> Column:
        following = F.slice("lines", k + 2, most)
        one, two = F.size(F.coalesce(F.get(following, F.lit(0)), F.array())), F.size(F.coalesce(F.get(following, F.lit(1)), F.array()))
        after = F.slice(F.flatten(F.transform(following, lambda x: F.slice(x, 1, most))), 1, most)
        return F.struct(own.alias("own"), after.alias("after"), one.alias("one"), two.alias("two"))

    each = lines.select("row", "doc_id", F.posexplode(F.transform("lines", joined)).alias("paragraph", "x"))
    each = each.select("row", "doc_id", "paragraph", "x.*").where(F.arrays_overlap(F.concat("own", "after"), telling))
    widths = F.array(
        F.struct(F.lit(0).alias("lines"), F.lit(0).alias("words")),
        F.struct(F.lit(1).alias("lines"), F.least("one", F.lit(most)).alias("words")),
        F.struct(F.lit(2).alias("lines"), F.least(F.col("one") + F.col("two"), F.lit(most)).alias("words")),
        F.struct(F.lit(most).alias("lines"), F.lit(most).alias("words")),
    )
    each = each.select("*", F.explode(widths).alias("width"))
    beyond = F.slice("after", F.lit(1), F.col("width.words"))
    every = _fixed(vocabulary())
    found = each.select(
        "row",
        "doc_id",
        "paragraph",
        (F.col("paragraph") + F.col("width.lines")).alias("last"),
        F.array_intersect(ngrams(F.concat("own", beyond)), every).alias("grams"),
        F.array_intersect(ngrams(F.col("own")), every).alias("alone"),
        F.array_intersect(ngrams(beyond), every).alias("beyond"),
    )
    found = found.where(F.arrays_overlap("grams", telling))
    more = F.exists(F.array_except("grams", "alone"), lambda g: g.contains(" "))
    share = F.exists(F.array_except("grams", "beyond"), lambda g: g.contains(" "))
    return found.where((F.col("last") == F.col("paragraph")) | more & share).drop("alone")


def _templates(spark: SparkSession) -> DataFrame:
    rows = [(family, _grams(t)) for family, texts in TEMPLATES.items() for t in texts]
    return spark.createDataFrame([(f, g, [x for x in g if " " in x]) for f, g in rows], "family string, grams array<string>, pairs array<string>")


def fit_licenses(spark: SparkSession, found: DataFrame, negatives: int = FIT_NEGATIVES) -> LicenseModel:
    """Fits on the templates, whole and cut in half, and on what is unknown: other sentences and all paragraphs of the
    corpus that hold less than a third of any template, which weigh about ``negatives`` together so that the templates
    keep their part. Paragraphs with the same grams are one row with their number. The threshold is calibrated on all
    that is unknown."""
    families = [UNKNOWN, *sorted(TEMPLATES)]
    positive = []
    for family, texts in TEMPLATES.items():
        for t in texts:
            own, half = t.split(), len(t.split()) // 2
            cuts = [own] + ([own[:-half], own[half:]] if len(own) > 8 else [])
            positive += [(float(families.index(family)), _grams(" ".join(c))) for c in cuts] * 4
    positive += [(0.0, _grams(t)) for t in OTHER] * 4 + [(0.0, [g]) for g in sorted(COMMON)]
    # a paragraph with little of any template; the templates are few and fixed, so each line meets a bounded set
    least = F.greatest(*[F.size(F.array_intersect("pairs", _fixed([g for g in _grams(t) if " " in g]))) / F.lit(float(len(t.split()) - 1)) for texts in TEMPLATES.values() for t in texts])
    share = min(1.0, negatives / max(found.count(), 1))
    other = (
        found.groupBy(F.array_sort("grams").alias("grams"))
        .agg(F.count(F.lit(1)).alias("times"))
        .withColumn("pairs", F.filter("grams", lambda g: g.contains(" ")))
        .where(least < 1 / 3)
        .select(F.lit(0.0).alias("label"), "grams", (F.col("times") * share).alias("weight"), "times")
    )
    fixed = spark.createDataFrame(positive, "label double, grams array<string>")
    fixed = fixed.select("*", F.lit(1.0).alias("weight"), F.lit(round(1 / share)).cast("bigint").alias("times"))
    rows = landed(fixed.union(other), "license-fit")
    counts = CountVectorizerModel.from_vocabulary(vocabulary(), inputCol="grams", outputCol="features")
    counts.setBinary(True)
    fit = LogisticRegression(family="multinomial", regParam=0.002, maxIter=60, labelCol="label", weightCol="weight")
    fitted = fit.fit(counts.transform(rows))
    names = IndexToString(inputCol="prediction", outputCol="family", labels=families)
    stages = PipelineModel([counts, fitted, names])
    # in steps of a millionth, so that there is a bounded number of them
    scored = stages.transform(rows.where("label = 0")).select(
        F.round(1 - vector_to_array("probability")[0], 6).alias("p"), "times"
    )
    reached = scored.agg(F.percentile("p", 1 - MOST_FALSE, F.col("times"))).first()[0] or 0.0
    return LicenseModel(stages, families, max(LEAST_PROBABILITY, reached))


def license_notices(docs: DataFrame) -> DataFrame:
    """(doc_id, paragraph, family, probability, containment) of every licence notice, on one line or wrapped over several.

    ``paragraph`` is the number of the line that it starts on; ``containment`` the largest share of the word pairs of a
    template of the family that the notice has. Where readings of a family overlap, the one with most of a template
    counts, then the shortest, then the first. Null and empty texts have no notices; repeated rows count each; null ids
    keep their lines; other columns are not read. No documents give no rows.
    """
    spark = docs.sparkSession
    found = landed(paragraphs(docs), "paragraphs")
    model = fit_licenses(spark, found)
    predicted = model.stages.transform(found).withColumn("probability", F.array_max(vector_to_array("probability")))
    predicted = predicted.where((F.col("family") != UNKNOWN) & (F.col("probability") >= model.threshold))

    def share(grams: str, pairs: list[str]) -> Column:
        return F.size(F.array_intersect(grams, _fixed(pairs))) / F.lit(float(len(pairs)))

    shares = []
    for family, texts in TEMPLATES.items():
        for t in texts:
            pairs = [g for g in _grams(t) if " " in g]
            # a reading of several lines counts for what its first line adds to
            begins = (F.col("last") == F.col("paragraph")) | (share("grams", pairs) > share("beyond", pairs))
            shares.append(F.when((F.col("family") == family) & begins, share("grams", pairs)).otherwise(F.lit(0.0)))
    for family, needed in NEEDED.items():
        predicted = predicted.where((F.col("family") != family) | F.arrays_overlap("grams", _fixed([*needed])))
    confirmed = predicted.withColumn("containment", F.greatest(*shares)).where(F.col("containment") >= LEAST_CONTAINMENT)
    one = F.struct(
        (-F.col("containment")).alias("missing"), (F.col("last") - F.col("paragraph")).alias("more"), "paragraph", "last", "probability", "containment"
    )
    readings = confirmed.select("row", "doc_id", "family", one.alias("one"))
    readings = readings.groupBy("row", "family").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list("one")).alias("ones"))
    none = F.slice("ones", 1, 0)
    kept = F.aggregate(
        "ones",
        none,
        lambda kept, x: F.when(
            F.exists(kept, lambda y: (y["paragraph"] <= x["last"]) & (x["paragraph"] <= y["last"])), kept
        ).otherwise(F.concat(kept, F.array(x))),
    )
    notices = readings.select("doc_id", "family", F.explode(kept).alias("one"))
    return notices.select("doc_id", "one.paragraph", "family", "one.probability", "one.containment")

"""Spelling variants against comparing all words with all words."""

import random
import re
import zlib
from collections import Counter

import pytest
from helpers import SCHEMA, clashing, lower, sample
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeferry.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_apart(a: str, b: str) -> bool:
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute_counts(rows, one_in, least_length, least_count):
    total = Counter()
    for doc_id, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if one_in and doc_id is not None and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least_length and n >= least_count}


def brute_groups(counts, factor):
    near = {w: [v for v in counts if one_apart(v, w)] for w in counts}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, n, form[w] or "", counts.get(form[w], 0), len(near[w]), root(w)) for w, n in counts.items())


def plain(found):
    return sorted((r["word"], r["n"], r["form"] or "", r["form_n"] or 0, r["n_near"], r["root"]) for r in found.collect())


@given(st.text("abÃĀxZé× .€\U0001f642¿", max_size=30))
def test_runs(text):
    assert [r.decode() for r in spelling.runs(text.encode())] == [lower(r) for r in RUN.findall(text)]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("abc", min_size=1, max_size=7), min_size=1, max_size=30), st.integers(0, 7))
def test_index_finds_one_error(words, apart):
    words = sorted(words)
    index = spelling.PositionIndex(words)
    for word in words:
        sets = index.near(word)
        for k, other in enumerate(words):
            kinds = [bool(s >> k & 1) for s in sets]
            assert kinds == [one_apart(word, other) and len(other) - len(word) == d for d in (0, -1, 1)]
        far = index.near(word, apart)
        for s, t in zip(sets, far):
            want = [k for k, o in enumerate(words) if s >> k & 1 and not (len(word) >= apart and len(o) >= apart and o[:apart] == word[:apart])]
            assert [k for k in range(len(words)) if t >> k & 1] == want


def documents():
    rng = random.Random(7)
    rows = sample()
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(5, 9))) for _ in range(60)]
    for k in range(60):
        own = []
        for _ in range(150):
            w = rng.choice(base[: 5 + k])
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "x", w[at] + "y", "É"]) + w[at + 1 :]
            own.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((5000 + k, " ".join(own) + "×÷ß漢字" + own[0], "en", "s", 0))
    rows.append((7000, "a" * 50_000 + " " + ("b" * 50_000 + ", ") * 5, None, None, 0))
    return rows


@pytest.mark.parametrize("one_in", [0, 3])
def test_counts(spark, monkeypatch, one_in):
    rows = documents()
    df = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(3)
    want = brute_counts(rows, one_in, 6, 5)
    assert {r["word"]: r["n"] for r in spelling.word_counts(df, cut_one_in=one_in).collect()} == want
    monkeypatch.setattr(spelling, "HELD_WORDS", 10)
    assert {r["word"]: r["n"] for r in spelling.word_counts(df, cut_one_in=one_in).collect()} == want


@pytest.mark.parametrize("bucket_words", [spelling.BUCKET_WORDS, 3])
def test_groups(spark, bucket_words):
    counts = brute_counts(documents(), 3, 3, 1)
    # a chain of forms, ties, and many words of one bucket
    counts |= {"chains": 1, "chainss": 5, "chainsss": 25, "chainssss": 125, "chainsssss": 625, "tietie": 1, "tiexie": 9, "tieyie": 9}
    rng = random.Random(3)
    while len(counts) < 1500:
        counts.setdefault("pre" + "".join(rng.choice("ab") for _ in range(rng.randint(4, 10))), rng.randint(1, 40))
    df = spark.createDataFrame([*counts.items()], "word string, n long").repartition(3)
    found = spelling.grouped(df, bucket_words=bucket_words)
    want = brute_groups(counts, 5)
    assert plain(found) == want and sum(r[2] != "" for r in want) > 50
    assert {r[5] for r in want if r[0].startswith("chain")} == {"chainsssss"}


def test_no_words(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert spelling.grouped(spelling.word_counts(none)).count() == 0
    few = spark.createDataFrame([(1, None, "en", "s", 0), (None, "", None, None, None)], SCHEMA)
    assert spelling.grouped(spelling.word_counts(few, cut_one_in=199)).count() == 0

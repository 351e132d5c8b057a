"""Syncmer fingerprints against their definition, code point by code point."""

import hashlib
import random
import struct

import pytest
import xxhash
from helpers import SCHEMA, clashing, sample
from pyspark.sql import functions as F

from lakeferry.llm import syncmers

K, S = syncmers.K, syncmers.S


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def brute_anchors(text):
    if not text:
        return []
    text = "\u0002" * (K - 1) + text + "\u0003" * (K - 1)
    inner = [signed(xxhash.xxh64_intdigest(text[i : i + S].encode(), 42)) for i in range(len(text) - S + 1)]
    found = []
    for p in range(len(text) - K + 1):
        own = inner[p : p + K - S + 1]
        if min(own) in (own[0], own[-1]):
            h = 42
            for k in (*range(0, K - S, S), K - S):
                h = xxhash.xxh64_intdigest(struct.pack("<q", own[k]), h)
            found.append((p, h >> 16))
    return found


def brute_fingerprint(text):
    first = {}
    for p, h in brute_anchors(text):
        first.setdefault(h, p)
    return sorted(first.items())[: syncmers.ANCHORS]


def brute_likeness(one, other):
    if not one and not other:
        return 1.0
    a, b = dict(one), dict(other)
    seen = sorted(a.keys() | b.keys())[: syncmers.ANCHORS]
    shifts = sorted(a[h] - b[h] for h in seen if h in a and h in b)
    last = max([0, *a.values(), *b.values()])
    usual = shifts[len(shifts) // 2] if shifts else 0
    j = sum(abs(s - usual) <= syncmers.SLACK + syncmers.SLACK_SHARE * last for s in shifts) / len(seen)
    return 2 * j / (1 + j)


def as_text(fp):
    return " ".join(f"{h:012x}@{p}" for h, p in fp)


def brute(rows):
    rows = [(i, t or "") for i, t, *_ in rows]
    key = lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64_intdigest(r[1].encode(), 42)))
    rows = sorted(rows, key=key, reverse=True)
    out = []
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        third = len(text) // 3
        edited = text[: len(text) - third] + following[:third]
        own, other, nxt = map(brute_fingerprint, (text, edited, following))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((doc_id, len(text), digest, as_text(own), as_text(other), brute_likeness(own, other), brute_likeness(own, nxt)))
    return sorted(out, key=str)


def rows_of_all_kinds():
    rng = random.Random(11)
    rows = sample(n=40)
    rows += [(2000, "\U0001f642漢é" * 50 + "a", "en", "s", 0), (2001, "ab", "en", "s", 0), (2002, "abc", "en", "s", 0)]
    rows += [(-5, "x" * 300, None, None, 0), (2003, "".join(rng.choice("ab \U00010400") for _ in range(3000)), "en", "s", 0)]
    return rows


@pytest.mark.parametrize("bucket_bytes, piece", [(syncmers.BUCKET_BYTES, syncmers.PIECE), (500, 100)])
def test_compared(spark, monkeypatch, bucket_bytes, piece):
    monkeypatch.setattr(syncmers, "PIECE", piece)
    rows = rows_of_all_kinds()
    df = clashing(spark.createDataFrame(rows, SCHEMA)).selectExpr("*", "'x' as ghost", "'x' as key", "1 as next_text").repartition(3)
    found = syncmers.compared(df, bucket_bytes)
    assert found.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    got = sorted((tuple(r) for r in found.collect()), key=str)
    want = brute(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(abs(g[k] - w[k]) < 1e-12 for g, w in zip(got, want) for k in (5, 6))
    long = [w for w in want if w[1] > 500]
    assert sum(w[5] for w in long) > 0.5 * len(long)


def test_likeness_of_edits(spark):
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(800))
    words = text.split(" ")
    cases = [
        (text, text, 1.0, 1.0),
        (text, "A new title. " + text, 0.9, 1.0),
        (text, " ".join(words[:400]), 0.5, 0.8),
        (text, " ".join(sorted(words)), 0.0, 0.2),
        (text, text[::-1], 0.0, 0.05),
        ("", "", 1.0, 1.0),
        ("", text, 0.0, 0.0),
        (text, "", 0.0, 0.0),
    ]
    df = spark.createDataFrame(cases, "a string, b string, low double, high double")
    fps = df.select(syncmers.fingerprint(F.col("a")).alias("a"), syncmers.fingerprint(F.col("b")).alias("b"), "low", "high")
    for r in fps.select(syncmers.likeness(F.col("a"), F.col("b")).alias("x"), "low", "high").collect():
        assert r["low"] <= r["x"] <= r["high"], r


def test_few_documents(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert syncmers.compared(none).count() == 0
    one = spark.createDataFrame([(1, "abcdef", "en", "s", 6)], SCHEMA)
    assert [r["near_next"] for r in syncmers.compared(one).collect()] == [1.0]
    many = spark.createDataFrame([(7, "same text", "en", "s", 9)] * 50, SCHEMA).repartition(5)
    got = syncmers.compared(many, 100).collect()
    assert len(got) == 50 and {r["near_next"] for r in got} == {1.0}


def test_a_long_text(spark):
    text = "wort und " * 120_000
    df = spark.createDataFrame([(1, text, "de", "s", 0), (2, text + "x", "de", "s", 0)], SCHEMA)
    got = {r["doc_id"]: r for r in syncmers.compared(df).collect()}
    assert got[1]["fingerprint"] == as_text(brute_fingerprint(text)) and got[2]["n_chars"] == len(text) + 1

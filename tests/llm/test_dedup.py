"""Near duplicates and repeated passages against brute force."""

import hashlib
import random

import pytest
import xxhash
from helpers import SCHEMA, clashing, lower, sample, words
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeferry.llm import components as components_module
from lakeferry.llm import lempel_ziv, simhash
from lakeferry.llm.components import components


def brute_fingerprint(text):
    w = words(lower(text or ""))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=4))
def test_masks_cover_every_near_pair(fp, flips):
    other = fp
    for bit in set(flips):
        other ^= 1 << bit
    assert any(fp & m == other & m for m in simhash.covering_masks())


@pytest.mark.parametrize("bucket_rows", [4096, 2])
def test_groups(spark, bucket_rows):
    rows = sample()
    df = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(3)
    got = simhash.near_duplicates(df, bucket_rows=bucket_rows).collect()
    assert len(got) == len(rows)
    fps = {t: brute_fingerprint(t) for t in {r[1] for r in rows}}
    distinct = sorted(set(fps.values()))
    root = groups(distinct, [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if (a ^ b).bit_count() <= 4])
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            key = root[fps[text]]
            first[key] = min(doc_id, first.get(key, doc_id))
    want = sorted(((r[0], fps[r[1]], first.get(root[fps[r[1]]])) for r in rows), key=str)
    assert sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got), key=str) == want
    kept = sorted(r["doc_id"] for r in simhash.one_of_each(df).where("doc_id is not null").collect())
    assert set(kept) == set(first.values()) and simhash.one_of_each(df).columns == df.columns


def test_dense_buckets_are_linked_alike(spark):
    rng = random.Random(1)
    center = rng.getrandbits(63)
    near = {center}
    while len(near) < 400:
        near.add(rng.choice([*near][:40]) ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)))
    df = spark.createDataFrame([(f,) for f in near], "fp long")
    results = []
    for bucket_rows in (10_000, 3):
        links = [tuple(r) for r in simhash.near_pairs(df, bucket_rows=bucket_rows).collect()]
        results.append(groups(near, links))
    want = groups(near, [(a, b) for a in near for b in near if a < b and (a ^ b).bit_count() <= 4])
    assert results == [want, want]
    with pytest.raises(ValueError, match="even"):
        simhash.near_pairs(df, radius=3)


def test_components_of_chains_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (200, 100), (300, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


SKEWED = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
    # a partition is split by the map tasks its rows come from, so there have to be some
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.files.openCostInBytes": "1",
    "spark.sql.files.maxPartitionBytes": "16k",
}


@pytest.fixture
def plans(spark, monkeypatch):
    """Plans of all that is written between two steps, as they ran with a low threshold of skew."""
    seen = []

    def landed(df, name):
        df.collect()
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return spark.createDataFrame(df.collect(), df.schema).repartition(4) if name == "blocks" else write(df, name)

    write = lempel_ziv.landed
    for module in (components_module, lempel_ziv, simhash):
        monkeypatch.setattr(module, "landed", landed)
    before = {k: spark.conf.get(k, None) for k in SKEWED}
    for k, v in SKEWED.items():
        spark.conf.set(k, v)
    yield seen
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_large_star_is_split(spark, plans):
    rng = random.Random(1)
    edges = [(rng.getrandbits(40), 7) for _ in range(20_000)] + [(k, k + 10**6) for k in range(50, 90)]
    got = components(spark.createDataFrame(edges, "a long, b long").repartition(6))
    assert got.where("root = 7").count() == len({a for a, _ in edges[:20_000]}) + 1
    assert [name for name, plan in plans if "skew=true" in plan]


def test_a_common_anchor_is_split(spark, plans):
    rng = random.Random(4)
    common = [f"c{k}" for k in range(20)]
    text = lambda k: " ".join([f"x{k}{rng.random()}" for _ in range(45)] + common + [f"y{k}{rng.random()}" for _ in range(45)])
    docs = spark.createDataFrame([(k, text(k % 900), "en", "s", 0) for k in range(1500)], SCHEMA).repartition(6)
    spans = lempel_ziv.duplicate_spans(docs)
    spans.collect()
    last = spans._jdf.queryExecution().executedPlan().toString()
    assert any("skew=true" in plan for _, plan in [*plans, ("spans", last)])


def brute_removed(rows):
    first = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            w = words(text)
            for i in range(len(w) - 49):
                key = tuple(w[i : i + 50])
                first[key] = min(doc_id, first.get(key, doc_id))
    out = []
    for doc_id, text, *_ in rows:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if doc_id is not None and first[tuple(w[i : i + 50])] < doc_id:
                gone[i : i + 50] = [True] * 50
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out.append((doc_id, len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_repeated_passages(spark):
    rows = sample()
    rng = random.Random(5)
    # copies cut, joined and edited at all distances around the window
    source = words(rows[3][1]) + words(max((r[1] or "" for r in rows), key=len))[:300]
    for k in range(46, 56):
        at = rng.randrange(0, 100)
        rows.append((1000 + k, " ".join([f"a{k}", *source[at : at + k], f"b{k}", *source[at + 5 : at + 5 + k]]), "en", "s", 0))
    df = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(3)
    got = sorted((tuple(r) for r in lempel_ziv.removed(df).collect()), key=str)
    want = brute_removed(rows)
    assert got == want and sum(r[2] for r in want) > 1000
    texts = {r["doc_id"]: r["text"] for r in lempel_ziv.deduplicated(df).where("doc_id = 0").collect()}
    assert texts == {0: rows[0][1]}


def test_no_documents(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(none).count() == 0 and simhash.one_of_each(none).count() == 0
    assert lempel_ziv.removed(none).count() == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), max_size=120), min_size=1, max_size=6))
def test_equal_windows_are_parsed_alike(texts):
    """Every pair of equal windows has the same anchor, and equal blocks have equal words."""
    joined = [" ".join(t).encode() for t in texts]
    found = lempel_ziv.Words(joined)
    owner, g, q, lo, n = lempel_ziv.parse(found)
    anchor, block = {}, {}
    for o, a, h, start, count in zip(owner, g, q, lo, n, strict=True):
        for p in range(start, start + count):
            assert anchor.setdefault(tuple(texts[o][p : p + 50]), a) == a
        whole = tuple(texts[o][start : start + count - 1 + 50])
        assert block.setdefault((a, h), whole) == whole
    assert sum(n) == sum(max(len(t) - 49, 0) for t in texts)

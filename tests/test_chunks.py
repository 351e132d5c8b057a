"""Chunks of equal numbers of rows, whatever the keys look like."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from test_tables import Recorder

from lakeferry.operators import chunks
from lakeferry.sources import jdbc
from lakeferry.spec import TableSpec


def keys_of(kind):
    rng = random.Random(3)
    if kind == "wide":
        return rng.sample(range(10**18), 1000)
    if kind == "skewed":
        return sorted({int(1.02**i * 50) + i for i in range(900)} | set(range(40)))
    if kind == "text":
        return sorted({f"{rng.getrandbits(60):x}'{i}" for i in range(500)})
    if kind == "hot":
        return [7] * 600 + list(range(400))
    return list(range(100)) if kind == "dense" else []


@pytest.mark.parametrize("kind", ["wide", "skewed", "text", "hot", "dense", "none"])
def test_chunks_hold_the_contract_s_rows(spark, kind, view):
    keys, size = keys_of(kind), 64
    name = "string" if kind == "text" else "decimal(20,0)" if kind == "skewed" else "long"
    df = spark.createDataFrame([(str(k) if name != "long" else k, i) for i, k in enumerate(keys)], f"k {'string' if name != 'long' else name}, id long")
    df = df.withColumn("k", F.col("k").cast(name)).union(spark.sql(f"select cast(null as {name}), -1L")).repartition(7)
    df.createOrReplaceTempView(view)
    columns = ["k", "id"]
    starts = [tuple(r) for r in spark.sql(chunks.starts_text(columns, view, size)).collect()]
    assert [tuple(r) for r in chunks.chunk_starts(df, columns, size).collect()] == starts
    predicates = list(chunks.balanced_predicates(columns, starts))
    assert len(predicates) == max(-(-len(keys) // size), 1)
    found = df.select("k", *[F.expr(p).cast("int").alias(f"p{i}") for i, p in enumerate(predicates)])
    hits = [[i for i, x in enumerate(r[1:]) if x] for r in found.collect()]
    assert all(len(h) == 1 for h in hits)
    sizes = [sum(h == [i] for h in hits) for i in range(len(predicates))]
    assert max(sizes) <= size + 1 and all(s >= size for s in sizes[:-1])
    # outside the bounds that were known
    if kind == "wide":
        later = spark.createDataFrame([(-(10**18), 0), (2 * 10**18, 0)], "k long, id long")
        assert [r[0] + r[1] for r in later.select(F.expr(predicates[0]).cast("int"), F.expr(predicates[-1]).cast("int")).collect()] == [1, 1]


def test_one_column_keeps_a_hot_key_together():
    assert list(chunks.balanced_predicates(["k"], [(1,), (7,), (7,), (7,), (9,)])) == ["(k < 7 or k is null)", "(k >= 7 and k < 9)", "k >= 9"]
    assert list(chunks.balanced_predicates(["k"], [])) == list(chunks.balanced_predicates(["k"], [(3,)])) == ["1 = 1"]
    assert list(chunks.balanced_predicates(["d"], [(0,), (date(2024, 1, 2),)]))[1] == "d >= date '2024-01-02'"


def test_predicates_come_one_by_one():
    def starts():
        yield from ((i,) for i in range(3))
        raise AssertionError("asked for too much")

    found = chunks.balanced_predicates(["k"], starts())
    assert next(found) == "(k < 1 or k is null)"


class Histogram(Recorder):
    """Bounds of the key first, then the first keys of the chunks."""

    def __init__(self, low, high, step):
        super().__init__()
        self.keys = range(low, high, step)
        self.bounds = {"lo": low, "hi": high}

    def load(self):
        return self

    def first(self):
        return self.bounds

    def toLocalIterator(self):
        return ((k,) for k in self.keys)


def test_wide_keys_are_split_by_the_histogram():
    spec = TableSpec("t", (("id", "bigint"),), ts_column="at", chunk_rows=10)
    session = Histogram(0, 10**18, 10**16)
    jdbc.read_full(session, {"url": "u"}, spec)
    assert session.asked[1] == (
        "(select id from (select id, row_number() over (order by id) as place from t where id is not null) n "
        "where mod(place - 1, 10) = 0 order by id) q"
    )
    assert len(session.asked[-1][2]) == 100 and session.asked[-1][2][-1] == f"id >= {99 * 10**16}"
    jdbc.read_incremental(session, {"url": "u"}, spec, date(2024, 1, 1))
    assert "and (at >= '2024-01-01 00:00:00+00')" in session.asked[-2] and len(session.asked[-1][2]) == 100
    with pytest.raises(ValueError, match="read it in waves"):
        jdbc.read_full(Histogram(0, 10**18, 10**12), {"url": "u"}, spec)


def test_waves():
    spec = TableSpec("t", (("id", "bigint"), ("n", "integer")), ts_column="at", chunk_rows=10, chunk_column="n")
    session = Histogram(0, 1, 1)
    session.toLocalIterator = lambda: ((k, k) for k in range(25))
    waves = jdbc.read_waves(session, {"url": "u"}, spec, chunks=10)
    next(waves)
    assert len(session.asked) == 2 and "order by n, id" in session.asked[0] and len(session.asked[1][2]) == 10
    assert session.asked[1][2][1] == "((n > 1 or (n = 1 and id >= 1)) and (n < 2 or (n = 2 and id < 2)))"
    assert [len(session.asked[-1][2]) for _ in waves] == [10, 5]
    unsplit = TableSpec("t", (("key", "text"),), ts_column="at")
    assert len(list(jdbc.read_waves(session, {"url": "u"}, unsplit, date(2024, 1, 1)))) == 1
    assert session.asked[-1][1:3] == ("(select key from t where at >= '2024-01-01 00:00:00+00') q", ["1 = 1"])


@pytest.mark.parametrize("kind", ["wide", "skewed", "text", "hot", "dense", "none"])
def test_rows_have_the_number_of_their_predicate(spark, kind, monkeypatch):
    monkeypatch.setattr(chunks, "WAVE_PREDICATES", 3)
    name = "string" if kind == "text" else "long"
    df = spark.createDataFrame([(k, i) for i, k in enumerate([*keys_of(kind), None])], f"k {name}, id long").repartition(7)
    starts = [tuple(r) for r in chunks.chunk_starts(df, ["k"], 64).collect()]
    found = [list(chunks.balanced_predicates(["k"], starts))]
    if kind in ("dense", "hot"):
        found.append(chunks.range_predicates("k", 5, 90, 7))
    for predicates in found:
        hit = F.coalesce(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(predicates)])
        want = sorted(tuple(r) for r in df.select("id", hit).collect())
        assert sorted(tuple(r) for r in chunks.chunk_numbers(df, "k", predicates).select("id", "chunk").collect()) == want


def test_predicates_that_leave_gaps_are_refused(spark):
    df = spark.createDataFrame([(1,)], "k long")
    for few in (slice(1, None), slice(None, 2), slice(None, None, 2)):
        with pytest.raises(ValueError, match="predicate"):
            chunks.chunk_numbers(df, "k", chunks.range_predicates("k", 0, 40, 10)[few])


def orders_of(spark, folder, step, n=5000):
    orders = spark.range(n).select((F.col("id") * step).alias("o_orderkey"))
    orders.write.parquet(f"{folder}/orders.parquet")
    return str(folder)


def test_many_predicates_are_no_part_of_the_plan(spark, tmp_path):
    from workload.replication import chunked_by_range

    found = chunked_by_range(spark, orders_of(spark, tmp_path, 1000))
    assert "CASE WHEN" not in found._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, found.collect())) == [(i, 1) for i in range(5000)]


def test_cubes_beyond_bigint(spark, tmp_path):
    from workload.runs import chunked_balanced

    found = chunked_balanced(spark, orders_of(spark, tmp_path, 10**6))
    want = [(i, 1000, (i * 10**9) ** 3, ((i * 1000 + 999) * 10**6) ** 3) for i in range(5)]
    assert sorted((r[0], r[1], int(r[2]), int(r[3])) for r in found.collect()) == want

import glob
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.operators.guards import CheckFailed, table_counts
from lakeferry.plans import backfill, replicate
from lakeferry.sinks import tables
from lakeferry.sinks.messages import messages, write_messages
from lakeferry.sinks.storage import shared_path
from lakeferry.sources import files, jdbc
from lakeferry.spec import TableSpec

LOOKUPS = TableSpec.from_contract(
    "lookups",
    {
        "schema": {"id": "integer", "key": "character varying", "created_at": "timestamp without time zone"},
        "ts_column": "created_at",
        "bq_partition_column": "created_at",
    },
)


def lookups(spark, data):
    return spark.createDataFrame(data, "id int, key string, created_at timestamp")


DAY_1, DAY_2 = datetime(2024, 1, 1, 23, 59, 59), datetime(2024, 1, 2)


def test_shared_path_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_path(spark, "x").startswith(root + "/x-") and shared_path(spark, "x") != shared_path(spark, "x")


def test_raw_appends_and_backfill_replaces(spark, tmp_path, view):
    root = str(tmp_path / "raw")
    first, second = lookups(spark, [(1, "a", DAY_1)]), lookups(spark, [(1, "b", DAY_1), (2, "c", None)])
    replicate.load_raw(spark, first, LOOKUPS, "2024-01-03 00:00:00", root, view)
    replicate.load_raw(spark, second, LOOKUPS, "2024-01-04 00:00:00", root, view)
    assert spark.table(view).count() == 3
    raw = spark.table(view).drop(tables.DAY)
    assert rows(replicate.refined(raw, LOOKUPS).select("id", "key")) == [(1, "b"), (2, "c")]
    replicate.load_raw(spark, second, LOOKUPS, "2024-01-05 00:00:00", root, view, backfill=True)
    assert spark.table(view).count() == 2
    replicate.load_raw(spark, first, LOOKUPS, "2024-01-06 00:00:00", root, view)
    assert spark.table(view).count() == 3


def test_table_without_timestamp_is_replaced(spark, tmp_path, view):
    spec = TableSpec.from_contract("countries", {"schema": {"id": "integer", "code": "text"}})
    for code in ("se", "fi"):
        source = spark.createDataFrame([(1, code)], "id int, code string")
        replicate.load_raw(spark, source, spec, "2024-01-01 00:00:00", str(tmp_path), view)
    assert [r["code"] for r in spark.table(view).collect()] == ["fi"]


def test_day_reload(spark, tmp_path, view):
    run = "2024-01-03 00:00:00"
    replicate.load_raw(spark, lookups(spark, [(1, "a", DAY_1), (2, "b", DAY_2), (3, "c", DAY_2)]), LOOKUPS, run, str(tmp_path), view)
    again = lookups(spark, [(2, "B", DAY_2)])
    for _ in range(2):
        replicate.load_raw_day(spark, again, LOOKUPS, run, view, "created_at", date(2024, 1, 2))
        assert rows(spark.table(view).select("id", "key")) == [(1, "a"), (2, "B")]
    with pytest.raises(Exception, match="unexpected _day: 2024-01-01"):
        replicate.load_raw_day(spark, lookups(spark, [(1, "x", DAY_1)]), LOOKUPS, run, view, "created_at", date(2024, 1, 2))
    assert spark.table(view).count() == 2
    # a day that has no rows any more becomes empty, other days stay
    replicate.load_raw_day(spark, again.limit(0), LOOKUPS, run, view, "created_at", date(2024, 1, 2))
    assert rows(spark.table(view).select("id")) == [(1,)]
    with pytest.raises(ValueError, match="there is no table"):
        replicate.load_raw_day(spark, again, LOOKUPS, run, view + "x", "created_at", date(2024, 1, 2))
    with pytest.raises(Exception, match="PATH_NOT_FOUND|Path does not exist"):
        tables.reload_day(spark, again, str(tmp_path / "none"), "created_at", date(2024, 1, 2))


def test_clean_table_layout(spark, tmp_path, view):
    raw = replicate.landed(lookups(spark, [(i, "k", DAY_1) for i in range(200)] + [(1, "k", DAY_2)]), LOOKUPS, "2024-01-03 00:00:00")
    # small ranges are not joined here, as they would not be in a large table
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        replicate.build_clean(spark, raw, LOOKUPS, str(tmp_path), view)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tables.DAY not in spark.table(view).columns and spark.table(view).count() == 201
    clean = spark.read.parquet(tables.current_path(spark, view))
    # files of one day hold separate ranges of keys
    spans = sorted(
        (r["lo"], r["hi"])
        for r in clean.filter(f"{tables.DAY} = date'2024-01-01'")
        .groupBy(F.input_file_name())
        .agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
        .collect()
    )
    assert len(spans) > 1 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert "PartitionFilters: [isnotnull(_day" in clean.filter(f"{tables.DAY} = date'2024-01-01'")._jdf.queryExecution().executedPlan().toString()
    sensitive = TableSpec(**{**LOOKUPS.__dict__, "gdpr_sensitive": True})
    with pytest.raises(ValueError, match="sensitive"):
        replicate.build_clean(spark, raw, sensitive, str(tmp_path), view)


def test_hot_day_is_split_by_rebalance(spark, tmp_path):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(0).alias("part"), F.repeat(F.lit("x"), 50).alias("t"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    try:
        tables.replace_partitions(df.repartition(8), str(tmp_path / "t"), ["part"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20_000
    assert len(glob.glob(str(tmp_path / "t" / "part=0" / "*.parquet"))) > 1


def test_copies_of_a_row_are_spread(spark, tmp_path):
    # a third of the rows are copies of one row, and all are of one day
    df = spark.range(3000).repartition(6).select(F.lit(1).alias("p"), F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = tables.write_snapshot(df, str(tmp_path), ["p"], ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(path)
    sizes = [r["n"] for r in back.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert back.count() == 3000 and back.filter("k = 5").count() == 1001
    assert len(sizes) == 4 and max(sizes) < 1200
    assert back.filter("k = 5").groupBy(F.input_file_name()).count().count() > 1


def test_replace_partitions_leaves_others(spark, tmp_path):
    path = str(tmp_path)
    schema = "v int, date string, country string"
    tables.replace_partitions(spark.createDataFrame([(1, "d1", "SE"), (2, "d1", "FI"), (3, "d2", "SE")], schema), path, ["date", "country"])
    new = spark.createDataFrame([(9, "d1", "SE")], schema)
    for df in (new, new, new.limit(0)):
        tables.replace_partitions(df, path, ["date", "country"])
        assert rows(spark.read.parquet(path)) == [(2, "d1", "FI"), (3, "d2", "SE"), (9, "d1", "SE")]


def test_publish_can_read_the_version_it_replaces(spark, tmp_path, view):
    tables.publish(spark, spark.range(3), view, str(tmp_path))
    tables.publish(spark, spark.table(view).filter("id > 0"), view, str(tmp_path))
    assert rows(spark.table(view)) == [(1,), (2,)]
    tables.publish(spark, spark.table(view).withColumn("p", F.lit(1)).limit(0), view, str(tmp_path), ["p"])
    assert spark.table(view).columns == ["id", "p"] and spark.table(view).count() == 0


def test_promotion(spark, tmp_path, view):
    spec = TableSpec.from_contract("t", {"schema": {"id": "bigint"}})
    full = spark.range(2000)
    counts = table_counts({"t": full})
    backfill.promote(spark, full, spec, counts, str(tmp_path), view)
    backfill.promote(spark, full.filter("id > 1"), spec, counts, str(tmp_path), view)
    assert spark.table(view).count() == 1998
    with pytest.raises(CheckFailed):
        backfill.promote(spark, full.filter("id > 2"), spec, counts, str(tmp_path), view)
    assert spark.table(view).count() == 1998
    with pytest.raises(ValueError, match="no source count"):
        backfill.promote(spark, full, TableSpec("other", (("id", "bigint"),)), counts, str(tmp_path), view)
    free = TableSpec.from_contract("t", {"schema": {"id": "bigint"}, "ignore_sanity_check": True, "ignore_daily": True})
    backfill.promote(spark, full.limit(1), free, counts, str(tmp_path), view)
    assert spark.table(view).count() == 1
    assert backfill.target_layer(free) == "clean" and backfill.target_layer(spec) == "raw"


SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("price", T.DecimalType(38, 9)),
    ]
)
LINES = [
    '1,"a\nb ""q""",2024-01-01 10:00:00,"{x,""y,z""}",12345678901234567890.123456789',
    "2,short",
    "3,long,2024-01-01 00:00:00,{},1,surplus,more",
    "x,bad integer,,,",
    "4,,not a time,,",
    '5,"",,,',
]


def test_dirty_csv(spark, tmp_path, view):
    (tmp_path / "in.csv").write_text("\n".join(LINES) + "\n")
    got = {r["id"]: r for r in files.read_csv(spark, str(tmp_path / "in.csv"), SCHEMA).collect()}
    assert [k for k, r in got.items() if r["_bad_row"]] == [None, 4]
    assert got[1]["text"] == 'a\nb "q"' and got[1]["tags"] == ["x", "y,z"]
    assert str(got[1]["price"]) == "12345678901234567890.123456789"
    assert got[2]["text"] == "short" and got[2]["at"] is None
    assert got[3]["text"] == "long" and got[3]["tags"] == []
    assert got[5]["text"] == ""


def test_bad_row_limit(spark, tmp_path, view):
    (tmp_path / "in.csv").write_text("\n".join(LINES) + "\n")
    read = files.read_csv(spark, str(tmp_path / "in.csv"), SCHEMA)
    assert tables.publish_checked(spark, read, view, str(tmp_path / "t"), 2) == 2
    assert spark.table(view).count() == 4
    with pytest.raises(CheckFailed, match="2 bad rows"):
        tables.publish_checked(spark, read, view, str(tmp_path / "t"), 1)
    assert spark.table(view).count() == 4


def test_csv_headers_and_splits(spark, tmp_path):
    df = spark.createDataFrame([(1, " kept "), (2, 'say "x", y'), (3, None), (4, "")], "id long, text string")
    tables.write_report_csv(df, str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c"), df.schema, header_rows=1, quoted_newlines=False)
    assert rows(back.drop("_bad_row")) == rows(df)
    with pytest.raises(ValueError):
        files.read_csv(spark, str(tmp_path / "c"), df.schema, header_rows=2)


def test_csv_to_nested_json(spark, tmp_path):
    spec = TableSpec.from_contract("t", {"schema": {"id": "integer", "tags": "ARRAY", "amount": "numeric"}})
    (tmp_path / "in.csv").write_text('1,"{a,b}",0.1,2024-01-01 00:00:00\n2,,,\n')
    tables.csv_to_ndjson(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), spec)
    back = files.read_ndjson(spark, str(tmp_path / "out"), spec.spark_schema()).orderBy("id").collect()
    assert back[0]["tags"] == ["a", "b"] and str(back[0]["amount"]) == "0.100000000"
    assert back[0]["_ingested_ts"] == datetime(2024, 1, 1) and back[1]["tags"] is None


def test_artifacts_and_xml_files(spark, tmp_path):
    (tmp_path / "c.json").write_text('{\n "tables": [{"name": "core.a", "covered": 1, "total": 2}]\n}')
    artifact = files.read_artifact(spark, str(tmp_path / "c.json"), files.COVERAGE_ARTIFACT)
    assert artifact.first()["tables"][0]["name"] == "core.a"
    (tmp_path / "r.xml").write_text("<e><b><series><seriesname>USD</seriesname><unit>1</unit></series></b></e>")
    assert files.read_xml_series(spark, str(tmp_path / "r.xml"), "seriesname string, unit string").first()["seriesname"] == "USD"


def test_messages(spark, tmp_path):
    write_messages(messages(spark.range(2), F.to_json(F.struct("id"))), str(tmp_path / "m"))
    assert rows(spark.read.text(str(tmp_path / "m"))) == [('{"id":0}',), ('{"id":1}',)]


# no database is started: the texts and predicates that a read sends are checked instead
def test_jdbc_texts():
    spec = TableSpec.from_contract(
        "payout.events",
        {"schema": {"id": "bigint", '"order"': "integer", "camelCase": "text"}, "ts_column": "COALESCE(updated_at, created_at)", "bq_partition_column": "created_at"},
    )
    day = date(2024, 2, 29)
    assert jdbc.select_text(spec) == 'select id, "order", "camelCase" from payout.events'
    assert jdbc.since(spec, day) == "COALESCE(updated_at, created_at) >= '2024-02-29 00:00:00+00'"
    assert jdbc.since(TableSpec("t", ()), day) is None
    assert jdbc.day_text(spec, "ts", day).endswith("where ts >= '2024-02-29 00:00:00+00' and ts < '2024-03-01 00:00:00+00'")
    assert jdbc.counts_text([spec, TableSpec("b", ())]) == (
        "select 'events' as table_name, count(*) as num_rows from payout.events union all "
        "select 'b' as table_name, count(*) as num_rows from b"
    )
    assert "table_name in ('events')" in jdbc.catalog_text([spec])


class Selected:
    """Stands for the rows that a read returns."""

    def __getitem__(self, name):
        return name

    def select(self, *columns):
        return columns


class Recorder:
    """Stands for a session and keeps what a read would ask for."""

    def __init__(self):
        self.asked = []
        self.read = self

    def format(self, name):
        return self

    def options(self, **options):
        self.asked.append(options["dbtable"])
        return self

    def load(self):
        return "rows"

    def jdbc(self, url, table, predicates, properties):
        self.asked.append((url, table, predicates, properties["fetchsize"]))
        return Selected()


def test_jdbc_reads_are_split():
    connection = {"url": "jdbc:x", "user": "u"}
    spec = TableSpec("t", (("id", "bigint"),), ts_column="updated_at", partition_column="created_at", chunk_rows=10)
    session = Recorder()
    jdbc.read_full(session, connection, spec, bounds=(1, 30))
    url, table, predicates, fetch = session.asked[-1]
    assert (url, table, fetch) == ("jdbc:x", "(select id from t) q", "10000") and len(predicates) == 3
    jdbc.read_full(session, connection, spec, days=(date(2024, 1, 1), date(2024, 1, 4)))
    assert len(session.asked[-1][2]) == 5 and session.asked[-1][2][-1].endswith("created_at is null)")
    assert jdbc.read_incremental(session, connection, spec, date(2024, 1, 1), date(2024, 1, 2)) == ("`id`",)
    _, table, predicates, _ = session.asked[-1]
    assert table == "t" and len(predicates) == 3
    assert all(p.startswith("(updated_at >= '2024-01-01 00:00:00+00') and (updated_at ") for p in predicates)
    jdbc.read_incremental(session, connection, spec, date(2024, 1, 1), bounds=(1, 30))
    assert "where updated_at >= " in session.asked[-1][1] and len(session.asked[-1][2]) == 3
    unsplit = TableSpec("t", (("id", "text"),), ts_column="updated_at")
    jdbc.read_incremental(session, connection, unsplit, date(2024, 1, 1))
    assert session.asked[-1] == "(select id from t where updated_at >= '2024-01-01 00:00:00+00') q"
    jdbc.read_full(session, connection, unsplit)
    assert session.asked[-1] == "(select id from t) q"


class OneRow(Recorder):
    def __init__(self, row):
        super().__init__()
        self.row = row

    def load(self):
        return self

    def first(self):
        return self.row


def test_jdbc_bounds():
    spec = TableSpec("t", (("id", "bigint"),))
    session = OneRow({"lo": 3, "hi": 9})
    assert jdbc.key_bounds(session, {"url": "u"}, spec) == (3, 9)
    assert session.asked == ["(select min(id) as lo, max(id) as hi from t) q"]
    assert jdbc.key_bounds(OneRow({"lo": None, "hi": None}), {"url": "u"}, spec) is None
    assert jdbc.key_bounds(session, {"url": "u"}, TableSpec("t", (("id", "text"),))) is None
    dated = TableSpec("t", (("id", "text"), ("created_at", "timestamp with time zone")))
    asked = OneRow({"lo": datetime(2024, 1, 1, 5), "hi": date(2024, 1, 3)})
    assert jdbc.day_bounds(asked, {"url": "u"}, dated) == (date(2024, 1, 1), date(2024, 1, 3))
    assert asked.asked == ["(select min(created_at) as lo, max(created_at) as hi from t) q"]
    assert jdbc.day_bounds(asked, {"url": "u"}, spec) is None


def test_reads_are_split_without_bounds_of_the_caller():
    connection = {"url": "jdbc:x", "user": "u"}
    numbered = TableSpec("t", (("id", "bigint"),), ts_column="updated_at", chunk_rows=10)
    session = OneRow({"lo": 1, "hi": 30})
    jdbc.read_incremental(session, connection, numbered, date(2024, 1, 1))
    assert session.asked[0].endswith("from t where updated_at >= '2024-01-01 00:00:00+00') q")
    assert len(session.asked[-1][2]) == 3
    jdbc.read_full(session, connection, numbered)
    assert len(session.asked[-1][2]) == 3
    dated = TableSpec("t", (("id", "text"), ("created_at", "timestamp with time zone")))
    session = OneRow({"lo": date(2024, 1, 1), "hi": date(2024, 1, 3)})
    jdbc.read_full(session, connection, dated)
    assert len(session.asked[-1][2]) == 4
    # the contract's chunk size holds for any table; only the caller widens it
    large = OneRow({"lo": 1, "hi": 50_000})
    jdbc.read_full(large, connection, numbered)
    assert len(large.asked[-1][2]) == 5_000
    jdbc.read_full(large, connection, numbered, max_tasks=7)
    assert len(large.asked[-1][2]) == 7


def test_packed_messages_are_the_same_rows(spark, tmp_path, monkeypatch):
    from lakeferry.sinks import messages as sink

    monkeypatch.setattr(sink, "PACKED_MESSAGES", 1000)
    rows = messages(spark.range(5000).coalesce(1), F.to_json(F.struct("id", F.lit("a campaign of the report").alias("name"))))
    sizes = {}
    for codec in (None, "lz4"):
        path = tmp_path / str(codec)
        write_messages(rows, str(path), codec)
        assert spark.read.text(str(path)).exceptAll(rows).count() == 0 and spark.read.text(str(path)).count() == 5000
        sizes[codec] = [f.stat().st_size for f in path.glob("part-*")]
    assert len(sizes["lz4"]) == 5 and sum(sizes["lz4"]) < sum(sizes[None]) / 3


def test_landed_reports_are_packed(spark, tmp_path, monkeypatch):
    from workload import documents

    monkeypatch.setattr(documents, "shared_path", lambda session, name: str(tmp_path / name))
    reports = spark.range(100).select(F.to_json(F.struct("id")).alias("value"))
    assert documents._landed(spark, reports, "r", "id long").count() == 100
    assert not list((tmp_path / "r").glob("*.txt")) and list((tmp_path / "r").glob("*.lz4"))

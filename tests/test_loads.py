"""Loads that must not lose rows: limits of bad rows, promotion, reruns, growth, other session zones."""

import glob
import random
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.json_documents import JsonField, project_json
from lakeferry.functions.times import day_of, instant
from lakeferry.operators.guards import CheckFailed, require_passed, table_counts
from lakeferry.plans import backfill, marketing, metadata, replicate, subject_report
from lakeferry.sinks import tables
from lakeferry.sources import files
from lakeferry.spec import TableSpec

RUN_1, RUN_2 = "2024-02-01 00:00:00", "2024-02-02 00:00:00"
SPEC = TableSpec.from_contract(
    "t",
    {
        "schema": {"id": "bigint", "at": "timestamp without time zone", "note": "text"},
        "ts_column": "at",
        "bq_partition_column": "at",
    },
)


def source(spark, ids, day=1, note="a"):
    return spark.createDataFrame([(i, datetime(2024, 1, day, 5), note) for i in ids], "id long, at timestamp_ntz, note string")


def test_appends_after_a_promotion_keep_all_rows(spark, tmp_path, view):
    early = source(spark, range(100))
    backfill.promote(spark, replicate.landed(early, SPEC, RUN_1), SPEC, table_counts({"t": early}), str(tmp_path), view)
    replicate.load_raw(spark, source(spark, [200], day=2), SPEC, RUN_2, str(tmp_path), view)
    assert spark.table(view).count() == 101
    replicate.load_raw_day(spark, source(spark, [1, 2]), SPEC, RUN_2, view, "at", date(2024, 1, 1))
    assert sorted(r["id"] for r in spark.table(view).collect()) == [1, 2, 200]
    replicate.load_raw_day(spark, source(spark, []), SPEC, RUN_2, view, "at", date(2024, 1, 1))
    assert [r["id"] for r in spark.table(view).collect()] == [200]


def test_a_promoted_clean_table_has_the_clean_layout(spark, tmp_path, view):
    spec = TableSpec.from_contract("t", {"schema": {"id": "bigint", "created_at": "timestamp without time zone"}, "ignore_daily": True})
    df = spark.createDataFrame([(i, datetime(2024, 1, 1 + i % 2)) for i in range(10)], "id long, created_at timestamp_ntz")
    path = backfill.promote(spark, df, spec, table_counts({"t": df}), str(tmp_path), view)
    assert len(glob.glob(f"{path}/_day=*")) == 2 and spark.table(view).columns == ["id", "created_at"]


def test_the_same_run_twice_counts_once(spark, tmp_path, view):
    for _ in range(2):
        replicate.load_raw(spark, source(spark, [1, 2, 3]), SPEC, RUN_1, str(tmp_path), view)
    assert spark.table(view).count() == 6
    assert sorted(r["id"] for r in replicate.current_rows(spark.table(view), SPEC).collect()) == [1, 2, 3]


def test_a_new_column_is_shown(spark, tmp_path, view):
    narrow = TableSpec(**{**SPEC.__dict__, "columns": SPEC.columns[:2]})
    replicate.load_raw(spark, source(spark, [1]), narrow, RUN_1, str(tmp_path), view)
    replicate.load_raw(spark, source(spark, [2], day=2), SPEC, RUN_2, str(tmp_path), view)
    assert rows(spark.table(view).select("id", "note")) == [(1, None), (2, "a")]
    replicate.load_raw_day(spark, source(spark, [3], note="b"), SPEC, RUN_2, view, "at", date(2024, 1, 1))
    assert rows(spark.table(view).select("id", "note")) == [(2, "a"), (3, "b")]


def test_other_tables_are_refused(spark, tmp_path, view):
    spark.range(3).write.saveAsTable(view)
    with pytest.raises(ValueError, match="no table of this toolkit"):
        replicate.load_raw(spark, source(spark, [1]), SPEC, RUN_1, str(tmp_path), view)
    spark.sql(f"drop table {view}")


def test_old_versions(spark, tmp_path, view):
    for n in range(4):
        tables.publish(spark, spark.range(n + 1), view, str(tmp_path))
    assert len(tables.drop_old_versions(spark, view, str(tmp_path), keep=1)) == 2
    assert spark.table(view).count() == 4 and len(glob.glob(f"{tmp_path}/version=*")) == 2


def bad_lines(n):
    return "\n".join([f'{{"id": {i}}}' for i in range(20)] + ['{"id": "x"}', "{cut"][:1] * (n - n // 2) + ["{cut"] * (n // 2)) + "\n"


@pytest.mark.parametrize("found", [3, 4])
def test_bad_json_lines(spark, tmp_path, view, found):
    (tmp_path / "in.json").write_text(bad_lines(found))
    read = files.read_ndjson_flagged(spark, str(tmp_path / "in.json"), "id long")
    if found > 3:
        with pytest.raises(CheckFailed, match="4 bad rows"):
            tables.checked_rows(read, str(tmp_path / "load"), 3)
    else:
        good, bad = tables.checked_rows(read, str(tmp_path / "load"), 3)
        assert (good.count(), bad) == (20, 3)
    rejects = spark.read.parquet(str(tmp_path / "load" / tables.REJECTS))
    assert rejects.count() == found and rejects.filter(f"{files.CORRUPT} is null").isEmpty()
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        files.read_ndjson(spark, str(tmp_path / "in.json"), "id long").collect()


def test_bad_reports_leave_the_table_alone(spark, tmp_path):
    good = '{"metadata": {"campaignId": 1}, "granularity": [{"date": "2024-01-01", "localSpend": {"amount": "5", "currency": "SEK"}}]}\n'
    (tmp_path / "a.json").write_text(good)
    marketing.load_apple(spark, str(tmp_path / "a.json"), str(tmp_path / "t"))
    (tmp_path / "b.json").write_text(good + "{cut\n" * 2)
    marketing.load_apple(spark, str(tmp_path / "b.json"), str(tmp_path / "t"), max_bad_rows=2)
    before = rows(spark.read.parquet(str(tmp_path / "t")))
    with pytest.raises(CheckFailed):
        marketing.load_apple(spark, str(tmp_path / "b.json"), str(tmp_path / "t"), max_bad_rows=1)
    assert rows(spark.read.parquet(str(tmp_path / "t"))) == before and len(before) == 1


def test_bad_rows_leave_a_day_alone(spark, tmp_path):
    schema = T.StructType().add("day", "date").add("n", "integer")
    table = str(tmp_path / "t")
    spark.createDataFrame([(date(2024, 1, 1), 1)], schema).withColumn("_day", F.col("day")).write.partitionBy("_day").parquet(table)
    (tmp_path / "in.csv").write_text("day,n\n" + "2024-01-01,2\n" + "2024-01-01,x\n" * 3)
    with pytest.raises(CheckFailed, match="3 bad rows"):
        metadata.load_report_day(spark, str(tmp_path / "in.csv"), schema, table, "day", date(2024, 1, 1), max_bad_rows=2)
    assert [r["n"] for r in spark.read.parquet(table).collect()] == [1]
    assert metadata.load_report_day(spark, str(tmp_path / "in.csv"), schema, table, "day", date(2024, 1, 1), max_bad_rows=3) == 3
    assert [r["n"] for r in spark.read.parquet(table).collect()] == [2]
    assert spark.read.parquet(f"{table}.load/{tables.REJECTS}").count() == 6


def test_bad_values_do_not_reach_nested_json(spark, tmp_path):
    spec = TableSpec.from_contract("t", {"schema": {"id": "integer", "tags": "ARRAY"}})
    (tmp_path / "in.csv").write_text('1,"{a,b}",\nzz,b,notatime\n')
    with pytest.raises(CheckFailed):
        tables.csv_to_ndjson(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), spec, max_bad_rows=0)
    assert not (tmp_path / "out").exists()
    assert tables.csv_to_ndjson(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), spec) == 1
    assert files.read_ndjson(spark, str(tmp_path / "out"), spec.spark_schema()).count() == 1


@pytest.mark.parametrize("header", [0, 1])
def test_rows_that_cross_splits(spark, tmp_path, header):
    schema = T.StructType().add("id", "integer").add("t", "string").add("n", "integer")
    for name in "ab":
        lines = [f'{i},"{name} line\nsecond ""{i}"" line\n\n{"x" * (i % 40)}",{i * 2}' if i % 3 else f"{i},plain,{i * 2}" for i in range(300)]
        (tmp_path / f"{name}.csv").write_text("id,t,n\n" * header + "\n".join(lines) + ("\n" if name == "a" else ""))
    whole = rows(files.read_csv(spark, str(tmp_path), schema, header))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        split = files.read_csv(spark, str(tmp_path), schema, header, max_file_bytes=1)
        assert rows(split) == whole and split.count() == 600
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_every_failed_table_is_named(spark):
    check = spark.createDataFrame([(f"t{i}", False) for i in range(150)], "table_name string, passed boolean")
    with pytest.raises(CheckFailed) as failed:
        require_passed(check)
    assert all(f"'t{i}'" in str(failed.value) for i in range(150))


def test_json_paths(spark):
    df = spark.createDataFrame(
        [('{"a": 1, "a-b": 2, "x y": {"n": [5, 6]}, "q": "z"}',), ("{bad",), ('{"a": 1, "a": 2}',), (None,)], "doc string"
    )
    fields = [
        JsonField("a", ("$.a",), "integer"),
        JsonField("ab", ("$.a-b",), "integer"),
        JsonField("xy", ("$['x y'].n[1]",), "integer"),
        JsonField("q", ('$["q"]',), "integer"),
    ]
    got = [r[1:] for r in project_json(df, "doc", fields, "rejects").collect()]
    assert got[0] == (1, 2, 6, None, ["q"])
    assert got[1] == (None, None, None, None, ["doc"]) and got[3] == (None, None, None, None, [])
    assert got[2][-1] == ["doc"]
    for path in ("a", "$a", "$.a b", "$.", "$[x]", "$.a["):
        with pytest.raises(ValueError, match="no JSON path"):
            project_json(df, "doc", [JsonField("f", (path,))])


def test_reports_of_earlier_customers_stay(spark, tmp_path):
    sendouts = spark.createDataFrame(
        [(c, datetime(2024, 1, 1), "sent", "mail", "r", "{}") for c in (1, 1, 2)],
        "customer_id int, scheduled_at timestamp, status string, type string, recipient string, content string",
    )
    section = {"communications": subject_report.SECTIONS["communications"]}
    for ids in ([1], [2], [1, 3]):
        requests = spark.createDataFrame([(i,) for i in ids], "customer_id int")
        subject_report.write_report({"sendouts": sendouts}, requests, str(tmp_path), section)
    found = sorted(p.rsplit("=", 1)[-1] for p in glob.glob(f"{tmp_path}/communications/_customer=*"))
    assert found == ["1", "2", "3"]
    read = spark.read.option("header", True).csv(f"{tmp_path}/communications")
    assert read.count() == 3


def test_headers_alone_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(subject_report, "FOLDERS_PER_TASK", 10, raising=False)
    schema = "customer_id int, scheduled_at timestamp, status string, type string, recipient string, content string"
    section = {"communications": subject_report.SECTIONS["communications"]}
    requests = spark.range(100).select(F.col("id").cast("int").alias("customer_id"))
    subject_report.write_report({"sendouts": spark.createDataFrame([], schema)}, requests, str(tmp_path), section)
    files = glob.glob(f"{tmp_path}/communications/_customer=*/part-*")
    assert len(files) == 100 and len({f.rsplit("/", 1)[-1].split("-")[1] for f in files}) > 3


@pytest.fixture
def new_york(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_times_without_a_zone_are_utc(spark, new_york, tmp_path, view):
    df = spark.createDataFrame(
        [("2024-03-10 02:30:00", datetime(2024, 3, 10, 2, 30), date(2024, 3, 10))], "t string, n timestamp_ntz, d date"
    )
    seconds = df.select(*[F.unix_seconds(instant(F.col(c), df.schema[c].dataType)) for c in df.columns]).first()
    assert tuple(seconds) == (1710037800, 1710037800, 1710028800)
    assert df.select(day_of(instant(F.col("n"), T.TimestampNTZType()), T.TimestampType())).first()[0] == date(2024, 3, 10)
    replicate.load_raw(spark, source(spark, [1]), SPEC, RUN_1, str(tmp_path / "raw"), view)
    stored = spark.table(view).select(F.unix_seconds("_ingested_ts"), F.unix_seconds(F.to_timestamp(F.concat(F.col("at").cast("string"), F.lit("Z"))) if dict(spark.table(view).dtypes)["at"] != "timestamp" else F.col("at"))).first()
    assert tuple(stored) == (1706745600, 1704085200)
    (tmp_path / "in.csv").write_text("2024-01-01 00:00:00\nnever\n")
    read = files.read_csv(spark, str(tmp_path / "in.csv"), T.StructType().add("at", "timestamp"))
    assert [(r[0], r["_bad_row"]) for r in read.select(F.unix_seconds("at"), "_bad_row").collect()] == [(1704067200, False), (None, True)]


def test_outcome_of_the_index_fetch(spark):
    from lakeferry.operators.rates import CLOSED, FOUND, INDEX_TITLE, index_outcomes
    from lakeferry.plans.rates import require_index

    def page(title, day="3/5/2024", quote="'"):
        cells = "".join(f"<tr><td>{t}</td><td>{v}</td></tr>" for t, v in (("a", 1), ("b", 2), (title, "3&#46;5 &#x25;")))
        return f"<table id=x class={quote}table table-striped{quote}><tr><th>{day}</th></tr>{cells}</table>"

    tuesday, saturday = date(2024, 3, 5), date(2024, 3, 2)
    pages = spark.createDataFrame([(page(INDEX_TITLE),)], "html string")
    got = index_outcomes(pages, tuesday).first()
    assert (float(got["value"]), got["outcome"]) == (3.5, FOUND) and require_index(pages, tuesday) == FOUND
    assert require_index(pages, saturday) == CLOSED
    for bad in (page("renamed"), page(INDEX_TITLE, "3/4/2024"), "<p>none</p>", None):
        with pytest.raises(CheckFailed, match="no index value"):
            require_index(spark.createDataFrame([(bad,)], "html string"), tuesday)


@pytest.mark.parametrize("seed", range(4))
def test_rows_do_not_depend_on_the_size_of_splits(spark, tmp_path, seed):
    """Against a reader that goes through a file character by character."""
    rng = random.Random(seed)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b", "c")])
    values = ["", " ", "x", "x y", 'p"q', "é", "\t", '"a"', '"two\nlines"', '"say ""x"""', '""', '"\n\n"', '" "']
    read = {"": None, '"a"': "a", '"two\nlines"': "two\nlines", '"say ""x"""': 'say "x"', '""': "", '"\n\n"': "\n\n", '" "': " "}
    want = {0: [], 1: []}
    for n in range(12):
        lines = [[rng.choice(values) for _ in range(rng.randint(1, 4))] for _ in range(40)] + [[""], ["   "], ["\t"], [" ", " "]]
        rng.shuffle(lines)
        end = "\n" if seed % 2 else rng.choice(["\n", "\r\n"])
        (tmp_path / f"{n}.csv").write_bytes((end.join(map(",".join, lines)) + rng.choice(["", end])).encode())
        found = [tuple(([read.get(v, v) for v in line] + [None, None])[:3]) for line in lines if line != [""]]
        for header in (0, 1):
            want[header] += [(*r, False) for r in found[header:]]
    try:
        for size, file_bytes in ((1 << 20, files.UNSPLIT_BYTES), (1 << 20, 0), (150, 0)):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            for header in (0, 1):
                got = files.read_csv(spark, str(tmp_path), schema, header, max_file_bytes=file_bytes)
                assert rows(got) == sorted(want[header], key=str)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_a_row_of_very_many_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text('1,"' + "line\n" * 12_000 + '"\n2,b\n')
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("t", T.StringType())])
    for size in (files.UNSPLIT_BYTES, 0):
        got = files.read_csv(spark, str(tmp_path), schema, max_file_bytes=size).select("id", F.length("t")).collect()
        assert sorted(map(tuple, got)) == [(1, 60_000), (2, 1)]


def test_stray_quotes_lose_no_rows(spark, tmp_path):
    rows = ['1,5" pipe', '2,"two\nlines, ""quoted"""', "3,plain", '4,3" and 4" pipes, say', '5,"', '6"', "7,end", '8,"a"', '9,x"y']
    file = tmp_path / "pipes.csv"
    file.write_text("\n".join(rows * 40) + "\n")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])
    read = []
    try:
        for size in (1 << 20, 200):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            for n in (1 << 20, 0):
                read.append(sorted(map(tuple, files.read_csv(spark, str(file), schema, max_file_bytes=n).collect()), key=str))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert all(r == read[0] for r in read) and len(read[0]) == 40 * 8 and ("1", '5" pipe', False) in read[0]
    (tmp_path / "open.csv").write_text('1,a\n2,"open\n3,b\n')
    for n in (1 << 20, 0):
        with pytest.raises(ValueError, match="open quoted value"):
            files.read_csv(spark, str(tmp_path / "open.csv"), schema, max_file_bytes=n)

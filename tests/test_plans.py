import glob
import json
from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.operators.derived import TASK_COLUMNS
from lakeferry.operators.guards import CheckFailed
from lakeferry.operators.marketing import APPLE_SCHEMA, SNAPCHAT_SCHEMA, apple_rows, snapchat_rows
from lakeferry.operators.rates import index_message, index_values, response_faults
from lakeferry.plans import exports, marketing, metadata, rates, subject_report
from lakeferry.sources.files import read_ndjson
from lakeferry.spec import parse_specs


def land(path, *documents):
    path.mkdir(exist_ok=True)
    (path / "r.json").write_text("\n".join(json.dumps(d) for d in documents))
    return str(path)


def apple(spend, **meta):
    return {
        "metadata": {"campaignId": 1, "countriesOrRegions": ["SE", "FI"], "totalBudget": {"amount": "100"}, **meta},
        "granularity": [{"date": "2024-01-01", "localSpend": {"amount": spend, "currency": "SEK"}, "taps": 3}],
    }


def test_apple(spark, tmp_path):
    landing = land(tmp_path / "in", apple(0), apple("0"), apple("0.0"), apple("2.5", adChannelType="SEARCH", app={"appName": "x", "other": 1}), apple(1))
    got = apple_rows(read_ndjson(spark, landing, APPLE_SCHEMA)).orderBy("local_spend").collect()
    assert [r["local_spend"] for r in got] == [1.0, 2.5]
    assert got[0]["app_dict"] == "{}" and json.loads(got[1]["app_dict"]) == {"appName": "x", "other": 1}
    assert got[1]["ad_channel_type"] == "SEARCH" and got[0]["countries"] == "SE,FI"
    assert got[0]["deleted"] is False and got[0]["total_remaining_budget"] == 0 and got[0]["impressions"] == 0
    assert len(got[0]) == 19
    path = str(tmp_path / "out")
    for _ in range(2):
        marketing.load_apple(spark, landing, path)
        assert spark.read.parquet(path).count() == 2
    marketing.load_apple(spark, land(tmp_path / "none", apple(0)), path)
    assert spark.read.parquet(path).count() == 2


def snap(at, name, *spends):
    ad = {"ad": {"id": "a1", "name": "n"}, "timeseries": [{"stats": {"spend": s, "impressions": 5}} for s in spends]}
    return {"execution_ts": at, "campaigns": [{"campaign": {"id": "c1", "name": name}, "ads": [ad]}, {"campaign": {"id": "c2", "name": "x"}, "ads": []}]}


def test_snapchat(spark, tmp_path):
    landing = land(
        tmp_path / "in",
        snap("2022-03-27T01:00:00Z", "se_brand", 2_000_000, 0),
        snap("2022-10-30T23:30:00Z", "plain", 4_000_000),
        {"execution_ts": "2022-01-01T00:00:00Z", "campaigns": []},
    )
    got = snapchat_rows(read_ndjson(spark, landing, SNAPCHAT_SCHEMA)).orderBy("spend").collect()
    assert [(r["date"], r["country_code"], r["spend"], r["currency_code"]) for r in got] == [
        (date(2022, 3, 27), "SE", 2.5, "EUR"), (date(2022, 10, 31), "PLAIN", 5.0, "EUR"),
    ]
    assert got[0]["impressions"] == 5 and got[0]["uniques"] == 0 and got[0]["swipe_up_percent"] is None and len(got[0]) == 19
    marketing.load_snapchat(spark, landing, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def tiktok(account, ad_id, name, spend):
    metrics = {"spend": spend, "clicks": 2} | ({"campaign_name": name} if name else {})
    return {"account_country": account, "list": [{"dimensions": {"stat_time_day": "2022-05-01 00:00:00", "ad_id": ad_id}, "metrics": metrics}]}


def test_tiktok(spark, tmp_path):
    path = str(tmp_path / "out")
    both = [tiktok("SE", 1, "fi_x", "8.0"), tiktok("SE", 2, "zz", "4"), tiktok("SE", 3, None, "4"), tiktok("SE", 4, "se", "0.0"), tiktok("FI", 5, "fi", "1")]
    marketing.load_tiktok(spark, land(tmp_path / "a", *both), path)
    shown = spark.read.parquet(path)
    assert rows(shown.select("ad_id", "country_code", "spend", "account_country")) == [
        (1, "FI", 10.0, "SE"), (2, "SE", 5.0, "SE"), (3, "SE", 5.0, "SE"), (5, "FI", 1.25, "FI"),
    ]
    assert len(shown.drop("day", "account_country").columns) == 26
    # one account is loaded again: its rows are replaced, also those with another derived country
    marketing.load_tiktok(spark, land(tmp_path / "b", *both[:2]), path)
    assert rows(spark.read.parquet(path).select("ad_id")) == [(1,), (2,), (5,)]


def body(*series):
    parts = "".join(f"<series><seriesname>{n}</seriesname><unit>{u}</unit><ultimo>{v}</ultimo></series>" for n, u, v in series)
    return f'<s:E xmlns:s="http://www.w3.org/2003/05/soap-envelope"><s:Body><r><groups>{parts}</groups></r></s:Body></s:E>'


FAULT = '<s:E xmlns:s="http://www.w3.org/2003/05/soap-envelope"><s:Body><s:Fault><s:Reason><s:Text>bad month</s:Text></s:Reason></s:Fault></s:Body></s:E>'


def test_rates(spark, tmp_path, view):
    def responses(*bodies):
        return spark.createDataFrame([(b,) for b in bodies], "body string")

    def load(day, *bodies):
        return rates.load_rates(spark, responses(*bodies), day, view, str(tmp_path))

    assert load(date(2024, 4, 17), body(("USD", 1, 10.5), ("NOK", 100, 95), ("GBP", 1, 13)))
    assert load(date(2024, 4, 20), body(("USD", 1, 11)))
    assert load(date(2024, 5, 1), body(("EUR", 1, 11.4)))
    got = [(r[0], r[1], float(r[2])) for r in spark.table(view).orderBy("exchange_month", "currency_code").collect()]
    assert got == [(date(2024, 4, 1), "NOK", 0.95), (date(2024, 4, 1), "USD", 11.0), (date(2024, 5, 1), "EUR", 11.4)]
    assert not load(date(2024, 6, 1), body(("GBP", 1, 1)))
    with pytest.raises(Exception, match="failed to fetch rates: bad month"):
        load(date(2024, 6, 1), FAULT)
    assert spark.table(view).count() == 3
    assert rows(response_faults(responses(FAULT, body()))) == [("bad month",)]


def page(day, title="Euribor 3 months", value="0.061 %", cell="th"):
    return f"""<html><table class="table table-striped"><thead><tr><th></th><th> {day} </th></tr></thead>
    <tr><th><a href="/1">Euribor 1 week</a></th><td>-0.5 %</td></tr><tr><td>Euribor 1 month</td><td>-0.3 %</td></tr>
    <tr><{cell}><a href="/3">{title}</a></{cell}><td>{value}</td></tr></table></html>"""


def test_index_pages(spark):
    texts = [
        page("7/12/2022"),
        page("7/12/2022", title="Renamed"),
        page("7/12/2022", value="n/a"),
        # the text of a linked cell counts twice, so the second text is no number
        page("7/12/2022", cell="td"),
        page("7/16/2022"),
        page("7/11/2022"),
        "<p>none</p>",
        page("x"),
    ]
    pages = spark.createDataFrame([(t,) for t in texts], "html string")
    assert [json.loads(r["value"]) for r in rates.index_messages(pages, date(2022, 7, 12)).collect()] == [
        {"dateFrom": "2022-07-12", "countryCode": "FI", "type": "EURIBOR_3M", "value": 0.061}
    ]
    assert rates.index_messages(pages, date(2022, 7, 13)).count() == 0
    assert [str(r["day"]) for r in index_values(pages).orderBy("day").collect()] == ["2022-07-11", "2022-07-12"]
    assert index_values(pages).select(index_message(F.col("day"), F.col("value"), "T", "SE")).count() == 2


def subjects(spark):
    n = 400
    # one customer has a third of all rows
    ids = [7 if i % 3 == 0 else i % 20 for i in range(n)]
    sendouts = spark.createDataFrame(
        [(c, None if i % 50 == 0 else datetime(2024, 1, 1 + (i * 7) % 28, i % 24), "sent", "mail", 'a "b", c', f'{{"n": {i}}}') for i, c in enumerate(ids)],
        "customer_id int, scheduled_at timestamp, status string, type string, recipient string, content string",
    ).repartition(5)
    return sendouts, ids


def test_report_files(spark, tmp_path):
    sendouts, ids = subjects(spark)
    requests = spark.createDataFrame([(7,), (3,), (999,)], "customer_id int")
    name = "communications"
    section = subject_report.SECTIONS[name]
    subject_report.write_report({"sendouts": sendouts}, requests, str(tmp_path), {name: section})
    folders = sorted(p.split("/")[-1] for p in glob.glob(f"{tmp_path}/{name}/_customer=*"))
    assert folders == ["_customer=3", "_customer=7", "_customer=999"]
    (alone,) = glob.glob(f"{tmp_path}/{name}/_customer=999/*.txt")
    assert open(alone, encoding="utf-8").read() == "scheduled_at,status,type,recipient,content\n"
    parts = sorted(glob.glob(f"{tmp_path}/{name}/_customer=7/*.csv"))
    times = []
    for part in parts:
        lines = open(part, encoding="utf-8").read().splitlines()
        assert lines[0] == "scheduled_at,status,type,recipient,content"
        assert all('"a ""b"", c"' in line for line in lines[1:])
        times += [line.split(",")[0] for line in lines[1:]]
    assert len(times) == ids.count(7)
    assert times == sorted(times, key=lambda t: (t == "", t))


def test_every_section_has_its_header(spark):
    from workload import reports

    built = {
        "contact_details": reports.subject_contacts,
        "application_details": reports.subject_applications,
        "general_customer_details": reports.subject_general,
        "autogiro": reports.subject_autogiro,
        "signatures": reports.subject_signatures,
        "external_lookup_listings": reports.subject_lookups,
        "internal_notes": reports.subject_notes,
        "bank_accounts": reports.subject_accounts,
        "bank_transactions": reports.subject_transactions,
        "communications": reports.subject_communications,
    }
    assert built.keys() == subject_report.SECTIONS.keys()
    for name, query in built.items():
        found = query(spark, "/root/testdata/sf0.001").columns
        assert set(subject_report.SECTIONS[name].header) | {"customer_id"} == set(found)


def test_exported_changes(spark, tmp_path, view):
    def export(n, data):
        table = spark.createDataFrame(data, "id int, v string")
        exports.export_changes(spark, table, ["id"], view, str(tmp_path / "t"), str(tmp_path / f"out{n}"))
        return rows(spark.read.schema("change string, id int, v string").json(str(tmp_path / f"out{n}")))

    assert export(1, [(1, "a"), (2, None)]) == [("insert", 1, "a"), ("insert", 2, None)]
    assert export(2, [(1, "a"), (2, "b"), (3, "c")]) == [("insert", 3, "c"), ("update", 2, "b")]
    assert export(3, [(2, "b"), (3, "c")]) == [("delete", 1, "a")]
    assert rows(spark.table(view)) == [(2, "b"), (3, "c")]


def test_metadata_jobs(spark, tmp_path, view):
    specs = parse_specs({"t": {"schema": {"id": "integer", "gone": "text"}}}).values()
    catalog = spark.createDataFrame([("t", "id", "integer")], "table_name string, column_name string, data_type string")
    assert metadata.write_table_info(spark, specs, catalog, str(tmp_path / "info")).count() == 1
    info = spark.read.json(str(tmp_path / "info")).first()
    assert (info["table_name"], info["drifted_columns"], info["extract"]) == ("t", "gone", False)

    (tmp_path / "tests.json").write_text('{"tables": [{"name": "core.a", "covered": 1, "total": 2}]}')
    (tmp_path / "fresh.json").write_text(
        '{"results": [{"unique_id": "s.p.d.m", "status": "pass", "max_loaded_at": "x", "max_loaded_at_time_ago_in_s": 1, "criteria": {"filter": null}}]}'
    )
    day = date(2024, 1, 2)
    metadata.write_coverage(spark, str(tmp_path / "tests.json"), str(tmp_path / "tests.json"), day, str(tmp_path / "cov"))
    assert spark.read.option("header", True).csv(str(tmp_path / "cov")).count() == 2
    metadata.write_freshness(spark, str(tmp_path / "fresh.json"), day, str(tmp_path / "fresh"))
    schema = T.StructType([T.StructField(c, T.DateType() if c == "execution_date" else T.StringType()) for c in
                           "execution_date dataset_name model_name status max_timestamp_in_table max_timestamp_time_ago_in_s filter_condition".split()])
    table = str(tmp_path / "table")
    spark.createDataFrame([], schema).withColumn("_day", F.col("execution_date")).write.parquet(table)
    for _ in range(2):
        metadata.load_report_day(spark, str(tmp_path / "fresh"), schema, table, "execution_date", day)
    loaded = spark.read.schema(schema.add("_day", "date")).parquet(table)
    assert [r["model_name"] for r in loaded.collect()] == ["m"]

    log = spark.createDataFrame([("w", "CREATED", 1)], "w string, action string, at int")
    metadata.rebuild_lifecycle(spark, log, ["w"], "action", "at", str(tmp_path / "life"), view)
    assert rows(spark.table(view)) == [("w", 1, None)]

    tasks = spark.createDataFrame(
        [tuple({"task_id": "a", "dag_id": "d", "start_date": datetime(2024, 1, 2, 5), "duration": 99_999.0}.get(c) for c in TASK_COLUMNS)],
        ", ".join(f"{c} {'timestamp' if c.endswith('_date') else 'double' if c == 'duration' else 'string'}" for c in TASK_COLUMNS),
    )
    metadata.load_task_metadata(spark, tasks, "watch", str(tmp_path / "runs"), view + "_runs")
    assert spark.table(view + "_runs").first()["task_id"] == "a"
    metadata.check_long_tasks(tasks, date(2024, 1, 9), "watch")
    with pytest.raises(CheckFailed):
        metadata.check_long_tasks(tasks, day, "watch")

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakeferry.functions.html import first_table, table_cells
from lakeferry.functions.json_documents import POLICY_FIELDS, JsonField, lenient_timestamp, project_json
from lakeferry.functions.normalize import (
    array_from_text,
    cast_timestamps,
    export_text,
    normalize_rows,
    project,
    with_ingested_ts,
)
from lakeferry.functions.text import country_prefix, leading_word, local_day, name_part
from lakeferry.functions.xml import base64_text, fault_text, signed_text
from lakeferry.spec import TableSpec


@pytest.mark.parametrize(
    "text, items",
    [
        ("{}", []),
        ("{a,b}", ["a", "b"]),
        ('{"b,c", d ,NULL}', ["b,c", "d", None]),
        ('{"NULL","say \\"hi\\"",""}', ["NULL", 'say "hi"', ""]),
        ("{,a}", ["", "a"]),
        (None, None),
    ],
)
def test_array_text(spark, text, items):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(array_from_text(F.col("t"))).first()[0] == items


def test_normalized_row(spark):
    spec = TableSpec.from_contract(
        "t",
        {
            "schema": {
                "id": "integer", '"order"': "text", "at": "timestamp with time zone", "doc": "jsonb", "objs": "jsonb",
                "nums": "ARRAY", "txt": "ARRAY", "raw": "text", "amount": "numeric",
            }
        },
    )
    df = spark.sql(
        """select 3000000000 as id, date'2024-02-03' as `order`, timestamp'2024-02-03 15:04:05.5' as at,
        named_struct('a', 1, 'b', 'x') as doc, array(map('k', 1), map('k', 2)) as objs, array(1, null) as nums,
        '{x,"y,z"}' as txt, encode('å', 'UTF-8') as raw, 1.25 as amount, 'extra' as extra"""
    )
    row = normalize_rows(df, spec).first()
    assert row["id"] == 3_000_000_000 and row["order"] == "2024-02-03"
    assert row["at"] == datetime(2024, 2, 3, 15, 4, 5, 500000)
    assert row["doc"] == '{"a":1,"b":"x"}' and row["objs"] == '[{"k":1},{"k":2}]'
    assert row["nums"] == ["1", None] and row["txt"] == ["x", "y,z"] and row["raw"] == "å"
    assert normalize_rows(df, spec, joined_lists=True).first()["objs"] == '{"k":1}, {"k":2}'
    assert project(df, spec).columns == spec.column_names
    stamped = with_ingested_ts(df, "2024-01-01 00:00:00").first()["_ingested_ts"]
    assert stamped == datetime(2024, 1, 1)
    assert dict(cast_timestamps(df.select(F.lit("2024-02-03").alias("at")), spec).dtypes) == {"at": "timestamp"}


def test_export_text_uses_a_24_hour_clock(spark):
    df = spark.sql("select timestamp'2024-02-03 15:04:05' as z, timestamp_ntz'2024-02-03 15:04:05' as t, date'2024-02-03' as d, cast(null as date) as n, 1 as i")
    assert tuple(export_text(df).first()) == (
        "2024-02-03 15:04:05.000000Z", "2024-02-03 15:04:05.000000", "2024-02-03", None, 1,
    )


def test_json_projection(spark):
    docs = [
        '{"a":{"b":"x","l":[{"c":1},5]},"A":7,"z":{"q":1.50}}',
        '{"a":"str","z":[1]}',
        "[1]",
        '{"a":{"b":{"n":1},"l":3}}',
        '{"a":{"b":"{x"}}',
        '{"a":{"b":null}}',
        "{broken",
        None,
    ]
    fields = [
        JsonField("b", ("$.a.b",), "text"),
        JsonField("c", ("$.a.l[0].c",), "integer"),
        JsonField("doc", ("$.a.b",)),
        JsonField("upper", ("$.A",), "integer"),
        JsonField("z", ("$.z",)),
        JsonField("first", ("$.a.l[0].zz", "$.A"), "text"),
    ]
    df = spark.createDataFrame([(d,) for d in docs], "j string").coalesce(1)
    got = [tuple(r)[1:] for r in project_json(df, "j", fields).collect()]
    empty = (None,) * 6
    assert got == [
        ("x", 1, '"x"', 7, '{"q":1.5}', "7"),
        (None, None, None, None, "[1]", None),
        empty,
        (None, None, '{"n":1}', None, None, None),
        ("{x", None, '"{x"', None, None, None),
        empty,
        empty,
        empty,
    ]


def test_json_casts_and_rejects(spark):
    doc = '{"n":"12.5","bad":"12 kr","flag":"TRUE","one":1,"list":["a",1,null],"nested":["a",{"b":1}],"big":12345678901234567890}'
    fields = [
        JsonField("n", ("$.n",), "numeric"),
        JsonField("bad", ("$.bad",), "numeric"),
        JsonField("flag", ("$.flag",), "boolean"),
        JsonField("one", ("$.one",), "boolean"),
        JsonField("list", ("$.list",), "texts"),
        JsonField("nested", ("$.nested",), "texts"),
        JsonField("big", ("$.big",), "integer"),
        JsonField("gone", ("$.gone",), "integer"),
    ]
    row = project_json(spark.createDataFrame([(doc,)], "j string"), "j", fields, rejects="rejects").first()
    assert float(row["n"]) == 12.5 and row["bad"] is None and row["flag"] is True and row["one"] is None
    assert row["list"] == ["a", "1", None] and row["nested"] is None
    assert sorted(row["rejects"]) == ["bad", "big", "one"]


def test_policy_has_all_columns(spark):
    doc = '{"data":{"Rdm":{"x":1},"Request":1,"request":{"loanBalance":"5"},"Limit":{"suggested_limit":9,"customer_type":"new"},"SCLookup":{"_id":"k"}},"response":{"scorecard_version":3}}'
    row = project_json(spark.createDataFrame([(1, doc)], "id int, main_policy string"), "main_policy", POLICY_FIELDS).first()
    assert len(POLICY_FIELDS) == 55 and len(row) == 57
    assert row["rdm"] == '{"x":1}' and row["request_schema"] == "1" and row["request"] == '{"loanBalance":"5"}'
    assert int(row["loan_balance"]) == 5 and row["suggested_limit"] == "9" and row["customer_type"] == "new"
    assert row["schufa_lookup_id"] == '"k"' and row["scorecard_version"] == "3" and row["kalp"] is None


@pytest.mark.parametrize(
    "text, want",
    [
        ("2024-03-05T10:11:12.5Z", datetime(2024, 3, 5, 10, 11, 12, 500000)),
        ("2024-03-05 10:11:12+02:00", datetime(2024, 3, 5, 8, 11, 12)),
        ("2024-03-05 10:11:12", datetime(2024, 3, 5, 10, 11, 12)),
        ("2024-03-05", datetime(2024, 3, 5)),
        ("Tue, 05 Mar 2024 10:11:12 GMT", datetime(2024, 3, 5, 10, 11, 12)),
        ("2024", None),
        ("yesterday", None),
        ("2024-13-45 10:11:12", None),
        (None, None),
    ],
)
def test_lenient_timestamp(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(lenient_timestamp(F.col("t"))).first()[0] == want


SIGNATURE = (
    '<a:Signature xmlns:a="http://www.w3.org/2000/09/xmldsig#"><a:Object><b:bankIdSignedData xmlns:b="urn:t">'
    "<b:usrVisibleData>{}</b:usrVisibleData></b:bankIdSignedData></a:Object></a:Signature>"
)


def test_signature(spark):
    import base64

    def b64(text):
        return base64.b64encode(text.encode()).decode()

    texts = [b64(SIGNATURE.format(b64("Jag godkänner €"))), b64("<Signature><Object/></Signature>"), "no base64!", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string").coalesce(1)
    assert [r[0] for r in df.select(signed_text(F.col("s"))).collect()] == ["Jag godkänner €", None, None, None]
    assert df.select(base64_text(F.lit("aGVq"))).first()[0] == "hej"


def test_fault(spark):
    bodies = [
        "<E><Body><s:Fault xmlns:s='urn:x'><s:Reason><s:Text>down</s:Text></s:Reason></s:Fault></Body></E>",
        "<E><Fault/></E>",
        "<E><series>Fault</series></E>",
    ]
    df = spark.createDataFrame([(b,) for b in bodies], "b string").coalesce(1)
    assert [r[0] for r in df.select(fault_text(F.col("b"))).collect()] == ["down", "unknown fault", None]


def test_html_table(spark):
    html = """<table><tr><td>other</td></tr></table>
    <TABLE class="table table-striped" id="x"><tr><th></th><th> 7/12/2022 </th></tr>
    <tr><td><a href="#">1&nbsp;week</a></td><td>a &amp;lt; b</td><td>  </td></tr></TABLE>"""
    df = spark.createDataFrame([(html,), ("<p>none</p>",)], "h string").coalesce(1)
    got = [r[0] for r in df.select(table_cells(first_table(F.col("h"), "table table-striped"))).collect()]
    assert got == [[["7/12/2022"], ["1 week", "1 week", "a &lt; b"]], None]


def test_text_helpers(spark):
    row = spark.range(1).select(
        name_part(F.lit("a.b.c"), 1), name_part(F.lit("a.b.c"), -1), name_part(F.lit("a"), 3),
        leading_word(F.lit("se_brand_x")), leading_word(F.lit("plain")),
        country_prefix(F.lit("fi_x"), ["SE", "FI"], "SE"), country_prefix(F.lit("xx_x"), ["SE", "FI"], "SE"),
    ).first()
    assert tuple(row) == ("b", "c", None, "SE", "PLAIN", "FI", "SE")


@pytest.mark.parametrize(
    "instant, day",
    [
        ("2022-03-26 22:59:59", date(2022, 3, 26)),
        ("2022-03-26 23:00:00", date(2022, 3, 27)),
        ("2022-03-27 22:00:00", date(2022, 3, 28)),
        ("2022-10-29 22:00:00", date(2022, 10, 30)),
        ("2022-10-30 22:30:00", date(2022, 10, 30)),
        ("2022-10-30 23:00:00", date(2022, 10, 31)),
    ],
)
def test_local_day_on_clock_changes(spark, instant, day):
    assert spark.range(1).select(local_day(F.lit(instant).cast("timestamp"), "Europe/Stockholm")).first()[0] == day

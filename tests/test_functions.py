"""Column functions, JSON rows and user-defined functions."""

import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions import json_rows, times, udaf, udx
from rivulet.functions.vector import euclidean
from rivulet.sources.files import login_events


def one(spark, *columns, **values):
    names = list(values)
    df = spark.createDataFrame([tuple(values[n] for n in names)], ", ".join(f"{n} string" for n in names)) if names else spark.range(1)
    row = df.select(*columns).first()
    return row[0] if len(columns) == 1 else tuple(row)


def test_local_dates(spark):
    ms = F.lit(1576631741795).cast("bigint")
    assert one(spark, times.local_date_text(ms), times.local_time_text(ms)) == ("2019-12-18", "2019-12-18 09:15:41")
    assert one(spark, times.second_of_millis(ms).cast("string")) == "2019-12-18 01:15:41"


def test_minutes_truncate(spark):
    at = F.lit("2019-01-11 13:05:00").cast("timestamp")
    assert one(spark, times.minutes_between(at, F.lit("2019-01-11 13:25:59").cast("timestamp"))) == 20


@pytest.mark.parametrize(
    "text, ok",
    [
        ("2020-01-02T03:04:05Z", True),
        ("2020-01-02T03:04:05.123456789Z", True),
        ("2020-01-02T03:04:05", False),
        ("2020-01-02T03:04:05+01:00", False),
        ("2020-01-02 03:04:05Z", False),
        ("2020-13-02T03:04:05Z", False),
    ],
)
def test_strict_timestamps(spark, text, ok):
    assert (one(spark, times.rfc3339_timestamp(F.col("t")), t=text) is not None) is ok


@pytest.mark.parametrize(
    "text, value",
    [("03:04:05Z", "03:04:05"), ("03:04:05.000Z", "03:04:05"), ("03:04:05.1Z", None), ("24:00:00Z", None), ("03:04:05", None)],
)
def test_strict_times(spark, text, value):
    assert one(spark, json_rows.time_of_day(F.col("t")), t=text) == value


def test_login_lines_are_trimmed_and_typed(spark, rows):
    lines = spark.createDataFrame([("5402,83.1.2.3, success ,1558430815",), ("bad",)], "value string")
    assert rows(login_events(lines)) == [(5402, "83.1.2.3", "success", 1558430815), (None, None, None, None)]


PERSON = T.StructType([T.StructField("name", T.StringType()), T.StructField("age", T.IntegerType())])


def test_strict_rows(spark, rows):
    good = spark.createDataFrame([('{"name":"a","age":null}',)], "m string")
    assert rows(json_rows.strict_rows(good, "m", PERSON)) == [("a", None)]
    missing = spark.createDataFrame([('{"name":"a"}',)], "m string")
    assert rows(json_rows.strict_rows(missing, "m", PERSON, fail_on_missing=False)) == [("a", None)]
    with pytest.raises(Exception, match="missing field: age"):
        json_rows.strict_rows(missing, "m", PERSON).collect()
    with pytest.raises(Exception):
        json_rows.strict_rows(spark.createDataFrame([('{"name":',)], "m string"), "m", PERSON, False).collect()


def test_tolerant_rows_never_fail(spark, rows):
    messages = [
        '{"name":"a","age":1}', '{"name":"b","age":"x"}', '{"name":"c","age":null}', '{"name":"d"}', '{"name":', "", None,
        '{"name":"e","age":" 7.9 "}',
    ]
    df = spark.createDataFrame([(m,) for m in messages], "m string")
    strict = {r.m: (r.name, r.age, r.is_dead) for r in json_rows.tolerant_rows(df, "m", PERSON).collect()}
    assert strict['{"name":"a","age":1}'] == ("a", 1, False)
    assert strict['{"name":"b","age":"x"}'] == ("b", None, False)
    assert strict['{"name":"d"}'] == ("d", None, False)
    assert strict['{"name":'] == (None, None, True)
    lenient = json_rows.tolerant_rows(df, "m", PERSON, lenient=True)
    values = {r.m: r.age for r in lenient.collect()}
    assert values['{"name":"b","age":"x"}'] == 0 and values['{"name":"c","age":null}'] is None
    assert values['{"name":"e","age":" 7.9 "}'] == 7
    required = json_rows.tolerant_rows(df, "m", PERSON, fail_on_missing=True)
    assert {r.m: r.is_dead for r in required.collect()}['{"name":"d"}'] is True
    good, dead = json_rows.good_and_dead(json_rows.tolerant_rows(df, "m", PERSON), "m")
    assert good.columns == ["name", "age"] and good.count() + dead.count() == len(messages)
    assert '{"name":' in {r.m for r in dead.collect()}


def test_tolerant_types(spark):
    schema = T.StructType.fromDDL(
        "f float, s smallint, b tinyint, d decimal(10,2), day date, at timestamp, raw binary, ok boolean, "
        "tags array<string>, props map<string,int>, sub struct<x:int>"
    )
    message = {
        "f": " 1.5 ", "s": "7", "b": 3, "d": 1.25, "day": "2020-01-02", "at": "2020-01-02T03:04:05.5Z", "raw": "YWI=",
        "ok": "true", "tags": ["a"], "props": {"k": 1}, "sub": {"x": 4},
    }
    df = spark.createDataFrame([(json.dumps(message),), (json.dumps({**message, "b": "400"}),)], "m string")
    good, dead = json_rows.good_and_dead(json_rows.tolerant_rows(df, "m", schema), "m")
    row = good.first()
    assert (row.f, row.s, row.b, float(row.d), row.day) == (1.5, 7, 3, 1.25, datetime.date(2020, 1, 2))
    assert row.at == datetime.datetime(2020, 1, 2, 3, 4, 5, 500000)
    assert (bytes(row.raw), row.ok, row.tags, row.props, row["sub"].x) == (b"ab", True, ["a"], {"k": 1}, 4)
    assert dead.count() == 1


def test_json_schema_becomes_row_type():
    text = json.dumps(
        {
            "type": "object",
            "properties": {
                "lon": {"type": "number"},
                "rideTime": {"type": "string", "format": "date-time"},
                "note": {"type": ["string", "null"]},
                "tags": {"type": "array", "items": {"type": "integer"}},
                "sub": {"type": "object", "properties": {"ok": {"type": "boolean"}}},
                "raw": {"type": "string", "contentEncoding": "base64"},
            },
        }
    )
    got = json_rows.schema_from_json_schema(text).simpleString()
    assert got == (
        "struct<lon:decimal(38,18),rideTime:timestamp,note:string,tags:array<decimal(38,0)>,"
        "sub:struct<ok:boolean>,raw:binary>"
    )
    with pytest.raises(ValueError):
        json_rows.schema_from_json_schema('{"type":"array","items":{"type":"string"}}')


def test_json_fields_pairs_and_append(spark, rows):
    message = '{"param_data":{"platform_s":"ADR","category_s":"event_role","dt":"2020-04-26"}}'
    paths = ["$.param_data.platform_s", "$.param_data.category_s", "$.param_data.app_version_code_s"]
    assert one(spark, json_rows.joined_fields(F.col("m"), paths), m=message) == "ADR,event_role,null"
    docs = spark.createDataFrame(
        [('[{"x":"1","y":"d"},{"x":"2","y":"d"}]',), ("[]",), ('[{"x":"3","y":"d"},{"x":"4","y":"d"}]',)], "arr string"
    )
    pairs = docs.select(F.inline(json_rows.object_pairs(F.col("arr"))))
    assert rows(pairs) == [("1", "d"), ("2", "d"), ("3", "d"), ("4", "d")]
    objects = F.from_json(F.col("a"), "array<struct<id:string>>")
    extra = F.struct(F.lit("3").alias("id"))

    def wanted(ident):
        return lambda element: element["id"] == ident

    grown = [F.to_json(json_rows.append_if(objects, wanted(i), extra)) for i in ("1", "9")]
    assert one(spark, *grown, a='[{"id":"1"},{"id":"2"}]') == (
        '[{"id":"1"},{"id":"2"},{"id":"3"}]', '[{"id":"1"},{"id":"2"}]',
    )


def test_envelope_leaves_nulls_out(spark):
    record = spark.createDataFrame(
        [("t", 1, 2, 3, None, "v")], "topic string, partition int, offset bigint, timestamp bigint, key string, value string"
    )
    assert record.select(json_rows.envelope()).first()[0] == '{"topic":"t","partition":1,"offset":2,"timestamp":3,"value":"v"}'
    assert "timestamp" not in record.select(json_rows.envelope(False)).first()[0]


def test_distance(spark):
    df = spark.createDataFrame([([0.0, 3.0], [4.0, 0.0])], "a array<float>, b array<float>")
    assert df.select(euclidean(F.col("a"), F.col("b"))).first()[0] == 5.0
    with pytest.raises(Exception, match="differ in length"):
        df.select(euclidean(F.col("a"), F.array(F.lit(1.0)))).collect()


def test_udx_give_the_rows_of_the_built_ins(spark, rows):
    udx.register(spark)
    people = spark.createDataFrame(
        [('{"name":"Alice","age":13,"grade":"A"}',), ('{"name":"Jack","age":14,"grade":"B"}',)], "message string"
    )
    people.createOrReplaceTempView("people")
    final = spark.sql(
        """
        SELECT name, listagg(attr, ',') WITHIN GROUP (ORDER BY pos) AS attrs FROM (
          SELECT p.name, a.attr, row_number() OVER (PARTITION BY p.name ORDER BY find_in_set(a.attr, concat_ws(',', p.name, p.age, p.grade))) AS pos
          FROM people LEFT JOIN LATERAL person_columns(message) p ON TRUE
          LEFT JOIN LATERAL comma_rows(concat_ws(',', p.name, CAST(p.age AS STRING), p.grade)) a ON TRUE)
        GROUP BY name
        """
    )
    assert rows(final) == [("Alice", "Alice,13,A"), ("Jack", "Jack,14,B")]
    kept = spark.sql("SELECT p.name FROM (SELECT 'bad' AS m) LEFT JOIN LATERAL person_columns(m) p ON TRUE")
    assert rows(kept) == [(None,)]
    numbers = spark.sql("SELECT floored_max(v) FROM VALUES (-3L), (-1L) AS t(v)")
    assert numbers.first()[0] == 0
    assert spark.sql("SELECT upper_text('ab')").first()[0] == "AB"
    record = spark.sql("""SELECT e.* FROM (SELECT '{"topic":"t","value":"p","offset":4}' AS m), LATERAL envelope_columns(m) e""")
    assert rows(record) == [("t", "p", 4)]


def test_user_aggregate_in_two_steps(spark, rows):
    df = spark.range(500).select((F.col("id") % 3).alias("k"), F.when(F.col("id") % 3 == 0, -5).otherwise(F.col("id")).alias("v"), "id")
    got = udx.merged(df, ["k"], "v", udx.floored_max, "top", parts=8)
    assert rows(got) == [(0, 0), (1, 499), (2, 497)]


def test_clock_and_uuid(spark):
    assert spark.range(3).select(F.uuid()).distinct().count() == 3
    assert one(spark, times.now().isNotNull())
    assert one(spark, times.now(F.lit("x"))) == "x"


def test_user_aggregate_merges_its_buffers(spark, rows):
    data = [(None if i % 7 == 0 else i % 3, "k" if i % 2 else None, None if i % 5 == 0 else i * (1 << 40)) for i in range(2000)] + [(9, "only", None)]
    df = spark.createDataFrame(data, "a long, b string, v long").repartition(5)
    got = udaf.aggregate(df, ["a", "b"], "v", udaf.MEAN, "mean")
    assert got.columns == ["a", "b", "mean"]
    groups = {}
    for a, b, v in data:
        groups.setdefault((a, b), []).extend([] if v is None else [v])
    want = [(*k, sum(v) / len(v) if v else None) for k, v in groups.items()]
    assert rows(got) == sorted(want, key=repr)
    assert udaf.aggregate(df.limit(0), ["a"], "v", udaf.MEAN, "mean").count() == 0
    hot = spark.range(50_000).select(F.lit(1).alias("k"), "id")
    assert udaf.aggregate(hot, ["k"], "id", udaf.MEAN, "m").collect() == [(1, 24999.5)]

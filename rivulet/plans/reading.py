"""Projections, functions and parsing on the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions import json_rows, times
from rivulet.functions.text import compose_key, positional
from rivulet.operators.exports import ExportSource, ExportSpec, ExportTarget, event_day, export_rows, index_writer, run_exports
from rivulet.operators.ordered import ordered_lists
from rivulet.plans.registry import query
from rivulet.session import fresh_dir
from rivulet.sinks.keyed import MergedTable
from rivulet.sinks.topics import json_records, routed_records
from rivulet.sources import topics
from rivulet.sources.files import login_events
from rivulet.tables import table


@query(
    "nested_select",
    """
    SELECT o_orderkey AS ref1, o_orderstatus AS before_status, o_totalprice AS price, 'order' AS flag FROM orders
    """,
)
def nested_select(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        F.struct(F.col("o_orderkey").alias("ref"), F.col("o_orderstatus").alias("status")).alias("before"),
        F.struct(F.col("o_orderkey").alias("ref"), F.col("o_totalprice").alias("price")).alias("after"),
    )
    return rows.selectExpr("before.`ref` ref1", "before.status before_status", "after.price", "'order' as flag")


@query(
    "scalar_text",
    """
    SELECT upper(c_name) AS upper_name, concat_ws(',', c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment) AS joined,
           CAST(c_custkey AS VARCHAR) AS custkey_text, CAST(c_nationkey AS BIGINT) AS nation
    FROM customer
    """,
)
def scalar_text(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    return customers.select(
        "c_acctbal",
        F.upper("c_name").alias("upper_name"),
        F.concat_ws(",", "c_name", F.col("c_nationkey").cast("string"), "c_mktsegment").alias("joined"),
        F.col("c_custkey").cast("string").alias("custkey_text"),
        F.col("c_nationkey").cast("bigint").alias("nation"),
    ).drop("c_acctbal")


@query(
    "csv_parse",
    """
    SELECT event_id AS "userId", concat('10.0.0.', user_id) AS ip, event_type AS "eventType",
           CAST(floor(epoch(ts)) AS BIGINT) AS "eventTime" FROM events
    """,
)
def csv_parse(spark: SparkSession, sf: str) -> DataFrame:
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    lines = table(spark, sf, "events").select(
        F.concat_ws(
            " , ", F.col("event_id").cast("string"), F.concat(F.lit("10.0.0."), "user_id"), "event_type", seconds.cast("string")
        ).alias("value")
    )
    return login_events(lines)


@query(
    "positional_fields",
    """
    SELECT p_partkey AS id, split_part(p_name, ' ', 1) AS first,
           CASE WHEN p_name LIKE '% %' THEN split_part(p_name, ' ', 2) END AS second FROM part
    """,
)
def positional_fields(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "part").select(
        F.concat_ws(" ", F.col("p_partkey").cast("string"), "p_name").alias("value")
    )
    fields = [("id", "bigint"), ("first", "string"), ("second", "string")]
    return lines.select(*positional(F.col("value"), fields, " "))


@query(
    "epoch_dates",
    """
    SELECT event_id, epoch_us(ts) // 1000 AS ms, date_trunc('second', ts) AS second,
           strftime(ts + INTERVAL '8 hours', '%Y-%m-%d') AS local_date,
           strftime(ts + INTERVAL '8 hours', '%Y-%m-%d %H:%M:%S') AS local_time,
           strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%H') AS hour,
           date_sub('minute', ts, TIMESTAMP '2024-02-01 00:00:00') AS minutes
    FROM events
    """,
)
def epoch_dates(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    events = table(spark, sf, "events").select("event_id", "ts", times.epoch_millis(F.col("ts")).alias("ms"))
    ms = F.col("ms")
    return events.select(
        "event_id",
        "ms",
        times.second_of_millis(ms).cast("timestamp_ntz").alias("second"),
        times.local_date_text(ms).alias("local_date"),
        times.local_time_text(ms).alias("local_time"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.date_format("ts", "HH").alias("hour"),
        times.minutes_between(F.col("ts"), as_of).alias("minutes"),
    )


def _messages(events: DataFrame) -> DataFrame:
    """Events as JSON messages; those of some types are broken in one way each."""
    kind = F.col("event_type")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zone = F.when(kind == "view", "").otherwise("Z")
    amount = F.when(kind == "signup", "n/a").otherwise(F.col("user_id").cast("string"))
    message = F.concat(
        F.lit('{"id":'), "event_id", F.lit(',"amount":"'), amount, F.lit('","at":"'), stamp, zone, F.lit('"}')
    )
    broken = F.when(kind == "error", F.substr(message, F.lit(1), F.length(message) - 1)).otherwise(message)
    return events.select("event_id", broken.alias("message"))


@query(
    "tolerant_json",
    """
    SELECT event_id, event_type IN ('error', 'view') AS is_dead,
           CASE WHEN event_type NOT IN ('error', 'view') THEN event_id END AS id,
           CASE WHEN event_type = 'signup' THEN 0 WHEN event_type NOT IN ('error', 'view') THEN CAST(user_id AS INTEGER) END AS amount,
           CASE WHEN event_type NOT IN ('error', 'view') THEN ts END AS at
    FROM events
    """,
)
def tolerant_json(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("id", T.LongType()),
            T.StructField("amount", T.IntegerType()),
            T.StructField("at", T.TimestampNTZType()),
        ]
    )
    messages = _messages(table(spark, sf, "events"))
    return json_rows.tolerant_rows(messages, "message", schema, lenient=True).drop("message")


def _records(events: DataFrame) -> DataFrame:
    """Events as topic log records: four partitions per topic, the id as offset."""
    return events.select(
        F.col("event_type").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        times.epoch_millis(F.col("ts")).alias("timestamp"),
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("key"),
        F.col("props").alias("value"),
    )


@query(
    "envelope",
    """
    SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
           epoch_us(ts) // 1000 AS "timestamp", CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS "key",
           props AS "value", event_type <> 'error' AS has_key
    FROM events WHERE NOT (event_type = 'click' AND user_id % 4 = 0 AND event_id < 42)
      AND NOT (event_type = 'click' AND user_id % 4 = 1 AND event_id < 300)
    """,
)
def envelope(spark: SparkSession, sf: str) -> DataFrame:
    start = topics.parse_offsets("partition:0,offset:42;partition:1,offset:300", "click")
    records = topics.from_position(_records(table(spark, sf, "events")), start)
    text = records.select(json_rows.envelope().alias("record"))
    schema = T.StructType.fromDDL("topic string, partition int, offset bigint, timestamp bigint, key string, value string")
    parsed = text.select(F.from_json("record", schema).alias("r"), F.get_json_object("record", "$.key").alias("k"))
    return parsed.select("r.*", F.col("k").isNotNull().alias("has_key"))


@query(
    "strict_json",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
)
def strict_json(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "props")
    return json_rows.strict_rows(events, "props", T.StructType.fromDDL("k int"))


@query(
    "next_positions",
    """
    SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", max(event_id) + 1 AS next_offset
    FROM events GROUP BY ALL
    """,
)
def next_positions(spark: SparkSession, sf: str) -> DataFrame:
    return topics.next_positions(_records(table(spark, sf, "events")))


@query(
    "topic_route",
    """
    SELECT event_type AS topic, CAST(user_id AS VARCHAR) AS "key", concat(event_type, ',', user_id, ',', props) AS "value"
    FROM events
    """,
)
def topic_route(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "events").select(
        F.concat_ws(",", "event_type", F.col("user_id").cast("string"), "props").alias("value")
    )
    return routed_records(lines)


@query(
    "json_rows_out",
    """
    SELECT 'nations' AS topic, concat('{"n_nationkey":', n_nationkey, ',"n_name":"', n_name, '","customers":', count(*), '}') AS "value"
    FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name
    """,
)
def json_rows_out(spark: SparkSession, sf: str) -> DataFrame:
    nations = table(spark, sf, "nation").select("n_nationkey", "n_name")
    counts = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count("*").alias("customers")
    )
    return json_records(nations.join(counts, "n_nationkey"), "nations")


@query(
    "json_fields",
    """
    SELECT event_id, concat(event_type, ',', CASE WHEN event_type = 'error' THEN 'null' ELSE CAST(user_id AS VARCHAR) END, ',null') AS fields
    FROM events
    """,
)
def json_fields(spark: SparkSession, sf: str) -> DataFrame:
    params = F.struct(
        F.col("event_type").alias("platform_s"),
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("category_s"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
    )
    messages = table(spark, sf, "events").select(
        "event_id", F.to_json(F.struct(params.alias("param_data"))).alias("message")
    )
    paths = ["$.param_data.platform_s", "$.param_data.category_s", "$.param_data.app_version_code_s"]
    return messages.select("event_id", json_rows.joined_fields(F.col("message"), paths).alias("fields"))


def _name_objects(extra: Column) -> Column:
    """Tokens of a part's name as JSON objects; promotional parts have none."""
    tokens = F.when(F.col("p_type") == "PROMO", F.array().cast("array<string>")).otherwise(F.split("p_name", " "))
    return F.transform(tokens, lambda t: F.struct(t.alias("x"), extra.alias("y")))


@query(
    "json_array_pairs",
    """
    SELECT p_partkey, unnest(string_split(p_name, ' ')) AS x, p_brand AS y FROM part WHERE p_type <> 'PROMO'
    """,
)
def json_array_pairs(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part")
    text = parts.select("p_partkey", F.to_json(_name_objects(F.col("p_brand"))).alias("arr"))
    return text.select("p_partkey", F.inline(json_rows.object_pairs(F.col("arr"))))


@query(
    "json_append",
    """
    SELECT p_partkey, concat('[', array_to_string(list_transform(
             CASE WHEN list_contains(w, 'red') THEN list_append(w, '3') ELSE w END,
             lambda i: concat('{"id":"', i, '"}')), ','), ']') AS arr
    FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)
    """,
)
def json_append(spark: SparkSession, sf: str) -> DataFrame:
    objects = F.transform(F.split("p_name", " "), lambda t: F.struct(t.alias("id")))
    text = table(spark, sf, "part").select("p_partkey", F.to_json(objects).alias("arr"))
    array = F.from_json("arr", "array<struct<id:string>>")
    grown = json_rows.append_if(array, lambda e: e["id"] == "red", F.struct(F.lit("3").alias("id")))
    return text.select("p_partkey", F.to_json(grown).alias("arr"))


@query(
    "json_build",
    """
    SELECT l_orderkey, part,
           concat('{"grade_id":"', l_orderkey, '","subject_type":[', string_agg(
             concat('{"subject_id":"', l_linenumber, '","type_id":"', l_partkey, '","source":"', l_suppkey, '"}'), ','
             ORDER BY l_linenumber, l_partkey, l_suppkey), ']}') AS doc
    FROM (SELECT *, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) - 1) // 100000
            AS part FROM lineitem)
    GROUP BY l_orderkey, part
    """,
)
def json_build(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    subject = F.struct(
        F.col("l_linenumber").cast("string").alias("subject_id"),
        F.col("l_partkey").cast("string").alias("type_id"),
        F.col("l_suppkey").cast("string").alias("source"),
    )
    lists = ordered_lists(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], subject, "subject_type")
    doc = F.to_json(F.struct(F.col("l_orderkey").cast("string").alias("grade_id"), "subject_type"))
    return lists.select("l_orderkey", "part", doc.alias("doc"))


@query(
    "json_columns_udtf",
    """SELECT event_type AS topic, props AS payload, event_id AS "offset" FROM events""",
)
def json_columns_udtf(spark: SparkSession, sf: str) -> DataFrame:
    records = _records(table(spark, sf, "events")).select(json_rows.envelope().alias("record"))
    return records.select(
        F.inline(F.array(F.from_json("record", "topic string, value string, offset bigint")))
    ).withColumnRenamed("value", "payload")


EXPORTS = (
    ExportSpec(
        ExportSource("orders", {"o_orderstatus": "F"}, ("o_orderkey", "o_custkey"), lambda: F.col("o_totalprice") > 100000),
        ExportTarget("index_orders", "id", {}, {"o_orderkey": "id", "o_custkey": "owner"}),
    ),
    ExportSpec(
        ExportSource("customer", {"c_mktsegment": "BUILDING"}, ("c_custkey", "c_nationkey")),
        ExportTarget("index_customer", "id", {}, {"c_custkey": "id", "c_nationkey": "owner"}),
    ),
)


@query(
    "export_job",
    """
    SELECT 'index_orders' AS target, o_orderkey AS id, o_custkey AS owner FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice > 100000
    UNION ALL SELECT 'index_customer', c_custkey, CAST(c_nationkey AS BIGINT) FROM customer WHERE c_mktsegment = 'BUILDING'
    """,
)
def export_job(spark: SparkSession, sf: str) -> DataFrame:
    first, second = (
        export_rows(spec, lambda name: table(spark, sf, name)).select(
            F.lit(spec.target.index).alias("target"), "id", F.col("owner").cast("bigint").alias("owner")
        )
        for spec in EXPORTS
    )
    return first.union(second)


#: members of a registry: documents with a delete configuration, more fields of them, one app's day, and a plain entry
REGISTRY = (
    ExportSpec(
        ExportSource("orders", {}, ("o_orderkey", "o_orderstatus", "o_totalprice"), lambda: F.col("o_totalprice") > 100000),
        ExportTarget("index_orders", "id", {"o_orderstatus": "F"}, {"o_orderkey": "id", "o_orderstatus": "label", "o_totalprice": "amount"}),
    ),
    "a plain entry",
    ExportSpec(
        ExportSource("orders", {}, ("o_orderkey", "o_orderpriority"), lambda: (F.col("o_totalprice") > 200000) & (F.col("o_orderstatus") != "F")),
        ExportTarget("index_orders", "id", {}, {"o_orderkey": "id", "o_orderpriority": "label"}, partial=True),
    ),
    ExportSpec(
        ExportSource("app_events", {}, ("event_id", "event", "value"), lambda: event_day("app1", "2024-01-05", "click")),
        ExportTarget("index_events", "id", {}, {"event_id": "id", "event": "label", "value": "amount"}),
    ),
)


@query(
    "export_registry",
    """
    SELECT 'index_orders' AS target, o_orderkey AS id,
           CASE WHEN o_totalprice > 200000 THEN o_orderpriority ELSE o_orderstatus END AS label, CAST(o_totalprice AS DOUBLE) AS amount
    FROM orders WHERE o_totalprice > 100000 AND o_orderstatus <> 'F'
    UNION ALL
    SELECT 'index_events', event_id, event_type, CAST(value AS DOUBLE) FROM events
    WHERE user_id % 3 = 1 AND strftime(ts, '%Y-%m-%d') = '2024-01-05' AND event_type = 'click'
    """,
)
def export_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Every spec of the registry in turn: a full export with deletes, a partial update, a day's events."""

    def load(name: str) -> DataFrame:
        if name != "app_events":
            return table(spark, sf, name)
        app = F.concat(F.lit("app"), F.col("user_id") % 3).alias("app")
        return table(spark, sf, "events").select("event_id", "value", app, F.date_format("ts", "yyyy-MM-dd").alias("dt"), F.col("event_type").alias("event"))

    document = T.StructType.fromDDL("id bigint, label string, amount double")
    root = fresh_dir(spark, "exports")
    indexes = {name: MergedTable(spark, f"{root}/{name}", document, ["id"]) for name in ("index_orders", "index_events")}
    run_exports(REGISTRY, load, index_writer(indexes))
    first, second = (indexes[name].rows().select(F.lit(name).alias("target"), "id", "label", "amount") for name in indexes)
    return first.union(second)


@query(
    "composed_key",
    "SELECT c_custkey, concat('userInfo:userId:', c_custkey, ':userName') AS k FROM customer",
)
def composed_key(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", compose_key("userInfo", "userId", F.col("c_custkey"), "userName").alias("k")
    )

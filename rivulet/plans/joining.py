"""Lookups, point-in-time and lateral joins on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.operators import aggregates as agg
from rivulet.operators import joins
from rivulet.plans.registry import query
from rivulet.sinks.keyed import put_cells
from rivulet.sources.tables import point_get
from rivulet.tables import table

# The five event types, in the order of the catalogue.
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")


def _asking(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Events whose user is looked up under seven times the id, so that some lookups miss."""
    return table(spark, sf, "events").select("event_id", (F.col("user_id") * 7).alias("user_id"), *columns)


_ASKING_SQL = "(SELECT event_id, user_id * 7 AS user_id, event_type FROM events)"


@query(
    "lookup_inner",
    f"SELECT event_id, user_id, c_name, c_acctbal FROM {_ASKING_SQL} JOIN customer ON user_id = c_custkey",
)
def lookup_inner(spark: SparkSession, sf: str) -> DataFrame:
    return joins.lookup_join(_asking(spark, sf), _customers(spark, sf), "user_id", "c_custkey")


@query(
    "lookup_left",
    f"SELECT event_id, user_id, c_name, c_acctbal FROM {_ASKING_SQL} LEFT JOIN customer ON user_id = c_custkey",
)
def lookup_left(spark: SparkSession, sf: str) -> DataFrame:
    return joins.lookup_join(_asking(spark, sf), _customers(spark, sf), "user_id", "c_custkey", "left")


LOOKUP_GROUP_SQL = f"""
    SELECT user_id, part, string_agg(label, ',' ORDER BY seq) AS items FROM (
      SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY seq, label) - 1) // 100000 AS part FROM (
        SELECT user_id, concat_ws(':', event_type, c_name) AS label, min(event_id) AS seq FROM {_ASKING_SQL}
        LEFT JOIN customer ON user_id = c_custkey GROUP BY 1, 2))
    GROUP BY user_id, part
    """


def labelled(asking: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """First event of each user and label. A user's rows shrink to the first of each kind before the lookup, which then cannot be skewed."""
    first = asking.groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))
    enriched = joins.lookup_join(first, _customers(spark, sf), "user_id", "c_custkey", "left")
    return enriched.select("user_id", F.concat_ws(":", "event_type", "c_name").alias("label"), "event_id")


@query("lookup_group", LOOKUP_GROUP_SQL)
def lookup_group(spark: SparkSession, sf: str) -> DataFrame:
    return agg.distinct_list(labelled(_asking(spark, sf, "event_type"), spark, sf), ["user_id"], "label", "event_id")


@query(
    "lookup_composed",
    f"""
    SELECT event_id, concat('userInfo:userId:', user_id, ':userName') AS key,
           CASE WHEN c_custkey IS NOT NULL THEN concat(c_mktsegment, c_name) END AS value
    FROM {_ASKING_SQL} LEFT JOIN customer ON user_id = c_custkey
    """,
)
def lookup_composed(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    keyed = customers.withColumn("rowkey", joins.compose_key("userInfo", "userId", F.col("c_custkey"), "userName"))
    cells = put_cells(keyed, "rowkey", "info", ["c_name", "c_mktsegment"], F.lit(0).cast("bigint"))
    entries = joins.concat_cells(cells)
    found = joins.composed_lookup(_asking(spark, sf), "user_id", entries, "userInfo", "userId", "userName")
    return found.select("event_id", "key", "value")


@query(
    "asof_rate",
    """
    SELECT c.event_id, c.user_id, c.ts, p.value AS rate
    FROM (SELECT * FROM events WHERE event_type = 'click') c
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
      ON c.user_id = p.user_id AND c.ts >= p.ts
    """,
)
def asof_rate(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    clicks = events.where("event_type = 'click'").select("event_id", "user_id", "ts")
    rates = events.where("event_type = 'purchase'").select(
        "user_id", "ts", F.col("value").alias("rate"), "event_id"
    )
    return joins.as_of_join(clicks, rates, "user_id", "ts", "rate", ["event_id"], tie="event_id")


@query(
    "lateral_json",
    """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k
    FROM events
    """,
)
def lateral_json(spark: SparkSession, sf: str) -> DataFrame:
    # Messages of error events are cut short, so they have no row to join.
    events = table(spark, sf, "events").selectExpr(
        "event_id", "if(event_type = 'error', substr(props, 1, length(props) - 1), props) AS props"
    )
    parsed = F.from_json("props", "k INT, _bad STRING", {"columnNameOfCorruptRecord": "_bad"})
    events = events.withColumn("parsed", parsed)
    rows = F.when(F.col("parsed._bad").isNull(), F.array(F.struct(F.col("parsed.k").alias("k"))))
    return joins.lateral(events, rows).select("event_id", "k")


@query(
    "lateral_split",
    """
    SELECT p_partkey, t.attr FROM part
    LEFT JOIN LATERAL (SELECT unnest(string_split(CASE WHEN p_type <> 'PROMO' THEN p_name END, ' ')) AS attr) t ON TRUE
    """,
)
def lateral_split(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").selectExpr("p_partkey", "if(p_type <> 'PROMO', p_name, NULL) AS name")
    attrs = F.transform(F.split("name", " "), lambda a: F.struct(a.alias("attr")))
    return joins.lateral(parts, attrs).select("p_partkey", "attr")


@query(
    "left_using",
    """
    SELECT nationkey, segment, customers, rich, poor FROM
      (SELECT c_nationkey AS nationkey, c_mktsegment AS segment, count(*) AS customers FROM customer GROUP BY 1, 2) a
      LEFT JOIN (SELECT c_nationkey AS nationkey, c_mktsegment AS segment, count(*) AS rich
                 FROM customer WHERE c_acctbal > 9500 GROUP BY 1, 2) b USING (nationkey, segment)
      LEFT JOIN (SELECT c_nationkey AS nationkey, c_mktsegment AS segment, count(*) AS poor
                 FROM customer WHERE c_acctbal < -500 GROUP BY 1, 2) c USING (nationkey, segment)
    """,
)
def left_using(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nationkey"), F.col("c_mktsegment").alias("segment"), "c_acctbal"
    )

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("nationkey", "segment").agg(F.count("*").alias(name))

    return joins.using_left_chain(
        counted(customers, "customers"),
        [counted(customers.where("c_acctbal > 9500"), "rich"), counted(customers.where("c_acctbal < -500"), "poor")],
        ["nationkey", "segment"],
    )


@query(
    "never_done",
    """
    WITH catalogue AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view']) AS event_type),
    seen AS (SELECT user_id, event_type, max(ts) AS last FROM events
             WHERE ts < TIMESTAMP '2024-01-08 00:00:00' GROUP BY 1, 2),
    grid AS (SELECT u.user_id, c.event_type, s.last
             FROM (SELECT DISTINCT user_id FROM events) u CROSS JOIN catalogue c
             LEFT JOIN seen s ON s.user_id = u.user_id AND s.event_type = c.event_type),
    fresh AS (SELECT user_id FROM grid GROUP BY 1 HAVING count(*) > count(last))
    SELECT user_id, event_type, CAST(NULL AS BIGINT) AS idle_minutes FROM grid
    WHERE last IS NULL
    UNION ALL
    SELECT user_id, event_type, date_sub('minute', last, TIMESTAMP '2024-01-08 00:00:00') FROM grid
    WHERE user_id NOT IN (SELECT user_id FROM fresh)
      AND date_sub('minute', last, TIMESTAMP '2024-01-08 00:00:00') > 1440
    """,
)
def never_done(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.lit("2024-01-08 00:00:00").cast("timestamp_ntz")
    events = table(spark, sf, "events").select("user_id", "event_type", "ts")
    return joins.unattempted(
        events, events.where(F.col("ts") < as_of), "user_id", "event_type", "ts", EVENT_TYPES, as_of, 1440
    )


@query(
    "point_lookup",
    """
    SELECT custkey, c_name, c_mktsegment
    FROM (SELECT DISTINCT user_id * 7 AS custkey FROM events) LEFT JOIN customer ON custkey = c_custkey
    """,
)
def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "events").select((F.col("user_id") * 7).alias("custkey")).distinct()
    customers = table(spark, sf, "customer").withColumnRenamed("c_custkey", "custkey")
    return point_get(keys, customers, "custkey", ["c_name", "c_mktsegment"])

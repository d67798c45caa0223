"""Registered functions called by name in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions import udaf, udx
from rivulet.plans.registry import query
from rivulet.tables import table


@query("udf_upper", "SELECT c_custkey, upper(c_mktsegment) AS segment FROM customer")
def udf_upper(spark: SparkSession, sf: str) -> DataFrame:
    udx.register(spark)
    return spark.sql(
        "SELECT c_custkey, upper_text(lower(c_mktsegment)) AS segment FROM {customer}", customer=table(spark, sf, "customer")
    )


@query(
    "udaf_floored_max",
    """
    SELECT s_nationkey, s_suppkey // 10 AS block, greatest(coalesce(max(CAST(floor(s_acctbal) AS BIGINT)), 0), 0) AS top
    FROM supplier GROUP BY ALL
    """,
)
def udaf_floored_max(spark: SparkSession, sf: str) -> DataFrame:
    udx.register(spark)
    rows = table(spark, sf, "supplier").selectExpr("s_nationkey", "s_suppkey div 10 AS block", "floor(s_acctbal) AS balance")
    return udx.merged(rows, ["s_nationkey", "block"], "balance", lambda c: F.call_function("floored_max", c), "top")


@query(
    "udaf_mean",
    """
    SELECT o_custkey, round(CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100, 6) AS mean
    FROM orders GROUP BY o_custkey
    """,
)
def udaf_mean(spark: SparkSession, sf: str) -> DataFrame:
    """A user's own aggregate whose buffer, a sum and a count, is not its result."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    means = udaf.aggregate(table(spark, sf, "orders").select("o_custkey", cents), ["o_custkey"], "cents", udaf.MEAN, "mean")
    return means.select("o_custkey", F.round(F.col("mean") / 100, 6).alias("mean"))


@query("udtf_columns", "SELECT event_id, event_type AS name, CAST(user_id AS INTEGER) AS age, 'A' AS grade FROM events")
def udtf_columns(spark: SparkSession, sf: str) -> DataFrame:
    udx.register(spark)
    message = F.to_json(F.struct(F.col("event_type").alias("name"), F.col("user_id").alias("age"), F.lit("A").alias("grade")))
    rows = table(spark, sf, "events").select(F.col("event_id").alias("id"), message.alias("message"))
    return spark.sql("SELECT id AS event_id, name, age, grade FROM person_table(TABLE(SELECT * FROM {rows}))", rows=rows)


@query("udtf_rows", "SELECT c_custkey, unnest([c_mktsegment, c_name]) AS attr FROM customer")
def udtf_rows(spark: SparkSession, sf: str) -> DataFrame:
    udx.register(spark)
    message = F.concat_ws(",", "c_mktsegment", "c_name")
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), message.alias("message"))
    return spark.sql("SELECT id AS c_custkey, attr FROM comma_table(TABLE(SELECT * FROM {rows}))", rows=rows)


@query("udtf_envelope", """SELECT event_type AS topic, props AS payload, event_id AS "offset" FROM events""")
def udtf_envelope(spark: SparkSession, sf: str) -> DataFrame:
    udx.register(spark)
    message = F.to_json(F.struct(F.col("event_type").alias("topic"), F.col("props").alias("value"), F.col("event_id").alias("offset")))
    rows = table(spark, sf, "events").select(F.col("event_id").alias("id"), message.alias("message"))
    return spark.sql("SELECT topic, payload, offset FROM envelope_table(TABLE(SELECT * FROM {rows}))", rows=rows)

"""Sinks on the driver's tables: written to the shared folder, then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.functions import times
from rivulet.plans.registry import query
from rivulet.session import fresh_dir
from rivulet.sinks import files, keyed, ledger
from rivulet.sinks import tables as table_sinks
from rivulet.sources import files as file_sources
from rivulet.sources import tables as table_sources
from rivulet.tables import table

HALF = "2024-01-16 00:00:00"


def _halves(events: DataFrame) -> list[DataFrame]:
    """The table as two batches by time."""
    middle = F.lit(HALF).cast("timestamp_ntz")
    return [events.where(F.col("ts") < middle), events.where(F.col("ts") >= middle)]


def _upserted(spark: SparkSession, sf: str) -> keyed.KeyedTable:
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    plain = events.drop("ts")
    target = keyed.KeyedTable(spark, fresh_dir(spark, "upsert"), plain.schema, ["user_id"], ["event_id"])
    for batch_id, batch in enumerate(_halves(events)):
        target.upsert(batch.drop("ts"), batch_id)
    return target


LATEST_SQL = """
    SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type,
           arg_max(value, event_id) AS value FROM events GROUP BY user_id
    """


@query("upsert_latest", LATEST_SQL)
def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _upserted(spark, sf).current()


@query("upsert_drop", "SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def upsert_drop(spark: SparkSession, sf: str) -> DataFrame:
    target = _upserted(spark, sf)
    target.compact()
    return keyed.without_fields(target.current(), "event_type")


def _event_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a put to its user's row, under its type."""
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("rowkey"),
        F.lit("info").alias("family"),
        F.col("event_type").alias("qualifier"),
        F.col("event_id").alias("ts"),
        F.col("props").alias("value"),
    )


@query(
    "wide_pivot",
    """
    SELECT CAST(user_id AS VARCHAR) AS rowkey,
           arg_max(CASE WHEN event_type = 'click' THEN props END, CASE WHEN event_type = 'click' THEN event_id END) AS click,
           arg_max(CASE WHEN event_type = 'error' THEN props END, CASE WHEN event_type = 'error' THEN event_id END) AS error,
           arg_max(CASE WHEN event_type = 'view' THEN props END, CASE WHEN event_type = 'view' THEN event_id END) AS "view"
    FROM events GROUP BY user_id
    """,
)
def wide_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return table_sources.wide_rows(_event_cells(spark, sf), "info", ["click", "error", "view"]).select("rowkey", "info.*")


@query(
    "copy_cell",
    """
    SELECT CAST(user_id AS VARCHAR) AS rowkey, 'info' AS family, 'purchase' AS qualifier, max(event_id) AS ts,
           arg_max(props, event_id) AS value
    FROM events WHERE event_type = 'purchase' GROUP BY user_id
    """,
)
def copy_cell(spark: SparkSession, sf: str) -> DataFrame:
    cells = table_sources.one_cell(_event_cells(spark, sf), "info", "purchase")
    target = keyed.KeyedTable(
        spark, fresh_dir(spark, "cells"), cells.schema, ["rowkey", "family", "qualifier"], ["ts"]
    )
    target.upsert(cells, 0)
    return target.current()


@query(
    "txn_sink",
    f"""
    SELECT event_type AS value, CAST(count(*) AS INTEGER) AS total, TIMESTAMP '2024-02-01 00:00:00' AS insert_time,
           CASE WHEN ts < TIMESTAMP '{HALF}' THEN 0 ELSE 1 END::BIGINT AS batch_id
    FROM events GROUP BY event_type, 4
    """,
)
def txn_sink(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.StructType.fromDDL("value string, total int, insert_time timestamp_ntz")
    target = ledger.BatchLedger(spark, fresh_dir(spark, "ledger"), schema)
    clock = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    halves = _halves(table(spark, sf, "events").select("event_type", "ts"))
    for batch_id in (0, 1, 0):  # the last one is a replay and changes nothing
        counts = halves[batch_id].groupBy("event_type").agg(F.count("*").alias("n"))
        target.write(ledger.transaction_rows(counts, "event_type", "n", clock), batch_id)
    return target.read()


def _by_day(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return events.select("event_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("dt"))


def _new_table(spark: SparkSession, df: DataFrame, by: list[str]) -> str:
    """Catalog table with files in the shared folder."""
    name = f"rivulet_{uuid.uuid4().hex}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
    table_sources.create_table(
        spark, name, columns, "parquet", partitioned_by=by, location=fresh_dir(spark, "table")
    )
    return name


@query(
    "overwrite_partition",
    """
    SELECT event_id, CASE WHEN strftime(ts, '%Y-%m-%d') = '2024-01-15' THEN upper(event_type) ELSE event_type END AS event_type,
           strftime(ts, '%Y-%m-%d') AS dt FROM events
    """,
)
def overwrite_partition(spark: SparkSession, sf: str) -> DataFrame:
    days = _by_day(spark, sf)
    name = _new_table(spark, days, ["dt"])
    table_sinks.insert_into(days.hint("rebalance", "dt"), name, ["event_id", "event_type", "dt"])
    day = days.where("dt = '2024-01-15'").withColumn("event_type", F.upper("event_type"))
    table_sinks.overwrite_partition(day, name, {"dt": "2024-01-15"}, ["event_id", "event_type"])
    return spark.table(name)


@query(
    "replace_days",
    """
    SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-16 00:00:00' THEN upper(event_type) ELSE event_type END AS event_type,
           CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS dt FROM events
    """,
)
def replace_days(spark: SparkSession, sf: str) -> DataFrame:
    days = _by_day(spark, sf)
    path = fresh_dir(spark, "days")
    files.partitioned(days, path, ["dt"])
    late = days.where("dt >= '2024-01-16'").withColumn("event_type", F.upper("event_type"))
    files.replace_partitions(late, path, ["dt"])
    return spark.read.parquet(path)


@query(
    "partition_filter",
    """
    SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d') AS dt FROM events
    WHERE event_type = 'purchase' AND strftime(ts, '%Y-%m-%d') = '2024-01-10'
    """,
)
def partition_filter(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("dt")
    )
    name = _new_table(spark, events, ["event_type", "dt"])
    table_sinks.insert_into(
        events.hint("rebalance", "event_type", "dt"), name, ["event_id", "user_id", "event_type", "dt"]
    )
    return table_sources.partition_scan(spark, name, {"event_type": "purchase", "dt": "2024-01-10"})


@query(
    "insert_append",
    """
    SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier
    """,
)
def insert_append(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    name = _new_table(spark, customers, [])
    table_sinks.insert_into(customers, name, ["id", "name"])
    view = f"{name}_suppliers"
    table_sinks.as_view(suppliers, view)
    spark.sql(f"INSERT INTO {name} SELECT id, name FROM {view}")
    spark.catalog.dropTempView(view)
    return spark.table(name)


@query(
    "day_bucket_orc",
    "SELECT event_id, event_type, CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS c_date FROM events",
)
def day_bucket_orc(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    path = fresh_dir(spark, "orc-days")
    files.partitioned(files.with_clock_day(events, F.col("ts")).drop("ts"), path, ["c_date"], "orc")
    return spark.read.orc(path)


@query(
    "orc_zlib",
    """
    SELECT lang AS platform, source AS event, CAST(doc_id AS VARCHAR) AS dt FROM documents
    """,
)
def orc_zlib(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").select(
        F.col("lang").alias("platform"), F.col("source").alias("event"), F.col("doc_id").cast("string").alias("dt")
    )
    path = fresh_dir(spark, "orc")
    files.partitioned(rows.to(T.StructType.fromDDL("platform string, event string, dt string")), path, [], "orc")
    return spark.read.schema("platform string, event string, dt string").orc(path)


@query("path_parquet", "SELECT doc_id, text, lang AS platform, source AS event FROM documents")
def path_parquet(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents").select(
        "doc_id", "text", F.col("lang").alias("platform"), F.col("source").alias("event")
    )
    path = fresh_dir(spark, "paths")
    files.partitioned(documents, path, ["platform", "event"])
    return spark.read.parquet(path)


@query(
    "hour_commit",
    """
    SELECT strftime(ts, '%Y-%m') AS dt, strftime(ts, '%H') AS h, count(*) AS n, TRUE AS committed
    FROM events GROUP BY 1, 2
    """,
)
def hour_commit(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts")
    rows = files.with_day_and_hour(events, F.col("ts"), "yyyy-MM").drop("ts")
    path = fresh_dir(spark, "hours")
    sink = files.committing_partitions(path, ["dt", "h"])
    sink(rows, 0)
    sink(rows, 0)  # a replay replaces the batch's own files
    marked = spark.createDataFrame(files.committed_partitions(spark, path, ["dt", "h"]), "dt string, h string")
    stored = "event_id bigint, dt string, h string, batch_id int"
    counts = spark.read.schema(stored).orc(path).groupBy("dt", "h").agg(F.count("*").alias("n"))
    found = counts.join(marked.withColumn("committed", F.lit(True)), ["dt", "h"], "left")
    return found.select("dt", "h", "n", F.coalesce("committed", F.lit(False)).alias("committed"))


@query("csv_out", "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders")
def csv_out(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    path = fresh_dir(spark, "csv")
    files.csv_rows(orders, path)
    return spark.read.schema(orders.schema).option("sep", " ").csv(path)


@query("text_paths", "SELECT event_type, CAST(user_id % 4 AS INTEGER) AS shard, props AS value FROM events")
def text_paths(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(
        "event_type", F.pmod("user_id", F.lit(4)).cast("int").alias("shard"), F.col("props").alias("value")
    )
    path = fresh_dir(spark, "text")
    files.text_rows(rows, path, "value", ["event_type", "shard"])
    return file_sources.text_lines(spark, path)


@query(
    "json_scan",
    """
    SELECT event_id, 'all' AS flag, user_id AS count, CASE WHEN event_type <> 'error' THEN event_type END AS kind FROM events
    """,
)
def json_scan(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "event_id", "user_id", F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind")
    )
    path = fresh_dir(spark, "json")
    events.write.json(path)
    return file_sources.json_lines(spark, path).selectExpr("event_id", "'all' as flag", "user_id as count", "kind")


@query(
    "comma_scan",
    """
    SELECT event_id AS id, event_type AS kind, epoch_us(ts) // 1000 AS ms FROM events
    """,
)
def comma_scan(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "events").select(
        F.concat_ws(
            ", ", F.col("event_id").cast("string"), "event_type", times.epoch_millis(F.col("ts")).cast("string")
        ).alias("value")
    )
    path = fresh_dir(spark, "lines")
    lines.write.text(path)
    return file_sources.comma_rows(spark, path, "id bigint, kind string, ms bigint")

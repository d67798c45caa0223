"""Streaming twins: each table's files are read as a stream and must give the batch answer.

The answers do not depend on how many micro-batches the files make.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.operators import windows
from rivulet.operators.joins import lookup_join
from rivulet.operators.sequences import Pattern
from rivulet.operators.sets import union_distinct_stream
from rivulet.plans import detecting, joining
from rivulet.plans.registry import query
from rivulet.plans.writing import LATEST_SQL
from rivulet.session import fresh_dir, use_utc
from rivulet.sinks import files, keyed
from rivulet.sinks.ledger import BatchLedger
from rivulet.sinks.topics import json_records
from rivulet.sources import topics
from rivulet.streaming import carried, jobs, processors
from rivulet.tables import table, zoned, zoneless


def _events(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return jobs.table_stream(use_utc(spark), sf, "events").select(*columns)


def _windowed(spark: SparkSession, sf: str, size: str, slide: str | None, mode: str = "update") -> DataFrame:
    events = zoned(_events(spark, sf, "ts", "event_type"), "ts")
    counted = windows.windowed(events, "ts", size, {"pv": F.count(F.lit(1))}, ["event_type"], slide, "10 minutes")
    emitted = jobs.drained(counted, mode, "windows")
    return zoneless(jobs.latest_updates(emitted, ["window_start", "window_end", "event_type"]), "window_start", "window_end")


@query("stream_tumbling_count", detecting.TUMBLING_SQL)
def stream_tumbling_count(spark: SparkSession, sf: str) -> DataFrame:
    return _windowed(spark, sf, "1 hour", None)


@query("stream_sliding_count", detecting.SLIDING_SQL)
def stream_sliding_count(spark: SparkSession, sf: str) -> DataFrame:
    return _windowed(spark, sf, "2 hours", "30 minutes")


KEYED_COUNT_SQL = "SELECT event_type, count(*) AS n FROM events GROUP BY event_type"


@query("stream_keyed_count", KEYED_COUNT_SQL)
def stream_keyed_count(spark: SparkSession, sf: str) -> DataFrame:
    emitted = jobs.drained(jobs.running_counts(_events(spark, sf, "event_type"), "event_type"), "update", "counts")
    return jobs.latest_updates(emitted, ["event_type"]).orderBy(F.desc("n"), "event_type")


@query("stream_clock_windows", KEYED_COUNT_SQL)
def stream_clock_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per window of the processing clock; how rows fall into windows is the clock's matter, their sum is not."""
    stamped = windows.on_clock(_events(spark, sf, "event_type"))
    counted = windows.windowed(stamped, "clock", "5 seconds", {"pv": F.count(F.lit(1))}, ["event_type"])
    emitted = jobs.drained(counted, "update", "clock")
    final = jobs.latest_updates(emitted, ["window_start", "window_end", "event_type"])
    return final.groupBy("event_type").agg(F.sum("pv").alias("n"))


@query(
    "stream_running_sum",
    """
    SELECT user_id, event_id,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS running
    FROM events
    """,
)
def stream_running_sum(spark: SparkSession, sf: str) -> DataFrame:
    cents = F.round(F.col("value") * 100).cast("bigint").alias("cents")
    events = _events(spark, sf, "user_id", "event_id", "value").select("user_id", "event_id", cents)
    job = carried.running_sums(spark, fresh_dir(spark, "running"), events.schema, "user_id", "event_id", "cents")
    return carried.output(events, job).drop("batch_id")


def _keyed_events(spark: SparkSession, sf: str) -> DataFrame:
    return zoned(_events(spark, sf, "user_id", "ts", "event_id", "event_type"), "ts").toDF("user_id", "event_time", "seq", "kind")


#: the watermark when all files are read: five seconds, in whole milliseconds, behind the latest event
WATERMARK_SQL = "(SELECT (epoch_ms(max(ts)) - 5000) * 1000 FROM events)"
RATES_WATERMARK_SQL = WATERMARK_SQL.replace("FROM events", "FROM events WHERE event_type IN ('click', 'purchase')")


@query("stream_fail_pairs", detecting.FAIL_PAIRS_SQL)
def stream_fail_pairs(spark: SparkSession, sf: str) -> DataFrame:
    events = _keyed_events(spark, sf)
    path, within = fresh_dir(spark, "fail-pairs"), F.expr("INTERVAL 3 HOURS")
    job = carried.arrival_pairs(spark, path, events.schema, within, "error", "fails within 3 hours")
    return zoneless(carried.output(events, job).drop("batch_id"), "first_fail", "last_fail")


@query("stream_fail_pattern", f"SELECT * FROM ({detecting.FAIL_PATTERN_SQL}) WHERE epoch_us(last_fail) <= {WATERMARK_SQL}")
def stream_fail_pattern(spark: SparkSession, sf: str) -> DataFrame:
    found = _matches(spark, sf, detecting.fail_pair("kind"), "fail-pattern")
    pair = found.select("user_id", F.col("first.event_time").alias("first_fail"), F.col("last.event_time").alias("last_fail"))
    return zoneless(pair.withColumn("warning", F.lit("login fail!")), "first_fail", "last_fail")


@query("stream_match_pattern", f"SELECT * FROM ({detecting.THREE_STEPS_SQL}) WHERE epoch_us(failed_at) <= {WATERMARK_SQL}")
def stream_match_pattern(spark: SparkSession, sf: str) -> DataFrame:
    found = _matches(spark, sf, detecting.three_steps("kind"), "three-steps")
    return zoneless(detecting.step_ids(found, "seq", "event_time"), "failed_at")


def _matches(spark: SparkSession, sf: str, pattern: Pattern, name: str) -> DataFrame:
    events = _keyed_events(spark, sf)
    order, columns = ["event_time", "seq"], ["event_time", "seq"]
    job = carried.matches(spark, fresh_dir(spark, name), events.schema, pattern, "user_id", "event_time", order, columns, 5)
    return carried.output(events, job).drop("batch_id")


@query(
    "stream_asof_rate",
    f"""
    SELECT c.event_id, c.user_id, c.ts, p.value AS rate
    FROM (SELECT * FROM events WHERE event_type = 'click') c
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
      ON c.user_id = p.user_id AND c.ts >= p.ts
    WHERE epoch_us(c.ts) <= {RATES_WATERMARK_SQL}
    """,
)
def stream_asof_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks and the rates they need come from one stream; a click waits until no earlier rate can come."""
    events = zoned(_events(spark, sf, "event_id", "user_id", "ts", "event_type", "value"), "ts")
    mixed = events.where("event_type IN ('click', 'purchase')").withColumnRenamed("value", "rate")
    clicks, rates = (mixed.select("user_id", "ts", "event_id", *more).schema for more in ([], ["rate"]))
    rows = carried.as_of_rows(mixed, F.col("event_type") == "purchase", "user_id", "ts", "rate", "event_id", ["event_id"])
    job = carried.as_of(spark, fresh_dir(spark, "asof"), clicks, rates, "user_id", "ts", "rate", "event_id", 5)
    return zoneless(carried.output(rows, job).drop("batch_id"), "ts")


@query("stream_lookup_group", joining.LOOKUP_GROUP_SQL)
def stream_lookup_group(spark: SparkSession, sf: str) -> DataFrame:
    """Each batch looks up its users and emits the lists it changes; the last one of a key is its list."""
    rows = T.StructType.fromDDL("user_id bigint, label string, event_id bigint")
    lists = carried.DistinctLists(spark, fresh_dir(spark, "lists"), rows, ["user_id"], "label", "event_id")

    class Enriched:
        out = lists.out

        @staticmethod
        def write(batch: DataFrame, batch_id: int) -> None:
            lists.write(joining.labelled(batch, spark, sf), batch_id)

    events = _events(spark, sf, "event_id", "user_id", "event_type").withColumn("user_id", F.col("user_id") * 7)
    return jobs.latest_updates(carried.output(events, Enriched), ["user_id", "part"])


@query(
    "stream_fail_burst",
    f"""
    SELECT * FROM ({detecting.BURST_SQL})
    WHERE epoch_us(first_fail) + CAST({detecting.BURST_SPAN + 1} AS BIGINT) * 1000000 <= {WATERMARK_SQL}
    """,
)
def stream_fail_burst(spark: SparkSession, sf: str) -> DataFrame:
    with processors.rocks_state(spark):
        bursts = processors.ordered_bursts(_keyed_events(spark, sf), detecting.BURST_SPAN, 2, "5 seconds", "error")
        return zoneless(jobs.drained(bursts, "append", "fail-burst").drop("batch_id"), "first_fail", "last_fail")


@query("stream_changelog", KEYED_COUNT_SQL)
def stream_changelog(spark: SparkSession, sf: str) -> DataFrame:
    """What is left when every withdrawal has taken its row back."""
    counts = jobs.running_counts(_events(spark, sf, "event_type"), "event_type")
    changes = carried.output(counts, carried.ChangeLog(spark, fresh_dir(spark, "changelog"), counts.schema, ["event_type"]), "update")
    sign = F.when(F.col("is_add"), 1).otherwise(-1)
    return changes.groupBy("event_type").agg(F.sum(sign * F.col("n")).alias("n"))


@query("stream_upsert_latest", LATEST_SQL)
def stream_upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf, "user_id", "event_id", "event_type", "value")
    root = fresh_dir(spark, "stream-upsert")
    target = keyed.KeyedTable(spark, f"{root}/table", events.schema, ["user_id"], ["event_id"])
    jobs.drain(events, target.upsert, "append", f"{root}/checkpoint")
    return target.current()


@query("stream_route", detecting.ROUTE_SQL)
def stream_route(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_dir(spark, "stream-route")
    stream = jobs.table_stream(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    route = detecting.document_route()
    outputs = {name: BatchLedger(spark, f"{root}/{name}", stream.select("doc_id").schema) for name in route.sinks}
    for name, output in outputs.items():
        route.end(name, output.write)
    jobs.drain(stream, route.write, "append", f"{root}/checkpoint")
    union = None
    for name, output in outputs.items():
        rows = output.read().select(F.lit(name).alias("end"), "doc_id")
        union = rows if union is None else union.union(rows)
    return union


@query(
    "stream_union_distinct",
    """
    SELECT user_id, event_type FROM events WHERE event_type IN ('click', 'view')
    UNION SELECT user_id, event_type FROM events WHERE event_type IN ('view', 'error')
    """,
)
def stream_union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    def side(*kinds: str) -> DataFrame:
        return _events(spark, sf, "user_id", "event_type").where(F.col("event_type").isin(*kinds))

    both = union_distinct_stream(side("click", "view"), side("view", "error"), ["user_id", "event_type"])
    return jobs.drained(both, "append", "union").select("user_id", "event_type")


@query(
    "stream_lookup",
    """
    SELECT event_id, user_id * 7 AS user_id, c_name FROM events LEFT JOIN customer ON user_id * 7 = c_custkey
    """,
)
def stream_lookup(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_dir(spark, "stream-lookup")
    schema = "event_id bigint, user_id bigint, c_name string"
    target = BatchLedger(spark, f"{root}/out", T.StructType.fromDDL(schema))

    def enrich(batch: DataFrame, batch_id: int) -> None:
        # The dimension is read again for every batch: its state as of processing time.
        dimension = table(spark, sf, "customer").select("c_custkey", "c_name")
        target.write(lookup_join(batch, dimension, "user_id", "c_custkey", "left"), batch_id)

    events = _events(spark, sf, "event_id", "user_id").withColumn("user_id", F.col("user_id") * 7)
    jobs.drain(events, enrich, "append", f"{root}/checkpoint")
    return target.read().drop("batch_id")


@query("batch_counts", KEYED_COUNT_SQL)
def batch_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of each micro-batch alone, added up."""
    root = fresh_dir(spark, "batch-counts")
    target = BatchLedger(spark, f"{root}/out", T.StructType.fromDDL("event_type string, n bigint"))
    jobs.drain(_events(spark, sf, "event_type"), jobs.counts_per_batch("event_type", target), "append", f"{root}/checkpoint")
    return target.read().groupBy("event_type").agg(F.sum("n").alias("n"))


@query(
    "stream_positions",
    """
    SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", max(event_id) + 1 AS next_offset
    FROM events GROUP BY ALL
    """,
)
def stream_positions(spark: SparkSession, sf: str) -> DataFrame:
    log = _events(spark, sf, "event_id", "user_id", "event_type").select(
        F.col("event_type").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    root = fresh_dir(spark, "positions")
    target = keyed.KeyedTable(
        spark, f"{root}/table", topics.next_positions(log).schema, ["topic", "partition"], ["next_offset"]
    )

    def commit(batch: DataFrame, batch_id: int) -> None:
        target.upsert(topics.next_positions(batch), batch_id)

    jobs.drain(log, jobs.skipping_empty(commit), "append", f"{root}/checkpoint")
    return target.current()


@query(
    "topic_counts",
    """
    SELECT concat('{"window_start":"', strftime(time_bucket(INTERVAL '10 minutes', ts), '%Y-%m-%dT%H:%M:%S.000Z'),
                  '","event_type":"', event_type, '","pv":', count(*), '}') AS "value"
    FROM events GROUP BY time_bucket(INTERVAL '10 minutes', ts), event_type
    """,
)
def topic_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Complete mode: each batch sends the whole snapshot to the topic; the last one counts."""
    events = zoned(_events(spark, sf, "ts", "event_type"), "ts")
    counted = windows.windowed(events, "ts", "10 minutes", {"pv": F.count(F.lit(1))}, ["event_type"])
    emitted = jobs.drained(counted.drop("window_end"), "complete", "topic-counts")
    last = emitted.agg(F.max("batch_id")).first()[0]
    return json_records(emitted.where(F.col("batch_id") == F.lit(last)).drop("batch_id"))


@query("stream_day_orc", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS c_date FROM events")
def stream_day_orc(spark: SparkSession, sf: str) -> DataFrame:
    """Streaming ORC sink by day; here the event's time stands for the writer's clock."""
    root = fresh_dir(spark, "day-orc")
    events = zoned(_events(spark, sf, "event_id", "ts"), "ts")
    writer = files.day_bucket_stream(events, f"{root}/out", f"{root}/checkpoint", F.col("ts"))
    writer.trigger(availableNow=True).start().awaitTermination()
    stored = spark.read.schema("event_id bigint, ts timestamp, c_date string").orc(f"{root}/out")
    return stored.select("event_id", "c_date")


@query("stream_parquet", "SELECT event_id, event_type, props FROM events")
def stream_parquet(spark: SparkSession, sf: str) -> DataFrame:
    root = fresh_dir(spark, "stream-parquet")
    events = _events(spark, sf, "event_id", "event_type", "props")
    files.parquet_stream(events, f"{root}/out", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{root}/out")

"""Windows, patterns, routing and clustering on the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.vector import euclidean
from rivulet.operators import clusters, patterns, routing, windows
from rivulet.operators.sequences import Pattern, match
from rivulet.plans.registry import query
from rivulet.tables import table


def _count() -> dict:
    return {"pv": F.count(F.lit(1))}


TUMBLING_SQL = """
    SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
           time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, event_type, count(*) AS pv
    FROM events GROUP BY ALL
    """
SLIDING_SQL = """
    SELECT w AS window_start, w + INTERVAL '2 hours' AS window_end, event_type, count(*) AS pv
    FROM (SELECT event_type, unnest([b, b - INTERVAL '30 minutes', b - INTERVAL '60 minutes', b - INTERVAL '90 minutes']) AS w
          FROM (SELECT event_type, time_bucket(INTERVAL '30 minutes', ts) AS b FROM events))
    GROUP BY ALL
    """


@query("tumbling_count", TUMBLING_SQL)
def tumbling_count(spark: SparkSession, sf: str) -> DataFrame:
    return windows.windowed(table(spark, sf, "events"), "ts", "1 hour", _count(), ["event_type"])


@query("sliding_count", SLIDING_SQL)
def sliding_count(spark: SparkSession, sf: str) -> DataFrame:
    return windows.windowed(table(spark, sf, "events"), "ts", "2 hours", _count(), ["event_type"], "30 minutes")


@query(
    "global_window",
    """
    SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
           time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
           arg_min(event_type, event_id) AS event_type,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY ALL
    """,
)
def global_window(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("value").cast("decimal(18,2)")
    sums = windows.whole_window_sum(table(spark, sf, "events"), "ts", "1 hour", value, "event_type", "event_id")
    return sums.withColumn("total", F.col("total").cast("double"))


@query(
    "proc_tumbling",
    """
    SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
           time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, event_type,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM events GROUP BY ALL
    """,
)
def proc_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    stamped = windows.on_clock(table(spark, sf, "events"), F.col("ts"))
    total = {"total": F.sum(F.col("value").cast("decimal(18,2)")).cast("double")}
    return windows.windowed(stamped, "clock", "1 hour", total, ["event_type"])


PAIRS_SQL = """
    SELECT user_id, prev_ts AS first_fail, ts AS last_fail, '{message}' AS warning FROM (
      SELECT user_id, ts, event_type, lag(ts) OVER w AS prev_ts, lag(event_type) OVER w AS prev_type
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY {order}))
    WHERE event_type = 'error' AND prev_type = 'error' AND ts < prev_ts + INTERVAL '{hours} hours'
    """
FAIL_PAIRS_SQL = PAIRS_SQL.format(message="fails within 3 hours", order="event_id", hours=3)
FAIL_PATTERN_SQL = PAIRS_SQL.format(message="login fail!", order="ts, event_id", hours=7)


@query("fail_pairs", FAIL_PAIRS_SQL)
def fail_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.consecutive_fails(
        table(spark, sf, "events"), "user_id", "event_type", "ts", ["event_id"],
        F.expr("INTERVAL 3 HOURS"), "error", "fails within 3 hours",
    )


@query("fail_pattern", FAIL_PATTERN_SQL)
def fail_pattern(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.consecutive_fails(
        table(spark, sf, "events"), "user_id", "event_type", "ts", ["ts", "event_id"],
        F.expr("INTERVAL 7 HOURS"), "error",
    )


def fail_pair(kind: str = "event_type") -> Pattern:
    """Two errors one right after the other, less than seven hours apart."""
    error = F.col(kind) == "error"
    return Pattern.begin("first", error).next("last", error).within(7 * 3600)


@query("match_fail_pair", FAIL_PATTERN_SQL)
def match_fail_pair(spark: SparkSession, sf: str) -> DataFrame:
    found = match(table(spark, sf, "events"), fail_pair(), "user_id", "ts", ["ts", "event_id"], ["ts"])
    return found.select("user_id", F.col("first.ts").alias("first_fail"), F.col("last.ts").alias("last_fail"), F.lit("login fail!").alias("warning"))


THREE_STEPS_SQL = """
    WITH placed AS (SELECT user_id, ts, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
    ahead AS (
      SELECT *, min(CASE WHEN event_type = 'purchase' THEN rn END)
        OVER (PARTITION BY user_id ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS buys
      FROM placed)
    SELECT a.user_id, a.event_id AS seen_id, b.event_id AS bought_id, c.event_id AS failed_id, c.ts AS failed_at
    FROM ahead a JOIN placed b ON b.user_id = a.user_id AND b.rn = a.buys
    JOIN placed c ON c.user_id = a.user_id AND c.rn = b.rn + 1 AND c.event_type = 'error'
    WHERE a.event_type = 'view' AND c.ts < a.ts + INTERVAL '48 hours'
    """


def three_steps(kind: str = "event_type") -> Pattern:
    """A view, later a purchase, and an error right after it, all in less than two days."""
    pattern = Pattern.begin("seen", F.col(kind) == "view").followed_by("bought", F.col(kind) == "purchase")
    return pattern.next("failed", F.col(kind) == "error").within(48 * 3600)


def step_ids(found: DataFrame, ident: str, time: str) -> DataFrame:
    """Ids of the three events, and when the last one was."""
    ids = [F.col(f"{s}.{ident}").alias(f"{s}_id") for s in ("seen", "bought", "failed")]
    return found.select("user_id", *ids, F.col(f"failed.{time}").alias("failed_at"))


@query("match_three_steps", THREE_STEPS_SQL)
def match_three_steps(spark: SparkSession, sf: str) -> DataFrame:
    found = match(table(spark, sf, "events"), three_steps(), "user_id", "ts", ["ts", "event_id"], ["event_id", "ts"])
    return step_ids(found, "event_id", "ts")


BURST_SPAN = 24 * 3600
BURST_SQL = """
    WITH RECURSIVE numbered AS (
      SELECT user_id, event_type = 'error' AS failed, CAST(floor(epoch(ts)) AS BIGINT) AS t,
             sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)
               OVER (PARTITION BY user_id ORDER BY ts, event_id) AS r
      FROM events),
    fails AS (SELECT user_id, r, t, count(*) AS n FROM numbered WHERE failed GROUP BY ALL),
    stops AS (SELECT user_id, r - 1 AS r, t AS stop FROM numbered WHERE NOT failed),
    starts AS (
      SELECT user_id, r, min(t) AS first FROM fails GROUP BY user_id, r
      UNION ALL
      SELECT s.user_id, s.r, min(f.t) FROM starts s JOIN fails f
        ON f.user_id = s.user_id AND f.r = s.r AND f.t > s.first + {span} GROUP BY s.user_id, s.r),
    bursts AS (
      SELECT s.user_id, s.r, s.first, max(f.t) AS last, sum(f.n) AS fails FROM starts s JOIN fails f
        ON f.user_id = s.user_id AND f.r = s.r AND f.t BETWEEN s.first AND s.first + {span} GROUP BY ALL)
    SELECT b.user_id, make_timestamp(first * 1000000) AS first_fail, make_timestamp(last * 1000000) AS last_fail,
           CAST(fails AS BIGINT) AS fails
    FROM bursts b LEFT JOIN stops p ON p.user_id = b.user_id AND p.r = b.r
    WHERE fails >= 2 AND (stop IS NULL OR stop > first + {span})
    """.format(span=BURST_SPAN)


@query("fail_burst", BURST_SQL)
def fail_burst(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.fail_bursts(
        table(spark, sf, "events"), "user_id", "event_type", "ts", ["ts", "event_id"], BURST_SPAN, 2, "error"
    )


@query(
    "late_split",
    """
    SELECT event_id, age_seconds, CASE WHEN age_seconds < 864000 THEN 'main' ELSE 'late' END AS output,
           CASE WHEN age_seconds >= 864000 THEN concat('event ', event_id, ' is late by ', age_seconds, ' seconds') END AS message
    FROM (SELECT event_id, date_sub('second', ts, (SELECT max(ts) FROM events)) AS age_seconds FROM events)
    """,
)
def late_split(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "ts")
    as_of = events.agg(F.max("ts")).scalar()
    age = F.timestamp_diff("SECOND", F.col("ts"), as_of)
    message = F.concat(
        F.lit("event "), F.col("event_id"), F.lit(" is late by "), F.col("age_seconds"), F.lit(" seconds")
    )
    return routing.late_split(events, age, 864000, message).drop("ts")


ROUTE_SQL = """
    SELECT 'western' AS "end", doc_id FROM documents WHERE lang IN ('en', 'fr')
    UNION ALL SELECT 'long', doc_id FROM documents WHERE lang IN ('en', 'fr') AND n_chars > 2000
    UNION ALL SELECT 'german', doc_id FROM documents WHERE lang = 'de'
    """


def document_route() -> routing.RowRoute:
    """Documents by language; long western ones reach two ends, Spanish ones none."""

    def only_id(row: Column) -> Column:
        return F.struct(row["doc_id"].alias("doc_id"))

    return (
        routing.RowRoute()
        .point("all", lambda row: row)
        .point("west", lambda row: row.dropFields("lang"))
        .point("ids", only_id)
        .point("short_ids", only_id)
        .point("de", only_id)
        .end("western")
        .end("long")
        .end("german")
        .edge("all", "west", lambda row: row["lang"].isin("en", "fr"))
        .edge("all", "de", lambda row: row["lang"] == "de")
        .edge("west", "ids")
        .edge("west", "short_ids", lambda row: row["n_chars"] > 2000)
        .edge("ids", "western")
        .edge("short_ids", "long")
        .edge("de", "german")
    )


@query("route", ROUTE_SQL)
def route(spark: SparkSession, sf: str) -> DataFrame:
    return document_route().combined(table(spark, sf, "documents").select("doc_id", "lang", "n_chars"))


@query(
    "vector_distance",
    """
    SELECT vec_id, round(list_distance(CAST(embedding AS DOUBLE[]),
             CAST((SELECT arg_min(embedding, vec_id) FROM embeddings) AS DOUBLE[])), 4) AS distance
    FROM embeddings
    """,
)
def vector_distance(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding")
    first = vectors.agg(F.min_by("embedding", "vec_id")).scalar()
    beside = vectors.withColumn("first", first)
    return beside.select("vec_id", F.round(euclidean(F.col("embedding"), F.col("first")), 4).alias("distance"))


# The twin writes out this many passes; once settled, further ones change nothing.
KMEANS_K, KMEANS_PASSES = 10, 40


def _kmeans_sql(k: int, passes: int, tolerance: float = 0.01, seed: int = 42) -> str:
    """The same start, passes and stop rule written out: once settled, centres stay as they are."""
    steps = [
        """p AS MATERIALIZED (
             SELECT min(vec_id) AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings GROUP BY embedding)""",
        f"""c0 AS MATERIALIZED (
             SELECT row_number() OVER (ORDER BY md5(concat('{seed}:', id)), id) - 1 AS c, v FROM p QUALIFY c < {k})""",
    ]
    nearest = "SELECT {cols}, arg_min(c, (list_distance(x.v, q.v), c)) AS c FROM {points} x, c{i} q GROUP BY ALL"
    for i in range(passes):
        steps.append(f"a{i} AS MATERIALIZED ({nearest.format(cols='x.id, x.v', points='p', i=i)})")
        steps.append(
            f"""m{i} AS MATERIALIZED (
                  SELECT c, list(mean ORDER BY pos) AS v FROM (
                    SELECT c, pos, avg(x) AS mean FROM (
                      SELECT c, unnest(v) AS x, unnest(range(len(v))) AS pos FROM a{i}) GROUP BY c, pos)
                  GROUP BY c)"""
        )
        steps.append(
            f"""c{i + 1} AS MATERIALIZED (
                  SELECT c, CASE WHEN max(list_distance(old, new)) OVER () > {tolerance} THEN new ELSE old END AS v
                  FROM (SELECT q.c, q.v AS old, coalesce(m.v, q.v) AS new FROM c{i} q LEFT JOIN m{i} m USING (c)))"""
        )
    points = "(SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"
    final = nearest.format(cols="x.vec_id, x.v", points=points, i=passes - 1)
    return (
        "WITH " + ",\n".join(steps) + f""" SELECT a.vec_id, CAST(a.c AS INTEGER) AS cluster,
             round(list_distance(a.v, q.v), 4) AS distance FROM ({final}) a JOIN c{passes - 1} q USING (c)"""
    )


@query("kmeans", _kmeans_sql(KMEANS_K, KMEANS_PASSES))
def kmeans(spark: SparkSession, sf: str) -> DataFrame:
    points = table(spark, sf, "embeddings").select("vec_id", "embedding")
    result = clusters.kmeans(points, "embedding", "vec_id", KMEANS_K)
    return result.assigned.select("vec_id", "cluster", F.round("distance", 4).alias("distance"))

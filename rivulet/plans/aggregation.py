"""Aggregates, sorts and set operations on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.functions.text import java_tokens, lines_of
from rivulet.operators import aggregates as agg
from rivulet.operators import ordered, sets
from rivulet.operators.predicates import bool_query, in_range, in_values, term
from rivulet.plans.registry import query
from rivulet.tables import table


@query(
    "word_count",
    """
    SELECT word, count(*) AS n FROM (
      SELECT unnest(CASE WHEN length(line) > 0 AND rtrim(line, ' ') = '' THEN []::VARCHAR[]
                         ELSE string_split(rtrim(line, ' '), ' ') END) AS word
      FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents))
    GROUP BY word
    """,
)
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "documents").select(F.explode(lines_of(F.col("text"))).alias("value"))
    return agg.word_counts(lines)


def _tagged_balances(spark: SparkSession, sf: str) -> DataFrame:
    cents = "decimal(18,2)"
    return agg.tagged_union(
        {
            "customer": table(spark, sf, "customer").select(
                F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").cast(cents).alias("balance")
            ),
            "supplier": table(spark, sf, "supplier").select(
                F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").cast(cents).alias("balance")
            ),
        }
    )


@query(
    "conditional_sum",
    """
    SELECT nationkey,
           CAST(sum(CASE WHEN flag = 'customer' THEN balance ELSE 0 END) AS DOUBLE) AS customer_balance,
           CAST(sum(CASE WHEN flag = 'supplier' THEN balance ELSE 0 END) AS DOUBLE) AS supplier_balance
    FROM (SELECT c_nationkey AS nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS balance, 'customer' AS flag FROM customer
          UNION ALL
          SELECT s_nationkey, CAST(s_acctbal AS DECIMAL(18,2)), 'supplier' FROM supplier)
    GROUP BY nationkey
    """,
)
def conditional_sum(spark: SparkSession, sf: str) -> DataFrame:
    sums = agg.conditional_sums(
        _tagged_balances(spark, sf),
        ["nationkey"],
        "balance",
        {"customer_balance": "customer", "supplier_balance": "supplier"},
    )
    return sums.select("nationkey", *[F.col(c).cast("double") for c in sums.columns[1:]])


@query(
    "running_sum",
    """
    SELECT event_id, user_id,
           CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY event_id) AS DOUBLE) AS running
    FROM events
    """,
)
def running_sum(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    value = F.col("value").cast("decimal(18,2)")
    sums = ordered.running_sum(events, ["user_id"], ["event_id"], value)
    return sums.select("event_id", "user_id", F.col("running").cast("double").alias("running"))


@query("keyed_count_topk", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def keyed_count_topk(spark: SparkSession, sf: str) -> DataFrame:
    return agg.top_counts(table(spark, sf, "events"), "event_type")


@query(
    "distinct_list",
    """
    SELECT user_id, part, string_agg(event_type, ',' ORDER BY seq) AS items
    FROM (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY seq, event_type) - 1) // 100000 AS part
          FROM (SELECT user_id, event_type, min(event_id) AS seq FROM events GROUP BY 1, 2))
    GROUP BY user_id, part
    """,
)
def distinct_list(spark: SparkSession, sf: str) -> DataFrame:
    return agg.distinct_list(table(spark, sf, "events"), ["user_id"], "event_type", "event_id")


@query(
    "list_agg",
    """
    SELECT o_custkey, part, string_agg(o_orderpriority, ',' ORDER BY o_orderkey) AS items
    FROM (SELECT *, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 100000 AS part FROM orders)
    GROUP BY o_custkey, part
    """,
)
def list_agg(spark: SparkSession, sf: str) -> DataFrame:
    return agg.joined_list(table(spark, sf, "orders"), ["o_custkey"], ["o_orderkey"], "o_orderpriority")


@query(
    "group_collect",
    """
    SELECT o_custkey, part, array_to_string(list(o_orderstatus ORDER BY o_orderkey), '|') AS statuses, count(*) AS n
    FROM (SELECT *, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 100000 AS part FROM orders)
    GROUP BY o_custkey, part
    """,
)
def group_collect(spark: SparkSession, sf: str) -> DataFrame:
    lists = ordered.ordered_lists(
        table(spark, sf, "orders"), ["o_custkey"], ["o_orderkey"], F.col("o_orderstatus"), "statuses"
    )
    return lists.select(
        "o_custkey",
        "part",
        F.array_join("statuses", "|").alias("statuses"),
        F.size("statuses").cast("long").alias("n"),
    )


@query(
    "max_floor",
    """
    SELECT s_nationkey, s_suppkey // 10 AS block,
           greatest(coalesce(max(CAST(floor(s_acctbal) AS BIGINT)), 0), 0) AS top
    FROM supplier GROUP BY ALL
    """,
)
def max_floor(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "supplier").select(
        "s_nationkey", F.expr("s_suppkey div 10").alias("block"), F.floor("s_acctbal").alias("balance")
    )
    return rows.groupBy("s_nationkey", "block").agg(agg.max_with_floor("balance").alias("top"))


@query(
    "changelog",
    """
    WITH counted AS (
      SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events)
    SELECT event_type, event_id, TRUE AS is_add, n FROM counted
    UNION ALL SELECT event_type, event_id, FALSE, n - 1 FROM counted WHERE n > 1
    """,
)
def changelog(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_type", "event_id")
    return agg.changelog_of_counts(events, ["event_type"], ["event_id"])


@query(
    "sql_sum",
    """
    SELECT o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY o_orderstatus
    """,
)
def sql_sum(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """
        SELECT o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
        FROM {orders} GROUP BY o_orderstatus
        """,
        orders=table(spark, sf, "orders"),
    )


@query(
    "cond_max",
    """
    SELECT o_orderpriority,
           max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS "o_totalprice_F",
           max(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS "o_orderkey_F",
           max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS "o_totalprice_O",
           max(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END) AS "o_orderkey_O"
    FROM orders GROUP BY o_orderpriority
    """,
)
def cond_max(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return agg.conditional_max(
        orders, ["o_orderpriority"], ["o_totalprice", "o_orderkey"], ["F", "O"], "o_orderstatus"
    )


@query(
    "group_reduce",
    """
    SELECT o_orderpriority, o_orderstatus AS status, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY ALL
    """,
)
def group_reduce(spark: SparkSession, sf: str) -> DataFrame:
    maps = agg.group_sums_as_map(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", "o_totalprice")
    return maps.select("o_orderpriority", F.explode("sums").alias("status", "total"))


@query(
    "non_null_count",
    """
    SELECT event_type, count(*) AS all_rows, count(CASE WHEN value < 100 THEN value END) AS with_value
    FROM events GROUP BY event_type
    """,
)
def non_null_count(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("value", F.expr("nullif(value, if(value < 100, NULL, value))"))
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("all_rows"), F.count("value").alias("with_value"))


@query(
    "sort_limit",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def sort_limit(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


def _bands(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Nation and balance band of every customer and of every supplier."""
    customers = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nationkey"), F.floor(F.col("c_acctbal") / 1000).alias("band")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nationkey"), F.floor(F.col("s_acctbal") / 1000).alias("band")
    )
    return customers, suppliers


_BANDS_SQL = (
    "SELECT c_nationkey AS nationkey, CAST(floor(c_acctbal / 1000) AS BIGINT) AS band FROM customer",
    "SELECT s_nationkey AS nationkey, CAST(floor(s_acctbal / 1000) AS BIGINT) AS band FROM supplier",
)


@query(
    "full_merge",
    f"""
    SELECT nationkey, band, coalesce(c.rows, s.rows) AS rows, coalesce(c.side, s.side) AS side
    FROM (SELECT nationkey, band, count(*) AS rows, 'customer' AS side FROM ({_BANDS_SQL[0]}) GROUP BY ALL) c
    FULL JOIN (SELECT nationkey, band, count(*) AS rows, 'supplier' AS side FROM ({_BANDS_SQL[1]}) GROUP BY ALL) s
    USING (nationkey, band)
    """,
)
def full_merge(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["nationkey", "band"]
    customers, suppliers = (
        bands.groupBy(*keys).agg(F.count("*").alias("rows")).withColumn("side", F.lit(side))
        for bands, side in zip(_bands(spark, sf), ("customer", "supplier"))
    )
    return agg.full_merge(customers, suppliers, keys, ["rows", "side"])


@query("union_distinct", f"{_BANDS_SQL[0]} UNION {_BANDS_SQL[1]}")
def union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return sets.union_distinct(*_bands(spark, sf))


@query("except_rows", f"{_BANDS_SQL[0]} EXCEPT {_BANDS_SQL[1]}")
def except_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sets.except_distinct(*_bands(spark, sf))


@query("except_all", f"{_BANDS_SQL[0]} EXCEPT ALL {_BANDS_SQL[1]}")
def except_all(spark: SparkSession, sf: str) -> DataFrame:
    return sets.except_multiset(*_bands(spark, sf))


@query(
    "key_difference",
    "SELECT c_custkey AS custkey FROM customer EXCEPT SELECT user_id FROM events",
)
def key_difference(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))
    active = table(spark, sf, "events").select(F.col("user_id").alias("custkey"))
    return sets.key_difference(customers, active, ["custkey"])


@query(
    "range_union",
    """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 300000
    UNION ALL SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 50000
    """,
)
def range_union(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return sets.union_rows(
        orders.where(in_range("o_totalprice", gt=300000)), orders.where(in_range("o_totalprice", lt=50000))
    )


@query(
    "compound_filter",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority, o_orderdate FROM orders
    WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
      AND (o_orderstatus = 'O' OR (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'))
    """,
)
def compound_filter(spark: SparkSession, sf: str) -> DataFrame:
    since = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    wanted = bool_query(
        must=[
            F.col("o_orderdate") >= since,
            bool_query(
                should=[
                    bool_query(must=[term("o_orderstatus", "O")]),
                    bool_query(must=[term("o_orderstatus", "F"), term("o_orderpriority", "1-URGENT")]),
                ]
            ),
        ]
    )
    return table(spark, sf, "orders").where(wanted).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate"
    )


@query(
    "in_filter",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')",
)
def in_filter(spark: SparkSession, sf: str) -> DataFrame:
    wanted = in_values("o_orderpriority", ["1-URGENT", "2-HIGH"])
    return table(spark, sf, "orders").where(wanted).select("o_orderkey", "o_orderpriority")


@query(
    "token_rows",
    """
    SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part
    """,
)
def token_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", F.explode(java_tokens(F.col("p_name"))).alias("word"))

"""Lookup, point-in-time, lateral and anti joins (J).

No join is forced to broadcast: Spark compares the dimension's size with its
threshold, and adaptive execution splits a hot key of the stream side otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.functions.text import compose_key
from rivulet.operators import ordered


def lookup_join(
    facts: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str, how: str = "inner"
) -> DataFrame:
    """Enrich facts from a dimension; ``left`` keeps misses with NULLs.

    The dimension's key column is dropped, as it repeats the fact's.
    """
    if how not in ("inner", "left"):
        raise ValueError("a lookup is an inner or a left join")
    renamed = dimension.withColumnRenamed(dim_key, "_dim_key")
    return facts.join(renamed, F.col(fact_key) == F.col("_dim_key"), how).drop("_dim_key")


def salted_lookup_join(
    facts: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str, how: str = "inner", parts: int = 16
) -> DataFrame:
    """Lookup join that spreads every key over ``parts`` tasks.

    For a dimension too large to broadcast whose result is grouped by the same key: there
    adaptive execution keeps a hot key together, as splitting it would cost another
    shuffle. Each dimension row is repeated ``parts`` times; facts with a NULL key, which
    never match, spread like all others.
    """
    left = facts.withColumn("_salt", F.pmod(F.xxhash64(*facts.columns, F.monotonically_increasing_id()), F.lit(parts)).cast("int"))
    right = dimension.withColumnRenamed(dim_key, "_dim_key").withColumn(
        "_dim_salt", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    )
    matched = (F.col(fact_key) == F.col("_dim_key")) & (F.col("_salt") == F.col("_dim_salt"))
    return left.join(right, matched, how).drop("_salt", "_dim_salt", "_dim_key")


def composed_lookup(
    requests: DataFrame, key_column: str, entries: DataFrame, table: str, pk: str, field: str
) -> DataFrame:
    """Look up ``table:pk:<value>:field`` in a key/value table; a miss gives a NULL value.

    Adds ``key`` and ``value`` to the requests. ``entries`` holds ``(k, v)``.
    """
    keyed = requests.withColumn("key", compose_key(table, pk, F.col(key_column), field))
    return lookup_join(keyed, entries.select("k", F.col("v").alias("value")), "key", "k", "left")


def concat_cells(cells: DataFrame) -> DataFrame:
    """All cells of a row glued together in (family, qualifier) order, as ``(k, v)``.

    Each cell contributes its newest value, so a row key is reduced before the shuffle
    however many versions it has.
    """
    newest = cells.groupBy(F.col("rowkey").alias("k"), "family", "qualifier").agg(F.max_by("value", "ts").alias("value"))
    glued = F.sort_array(F.collect_list(F.struct("family", "qualifier", "value")))
    return newest.groupBy("k").agg(F.array_join(F.transform(glued, lambda c: c["value"]), "").alias("v"))


def as_of_join(
    facts: DataFrame,
    history: DataFrame,
    key: str,
    time: str,
    value: str,
    fact_columns: Sequence[str],
    tie: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Latest history value at or before each fact's time, NULL before the first.

    One shuffle of both sides together instead of a range join. A history row at
    the same time as a fact counts, so history sorts first; ``tie`` orders history
    rows of equal time.
    """

    def null_of(df: DataFrame, name: str) -> Column:
        return F.lit(None).cast(df.schema[name].dataType)

    tie = tie or value
    versions = history.select(
        key,
        time,
        F.col(value).alias("_value"),
        F.lit(0).alias("_side"),
        F.col(tie).alias("_tie"),
        *[null_of(facts, c).alias(c) for c in fact_columns],
    )
    asked = facts.select(
        key,
        time,
        null_of(history, value).alias("_value"),
        F.lit(1).alias("_side"),
        null_of(history, tie).alias("_tie"),
        *fact_columns,
    )
    known = ordered.last_known(
        versions.union(asked), [key], [time, "_side", "_tie"], "_value", "_known", slices
    )
    return known.where(F.col("_side") == 1).select(
        key, time, *fact_columns, F.col("_known").alias(value)
    )


def lateral(df: DataFrame, rows: Column, keep_empty: bool = True) -> DataFrame:
    """Join each row with the struct array ``rows``; by default a row with none is kept."""
    return df.select("*", F.inline_outer(rows) if keep_empty else F.inline(rows))


def using_left_chain(base: DataFrame, others: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left join each table in turn USING the keys; NULL keys do not match."""
    for other in others:
        base = base.join(other, list(keys), "left")
    return base


def unattempted(
    users: DataFrame,
    attempts: DataFrame,
    user: str,
    item: str,
    time: str,
    items: Sequence[str],
    as_of: Column,
    idle_minutes: int = 20,
) -> DataFrame:
    """Per user: the items never attempted; if none, those idle for over ``idle_minutes``.

    ``items`` is the fixed catalogue. A user's attempts are first reduced to the
    last one per catalogue item, so a user's map never outgrows the catalogue and
    neither the user table nor the attempts are multiplied.
    Result: ``(user, item, idle_minutes)`` with NULL minutes for new items.
    """
    catalogue = F.array(*[F.lit(i) for i in items])
    last = (
        attempts.where(F.col(item).isin(list(items)))
        .groupBy(user, item)
        .agg(F.max(time).alias("_last"))
        .groupBy(user)
        .agg(F.map_from_entries(F.collect_list(F.struct(item, "_last"))).alias("_seen"))
    )
    state = users.select(user).distinct().join(last, user, "left")
    never = F.filter(catalogue, lambda i: F.col("_seen").isNull() | ~F.map_contains_key("_seen", i))
    idle = F.filter(
        F.transform(
            F.map_entries("_seen"),
            lambda e: F.struct(
                e["key"].alias("item"),
                F.timestamp_diff("MINUTE", e["value"], as_of).alias("idle_minutes"),
            ),
        ),
        lambda s: s["idle_minutes"] > idle_minutes,
    )
    fresh = F.transform(
        never, lambda i: F.struct(i.alias("item"), F.lit(None).cast("bigint").alias("idle_minutes"))
    )
    return state.select(user, F.inline(F.when(F.size(never) > 0, fresh).otherwise(idle))).withColumnRenamed(
        "item", item
    )

"""Ordered and incremental work on micro-batches by the batch operators.

A batch goes through the range slices of ``operators.ordered`` like any table, so no task holds a
key's share of it. What one batch hands to the next is a small keyed table: a key's total, its last
event, its newest version, its last emitted row. Those of a batch's keys join it as rows of their
own, ordered before all others, so a hot key needs no join.

All state and output is written per batch id below one path. A batch reads what earlier ids wrote, so a
replayed batch, also after a crash between two writes, gives the same again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.operators import aggregates, ordered, patterns, sequences
from rivulet.session import fresh_dir, settle
from rivulet.sinks.keyed import KeyedTable, newest
from rivulet.sinks.ledger import BatchLedger
from rivulet.streaming import jobs

#: True for a batch's own rows, False for those carried into it
NEW = "_new"
Operator = Callable[[DataFrame], DataFrame]


def plain(schema: T.StructType) -> T.StructType:
    """The same columns without metadata such as a watermark's mark."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])


class Carried:
    """Runs an operator over each batch, led by the rows its keys carry from earlier ones.

    ``run`` takes the batch's rows and the carried ones and gives the output of the new ones;
    ``carry`` takes the same and gives each key's row for later batches.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        rows: T.StructType,
        keys: Sequence[str],
        out: str,
        run: Operator,
        carry: Operator,
    ):
        self.spark = spark
        self.path = path
        self.rows = plain(rows)
        self.keys = list(keys)
        self.table = KeyedTable(spark, f"{path}/carried", self.rows, keys, [c for c in rows.names if c not in keys])
        self.out = BatchLedger(spark, f"{path}/out", T.StructType.fromDDL(out))
        self.run = run
        self.carry = carry

    def write(self, batch: DataFrame, batch_id: int) -> None:
        self.take(settle(batch.select(*self.rows.names), "batch"), batch_id)

    def take(self, rows: DataFrame, batch_id: int) -> None:
        held = self.table.current(batch_id, rows.select(*self.keys).distinct())
        both = rows.withColumn(NEW, F.lit(True)).unionByName(held.withColumn(NEW, F.lit(False)))
        self.out.write(self.run(both), batch_id)
        self.table.upsert(self.carry(both), batch_id)


class EventTime(Carried):
    """Holds rows back until the watermark has passed them, so batches come in event-time order.

    The watermark is ``delay`` seconds behind the latest time seen, in whole milliseconds like the
    engine's; rows that come behind it are dropped, and rows without a time. What has not been passed waits in a table of its own.
    Without ``carry``, passed rows themselves stay for ``keep`` seconds and are handed to ``run``
    again as old rows.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        rows: T.StructType,
        keys: Sequence[str],
        out: str,
        run: Operator,
        time: str,
        delay: int,
        carry: Operator | None = None,
        keep: int = 0,
    ):
        super().__init__(spark, path, rows, keys, out, run, carry or (lambda both: both))
        self.time = time
        self.delay = delay * 1_000_000
        self.keep = None if carry else keep * 1_000_000
        self.marks = KeyedTable(spark, f"{path}/marks", T.StructType.fromDDL("job int, latest bigint, batch bigint"), ["job"], ["batch"])

    def _waiting(self, batch_id: int) -> str:
        return f"{self.path}/waiting/group={batch_id // 1000}/batch={batch_id}"

    def write(self, batch: DataFrame, batch_id: int) -> None:
        micros = F.unix_micros(F.col(self.time).cast("timestamp"))
        mark = self.marks.current(batch_id).first()
        rows = batch.select(*self.rows.names).where(F.col(self.time).isNotNull())
        if mark is not None:
            rows = rows.where(micros > mark.latest - self.delay)
        rows = settle(rows, "batch")
        latest = rows.agg(F.max(micros)).first()[0]
        if latest is None and mark is None:
            return
        passed = None if mark is None else mark.latest - self.delay
        latest = max(t for t in (latest and latest // 1000 * 1000, mark and mark.latest) if t is not None)
        limit = latest - self.delay
        pool = rows
        if mark is not None:
            pool = pool.unionByName(self.spark.read.schema(self.rows).parquet(self._waiting(mark.batch)))
        stays = micros > limit - (self.keep or 0)
        pool.where(stays).write.mode("overwrite").parquet(self._waiting(batch_id))
        due = pool.where(micros <= limit)
        if self.keep is None:
            self.take(due, batch_id)
        else:
            own = F.lit(True) if passed is None else micros > passed
            self.out.write(self.run(due.withColumn(NEW, own)), batch_id)
        now = self.spark.range(1).select(F.lit(0).alias("job"), F.lit(latest).alias("latest"), F.lit(batch_id).alias("batch"))
        self.marks.upsert(now, batch_id)


class ChangeLog:
    """Turns the updates of a keyed aggregate into withdrawals and additions.

    Takes the batches of an update-mode stream, one row per changed key. Each is kept as the key's
    newest version; a key that had another one before gives it back first. A version that did not
    change gives nothing.
    """

    def __init__(self, spark: SparkSession, path: str, updates: T.StructType, keys: Sequence[str]):
        schema = plain(updates)
        self.keys = list(keys)
        self.versions = KeyedTable(spark, f"{path}/versions", schema, keys, [c for c in schema.names if c not in keys])
        self.out = BatchLedger(spark, f"{path}/changes", T.StructType([*schema.fields, T.StructField("is_add", T.BooleanType())]))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        self.versions.upsert(batch, batch_id)
        new = self.versions.batch(batch_id)
        old = self.versions.current(batch_id, new.select(*self.keys))
        both = old.withColumn("is_add", F.lit(False)).unionByName(new.withColumn("is_add", F.lit(True)))
        # a row that is both withdrawn and added has not changed
        same = both.groupBy(*[c for c in both.columns if c != "is_add"])
        changes = same.agg(F.count("*").alias("_n"), F.max("is_add").alias("is_add")).where("_n = 1").drop("_n")
        self.out.write(changes, batch_id)


class DistinctLists:
    """The distinct values of each key in first-seen order, as batches come.

    Keeps the first sequence number of each (key, value). A batch only changes values that are new or were
    seen earlier than known; the lists of their keys are emitted whole, as ``(keys, part, items)``.
    """

    def __init__(self, spark: SparkSession, path: str, rows: T.StructType, keys: Sequence[str], value: str, seq: str):
        self.keys, self.value, self.seq = list(keys), value, seq
        self.seen = KeyedTable(spark, f"{path}/seen", plain(rows), [*keys, value], [seq])
        kinds = [f"`{k}` {rows[k].dataType.simpleString()}" for k in keys]
        self.out = BatchLedger(spark, f"{path}/lists", T.StructType.fromDDL(", ".join([*kinds, "part bigint, items string"])))

    def write(self, batch: DataFrame, batch_id: int) -> None:
        pair = [*self.keys, self.value]
        first = batch.where(F.col(self.value).isNotNull()).groupBy(*pair).agg(F.min(self.seq).alias(self.seq))
        first = settle(first, "first")
        known = self.seen.current(batch_id, first.select(*pair))
        both = first.withColumn(NEW, F.lit(True)).unionByName(known.withColumn(NEW, F.lit(False)))
        old = F.min(F.when(~F.col(NEW), F.col(self.seq)))
        merged = both.groupBy(*pair).agg(F.min(self.seq).alias(self.seq), old.alias("_old"))
        changed = merged.where(F.col("_old").isNull() | (F.col(self.seq) < F.col("_old"))).drop("_old")
        self.seen.upsert(changed, batch_id)
        touched = self.seen.batch(batch_id).select(*self.keys).distinct()
        values = self.seen.current(batch_id + 1, touched)
        lists = aggregates.distinct_list(values, self.keys, self.value, self.seq)
        self.out.write(lists.withColumn("part", F.col("part").cast("bigint")), batch_id)


def output(stream: DataFrame, job, mode: str = "append") -> DataFrame:
    """All output of a job over everything the stream has now, with batch ids."""
    jobs.drain(stream, job.write, mode, f"{fresh_dir(stream.sparkSession, 'job')}/checkpoint")
    return job.out.read()


def running_sums(spark: SparkSession, path: str, schema: T.StructType, key: str, seq: str, value: str) -> Carried:
    """The sum of ``value`` up to each row, ``(key, seq, running)``: by ``seq`` in a batch, then batch by batch."""

    def run(both: DataFrame) -> DataFrame:
        sums = ordered.running_sum(both, [key], [NEW, seq], F.coalesce(value, F.lit(0)), "running")
        return sums.where(NEW).select(key, seq, F.col("running").cast("bigint").alias("running"))

    def carry(both: DataFrame) -> DataFrame:
        return both.groupBy(key).agg(F.max(seq).alias(seq), F.sum(value).cast(schema[value].dataType).alias(value))

    kinds = {c: schema[c].dataType.simpleString() for c in (key, seq)}
    return Carried(spark, path, schema, [key], f"`{key}` {kinds[key]}, `{seq}` {kinds[seq]}, running bigint", run, carry)


def arrival_pairs(
    spark: SparkSession, path: str, schema: T.StructType, within: Column, fail: str = "fail", message: str = "login fail!"
) -> Carried:
    """Adjacent fails in arrival order, given by ``seq``; rows are ``user_id, event_time, seq, kind``."""

    def run(both: DataFrame) -> DataFrame:
        return patterns.consecutive_fails(both, "user_id", "kind", "event_time", [NEW, "seq"], within, fail, message)

    def carry(both: DataFrame) -> DataFrame:
        return newest(both, ["user_id"], [NEW, "seq"])

    user, time = (schema[c].dataType.simpleString() for c in ("user_id", "event_time"))
    out = f"user_id {user}, first_fail {time}, last_fail {time}, warning string"
    return Carried(spark, path, schema, ["user_id"], out, run, carry)


def matches(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    pattern: sequences.Pattern,
    key: str,
    time: str,
    order: Sequence[str],
    columns: Sequence[str],
    delay: int,
) -> EventTime:
    """A pattern's matches in event-time order, once the watermark has passed their last event.

    A match spans less than the pattern's bound, so passed rows stay that long.
    """
    if pattern.bound is None:
        raise ValueError("a pattern on a stream needs a bound")
    last = pattern.steps[-1].name

    def run(both: DataFrame) -> DataFrame:
        found = sequences.match(both, pattern, key, time, order, [*columns, NEW])
        return found.where(F.col(f"{last}.{NEW}")).select(key, *[F.struct(*[f"{s.name}.{c}" for c in columns]).alias(s.name) for s in pattern.steps])

    event = ", ".join(f"{c}: {schema[c].dataType.simpleString()}" for c in columns)
    out = ", ".join([f"`{key}` {schema[key].dataType.simpleString()}", *[f"`{s.name}` struct<{event}>" for s in pattern.steps]])
    return EventTime(spark, path, schema, [key], out, run, time, delay, keep=pattern.bound)


def as_of(
    spark: SparkSession,
    path: str,
    facts: T.StructType,
    history: T.StructType,
    key: str,
    time: str,
    value: str,
    tie: str,
    delay: int,
) -> EventTime:
    """Each fact with the newest version at or before its time, once the watermark has passed it.

    Takes the rows of ``as_of_rows``. Versions the watermark has passed fold into one row per key.
    """
    names = [c for c in facts.names if c not in (key, time)]
    kinds = {c: facts[c].dataType.simpleString() for c in facts.names}
    version = f"_value {history[value].dataType.simpleString()}, _tie {history[tie].dataType.simpleString()}, _side int"
    rows = T.StructType.fromDDL(", ".join([f"`{key}` {kinds[key]}, `{time}` {kinds[time]}", version, *[f"`{c}` {kinds[c]}" for c in names]]))

    def run(both: DataFrame) -> DataFrame:
        known = ordered.last_known(both, [key], [NEW, time, "_side", "_tie"], "_value", "_known")
        return known.where(F.col(NEW) & (F.col("_side") == 1)).select(key, time, *names, F.col("_known").alias(value))

    def carry(both: DataFrame) -> DataFrame:
        return newest(both.where("_side = 0 AND _value IS NOT NULL").select(*rows.names), [key], [time, "_tie"])

    out = ", ".join([f"`{key}` {kinds[key]}, `{time}` {kinds[time]}", *[f"`{c}` {kinds[c]}" for c in names], f"`{value}` {history[value].dataType.simpleString()}"])
    return EventTime(spark, path, rows, [key], out, run, time, delay, carry)


def as_of_rows(rows: DataFrame, version: Column, key: str, time: str, value: str, tie: str, names: Sequence[str]) -> DataFrame:
    """Rows of ``as_of`` from a table or stream that holds versions and facts; a version without a value says nothing."""
    side = F.when(version, 0).otherwise(1)
    return rows.select(
        key, time, F.when(version, F.col(value)).alias("_value"), F.when(version, F.col(tie)).alias("_tie"), side.alias("_side"), *names
    )

"""Streams over several micro-batches against the batch forms."""

import datetime
import os
import random
import shutil

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rivulet.operators import patterns, windows
from rivulet.operators.sequences import Pattern, match
from rivulet.operators.sets import union_distinct_stream
from rivulet.sinks import files
from rivulet.sinks.ledger import BatchLedger
from rivulet.sinks.topics import console_writer
from rivulet.sources import files as file_sources
from rivulet.sources.topics import LOG_SCHEMA, log_table
from rivulet.streaming import carried, jobs, processors
from test_ordered import bursts_of
from test_operators import example_route, example_row_route

EVENT = "user_id bigint, event_time timestamp, seq bigint, kind string"
START = datetime.datetime(2024, 1, 1)


def at(seconds):
    return START + datetime.timedelta(seconds=seconds)


def seconds(stamp):
    return int((stamp - START).total_seconds())


def feed(spark, path, batches, schema):
    """One file per batch, read one per micro-batch in this order."""
    for i, rows in enumerate(batches):
        staged = f"{path}-{i}"
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(staged)
        os.makedirs(path, exist_ok=True)
        part = next(n for n in os.listdir(staged) if n.endswith(".parquet"))
        target = f"{path}/{i:03d}.parquet"
        os.link(f"{staged}/{part}", target)
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    ddl = spark.createDataFrame([], schema).schema
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", 1).parquet(path)


def stream_events(seed, batches=3, disorder=4):
    """Random logins; inside a batch and across batches times are a little out of order."""
    rng = random.Random(seed)
    out, t, seq = [], 0, 0
    for _ in range(batches):
        rows = []
        for _ in range(60):
            t += rng.randrange(3)
            rows.append((rng.randrange(4), at(t - rng.randrange(disorder)), seq, "fail" if rng.random() < 0.7 else "success"))
            seq += 1
        out.append(rows)
    return out


CLOSING = [[(-1, at(10_000_000), -1, "closing")]]


def flat(spark, batches):
    return spark.createDataFrame([r for b in batches for r in b], EVENT)


def schema_of(spark, ddl):
    return spark.createDataFrame([], ddl).schema


def pairs_job(spark, path, interval="INTERVAL 3 SECONDS"):
    return carried.arrival_pairs(spark, path, schema_of(spark, EVENT), F.expr(interval))


@pytest.mark.parametrize("seed", [1, 2])
def test_fails_in_arrival_order_carry_over(spark, fresh, seed):
    batches = stream_events(seed)
    found = carried.output(feed(spark, fresh(), batches, EVENT), pairs_job(spark, fresh("job")))
    want = patterns.consecutive_fails(flat(spark, batches), "user_id", "kind", "event_time", ["seq"], F.expr("INTERVAL 3 SECONDS"))
    got = sorted(tuple(r)[:4] for r in found.collect())
    assert got == sorted(map(tuple, want.collect())) and got
    assert found.select("batch_id").distinct().count() > 1


def pattern_job(spark, path, pattern=None, delay=20):
    pattern = pattern or Pattern.begin("a", F.col("kind") == "fail").next("b", F.col("kind") == "fail").within(7)
    columns = ["event_time", "seq"]
    return carried.matches(spark, path, schema_of(spark, EVENT), pattern, "user_id", "event_time", columns, columns, delay)


@pytest.mark.parametrize("seed", [3, 4])
def test_event_time_pattern_across_batches(spark, fresh, seed):
    batches = stream_events(seed)
    stream = feed(spark, fresh(), batches + CLOSING, EVENT)
    found = carried.output(stream, pattern_job(spark, fresh("job")))
    want = patterns.consecutive_fails(
        flat(spark, batches), "user_id", "kind", "event_time", ["event_time", "seq"], F.expr("INTERVAL 7 SECONDS")
    )
    got = sorted((r.user_id, r.a.event_time, r.b.event_time) for r in found.collect())
    assert got == sorted(tuple(r)[:3] for r in want.collect()) and got
    # Part of the alerts comes out before the stream ends.
    assert found.select("batch_id").distinct().count() > 1


def test_longer_patterns_across_batches(spark, fresh):
    kind = F.col("kind")
    pattern = Pattern.begin("a", kind == "success").followed_by("b", kind == "success").next("c", kind == "fail").within(9)
    batches = stream_events(8, batches=4)
    found = carried.output(feed(spark, fresh(), batches + CLOSING, EVENT), pattern_job(spark, fresh("job"), pattern))
    want = match(flat(spark, batches), pattern, "user_id", "event_time", ["event_time", "seq"], ["seq"])
    ids = [F.col(f"{n}.seq").alias(n) for n in "abc"]
    got = sorted(map(tuple, found.select("user_id", *ids).collect()))
    assert got == sorted(map(tuple, want.select("user_id", *ids).collect())) and got


@pytest.mark.parametrize("seed", [5, 6])
def test_bursts_across_batches(spark, fresh, seed):
    batches = stream_events(seed)
    stream = feed(spark, fresh(), batches + CLOSING, EVENT)
    with processors.rocks_state(spark):
        found = jobs.drained(processors.ordered_bursts(stream, 3, 2, "30 seconds"), "append", "t")
    want = []
    for user in range(4):
        mine = sorted((r[1], r[2], r[3]) for b in batches for r in b if r[0] == user)
        want += [(user, *b) for b in bursts_of([(seconds(t), k) for t, _, k in mine], 3, 2)]
    got = [(r.user_id, seconds(r.first_fail), seconds(r.last_fail), r.fails) for r in found.collect()]
    assert sorted(got) == sorted(want) and got
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


class Handle:
    """Stands for a processor's handle: a list or value in memory, and the timers set."""

    def __init__(self):
        self.kept, self.timers = [], []

    def getListState(self, name, schema):
        return Handle()

    getValueState = getListState

    def registerTimer(self, at):
        self.timers.append(at)

    def appendList(self, rows):
        self.kept += rows

    def put(self, rows):
        self.kept = rows

    def update(self, value):
        self.kept = list(value)

    def exists(self):
        return bool(self.kept)

    def get(self):
        return self.kept

    def clear(self):
        self.kept = []


def test_timers_of_bursts_do_not_grow_with_the_rows():
    handle, job = Handle(), processors.Bursts(3, 2)
    job.init(handle)
    t = np.arange(1000) * 1_000_000
    rows = pd.DataFrame({"none": False, "user": t % 7, "t": t, "seq": t, "fail": True})
    list(job.handleInputRows((0,), iter([rows[:600], rows[600:]]), None))
    assert sorted(set(handle.timers)) == [1000, 601_000]

    class Clock:
        def getCurrentWatermarkInMs(self):
            return 500_000

    handle.timers.clear()
    list(job.handleExpiredTimer((0,), Clock(), None))
    # the earliest second that still waits, and the end of the earliest open burst
    assert 501_000 in handle.timers and len(handle.timers) == 2 and min(handle.timers) > 500_000
    assert sum(len(r[0]) for r in job.waiting.kept) == 500 * processors.WAITING.itemsize


def test_bursts_of_users_and_times_that_are_null(spark, fresh):
    first = [(None, at(1), 1, "fail"), (0, at(1), 2, "fail"), (2**60 + 1, at(2), 3, "fail"), (0, None, 4, "success"), (None, at(2), 5, "fail")]
    second = [(0, at(3), 6, "fail"), (2**60 + 1, at(3), None, "fail"), (2**60 + 1, at(3), 7, "success"), (None, None, 8, "fail")]
    with processors.rocks_state(spark):
        found = processors.ordered_bursts(feed(spark, fresh(), [first, second, *CLOSING], EVENT), 3, 2, "30 seconds", groups=1)
        got = jobs.drained(found, "append", "t").drop("batch_id").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(None, at(1), at(2), 2), (0, at(1), at(3), 2)], key=repr)


def test_seconds_keep_what_follows_their_last_success():
    times = np.array([1_200_000, 1_100_000, 1_300_000, 5_000_000, 5_000_000, 9_000_000])
    seqs, fails = np.array([2, 1, 3, 5, 4, 6]), np.array([False, True, True, True, True, False])
    assert list(processors.per_second(times, seqs, fails)) == [(1, True, 1), (5, False, 2), (9, True, 0)]


def test_rows_behind_the_watermark_are_dropped(spark, fresh):
    batches = [
        [(1, at(0), 0, "fail"), (1, at(100), 1, "success"), (1, None, 9, "fail")],
        [(2, at(200), 2, "success")],
        [(1, at(1), 3, "fail"), (2, at(201), 4, "success")],
    ]
    found = {
        delay: carried.output(feed(spark, fresh(), batches + CLOSING, EVENT), pattern_job(spark, fresh("job"), delay=delay)).collect()
        for delay in (5, 500)
    }
    assert found[5] == []
    assert [(r.user_id, seconds(r.a.event_time), seconds(r.b.event_time)) for r in found[500]] == [(1, 0, 1)]


def test_pattern_state_survives_a_restart(spark, fresh):
    path, checkpoint, out = fresh(), fresh("cp"), fresh("out")
    found = []
    for rows in ([(1, at(0), 0, "fail")], [(1, at(1), 1, "fail")]):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(path)
        job = pairs_job(spark, out)
        jobs.drain(spark.readStream.schema(EVENT).parquet(path), job.write, "append", checkpoint)
        found.append(job.out.read().count())
    assert found == [0, 1]


@pytest.mark.parametrize("kind", ["pairs", "pattern"])
def test_a_replayed_batch_changes_nothing(spark, fresh, rows, kind):
    batches = [flat(spark, [b]) for b in stream_events(9, batches=3) + CLOSING]
    once, again = ({"pairs": pairs_job, "pattern": pattern_job}[kind](spark, fresh(f"job{i}")) for i in range(2))
    for i, batch in enumerate(batches):
        once.write(batch, i)
        again.write(batch, i)
        again.write(batch, i)
    # a crash between the output and the carried rows: the batch is written again from the same state
    shutil.rmtree(f"{again.path}/{'carried' if kind == 'pairs' else 'marks'}/delta/group=0/_batch=3")
    again.write(batches[3], 3)
    assert rows(again.out.read()) == rows(once.out.read()) and once.out.read().count()


def test_changelog_withdraws_before_it_adds(spark, fresh, rows):
    stream = feed(spark, fresh(), [[("a",), ("a",), ("b",)], [("a",)], [("c",), (None,)], [(None,)]], "w string")
    counts = jobs.running_counts(stream, "w")
    changes = carried.output(counts, carried.ChangeLog(spark, fresh("log"), counts.schema, ["w"]), "update")
    want = [(0, "a", True, 2), (0, "b", True, 1), (1, "a", False, 2), (1, "a", True, 3), (2, "c", True, 1), (2, None, True, 1)]
    want += [(3, None, False, 1), (3, None, True, 2)]
    assert rows(changes.select("batch_id", "w", "is_add", "n")) == sorted(want, key=repr)


def test_changelog_leaves_out_what_did_not_change(spark, fresh, rows):
    log = carried.ChangeLog(spark, fresh("log"), schema_of(spark, "w string, n bigint"), ["w"])
    for i, n in enumerate([1, 1, 2]):
        log.write(spark.createDataFrame([("a", n)], "w string, n bigint"), i)
    assert rows(log.out.read()) == [("a", 1, False, 2), ("a", 1, True, 0), ("a", 2, True, 2)]


SUMS = "k string, i bigint, v bigint"


def test_running_sums_go_on_across_batches(spark, fresh, rows):
    stream = feed(spark, fresh(), [[("a", 2, 5), ("a", 1, 1), ("b", 3, 2)], [("a", 4, -3), ("b", 5, None), (None, 6, 1)], [(None, 7, 1)]], SUMS)
    sums = carried.output(stream, carried.running_sums(spark, fresh("job"), schema_of(spark, SUMS), "k", "i", "v"))
    want = [("a", 1, 1), ("a", 2, 6), ("a", 4, 3), ("b", 3, 2), ("b", 5, 2), (None, 6, 1), (None, 7, 2)]
    assert rows(sums.select("k", "i", "running")) == sorted(want, key=repr)


def test_no_task_holds_a_hot_keys_share_of_a_batch(spark, fresh):
    one = spark.range(4000).select(F.lit("hot").alias("k"), F.col("id").alias("i"), F.lit(1).cast("bigint").alias("v"))
    job = carried.running_sums(spark, fresh("job"), schema_of(spark, SUMS), "k", "i", "v")
    for batch in range(2):
        job.write(one.withColumn("i", F.col("i") + 4000 * batch), batch)
    assert job.out.read().agg(F.max("running"), F.count("*")).first() == (8000, 8000)
    plan = job.run(one.withColumn(carried.NEW, F.lit(True)))._jdf.queryExecution().executedPlan().toString()
    windows_ = [line for line in plan.splitlines() if "windowspecdefinition" in line]
    assert windows_ and all("_slice" in line.split("windowspecdefinition")[1] for line in windows_) and "InPandas" not in plan


def test_temporal_join_on_a_stream(spark, fresh):
    rng = random.Random(2)
    rows, t = [], 0
    for seq in range(300):
        t += rng.randrange(3)
        is_rate = rng.random() < 0.3
        value = None if is_rate and rng.random() < 0.1 else float(seq) if is_rate else None
        rows.append((rng.randrange(3), at(t - rng.randrange(4)), seq, "rate" if is_rate else "fact", value))
    ddl = "k int, t timestamp, seq bigint, kind string, rate double"
    batches = [rows[i : i + 60] for i in range(0, 300, 60)] + [[(-1, at(10_000_000), -1, "rate", 0.0)]]
    stream = feed(spark, fresh(), batches, ddl)
    mixed = carried.as_of_rows(stream, F.col("kind") == "rate", "k", "t", "rate", "seq", ["seq"])
    facts, history = (schema_of(spark, d) for d in ("k int, t timestamp, seq bigint", "k int, t timestamp, seq bigint, rate double"))
    found = carried.output(mixed, carried.as_of(spark, fresh("job"), facts, history, "k", "t", "rate", "seq", 20))
    want = []
    for k, when, seq, kind, _ in rows:
        if kind == "fact":
            known = [(u, s, v) for key, u, s, other, v in rows if key == k and other == "rate" and v is not None and u <= when]
            want.append((k, when, seq, max(known)[2] if known else None))
    assert sorted((tuple(r) for r in found.select("k", "t", "seq", "rate").collect()), key=repr) == sorted(want, key=repr)
    assert found.select("batch_id").distinct().count() > 2


def test_distinct_lists_grow_batch_by_batch(spark, fresh, rows):
    ddl = "k string, v string, i bigint"
    batches = [[("a", "x", 5), ("a", "y", 6), ("b", "z", 7), (None, "n", 1)], [("a", "x", 8), ("b", None, 9)], [("a", "w", 3), ("a", "y", 1), (None, "m", 2)]]
    stream = feed(spark, fresh(), batches, ddl)
    lists = carried.output(stream, carried.DistinctLists(spark, fresh("job"), schema_of(spark, ddl), ["k"], "v", "i"))
    want = [(0, "a", "x,y"), (0, "b", "z"), (0, None, "n"), (2, "a", "y,w,x"), (2, None, "n,m")]
    assert rows(lists.select("batch_id", "k", "items")) == sorted(want, key=repr)


def test_distinct_union_remembers_rows_of_long_ago(spark, fresh, rows):
    batches = [[("a", at(0))], [("b", at(61 * 86400))], [("a", at(61 * 86400)), ("c", at(1))]]
    stream = feed(spark, fresh(), batches, "w string, t timestamp").select("w")
    both = union_distinct_stream(stream, stream, ["w"])
    assert rows(jobs.drained(both, "append", "union").select("w")) == [("a",), ("b",), ("c",)]


def test_counts_per_batch_are_not_carried_over(spark, fresh, rows):
    stream = feed(spark, fresh(), [[("a",), ("a",)], [("a",), ("b",)]], "w string")
    book = BatchLedger(spark, fresh("out"), spark.createDataFrame([], "w string, n bigint").schema)
    jobs.drain(stream, jobs.counts_per_batch("w", book), "append", fresh("cp"))
    assert rows(book.read().select("batch_id", "w", "n")) == [(0, "a", 2), (1, "a", 1), (1, "b", 1)]


def test_running_counts_snapshot_is_sorted(spark, fresh):
    stream = feed(spark, fresh(), [[("b",), ("a",)], [("c",), ("c",)]], "w string")
    snapshots = {}

    def keep(df, batch_id):
        snapshots[batch_id] = [tuple(r) for r in df.collect()]

    counts = jobs.running_counts(stream, "w").orderBy(F.desc("n"), "w")
    jobs.drain(counts, keep, "complete", fresh("cp"))
    assert snapshots == {0: [("a", 1), ("b", 1)], 1: [("c", 2), ("a", 1), ("b", 1)]}


def test_append_windows_wait_for_the_watermark(spark, fresh):
    batches = [[(at(1), "x"), (at(2), "x")], [(at(100), "x")], [(at(101), "x")], [(at(3), "x"), (at(500), "x")]]
    stream = feed(spark, fresh(), batches, "t timestamp, b string")
    counted = windows.windowed(stream, "t", "5 seconds", {"pv": F.count("*")}, ["b"], watermark="5 seconds")
    out = jobs.drained(counted, "append", "w")
    got = sorted((seconds(r.window_start), r.pv) for r in out.collect())
    assert got == [(0, 2), (100, 2)]  # the late row is dropped, the newest window is still open


def test_checkpoint_survives_a_restart(spark, fresh, rows):
    path, checkpoint, out = fresh(), fresh("cp"), fresh("out")
    stream = feed(spark, path, [[("a",)]], "w string")
    book = BatchLedger(spark, out, spark.createDataFrame([], "w string, n bigint").schema)
    jobs.drain(jobs.running_counts(stream, "w"), book.write, "update", checkpoint)
    spark.createDataFrame([("a",), ("b",)], "w string").coalesce(1).write.mode("append").parquet(path)
    jobs.drain(jobs.running_counts(spark.readStream.schema("w string").parquet(path), "w"), book.write, "update", checkpoint)
    assert os.path.isdir(f"{checkpoint}/offsets")
    assert rows(jobs.latest_updates(book.read(), ["w"])) == [("a", 2), ("b", 1)]


def test_route_writes_every_end(spark, fresh, rows):
    data = [[('{"topic":"test","value":"a"}',), ('{"topic":"test1","value":"b"}',)], [('{"topic":"both","value":"c"}',)]]
    route = example_route()
    schema = spark.createDataFrame([], "value string").schema
    books = {name: BatchLedger(spark, fresh(name), schema) for name in ("4", "5")}
    for name, book in books.items():
        route.end(name, book.write)
    jobs.drain(feed(spark, fresh(), data, "value string"), route.write, "append", fresh("cp"))
    assert rows(books["4"].read()) == [("a", 0), ("c", 1)] and rows(books["5"].read()) == [("b", 0), ("c", 1)]


def test_row_route_writes_every_end_from_one_pass(spark, fresh, rows):
    data = [[('{"topic":"test","value":"a"}',), ('{"topic":"test1","value":"b"}',)], [('{"topic":"both","value":"c"}',)]]
    route = example_row_route()
    schema = spark.createDataFrame([], "value string").schema
    books = {name: BatchLedger(spark, fresh(name), schema) for name in ("4", "5")}
    for name, book in books.items():
        route.end(name, book.write)
    jobs.drain(feed(spark, fresh(), data, "value string"), route.write, "append", fresh("cp"))
    assert rows(books["4"].read()) == [("a", 0), ("c", 1)] and rows(books["5"].read()) == [("b", 0), ("c", 1)]


def test_standing_job_runs_at_its_cadence(spark, fresh, rows):
    stream = feed(spark, fresh(), [[("a",)], [("a",)]], "w string")
    book = BatchLedger(spark, fresh("out"), spark.createDataFrame([], "w string, n bigint").schema)
    query = jobs.start(jobs.running_counts(stream, "w"), book.write, "complete", fresh("cp"), jobs.FAST)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert rows(book.read()) == [("a", 1, 0), ("a", 2, 1)]


def test_console_end_points(spark, fresh):
    stream = feed(spark, fresh(), [[("a",)]], "value string")
    query = console_writer(stream, prefix="A: ").trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.exception() is None and query.lastProgress.numInputRows >= 0


def test_file_stream_sinks(spark, fresh):
    stream = feed(spark, fresh(), [[(1,)], [(2,)]], "n int")
    orc, parquet = fresh("orc"), fresh("parquet")
    query = files.day_bucket_stream(stream, orc, fresh("cp"), F.lit("2020-05-06").cast("timestamp"))
    query.trigger(availableNow=True).start().awaitTermination()
    assert os.path.isdir(f"{orc}/c_date=2020-05-06") and spark.read.orc(orc).count() == 2
    files.parquet_stream(stream, parquet, fresh("cp")).trigger(availableNow=True).start().awaitTermination()
    assert os.path.isdir(f"{parquet}/_spark_metadata") and spark.read.parquet(parquet).count() == 2


def test_text_stream_and_log_stream(spark, fresh):
    path = fresh()
    os.makedirs(path)
    with open(f"{path}/a.txt", "w") as f:
        f.write("x y\nz\n")
    lines = file_sources.text_lines(spark, path, stream=True)
    assert jobs.drained(lines, "append", "lines").count() == 2
    log = fresh("log")
    spark.createDataFrame([("t", 0, 1, None, None, "v")], LOG_SCHEMA).write.parquet(log)
    assert jobs.drained(log_table(spark, log, stream=True), "append", "log").first().value == "v"


def test_tables_are_read_file_by_file(spark, fresh):
    path = fresh()
    spark.range(1000).repartition(4).write.parquet(f"{path}/t.parquet")
    counts = jobs.running_counts(jobs.table_stream(spark, path, "t", 2), F.lit("all"))
    seen = jobs.drained(counts, "update", "files").select("batch_id", "n").collect()
    assert len(seen) == 2 and max(r.n for r in seen) == 1000

"""Sinks: layout, replay, upsert, transactions."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from rivulet.sinks import files, jdbc, keyed, ledger, tables, topics
from rivulet.sources import files as file_sources
from rivulet.sources import tables as table_sources
from rivulet.sources import topics as topic_sources


def names(path, suffix):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(suffix)]


def test_partition_paths_and_codecs(spark, fresh, rows):
    df = spark.createDataFrame([("ADR", "role", 1), ("IOS", "login", 2)], "platform string, event string, n int")
    path = fresh()
    files.partitioned(df, path, ["platform", "event"])
    assert os.path.isdir(f"{path}/platform=ADR/event=role")
    assert all("snappy" in n for n in names(path, ".parquet"))
    assert rows(spark.read.parquet(path).select("platform", "event", "n")) == [("ADR", "role", 1), ("IOS", "login", 2)]
    orc = fresh()
    files.partitioned(df, orc, [], "orc")
    assert all("zlib" in n for n in names(orc, ".orc")) and spark.read.orc(orc).count() == 2


def test_a_hot_partition_is_spread_over_files(spark, fresh):
    df = spark.range(1000).select(F.lit("2020-01-01").alias("c_date"), "id")
    path = fresh()
    files.partitioned(df, path, ["c_date"], max_rows=100)
    assert len(names(path, ".parquet")) >= 10
    assert spark.read.parquet(path).count() == 1000


def test_clock_day_is_the_writers(spark):
    df = spark.createDataFrame([(0,)], "t bigint").select(F.timestamp_seconds("t").alias("t"))
    assert files.with_clock_day(df).first().c_date > "2020-01-01"
    assert files.with_clock_day(df, F.col("t")).first().c_date == "1970-01-01"


def test_success_marks_in_touched_partitions(spark, fresh, rows):
    path = fresh()
    sink = files.committing_partitions(path, ["dt", "h"])
    first = spark.createDataFrame([(1, "2020-01-01", "07"), (2, "2020-01-01", "08")], "n int, dt string, h string")
    sink(first, 0)
    assert files.committed_partitions(spark, path, ["dt", "h"]) == [("2020-01-01", "07"), ("2020-01-01", "08")]
    assert os.path.exists(f"{path}/dt=2020-01-01/h=07/_SUCCESS")
    sink(spark.createDataFrame([(3, "2020-01-01", "07")], first.schema), 1)
    sink(first, 0)
    stored = spark.read.schema("n int, dt string, h string, batch_id int").orc(path)
    assert rows(stored.select("n", "h", "batch_id")) == [(1, "07", 0), (2, "08", 0), (3, "07", 1)]


def test_only_finished_partitions_are_marked(spark, fresh):
    path = fresh()
    sink = files.committing_partitions(path, ["h"], finished=lambda df: df.where("h < 9 OR h IS NULL"))
    sink(spark.createDataFrame([(1, 7), (2, 8), (3, 9), (4, None)], "n int, h int").repartition(3), 0)
    assert files.committed_partitions(spark, path, ["h"]) == [("7",), ("8",), ("__HIVE_DEFAULT_PARTITION__",)]
    assert spark.read.orc(path).count() == 4


def test_csv_and_text_rows(spark, fresh, rows):
    df = spark.createDataFrame([(1, "a b", None), (2, "c", "d")], "n int, s string, t string")
    path = fresh()
    files.csv_rows(df, path)
    assert rows(spark.read.schema(df.schema).csv(path, sep=" ")) == [(1, "a b", None), (2, "c", "d")]
    text = fresh()
    files.text_rows(df.select("n", F.col("s").alias("value")), text, "value", ["n"])
    assert os.path.isdir(f"{text}/n=2") and file_sources.text_lines(spark, text).count() == 2
    assert files.single_file(spark.range(100, numPartitions=5)).rdd.getNumPartitions() == 1


def test_replaced_partitions_leave_others_alone(spark, fresh, rows):
    path = fresh()
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    files.partitioned(df, path, ["p"])
    files.replace_partitions(spark.createDataFrame([(9, "b")], df.schema), path, ["p"])
    assert rows(spark.read.parquet(path).select("n", "p")) == [(1, "a"), (9, "b")]


def test_catalog_tables(spark, fresh, rows):
    table_sources.create_table(spark, "sales", "n int, app string, dt string", "orc", {"orc.compress": "ZLIB"}, ["app", "dt"], fresh())
    df = spark.createDataFrame([(1, "x", "d1"), (2, "x", "d2"), (3, "y", "d1")], "n int, app string, dt string")
    tables.insert_into(df, "sales", ["n", "app", "dt"])
    tables.overwrite_partition(df.select((F.col("n") + 10).alias("n")), "sales", {"app": "x", "dt": "d2"}, ["n"])
    got = table_sources.partition_scan(spark, "sales", {"app": "x", "dt": "d2"})
    assert sorted(r.n for r in got.collect()) == [11, 12, 13]
    assert "PartitionFilters: [isnotnull(app" in got._jdf.queryExecution().toString()
    assert spark.table("sales").count() == 5
    assert [r.n for r in tables.fetch(tables.as_view(df, "v").orderBy("n"), 2)] == [1, 2]
    spark.sql("DROP TABLE sales")


DOC = "id string, word string, count int, seq bigint"


def test_upserts_keep_the_newest_row_per_key(spark, fresh, rows):
    schema = spark.createDataFrame([], DOC).schema
    table = keyed.KeyedTable(spark, fresh(), schema, ["id"], ["seq"])
    assert table.current().count() == 0
    one = spark.createDataFrame([("a", "x", 1, 1), ("a", "y", 2, 2), ("b", "z", 3, 3)], schema)
    two = spark.createDataFrame([("a", "w", 9, 0)], schema)
    table.upsert(one, 0)
    table.upsert(two, 1)
    table.upsert(one, 0)  # a replay
    expected = [("a", "w", 9, 0), ("b", "z", 3, 3)]
    assert rows(table.current()) == expected
    assert rows(table.current(before=1)) == [("a", "y", 2, 2), ("b", "z", 3, 3)]
    table.compact()
    assert rows(table.current()) == expected
    table.upsert(spark.createDataFrame([("c", "q", 1, 1)], schema), 2)
    assert rows(table.current()) == [*expected, ("c", "q", 1, 1)]
    slim = keyed.without_fields(table.current(), "word")
    assert slim.columns == ["id", "count", "seq"]
    nested = table.current().select(F.struct("id", "word").alias("d")).select(keyed.without_nested(F.col("d"), "word").alias("d"))
    assert nested.schema["d"].dataType.names == ["id"]


def test_folding_a_replayed_batch_leaves_the_base_alone(spark, fresh, rows):
    schema = spark.createDataFrame([], "id bigint, seq bigint").schema
    table = keyed.KeyedTable(spark, fresh(), schema, ["id"], ["seq"], fold_every=3)
    for batch in range(8):
        table.upsert(spark.createDataFrame([(batch % 2, batch), (100 + batch, batch)], schema), batch)
    expected = sorted([(0, 6), (1, 7), *[(100 + b, b) for b in range(8)]], key=repr)
    assert rows(table.current()) == expected and table._parts(None) == (5, [6, 7])
    bases = {d: os.stat(d).st_mtime_ns for d in glob.glob(f"{table.path}/base/*/_SUCCESS")}
    table.upsert(spark.createDataFrame([(0, 6), (106, 6)], schema), 6)  # a replay that folds
    assert rows(table.current()) == expected and len(bases) == 2
    assert bases == {d: os.stat(d).st_mtime_ns for d in glob.glob(f"{table.path}/base/*/_SUCCESS")}


def test_merged_tables_take_columns_and_removals(spark, fresh, rows):
    schema = spark.createDataFrame([], "id int, a string, b int").schema
    table = keyed.MergedTable(spark, fresh(), schema, ["id"], fold_every=3)

    def df(data, ddl):
        return spark.createDataFrame(data, ddl)

    steps = [
        table.full(df([(1, "x", 1), (2, "y", None), (3, "z", 3), (None, "n", 0)], "id int, a string, b int")),
        table.partial(df([(1, 10), (None, 9)], "id int, b int")),
        table.removed(df([(2,), (3,)], "id int")).unionByName(table.partial(df([(1, None)], "id int, a string"))),
        table.partial(df([(3, 30)], "id int, b int")),
        table.full(df([(2, None, 2)], "id int, a string, b int")).unionByName(table.removed(df([(None,)], "id int"))),
    ]
    want = [
        [(1, "x", 1), (2, "y", None), (3, "z", 3), (None, "n", 0)],
        [(1, "x", 10), (2, "y", None), (3, "z", 3), (None, "n", 9)],
        [(1, None, 10), (None, "n", 9)],
        [(1, None, 10), (3, None, 30), (None, "n", 9)],
        [(1, None, 10), (2, None, 2), (3, None, 30)],
    ]
    for batch, (step, expected) in enumerate(zip(steps, want)):
        table.upsert(step, batch)
        table.upsert(step, batch)  # a replay
        assert rows(table.rows()) == sorted(expected, key=repr)
    table.compact()
    assert rows(table.rows()) == sorted(want[-1], key=repr) and table._parts(None)[0] == 4


def test_ledger_of_many_batches_stays_short(spark, fresh):
    schema = spark.createDataFrame([], "n bigint").schema
    book = ledger.BatchLedger(spark, fresh(), schema, group=10)
    for batch in range(65):
        book.write(spark.range(1).toDF("n"), batch)
    book.write(spark.range(5).toDF("n"), 3)  # a replay of a folded batch
    found = book.read()
    assert sorted(r.batch_id for r in found.collect()) == list(range(65))
    folded, single = book._layout()
    assert len(folded) == 5 and len(single) == 15


def test_ledger_takes_a_batch_once(spark, fresh, rows):
    schema = spark.createDataFrame([], "value string, total int, insert_time timestamp").schema
    book = ledger.BatchLedger(spark, fresh(), schema)
    assert book.read().count() == 0
    counts = spark.createDataFrame([("a", 2)], "w string, n bigint")
    book.write(ledger.transaction_rows(counts, "w", "n"), 0)
    before = rows(book.read())
    book.write(ledger.transaction_rows(counts, "w", "n"), 0)
    assert rows(book.read()) == before and book.batches() == [0]


def test_ledger_shows_nothing_of_a_failed_batch(spark, fresh):
    schema = spark.createDataFrame([], "n bigint").schema
    book = ledger.BatchLedger(spark, fresh(), schema)
    broken = spark.range(10).select(F.expr("if(id > 5, raise_error('stop'), id)").cast("bigint").alias("n"))
    with pytest.raises(Exception):
        book.write(broken, 0)
    assert not book.committed(0) and book.read().count() == 0
    book.write(spark.range(3).toDF("n"), 0)
    assert book.read().count() == 3


class Recorder:
    """Stands in for a DB-API connection and notes what it is told."""

    def __init__(self, known=(), fail_on=None):
        self.known, self.fail_on, self.log = set(known), fail_on, []

    def cursor(self):
        return self

    def execute(self, text):
        if self.fail_on and self.fail_on in text:
            raise RuntimeError("refused")
        self.log.append(text)

    def fetchone(self):
        return (1 if any(f"= {i}" in self.log[-1] for i in self.known) else 0,)

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def test_jdbc_batch_commits_once():
    new = Recorder()
    assert jdbc.commit_batch(lambda: new, "ledger", 7, ["INSERT a"])
    assert new.log[1:] == ["INSERT a", "INSERT INTO ledger (batch_id) VALUES (7)", "commit", "close"]
    done = Recorder(known=[7])
    assert not jdbc.commit_batch(lambda: done, "ledger", 7, ["INSERT a"])
    assert "INSERT a" not in done.log and "commit" not in done.log
    bad = Recorder(fail_on="INSERT a")
    with pytest.raises(RuntimeError):
        jdbc.commit_batch(lambda: bad, "ledger", 7, ["INSERT a"])
    assert bad.log[-2:] == ["rollback", "close"]


def test_jdbc_statements_and_options():
    assert jdbc.merge_statement("t1", "s1", ["id"], ["id", "v"]) == (
        "MERGE INTO t1 t USING s1 s ON t.id = s.id WHEN MATCHED THEN UPDATE SET t.v = s.v "
        "WHEN NOT MATCHED THEN INSERT (id, v) VALUES (s.id, s.v)"
    )
    assert jdbc.insert_statement("t1", "s1", ["a", "b"]) == "INSERT INTO t1 (a, b) SELECT a, b FROM s1"
    options = table_sources.jdbc_options("jdbc:x", "score", "drv", ("id", 0, 1000, 8))
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8" and options["driver"] == "drv"


def test_routed_records(spark, rows):
    lines = spark.createDataFrame([("test,k1,x",), ("test1,k2",), ("solo",)], "value string")
    assert rows(topics.routed_records(lines)) == [
        ("solo", None, "solo"), ("test", "k1", "test,k1,x"), ("test1", "k2", "test1,k2"),
    ]
    assert rows(topics.json_records(spark.createDataFrame([(1, "a")], "n int, s string"), "t")) == [("t", '{"n":1,"s":"a"}')]
    assert rows(topics.prefixed(lines, "A: "))[0] == ("A: solo",)


def test_topic_subscription(spark, rows):
    data = [("t1", 0, o, None, None, f"v{o}") for o in range(3)] + [("t2", 1, 5, None, None, "w")]
    log = spark.createDataFrame(data, topic_sources.LOG_SCHEMA)
    assert topic_sources.of_topics(log, ["t1"]).count() == 3
    assert topic_sources.of_topics(log, pattern="t.").count() == 4 and topic_sources.of_topics(log, pattern="t").count() == 0
    start = topic_sources.parse_offsets("partition:0,offset:2;partition:1,offset:300", "t1")
    assert start == {"t1": {0: 2, 1: 300}}
    assert sorted(r.value for r in topic_sources.from_position(log, start).collect()) == ["v2", "w"]
    assert rows(topic_sources.next_positions(log)) == [("t1", 0, 3), ("t2", 1, 6)]
    options = topic_sources.kafka_options("h:1", ["a", "b"], start={"a": {0: 42}})
    assert options["subscribe"] == "a,b" and options["startingOffsets"] == '{"a": {"0": 42}}'
    assert topic_sources.kafka_options("h:1", pattern="x.*", start="earliest")["subscribePattern"] == "x.*"
    with pytest.raises(ValueError):
        topic_sources.kafka_options("h:1")


def test_generated_messages(spark):
    messages = table_sources.generated_messages(spark, 50_000)
    assert messages.count() == 50_000 and {r.value for r in messages.select("value").distinct().collect()} == {"a"}
    assert table_sources.generated_stream(spark).isStreaming


def test_json_lines_need_a_schema_on_streams(spark, fresh):
    with pytest.raises(ValueError):
        file_sources.json_lines(spark, fresh(), stream=True)

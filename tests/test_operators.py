"""Small worked examples of the batch operators."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from rivulet.functions.text import java_tokens
from rivulet.operators import aggregates, joins, predicates, sets, windows
from rivulet.operators.exports import ExportSource, ExportSpec, ExportTarget, event_day, index_writer, run_exports
from rivulet.operators.patterns import consecutive_fails
from rivulet.operators.routing import Route, RowRoute, late_split
from rivulet.operators.sequences import Pattern, match
from rivulet.sinks.keyed import MergedTable, put_cells
from rivulet.sources.tables import one_cell, point_get, wide_rows


def at(seconds):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=seconds)


def test_word_count(spark, rows):
    lines = spark.createDataFrame([("a b",), ("c",), ("d",), ("a b c",)], "value string")
    assert rows(aggregates.word_counts(lines)) == [("a", 2), ("b", 2), ("c", 2), ("d", 1)]


@pytest.mark.parametrize(
    "line, tokens",
    [
        ("a b", ["a", "b"]),
        ("a  ", ["a"]),
        (" a", ["", "a"]),
        ("a  b", ["a", "", "b"]),
        ("", [""]),
        ("   ", None),
    ],
)
def test_token_rule(spark, line, tokens):
    df = spark.createDataFrame([(line,)], "value string")
    assert df.select(java_tokens(F.col("value"))).first()[0] == tokens


def test_sum_of_frequencies(spark, rows):
    words = spark.createDataFrame([("hello", 1), ("hello", 1), ("ciao", 1)], "word string, frequency bigint")
    summed = spark.sql("SELECT word, sum(frequency) AS frequency FROM {w} GROUP BY word", w=words)
    assert rows(summed) == [("ciao", 1), ("hello", 2)]


def test_conditional_sums_keep_null_and_empty_apart(spark, rows):
    schema = "name string, be string, count bigint"
    sources = {
        "all": spark.createDataFrame([("一中", None, 122), ("二中", "bj", 1), ("三中", "hn", 1)], schema),
        "tea": spark.createDataFrame([("一中", "", 5), ("二中", "bj", 7)], schema),
        "stu": spark.createDataFrame([("一中", "", 8), ("三中", "hn", 9)], schema),
    }
    tagged = aggregates.tagged_union(sources)
    sums = aggregates.conditional_sums(tagged, ["name", "be"], "count", {"all_count": "all", "tea_count": "tea"})
    expected = [("一中", None, 122, 0), ("一中", "", 0, 5), ("二中", "bj", 1, 7), ("三中", "hn", 1, 0)]
    assert rows(sums) == sorted(expected, key=repr)


def test_full_merge_prefers_the_first_side(spark, rows):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 5)], "ref int, p string, q int")
    b = spark.createDataFrame([(1, "z", 7), (3, "w", 8)], "ref int, p string, q int")
    merged = aggregates.full_merge(a, b, ["ref"], ["p", "q"])
    assert rows(merged) == [(1, "x", 7), (2, "y", 5), (3, "w", 8)]


def test_max_starts_at_the_floor(spark, rows):
    df = spark.createDataFrame([("a", -5), ("a", -1), ("b", 3), ("c", None)], "k string, v int")
    assert rows(df.groupBy("k").agg(aggregates.max_with_floor("v").alias("m"))) == [("a", 0), ("b", 3), ("c", 0)]


def test_distinct_list_in_first_seen_order(spark, rows):
    data = [(1, "b", 1), (1, "a", 2), (1, "b", 3), (2, None, 4), (2, "z", 5)]
    df = spark.createDataFrame(data, "u int, r string, seq int")
    assert rows(aggregates.distinct_list(df, ["u"], "r", "seq")) == [(1, 0, "b,a"), (2, 0, "z")]


def test_group_sums_as_map(spark):
    df = spark.createDataFrame([("a", "x", 1.1), ("a", "x", 2.2), ("a", "y", 3.0), ("a", "new", 1.0), ("a", None, 5.0)], "k string, i string, v double")
    sums = aggregates.group_sums_as_map(df, "k", "i", "v").first()["sums"]
    assert sums == {"x": 3.3, "y": 3.0, "new": 1.0}


def test_top_counts_break_ties_by_key(spark):
    df = spark.createDataFrame([(w,) for w in "b a c c".split()], "w string")
    assert [tuple(r) for r in aggregates.top_counts(df, "w").collect()] == [("c", 2), ("a", 1), ("b", 1)]


def test_multiset_difference(spark, rows):
    a = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 5, 6, 6]], "v int")
    b = spark.createDataFrame([(v,) for v in [1, 2, 3, 4, 6]], "v int")
    assert rows(sets.except_multiset(a, b)) == [(5,), (6,)]
    assert rows(sets.except_distinct(a, b)) == [(5,)]
    assert rows(sets.key_difference(a, b, ["v"])) == [(5,)]
    assert sets.union_rows(a, b).count() == 12 and sets.union_distinct(a, b).count() == 6


def test_predicates(spark, rows):
    data = [(1, "x", None), (2, "y", "k"), (3, "y", "z"), (4, "w", None)]
    df = spark.createDataFrame(data, "t int, task string, cls string")
    nested = predicates.bool_query(
        must=[
            predicates.in_range("t", gte=1, lt=4),
            predicates.bool_query(
                should=[
                    predicates.term("task", "x"),
                    predicates.bool_query(must=[predicates.term("task", "y"), predicates.term("cls", "k")]),
                ]
            ),
        ]
    )
    assert rows(df.where(nested).select("t")) == [(1,), (2,)]
    assert rows(df.where(predicates.in_values("t", [1, 4])).select("t")) == [(1,), (4,)]
    assert df.where(predicates.in_values("t", [])).count() == 0
    assert df.where(predicates.bool_query()).count() == 4
    both = predicates.bool_query(must=[predicates.term("t", 1)], should=[predicates.term("t", 2)])
    assert rows(df.where(both).select("t")) == [(1,)]


LOGINS = [
    # user, kind, time: in arrival order user 1 succeeds between its fails, by time it does not.
    (1, "fail", 842),
    (1, "success", 844),
    (1, "fail", 843),
    (2, "fail", 100),
    (2, "fail", 107),
    (3, "fail", 200),
    (3, "fail", 203),
    (4, "fail", 300),
    (4, "fail", 290),
    (5, "fail", 400),
    (5, "fail", 401),
    (5, "fail", 402),
]


@pytest.fixture
def logins(spark):
    data = [(u, k, t, i) for i, (u, k, t) in enumerate(LOGINS)]
    return spark.createDataFrame(data, "user bigint, kind string, t bigint, seq bigint")


def pairs(df):
    return sorted((r.user, r.first_fail, r.last_fail) for r in df.collect())


def test_fails_in_arrival_order(logins):
    got = consecutive_fails(logins, "user", "kind", "t", ["seq"], F.lit(3))
    # Exactly 3 s apart is outside; an earlier time than the previous one is inside.
    assert pairs(got) == [(4, 300, 290), (5, 400, 401), (5, 401, 402)]


def test_fails_in_event_time_order(logins):
    got = consecutive_fails(logins, "user", "kind", "t", ["t", "seq"], F.lit(7))
    assert pairs(got) == [(1, 842, 843), (3, 200, 203), (5, 400, 401), (5, 401, 402)]
    assert {r.warning for r in got.collect()} == {"login fail!"}


def test_rates_at_the_end_of_history(spark, rows):
    history = spark.createDataFrame(
        [("US Dollar", 1, 102), ("Euro", 2, 114), ("Yen", 3, 1), ("Euro", 4, 116), ("Euro", 5, 119)],
        "currency string, t bigint, rate bigint",
    )
    facts = spark.createDataFrame(
        [("Euro", 9, "a"), ("Yen", 9, "b"), ("US Dollar", 9, "c"), ("Euro", 4, "d"), ("Euro", 1, "e"), ("Won", 9, "f")],
        "currency string, t bigint, id string",
    )
    joined = joins.as_of_join(facts, history, "currency", "t", "rate", ["id"]).select("id", "rate")
    assert rows(joined) == [("a", 119), ("b", 1), ("c", 102), ("d", 116), ("e", None), ("f", None)]


def test_lookups(spark, rows):
    facts = spark.createDataFrame([(1000, "good0c"), (1001, "good1c")], "id int, click string")
    dim = spark.createDataFrame([(1000, "ann")], "key int, name string")
    assert rows(joins.lookup_join(facts, dim, "id", "key")) == [(1000, "good0c", "ann")]
    assert rows(joins.lookup_join(facts, dim, "id", "key", "left"))[1] == (1001, "good1c", None)
    with pytest.raises(ValueError):
        joins.lookup_join(facts, dim, "id", "key", "full")


def test_every_cell_of_a_row_counts(spark, rows):
    cells = spark.createDataFrame(
        [("r", "info", "b", 1, "2"), ("r", "info", "a", 1, "old"), ("r", "info", "a", 2, "1"), ("r", "more", "a", 1, "3"), ("s", "x", "y", 1, "z")],
        "rowkey string, family string, qualifier string, ts bigint, value string",
    )
    assert rows(joins.concat_cells(cells)) == [("r", "123"), ("s", "z")]


def test_composed_lookup_concatenates_cells_and_keeps_misses(spark, rows):
    users = spark.createDataFrame([(1000, "ann", "30"), (1002, "bob", None)], "id int, name string, age string")
    keyed = users.withColumn("rowkey", joins.compose_key("userInfo", "userId", F.col("id"), "userName"))
    cells = put_cells(keyed, "rowkey", "info", ["name", "age"], F.lit(1).cast("bigint"))
    older = cells.withColumns({"ts": F.lit(0).cast("bigint"), "value": F.lit("old")})
    entries = joins.concat_cells(cells.union(older))
    asked = spark.createDataFrame([(1000,), (1001,), (1002,)], "id int")
    found = joins.composed_lookup(asked, "id", entries, "userInfo", "userId", "userName")
    constant = found.select("key", "value", F.lit("aaa").alias("tag"))
    assert rows(constant) == [
        ("userInfo:userId:1000:userName", "30ann", "aaa"),
        ("userInfo:userId:1001:userName", None, "aaa"),
        ("userInfo:userId:1002:userName", "bob", "aaa"),
    ]


def test_left_chain_does_not_match_null_keys(spark, rows):
    a = spark.createDataFrame([("x", None), ("y", "b")], "name string, be string")
    t = spark.createDataFrame([("x", None, 1), ("y", "b", 2)], "name string, be string, tea int")
    s = spark.createDataFrame([("y", "b", 3)], "name string, be string, stu int")
    assert rows(joins.using_left_chain(a, [t, s], ["name", "be"])) == [("x", None, None, None), ("y", "b", 2, 3)]


def test_unattempted_items(spark, rows):
    now = F.lit("2019-03-01 00:00:00").cast("timestamp")
    items = [str(i) for i in range(12)]
    at = datetime.datetime
    attempts = [("u", "3", at(2019, 1, 11)), ("u", "5", at(2019, 2, 11)), ("u", "other", at(2019, 2, 1))]
    attempts += [("v", i, at(2019, 2, 28, 23, 30 + int(i))) for i in items]
    df = spark.createDataFrame(attempts, "user string, item string, t timestamp")
    users = spark.createDataFrame([("u",), ("v",), ("w",)], "user string")
    got = rows(joins.unattempted(users, df, "user", "item", "t", items, now, 20))
    assert [r[1] for r in got if r[0] == "u"] == sorted(set(items) - {"3", "5"})
    assert [r[1:] for r in got if r[0] == "v"] == [(str(i), 30 - i) for i in range(10)]
    assert len([r for r in got if r[0] == "w"]) == 12


def test_lateral_keeps_rows_without_matches(spark, rows):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "id int, s string")
    attrs = F.transform(F.split("s", ","), lambda a: F.struct(a.alias("attr")))
    assert rows(joins.lateral(df, attrs).select("id", "attr")) == [(1, "a"), (1, "b"), (2, None)]
    assert joins.lateral(df, attrs, keep_empty=False).count() == 2


def test_sliding_windows_are_aligned_to_the_epoch(spark, rows):
    df = spark.createDataFrame([("x", 3)], "b string, s bigint").withColumn("t", F.timestamp_seconds("s"))
    got = windows.windowed(df, "t", "5 seconds", {"n": F.count("*")}, ["b"], "2 seconds")
    starts = sorted(r[0] for r in got.select(F.unix_seconds("window_start")).collect())
    assert starts == [0, 2]


def test_whole_window_keeps_the_first_label(spark):
    df = spark.createDataFrame([("b", 1, 0), ("a", 2, 1)], "w string, n int, seq int")
    stamped = windows.on_clock(df, F.timestamp_seconds(F.col("seq")))
    row = windows.whole_window_sum(stamped, "clock", "5 seconds", F.col("n"), "w", "seq").first()
    assert (row.w, row.total) == ("b", 3)


def example_route():
    return (
        Route()
        .point("1", lambda df: df.select(F.from_json("value", "topic string, value string").alias("r")).select("r.*"))
        .point("2", lambda df: df.select("value"))
        .point("3", lambda df: df.select("value"))
        .end("4")
        .end("5")
        .edge("1", "2", F.col("topic") == "test")
        .edge("2", "4")
        .edge("1", "3", F.col("topic").isin("test1", "both"))
        .edge("3", "5")
        .edge("1", "2", F.col("topic") == "both")
    )


def test_route_by_topic(spark, rows):
    data = [('{"topic":"%s","value":"%s"}' % p,) for p in [("test", "a"), ("test1", "b"), ("none", "c"), ("both", "d")]]
    route = example_route()
    assert route.roots() == ["1"]
    got = route.combined(spark.createDataFrame(data, "value string"))
    assert rows(got) == [("4", "a"), ("4", "d"), ("5", "b"), ("5", "d")]


def test_route_rejects_bad_graphs(spark):
    with pytest.raises(ValueError):
        Route().point("a", lambda df: df).edge("a", "missing")
    with pytest.raises(ValueError):
        Route().end("e").point("a", lambda df: df).edge("e", "a")
    loop = Route().point("r", lambda d: d).point("a", lambda d: d).point("b", lambda d: d).end("e")
    loop.edge("r", "a").edge("a", "b").edge("b", "a")
    with pytest.raises(ValueError):
        loop.ends(spark.range(1))


def example_row_route():
    def value(row):
        return F.struct(row["value"].alias("value"))

    return (
        RowRoute()
        .point("1", lambda row: F.from_json(row["value"], "topic string, value string"))
        .point("2", value)
        .point("3", value)
        .end("4")
        .end("5")
        .edge("1", "2", lambda row: row["topic"] == "test")
        .edge("2", "4")
        .edge("1", "3", lambda row: row["topic"].isin("test1", "both"))
        .edge("3", "5")
        .edge("1", "2", lambda row: row["topic"] == "both")
    )


def test_row_route_is_one_scan(spark, rows, fresh):
    data = [('{"topic":"%s","value":"%s"}' % p,) for p in [("test", "a"), ("test1", "b"), ("none", "c"), ("both", "d")]] + [(None,), ("bad",)]
    path = fresh()
    spark.createDataFrame(data, "value string").write.parquet(path)
    route = example_row_route()
    assert route.roots() == ["1"] and route.ordered()[0] == "1"
    got = route.combined(spark.read.parquet(path))
    assert rows(got) == rows(example_route().combined(spark.read.parquet(path))) == [("4", "a"), ("4", "d"), ("5", "b"), ("5", "d")]
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_row_route_follows_every_path_of_a_diamond(spark, rows):
    def plus(n):
        return lambda row: F.struct((row["n"] + n).alias("n"))

    route = RowRoute().point("r", plus(0)).point("a", plus(10)).point("b", plus(20)).point("c", plus(100)).end("e").end("rest")
    route.edge("r", "a").edge("r", "b", lambda row: row["n"] > 1).edge("a", "c").edge("b", "c").edge("c", "e").edge("c", "rest", lambda row: row["n"] > 121)
    got = route.combined(spark.createDataFrame([(1,), (2,), (None,)], "n long"), "at")
    assert rows(got) == sorted([("e", 111), ("e", 112), ("e", 122), ("e", None), ("rest", 122)], key=repr)
    assert route.ordered()[-3:] != ["a", "b", "c"] and route.ordered().index("c") > max(route.ordered().index(p) for p in "ab")


def test_row_route_rejects_bad_graphs(spark):
    with pytest.raises(ValueError):
        RowRoute().point("a", lambda row: row).edge("a", "missing")
    with pytest.raises(ValueError):
        RowRoute().end("e").point("a", lambda row: row).edge("e", "a")
    loop = RowRoute().point("r", lambda r: r).point("a", lambda r: r).point("b", lambda r: r).end("e")
    loop.edge("r", "a").edge("a", "b").edge("b", "a")
    with pytest.raises(ValueError):
        loop.combined(spark.range(1))
    with pytest.raises(ValueError):
        RowRoute().point("a", lambda r: r).point("b", lambda r: r).edge("a", "b").combined(spark.range(1))


def matches_of(rows, steps, bound):
    """Plain walk: for each row that fits the first step, the row each later step takes."""
    found = []
    for user in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == user), key=lambda r: (r[1], r[2]))
        for i, row in enumerate(mine):
            if row[3] not in steps[0][0]:
                continue
            taken, at_ = [row], i
            for kinds, strict in steps[1:]:
                later = range(at_ + 1, len(mine))
                nxt = next((j for j in later if mine[j][3] in kinds), None)
                if strict:
                    nxt = at_ + 1 if at_ + 1 < len(mine) and mine[at_ + 1][3] in kinds else None
                if nxt is None:
                    break
                taken.append(mine[nxt])
                at_ = nxt
            if len(taken) == len(steps) and taken[-1][1] - taken[0][1] < bound:
                found.append((user, *[r[2] for r in taken]))
    return sorted(found)


@pytest.mark.parametrize("slices", [1, 4, 40])
@pytest.mark.parametrize("strict", [(False, False), (True, False), (False, True), (True, True)])
def test_patterns_match_a_plain_walk(spark, slices, strict):
    rng = random.Random(slices)
    data = [(0 if rng.random() < 0.6 else rng.randrange(5), rng.randrange(60), i, rng.choice("abcx")) for i in range(160)]
    kind = F.col("kind")
    pattern = Pattern.begin("one", kind == "a")
    steps = [("a", False)]
    for name, k, s in zip(("two", "three"), "bc", strict):
        pattern = pattern.next(name, kind == k) if s else pattern.followed_by(name, kind == k)
        steps.append((k, s))
    df = spark.createDataFrame([(u, at(t), i, k) for u, t, i, k in data], "u int, t timestamp, i int, kind string").repartition(3)
    got = match(df, pattern.within(30), "u", "t", ["t", "i"], ["i", "kind"], slices)
    ids = [F.col(f"{s.name}.i").alias(s.name) for s in pattern.steps]
    assert sorted(map(tuple, got.select("u", *ids).collect())) == matches_of(data, steps, 30)


def test_patterns_with_nulls_and_one_step(spark, rows):
    df = spark.createDataFrame([(1, at(1), 0, "a"), (1, None, 1, "a"), (None, at(2), 2, "a"), (1, at(3), 3, None)], "u int, t timestamp, i int, kind string")
    one = Pattern.begin("x", F.col("kind") == "a")
    assert rows(match(df, one, "u", "t", ["t", "i"], ["i"]).select("x.i")) == [(0,), (1,), (2,)]
    two = one.followed_by("y", F.col("kind") == "a")
    assert rows(match(df, two, "u", "t", ["t", "i"], ["i"]).select("x.i", F.col("y.i").alias("j"))) == [(1, 0)]
    with pytest.raises(ValueError):
        two.next("x", F.lit(True))


def test_late_rows_get_a_message(spark, rows):
    df = spark.createDataFrame([("1", 950), ("2", 900), ("3", 100)], "id string, time bigint")
    tagged = late_split(df, F.lit(1000) - F.col("time"), 100, F.concat(F.lit("late: "), F.col("id")))
    assert rows(tagged.select("id", "output", "message")) == [
        ("1", "main", None), ("2", "late", "late: 2"), ("3", "late", "late: 3"),
    ]


def test_exports_skip_members_that_are_no_specs(spark, rows):
    tables = {"ads": spark.createDataFrame([("p", 1, 2), ("q", 3, 4)], "part string, a int, b int")}
    spec = ExportSpec(ExportSource("ads", {"part": "p"}, ("a", "b")), ExportTarget("index_a", "id", {}, {"a": "id"}))
    none = ExportSpec(ExportSource("ads", {}, ("a",), lambda: F.lit(1) == 0), ExportTarget("index_b", "a"))
    written = {}
    done = run_exports([spec, "plain", none], tables.get, lambda target, df: written.update({target.index: df}))
    assert done == ["index_a", "index_b"]
    assert rows(written["index_a"]) == [(1, 2)] and written["index_a"].columns == ["id", "b"]
    assert written["index_b"].count() == 0
    days = spark.createDataFrame([("yys", "2020-05-23", ""), ("yys", "2020-05-23", "x")], "app string, dt string, event string")
    assert days.where(event_day("yys", "2020-05-23")).count() == 1


def test_exports_delete_and_update_documents(spark, rows, fresh):
    tables = {
        "docs": spark.createDataFrame([(1, "on", 5), (2, "off", 6), (3, "on", 7), (4, None, 8)], "id int, state string, n int"),
        "more": spark.createDataFrame([(1, 50), (9, 90)], "id int, n int"),
        "gone": spark.createDataFrame([(3, "off", 0)], "id int, state string, n int"),
    }
    index = MergedTable(spark, fresh(), spark.createDataFrame([], "id int, state string, n int").schema, ["id"])
    full = ExportTarget("x", "id", {"state": "off"})
    registry = [
        ExportSpec(ExportSource("docs", {}, ("id", "state", "n")), full),
        ExportSpec(ExportSource("more", {}, ("id", "n")), ExportTarget("x", "id", partial=True)),
        ExportSpec(ExportSource("gone", {}, ("id", "state", "n")), full),
    ]
    assert run_exports(registry, tables.get, index_writer({"x": index})) == ["x"] * 3
    assert rows(index.rows()) == sorted([(1, "on", 50), (4, None, 8), (9, None, 90)], key=repr)
    assert rows(index.rows(before=1)) == sorted([(1, "on", 5), (3, "on", 7), (4, None, 8)], key=repr)


def test_wide_rows_and_point_gets(spark, rows):
    cells = spark.createDataFrame(
        [("r1", "info", "name", 1, "old"), ("r1", "info", "name", 2, "new"), ("r1", "info", "age", 1, "7"),
         ("r2", "info", "age", 1, "8"), ("r2", "x", "name", 9, "no")],
        "rowkey string, family string, qualifier string, ts bigint, value string",
    )
    wide = wide_rows(cells, "info", ["name", "age"])
    assert rows(wide.select("rowkey", "info.*")) == [("r1", "new", "7"), ("r2", None, "8")]
    assert rows(one_cell(cells, "info", "name")) == [("r1", "info", "name", 2, "new")]
    keys = spark.createDataFrame([("r1",), ("r9",)], "rowkey string")
    assert rows(point_get(keys, wide.select("rowkey", "info.name"), "rowkey", ["name"])) == [("r1", "new"), ("r9", None)]

"""Per-key ordered operators against plain loops, over many slices and few."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from rivulet.operators import aggregates, joins, ordered, patterns

SCHEMA = "k string, seq bigint, t bigint, kind string, v bigint"


def skewed(seed, n=400, ties=False):
    """A third of all rows belong to one key; times are out of order and may repeat."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(20)}"
        t = rng.randrange(n // 10 if ties else 10 * n)
        kind = "fail" if rng.random() < 0.6 else "success"
        rows.append((key, seq, t, kind, rng.randrange(-50, 50)))
    return rows


def by_key(rows, order):
    ordered_rows = sorted(rows, key=lambda r: (r[0], *order(r)))
    return itertools.groupby(ordered_rows, key=lambda r: r[0])


@pytest.fixture(params=[(1, 60), (2, 7), (3, 1)], ids=["many slices", "some slices", "one slice"])
def case(request, spark):
    seed, slices = request.param
    data = skewed(seed)
    return data, spark.createDataFrame(data, SCHEMA).repartition(3), slices


def sizes(df, keys, order, slices):
    found = ordered.with_slices(df, keys, order, slices).groupBy("_slice").count()
    return [r["count"] for r in found.collect()]


@pytest.mark.parametrize(
    "key, seq",
    [
        ("CAST(NULL AS INT)", "id"),
        ("IF(id % 3 = 0, -1, id % 997)", "id"),
        ("1", "CAST(NULL AS BIGINT)"),
        ("1", "IF(id % 100 = 0, id, 5)"),
        ("id % 30000", "1"),
    ],
    ids=["null key", "a third in one key", "null order", "99 % ties", "many keys"],
)
@pytest.mark.parametrize("equal", [False, True], ids=["other columns", "equal rows"])
def test_slices_are_even_whatever_the_keys(spark, key, seq, equal):
    df = spark.range(0, 60_000, 1, 6).selectExpr(f"{key} AS k", f"{seq} AS seq", "1 AS v" if equal else "id AS v")
    got = sizes(df, ["k"], ["seq"], 20)
    assert sum(got) == 60_000 and len(got) > 15 and max(got) < 6000


def test_slices_follow_the_order(spark):
    df = spark.createDataFrame(skewed(5), SCHEMA)
    spans = ordered.with_slices(df, ["k"], ["t"], 30).groupBy("k", "_slice").agg(
        F.min("t").alias("lo"), F.max("t").alias("hi")
    )
    for _, group in itertools.groupby(sorted((r.k, r._slice, r.lo, r.hi) for r in spans.collect()), lambda r: r[0]):
        group = list(group)
        assert all(a[3] <= b[2] for a, b in zip(group, group[1:]))


def test_running_sum(case):
    data, df, slices = case
    expected = []
    for _, group in by_key(data, lambda r: (r[1],)):
        total = 0
        for r in group:
            total += r[4]
            expected.append((r[1], total))
    got = ordered.running_sum(df, ["k"], ["seq"], F.col("v"), "s", slices)
    assert sorted((r.seq, r.s) for r in got.collect()) == sorted(expected)


def test_previous_row(case):
    data, df, slices = case
    expected = []
    for _, group in by_key(data, lambda r: (r[2], r[1])):
        before = None
        for r in group:
            expected.append((r[1], before))
            before = (r[3], r[1])
    got = ordered.previous_row(df, ["k"], ["t", "seq"], ["kind", "seq"], "p", slices)
    assert sorted((r.seq, tuple(r.p) if r.p else None) for r in got.collect()) == sorted(expected)


def test_null_order_values_come_first(spark):
    data = [("hot", None if seq % 7 == 0 else seq * 3, seq, 1) for seq in range(200)]
    df = spark.createDataFrame(data, "k string, t bigint, seq bigint, v bigint")
    got = ordered.running_sum(df, ["k"], ["t", "seq"], F.col("v"), "s", 20).collect()
    want = sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    assert sorted((r.seq, r.s) for r in got) == sorted((r[2], i) for i, r in enumerate(want, 1))


def test_last_known(case):
    data, df, slices = case
    sparse = df.withColumn("v", F.when(F.col("v") > 25, F.col("v")))
    expected = []
    for _, group in by_key(data, lambda r: (r[1],)):
        known = None
        for r in group:
            known = r[4] if r[4] > 25 else known
            expected.append((r[1], known))
    got = ordered.last_known(sparse, ["k"], ["seq"], "v", "known", slices)
    assert sorted((r.seq, r.known) for r in got.collect()) == sorted(expected)


def test_lists_keep_everything_in_order(case):
    data, df, slices = case
    parts = ordered.ordered_lists(df, ["k"], ["seq"], F.col("v"), "vs", 9, slices).collect()
    for key, group in by_key(data, lambda r: (r[1],)):
        want = [r[4] for r in group]
        mine = sorted((p.part, p.vs) for p in parts if p.k == key)
        assert mine == [(i // 9, want[i : i + 9]) for i in range(0, len(want), 9)]


@pytest.mark.parametrize("n, parts", [(0, []), (9, [9]), (10, [10]), (11, [10, 1]), (200, [10] * 20)])
@pytest.mark.parametrize("key", [None, "k"])
@pytest.mark.parametrize("null_order", [False, True])
def test_parts_are_numbered_alike_for_every_size(spark, n, parts, key, null_order):
    df = spark.createDataFrame([(key, None if null_order else i, 7) for i in range(n)], "k string, seq bigint, v int")
    got = ordered.ordered_lists(df, ["k"], ["seq"], F.col("v"), "vs", 10, 5).collect()
    assert sorted((r.part, len(r.vs)) for r in got) == list(enumerate(parts))


def test_changelog(case):
    data, df, slices = case
    expected = []
    for key, group in by_key(data, lambda r: (r[1],)):
        for n, r in enumerate(group, 1):
            if n > 1:
                expected.append((key, r[1], False, n - 1))
            expected.append((key, r[1], True, n))
    got = aggregates.changelog_of_counts(df, ["k"], ["seq"], slices).select("k", "seq", "is_add", "n")
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("slices", [50, 1])
def test_as_of_join(spark, ties, slices):
    data = skewed(7, ties=ties)
    df = spark.createDataFrame(data, SCHEMA)
    facts, history = df.where("kind = 'fail'"), df.where("kind = 'success'")
    expected = []
    for r in data:
        if r[3] == "fail":
            earlier = [h for h in data if h[3] == "success" and h[0] == r[0] and h[2] <= r[2]]
            best = max(earlier, key=lambda h: (h[2], h[1]), default=None)
            expected.append((r[1], best[4] if best else None))
    rates = history.select("k", "t", F.col("v").alias("rate"), "seq")
    got = joins.as_of_join(facts.select("k", "t", "seq"), rates, "k", "t", "rate", ["seq"], "seq", slices)
    assert sorted((r.seq, r.rate) for r in got.collect()) == sorted(expected)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_is_a_plain_lookup(spark, how):
    data = [*skewed(21), (None, 900, 1, "fail", 1), *[("absent", 901 + i, 1, "fail", 1) for i in range(50)]]
    facts = spark.createDataFrame(data, SCHEMA)
    dimension = spark.createDataFrame([("hot", "h"), ("k1", "one"), ("k2", "two")], "key string, name string")
    plain = joins.lookup_join(facts, dimension, "k", "key", how)
    salted = joins.salted_lookup_join(facts, dimension, "k", "key", how, 7)
    assert salted.columns == plain.columns
    assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


@pytest.mark.parametrize("order", [["seq"], ["t", "seq"]], ids=["arrival", "event time"])
def test_consecutive_fails(case, order):
    data, df, slices = case
    timed = df.withColumn("t", F.col("t").cast("bigint"))
    position = {"seq": 1, "t": 2}
    expected = []
    for key, group in by_key(data, lambda r: tuple(r[position[o]] for o in order)):
        before = None
        for r in group:
            if before and r[3] == before[3] == "fail" and r[2] < before[2] + 700:
                expected.append((key, before[2], r[2]))
            before = r
    got = patterns.consecutive_fails(timed, "k", "kind", "t", order, F.lit(700), slices=slices)
    assert sorted((r.k, r.first_fail, r.last_fail) for r in got.collect()) == sorted(expected)


def bursts_of(events, span, least):
    """Plain walk over one key's events in order."""
    found, burst = [], None
    for t, kind in events:
        if burst and t > burst[0] + span:
            found.append(burst)
            burst = None
        if kind != "fail":
            burst = None
        else:
            burst = (burst[0], t, burst[2] + 1) if burst else (t, t, 1)
    return [b for b in [*found, *([burst] if burst else [])] if b[2] >= least]


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("slices", [50, 1])
def test_fail_bursts(spark, ties, slices):
    data = skewed(11, ties=ties)
    df = spark.createDataFrame(data, SCHEMA).withColumn("at", F.timestamp_seconds("t"))
    span = 3 if ties else 300
    expected = []
    for key, group in by_key(data, lambda r: (r[2], r[1])):
        expected += [(key, *b) for b in bursts_of([(r[2], r[3]) for r in group], span, 2)]
    got = patterns.fail_bursts(df, "k", "kind", "at", ["at", "seq"], span, 2, slices=slices)
    seconds = got.select("k", F.unix_seconds("first_fail"), F.unix_seconds("last_fail"), "fails")
    assert sorted(tuple(r) for r in seconds.collect()) == sorted(expected)
    assert expected


def test_bursts_of_a_key_that_never_succeeds(spark):
    data = [("k", i, t, "fail", 0) for i, t in enumerate(sorted(random.Random(3).randrange(20_000) for _ in range(900)))]
    df = spark.createDataFrame(data, SCHEMA).withColumn("at", F.timestamp_seconds("t"))
    got = patterns.fail_bursts(df, "k", "kind", "at", ["at", "seq"], 40, 2, slices=20)
    seconds = got.select(F.unix_seconds("first_fail"), F.unix_seconds("last_fail"), "fails")
    assert sorted(tuple(r) for r in seconds.collect()) == sorted(bursts_of([(r[2], "fail") for r in data], 40, 2))

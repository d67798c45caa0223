"""N-gram Jaccard join, exact duplicates, repeated byte strings and spread lines."""

import hashlib
import random
import re
import string
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from helpers import AWKWARD, table, words

from rivulet.llm import exact, jaccard, linededup, linking, repeats


def shingles(text, n=3):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def expected_groups(texts, n, threshold):
    sets = [shingles(t, n) for t in texts]
    links = [[] for _ in texts]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and Fraction(len(a & b), len(a | b)) >= threshold:
                links[i].append(j)
                links[j].append(i)
    label = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i, near in enumerate(links):
            least = min([label[i], *(label[j] for j in near)])
            changed |= least != label[i]
            label[i] = least
    return [(i, len(s), label[i], len(links[i])) for i, s in enumerate(sets)]


def near_copies(seed, count, size, edits, vocabulary=400):
    rng = random.Random(seed)
    base = [f"v{rng.randrange(vocabulary)}" for _ in range(size)]
    out = []
    for _ in range(count):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(len(copy))] = f"u{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("n, threshold, block_bytes", [(3, "0.9", 4 << 20), (5, "0.8", 2048)])
def test_jaccard_groups_match_brute_force(spark, n, threshold, block_bytes):
    texts = AWKWARD + near_copies(1, 60, 150, 4) + near_copies(2, 30, 12, 1) + near_copies(3, 30, 30, 3) + near_copies(4, 20, 700, 40)
    df = table(spark, texts).repartition(5)
    got = jaccard.similar_groups(df, n=n, threshold=threshold, block_bytes=block_bytes)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert sorted(tuple(r) for r in got.collect()) == expected_groups(texts, n, Fraction(threshold))


def test_partenum_signatures_meet_for_every_linked_pair():
    rng = np.random.default_rng(5)
    for threshold in (Fraction("0.9"), Fraction("0.8")):
        for size in [*range(1, 60), 143, 500, 2001]:
            a = np.sort(rng.integers(1, 1 << 63, size, dtype=np.uint64))
            most = int(size * (1 - threshold))  # elements that may go
            b = np.sort(rng.choice(a, size - most, replace=False))
            bounds = np.array([0, len(a), len(a) + len(b)])
            rows, marks = jaccard.signatures(np.concatenate([a, b]), bounds, threshold)
            assert not len(b) or set(marks[rows == 0].tolist()) & set(marks[rows == 1].tolist())


def test_partenum_is_complete_at_the_threshold_for_many_partitions():
    rng = np.random.default_rng(8)
    for threshold, sizes in ((Fraction("0.8"), range(70, 330)), (Fraction("0.9"), range(150, 400, 2))):
        for size in sizes:  # up to twenty partitions and more, most with few elements
            a = np.unique(rng.integers(1, 1 << 63, size, dtype=np.uint64))
            b = np.sort(rng.choice(a, len(a) - int(len(a) * (1 - threshold)), replace=False))
            rows, marks = jaccard.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), threshold)
            assert set(marks[rows == 0].tolist()) & set(marks[rows == 1].tolist())


@pytest.mark.parametrize("chunks", [1, 2, 7])
def test_meetings_in_packets_tie_every_name_to_its_hub(chunks):
    rng = np.random.default_rng(chunks)
    marks, names = rng.integers(0, 300, 900).astype(np.uint64), rng.integers(0, 40, 900)
    state = tuple(np.empty(0, kind) for kind in (np.uint64, np.int64, np.int64, np.int64))
    pairs, several = set(), set()
    for a, b in zip(np.array_split(marks, chunks), np.array_split(names, chunks)):
        (reps, hubs, more), state = jaccard.meetings(a, b, state)
        pairs |= set(zip(reps.tolist(), hubs.tolist()))
        several |= {(r, h) for r, h, m in zip(reps.tolist(), hubs.tolist(), more.tolist()) if m}
    hub_of = dict(zip(state[0].tolist(), state[1].tolist()))
    want, want_several = set(), set()
    for mark in set(marks.tolist()):
        own = set(names[marks == mark].tolist())
        ties = {(n, hub_of[mark]) for n in own if n != hub_of[mark]}
        want |= ties
        want_several |= ties if len(own) > 2 else set()
    assert pairs == want and several == want_several


def test_jaccard_tells_colliding_words_apart(spark):
    words_ = ["".join("ab"[(p.bit_count() + turn) & 1] for p in range(2048)) for turn in (0, 1)]
    texts = [*words_, *[f"{w} x" for w in words_], *[f"{w} x" for w in words_]]
    got = jaccard.similar_groups(table(spark, texts))
    assert sorted(tuple(r) for r in got.collect()) == expected_groups(texts, 3, Fraction("0.9"))


def test_jaccard_on_empty_null_and_repeated_ids(spark):
    assert jaccard.similar_groups(table(spark, [])).count() == 0
    df = table(spark, ["a b c d", "a b c d", "a b c d", None], ids=[7, 7, None, 9])
    got = sorted((tuple(r) for r in jaccard.similar_groups(df).collect()), key=repr)
    assert got == sorted([(7, 2, 7, 0), (7, 2, 7, 0), (None, 2, None, 0), (9, 0, 9, 0)], key=repr)


@pytest.mark.parametrize("block_bytes", [4096, 8, 1])
def test_exact_duplicates(spark, block_bytes):
    texts = [t and t[:3000] for t in AWKWARD] + ["a  b", "a\t\nb", " a b", "a b ", "x" * 100, "x" * 99 + "y", "x" * 100]
    rows = {
        r.doc_id: tuple(r) for r in exact.exact_duplicates(table(spark, texts).repartition(3), block_bytes=block_bytes).collect()
    }
    plain = [re.sub("[\x20\x09-\x0d]+", " ", t or "") for t in texts]
    for i, t in enumerate(plain):
        same = [j for j, u in enumerate(plain) if u == t]
        assert rows[i] == (i, same[0], len(same), same[0] == i, hashlib.sha256(t.encode()).hexdigest())


def test_exact_duplicates_keep_one_of_repeated_and_null_ids(spark):
    assert exact.exact_duplicates(table(spark, [])).count() == 0
    got = exact.exact_duplicates(table(spark, ["a", "a", "a", "b"], ids=[5, 5, None, None])).collect()
    a = [r for r in got if r.group_size == 3]
    assert sorted((r.kept, r.keep_id) for r in a) == [(False, 5), (False, 5), (True, 5)]
    assert [(r.kept, r.keep_id) for r in got if r.group_size == 1] == [(True, None)]


def expected_repeats(ids, texts, length):
    content = [(t or "").encode() for t in texts]
    first = {}
    for i, c in sorted(zip(ids, content)):
        for s in range(len(c) - length + 1):
            first.setdefault(c[s : s + length], i)
    out = []
    for i, c in zip(ids, content):
        gone = [False] * len(c)
        for s in range(len(c) - length + 1):
            if first[c[s : s + length]] < i:
                gone[s : s + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(c, gone) if not g)
        out.append((i, len(c), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot, block_bytes", [(256, 4 << 20), (0, 4000), (2, 4000)])
def test_repeats_match_brute_force(spark, hot, block_bytes):
    rng = random.Random(9)

    def prose(n):
        return " ".join("".join(rng.choice("abcdeéß日") for _ in range(rng.randrange(1, 7))) for _ in range(n))

    passages = [prose(30) for _ in range(3)] + ["ab" * 60, "z" * 130]
    texts = [None, "", "short", "z" * 49, "z" * 50]
    for _ in range(60):
        parts = [prose(rng.randrange(20))]
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(0, 40)
            parts += [p[a : a + rng.randrange(30, 140)], prose(rng.randrange(12))]
        texts.append(rng.choice(["", " "]).join(parts))
    texts += [texts[-1], texts[-1], texts[20]]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    ids[-1] = ids[-2]  # one id twice
    got = repeats.remove_repeats(table(spark, texts, ids=ids).repartition(4), hot=hot, block_bytes=block_bytes).drop("kept")
    assert sorted(tuple(r) for r in got.collect()) == expected_repeats(ids, texts, 50)


def test_repeats_with_null_ids_and_empty_table(spark):
    assert repeats.remove_repeats(table(spark, [])).count() == 0
    got = repeats.remove_repeats(table(spark, ["q" * 60, "q" * 60, "q" * 60], ids=[None, None, 3])).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in got) == [(-1, 60), (-1, 60), (3, 0)]


def test_suffix_order_sorts_by_content():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 600).astype(np.uint8)
    starts = rng.integers(0, 560, 400)
    groups = np.sort(rng.integers(0, 7, 400))
    groups = np.unique(groups, return_inverse=True)[1]
    order = repeats.suffix_order(data, repeats.prefix_hashes(data), starts, groups, 30)
    key = lambda i: (groups[i], data[starts[i] : starts[i] + 30].tobytes())
    assert [key(i) for i in order] == sorted(map(key, range(400)))


def test_spread_lines_go_but_the_first(spark):
    common, near, local = "this line is everywhere", "this one is on two", "on one site only here"
    texts = [f"{common}\nown a b {i}\n{local if i < 4 else ''}\n{near if i in (0, 9) else ''}" for i in range(10)]
    sources = ["s0" if i < 4 else f"s{i}" for i in range(10)]
    df = table(spark, texts + [None, "", common], sources=sources + ["s1", None, None], ids=[*range(10), 10, 11, 12])
    got = {r.doc_id: r for r in linededup.line_dedup(df, min_sites=3).collect()}
    assert got[0].text == texts[0] and got[0].n_removed_lines == 0
    for i in range(1, 10):
        assert got[i].text == texts[i].removeprefix(common + "\n") and got[i].n_removed_lines == 1
    assert got[10].text is None and got[11].text == "" and (got[12].text, got[12].n_removed_lines) == ("", 1)
    assert set(df.columns) < set(linededup.line_dedup(df).columns)
    assert linededup.line_dedup(table(spark, [])).count() == 0


def test_short_and_blank_lines_stay_and_repeated_rows_are_alike(spark):
    texts = ["a b\n\nthe same line", "a b\n\nthe same line", "a b\n\nthe same line ", "the same line"]
    df = table(spark, texts, sources=["x", "x", "y", "z"], ids=[1, 1, 2, None])
    got = linededup.line_dedup(df, min_sites=3).orderBy("doc_id").collect()
    assert sorted((r.doc_id or -1, r.text) for r in got) == [(-1, ""), (1, texts[0]), (1, texts[0]), (2, "a b\n")]


def test_signatures_are_sent_in_few_bytes():
    rng = random.Random(5)
    texts = [" ".join(rng.choice(string.ascii_letters) * rng.randrange(1, 9) for _ in range(300)) for _ in range(50)]
    width = jaccard.name_bytes(len(texts))
    sign = jaccard._signer(5, Fraction("0.8"), 0, width, 4)
    sent = list(sign(iter([pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(texts)], ["id", "text"])])))
    marks = sum(len(m.as_py()) for b in sent for m in b.column("marks")) // 4
    names = [jaccard.unpacked_names(v.as_py(), width) for b in sent for v in b.column("names")]
    assert sum(len(v) for v in names) == marks > 50 * 200
    assert sum(len(v.as_py()) for b in sent for c in ("marks", "names") for v in b.column(c)) <= 10 * marks
    assert len(set(np.concatenate(names).tolist())) == 50
    assert [jaccard.name_bytes(n) for n in (0, 50, 250_000, 10**8, 10**12)] == [4, 4, 5, 8, 8]
    some = np.array([0, 1, 2**40 - 1])
    assert jaccard.unpacked_names(jaccard.packed_names(some, 5), 5).tolist() == some.tolist()


def test_full_sets_are_made_only_where_sketches_leave_a_link(spark):
    rng = np.random.default_rng(3)
    base = np.unique(rng.integers(0, 2**63, 400, np.uint64))
    near, far = np.sort(np.append(base[:-10], rng.integers(0, 2**63, 10, np.uint64))), np.unique(rng.integers(0, 2**63, 400, np.uint64))
    twin = np.sort(np.append(far[5:], rng.integers(0, 2**63, 5, np.uint64)))
    other = np.unique(rng.integers(0, 2**63, 400, np.uint64))
    held = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate([base, near, far, twin, other])], "rep long, content binary")
    asked = []

    def sets(reps):
        asked.append({r.rep for r in reps.collect()})
        return held.join(reps, "rep")

    pairs = spark.createDataFrame([(1, 0, True), (2, 0, True), (3, 0, True), (4, 0, True)], "rep long, hub long, several boolean")
    found = linking.confirmed(pairs, linking.sketched(held), sets, Fraction("0.8"))
    assert sorted(tuple(sorted(r)) for r in found.collect()) == [(0, 1), (2, 3)]
    assert asked == [{0, 1}, {2, 3}]


def test_sketches_part_large_sets_that_do_not_link(spark):
    rng = np.random.default_rng(4)

    def like(own, share, size):
        return np.unique(np.append(rng.permutation(own)[: int(share * len(own))], rng.integers(0, 2**63, size, np.uint64)))

    base = np.unique(rng.integers(0, 2**63, 6000, np.uint64))
    contents = [base, like(base, 0.9, 500), like(base, 0.7, 1500), like(base, 0.7, 1900), like(base, 0.5, 9000)]
    held = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate(contents)], "rep long, content binary")
    asked = []

    def sets(reps):
        asked.append({r.rep for r in reps.collect()})
        return held.join(reps, "rep")

    pairs = spark.createDataFrame([(i, 0, True) for i in range(1, 5)], "rep long, hub long, several boolean")
    found = linking.confirmed(pairs, linking.sketched(held), sets, Fraction("0.8"))
    assert [tuple(r) for r in found.collect()] == [(1, 0)]
    assert asked == [{0, 1}, set()]


@pytest.mark.parametrize("sizes", [(1000, 1100), (1020, 1030), (2040, 2060), (4000, 4300), (200_000, 210_000)])
def test_folded_sketches_never_exceed_the_difference(sizes):
    rng = np.random.default_rng(5)
    a = np.unique(rng.integers(0, 2**63, sizes[0], np.uint64))
    b = np.unique(np.append(a[50:], rng.integers(0, 2**63, sizes[1] - sizes[0] + 50, np.uint64)))
    x, y = (np.frombuffer(linking.sketch(v), np.uint64).reshape(1, -1) for v in (a, b))
    words = min(x.shape[1], y.shape[1])
    differ = int(np.bitwise_count(linking.folded(x, words) ^ linking.folded(y, words)).sum())
    most = len(np.setxor1d(a, b))
    assert differ <= most and (most - differ) % 2 == 0 and x.shape[1] <= linking.MOST_SKETCH_WORDS
    assert linking.folded(y, linking.SKETCH_WORDS).tolist() == linking.sketches([b]).tolist()


def test_sets_linked_over_any_hub_are_not_compared_again(spark):
    rng = np.random.default_rng(6)
    near = [np.unique(rng.integers(0, 2**63, 400, np.uint64))]
    for _ in range(3):
        near.append(np.sort(np.append(near[0][:-6], rng.integers(0, 2**63, 6, np.uint64))))
    far = np.unique(rng.integers(0, 2**63, 400, np.uint64))
    held = spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in enumerate([far, *near])], "rep long, content binary")
    asked = []

    def sets(reps):
        asked.append({r.rep for r in reps.collect()})
        return held.join(reps, "rep")

    # 2, 3 and 4 link to 1; all share buckets with 0, which links to none
    rows = [(i, 1, False) for i in (2, 3, 4)] + [(i, 0, True) for i in (1, 2, 3, 4)]
    pairs = spark.createDataFrame(rows, "rep long, hub long, several boolean")
    found = linking.confirmed(pairs, linking.sketched(held), sets, Fraction("0.8"))
    assert sorted(tuple(r) for r in found.collect()) == [(2, 1), (3, 1), (4, 1)]
    assert asked == [{1, 2, 3, 4}, set()]

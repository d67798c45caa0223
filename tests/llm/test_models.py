"""Benchmark decontamination, language model and the pipeline."""

import collections
import math
import pickle
import random
import tracemalloc
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import AWKWARD, table, words

import corpus_pipeline
from rivulet.llm import leaks, lm

SF_DIR = "/root/testdata/sf0.001"


def word_distance(item, text):
    """Least word edit distance of the item to any stretch of the text."""
    costs = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, v in enumerate(text, 1):
            new.append(min(costs[j - 1] + (w != v), costs[j] + 1, new[-1] + 1))
        costs = new
    return min(costs)


def planted(seed=3):
    rng = random.Random(seed)
    common = ["the", "of", "and", "in", "to"]

    def prose(n):
        return [rng.choice(common) if rng.random() < 0.4 else f"w{rng.randrange(3000)}" for _ in range(n)]

    items = [prose(rng.randrange(8, 60)) for _ in range(40)]
    texts, truth = [], set()
    for d in range(240):
        text = prose(rng.randrange(5, 200))
        if d % 2:
            k = rng.randrange(len(items))
            copy = list(items[k])
            for _ in range(rng.randrange(int(leaks.EDIT_SHARE * len(copy)) + 1)):
                at = rng.randrange(len(copy))
                rng.choice([lambda: copy.pop(at), lambda: copy.insert(at, "odd"), lambda: copy.__setitem__(at, "odd")])()
            at = rng.randrange(len(text))
            text[at:at] = copy
        texts.append(text)
        truth |= {(d, k) for k, item in enumerate(items) if word_distance(item, text) <= int(leaks.EDIT_SHARE * len(item))}
    return items, texts, truth


def test_leaks_reach_the_recall_and_are_exact(spark):
    items, texts, truth = planted()
    df = table(spark, [" ".join(t).title() + "." for t in texts])
    benchmark = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)] + [(100, None), (101, ""), (102, "a b")], "item_id long, text string")
    found = leaks.find_leaks(df, benchmark).collect()
    pairs = {(r.doc_id, r.item_id) for r in found}
    assert pairs <= truth and len(pairs) >= 0.95 * len(truth) and len(truth) >= 120
    for r in found:
        assert word_distance(items[r.item_id], texts[r.doc_id]) <= r.edits
    blocks = leaks.find_leaks(df, benchmark, block_bytes=3000)
    assert {(r.doc_id, r.item_id) for r in blocks.collect()} <= truth and blocks.count() >= 0.95 * len(truth)
    clean = leaks.without_leaks(df, benchmark)
    assert clean.columns == df.columns
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in pairs}


def test_leaks_on_awkward_texts(spark):
    benchmark = spark.createDataFrame([(1, "one two three four five six"), (1, "one two three four five six")], "item_id long, text string")
    df = table(spark, AWKWARD + ["ONE two, three four five six!", "three four five six"], ids=[None] * len(AWKWARD) + [5, 6])
    assert sorted(tuple(r) for r in leaks.find_leaks(df, benchmark).collect()) == [(5, 1, 0, 0)] * 2
    assert leaks.find_leaks(table(spark, []), benchmark).count() == 0
    assert leaks.find_leaks(df, benchmark.where("item_id > 1")).count() == 0
    assert leaks.without_leaks(df, benchmark).count() == len(AWKWARD) + 1


def test_short_items_are_found_word_by_word(spark):
    items = ["a b", "b a", "b", "A, b!", "x y z w", "日本語", "...", "a b c d e"]
    texts = ["a b a", "b", "q x y z w q", "x y z", "日本語 です", "日本語です", "a", None, "a b c d e"]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = sorted(tuple(r) for r in leaks.find_leaks(table(spark, texts), benchmark).collect())
    short = [(0, 0, 0, 0), (0, 1, 0, 1), (0, 2, 0, 1), (0, 3, 0, 0), (1, 2, 0, 0), (2, 4, 0, 1), (4, 5, 0, 0), (8, 0, 0, 0), (8, 2, 0, 1), (8, 3, 0, 0)]
    assert [r for r in found if r[1] != 7] == short and (8, 7, 0, 0) in found
    assert sorted(r.doc_id for r in leaks.without_leaks(table(spark, texts), benchmark).collect()) == [3, 5, 6, 7]


def expected_base(ids, texts):
    tokens = [words(t) + [None] for t in texts]
    counts = collections.Counter()
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in ids]
    for own, out in zip(tokens, held):
        if not out:
            counts.update(own)
    total, different = sum(counts.values()), len(counts)
    return {
        i: (out, len(own), sum(counts[w] > 0 for w in own), total, sum(math.log10((counts[w] + 1) / (total + different + 1)) for w in own))
        for i, own, out in zip(ids, tokens, held)
    }


def check_scores(rows, ids, texts):
    want = expected_base(ids, texts)
    assert len(rows) == len(ids)
    for r in rows:
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:4]
        assert math.isclose(r.base_score, want[r.doc_id][4], rel_tol=1e-9, abs_tol=1e-9)
        assert math.isfinite(r.score) and r.score <= 1e-6


def test_language_model_counts_and_beats_the_unigram(spark, monkeypatch):
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = dict(df.select("doc_id", "text").collect())
    monkeypatch.setattr(lm, "COUNT_WORDS", 500)  # so that rare words are joined
    monkeypatch.setattr(lm, "MODEL_WORDS", 300)
    rows = lm.likelihood_report(df).collect()
    check_scores(rows, list(texts), list(texts.values()))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_on_awkward_rows(spark):
    texts = AWKWARD + AWKWARD
    df = table(spark, texts, ids=list(range(len(texts))))
    check_scores(lm.likelihood_report(df).collect(), list(range(len(texts))), texts)
    twice = lm.likelihood_report(df.unionByName(df)).collect()
    by_id = collections.defaultdict(set)
    for r in twice:
        by_id[r.doc_id].add((r.n_known, round(r.base_score, 6)))
    assert len(twice) == 2 * len(texts) and all(len(v) == 1 for v in by_id.values())
    assert lm.likelihood_report(table(spark, [])).count() == 0
    alone = lm.likelihood_report(table(spark, ["a b"], ids=[next(i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2)])).collect()
    assert [(r.held_out, r.n_known, r.train_tokens, r.base_score) for r in alone] == [(True, 0, 0, 0.0)]


def test_probabilities_add_up_and_state_crosses_windows():
    counts = np.array([50, 40, 30, 20, 10, 5, 25])
    net = lm.Network(counts, hidden=5)
    rng = np.random.default_rng(1)
    net.values = [v + rng.normal(0, 0.3, v.shape).astype(np.float32) for v in net.values]
    net.values[5][6:] = -30
    h = rng.normal(size=(4, 5)).astype(np.float32)
    total = sum(np.exp(net.output(h, np.full(4, k))[0]) for k in range(7))
    assert np.allclose(total, 1, atol=1e-5)
    ids = rng.integers(0, 7, 90)
    one = lm.log_likelihoods(net, ids, np.array([0, 90]))
    many = lm.log_likelihoods(net, np.concatenate([ids[:7], ids, ids[:20]]), np.array([0, 7, 97, 117]))
    assert np.allclose(one, many[7:97], atol=1e-4) and np.allclose(one[:7], many[:7], atol=1e-4)


def test_vocabulary_and_state_keep_their_size(spark):
    counts = spark.range(6001).selectExpr("id AS word", "9000 - id AS n")
    own = lm.Vocabulary.of(counts, lm.COUNT_WORDS, lm.MODEL_WORDS)
    _, ids = own.look_up(np.arange(4096, dtype=np.uint64))
    assert sorted(ids) == list(range(4096)) and own.size == 4096
    net = lm.Network(own.model_counts())
    assert net.hidden == 24 and lm.STREAMS * lm.WINDOW == 4096
    found, _ = net.output(np.zeros((3, 24), np.float32), np.array([2100, 4095, 4096]))
    assert np.isfinite(found).all() and len(set(found.tolist())) == 3


def test_the_most_frequent_words_are_modelled_in_flat_vocabularies(spark):
    hashed = "CASE WHEN id = 0 THEN 0 ELSE xxhash64(id) END AS word"
    for n in ("1", "IF(id < 7, 3, 1)", "IF(id < 150, 2, 1)", "1000000 + id % 3", "1 + id"):
        counts = spark.range(1000).selectExpr(hashed, f"CAST({n} AS long) AS n")
        rows = sorted(counts.collect(), key=lambda r: (r.word != 0, -r.n, r.word))
        for most in (1, 100, 2000):
            own = lm.Vocabulary.of(counts, most, 50)
            order = np.argsort(np.where(own.ids >= 0, own.ids, 1 << 40), kind="stable")
            assert own.words.view(np.int64)[order][: own.size].tolist() == [r.word for r in rows[: min(50, most)]]
            assert sorted(own.words.view(np.int64).tolist()) == sorted(r.word for r in rows[:most])
            assert own.total == sum(r.n for r in rows) and own.different == 1000


def test_training_carries_the_state_through_long_texts(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcde") for _ in range(n)) for n in (1300, 3, 2000, 40, 0, 700)]
    tokens, firsts = lm.sequences(np.frombuffer("".join(texts).encode(), np.uint8), np.cumsum([0] + [len(t) for t in texts]))
    found, counts = np.unique(tokens, return_counts=True)
    vocabulary = lm.Vocabulary(found, counts, np.arange(len(found)), len(found), len(tokens), len(found))
    net = lm.Network(vocabulary.model_counts())
    rate, learn, seen = 0.0, lm.Network.learn, []

    def watched(self, before, fresh, target, h, rate_):
        out = learn(self, before, fresh, target, h, rate)
        seen.append((before, fresh, target, h))
        return out

    monkeypatch.setattr(lm.Network, "learn", watched)
    monkeypatch.setattr(lm, "STREAMS", 1)
    monkeypatch.setattr(lm, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    sent = lambda value: types.SimpleNamespace(value=value)
    list(lm._trainer(sent(net), sent(vocabulary))(iter([pa.RecordBatch.from_pydict({"text": texts})])))
    before, fresh, target = (np.concatenate([w[i][:, 0] for w in seen]) for i in range(3))
    real = target >= 0
    ids = vocabulary.look_up(tokens)[1]
    lengths = np.diff(firsts)
    begins = np.flatnonzero(fresh[real])
    assert sorted(np.diff(np.append(begins, real.sum()))) == sorted(lengths)
    for begin, n in zip(begins, np.diff(np.append(begins, real.sum()))):
        k = lengths.tolist().index(n)
        assert (target[real][begin : begin + n] == ids[firsts[k] : firsts[k + 1]]).all()
        assert before[real][begin] == net.size + 1 and (before[real][begin + 1 : begin + n] == ids[firsts[k] : firsts[k + 1] - 1]).all()
    h = np.zeros((1, net.hidden), np.float32)
    for b, f, t, given in seen:  # without a rate the weights stay, and the states are those of scoring
        assert np.allclose(given, h, atol=1e-5) and (f[0, 0] or np.abs(given).max() > 0)
        for step in range(len(b)):
            h = net.step(net.projected()[b[step]], f[step], h)[0]


def test_training_windows_take_every_token_once(monkeypatch):
    monkeypatch.setattr(lm, "POOL", 200)
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, 50, n).astype(np.int32) for n in rng.integers(1, 400, 30)]
    columns, found = [[] for _ in range(4)], []
    for run, before, fresh, target in lm.windows(iter(texts), 51, 4):
        for c, s in enumerate(run):
            columns[s] += list(zip(before[:, c].tolist(), fresh[:, c].tolist(), target[:, c].tolist()))
    for column in columns:
        for before, fresh, target in column:
            if fresh:
                found.append([])
                assert before == 51
            elif target >= 0:
                assert before == found[-1][-1]
            if target >= 0:
                found[-1].append(target)
    assert sorted(found) == sorted(t.tolist() for t in texts)
    assert list(lm.windows(iter([]), 51, 4)) == []


def test_gradients_match_differences():
    counts = np.array([50, 40, 30, 20, 10, 5, 25])
    net = lm.Network(counts, hidden=4)
    net.values = [v.astype(np.float64) for v in net.values]
    before, fresh, target, _, _ = lm.packed(np.array([0, 3, 6, 2, 1, 5, 4, 0]), np.array([0, 5, 8]), net.size + 1, 2)
    start = np.zeros((2, 4))

    def loss(values):
        net.values = values
        h, out = start, 0.0
        for t in range(len(before)):
            h = net.step(net.projected()[before[t]], fresh[t], h)[0]
            real = target[t] >= 0
            out -= net.output(h[real], target[t][real])[0].sum()
        return out / (target >= 0).sum()

    old = [v.copy() for v in net.values]
    net.squares = [np.full_like(v, 1e12) for v in old]  # so that a step is rate * gradient / 1e6
    net.learn(before, fresh, target, start, 1e6)
    grads = [a - b for a, b in zip(old, net.values)]
    for i, at in [(0, (2, 5)), (0, (7, 11)), (1, (1, 2)), (1, (3, 10)), (2, (0, 1)), (3, (0,)), (4, (3, 2)), (5, (2,)), (6, (3, 10))]:
        up, down = [v.copy() for v in old], [v.copy() for v in old]
        up[i][at] += 1e-5
        down[i][at] -= 1e-5
        assert math.isclose(grads[i][at], (loss(up) - loss(down)) / 2e-5, rel_tol=1e-3, abs_tol=1e-7)


def test_pipeline_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "lines", "near_copies", "leaks", "pieces"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = corpus_pipeline.settle(stage(spark, docs, SF_DIR), name)
        after = {r.doc_id: r for r in out.collect()}
        assert set(after) <= set(before) and out.columns[:5] == docs.columns[:5]
        if name == "language":
            assert len(after) == len(before)
        if name == "near_copies":
            sets = {d: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := words(r.text)) else set() for d, r in before.items()}
            label = {d: d for d in sets}
            pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
            for _ in sets:
                for a, b in pairs:
                    label[a] = label[b] = min(label[a], label[b])
            assert set(after) == {d for d in sets if label[d] == d}
        if name == "leaks":
            plain = {d: words(r.text) for d, r in before.items()}
            exact = {d for d, r in before.items() if any(i.text in (r.text or "") for i in items)}
            assert exact and not exact & set(after)
            assert all(d in after for d in plain if d not in exact and not any(set(words(i.text)) & set(plain[d]) for i in items))
        if name == "pieces":
            assert set(after) == set(before) and all(r.round_trip for r in after.values())
        docs = out


def test_pipeline_stages_remove_what_they_must(spark, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    junk = table(spark, ["", "12 34 !!", None, "..."], ids=[-1, -2, -3, -4]).select(docs.columns)
    kept = {r.doc_id for r in stages["language"](spark, docs.unionByName(junk), SF_DIR).collect()}
    assert kept and min(kept) >= 0

    line, rare = "read more of this", "this line is rare"
    texts = [f"{line}\nown {i}" for i in range(14)] + [line, f"{rare}\n {line} \n{line}", None, "", f"{rare}\n\nno"]
    sources = [f"s{i}" for i in range(14)] + ["s0"] * 5
    out = stages["lines"](spark, table(spark, texts, sources), SF_DIR).collect()
    first, want = True, {}
    for i, text in enumerate(texts):
        lines = (text or "").split("\n")
        left = []
        for own in lines:
            if own.strip(" ") != line or first:
                left.append(own)
            first = first and own.strip(" ") != line
        if len(left) == len(lines) or "".join(left).strip():
            want[i] = None if text is None else "\n".join(left)
    assert {r.doc_id: r.text for r in out} == want and 14 not in want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out)

    items, texts, truth = planted()
    spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = {r.doc_id for r in stages["leaks"](spark, table(spark, [" ".join(t) for t in texts]), str(tmp_path)).collect()}
    leaking = {d for d, _ in truth}
    assert left >= set(range(len(texts))) - leaking and len(leaking & left) <= 0.05 * len(leaking)


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.settle(stage(spark, docs, SF_DIR), name)
        assert docs.count() == 0


def test_scoring_finds_rare_words_in_the_same_pass():
    texts = ["a b c b", None, "c d d D e", "a"]
    held = pa.RecordBatch.from_pydict({"key": [1, 2, 3, 4], "id": [1, 2, 3, 4], "held_out": [False] * 4, "text": texts})
    data = np.frombuffer(b"abcdef", np.uint8)
    names = dict(zip("abcdef", lm.sequences(data, np.arange(7))[0][::2].tolist()))
    words = np.array(sorted([int(lm.END), names["a"], names["c"]]), np.uint64)
    vocabulary = lm.Vocabulary(words, np.array([4, 3, 2]), np.arange(3), 3, 9, 3)
    sent = lambda value: types.SimpleNamespace(value=value)
    score = lm._scorer(sent(lm.Network(vocabulary.model_counts())), sent(vocabulary))
    rows = [r for b in score(iter([held])) for r in b.to_pylist()]
    found = [sorted((r["word"] % 2**64, r["n"]) for r in row["rare"]) for row in rows]
    assert found == [[(names["b"], 2)], [], sorted([(names["d"], 3), (names["e"], 1)]), []]
    assert [r["n_tokens"] for r in rows] == [5, 1, 6, 2]


@pytest.mark.parametrize("bits", [64, 50, 20])
def test_words_are_looked_up_where_many_have_the_same_upper_bits(bits):
    rng = np.random.default_rng(bits)
    words = np.unique(rng.integers(0, 2**bits, 900, np.uint64) if bits < 64 else rng.integers(0, 2**64 - 1, 900, np.uint64))
    asked = np.concatenate([words, words + np.uint64(1), np.array([0, 2**64 - 1], np.uint64)])
    counts, ids = lm.Vocabulary(words, np.arange(len(words)), np.arange(len(words)), len(words), 1, 1).look_up(asked)
    known = {w: i for i, w in enumerate(words.tolist())}
    assert counts.tolist() == [known.get(w, -1) for w in asked.tolist()]
    assert ids.tolist() == [known.get(w, len(words)) for w in asked.tolist()]
    assert lm.Vocabulary(words[:0], words[:0].astype(int), words[:0].astype(int), 0, 0, 0).look_up(asked)[0].max() == -1


def test_training_windows_use_their_arrays_again():
    rng = np.random.default_rng(3)
    net = lm.Network(np.append(np.sort(rng.integers(1, 999, 1000))[::-1], 50))
    again = pickle.loads(pickle.dumps(net))
    state = np.zeros((lm.STREAMS, net.hidden), np.float32)

    def window() -> tuple[np.ndarray, ...]:
        target = rng.integers(0, net.size + 1, (lm.WINDOW, lm.STREAMS)).astype(np.int32)
        target[20:, 5] = -1
        before = np.vstack([np.full((1, lm.STREAMS), net.size + 1, np.int32), np.maximum(target[:-1], 0)])
        return before, before == net.size + 1, target

    first, second = window(), window()
    net.learn(*first, state, 0.05)
    tracemalloc.start()
    after = net.learn(*second, state, 0.05)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 1 << 21  # the arrays of a window take several times as much

    again.learn(*first, state, 0.05)
    again = pickle.loads(pickle.dumps(again))  # without the arrays
    assert not again.room._kept
    same = again.learn(*second, state, 0.05)
    assert (after == same).all() and (net.vector() == again.vector()).all()

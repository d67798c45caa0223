"""Min-max near-duplicates, the conversation trie and the alignment of tokenizers."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from helpers import AWKWARD, table
from test_duplicates import expected_groups, near_copies
from tokenizers import Tokenizer

from rivulet.llm import alignment, minmax, turntrie
from rivulet.llm.text_arrays import span_names

COLLIDING = ["", ""]
for place in range(2048):  # two words whose polynomial hashes modulo 2^64 are the same
    odd = place.bit_count() & 1
    COLLIDING[0] += "ab"[odd]
    COLLIDING[1] += "ba"[odd]


def near_rows(texts, n, threshold):
    return sorted((i, size, label, i == label) for i, size, label, _ in expected_groups(texts, n, threshold))


@pytest.mark.parametrize("n, block", [(4, 256), (5, 3)])
def test_near_duplicates_match_brute_force(spark, n, block):
    texts = AWKWARD + near_copies(1, 60, 150, 9) + near_copies(2, 30, 12, 1) + near_copies(3, 30, 30, 3) + near_copies(4, 20, 700, 40)
    texts += COLLIDING + [f"{w} and more of it here" for w in COLLIDING]
    # a hot group of copies, some of them changed
    texts += ["one text that very many rows of the table share with each other"] * 80 + near_copies(5, 60, 40, 2)
    got = minmax.near_duplicates(table(spark, texts).repartition(6), n=n, block=block)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(tuple(r) for r in got.collect()) == near_rows(texts, n, minmax.Fraction("0.8"))


def test_near_duplicates_on_empty_null_and_repeated_ids(spark):
    assert minmax.near_duplicates(table(spark, [])).count() == 0
    df = table(spark, ["a b c d", "x y z", "a b c d", "x y z", None, ""], ids=[7, 7, None, 9, 8, None])
    got = sorted((tuple(r) for r in minmax.near_duplicates(df).collect()), key=repr)
    want = [(7, 1, 7, True), (7, 1, 7, True), (None, 1, None, True), (9, 1, 7, False), (8, 0, 8, True), (None, 0, None, True)]
    assert got == sorted(want, key=repr)


def test_min_max_estimates_the_similarity():
    rng = np.random.default_rng(1)
    union = np.unique(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    a, b = union[:900], union[100:]
    low, high = minmax.min_max(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
    agree = [(x[0] == x[1]).mean() for x in (low, high)]
    assert abs(sum(agree) / 2 - 800 / 1000) < 0.07 and (low <= high).all()
    keys = minmax.band_keys(low, high)
    assert keys.shape == (2, minmax.BANDS) and (keys[0] == keys[1]).any()


def test_span_names_tell_colliding_words_apart():
    data = np.frombuffer(" ".join([*COLLIDING, "Word", "word", COLLIDING[0], "z" * (1 << 20), "z" * (1 << 20)]).encode(), np.uint8)
    cuts = np.flatnonzero(np.append(data, 0x20) == 0x20)
    starts, ends = np.concatenate([[0], cuts[:-1] + 1]), cuts
    names = span_names(data, starts, ends).tolist()
    assert names[0] != names[1] and names[0] == names[4] and names[2] != names[3] and names[5] == names[6]
    folded = span_names(data, starts, ends, fold=True)
    assert folded[2] == folded[3] and len(set(folded.tolist())) == 4


def crc(c):
    return zlib.crc32(str(c).encode()) % 9


def expected_trie(rows):
    """Rows of the trie from (conv, turn, role, text) rows, by dictionaries of prefixes."""
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            id = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            turns.setdefault(c, []).append((turn is not None, turn, id, len(text.encode())))
    lists = {c: [t[2:] for t in sorted(l, key=lambda t: (t[0], t[1] or 0, t[2]))] for c, l in turns.items()}
    convs = {c: lists.get(c - c % 5, [])[: crc(c)] + l[crc(c) :] for c, l in lists.items()}
    members, children, ends = {}, {}, {}
    for c, l in sorted(convs.items()):
        path = tuple(l)
        ends.setdefault(path, []).append(c)
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
            if d:
                children.setdefault(path[: d - 1], set()).add(path[:d])
    leaves, saved = Counter(), Counter()
    for path, own in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(own) - 1) * path[-1][1] if path else 0
    return sorted(
        (
            (
                own[0], len(path), members[path[:-1]][0] if path else None, len(own), len(children.get(path, ())), leaves[path], saved[path],
                hashlib.sha256(",".join(map(str, ends.get(path, []))).encode()).hexdigest(),
            )
            for path, own in members.items()
        ),
        key=repr,
    )


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, name string, level int")


def many_turns(seed=4):
    rng = random.Random(seed)
    rows = []
    for c in range(120):
        for t in range(rng.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, t, "user", f"t{rng.randrange(2)}" if t < 6 else "same"))
    rows += [(500, t, "user", "same") for t in range(90)] + [(501, t, None, "same" if t < 70 else None) for t in range(80)]
    rows += [(505, None, "user", "null turn"), (505, 1, "a", "ö"), (505, 1, "b", ""), (505, 1, "b", ""), (None, 1, "a", "b"), (-7, 3, "a", "b")]
    rows += [(c, t, "user", "copy") for c in range(1000, 1200, 5) for t in range(3)]  # one large group of copies
    return rows


@pytest.mark.parametrize("segment, most", [(64, 1 << 16), (2, 5), (3, 1), (16, 40)])
def test_trie_matches_brute_force(spark, segment, most):
    rows = many_turns()
    got = turntrie.prefix_trie(conversations(spark, rows).repartition(5), segment=segment, most=most)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected_trie(rows)


def test_trie_of_nothing(spark):
    assert turntrie.prefix_trie(conversations(spark, [])).count() == 0
    only_null = conversations(spark, [(None, 1, "a", "b")])
    assert turntrie.prefix_trie(only_null).count() == 0


def test_radix_tree_grows_through_all_layouts():
    rng = random.Random(1)
    keys = {bytes([rng.randrange(256)]) + bytes(rng.randrange(3) for _ in range(rng.randrange(8))) for _ in range(4000)} | {b""}
    tree, seen = turntrie.RadixTree(), set()
    for value, key in enumerate(rng.sample(sorted(keys), len(keys))):
        tree.insert(key, value)
    todo = [(tree.root, tree.root.path)]
    rooms = set()
    while todo:
        node, key = todo.pop()
        rooms.add(node.room)
        assert len(node.below()) <= node.room
        if node.value is not None:
            seen.add(key)
        todo += [(c, key + bytes([b]) + c.path) for b in range(256) if (c := node.child(b)) is not None]
    assert seen == keys and 256 in rooms and 4 in rooms
    for room, count in ((4, 4), (16, 5), (16, 16), (48, 17), (48, 48), (256, 49)):
        node = turntrie.Inner(b"")
        for b in range(count):
            node.put(255 - b, turntrie.Inner(bytes([b])))
        assert node.room == room and [node.child(255 - b).path for b in range(count)] == [bytes([b]) for b in range(count)]
        assert node.child(0) is None


def expected_alignment(rows):
    a = Tokenizer.from_file(alignment.MODEL_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=alignment.MODEL_B)
    values = alignment.byte_values()
    spell_a = {i: t.encode() if i == 50256 else bytes(values[c] for c in t) for t, i in a.get_vocab(with_added_tokens=True).items()}
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    spell_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    counts, docs = Counter(), []
    for id, text in rows:
        sides = []
        for ids, spell in ((a.encode(" " + text, add_special_tokens=False).ids, spell_a), (b.encode(text), spell_b)) if text else ():
            ends, end = {}, 0
            for k, i in enumerate(ids):
                end += len(spell[i])
                ends[end] = k
            sides.append((ids, ends, b"".join(spell[i] for i in ids)))
        if not text or any(s[2] != (" " + text).encode() for s in sides):
            docs.append((id, 0, 0, [], ""))
            continue
        (ids_a, ends_a, _), (ids_b, ends_b, _) = sides
        links, groups, i, j = [], [], 0, 0
        for end in sorted(ends_a.keys() & ends_b.keys()):
            x, y = ends_a[end] + 1, ends_b[end] + 1
            groups.append(",".join(map(str, ids_a[i:x])) + "|" + ",".join(map(str, ids_b[j:y])))
            links.append((ids_a[x - 1], ids_b[y - 1]))
            i, j = x, y
        counts.update(links)
        docs.append((id, len(ids_a), len(ids_b), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(n, best.get(y, 0))
    return sorted(
        ((id, n, m, len(l), len(l), sum(counts[p] == best[p[1]] for p in l), sum(counts[p] for p in l), h) for id, n, m, l, h in docs), key=repr
    )


@pytest.mark.parametrize("slice_bytes", [1, 5000, alignment.SLICE_BYTES])
def test_alignment_matches_brute_force(spark, slice_bytes):
    texts = AWKWARD + ["<|endoftext|> <s> </s><unk><0x41>", "a▁b", "x " * 500, "tab\tand  two   spaces ", "don't you're 12345 €😀", *COLLIDING]
    ids = list(range(len(texts)))
    ids[3] = ids[4]
    ids[6] = None
    got = alignment.align_tokenizers(table(spark, texts, ids=ids).repartition(3), slice_bytes=slice_bytes)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected_alignment(list(zip(ids, texts)))


def test_alignment_of_an_empty_table(spark):
    assert alignment.align_tokenizers(table(spark, [])).count() == 0


def test_texts_are_cut_without_a_trace():
    with open(alignment.MODEL_A, encoding="utf-8") as a, open(alignment.MODEL_B, "rb") as b:
        pair = alignment.Pair(a.read(), b.read())
    rng = random.Random(7)
    text = "".join(rng.choice(["word ", "été  ", "don't ", "'s ", "12 ", "\n", " ", "a　 b", "x", " ", "\x1f ", "\x85"]) for _ in range(60_000))
    chunks = pair.chunks(text)
    assert len(chunks) > 1000 and " ".join(chunks) == text
    ids_a, n_a, ids_b, n_b = pair.encode(chunks)
    assert ids_a.tolist() == pair.a.encode(" " + text, add_special_tokens=False).ids
    assert ids_b.tolist() == pair.b.encode(text)
    plain = [c for c in dict.fromkeys(chunks) if pair.joins(c)]
    assert all(np.array_equal(x, y) for x, y in zip(pair.encode(plain, len(plain)), pair.encode(plain)))


def test_galloping_finds_all_common_ends():
    rng = np.random.default_rng(3)
    a, b = ([np.unique(rng.integers(0, 4000, rng.integers(0, 900))) for _ in range(40)] for _ in range(2))
    sizes_a, sizes_b = ([0, *np.cumsum([len(x) for x in l])] for l in (a, b))
    flat_a, flat_b = (np.concatenate([x + 10_000 * i for i, x in enumerate(l)]) for l in (a, b))
    in_a, in_b = alignment.common_ends(flat_a, np.array(sizes_a), flat_b, np.array(sizes_b))
    want = np.intersect1d(flat_a, flat_b)
    assert (flat_a[in_a] == want).all() and (flat_b[in_b] == want).all()

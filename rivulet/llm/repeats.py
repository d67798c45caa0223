"""Removal of bytes that an earlier document holds in a common string of `length` bytes.

A byte goes if some `length`-byte string over it also starts in a document with a smaller id.

1. Documents are dealt into blocks by a hash of the id. Every window of `length` bytes has an
   anchor: its GRAM-byte string of least hash, the first among equals, which depends on the
   window alone. Windows next to each other mostly share an anchor; they form a context.
2. Blocks send their anchors' hashes, each once, to buckets; these answer which ones a second
   document has. Only contexts of those go on, and of equal contexts in a block only the
   smallest id's: the others' bytes are gone already. Anchors in very many blocks (`hot`)
   send each window by itself, dealt by the window's hash, so no bucket gets them all.
3. A bucket sorts the suffixes of its contexts, those with the same anchor at the same place
   together, by merge sort. Suffixes are compared by the length of their common extension,
   found by binary search over polynomial prefix hashes; neighbours that seem equal over
   `length` bytes are verified byte by byte. In each run of equal ones all but the smallest
   id's are covered.
4. The covered stretches go back to the blocks, where what is left is put together.

The documents are shuffled once; the steps that need them share that shuffle. Strings are
judged on the input. NULL texts are empty. NULL ids count as larger than all others; documents
with the same id never remove each other's bytes, and repeated rows get the same result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.tables import byte_total, parts, spread
from rivulet.llm.text_arrays import mix, prefix_hashes, raw_span_hashes, span_hashes, text_slices, within

LENGTH = 50
GRAM = 20
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20
HOT = 256
#: windows that are sorted at once, unless one anchor has more
SORTED = 1 << 16
SEGMENT = 1 << 18
NO_ID = np.iinfo(np.int64).max
PLACE = np.uint64((1 << 21) - 1)

SCHEMA = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


class Block:
    """The documents of one block as one byte array."""

    def __init__(self, table: pa.Table):
        slices = list(text_slices(table["text"], 1 << 40))
        self.data = np.concatenate([s[2] for s in slices]) if slices else np.empty(0, np.uint8)
        sizes = np.concatenate([np.diff(s[3]) for s in slices]) if slices else np.empty(0, np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        self.ids = table["id"].fill_null(NO_ID).to_numpy().astype(np.int64)
        self.prefixes = prefix_hashes(self.data)
        # a row's number follows from its id and text, not from the order in which rows arrive
        keys = span_hashes(self.prefixes, self.offsets[:-1], self.offsets[1:])
        order = np.lexsort((keys, self.ids))
        change = np.ones(len(order), bool)
        change[1:] = (self.ids[order][1:] != self.ids[order][:-1]) | (keys[order][1:] != keys[order][:-1])
        self.numbers = np.empty(len(order), np.int32)
        self.numbers[order] = np.cumsum(change) - 1

    def windows(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Contexts (first window, last window, anchor's place, anchor's hash)."""
        n = len(self.data)
        marks = np.zeros(n + 2, np.int32)
        sizes = np.diff(self.offsets)
        long = sizes >= length
        np.add.at(marks, self.offsets[:-1][long], 1)
        np.add.at(marks, self.offsets[1:][long] - length + 1, -1)
        inside = np.cumsum(marks, dtype=np.int32)[:n] > 0
        found = []
        span = length - GRAM + 1
        for begin in range(0, n, SEGMENT):
            end = min(n, begin + SEGMENT + length - 1)
            if end - begin < length:
                break
            starts = np.arange(begin, end - GRAM + 1)
            grams = mix(raw_span_hashes(self.prefixes, starts, starts + GRAM))
            least = (grams & ~PLACE) | (starts - begin).astype(np.uint64)
            width = 1
            while width * 2 <= span:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
            at = np.flatnonzero(inside[begin : begin + min(SEGMENT, len(least))])
            place = (least[at] & PLACE).astype(np.int64)
            fresh = np.ones(len(at), bool)
            fresh[1:] = (at[1:] != at[:-1] + 1) | (place[1:] != place[:-1])
            heads = np.flatnonzero(fresh)
            tails = np.append(heads[1:], len(at))[: len(heads)] - 1
            found.append((at[heads] + begin, at[tails] + begin, place[heads] + begin, grams[place[heads]] & ~np.uint64(1)))
        if not found:
            none = np.empty(0, np.int64)
            return none, none, none, none.astype(np.uint64)
        return tuple(np.concatenate(c) for c in zip(*found))

    def rows_at(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, places, side="right") - 1

    def gather(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return gather(self.data, starts, sizes)


def gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The pieces data[starts:starts + sizes], one after another."""
    return data[np.repeat(starts, sizes) + within(sizes)]


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each anchor, whatever its lowest bit; mixed again, as anchors are the least of many hashes."""
    return ((mix(hashes | np.uint64(1)) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def runs(values: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of equal neighbours."""
    cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)])) if len(values) else []


ANCHORS = "bucket int, block int, grams binary"


def _anchors(length: int, buckets: int):
    def send(table: pa.Table) -> pa.Table:
        block = Block(table)
        first, _, _, grams = block.windows(length)
        rows = block.rows_at(first)
        order = np.lexsort((rows, grams))
        grams, rows = grams[order], rows[order]
        heads = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.empty(0, np.int64)
        tails = np.append(heads[1:], len(grams))[: len(heads)] - 1
        several = rows[heads] != rows[tails]  # the lowest bit tells of a second document in the block
        grams = grams[heads] | several.astype(np.uint64)
        own = bucket_of(grams, buckets)
        order = np.argsort(own, kind="stable")
        own, grams = own[order], grams[order]
        cuts = runs(own)
        return pa.table(
            {
                "bucket": pa.array([int(own[a]) for a, _ in cuts], pa.int32()),
                "block": pa.array([table["block"][0].as_py()] * len(cuts), pa.int32()),
                "grams": pa.array([grams[a:b].tobytes() for a, b in cuts], pa.binary()),
            }
        )

    return send


SHARED = "block int, grams binary"


def _shared(hot: int):
    """Which anchors of each block another document has; the lowest bit tells of a hot one."""

    def answer(table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(v, np.uint64) for v in table["grams"].to_pylist()]
        grams = np.concatenate(lists)
        owner = np.repeat(np.arange(len(lists)), [len(v) for v in lists])
        names, which, blocks = np.unique(grams & ~np.uint64(1), return_inverse=True, return_counts=True)
        several = np.zeros(len(names), bool)
        several[which[(grams & np.uint64(1)) > 0]] = True
        use = (several | (blocks > 1))[which]
        told = (names | (blocks > hot).astype(np.uint64))[which[use]]
        owner = owner[use]
        cuts = runs(owner)
        return pa.table(
            {
                "block": pa.array([table["block"][int(owner[a])].as_py() for a, _ in cuts], pa.int32()),
                "grams": pa.array([told[a:b].tobytes() for a, b in cuts], pa.binary()),
            }
        )

    return answer


#: target: a bucket, or -1 - block for stretches that need no bucket
CONTEXTS = "target int, block int, ids binary, rows binary, starts binary, turns binary, sizes binary, content binary"


def _contexts(length: int, buckets: int):
    def send(documents: pa.Table, answers: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if documents.num_rows and answers.num_rows:
            block = Block(documents)
            number = documents["block"][0].as_py()
            told = np.concatenate([np.frombuffer(v, np.uint64) for v in answers["grams"].to_pylist()])
            told = told[np.argsort(told)]
            first, last, place, grams = block.windows(length)
            at = np.minimum(np.searchsorted(told & ~np.uint64(1), grams), len(told) - 1)
            use = (told[at] & ~np.uint64(1)) == grams
            first, last, place, grams, at = first[use], last[use], place[use], grams[use], at[use]
            hot = (told[at] & np.uint64(1)) > 0
            if hot.any():  # each window by itself
                sizes = np.where(hot, last - first + 1, 1)
                each = np.repeat(np.arange(len(first)), sizes)
                single = hot[each]
                first = first[each] + np.where(single, within(sizes), 0)
                last = np.where(single, first, last[each])
                place, grams = place[each], grams[each]
                whole = span_hashes(block.prefixes, first, first + length) & ~np.uint64(1)
                grams = np.where(single, whole, grams)
                place = np.where(single, first, place)
            rows = block.rows_at(first)
            sizes = last - first + length
            content = mix(span_hashes(block.prefixes, first, first + sizes) + (place - first).astype(np.uint64) + grams)
            ids = block.ids[rows]
            order = np.lexsort((ids, content))
            groups = np.repeat(np.arange(n := len(runs(content[order]))), [b - a for a, b in runs(content[order])]) if len(order) else order
            heads = np.searchsorted(groups, np.arange(n)) if len(order) else order
            lowest = order[heads][groups] if len(order) else order
            # of equal contexts the smallest id's are sent; equality is verified on the bytes
            same = np.zeros(len(order), bool)
            later = np.flatnonzero(ids[order] > ids[lowest])
            if len(later):
                a, b = order[later], lowest[later]
                alike = sizes[a] == sizes[b]
                equal = np.add.reduceat(
                    (block.gather(first[a], sizes[a]) != block.gather(first[b], sizes[a])).astype(np.int64), np.cumsum(sizes[a]) - sizes[a]
                )
                same[later] = alike & (equal == 0)
            gone = order[same]
            keep = order[~same]
            begins = (first - block.offsets[rows]).astype(np.int32)
            turns, sizes = (place - first).astype(np.uint8), sizes.astype(np.int32)
            if len(gone):
                own = block.numbers[rows[gone]].tobytes()
                out.append((-1 - number, number, b"", own, begins[gone].tobytes(), b"", sizes[gone].tobytes(), b""))
            own = bucket_of(grams[keep], buckets)
            ordered = np.argsort(own, kind="stable")
            own, keep = own[ordered], keep[ordered]
            for a, b in runs(own):
                k = keep[a:b]
                numbers = [ids[k], block.numbers[rows[k]], begins[k], turns[k], sizes[k]]
                packed = zstandard.compress(block.gather(first[k], sizes[k]).tobytes())
                out.append((int(own[a]), number, *(v.tobytes() for v in numbers), packed))
        names = ["target", "block", "ids", "rows", "starts", "turns", "sizes", "content"]
        columns = list(zip(*out)) if out else [[] for _ in names]
        return pa.table({n: pa.array(c, pa.int32() if i < 2 else pa.binary()) for i, (n, c) in enumerate(zip(names, columns))})

    return send


def common(prefixes: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Length, up to `length`, of the common extension of the suffixes at a and b."""
    found = np.where(raw_span_hashes(prefixes, a, a + length) == raw_span_hashes(prefixes, b, b + length), length, 0)
    open_ = np.flatnonzero(found < length)
    x, y, shared = a[open_], b[open_], np.zeros(len(open_), np.int64)
    step = 1 << (length.bit_length() - 1)
    while step:
        fits = shared + step < length
        more = np.where(fits, step, 0)
        same = raw_span_hashes(prefixes, x + shared, x + shared + more) == raw_span_hashes(prefixes, y + shared, y + shared + more)
        shared += np.where(same, more, 0)
        step >>= 1
    found[open_] = shared
    return found


def suffix_order(data: np.ndarray, prefixes: np.ndarray, starts: np.ndarray, groups: np.ndarray, length: int) -> np.ndarray:
    """Order of the suffixes by their first `length` bytes inside each group; groups are numbered 0, 1, ... in order.

    Bottom-up merge sort, all groups and runs at once: each suffix finds its rank in the
    sibling run by binary search.
    """
    perm = np.arange(len(starts))
    sizes = np.bincount(groups, minlength=int(groups.max()) + 1 if len(groups) else 0)
    heads = np.cumsum(sizes) - sizes
    width = 1
    while len(sizes) and width < sizes.max():
        slots = np.flatnonzero(sizes[groups] > width)
        base, size = heads[groups[slots]], sizes[groups[slots]]
        q = slots - base
        run = q // width
        low = np.minimum((run ^ 1) * width, size)
        high = np.minimum(low + width, size)
        left = run % 2 == 0
        lo, hi = low.copy(), high.copy()
        mine = starts[perm[slots]]
        while True:
            busy = np.flatnonzero(lo < hi)
            if not len(busy):
                break
            mid = (lo[busy] + hi[busy]) // 2
            other = starts[perm[base[busy] + mid]]
            shared = common(prefixes, mine[busy], other, length)
            equal = shared >= length
            at = np.where(equal, 0, shared)
            less = data[other + at] < data[mine[busy] + at]
            before = np.where(equal, ~left[busy], less)  # an equal one of the left run comes first
            lo[busy] = np.where(before, mid + 1, lo[busy])
            hi[busy] = np.where(before, hi[busy], mid)
        to = base + np.minimum(low, run * width) + (q - run * width) + (lo - low)
        new = perm.copy()
        new[to] = perm[slots]
        perm = new
        width *= 2
    return perm


def covered(
    data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, turns: np.ndarray, ids: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """(context, window) pairs whose string another context with a smaller id has.

    `turns` tells where in a context its anchor lies; contexts with other anchors have no
    window in common.
    """
    prefixes = prefix_hashes(data)
    counts = sizes - length + 1
    anchors = span_hashes(prefixes, starts + turns, starts + turns + GRAM)
    # equal contexts: all windows of the later ids
    whole = mix(span_hashes(prefixes, starts, starts + sizes) + turns.astype(np.uint64))
    order = np.lexsort((ids, whole))
    cuts = runs(whole[order])
    head = np.repeat([a for a, _ in cuts], [b - a for a, b in cuts]) if cuts else np.empty(0, np.int64)
    first = order[head] if len(order) else order
    later = np.flatnonzero((ids[order] > ids[first]) & (sizes[order] == sizes[first]))
    left = np.ones(len(starts), bool)
    out = []
    for at in range(0, len(later), SORTED // 8):
        a, b = order[later[at : at + SORTED // 8]], first[later[at : at + SORTED // 8]]
        differ = (gather(data, starts[a], sizes[a]) != gather(data, starts[b], sizes[a])).astype(np.int64)
        a = a[np.add.reduceat(differ, np.cumsum(sizes[a]) - sizes[a]) == 0]
        out.append((np.repeat(a, counts[a]), within(counts[a])))
        left[a] = False
    # suffixes of the rest, some anchors at a time
    rest = np.flatnonzero(left)
    _, which, many = np.unique(anchors[rest], return_inverse=True, return_counts=True)
    rest = rest[many[which] > 1]
    rest = rest[np.argsort(anchors[rest], kind="stable")]
    windows = np.cumsum(counts[rest])
    anew = np.flatnonzero(np.concatenate([[True], anchors[rest][1:] != anchors[rest][:-1]])) if len(rest) else rest
    begin = 0
    while begin < len(rest):
        done = windows[begin - 1] if begin else 0
        end = int(np.searchsorted(windows, done + SORTED, side="right"))
        later_cuts = anew[anew > begin]
        fits = later_cuts[later_cuts <= end]
        end = int(fits[-1]) if len(fits) and end < len(rest) else int(later_cuts[0]) if len(later_cuts) and end < len(rest) else len(rest)
        out.append(_sorted_windows(data, prefixes, starts, turns, anchors, ids, counts, rest[begin:end], length))
        begin = end
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out])


def _sorted_windows(
    data: np.ndarray,
    prefixes: np.ndarray,
    starts: np.ndarray,
    turns: np.ndarray,
    anchors: np.ndarray,
    ids: np.ndarray,
    counts: np.ndarray,
    chosen: np.ndarray,
    length: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the chosen contexts that equal one of a smaller id, by sorting them."""
    context, turn = np.repeat(chosen, counts[chosen]), within(counts[chosen])
    ahead = turns[context] - turn
    order = np.lexsort((ahead, anchors[context]))
    context, turn, ahead = context[order], turn[order], ahead[order]
    change = np.concatenate([[True], (anchors[context][1:] != anchors[context][:-1]) | (ahead[1:] != ahead[:-1])])
    groups = np.cumsum(change) - 1
    places = starts[context] + turn
    order = suffix_order(data, prefixes, places, groups, length)
    places, context, turn = places[order], context[order], turn[order]
    same = np.zeros(len(places), bool)
    same[1:] = (groups[1:] == groups[:-1]) & (common(prefixes, places[1:], places[:-1], length) >= length)
    pairs = np.flatnonzero(same)
    for at in range(0, len(pairs), SORTED // 8):  # verified byte by byte
        part = pairs[at : at + SORTED // 8]
        step = np.arange(length)
        same[part] = (data[places[part][:, None] + step] == data[places[part - 1][:, None] + step]).all(axis=1)
    run = np.cumsum(~same) - 1
    lowest = np.minimum.reduceat(ids[context], np.flatnonzero(~same))
    hit = ids[context] > lowest[run]
    return context[hit], turn[hit]


SPANS = "block int, rows binary, starts binary, sizes binary"


def _match(length: int):
    def match(table: pa.Table) -> pa.Table:
        names = ("rows", "starts", "sizes")
        if table["target"][0].as_py() < 0:
            return table.select(["block", *names])

        def joined(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(b"".join(table[name].to_pylist()), kind)

        data = np.frombuffer(b"".join(map(zstandard.decompress, table["content"].to_pylist())), np.uint8)
        sizes, turns = joined("sizes", np.int32).astype(np.int64), joined("turns", np.uint8).astype(np.int64)
        ids, numbers, firsts = joined("ids", np.int64), joined("rows", np.int32), joined("starts", np.int32)
        block = np.repeat(table["block"].to_numpy(), [len(v) // 8 for v in table["ids"].to_pylist()])
        context, turn = covered(data, np.cumsum(sizes) - sizes, sizes, turns, ids, length)
        order = np.lexsort((turn, context))
        context, turn = context[order], turn[order]
        # neighbouring windows as one stretch
        fresh = np.ones(len(context), bool)
        fresh[1:] = (context[1:] != context[:-1]) | (turn[1:] > turn[:-1] + 1)
        heads = np.flatnonzero(fresh)
        tails = np.append(heads[1:], len(context))[: len(heads)] - 1
        who, begin, size = context[heads], firsts[context[heads]] + turn[heads], turn[tails] - turn[heads] + length
        order = np.argsort(block[who], kind="stable")
        who, begin, size = who[order], begin[order], size[order]
        begin, size = begin.astype(np.int32), size.astype(np.int32)
        rows = [(int(block[who[a]]), numbers[who[a:b]].tobytes(), begin[a:b].tobytes(), size[a:b].tobytes()) for a, b in runs(block[who])]
        columns = list(zip(*rows)) if rows else [[] for _ in range(4)]
        return pa.table({n: pa.array(c, pa.binary() if i else pa.int32()) for i, (n, c) in enumerate(zip(("block", *names), columns))})

    return match


def _cut(with_text: bool):
    def cut(documents: pa.Table, spans: pa.Table) -> pa.Table:
        n = documents.num_rows
        block = Block(documents) if n else None
        removed = np.zeros(len(block.data) + 1 if n else 1, np.int64)
        if n and spans.num_rows:
            numbers, starts, sizes = (np.frombuffer(b"".join(spans[c].to_pylist()), np.int32) for c in ("rows", "starts", "sizes"))
            # repeated rows have one number and get the same stretches
            order = np.argsort(block.numbers, kind="stable")
            low, high = (np.searchsorted(block.numbers[order], numbers, side=side) for side in ("left", "right"))
            rows = order[np.repeat(low, high - low) + within(high - low)]
            starts, sizes = np.repeat(starts, high - low), np.repeat(sizes, high - low)
            np.add.at(removed, block.offsets[rows] + starts, 1)
            np.add.at(removed, block.offsets[rows] + starts + sizes, -1)
        gone = np.cumsum(removed)[:-1] > 0
        numbers, digests, texts = [], [], []
        for r in range(n):
            a, b = int(block.offsets[r]), int(block.offsets[r + 1])
            own = gone[a:b]
            kept = block.data[a:b][~own].tobytes()
            heads = int(own[:1].sum()) + int((own[1:] & ~own[:-1]).sum())
            numbers.append((b - a, int(own.sum()), heads))
            digests.append(hashlib.sha256(kept).hexdigest())
            texts.append(kept if with_text else None)
        columns = list(zip(*numbers)) if numbers else [[], [], []]
        return pa.table(
            {
                "id": documents["id"],
                **{name: pa.array(c, pa.int64()) for name, c in zip(("n_bytes", "n_removed", "n_spans"), columns)},
                "kept_sha256": pa.array(digests, pa.string()),
                "kept": pa.array(texts, pa.binary()),
            }
        )

    return cut


def remove_repeats(
    df: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    length: int = LENGTH,
    block_bytes: int = BLOCK_BYTES,
    hot: int = HOT,
    with_text: bool = True,
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept) for each row; kept are the remaining bytes."""
    if length <= GRAM:
        raise ValueError(f"length must be above {GRAM}")
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    total = byte_total(rows, "text")
    buckets = parts(total, BUCKET_BYTES)
    dealt = rows.withColumn("block", spread("id", parts(total, block_bytes)))
    anchors = dealt.groupBy("block").applyInArrow(_anchors(length, buckets), ANCHORS)
    answers = anchors.groupBy("bucket").applyInArrow(_shared(hot), SHARED)
    contexts = dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_contexts(length, buckets), CONTEXTS)
    spans = contexts.groupBy("target").applyInArrow(_match(length), SPANS)
    out = dealt.groupBy("block").cogroup(spans.groupBy("block")).applyInArrow(_cut(with_text), SCHEMA)
    return out.withColumnRenamed("id", id)


def repeats_report(df: DataFrame) -> DataFrame:
    return remove_repeats(df, with_text=False).drop("kept")


ORACLE = f"""
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
n AS (SELECT doc_id, x, length(x) // 2 AS n FROM d),
b AS (SELECT doc_id, n, x, unnest(range(0, greatest(n - {LENGTH} + 1, 0), 512)) AS base FROM n),
y AS (SELECT doc_id, n, base, substr(x, 2 * base + 1, {2 * (512 + LENGTH - 1)}) AS y FROM b),
w AS (SELECT doc_id, base, unnest(range(0, least(512, n - {LENGTH} + 1 - base))) AS t, y FROM y),
h AS (SELECT doc_id, base + t AS s, substr(y, 2 * t + 1, {2 * LENGTH}) AS g FROM w),
m AS (SELECT g, min(doc_id) AS first FROM h GROUP BY g),
hit AS (SELECT doc_id, s FROM h JOIN m USING (g) WHERE doc_id > first),
edge AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER o + {LENGTH} THEN 0 ELSE 1 END AS fresh FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY s)),
runs AS (SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS r FROM edge),
spans AS (SELECT doc_id, r, min(s) AS a, max(s) + {LENGTH} AS b FROM runs GROUP BY doc_id, r),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
cut AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last,
        string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT n.doc_id, n.n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept || substr(x, 2 * last + 1), x))) AS kept_sha256
FROM n LEFT JOIN cut USING (doc_id)"""

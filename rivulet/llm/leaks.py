"""Benchmark passages in documents, up to a share of edited words.

Texts are sequences of words (lower-cased A-Z, punctuation aside). A passage leaks into a
document if some stretch of it is at most `edit_share` of the item's words away in edit
distance (insert, delete, replace a word).

The CGK embedding turns edit distance into Hamming distance: a walk along the words stays or
steps ahead by a random bit of (step, word) and writes down the word it stands on. Items are
put into classes of about equal size; every place of a document is a window of the class's
size. Some steps of the walk are sampled into a signature, and windows that share one with an
item are candidates. Fresh walks and samples are repeated until the chance to miss a passage
with all its edits is at most 1 - `recall`; that chance is measured on edited copies of the
items themselves. Candidates are verified by exact edit distance.

Windows with too few words that occur in any item of the class cannot be within the bound and
are not embedded; that loses nothing. The items' tables are sent to the executors in blocks of
at most `block_bytes` of text; each block is one pass over the documents.

Items of fewer than `least_words` words take no edits: they are found by the hash of all their
words and compared word by word. NULL texts and items have no words, and items without words are
not searched. A run of letters without spaces or punctuation is one word, in every script.
Each row of documents and items counts for itself; repeated rows give repeated matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.tables import byte_total, parts, spread
from rivulet.llm.text_arrays import PUNCTUATION, span_names, text_slices, within, word_bounds

EDIT_SHARE = 0.2
RECALL = 0.97
LEAST_WORDS = 5
BLOCK_BYTES = 4 << 20
#: the largest item of a class has so many times the words of the smallest
CLASS_RATIO = 1.35
#: steps in a signature; one less after each PATIENCE rounds, so that every recall is reached
SAMPLED = 4
PATIENCE = 48
SLICE = 1 << 20

SCHEMA = "id long, item long, edits int, first_word long"
ARROW = pa.schema([("id", pa.int64()), ("item", pa.int64()), ("edits", pa.int32()), ("first_word", pa.int64())])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the index of each row's first."""
    starts, ends, firsts = word_bounds(data, offsets, PUNCTUATION)
    return span_names(data, starts, ends, fold=True), firsts


def signatures(words: np.ndarray, starts: np.ndarray, limits: np.ndarray, coins: np.ndarray, sampled: np.ndarray) -> np.ndarray:
    """The sampled steps of one walk from each start, over at most `limits` words."""
    place = np.zeros(len(starts), np.int64)
    out = np.zeros(len(starts), np.uint64)
    wanted = set(sampled.tolist())
    for step in range(int(sampled.max()) + 1):
        inside = place < limits
        word = words[np.where(inside, starts + place, 0)] * inside
        if step in wanted:
            out = (out ^ word) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        place += ((word * coins[step]) >> np.uint64(63)).astype(np.int64)
    return out


def marked(words: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the `size` words from each start."""
    out = np.zeros(len(starts), np.uint64)
    for step in range(size):
        out = (out ^ words[starts + step]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


@dataclass
class SizeClass:
    """Items of about one size."""

    size: int
    edits: int
    vocabulary: np.ndarray
    rounds: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def windows(self, words: np.ndarray, rows: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places whose next `size` words are mostly the class's, and how many words are left there."""
        at = np.searchsorted(self.vocabulary, words)
        known = self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == words
        counts = np.concatenate([[0], np.cumsum(known)])
        places = np.arange(len(words))
        ends = np.minimum(places + self.size, firsts[1:][rows])
        keep = counts[ends] - counts[:-1] >= self.size - self.edits
        return places[keep], (ends - places)[keep]


class Index:
    """All items of a block, ready for search."""

    def __init__(self, ids: list[int], texts: list[str], edit_share: float, recall: float, least_words: int, seed: int = 7):
        content = [t.encode() for t in texts]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in content])]).astype(np.int64)
        hashes, firsts = word_hashes(np.frombuffer(b"".join(content), np.uint8), offsets)
        order = [i for i in np.argsort(np.diff(firsts), kind="stable") if firsts[i + 1] > firsts[i]]
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.items = [hashes[firsts[i] : firsts[i + 1]] for i in order]
        self.edits = np.array([int(edit_share * len(w)) for w in self.items], np.int64)
        self.classes: list[SizeClass] = []
        rng = np.random.default_rng(seed)
        self.short: list[tuple[int, np.ndarray, np.ndarray]] = []
        begin = 0
        while begin < len(self.items) and len(self.items[begin]) < least_words:
            size = len(self.items[begin])
            end = begin + sum(len(w) == size for w in self.items[begin:])
            marks = marked(np.concatenate(self.items[begin:end]), np.arange(end - begin) * size, size)
            ranks = np.argsort(marks, kind="stable")
            self.short.append((size, marks[ranks], ranks + begin))
            self.edits[begin:end] = 0
            begin = end
        while begin < len(self.items):
            size = len(self.items[begin])
            end = begin
            while end < len(self.items) and len(self.items[end]) <= size * CLASS_RATIO:
                end += 1
            self.classes.append(self._fit(begin, end, size, recall, rng))
            begin = end

    def _fit(self, begin: int, end: int, size: int, recall: float, rng: np.random.Generator) -> SizeClass:
        own = self.items[begin:end]
        edits = int(self.edits[begin:end].max())
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in own])])
        words = np.concatenate(own)
        limits = np.full(len(own), size)
        copies = [edited(own[i % len(own)], int(self.edits[begin + i % len(own)]), rng) for i in range(max(256, len(own)))]
        copy_bounds = np.concatenate([[0], np.cumsum([len(w) for w in copies])])
        copy_words, of = np.concatenate(copies), np.arange(len(copies)) % len(own)
        missed = np.ones(len(copies), bool)
        rounds = []
        while missed.mean() > 1 - recall:
            coins = rng.integers(0, 1 << 63, size=size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            steps = max(1, SAMPLED - len(rounds) // PATIENCE)
            sampled = np.sort(rng.choice(size, size=min(steps, size), replace=False))
            marks = signatures(words, bounds[:-1], limits, coins, sampled)
            ranks = np.argsort(marks, kind="stable")
            rounds.append((coins, sampled, marks[ranks], ranks + begin))
            for shift in range(-edits, edits + 1):  # any window near the copy's begin may meet it
                starts = copy_bounds[:-1] + shift
                fits = (starts >= copy_bounds[:-1]) & (starts < copy_bounds[1:])
                got = signatures(copy_words, np.where(fits, starts, 0), np.minimum(size, copy_bounds[1:] - starts) * fits, coins, sampled)
                missed &= ~((got == marks[of]) & fits)
        return SizeClass(size, edits, np.unique(words), rounds)

    def search(self, words: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(row, item, edits, first word) of the verified matches, the best place of each row and item."""
        rows = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        yield from self._search_short(words, rows, firsts)
        pairs = []
        for own in self.classes:
            places, limits = own.windows(words, rows, firsts)
            if not len(places):
                continue
            for coins, sampled, marks, items in own.rounds:
                got = signatures(words, places, limits, coins, sampled)
                low, high = np.searchsorted(marks, got, "left"), np.searchsorted(marks, got, "right")
                hit = np.flatnonzero(high > low)
                counts = (high - low)[hit]
                which = np.repeat(low[hit], counts) + within(counts)
                pairs.append(np.stack([np.repeat(places[hit], counts), items[which]], axis=1))
        if not pairs or not sum(len(p) for p in pairs):
            return
        pairs = np.unique(np.concatenate(pairs), axis=0)
        for begin in range(0, len(pairs), 2048):
            part = pairs[begin : begin + 2048]
            row = rows[part[:, 0]]
            edits, place = self.verify(words, firsts, rows, part)
            good = edits <= self.edits[part[:, 1]]
            yield row[good], part[good, 1], edits[good], (place - firsts[row])[good]

    def _search_short(self, words: np.ndarray, rows: np.ndarray, firsts: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """As search(), for the short items: the first place of each row and item."""
        for size, marks, items in self.short:
            places = np.flatnonzero(np.arange(len(words)) + size <= firsts[1:][rows])
            got = marked(words, places, size)
            low, high = np.searchsorted(marks, got, "left"), np.searchsorted(marks, got, "right")
            for k in range(int((high - low).max()) if len(places) else 0):  # more than one: items with the same words
                hit = np.flatnonzero(high - low > k)
                place, item = places[hit], items[low[hit] + k]
                _, first = np.unique(np.stack([rows[place], item], axis=1), axis=0, return_index=True)
                place, item = place[first], item[first]
                same = [bool((words[p : p + size] == self.items[i]).all()) for p, i in zip(place.tolist(), item.tolist())]
                place, item = place[same], item[same]
                yield rows[place], item, np.zeros(len(place), np.int64), place - firsts[rows[place]]

    def verify(self, words: np.ndarray, firsts: np.ndarray, rows: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least edit distance of each pair's item to a stretch near the place, and where that stretch ends."""
        place, item = pairs[:, 0], pairs[:, 1]
        sizes = np.array([len(self.items[i]) for i in item])
        slack = self.edits[item]
        low = np.maximum(firsts[rows[place]], place - slack)
        high = np.minimum(firsts[rows[place] + 1], place + sizes + 2 * slack)
        width = int((high - low).max())
        at = low[:, None] + np.arange(width)
        real = at < high[:, None]
        text = np.where(real, words[np.minimum(at, len(words) - 1)], np.uint64(0))
        most = int(sizes.max())
        wanted = np.zeros((len(item), most), np.uint64)
        for k, i in enumerate(item):
            wanted[k, : sizes[k]] = self.items[i]
        ramp = np.arange(width + 1)
        costs = np.zeros((len(item), width + 1), np.int64)  # a match may begin anywhere
        final = np.zeros_like(costs)
        for i in range(most):
            new = np.empty_like(costs)
            new[:, 0] = costs[:, 0] + 1
            new[:, 1:] = np.minimum(costs[:, :-1] + (text != wanted[:, i : i + 1]), costs[:, 1:] + 1)
            costs = np.minimum.accumulate(new - ramp, axis=1) + ramp
            final = np.where((sizes == i + 1)[:, None], costs, final)
        final[:, 1:][~real] = most + 1
        best = np.argmin(final, axis=1)
        edits = final[np.arange(len(item)), best]
        return edits, np.maximum(firsts[rows[place]], low + best - sizes)


def edited(words: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    """A copy with so many random word edits."""
    out = words.tolist()
    for _ in range(edits):
        kind, at = rng.integers(3), int(rng.integers(max(1, len(out))))
        strange = int(rng.integers(1, 1 << 62))
        if kind == 0 and len(out) > 1:
            del out[at]
        elif kind == 1:
            out.insert(at, strange)
        else:
            out[at] = strange
    return np.array(out, np.uint64)


def _searcher(sent: Broadcast[Index]):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for batch in batches:
            ids = batch.column("id")
            for first, end, data, offsets in text_slices(batch.column("text"), SLICE):
                words, firsts = word_hashes(data, offsets)
                best: dict[tuple[int, int], tuple[int, int]] = {}
                for found in index.search(words, firsts) if len(words) else ():
                    for row, item, edits, place in zip(*(c.tolist() for c in found)):
                        best[row, item] = min(best.get((row, item), (edits, place)), (edits, place))
                if best:
                    keys = sorted(best)
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array([first + row for row, _ in keys])),
                            pa.array([int(index.ids[item]) for _, item in keys], pa.int64()),
                            pa.array([best[k][0] for k in keys], pa.int32()),
                            pa.array([best[k][1] for k in keys], pa.int64()),
                        ],
                        schema=ARROW,
                    )

    return search


def find_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    edit_share: float = EDIT_SHARE,
    recall: float = RECALL,
    least_words: int = LEAST_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(id, item_id, edits, first_word): one row for each document and each item found in it."""
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    out = None
    for sent in send_items(benchmark, item_text, item_id, edit_share, recall, least_words, block_bytes):
        found = rows.mapInArrow(_searcher(sent), SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out.withColumnsRenamed({"id": id, "item": item_id})


def send_items(
    benchmark: DataFrame,
    item_text: str = "text",
    item_id: str = "item_id",
    edit_share: float = EDIT_SHARE,
    recall: float = RECALL,
    least_words: int = LEAST_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> Iterator[Broadcast[Index]]:
    """The items' tables, a block of bounded size at a time; one empty block without items."""
    items = benchmark.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text")).where("text IS NOT NULL AND item IS NOT NULL")
    blocks = parts(byte_total(items, "text"), block_bytes)
    for block in range(blocks):
        own = items.where(spread(F.struct("item", "text"), blocks) == block).orderBy("item", "text").collect()
        index = Index([r["item"] for r in own], [r["text"] for r in own], edit_share, recall, least_words)
        yield benchmark.sparkSession.sparkContext.broadcast(index)


def without_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of df, unchanged, that hold no item."""

    def cleaner(sent: Broadcast[Index]):
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for first, end, data, offsets in text_slices(batch.column(text), SLICE):
                    words, firsts = word_hashes(data, offsets)
                    good = np.ones(end - first, bool)
                    for rows, *_ in sent.value.search(words, firsts) if len(words) else ():
                        good[rows] = False
                    yield batch.slice(first, end - first).filter(pa.array(good))

        return clean

    for sent in send_items(benchmark):
        df = df.mapInArrow(cleaner(sent), df.schema)
    return df


def leak_report(spark, sf_dir: str) -> DataFrame:
    return find_leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

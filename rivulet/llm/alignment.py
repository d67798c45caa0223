"""Alignment of two tokenizers over the same texts, from the byte offsets where tokens end.

Tokenizer A is a byte-level BPE file, B a sentence-piece model; both encode a space and the text.
Offsets where a token of each ends are found by galloping: each end of the shorter list is looked
for in the longer one by steps that double from the last place found, then by halving. The common
offsets cut both token lists into groups; differences of neighbouring ranks give the tokens of
each group, and the two tokens that end at a common offset are linked.

Both tokenizers always cut at a single space between other characters. So texts are split there, and each
different chunk of a slice of texts is encoded and aligned once.

1. A task aligns texts slice by slice, and keeps a slice's links as places in the slice's list of
   different id pairs, with how often each occurs.
2. Pairs are counted over all slices, so a pair goes into the shuffle once a slice, however
   common it is; the highest count of each B id follows.
3. Counts return to their slice, where the documents' links wait for them.

NULL and empty texts, and
those that the tokens of A or B do not spell, have no tokens: zeros and an empty string. Rows with
the same or a NULL id are rows of their own; each counts. Empty tables give none.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rivulet.llm.tables import settle
from rivulet.llm.text_arrays import within

MODEL_A = "/opt/tokenizers/byte_bpe_50k.json"
MODEL_B = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
SLICE_BYTES = 4 << 20
#: characters encoded at once
BATCH = 1 << 17
LANE = 64

ALIGNED = "slice long, id long, n_a long, n_b long, n_groups long, groups_sha256 string, slots binary, pairs array<long>, counts array<long>"
RESULT = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 characters stand for themselves, the other bytes in order for 256, 257, ...
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


@dataclass
class Spelling:
    """Bytes of each token id."""

    content: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes]) -> Spelling:
        sizes = np.array([len(t) for t in texts], np.int64)
        return cls(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes)

    def spelt(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the tokens, one after another."""
        sizes = self.sizes[ids]
        return self.content[np.repeat(self.starts[ids], sizes) + within(sizes)]


class Pair:
    """Both tokenizers; encodes lists of texts into id arrays and counts."""

    def __init__(self, model_a: str, model_b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_str(model_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        values = byte_values()
        entries = json.loads(model_a)
        texts = [b""] * self.a.get_vocab_size(with_added_tokens=True)
        for token, i in entries["model"]["vocab"].items():
            texts[i] = bytes(values[c] for c in token)
        for token in entries["added_tokens"]:
            texts[token["id"]] = token["content"].encode()
        self.spelling_a = Spelling.of(texts)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.spelling_b = Spelling.of(
            [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARKER, " ").encode() for i, p in enumerate(pieces)]
        )
        if not (self.spelling_a.sizes.all() and self.spelling_b.sizes.all()):
            raise ValueError("a token without bytes has no end of its own")
        #: no piece goes on after a space inside it, so texts may be cut before spaces
        self.cuttable = not any(MARKER in p.lstrip(MARKER) for p in pieces)

    def ids(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and of B for each text."""
        found = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [e.ids for e in found], self.b.encode(texts, num_threads=1)

    def joins(self, chunk: str) -> bool:
        """Whether a chunk may be encoded among others; one with a marker, which B does not spell, goes alone."""
        return self.cuttable and MARKER not in chunk and not chunk[0].isspace() and not chunk[-1].isspace()

    def encode(self, chunks: list[str], joined: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A, tokens of each chunk, and the same of B, for non-empty chunks.

        The first `joined` chunks are joined by spaces again, as a call for each would cost more than its tokens.
        """
        ids: tuple[list, list] = ([], [])
        counts: tuple[list, list] = ([], [])
        first = 0
        while first < len(chunks):
            end, size, most = first, 0, joined if first < joined else len(chunks)
            while end < most and (end == first or size + len(chunks[end]) <= BATCH):
                size += len(chunks[end]) + 1
                end += 1
            batch = chunks[first:end]
            cut = None
            if first < joined:
                ends = np.cumsum(np.fromiter((len(c.encode()) + 1 for c in batch), np.int64, len(batch)))
                found = [np.array(own[0], np.int32) for own in self.ids([" ".join(batch)])]
                cut = [_counts(own, spelling, ends) for own, spelling in zip(found, (self.spelling_a, self.spelling_b))]
            if cut is None or any(c is None for c in cut):
                single = self.ids(batch)
                cut = [np.fromiter(map(len, own), np.int64, len(batch)) for own in single]
                found = [np.fromiter(chain.from_iterable(own), np.int32, int(c.sum())) for own, c in zip(single, cut)]
            for side in (0, 1):
                ids[side].append(found[side])
                counts[side].append(cut[side])
            first = end
        return np.concatenate(ids[0]), np.concatenate(counts[0]), np.concatenate(ids[1]), np.concatenate(counts[1])

    def chunks(self, text: str) -> list[str]:
        """Parts of a text without the single spaces between them, where both tokenizers always cut."""
        return _SINGLE_SPACE.split(text) if self.cuttable else [text]


def _counts(ids: np.ndarray, spelling: Spelling, ends: np.ndarray) -> np.ndarray | None:
    """How many of the ids spell each chunk; None if a token goes over an end."""
    upto = np.cumsum(spelling.sizes[ids])
    last = np.searchsorted(upto, ends)
    if last[-1] + 1 != len(upto) or (upto[last] != ends).any():
        return None
    return np.diff(last, prepend=-1)


def gallop(short: np.ndarray, short_bounds: np.ndarray, long: np.ndarray, long_bounds: np.ndarray) -> np.ndarray:
    """For each element of the short lists, the place of the first element of its long list that is not smaller.

    List i is short[short_bounds[i]:short_bounds[i + 1]], and so for long. Lists are cut into lanes of
    LANE elements, and all lanes go on together, each from the last place it found. A place may
    be the list's end.
    """
    out = np.empty(len(short), np.int64)
    sizes = np.diff(short_bounds)
    lanes = -(-sizes // LANE)
    of = np.repeat(np.arange(len(sizes)), lanes)
    starts = short_bounds[:-1][of] + within(lanes) * LANE
    stops = np.minimum(starts + LANE, short_bounds[1:][of])
    place, limit = long_bounds[:-1][of].copy(), long_bounds[1:][of]
    padded = np.append(long, np.iinfo(long.dtype).max)
    for turn in range(LANE):
        live = np.flatnonzero(starts + turn < stops)
        if not len(live):
            break
        wanted = short[starts[live] + turn]
        low, end = place[live], limit[live]
        step = 1
        high = low.copy()  # first candidate; grows by 1, 2, 4, ...
        going = np.flatnonzero((high < end) & (padded[high] < wanted))
        while len(going):
            low[going] = high[going] + 1
            high[going] = np.minimum(high[going] + step, end[going])
            step *= 2
            going = going[(high[going] < end[going]) & (padded[high[going]] < wanted[going])]
        while True:  # the place is in [low, high]
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            less = padded[middle] < wanted[open_]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
        place[live] = low
        out[starts[live] + turn] = low
    return out


def common_ends(a: np.ndarray, a_bounds: np.ndarray, b: np.ndarray, b_bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b of the ends that each pair of lists has in common, in order."""
    a_sizes, b_sizes = np.diff(a_bounds), np.diff(b_bounds)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for drives, own, own_bounds, other, other_bounds, swap in (
        (a_sizes <= b_sizes, a, a_bounds, b, b_bounds, False),
        (a_sizes > b_sizes, b, b_bounds, a, a_bounds, True),
    ):
        lists = np.flatnonzero(drives)
        if not len(lists):
            continue
        sizes, far = np.diff(own_bounds)[lists], np.diff(other_bounds)[lists]
        mine = np.repeat(own_bounds[:-1][lists], sizes) + within(sizes)
        theirs = np.repeat(other_bounds[:-1][lists], far) + within(far)
        short, long = own[mine], other[theirs]
        ends = np.concatenate([[0], np.cumsum(far)])
        place = gallop(short, np.concatenate([[0], np.cumsum(sizes)]), long, ends)
        same = place < np.repeat(ends[1:], sizes)
        same[same] = long[place[same]] == short[same]
        pair = (mine[same], theirs[place[same]])
        found.append(pair[::-1] if swap else pair)
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    in_a, in_b = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(in_a, kind="stable")
    return in_a[order], in_b[order]


def group_text(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups of all lists written as `a1,a2|b1;`, and where each group's text ends."""
    groups = len(in_a)
    before_a, before_b = np.concatenate([[0], in_a + 1]), np.concatenate([[0], in_b + 1])
    of_a = np.repeat(np.arange(groups), np.diff(before_a))
    of_b = np.repeat(np.arange(groups), np.diff(before_b))
    at_a = np.arange(len(of_a)) + before_b[of_a]
    at_b = np.arange(len(of_b)) + before_a[of_b + 1]
    ids = np.empty(len(of_a) + len(of_b), np.int64)
    ids[at_a], ids[at_b] = a[: len(of_a)], b[: len(of_b)]
    marks = np.full(len(ids), ord(","), np.uint8)
    marks[at_a[in_a]], marks[at_b[in_b]] = ord("|"), ord(";")
    digits, sizes = decimals(int(ids.max(initial=0)))
    room = digits.shape[1]
    cells = np.empty((len(ids), room + 1), np.uint8)
    cells[:, :room] = digits[ids]
    lengths = sizes[ids]
    cells[np.arange(len(ids)), lengths] = marks
    text = cells[np.arange(room + 1) <= lengths[:, None]]
    return text, np.cumsum(lengths + 1)[at_b[in_b]] if groups else np.empty(0, np.int64)


@lru_cache(maxsize=2)
def _decimals(most: int) -> tuple[np.ndarray, np.ndarray]:
    room = len(str(most))
    texts = [str(i).ljust(room).encode() for i in range(most + 1)]
    return np.frombuffer(b"".join(texts), np.uint8).reshape(-1, room), np.array([len(str(i)) for i in range(most + 1)])


def decimals(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 to at least `most`, and how many each has."""
    room = 1 << 16
    while room <= most:
        room *= 2
    return _decimals(room)


@dataclass
class Chunks:
    """Of each chunk: tokens of A and B, both -1 if they do not spell it; its groups' text; its links."""

    n_a: np.ndarray
    n_b: np.ndarray
    texts: list[bytes]
    n_links: np.ndarray
    pairs: np.ndarray


def align(pair: Pair, chunks: list[str], joined: int = 0) -> Chunks:
    """Both tokenizers over a space and each chunk, which is not empty; `joined` as in encode()."""
    n = len(chunks)
    a, a_counts, b, b_counts = pair.encode(chunks, joined)
    raw = np.frombuffer("".join([" " + c for c in chunks]).encode(), np.uint8)
    sizes = np.fromiter((len(c.encode()) + 1 for c in chunks), np.int64, n)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    good = np.ones(n, bool)
    for spelling, ids, counts in ((pair.spelling_a, a, a_counts), (pair.spelling_b, b, b_counts)):
        ends = np.concatenate([[0], np.cumsum(spelling.sizes[ids])])[np.concatenate([[0], np.cumsum(counts)])]
        good &= np.diff(ends) == sizes
        # of those of the right length, all bytes
        spelt = spelling.spelt(ids[np.repeat(good, counts)])
        own = np.repeat(good, sizes)
        differ = np.flatnonzero(spelt != raw[own])
        good[np.repeat(np.arange(n), sizes)[own][differ]] = False
    a, b = a[np.repeat(good, a_counts)].astype(np.int64), b[np.repeat(good, b_counts)].astype(np.int64)
    a_bounds, b_bounds = (np.concatenate([[0], np.cumsum(np.where(good, c, 0))]) for c in (a_counts, b_counts))
    # chunks follow one another, so ends grow over all of them
    in_a, in_b = common_ends(np.cumsum(pair.spelling_a.sizes[a]), a_bounds, np.cumsum(pair.spelling_b.sizes[b]), b_bounds)
    n_links = np.bincount(np.repeat(np.arange(n), np.diff(a_bounds))[in_a], minlength=n)
    text, stops = group_text(a, b, in_a, in_b)
    stops = np.concatenate([[0], stops])[np.concatenate([[0], np.cumsum(n_links)])].tolist()
    text = text.tobytes()
    texts = [text[x : y - 1] for x, y in zip(stops[:-1], stops[1:])]
    bad = np.int64(-1)
    return Chunks(np.where(good, a_counts, bad), np.where(good, b_counts, bad), texts, n_links, (a[in_a] << 32) | b[in_b])


def _slices(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[list, list]]:
    """Ids and texts of consecutive rows of about `limit` bytes."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
            text = text.as_py() or ""
            if texts and held + len(text) > limit:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(id)
            texts.append(text)
            held += len(text)
    if texts:
        yield ids, texts


def _aligner(model_a: str, model_b: bytes, limit: int):
    fields = [("slice", pa.int64()), ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64())]
    fields += [("groups_sha256", pa.string()), ("slots", pa.binary()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = Pair(model_a, model_b)
        number = TaskContext.get().partitionId() << 32
        for ids, texts in _slices(batches, limit):
            place: dict[str, int] = {}
            parts = [[place.setdefault(c, len(place)) for c in pair.chunks(t)] if t else [] for t in texts]
            n_a, n_b, n_groups = (np.zeros(len(texts), np.int64) for _ in range(3))
            digests, slots = [""] * len(texts), [b""] * len(texts)
            pairs, counts = np.empty(0, np.int64), np.empty(0, np.int64)
            if place:
                chunks = list(place)
                plain = np.fromiter(map(pair.joins, chunks), bool, len(chunks))
                order = np.argsort(~plain, kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                own = align(pair, [chunks[k] for k in order.tolist()], int(plain.sum()))
                pairs, links = np.unique(own.pairs, return_inverse=True)
                counts = np.zeros(len(pairs), np.int64)
                links = links.astype(np.int32)
                firsts = np.cumsum(own.n_links) - own.n_links
                for i, part in enumerate(parts):
                    part = rank[part]
                    if not len(part) or (own.n_a[part] < 0).any():
                        continue
                    sizes = own.n_links[part]
                    held = links[np.repeat(firsts[part], sizes) + within(sizes)]
                    np.add.at(counts, held, 1)
                    n_a[i], n_b[i], n_groups[i] = own.n_a[part].sum(), own.n_b[part].sum(), len(held)
                    digests[i] = hashlib.sha256(b";".join([own.texts[k] for k in part.tolist()])).hexdigest()
                    slots[i] = held.tobytes()
                used = np.flatnonzero(counts)  # chunks of texts without tokens may hold other pairs
                if len(used) < len(pairs):
                    renamed = np.cumsum(counts > 0) - 1
                    slots = [renamed[np.frombuffer(s, np.int32)].astype(np.int32).tobytes() for s in slots]
                    pairs, counts = pairs[used], counts[used]
            more = [None]
            columns = [
                [number] * (len(texts) + 1), ids + more, n_a.tolist() + more, n_b.tolist() + more, n_groups.tolist() + more, digests + more,
                slots + more, [None] * len(texts) + [pairs], [None] * len(texts) + [counts],
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            number += 1

    return run


def _told(docs: pa.Table, known: pa.Table) -> pa.Table:
    """Adds up what is known of each document's links."""
    total, best = np.zeros((2, known.num_rows), np.int64)
    slot = known["slot"].to_numpy()
    total[slot], best[slot] = known["total"].to_numpy(), known["best"].to_numpy(zero_copy_only=False)
    lists = [np.frombuffer(s, np.int32) for s in docs["slots"].to_pylist()]
    sums = {
        "n_links": [len(s) for s in lists],
        "n_best": [int(best[s].sum()) for s in lists],
        "count_sum": [int(total[s].sum()) for s in lists],
    }
    columns = {c: docs[c] for c in ("id", "n_a", "n_b", "n_groups")}
    columns |= {name: pa.array(values, pa.int64()) for name, values in sums.items()}
    return pa.table(columns | {"groups_sha256": docs["groups_sha256"]})


def aligned(df: DataFrame, text: str, id: str, model_a: str, model_b: str, slice_bytes: int) -> DataFrame:
    """Rows of ALIGNED: one a document, and one a slice with its different id pairs; written once."""
    with open(model_a, encoding="utf-8") as a, open(model_b, "rb") as b:
        both = a.read(), b.read()
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return settle(rows.mapInArrow(_aligner(*both, slice_bytes), ALIGNED), "aligned")


def pair_counts(uses: DataFrame) -> DataFrame:
    """(pair, total, best): links of each id pair, and whether its B id has no pair with more.

    A B id has at most as many pairs as A has ids, so a window holds no more.
    """
    totals = uses.groupBy("pair").agg(F.sum("n").alias("total"))
    own = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    return totals.withColumn("best", F.col("total") == F.max("total").over(own))


def align_tokenizers(
    df: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    model_a: str = MODEL_A,
    model_b: str = MODEL_B,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row."""
    rows = aligned(df, text, id, model_a, model_b, slice_bytes)
    entry = F.arrays_zip("pairs", "counts")
    uses = rows.where("pairs IS NOT NULL").select("slice", F.posexplode(entry).alias("slot", "e"))
    uses = uses.select("slice", "slot", F.col("e.pairs").alias("pair"), F.col("e.counts").alias("n"))
    known = uses.join(pair_counts(uses), "pair").select("slice", "slot", "total", "best")
    docs = rows.where("pairs IS NULL").select(F.col("slice").alias("own"), "id", "n_a", "n_b", "n_groups", "groups_sha256", "slots")
    out = docs.groupBy("own").cogroup(known.groupBy("slice")).applyInArrow(_told, RESULT)
    return out.withColumnRenamed("id", id)

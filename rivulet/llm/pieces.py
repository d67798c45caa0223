"""Unigram segmentation into the pieces of a SentencePiece model, and back.

A text gets a space in front; spaces stand for the white-space marker. Of all ways to cut it
into pieces the one with the highest sum of log scores is taken (Viterbi; among equals the one
whose last piece begins first). A character that is no piece alone costs the lowest score less
10 and becomes its bytes' pieces. Pieces are looked up in a double-array trie, for all places
of many texts at once.

No piece of the usual models crosses from a character to a marker, or holds a line break, so
texts fall into chunks (a word with the spaces before it) that are cut independently; each
different chunk is cut once per slice of rows. For a model with such pieces a whole text is
one chunk. Decoding joins the pieces' bytes and drops the first space: the result is the text.
A marker character (U+2581) in the text itself becomes bytes, so it survives, too.

NULL and empty texts have no pieces and score 0. Rows are independent; repeated ones repeat.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast, SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField, StructType

from rivulet.llm.text_arrays import span_names, text_slices, within

MARKER = "▁"
#: what an unknown character costs beyond the lowest score
PENALTY = 10.0
#: bytes of text in a slice; bytes of different chunks cut at once
SLICE = 1 << 20
PACKET = 1 << 17
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: a model is sent to every executor; larger files are refused
MOST_MODEL_BYTES = 64 << 20

SCHEMA = "id long, pieces array<int>, n_pieces long, score double, round_trip boolean"
ARROW = pa.schema(
    [("id", pa.int64()), ("pieces", pa.list_(pa.int32())), ("n_pieces", pa.int64()), ("score", pa.float64()), ("round_trip", pa.bool_())]
)


@dataclass
class Trie:
    """Double array: the child of state s by byte b is t = base[s] + b if check[t] is s."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @classmethod
    def build(cls, keys: list[bytes]) -> Trie:
        """value[state] is the key's place in `keys`, else -1. State 0 is the root."""
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for i, key in enumerate(keys):
            node = 0
            for b in key:
                node = children[node].setdefault(b, len(children)) if b not in children[node] else children[node][b]
                if node == len(children):
                    children.append({})
                    values.append(-1)
            values[node] = i
        room = 2 * len(children) + 1024
        base, check, value = [0] * room, [-1] * room, [-1] * room
        taken = bytearray(room)
        taken[0] = 1
        value[0] = values[0]
        queue, free = [(0, 0)], 1
        for node, state in queue:
            kids = sorted(children[node].items())
            if not kids:
                continue
            low = kids[0][0]
            at = max(free, low + 1)
            tried = 0
            while True:
                at = taken.find(0, at)
                if at < 0 or at + 256 >= room:
                    grow = room
                    base += [0] * grow
                    check += [-1] * grow
                    value += [-1] * grow
                    taken += bytes(grow)
                    room += grow
                    at = max(free, low + 1)
                    continue
                if not any(taken[at - low + b] for b, _ in kids):
                    break
                at += 1
                tried += 1
            base[state] = at - low
            for b, child in kids:
                to = at - low + b
                taken[to], check[to], value[to] = 1, state, values[child]
                queue.append((child, to))
            free = taken.find(0, free)
            if tried > 4096:  # leave crowded stretches behind
                free = max(free, at - 1024)
        size = room
        pad = 256
        return cls(
            np.array(base[:size] + [0] * pad, np.int32), np.array(check[:size] + [-1] * pad, np.int32), np.array(value[:size] + [-1] * pad, np.int32)
        )

    def matches(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, value) of every key that begins at one of `starts` and ends by its end."""
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        at, state, depth = starts, np.zeros(len(starts), np.int32), 0
        while len(at):
            to = self.base[state] + data[at + depth]
            go = self.check[to] == state
            at, ends, state = at[go], ends[go], to[go]
            depth += 1
            hit = self.value[state] >= 0
            found.append((at[hit], at[hit] + depth, self.value[state[hit]]))
            more = at + depth < ends
            at, ends, state = at[more], ends[more], state[more]
        if not found:
            none = np.empty(0, np.int64)
            return none, none, none.astype(np.int32)
        return tuple(np.concatenate(column) for column in zip(*found))


@dataclass
class Vocabulary:
    """What encoding and decoding need of a model."""

    trie: Trie
    ids: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray
    lowest: float
    content: np.ndarray
    bounds: np.ndarray
    chunked: bool
    alone: np.ndarray

    @classmethod
    def load(cls, model: bytes) -> Vocabulary:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        byte_ids = np.full(256, -1, np.int32)
        texts, keys, ids, scores = [], [], [], []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                texts.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                texts.append(b"")
            else:
                texts.append(piece.replace(MARKER, " ").encode())
                keys.append(texts[-1])
                ids.append(i)
                scores.append(sp.get_score(i))
        if (byte_ids < 0).any():
            raise ValueError("the model has no pieces for single bytes")
        used = np.zeros(256, bool)
        used[list(set(b"".join(keys)))] = True
        alone = ~used
        alone[0x80:] = False  # parts of longer characters
        return cls(
            Trie.build(keys),
            np.array(ids, np.int32),
            np.array(scores),
            byte_ids,
            min(scores) - PENALTY,
            np.frombuffer(b"".join(texts), np.uint8),
            np.concatenate([[0], np.cumsum([len(t) for t in texts])]),
            not any(b" " in k.lstrip(b" ") for k in keys),
            alone,
        )

    def cut(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best pieces of each chunk data[bounds[i]:bounds[i + 1]]: ids, where each chunk's begin, scores."""
        n = len(bounds) - 1
        sizes = np.diff(bounds)
        lead = np.flatnonzero((data & 0xC0) != 0x80)
        owner = np.repeat(np.arange(n), sizes)
        stops = bounds[1:][owner[lead]]
        start, end, value = self.trie.matches(data, lead, stops)
        score = self.scores[value]
        # characters that are no piece themselves
        after = np.minimum(np.append(lead[1:], len(data)), stops)
        single = np.zeros(len(data) + 1, bool)
        follow = np.zeros(len(data) + 1, np.int64)
        follow[lead] = after
        single[start[end == follow[start]]] = True
        lone = lead[~single[lead]]
        start = np.concatenate([start, lone])
        end = np.concatenate([end, follow[lone]])
        value = np.concatenate([value, np.full(len(lone), -1, value.dtype)])
        score = np.concatenate([score, np.full(len(lone), self.lowest)])
        # forward: all edges that begin at the same place in their chunks, place by place
        place = start - bounds[owner[start]] if len(start) else start
        order = np.argsort(place, kind="stable")
        steps = np.searchsorted(place[order], np.arange(int(place.max(initial=0)) + 2))
        # a chunk's end and the next one's start are different slots
        best = np.full(len(data) + n + 1, -np.inf)
        back = np.full(len(data) + n + 1, -1, np.int64)
        best[bounds[:-1] + np.arange(n)] = 0.0
        slot_from = start + owner[start] if len(start) else start
        slot_to = end + owner[start] if len(start) else end
        for a, b in zip(steps[:-1], steps[1:]):
            e = order[a:b]
            total = best[slot_from[e]] + score[e]
            to = slot_to[e]
            better = total > best[to]
            best[to[better]] = total[better]
            back[to[better]] = e[better]
        # backward, all chunks at once
        chunk, edge = [], []
        now = np.flatnonzero(sizes > 0)
        slot = bounds[1:][now] + now
        while len(now):
            e = back[slot]
            chunk.append(now)
            edge.append(e)
            slot = slot_from[e]
            more = slot > bounds[:-1][now] + now
            now, slot = now[more], slot[more]
        finals = np.where(sizes > 0, best[bounds[1:] + np.arange(n)], 0.0)
        if not chunk:
            return np.empty(0, np.int32), np.zeros(n + 1, np.int64), finals
        step = np.repeat(np.arange(len(chunk)), [len(c) for c in chunk])
        chunk, edge = np.concatenate(chunk), np.concatenate(edge)
        order = np.lexsort((-step, chunk))
        chunk, edge = chunk[order], edge[order]
        unknown = value[edge] < 0
        counts = np.where(unknown, end[edge] - start[edge], 1)
        out = np.repeat(np.where(unknown, 0, self.ids[value[edge]]), counts).astype(np.int32)
        places = np.repeat(start[edge], counts) + within(counts)
        bytewise = np.repeat(unknown, counts)
        out[bytewise] = self.byte_ids[data[places[bytewise]]]
        firsts = np.concatenate([[0], np.cumsum(np.bincount(chunk, weights=counts, minlength=n).astype(np.int64))])
        return out, firsts, finals

    def cut_in_packets(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """cut() of PACKET bytes of chunks at a time, and of a longer chunk alone, so that its tables stay small."""
        out, firsts, scores, first, total = [], [np.zeros(1, np.int64)], [], 0, 0
        while first < len(bounds) - 1:
            end = max(first + 1, int(np.searchsorted(bounds, bounds[first] + PACKET, side="right")) - 1)
            own = bounds[first : end + 1]
            step = self.cut if own[-1] - own[0] <= PACKET else self.cut_long
            ids, begins, sums = step(data[own[0] : own[-1]], own - own[0])
            out.append(ids)
            firsts.append(begins[1:] + total)
            scores.append(sums)
            total += len(ids)
            first = end
        return np.concatenate(out) if out else np.empty(0, np.int32), np.concatenate(firsts), np.concatenate(scores) if scores else np.empty(0)

    def cut_long(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """cut() of one long chunk: pieces are looked up for a stretch of places at a time, the best way found place by place."""
        n = len(data)
        best = array("d", [-math.inf]) * (n + 1)
        size, taken = array("i", [0]) * (n + 1), array("i", [-1]) * (n + 1)
        best[0] = 0.0
        for begin in range(0, n, PACKET):
            stretch = data[begin : begin + PACKET]
            lead = begin + np.flatnonzero((stretch & 0xC0) != 0x80)
            start, end, value = self.trie.matches(data, lead, np.full(len(lead), n))
            # the lead bytes of the next character, or the end
            follow = lead + 1
            while True:
                inside = follow < n
                inside[inside] = (data[follow[inside]] & 0xC0) == 0x80
                if not inside.any():
                    break
                follow[inside] += 1
            at = np.searchsorted(lead, start)
            single = np.zeros(len(lead), bool)
            single[at[end == follow[at]]] = True
            start = np.concatenate([start, lead[~single]])
            end = np.concatenate([end, follow[~single]])
            score = np.concatenate([self.scores[value], np.full((~single).sum(), self.lowest)])
            value = np.concatenate([value, np.full((~single).sum(), -1, value.dtype)])
            order = np.argsort(start, kind="stable")
            for a, b, v, w in zip(start[order].tolist(), end[order].tolist(), value[order].tolist(), score[order].tolist()):
                total = best[a] + w
                if total > best[b]:
                    best[b], size[b], taken[b] = total, b - a, v
        at, path = n, []
        while at:
            path.append(at)
            at -= size[at]
        ends = np.array(path[::-1], np.int64)
        value, sizes = np.frombuffer(taken, np.int32)[ends], np.frombuffer(size, np.int32)[ends].astype(np.int64)
        unknown = value < 0
        counts = np.where(unknown, sizes, 1)
        out = np.repeat(np.where(unknown, 0, self.ids[value]), counts).astype(np.int32)
        places = np.repeat(ends - sizes, counts) + within(counts)
        bytewise = np.repeat(unknown, counts)
        out[bytewise] = self.byte_ids[data[places[bytewise]]]
        return out, np.array([0, len(out)]), np.array([best[n]])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, where each text's begin, and the sums of their scores."""
        n = len(offsets) - 1
        data, offsets = with_front_space(data, offsets)
        if not len(data):
            return np.empty(0, np.int32), np.zeros(n + 1, np.int64), np.zeros(n)
        begins = np.zeros(len(data), bool)
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        if self.chunked:
            space, alone = data == 0x20, self.alone[data]
            begins[1:] |= (space[1:] & ~space[:-1]) | alone[1:] | alone[:-1]
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        _, first, which = np.unique(span_names(data, starts, ends), return_index=True, return_inverse=True)
        if not same_bytes(data, starts, ends, starts[first][which]):  # names are hashes; then each chunk by itself
            first = which = np.arange(len(starts))
        sizes = (ends - starts)[first]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        chunks = data[np.repeat(starts[first] - bounds[:-1], sizes) + np.arange(bounds[-1])]
        ids, firsts, scores = self.cut_in_packets(chunks, bounds)
        counts = np.diff(firsts)[which]
        ends_at = np.concatenate([[0], np.cumsum(counts)])
        all_ids = ids[np.repeat(firsts[which] - ends_at[:-1], counts) + np.arange(ends_at[-1])]
        firsts_of_rows = np.searchsorted(starts, offsets)
        rows = np.repeat(np.arange(n), np.diff(firsts_of_rows))
        return all_ids, ends_at[firsts_of_rows], np.bincount(rows, weights=scores[which], minlength=n)

    def decode(self, ids: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and offsets of the texts whose ids begin at `firsts`, the front space still there."""
        known = (ids >= 0) & (ids < len(self.bounds) - 1)
        safe = np.where(known, ids, 0)
        sizes = np.where(known, np.diff(self.bounds)[safe], 0)
        at = np.concatenate([[0], np.cumsum(sizes)])
        return self.content[np.repeat(self.bounds[safe] - at[:-1], sizes) + np.arange(at[-1])], at[firsts]


def same_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, others: np.ndarray) -> bool:
    """Whether each span (they follow one another over all of the data) has the bytes that begin at its other place."""
    places = np.arange(len(data)) + np.repeat(others - starts, ends - starts)
    return bool((places < len(data)).all()) and np.array_equal(data[places], data)


def with_front_space(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A space before each text that is not empty."""
    filled = np.diff(offsets) > 0
    return np.insert(data, offsets[:-1][filled], np.uint8(0x20)), offsets + np.concatenate([[0], np.cumsum(filled)])


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        out = file.read(MOST_MODEL_BYTES + 1)
    if len(out) > MOST_MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MOST_MODEL_BYTES} bytes")
    return out


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary.load(model_bytes(path))


def send(sc: SparkContext, path: str) -> Broadcast[Vocabulary]:
    """The model's tables for every executor; bounded by MOST_MODEL_BYTES."""
    return sc.broadcast(vocabulary(path))


def encoded(own: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """Ids, their number, score and whether they decode to the text, for each text."""
    ids, firsts, scores = own.encode(data, offsets)
    back, ends = own.decode(ids, firsts)
    want, bounds = with_front_space(data, offsets)
    if np.array_equal(ends, bounds) and np.array_equal(back, want):
        same = np.ones(len(offsets) - 1, bool)
    else:
        same = np.array([np.array_equal(back[a:b], want[c:d]) for a, b, c, d in zip(ends, ends[1:], bounds, bounds[1:])], bool)
    lists = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(ids, pa.int32()))
    return lists, pa.array(np.diff(firsts), pa.int64()), pa.array(scores), pa.array(same)


def _encoder(sent: Broadcast[Vocabulary]):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text"), SLICE):
                own = batch.column("id").slice(first, end - first)
                yield pa.RecordBatch.from_arrays([own, *encoded(sent.value, data, offsets)], schema=ARROW)

    return encode


def encode(df: DataFrame, text: str = "text", id: str = "doc_id", model: str = MODEL) -> DataFrame:
    """(id, pieces, n_pieces, score, round_trip) for each row; round_trip: decoding gives the text back."""
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(_encoder(send(df.sparkSession.sparkContext, model)), SCHEMA).withColumnRenamed("id", id)


def add_pieces(df: DataFrame, text: str = "text", model: str = MODEL, into: str = "pieces", same: str = "round_trip") -> DataFrame:
    """The rows of df with the ids of their pieces and whether decoding gives the text back; replaces columns of these names."""
    df = df.drop(into, same)
    sent = send(df.sparkSession.sparkContext, model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(text), SLICE):
                rows = batch.slice(first, end - first)
                lists, _, _, equal = encoded(sent.value, data, offsets)
                yield pa.RecordBatch.from_arrays([*rows.columns, lists, equal], [*rows.schema.names, into, same])

    schema = StructType([*df.schema.fields, StructField(into, ArrayType(IntegerType())), StructField(same, BooleanType())])
    return df.mapInArrow(add, schema)


def _decoder(sent: Broadcast[Vocabulary]):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            lists = batch.column("pieces")
            texts = []
            for row in range(len(lists)):
                ids = lists[row].values
                if ids is None:
                    texts.append(None)
                    continue
                ids = ids.drop_null().to_numpy(zero_copy_only=False)
                back, _ = own.decode(ids, np.array([0, len(ids)]))
                texts.append(back.tobytes().removeprefix(b" ").decode(errors="replace"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    return decode


def decode(df: DataFrame, pieces: str = "pieces", id: str = "doc_id", model: str = MODEL) -> DataFrame:
    """(id, text) from lists of ids; unknown and control ids give nothing, a NULL list gives NULL."""
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(pieces).cast("array<int>").alias("pieces"))
    return rows.mapInArrow(_decoder(send(df.sparkSession.sparkContext, model)), "id long, text string").withColumnRenamed("id", id)

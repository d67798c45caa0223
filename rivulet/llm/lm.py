"""Word language model: a gated recurrent network with a class-factored softmax.

Words are lower-cased (A-Z) and split at white space; a text ends with an end token. The end
token and the most frequent words, MODEL_WORDS together, have their own probability
P(class | state) * P(word | class, state); all other words share one class and get
P(class | state) * (c + 1) / (N' + V' + 1), with the training counts among those words and one
share for all words never seen. The probabilities of all words add up to 1. At the start the
output is the unigram distribution.

Counting covers all training texts: each task counts its own words before the shuffle. Training
covers them, too: every text is learnt from once, in ROUNDS jobs over a hashed share of them;
in a job each task trains the network on its own rows by truncated backpropagation in numpy,
with the state carried from a text's first window to its last, and the tasks' weights are averaged, by tokens
and piece by piece. Counts of frequent words (COUNT_WORDS) are sent to the executors; those of
the others are joined, which no frequent word can skew.

A NULL text is empty: its one token is the end. Rows are told apart by a 64-bit hash of id and
text; repeated rows get the same scores. Without training texts all words are unseen, and the
scores are 0.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.llm.language import remainder
from rivulet.llm.tables import settle
from rivulet.llm.text_arrays import SPACES, span_names, text_slices, word_bounds

MODEL_WORDS = 4096
COUNT_WORDS = 1 << 16
#: upper bits of a word by which its count is looked up
PLACE_BITS = 18
CLASS_SIZE = 128
EMBEDDING = 16
HIDDEN = 24
WINDOW = 32
#: texts learnt from side by side; an update covers WINDOW tokens of each
STREAMS = 128
#: texts scored side by side, which changes no score
SCORE_STREAMS = 512
ROUNDS = 4
RATE = 0.05
#: bytes split into words together; arrays of this length stay in memory that is mapped already
SLICE = 1 << 18
#: tokens that training reads ahead: so many that a long text seldom starts last and runs alone
POOL = 1 << 22
#: tokens that are scored together: the more, the less time goes to the longest texts alone
SCORED = 2 << 20
#: tasks whose weights are added up first
TASKS = 32
#: words a task counts before it hands on the sums
COUNTED = 1 << 21
CHUNK = 1 << 14
#: hash that stands for the end token
END = np.uint64(0)


def sequences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words with END behind them, and where each text begins."""
    starts, ends, firsts = word_bounds(data, offsets, SPACES)
    words = span_names(data, starts, ends, fold=True)
    n = len(offsets) - 1
    firsts = firsts + np.arange(n + 1)
    out = np.full(len(words) + n, END, np.uint64)
    real = np.ones(len(out), bool)
    real[firsts[1:] - 1] = False
    out[real] = np.maximum(words, np.uint64(1))
    return out, firsts


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def counted(words: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate(words), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], ["word", "n"])

    kept: list[np.ndarray] = []
    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column("text"), SLICE):
            kept.append(sequences(data, offsets)[0])
            if sum(map(len, kept)) >= COUNTED:
                yield counted(kept)
                kept = []
    if kept:
        yield counted(kept)


@dataclass
class Vocabulary:
    """Counts of the frequent words and the model's ids of the most frequent ones."""

    words: np.ndarray
    counts: np.ndarray
    ids: np.ndarray
    size: int
    total: int
    different: int
    _places: tuple[np.ndarray, int] | None = None

    @classmethod
    def of(cls, counts: DataFrame, most: int, modelled: int) -> Vocabulary:
        total, different = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        # The first `most` words by (n desc, word): whole groups of words while they fit, then groups inside the first that
        # does not fit. Counts fall into some thousand classes of size, and words, being hashes, are even in their upper bits.
        rest, inside, fetched = most, F.lit(True), F.col("word") == int(END)
        for key in (-F.floor(F.log2("n") * 64), -F.col("n"), *(F.shiftright("word", bits) for bits in (48, 32, 16, 0))):
            full, cut = None, None
            for row in counts.where(inside).groupBy(key.alias("group")).count().orderBy("group").collect():
                if row["count"] > rest:
                    cut = row
                    break
                full, rest = row["group"], rest - row["count"]
            if full is not None:
                fetched |= inside & (key <= full)
            if cut is None or not rest:
                break
            inside &= key == cut["group"]
            if cut["count"] <= most:
                fetched |= inside
                break
        top = counts.where(fetched).collect()
        top.sort(key=lambda r: (r["word"] != int(END), -r["n"], r["word"]))
        top = top[:most]
        words = np.array([r["word"] for r in top], np.int64).view(np.uint64)
        number = np.array([r["n"] for r in top], np.int64)
        ids = np.where(np.arange(len(top)) < modelled, np.arange(len(top)), -1)
        order = np.argsort(words)
        return cls(words[order], number[order], ids[order], min(modelled, len(top)), int(total), int(different))

    def places(self) -> tuple[np.ndarray, int]:
        """Where the words with each PLACE_BITS upper bits begin, and how many such words there are at most."""
        if self._places is None:
            starts = np.searchsorted(self.words, np.arange(1 << PLACE_BITS, dtype=np.uint64) << np.uint64(64 - PLACE_BITS))
            most = int(np.diff(np.append(starts, len(self.words))).max())
            self._places = np.minimum(starts, len(self.words) - 1).astype(np.int32), most
        return self._places

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts (-1: not sent) and model ids (`size`: none of its own)."""
        if not len(self.words):
            return np.full(len(words), -1), np.full(len(words), self.size)
        firsts, most = self.places()
        at = firsts[(words >> np.uint64(64 - PLACE_BITS)).astype(np.int64)]
        later = np.arange(len(words))
        for _ in range(most - 1):  # words with the same upper bits are few, as they are hashes
            later = later[self.words[at[later]] < words[later]]
            if not len(later):
                break
            at[later] += 1
            np.minimum(at, len(self.words) - 1, out=at)
        known = self.words[at] == words
        ids = np.where(known & (self.ids[at] >= 0), self.ids[at], self.size)
        return np.where(known, self.counts[at], -1), ids

    def model_counts(self) -> np.ndarray:
        """Counts by model id, then of all other words together."""
        own = np.zeros(self.size, np.int64)
        own[self.ids[self.ids >= 0]] = self.counts[self.ids >= 0]
        return np.append(own, self.total - own.sum())


class Room:
    """Arrays that are used again by name, so that no window maps memory for new ones."""

    def __init__(self) -> None:
        self._kept: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int, like: np.ndarray) -> np.ndarray:
        """An array of this shape with any content, which lasts until the name is asked for again."""
        size, flat = math.prod(shape), self._kept.get(name)
        if flat is None or len(flat) < size or flat.dtype != like.dtype:
            flat = self._kept[name] = np.empty(size, like.dtype)
        return flat[:size].reshape(shape)

    def __reduce__(self) -> tuple:
        return Room, ()


class Network:
    """Gated recurrent network over model ids; the input after the last id marks a text's start."""

    # values: inputs, state, classes, class bias, words, word bias, projection of the inputs
    def __init__(self, counts: np.ndarray, hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.size, self.hidden = len(counts) - 1, hidden
        self.n_classes = -(-self.size // CLASS_SIZE)
        room = self.n_classes * CLASS_SIZE
        mass = np.append(np.add.reduceat(np.append(counts[:-1], np.zeros(room - self.size)), np.arange(0, room, CLASS_SIZE)) if room else [], counts[-1])
        shapes = [(self.size + 2, EMBEDDING), (hidden, 3 * hidden), (hidden, self.n_classes + 1), None, (room, hidden), None, (EMBEDDING, 3 * hidden)]
        values = [rng.normal(0, 0.2, s).astype(np.float32) if s else None for s in shapes]
        values[3] = np.log((mass + 1.0) / (mass + 1.0).sum()).astype(np.float32)
        values[5] = np.full(room, -30.0, np.float32)  # places without a word
        values[5][: self.size] = np.log((counts[:-1] + 1.0) / (np.repeat(mass[:-1], CLASS_SIZE)[: self.size] + CLASS_SIZE))
        self.values = values
        self.squares = [np.full_like(v, 1e-6) for v in values]
        self.room = Room()

    def vector(self) -> np.ndarray:
        """All weights and the roots of the gradients' square sums."""
        return np.concatenate([v.ravel() for v in self.values] + [np.sqrt(v).ravel() for v in self.squares])

    def set_vector(self, flat: np.ndarray) -> None:
        at = 0
        for group, power in ((self.values, 1), (self.squares, 2)):
            for i, v in enumerate(group):
                group[i] = (flat[at : at + v.size].reshape(v.shape) ** power).astype(np.float32)
                at += v.size

    def projected(self) -> np.ndarray:
        """What each input adds to the gates."""
        return self.values[0] @ self.values[6]

    def step(self, x: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """turned_step() of streams that are rows."""
        return tuple(v.T for v in self.turned_step(self.values[1].T, x.T, fresh, h.T))

    def turned_step(self, weights: np.ndarray, x: np.ndarray, fresh: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """One step of all streams from their projected inputs: new state, and what going back needs.

        All are (places, streams), which leaves the gates' parts in one piece each; `weights` are those of the state, turned.
        """
        size = self.hidden
        held = np.where(fresh, np.float32(0), h) if fresh.any() else h
        u = weights @ held
        gates = x[: 2 * size] + u[: 2 * size]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        u = u[2 * size :]
        new = gates[size:] * u
        new += x[2 * size :]
        np.tanh(new, out=new)
        state = held - new
        state *= gates[:size]
        state += new
        return state, held, gates, new, u

    def output(self, h: np.ndarray, target: np.ndarray, grads: list | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """ln P of each target; with `grads`, adds to the gradients and returns that of the states (kept in `room`).

        The biases are the weights of a state that is always 1. Exponentials stay undivided by their sums: the
        few columns of states and of their gradients are divided instead.
        """
        kind = np.where(target < self.size, target // CLASS_SIZE, self.n_classes)
        order = np.argsort(kind.astype(np.int16), kind="stable")
        kind, target = kind[order], target[order]
        room, n, wide = self.room, len(target), self.hidden + 1
        states = room("states", n, wide, like=h)
        states[:, :-1] = np.take(h, order, axis=0, out=room("sorted", n, self.hidden, like=h), mode="clip")
        states[:, -1] = 1
        classes = np.vstack([self.values[2], self.values[3]])
        words = room("words", len(self.values[4]), wide, like=self.values[4])
        words[:, :-1], words[:, -1] = self.values[4], self.values[5]
        by_class = room("by_class", self.n_classes, wide, CLASS_SIZE, like=words)
        by_class[:] = words.reshape(-1, CLASS_SIZE, wide).transpose(0, 2, 1)
        most = max(1.0, float(states.max(initial=0)), -float(states.min(initial=0)))
        # no sum of weights can reach the limit of the exponentials in most cases
        sizes = ((np.abs(w, out=room("sizes", *w.shape, like=w)), a) for w, a in ((classes, 0), (words, 1)))
        high = most * max(float(w.sum(axis=a).max(initial=0)) for w, a in sizes) > 60

        def soft(logits: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            """ln P of the targets, exponentials (in place), sums, and where the targets stand."""
            if high:
                np.minimum(logits, np.float32(60), out=logits)
            flat, place = logits.ravel(), np.arange(0, logits.size, logits.shape[1]) + at
            own = flat[place]
            np.exp(logits, out=logits)
            total = logits @ np.ones(logits.shape[1], np.float32)
            return own - np.log(total), flat, total, place

        turned = back = None
        if grads is not None:
            turned = room("turned_states", wide, n, like=h)
            turned[:] = states.T

        def learnt(flat: np.ndarray, logits: np.ndarray, total: np.ndarray, place: np.ndarray, own: slice) -> tuple[np.ndarray, np.ndarray]:
            """Gradients by the weights, (hidden + 1, columns), and what the states' ones are to be divided by."""
            flat[place] -= total
            share = 1 / total
            shared = np.multiply(turned[:, own], share, out=room("shared", wide, len(share), like=h))
            return shared @ logits, share[:, None]

        logits = np.matmul(states, classes, out=room("class_logits", n, classes.shape[1], like=h))
        found, flat, total, place = soft(logits, kind)
        if grads is not None:
            by, share = learnt(flat, logits, total, place, slice(None))
            grads[2] += by[:-1]
            grads[3] += by[-1]
            back = np.matmul(logits, self.values[2].T, out=room("back", n, self.hidden, like=h))
            back *= share
        cuts = np.searchsorted(kind, np.arange(self.n_classes + 1)).tolist()
        most = max((end - at for at, end in zip(cuts, cuts[1:])), default=0)
        all_logits, all_onto = room("logits", most, CLASS_SIZE, like=h), room("onto_class", most, self.hidden, like=h)
        target -= kind * CLASS_SIZE
        if grads is not None:
            by_words = room("by_words", self.n_classes, wide, CLASS_SIZE, like=h)
            by_words.fill(0)
        for c in range(self.n_classes):
            own, size = slice(cuts[c], cuts[c + 1]), cuts[c + 1] - cuts[c]
            if not size:
                continue
            part = slice(c * CLASS_SIZE, (c + 1) * CLASS_SIZE)
            logits = np.matmul(states[own], by_class[c], out=all_logits[:size])
            more, flat, total, place = soft(logits, target[own])
            found[own] += more
            if grads is not None:
                by_words[c], share = learnt(flat, logits, total, place, own)
                onto = np.matmul(logits, self.values[4][part], out=all_onto[:size])
                onto *= share
                back[own] += onto
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        if back is not None:
            grads[4].reshape(self.n_classes, CLASS_SIZE, -1)[:] += by_words[:, :-1].transpose(0, 2, 1)
            grads[5].reshape(self.n_classes, CLASS_SIZE)[:] += by_words[:, -1]
            back = np.take(back, place, axis=0, out=room("sorted", n, self.hidden, like=h), mode="clip")
        return found[place], back

    def learn(self, before: np.ndarray, fresh: np.ndarray, target: np.ndarray, h: np.ndarray, rate: float) -> np.ndarray:
        """One window (steps, streams), targets below 0 being no tokens; returns the state after it."""
        size, (steps, streams) = self.hidden, before.shape
        n, inputs, like = steps * streams, self.values[0], self.values[1]

        def room(name: str, *shape: int) -> np.ndarray:
            return self.room(name, *shape, like=like)

        read = np.take(inputs, before, axis=0, out=room("read", steps, streams, inputs.shape[1]), mode="clip")
        x = np.matmul(np.ascontiguousarray(self.values[6].T), read.transpose(0, 2, 1), out=room("x", steps, 3 * size, streams))
        weights, now = np.ascontiguousarray(like.T), np.ascontiguousarray(h.T)
        states, held, new, u = (room(name, steps, size, streams) for name in ("after", "held", "new", "u"))
        gates = room("gates", steps, 2 * size, streams)
        for t in range(steps):
            now, held[t], gates[t], new[t], u[t] = self.turned_step(weights, x[t], fresh[t], now)
            states[t] = now
        keep, use = gates[:, :size], gates[:, size:]
        grads = [None] + [room(f"gradient {i}", *v.shape) for i, v in enumerate(self.values) if i]
        for g in grads[1:]:
            g.fill(0)
        real = target.ravel() >= 0
        count = max(1, int(real.sum()))
        rows = room("rows", steps, streams, size)
        rows[:] = states.transpose(0, 2, 1)
        rows = rows.reshape(n, size)
        if count == n:
            by_row = self.output(rows, target.ravel(), grads)[1]
        else:
            by_row = room("by_row", n, size)
            by_row.fill(0)
            by_row[real] = self.output(rows[real], target.ravel()[real], grads)[1]
        onto = room("onto", steps, size, streams)
        onto[:] = by_row.reshape(steps, streams, size).transpose(0, 2, 1)
        by_new, by_keep, by_use, rest = (room(name, steps, size, streams) for name in ("by_new", "by_keep", "by_use", "rest"))
        # (1 - keep) * (1 - new * new), (held - new) * keep * (1 - keep), u * use * (1 - use)
        np.multiply(new, new, out=by_new)
        np.subtract(1, by_new, out=by_new)
        np.subtract(1, keep, out=rest)
        by_new *= rest
        np.subtract(held, new, out=by_keep)
        by_keep *= keep
        by_keep *= rest
        np.multiply(u, use, out=by_use)
        np.subtract(1, use, out=rest)
        by_use *= rest
        inner = room("inner", steps, 3 * size, streams)
        into = room("into", steps, size, streams)
        dh, cut = np.zeros_like(now), fresh.any(axis=1)
        for t in range(steps - 1, -1, -1):
            dh += onto[t]
            d_new = np.multiply(dh, by_new[t], out=into[t])
            np.multiply(dh, by_keep[t], out=inner[t, :size])
            np.multiply(d_new, by_use[t], out=inner[t, size : 2 * size])
            np.multiply(d_new, use[t], out=inner[t, 2 * size :])
            dh *= keep[t]
            dh += self.values[1] @ inner[t]
            if cut[t]:
                dh[:, fresh[t]] = 0
        turned, past = room("turned", steps, streams, 3 * size), room("past", steps, streams, size)
        turned[:], past[:] = inner.transpose(0, 2, 1), held.transpose(0, 2, 1)
        flat = turned.reshape(n, -1)
        np.matmul(past.reshape(n, -1).T, flat, out=grads[1])
        turned[:, :, 2 * size :] = into.transpose(0, 2, 1)
        np.matmul(read.reshape(n, -1).T, flat, out=grads[6])
        into = np.matmul(flat, self.values[6].T, out=room("into_inputs", n, inputs.shape[1]))
        for i in range(1, len(self.values)):
            g, part = grads[i], room("part", *grads[i].shape)
            g /= count
            self.squares[i] += np.multiply(g, g, out=part)
            g /= np.sqrt(self.squares[i], out=part)
            g *= rate
            self.values[i] -= g
        flat = before.ravel()
        order = np.argsort(flat.astype(np.int16) if self.size < 1 << 15 else flat, kind="stable")
        flat = flat[order]
        heads = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
        sorted_into = np.take(into, order, axis=0, out=room("sorted_into", *into.shape), mode="clip")
        rows, g = flat[heads], np.add.reduceat(sorted_into, heads) / count
        self.squares[0][rows] += g * g
        self.values[0][rows] -= rate * g / np.sqrt(self.squares[0][rows])
        return now.T


def packed(ids: np.ndarray, firsts: np.ndarray, start: int, streams: int) -> tuple[np.ndarray, ...]:
    """Texts laid end to end in streams of about one length, longest first.

    (inputs, fresh, targets, place of each target in ids, streams still running at each step);
    all but the last are (steps, streams).
    """
    sizes = np.diff(firsts)
    streams = min(streams, len(sizes))
    heap = [(0, s) for s in range(streams)]
    stream, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for r in np.argsort(-sizes, kind="stable").tolist():
        length, s = heapq.heappop(heap)
        stream[r], offset[r] = s, length
        heapq.heappush(heap, (length + int(sizes[r]), s))
    lengths = np.bincount(stream, weights=sizes, minlength=streams).astype(np.int64)
    rank = np.empty(streams, np.int64)
    rank[np.argsort(-lengths, kind="stable")] = np.arange(streams)
    steps = int(lengths.max())
    place = np.arange(len(ids))
    cell = place * streams
    cell += np.repeat((offset - firsts[:-1]) * streams + rank[stream], sizes)
    at, target = (np.full((steps, streams), -1, np.int32) for _ in range(2))
    at.ravel()[cell] = place
    target.ravel()[cell] = ids
    fresh = np.zeros((steps, streams), bool)
    fresh[offset, rank[stream]] = True
    before = np.full((steps, streams), start, np.int32)
    before[1:] = np.where(target[:-1] >= 0, target[:-1], start)
    before[fresh] = start
    return before, fresh, target, at, (at >= 0).sum(axis=1)


def windows(texts: Iterator[np.ndarray], start: int, streams: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(streams that run, inputs, fresh, targets) of one window after another; all but the first are (steps, streams).

    A text stays in its stream from its first token to its last. A stream that is through takes the
    longest of the waiting texts, of which about POOL tokens are read ahead.
    """
    waiting: list[tuple[int, int, np.ndarray]] = []
    ahead, order = 0, count()
    own: list[np.ndarray | None] = [None] * streams
    places = [0] * streams
    last = np.full(streams, start, np.int32)
    more = True
    while True:
        target = np.full((streams, WINDOW), -1, np.int32)
        fresh = np.zeros((streams, WINDOW), bool)
        for s in range(streams):
            at = 0
            while at < WINDOW:
                if own[s] is None:
                    while more and ahead < POOL:
                        ids = next(texts, None)
                        if ids is None:
                            more = False
                        else:
                            heapq.heappush(waiting, (-len(ids), next(order), ids))
                            ahead += len(ids)
                    if not waiting:
                        break
                    own[s], places[s] = heapq.heappop(waiting)[2], 0
                    ahead -= len(own[s])
                    fresh[s, at] = True
                ids, place = own[s], places[s]
                n = min(WINDOW - at, len(ids) - place)
                target[s, at : at + n] = ids[place : place + n]
                at, places[s] = at + n, place + n
                if places[s] == len(ids):
                    own[s] = None
        run = np.flatnonzero(target[:, 0] >= 0)
        if not len(run):
            return
        before = np.column_stack([last, target[:, :-1]])
        before[fresh | (target < 0)] = start
        last = target[:, -1]
        yield run, *(np.ascontiguousarray(v[run].T) for v in (before, fresh, target))


def log_likelihoods(net: Network, ids: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """ln P of each token, the class share alone for words without an id."""
    before, fresh, target, at, running = packed(ids, firsts, net.size + 1, SCORE_STREAMS)
    h = np.zeros((net.hidden, before.shape[1]), np.float32)
    out = np.zeros(len(ids))
    onto, weights = (np.ascontiguousarray(net.values[i].T) for i in (6, 1))
    states, places, waiting = [], [], 0
    for t, n in enumerate(running.tolist()):
        h = net.turned_step(weights, onto @ net.values[0][before[t, :n]].T, fresh[t, :n], h[:, :n])[0]
        states.append(h.T)
        places.append(at[t, :n])
        waiting += n
        if waiting >= CHUNK or t + 1 == len(running):
            own = np.concatenate(places)
            out[own] = net.output(np.concatenate(states), ids[own])[0]
            states, places, waiting = [], [], 0
    return out


def _trainer(net: Broadcast[Network], vocabulary: Broadcast[Vocabulary]):
    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Network.__new__(Network)
        own.__dict__ = {**net.value.__dict__, "values": [v.copy() for v in net.value.values], "squares": [v.copy() for v in net.value.squares], "room": Room()}
        tokens = 0

        def texts() -> Iterator[np.ndarray]:
            nonlocal tokens
            for batch in batches:
                for _, _, data, offsets in text_slices(batch.column("text"), SLICE):
                    words, firsts = sequences(data, offsets)
                    tokens += len(words)
                    ids = vocabulary.value.look_up(words)[1].astype(np.int32)
                    yield from (part.copy() for part in np.split(ids, firsts[1:-1]))

        h = np.zeros((STREAMS, own.hidden), np.float32)
        for run, before, fresh, target in windows(texts(), own.size + 1, STREAMS):
            h[run] = own.learn(before, fresh, target, h[run], RATE)
        if tokens:
            flat = own.vector().astype(np.float32)
            pieces = [flat[i : i + CHUNK].tobytes() for i in range(0, len(flat), CHUNK)]
            n = len(pieces)
            salt = TaskContext.get().partitionId() // TASKS
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, salt, np.int32)), pa.array(np.full(n, tokens)), pa.array(pieces, pa.binary())],
                ["piece", "salt", "tokens", "mean"],
            )

    return train


def _average(table: pa.Table) -> pa.Table:
    weights = table["tokens"].to_numpy()
    total = sum(np.frombuffer(v, np.float32) * np.float64(w) for v, w in zip(table["mean"].to_pylist(), weights))
    mean = (total / weights.sum()).astype(np.float32).tobytes()
    first = table.slice(0, 1)
    return pa.table({"piece": first["piece"], "salt": first["salt"], "tokens": [int(weights.sum())], "mean": pa.array([mean], pa.binary())})


PIECES = "piece int, salt int, tokens long, mean binary"


def fit(training: DataFrame, vocabulary: Broadcast[Vocabulary], key: Column, rounds: int = ROUNDS) -> Network:
    """Trains on all texts, a hashed share in each round, from the averaged weights of the one before."""
    sc = training.sparkSession.sparkContext
    net = Network(vocabulary.value.model_counts())
    for turn in range(rounds):
        rows = training.where(F.pmod(F.xxhash64(F.lit("round"), key), F.lit(rounds)) == turn).select("text")
        trained = rows.mapInArrow(_trainer(sc.broadcast(net), vocabulary), PIECES)
        for by in (["piece", "salt"], ["piece"]):
            trained = trained.groupBy(*by).applyInArrow(_average, PIECES)
        found = sorted(trained.collect(), key=lambda r: r["piece"])
        if found:
            net.set_vector(np.concatenate([np.frombuffer(r["mean"], np.float32) for r in found]))
    return net


RARE = pa.struct([("word", pa.int64()), ("n", pa.int32())])
LOCAL = (
    "key long, id long, held_out boolean, n_tokens long, n_known long, n_shared long, logs double, shared double, model double, "
    "rare array<struct<word: long, n: int>>"
)


def rare_words(words: np.ndarray, row: np.ndarray, n: int) -> pa.ListArray:
    """(word, how often) of each of n rows."""
    order = np.lexsort((words, row))
    words, row = words[order], row[order]
    heads = np.ones(len(words), bool)
    heads[1:] = (words[1:] != words[:-1]) | (row[1:] != row[:-1])
    heads = np.flatnonzero(heads)
    often = np.diff(np.append(heads, len(words))).astype(np.int32)
    bounds = np.searchsorted(row[heads], np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays([pa.array(words[heads].view(np.int64)), pa.array(often)], fields=list(RARE)))


def _scorer(net: Broadcast[Network], vocabulary: Broadcast[Vocabulary]):
    """What each text's score needs, and its words whose counts are not among the sent ones."""

    def scored(rows: list[pa.RecordBatch], parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        own = vocabulary.value
        words = np.concatenate([w for w, _ in parts])
        sizes = np.concatenate([np.diff(f) for _, f in parts])
        firsts, n = np.concatenate([[0], np.cumsum(sizes)]), len(sizes)
        counts, ids = own.look_up(words)
        row = np.repeat(np.arange(n), sizes)
        logs = np.where(counts >= 0, np.log10(np.maximum(counts, 0) + 1.0), 0.0)
        shared = ids == own.size

        def by_row(values: np.ndarray) -> np.ndarray:
            return np.bincount(row, weights=values, minlength=n)

        numbers = [sizes, by_row(counts > 0), by_row(shared)]
        sums = [by_row(logs), by_row(np.where(shared, logs, 0.0)), by_row(log_likelihoods(net.value, ids, firsts)) / np.log(10)]
        names = ["key", "id", "held_out", "n_tokens", "n_known", "n_shared", "logs", "shared", "model", "rare"]
        given = [pa.concat_arrays([r.column(c) for r in rows]) for c in names[:3]]
        rare = rare_words(words[counts < 0], row[counts < 0], n)
        return pa.RecordBatch.from_arrays(given + [pa.array(v.astype(np.int64)) for v in numbers] + [pa.array(v) for v in sums] + [rare], names)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[pa.RecordBatch] = []
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            named = batch.select(["key", "id", "held_out"])
            for first, end, data, offsets in text_slices(batch.column("text")):
                rows.append(named.slice(first, end - first))
                parts.append(sequences(data, offsets))
                if sum(len(w) for w, _ in parts) >= SCORED:
                    yield scored(rows, parts)
                    rows, parts = [], []
        if rows:
            yield scored(rows, parts)

    return score


def likelihoods(df: DataFrame, held_out: Column, text: str = "text", id: str = "doc_id") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score); learns from the rows not held out."""
    rows = df.select(
        F.xxhash64(F.col(id), F.col(text)).alias("key"), F.col(id).cast("long").alias("id"), held_out.alias("held_out"), F.col(text).alias("text")
    )
    training = rows.where("NOT held_out")
    counts = settle(
        training.select("text").mapInArrow(_count_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "counts"
    )
    sc = df.sparkSession.sparkContext
    own = Vocabulary.of(counts, COUNT_WORDS, MODEL_WORDS)
    sent = sc.broadcast(own)
    net = fit(training, sent, F.col("key"))

    local = settle(rows.mapInArrow(_scorer(sc.broadcast(net), sent), LOCAL), "local")
    rare = local.select("key", F.inline("rare").alias("word", "n"))
    seen = rare.join(counts.withColumnRenamed("n", "c"), "word")
    sums = seen.groupBy("key").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("logs_rare"), F.sum("n").alias("known_rare"))
    copies = local.groupBy("key").agg(F.count("*").alias("copies"))
    more = sums.join(copies, "key").select("key", (F.col("logs_rare") / F.col("copies")).alias("logs_rare"), (F.col("known_rare") / F.col("copies")).alias("known_rare"))
    outside = float(own.total - own.model_counts()[:-1].sum()) + (own.different - own.size) + 1
    extra, known = F.coalesce("logs_rare", F.lit(0.0)), F.coalesce("known_rare", F.lit(0.0))
    return local.drop("rare").join(more, "key", "left").select(
        F.col("id").alias(id),
        "held_out",
        "n_tokens",
        (F.col("n_known") + known).cast("long").alias("n_known"),
        F.lit(own.total).cast("long").alias("train_tokens"),
        (F.col("logs") + extra - F.col("n_tokens") * F.log10(F.lit(float(own.total + own.different + 1)))).alias("base_score"),
        (F.col("model") + F.col("shared") + extra - F.col("n_shared") * F.log10(F.lit(outside))).alias("score"),
    )


def likelihood_report(df: DataFrame) -> DataFrame:
    """Learns from the documents whose remainder by 7 is not 2 and scores all."""
    return likelihoods(df, remainder(F.col("doc_id"), 7) == 2)

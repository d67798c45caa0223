"""Licence notices: exact phrases by word, and short notices with a bounded number of edits.

Text is lower-cased (A-Z) and reduced to its words, one space between them. A notice of n
characters may have up to n // 12 edits, at least one: it is split into one piece more than
that, so every place of it holds one piece unchanged (pigeonhole). An Aho-Corasick automaton
finds the pieces in whole texts; around each the `regex` library matches the notice with that
bound of insertions, deletions and substitutions and tells how many there were.

A NULL or empty text has no words, no places and score 0. Rows are independent of each other;
repeated ones give repeated results.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from rivulet.llm.text_arrays import LOWER, PUNCTUATION, hash_of, prefix_hashes, span_hashes, text_slices, word_bounds

# Phrases that are counted word by word, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: (label, notice) for the search with edits
NOTICES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("cc-by", "creative commons attribution 4 0 international"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc0", "dedicated to the public domain under cc0"),
    ("gpl", "gnu general public license"),
    ("gpl-3.0", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("isc", "permission to use copy modify and or distribute this software"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mpl-2.0", "subject to the terms of the mozilla public license"),
    ("reserved", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]
CHARS_PER_EDIT = 12

SCHEMA = "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans string"
ARROW = pa.schema(
    [("id", pa.int64())]
    + [(n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.string())]
)


def most_edits(notice: str) -> int:
    return max(1, len(notice) // CHARS_PER_EDIT)


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """(place, piece): the notice in edits + 1 pieces of about the same length."""
    cuts = [round(i * len(notice) / (edits + 1)) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Notices:
    """Seeds and patterns of (label, notice) pairs."""

    def __init__(self, notices: list[tuple[str, str]]):
        self.notices = [(label, notice, most_edits(notice)) for label, notice in notices]
        self.patterns = [regex.compile(f"(?e)(?:{regex.escape(n, literal_spaces=True)}){{e<={k}}}") for _, n, k in self.notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, (_, notice, edits) in enumerate(self.notices):
            for place, piece in pieces(notice, edits):
                seeds.setdefault(piece, []).append((i, place))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.automaton.add_word(piece, (len(piece), uses))
        self.automaton.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """For each notice the merged ranges in which it can lie."""
        out: dict[int, list[list[int]]] = {}
        for last, (size, uses) in self.automaton.iter(text):
            begin = last + 1 - size
            for i, place in uses:
                _, notice, edits = self.notices[i]
                a, b = begin - place - edits, begin - place + len(notice) + edits
                own = out.setdefault(i, [])
                own.append([max(0, a), b])
        for i, own in out.items():
            own.sort()
            merged = [own[0]]
            for a, b in own[1:]:
                if a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            out[i] = merged
        return out

    def find(self, text: str) -> list[tuple[int, int, str, int, float]]:
        """(start, end, label, edits, score) of the notices in a normalised text, without those in the place of one of fewer edits."""
        found = []
        for i, ranges in self.windows(text).items():
            label, notice, _ = self.notices[i]
            for a, b in ranges:
                for match in self.patterns[i].finditer(text, a, min(b, len(text))):
                    edits = sum(match.fuzzy_counts)
                    found.append((match.start(), match.end(), label, edits, 1 - edits / len(notice)))
        return sorted(without_worse(found))


def without_worse(found: list[tuple[int, int, str, int, float]]) -> list[tuple[int, int, str, int, float]]:
    """Matches whose place no match of fewer edits takes up: one that begins and ends no more than the match's edits inside it.

    One sweep for each number of edits: of those with fewer that begin early enough, the one that ends last decides.
    """
    found = sorted(found)
    out = []
    for edits in sorted({f[3] for f in found}):
        fewer = [f for f in found if f[3] < edits]
        starts = [f[0] for f in fewer]
        ends = list(accumulate((f[1] for f in fewer), max))
        for f in found:
            if f[3] == edits:
                at = bisect_right(starts, f[0] + edits)
                if not at or ends[at - 1] + edits < f[1]:
                    out.append(f)
    return out


def word_places(text: str, places: list[int]) -> dict[int, int]:
    """How many spaces are before each of the places, in one walk over the text."""
    out, upto, count = {}, 0, 0
    for place in sorted(set(places)):
        count += text.count(" ", upto, place)
        out[place], upto = count, place
    return out


@lru_cache(maxsize=4)
def compiled(notices: tuple[tuple[str, str], ...]) -> Notices:
    return Notices(list(notices))


def phrase_places(hashes: np.ndarray, rows: np.ndarray, phrase: str) -> np.ndarray:
    """Indices of the words at which the phrase begins."""
    wanted = [np.uint64(hash_of(word)) for word in phrase.split()]
    room = max(0, len(hashes) - len(wanted) + 1)
    here = np.ones(room, dtype=bool)
    for i, value in enumerate(wanted):
        here &= hashes[i : i + room] == value
    at = np.flatnonzero(here)
    return at[rows[at] == rows[at + len(wanted) - 1]]


def spaced(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words, each with a space behind it, and where each row's words begin."""
    sizes = ends - starts + 1
    at = np.concatenate([[0], np.cumsum(sizes)])
    source = np.repeat(starts - at[:-1], sizes) + np.arange(at[-1])
    out = data[np.minimum(source, max(0, len(data) - 1))] if at[-1] else np.empty(0, dtype=np.uint8)
    out[at[1:] - 1] = 0x20
    return out.tobytes(), at[firsts]


def _scanner(phrases: dict[str, str], notices: tuple[tuple[str, str], ...]):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = compiled(notices)
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text")):
                n = end - first
                data = LOWER[data]
                starts, ends, firsts = word_bounds(data, offsets, PUNCTUATION)
                hashes = span_hashes(prefix_hashes(data), starts, ends)
                n_words = np.diff(firsts)
                rows = np.repeat(np.arange(n), n_words)
                n_base, lo, hi = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                base: list[set[str]] = [set() for _ in range(n)]
                for phrase, label in phrases.items():
                    at = phrase_places(hashes, rows, phrase)
                    row, word = rows[at], at - firsts[rows[at]]
                    np.add.at(n_base, row, 1)
                    np.minimum.at(lo, row, word)
                    np.maximum.at(hi, row, word)
                    for r in set(row.tolist()):
                        base[r].add(label)
                content, bounds = spaced(data, starts, ends, firsts)
                labels, scores, spans = [], [], []
                for r in range(n):
                    text = content[bounds[r] : bounds[r + 1]].decode(errors="replace")
                    found = search.find(text)
                    labels.append(",".join(sorted(base[r] | {f[2] for f in found})))
                    scores.append(1.0 if base[r] else max((f[4] for f in found), default=0.0))
                    words = word_places(text, [p for f in found for p in f[:2]])
                    spans.append(",".join(f"{f[2]}:{words[f[0]]}:{words[f[1]]}:{f[3]}" for f in found))
                none = n_base == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(first, n),
                        pa.array(n_words),
                        pa.array(n_base),
                        pa.array(lo, mask=none),
                        pa.array(hi, mask=none),
                        pa.array([",".join(sorted(b)) for b in base]),
                        pa.array(labels),
                        pa.array(scores, pa.float64()),
                        pa.array(spans),
                    ],
                    schema=ARROW,
                )

    return scan


def licence_scan(
    df: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    phrases: dict[str, str] = PHRASES,
    notices: list[tuple[str, str]] = NOTICES,
) -> DataFrame:
    """One row for each row of df.

    n_words, n_base, first_word, last_word, base_labels: the phrases' places. labels: those
    and the notices' labels. score: 1 with a phrase, else 1 - edits / length of the best
    notice, else 0. spans: label:first word:last word:edits of the notices found.
    """
    rows = df.select(df[id].cast("long").alias("id"), df[text].alias("text"))
    return rows.mapInArrow(_scanner(dict(phrases), tuple(notices)), SCHEMA).withColumnRenamed("id", id)

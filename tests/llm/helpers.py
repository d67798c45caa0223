"""Small tables that hold the awkward cases, and plain-Python forms of the rules."""

from __future__ import annotations

import re

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id string, row long, block int, key string"
SPACED = re.compile("[^\x20\x09-\x0d]+")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return SPACED.findall(lower(text))


def table(spark, texts, sources=None, langs=None, ids=None):
    """Documents with these texts; the last four columns have names that operators use inside."""
    n = len(texts)
    ids = list(range(n)) if ids is None else ids
    rows = [
        (ids[i], texts[i], (langs or [None] * n)[i], (sources or ["s"] * n)[i], None, "x", 1, 2, None)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, COLUMNS)


LONG = " ".join(f"w{i % 977} x{i}" for i in range(30_000))
AWKWARD = [None, "", " \t\n", "...", "a", "Ä ß 日本語 🙂", "same text here", "same text here", LONG, LONG + " end", "\x00\x01", "- -\r\n\r\n-"]

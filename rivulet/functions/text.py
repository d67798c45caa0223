"""Text to tokens, fields and keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def java_tokens(line: Column) -> Column:
    """Tokens of a line split on single spaces.

    Trailing empty tokens are dropped, inner and leading ones kept; an empty line
    is one empty token and a line of only spaces none.
    """
    trimmed = F.rtrim(line)
    only_spaces = (F.length(line) > 0) & (F.length(trimmed) == 0)
    return F.when(~only_spaces, F.split(trimmed, " "))


def lines_of(text: Column) -> Column:
    """Newline-separated lines of a text column as an array."""
    return F.split(text, "\n")


def positional(text: Column, fields: Sequence[tuple[str, str]], separator: str = ",") -> list[Column]:
    """Trimmed, typed columns from a separated text; ``fields`` are (name, type)."""
    parts = F.split(text, separator)
    return [F.trim(F.get(parts, F.lit(i))).try_cast(kind).alias(name) for i, (name, kind) in enumerate(fields)]


def compose_key(*parts: str | Column) -> Column:
    """``a:b:c`` key; plain strings are literals."""
    return F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

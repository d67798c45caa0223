"""Secret scan by fixed patterns and by sliding-window entropy, in built-in functions only.

Spans count code points from 0, end exclusive, per kind leftmost and not overlapping.
Pattern kinds: assign, access, hex. Method kinds: entropy-hex, entropy-upper, entropy-base64:
a run of 20 or more credential characters falls into one character class; a window of 20
characters slides along it, and the span reaches from the first window of high Shannon
entropy to the end of the last one. The counts of the window's characters are updated by the
character that enters and the one that leaves. Allow-listed runs give no entropy span;
pattern spans are never suppressed.

A NULL or empty text has no spans. Rows are kept as they are, repeated ones too; the result
column replaces one of the same name.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the pattern kinds: (kind, pattern, group that is measured, least length).
PATTERNS = [
    (
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{16,}", 0, 16),
]
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: (class, what the whole run must match, least bits per character)
CLASSES = [
    ("entropy-hex", r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+$", 2.8),
    ("entropy-upper", r"^(?=.*[0-9])(?=.*[A-Z])[A-Z0-9]+$", 3.4),
    ("entropy-base64", r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z]).+$", 3.8),
]
#: runs that are known not to be secrets
ALLOWED = [r"(?i)example", r"0123456789", r"(?i)abcdefghij", r"^(.)\1+$", r"(?i)^sha(1|256|384|512)[-=/_]"]
#: order of kinds that start together
KINDS = [name for name, *_ in PATTERNS] + [name for name, *_ in CLASSES]

SPAN = "struct<start:int,end:int,body:string>"
_FIRST_CODE, _CODES = ord("+"), ord("z") - ord("+") + 1
#: c * log2(c) in millionths, so that adding and taking away is exact
WEIGHTS = [0] + [round(c * math.log2(c) * 1e6) for c in range(1, WINDOW + 1)]


def most_weight(bits: float) -> int:
    """The sum of c * log2(c) up to which a window has at least so many bits per character."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * 1e6)


def matches(text: Column, pattern: str, group: int) -> Column:
    """All matches as (start, end, body of the group), placed by the lengths of what lies between them."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))
    body = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("found"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.char_length(x["between"])
        end = begin + F.char_length(x["whole"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["body"].alias("body"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(span)).alias("found"))

    rows = F.arrays_zip(between.alias("between"), whole.alias("whole"), body.alias("body"))
    found = F.aggregate(rows, start, step, lambda acc: acc["found"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def entropy_range(body: Column, limit: int) -> Column:
    """(start, end) inside a run, over its windows whose sum of c * log2(c) is at most `limit`."""
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    codes = F.transform(F.split(body, ""), lambda c: F.ascii(c) - _FIRST_CODE)
    moves = F.arrays_zip(codes.alias("enters"), F.concat(F.array_repeat(F.lit(-1), WINDOW), codes).alias("leaves"))
    nothing = F.struct(
        F.lit(0).alias("seen"),
        F.array_repeat(F.lit(0), _CODES).alias("counts"),
        F.lit(0).alias("weight"),
        F.lit(None).cast("int").alias("start"),
        F.lit(None).cast("int").alias("end"),
    )

    def step(acc: Column, x: Column) -> Column:
        leaves = x["leaves"] >= 0
        had = F.get(acc["counts"], x["leaves"])
        has = F.get(acc["counts"], x["enters"]) - F.when(x["leaves"] == x["enters"], 1).otherwise(0)
        less = F.when(leaves, F.get(weights, had - 1) - F.get(weights, had)).otherwise(0)
        weight = acc["weight"] + less + F.get(weights, has + 1) - F.get(weights, has)
        counts = F.transform(
            acc["counts"],
            lambda c, k: c + F.when(k == x["enters"], 1).otherwise(0) - F.when(k == x["leaves"], 1).otherwise(0),
        )
        high = (acc["seen"] >= WINDOW - 1) & (weight <= limit)
        return F.struct(
            (acc["seen"] + 1).alias("seen"),
            counts.alias("counts"),
            weight.alias("weight"),
            F.when(high & acc["start"].isNull(), acc["seen"] - (WINDOW - 1)).otherwise(acc["start"]).alias("start"),
            F.when(high, acc["seen"] + 1).otherwise(acc["end"]).alias("end"),
        )

    run = F.slice(moves, F.lit(1), F.size(codes))
    return F.aggregate(run, nothing, step, lambda acc: F.struct(acc["start"].alias("start"), acc["end"].alias("end")))


def find_secrets(df: DataFrame, text: str = "text", into: str = "secrets") -> DataFrame:
    """Adds an array of (start, end, kind, rank), sorted by start, then by the kinds' order."""
    content = F.coalesce(F.col(text), F.lit(""))
    found = []
    for rank, (kind, pattern, group, least) in enumerate(PATTERNS):
        found.append(_named(_long(matches(content, pattern, group), least), kind, rank))
    runs = F.filter(matches(content, CANDIDATE, 0), lambda s: ~_any_of(s["body"], ALLOWED))

    def classed(s: Column) -> Column:
        out = F.lit(None)
        for kind, shape, bits in reversed(CLASSES):
            rank = KINDS.index(kind)
            inner = F.array(entropy_range(s["body"], most_weight(bits)))
            moved = F.transform(inner, lambda e: F.struct((s["start"] + e["start"]).alias("start"), (s["start"] + e["end"]).alias("end")))
            out = F.when(s["body"].rlike(shape), _named(moved, kind, rank)[0]).otherwise(out)
        return out

    entropies = F.filter(F.transform(runs, classed), lambda s: s.isNotNull() & s["start"].isNotNull())
    return df.withColumn(into, F.array_sort(F.concat(*found, entropies), _by_place))


def _long(spans: Column, least: int) -> Column:
    return F.filter(spans, lambda s: F.char_length(s["body"]) >= least)


def _named(spans: Column, kind: str, rank: int) -> Column:
    named = [F.lit(kind).alias("kind"), F.lit(rank).alias("rank")]
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), *named))


def _of_rank(spans: Column, rank: int) -> Column:
    return F.filter(spans, lambda s: s["rank"] == rank)


def _any_of(body: Column, patterns: list[str]) -> Column:
    out = F.lit(False)
    for pattern in patterns:
        out = out | body.rlike(pattern)
    return out


def _by_place(a: Column, b: Column) -> Column:
    return F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(a["rank"] - b["rank"])


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(df: DataFrame) -> DataFrame:
    """Counts and digests of find_secrets() for documents(doc_id, text)."""
    found = find_secrets(df.select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["rank"] < len(PATTERNS))
    counts = {
        f"n_{kind}": F.size(_of_rank(F.col("secrets"), rank)).cast("long")
        for rank, (kind, *_) in enumerate(PATTERNS)
    }
    return found.select(
        "doc_id",
        *[c.alias(n) for n, c in counts.items()],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("secrets")).alias("spans"),
    )


def _duck_matches(pattern: str, group: int, options: str = "") -> str:
    """DuckDB list of (start, end, body) by the same rule."""
    p = "'" + pattern.replace("'", "''") + "'"  # the patterns given here have no look-behind
    return f"""list_transform(range(1, len(regexp_extract_all(t, {p}, 0{options})) + 1), lambda i: {{
        's': list_sum(list_transform(regexp_split_to_array(t, {p}{options})[1:i], lambda x: length(x)))
             + coalesce(list_sum(list_transform(regexp_extract_all(t, {p}, 0{options})[1:i - 1], lambda x: length(x))), 0),
        'n': length(regexp_extract_all(t, {p}, 0{options})[i]),
        'body': regexp_extract_all(t, {p}, {group}{options})[i]}})"""


def oracle() -> str:
    def plain(pattern: str) -> str:
        """Runs are maximal without the look-behind, too."""
        return re.sub(r"^\(\?<![^)]*\)", "", pattern)

    parts = []
    for rank, (kind, pattern, group, least) in enumerate(PATTERNS):
        pattern = plain(pattern)
        parts.append(
            f"""SELECT doc_id, {rank} AS rank, '{kind}' AS kind, s.s AS a, s.s + s.n AS b
            FROM (SELECT doc_id, unnest({_duck_matches(pattern, group)}) AS s FROM d
                  WHERE regexp_matches(t, '{pattern.replace("'", "''")}')) WHERE length(s.body) >= {least}"""
        )
    # the same classes without look-ahead
    shapes = {
        "entropy-hex": "regexp_full_match(body, '[0-9A-Fa-f]+') AND regexp_matches(body, '[0-9]') AND regexp_matches(body, '[A-Fa-f]')",
        "entropy-upper": "regexp_full_match(body, '[A-Z0-9]+') AND regexp_matches(body, '[0-9]') AND regexp_matches(body, '[A-Z]')",
        "entropy-base64": "regexp_matches(body, '[0-9]') AND regexp_matches(body, '[A-Z]') AND regexp_matches(body, '[a-z]')",
    }
    allowed = " OR ".join(f"regexp_matches(s.body, '{p}')" for p in ALLOWED if "\\1" not in p)
    whens = " ".join(f"WHEN {shape} THEN '{kind}'" for kind, shape in shapes.items())
    ranks = " ".join(f"WHEN '{kind}' THEN {KINDS.index(kind)}" for kind, *_ in CLASSES)
    limits = " ".join(f"WHEN '{kind}' THEN {most_weight(bits)}" for kind, _, bits in CLASSES)
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    runs AS (SELECT doc_id, s.s AS place, s.body AS body
        FROM (SELECT doc_id, unnest({_duck_matches(plain(CANDIDATE), 0)}) AS s FROM d WHERE regexp_matches(t, '{plain(CANDIDATE)}'))
        WHERE NOT ({allowed}) AND len(list_distinct(string_split(s.body, ''))) > 1),
    classed AS (SELECT *, CASE {whens} END AS kind FROM runs),
    wins AS (SELECT doc_id, place, body, kind, unnest(range(0, length(body) - {WINDOW} + 1)) AS w FROM classed WHERE kind IS NOT NULL),
    weighed AS (SELECT *, list_sum(list_transform(list_distinct(string_split(body[w + 1:w + {WINDOW}], '')),
        lambda c: ({WEIGHTS}::BIGINT[])[1 + len(list_filter(string_split(body[w + 1:w + {WINDOW}], ''), lambda y: y = c))])) AS weight FROM wins),
    entropies AS (SELECT doc_id, CASE kind {ranks} END AS rank, kind, place + min(w) AS a, place + max(w) + {WINDOW} AS b
        FROM weighed WHERE weight <= CASE kind {limits} END GROUP BY doc_id, place, body, kind),
    spans AS ({" UNION ALL ".join(parts)} UNION ALL SELECT * FROM entropies),
    joined AS (SELECT doc_id, count(*) FILTER (rank = 0) AS n0, count(*) FILTER (rank = 1) AS n1, count(*) FILTER (rank = 2) AS n2,
        string_agg(kind || ':' || a::BIGINT || ':' || b::BIGINT, ',' ORDER BY a, rank) FILTER (rank < 3) AS base,
        string_agg(kind || ':' || a::BIGINT || ':' || b::BIGINT, ',' ORDER BY a, rank) AS spans FROM spans GROUP BY doc_id)
    SELECT d.doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN joined USING (doc_id)"""

"""Exact duplicates by deterministic block naming.

The white-space-normalised text is cut into blocks of fixed size. Blocks are sorted and
numbered, equal ones alike; then neighbouring names are paired and the pairs sorted and
numbered, until each document has one name. Names compare content, never hashes, so two
documents have the same (number of blocks, name) only if their texts are the same.

Sorting runs inside hash buckets: a name is the bucket's number and the rank in the bucket.
A block goes into the sort once per Arrow batch that holds it, a pair once in all, so a
text that a third of the documents share does not fill one task.

NULL texts count as empty. Rows with the same id are rows of their own; of equal texts the
smallest id stays, NULL ids last, and of rows with the same id one. Empty tables give none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rivulet.llm.tables import settle, spread
from rivulet.llm.text_arrays import SPACES, text_slices

BLOCK_BYTES = 4096
BUCKETS = 1 << 20

CUT = "row long, id long, text_sha256 string, refs array<long>, fresh array<struct<ref:long,block:binary>>"
ARROW = pa.schema(
    [
        ("row", pa.int64()),
        ("id", pa.int64()),
        ("text_sha256", pa.string()),
        ("refs", pa.list_(pa.int64())),
        ("fresh", pa.list_(pa.struct([("ref", pa.int64()), ("block", pa.binary())]))),
    ]
)


def single_spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of white space as one space; new bytes and offsets."""
    space = SPACES[data]
    keep = np.ones(len(data), dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return np.where(space, np.uint8(0x20), data)[keep], kept[offsets]


def _cutter(block_bytes: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TaskContext.get().partitionId() << 40
        for batch in batches:
            known: dict[bytes, int] = {}
            for first, end, data, offsets in text_slices(batch.column("text")):
                data, offsets = single_spaced(data, offsets)
                digests, refs, fresh = [], [], []
                for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    content = data[a:b].tobytes()
                    digests.append(hashlib.sha256(content).hexdigest())
                    own, new = [], []
                    for at in range(0, max(1, len(content)), block_bytes):
                        block = content[at : at + block_bytes]
                        ref = known.get(block)
                        if ref is None:
                            counter += 1
                            ref = known[block] = counter
                            new.append({"ref": ref, "block": block})
                        own.append(ref)
                    refs.append(own)
                    fresh.append(new)
                rows = batch.slice(first, end - first)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("row"), rows.column("id"), pa.array(digests), pa.array(refs, ARROW.field(3).type), pa.array(fresh, ARROW.field(4).type)],
                    schema=ARROW,
                )

    return cut


def numbered(df: DataFrame, *content: str) -> DataFrame:
    """Adds `name`: the same positive number for rows of equal content, another for others."""
    bucketed = df.withColumn("bucket", spread(F.struct(*content), BUCKETS))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*content))
    return bucketed.withColumn("name", F.col("bucket").cast("long") * (1 << 40) + rank).drop("bucket")


def _in_order(df: DataFrame) -> DataFrame:
    """(row, place, name) to (row, names); a row's list is as long as its text."""
    listed = F.array_sort(F.collect_list(F.struct("place", "name")))
    return df.groupBy("row").agg(F.transform(listed, lambda x: x["name"]).alias("names"))


def identities(cut: DataFrame) -> DataFrame:
    """(row, blocks, name) from (row, refs, fresh)."""
    blocks = cut.select(F.explode("fresh").alias("f")).select("f.ref", "f.block")
    named = numbered(blocks, "block").select("ref", "name")
    placed = cut.select("row", F.posexplode("refs").alias("place", "ref")).join(named, "ref").select("row", "place", "name")
    state = settle(_in_order(placed).withColumn("blocks", F.size("names")), "names")
    done = []
    while True:
        done.append(state.where("size(names) = 1").select("row", "blocks", F.col("names")[0].alias("name")))
        state = state.where("size(names) > 1")
        if state.isEmpty():
            break
        half = F.sequence(F.lit(0), F.ceil(F.size("names") / 2).cast("int") - 1)
        pairs = state.select("row", "blocks", "names", F.explode(half).alias("place")).select(
            "row",
            "blocks",
            "place",
            F.get("names", F.col("place") * 2).alias("a"),
            F.coalesce(F.get("names", F.col("place") * 2 + 1), F.lit(0)).alias("b"),
        )
        names = settle(numbered(pairs.select("a", "b").distinct(), "a", "b"), "pairs")
        joined = pairs.join(names, ["a", "b"])
        sizes = joined.groupBy("row").agg(F.first("blocks").alias("blocks"), F.array_sort(F.collect_list(F.struct("place", "name"))).alias("l"))
        state = settle(sizes.select("row", "blocks", F.transform("l", lambda x: x["name"]).alias("names")), "names")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def exact_duplicates(df: DataFrame, text: str = "text", id: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for each row."""
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    cut = settle(rows.mapInArrow(_cutter(block_bytes), CUT), "blocks")
    own = cut.select("row", "id", "text_sha256").join(identities(cut), "row")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")
    groups = settle(own.groupBy("blocks", "name").agg(first, F.count("*").alias("group_size")), "groups")
    return own.join(groups, ["blocks", "name"]).select(
        F.col("id").alias(id),
        F.col("first.id").alias("keep_id"),
        "group_size",
        _is_first().alias("kept"),
        "text_sha256",
    )


def _is_first() -> Column:
    return F.col("row") == F.col("first.row")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d"""

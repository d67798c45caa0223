"""Near-duplicates by min-max hashing: of each permutation of the shingles both ends are kept.

The least and the greatest value of a set under a permutation each agree between two sets with
their Jaccard similarity as probability, so half as many permutations are evaluated for the same
number of unbiased signature values. A band of ROWS values takes the minima of some
permutations and the maxima of others, so that a band's values are independent.

1. Equal sets are one: the smallest id stands for them. Each different set gives BANDS keys.
2. Sets with a common key are candidates; links are confirmed on full sets, see `linking`.

A pair exactly at the similarity of 0.8 shares no band with a probability of 3e-6, one at 0.85 of
1e-9. A text of fewer than n words has its whole sequence as its one shingle; without words
(empty or NULL) the set is empty and links with nothing. Rows with the same id are one document
whose sets all count; a NULL id has no component and is kept. Empty tables give none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.linking import CHUNK, confirmed, set_table, shingles, sketched
from rivulet.llm.tables import component_labels, settle
from rivulet.llm.text_arrays import mix, text_slices

BANDS, ROWS = 42, 6
PERMUTATIONS = BANDS * ROWS // 2
SIGNED = "id long, n long, digest binary, bands array<long>"


def permutations() -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of the permutations of 32-bit values."""
    seeds = mix(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).astype(np.uint32)
    return seeds[:PERMUTATIONS] | np.uint32(1), seeds[PERMUTATIONS:]


def min_max(sets: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each non-empty set under each permutation."""
    folded = (sets ^ (sets >> np.uint64(32))).astype(np.uint32)
    factors, offsets = permutations()
    heads = bounds[:-1]
    low = np.empty((len(heads), PERMUTATIONS), np.uint32)
    high = np.empty((len(heads), PERMUTATIONS), np.uint32)
    for p in range(PERMUTATIONS):
        values = folded * factors[p] + offsets[p]
        low[:, p] = np.minimum.reduceat(values, heads)
        high[:, p] = np.maximum.reduceat(values, heads)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band: half its values are minima, half are maxima of other permutations."""
    half = ROWS // 2
    keys = np.zeros((len(low), BANDS), np.uint64)
    keys += mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    at = np.arange(BANDS) * half
    for i in range(half):
        keys = mix(keys * np.uint64(0xD1342543DE82EF95) + low[:, at + i])
        keys = mix(keys * np.uint64(0xD1342543DE82EF95) + high[:, (at + half + i) % PERMUTATIONS])
    return keys


def _signer(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column("text")):
                sets, bounds = shingles(data, offsets, n)
                sizes = np.diff(bounds)
                digests = [hashlib.blake2b(sets[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
                filled = np.flatnonzero(sizes)
                lists = np.zeros(len(sizes), np.int64)
                lists[filled] = BANDS
                keys = np.empty(0, np.uint64)
                if len(filled):
                    keys = band_keys(*min_max(sets, np.append(bounds[:-1][filled], len(sets)))).ravel()
                bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lists)]), pa.int32()), pa.array(keys.view(np.int64)))
                columns = [batch.column("id").slice(first, end - first), pa.array(sizes), pa.array(digests, pa.binary()), bands]
                yield pa.RecordBatch.from_arrays(columns, ["id", "n", "digest", "bands"])

    return run


def near_duplicates(df: DataFrame, text: str = "text", id: str = "doc_id", n: int = 5, threshold: str = "0.8", block: int = CHUNK) -> DataFrame:
    """(id, n_shingles, component_id, kept) for each row."""
    share = Fraction(threshold)
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    signed = settle(rows.mapInArrow(_signer(n), SIGNED), "signed")
    named = signed.where("id IS NOT NULL AND n > 0")
    different = settle(named.groupBy("digest").agg(F.min("id").alias("rep"), F.max("bands").alias("bands")), "different")

    # buckets with more than one set; the smallest set is the hub
    keys = different.select("rep", F.explode("bands").alias("key"))
    hubs = keys.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("top"), (F.count("*") > 2).alias("several"))
    near = settle(keys.join(hubs.where("hub != top").drop("top"), "key").groupBy("rep", "hub").agg(F.max("several").alias("several")), "near")
    sets = settle(set_table(rows, near.select(F.col("rep").alias("id")).distinct(), n), "sets")
    links = confirmed(near, sketched(sets), lambda reps: sets, share, block)

    copies = named.join(different.select("digest", "rep"), "digest").where("id != rep").select(F.col("id").alias("rep"), F.col("rep").alias("hub"))
    labels = component_labels(links.unionByName(copies), "rep", "hub")
    out = signed.join(labels, F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("label", "id"))
    return out.select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept")
    )


ORACLE = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS l FROM documents),
sh AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(l) >= 4 THEN list_transform(range(1, len(l) - 2), lambda i: array_to_string(l[i:i + 3], ' '))
           WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
linked AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT DISTINCT a AS node, a AS far FROM linked UNION SELECT node, b FROM reach JOIN linked ON a = far),
label AS (SELECT node AS doc_id, least(node, min(far)) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(r.component_id, d.doc_id) AS component_id,
       d.doc_id IS NOT DISTINCT FROM coalesce(r.component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN label r USING (doc_id)"""

"""k-means (M01) as a loop of Spark jobs.

The points stay on the executors. A pass adds up the members of each centre, so a
task shuffles one partial sum per centre and dimension, and only the k new centres
reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class KMeansResult:
    assigned: DataFrame
    centres: np.ndarray
    passes: int


def _nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of and squared distance to the nearest centre; ties go to the first."""
    squared = np.empty((len(points), len(centres)))
    for i, centre in enumerate(centres):
        difference = points - centre
        squared[:, i] = np.einsum("ij,ij->i", difference, difference)
    index = squared.argmin(axis=1)
    return index, squared[np.arange(len(points)), index]


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype("float64")


def start_centres(points: DataFrame, vector: str, ident: str, k: int, seed: int) -> np.ndarray:
    """k of the distinct points, those with the smallest seeded hash: random but repeatable."""
    rank = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(ident).cast("string")))
    chosen = points.orderBy(rank, ident).select(vector).limit(k).collect()
    if len(chosen) < k:
        raise ValueError(f"{k} clusters need {k} distinct points, found {len(chosen)}")
    return np.array([row[vector] for row in chosen], dtype="float64")


def _new_centres(points: DataFrame, vector: str, centres: np.ndarray) -> np.ndarray:
    k, width = centres.shape

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, counts = np.zeros((k, width)), np.zeros(k, dtype="int64")
        for batch in batches:
            if len(batch):
                matrix = _matrix(batch[vector])
                index, _ = _nearest(matrix, centres)
                members = index[None, :] == np.arange(k)[:, None]
                sums += members @ matrix
                counts += members.sum(axis=1)
        held = np.flatnonzero(counts)
        yield pd.DataFrame(
            {
                "c": np.repeat(held, width),
                "i": np.tile(np.arange(width), len(held)),
                "n": np.repeat(counts[held], width),
                "s": sums[held].ravel(),
            }
        )

    partial = points.select(vector).mapInPandas(add_up, "c int, i int, n bigint, s double")
    means = partial.groupBy("c", "i").agg((F.sum("s") / F.sum("n")).alias("mean"))
    moved = centres.copy()
    for row in means.collect():
        moved[row["c"], row["i"]] = row["mean"]
    return moved


def assign(points: DataFrame, vector: str, centres: np.ndarray) -> DataFrame:
    """Each point's nearest centre and the distance to it."""
    schema = T.StructType([*points.schema.fields, T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.DoubleType())])

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                index, squared = _nearest(_matrix(batch[vector]), centres)
                yield batch.assign(cluster=index.astype("int32"), distance=np.sqrt(squared))

    return points.mapInPandas(nearest, schema)


def kmeans(
    points: DataFrame,
    vector: str,
    ident: str,
    k: int,
    tolerance: float = 0.01,
    seed: int = 42,
    start: np.ndarray | None = None,
) -> KMeansResult:
    """Lloyd's algorithm until no centre moves by more than ``tolerance``, which always comes.

    Equal points count once in a centre's mean. A centre without members stays.
    The assignment returned is the one the last means were taken from.
    """
    if k < 1:
        raise ValueError("k must be positive")
    distinct = points.groupBy(vector).agg(F.min(ident).alias(ident)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        centres = start_centres(distinct, vector, ident, k, seed) if start is None else start
        passes = 0
        while True:
            before = centres
            centres = _new_centres(distinct, vector, before)
            passes += 1
            shift = np.sqrt(((centres - before) ** 2).sum(axis=1)).max()
            if shift <= tolerance:
                return KMeansResult(assign(points, vector, before), centres, passes)
    finally:
        distinct.unpersist()

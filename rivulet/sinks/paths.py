"""Listing and marking paths through Hadoop's file system, so any shared store works."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a path; none if it does not exist."""
    if not exists(spark, path):
        return []
    return sorted(s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path)))


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a glob pattern, found in one call."""
    return sorted(s.getPath().toString() for s in _fs(spark, pattern).globStatus(_path(spark, pattern)) or [])


def touch_each(files: DataFrame, root: str) -> None:
    """Creates the empty files named in the first column, below the root; the tasks do it, not the driver."""
    spark = files.sparkSession
    base = str(_path(spark, root).makeQualified(_fs(spark, root).getUri(), _fs(spark, root).getWorkingDirectory()).toString())
    if base.startswith("file:"):
        base = "file://" + base.removeprefix("file:").removeprefix("//")

    def touch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, directory = FileSystem.from_uri(base)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                system.open_output_stream(f"{directory}/{name}").close()
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    files.mapInArrow(touch, "n long").agg(F.sum("n")).collect()

"""Writes that take effect once per batch id.

``foreachBatch`` may call a sink again with a batch it has already finished. Each
batch writes to a directory named by its id. Spark's commit protocol shows files
only after the whole job has succeeded and then sets ``_SUCCESS``, which is the
ledger entry: without it the batch does not exist for readers.

Batches lie in groups of consecutive ids. A batch that begins a group folds the group
before the last one into a single directory, so what a reader lists and opens grows with the
groups, and a writer looks at its own batch and one group. Old directories stay for readers
that still have them open.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.sinks import paths

BATCH = "batch_id"
GROUP = 100


class BatchLedger:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, group: int = GROUP):
        self.spark = spark
        self.path = path
        self.schema = schema
        self.group = group
        self.stored = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])

    def _directory(self, batch_id: int) -> str:
        return f"{self.path}/open/group={batch_id // self.group}/{BATCH}={batch_id}"

    def _folded(self, group: int | str) -> str:
        return f"{self.path}/folded/group={group}"

    def committed(self, batch_id: int) -> bool:
        folded = f"{self._folded(batch_id // self.group)}/_SUCCESS"
        return paths.exists(self.spark, f"{self._directory(batch_id)}/_SUCCESS") or paths.exists(self.spark, folded)

    def write(self, df: DataFrame, batch_id: int) -> None:
        """Commit the batch, or do nothing if it already is; a failure leaves nothing visible."""
        if batch_id % self.group == 0 and batch_id >= 2 * self.group:
            self._fold(batch_id // self.group - 2)
        if not self.committed(batch_id):
            df.select(*self.schema.names).write.mode("overwrite").parquet(self._directory(batch_id))

    def _fold(self, group: int) -> None:
        """Write the finished batches of a group as one directory, once."""
        if not paths.exists(self.spark, f"{self._folded(group)}/_SUCCESS"):
            rows = self._rows(self._finished(group), f"{self.path}/open/group={group}")
            rows.hint("rebalance").write.mode("overwrite").parquet(self._folded(group))

    def _finished(self, group: int | str) -> list[str]:
        found = paths.matching(self.spark, f"{self.path}/open/group={group}/{BATCH}=*/_SUCCESS")
        return [f.removesuffix("/_SUCCESS") for f in found]

    def _rows(self, directories: list[str], base: str) -> DataFrame:
        if not directories:
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).option("basePath", base).parquet(*directories)

    def _layout(self) -> tuple[list[str], list[str]]:
        """Folded groups, and finished batches of the others."""
        folded = [f.removesuffix("/_SUCCESS") for f in paths.matching(self.spark, f"{self.path}/folded/group=*/_SUCCESS")]
        done = {f.rpartition("=")[2] for f in folded}
        groups = [n.partition("=")[2] for n in paths.children(self.spark, f"{self.path}/open")]
        return folded, [d for g in groups if g not in done for d in self._finished(g)]

    def batches(self) -> list[int]:
        """Ids of the batches that are not folded yet."""
        return sorted(int(re.search(rf"{BATCH}=(\d+)$", d)[1]) for d in self._layout()[1])

    def read(self) -> DataFrame:
        """Rows of all committed batches with their batch id."""
        folded, single = self._layout()
        rows = self._rows(single, f"{self.path}/open").select(*self.stored.names)
        if folded:
            rows = self.spark.read.schema(self.stored).parquet(*folded).unionByName(rows)
        return rows


def transaction_rows(df: DataFrame, value: str, total: str, insert_time: Column | None = None) -> DataFrame:
    """Rows ``(value, total, insert_time)`` of the transactional sink."""
    when = F.current_timestamp() if insert_time is None else insert_time
    return df.select(F.col(value).alias("value"), F.col(total).cast("int").alias("total"), when.alias("insert_time"))

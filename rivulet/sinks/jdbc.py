"""JDBC sinks.

Rows go from the executors to the database in batches. What must be atomic happens
afterwards in the database: the batch lands in a staging table, and one short
transaction merges it and records the batch id. The driver sends statements only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from contextlib import closing
from typing import Any

from pyspark.sql import DataFrame

from rivulet.sinks.keyed import newest


def append(df: DataFrame, url: str, table: str, batch_rows: int = 5_000, properties: Mapping[str, str] | None = None) -> None:
    """Insert the rows, mapped to columns by name."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows), **(properties or {})}
    df.write.format("jdbc").mode("append").options(**options).save()


def merge_statement(target: str, stage: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """``MERGE`` of a staging table into the target by key."""
    match = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    rest = [c for c in columns if c not in keys]
    update = f"WHEN MATCHED THEN UPDATE SET {', '.join(f't.{c} = s.{c}' for c in rest)} " if rest else ""
    names, values = ", ".join(columns), ", ".join(f"s.{c}" for c in columns)
    return (
        f"MERGE INTO {target} t USING {stage} s ON {match} {update}"
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )


def insert_statement(target: str, stage: str, columns: Sequence[str]) -> str:
    names = ", ".join(columns)
    return f"INSERT INTO {target} ({names}) SELECT {names} FROM {stage}"


def commit_batch(
    connect: Callable[[], Any], ledger: str, batch_id: int, statements: Sequence[str]
) -> bool:
    """Run the statements and record the batch id in one transaction.

    ``connect`` gives a DB-API connection with autocommit off. Returns False and
    changes nothing if the batch is already recorded; any failure rolls back.
    """
    with closing(connect()) as connection:
        cursor = connection.cursor()
        try:
            cursor.execute(f"SELECT COUNT(*) FROM {ledger} WHERE batch_id = {int(batch_id)}")
            if cursor.fetchone()[0]:
                connection.rollback()
                return False
            for statement in statements:
                cursor.execute(statement)
            cursor.execute(f"INSERT INTO {ledger} (batch_id) VALUES ({int(batch_id)})")
            connection.commit()
            return True
        except Exception:
            connection.rollback()
            raise


def transactional(
    url: str,
    target: str,
    stage: str,
    ledger: str,
    connect: Callable[[], Any],
    keys: Sequence[str] = (),
    properties: Mapping[str, str] | None = None,
    order: Sequence[str] = (),
) -> Callable[[DataFrame, int], None]:
    """Sink that stages a batch and commits it once; with ``keys`` it upserts.

    ``MERGE`` wants one row per key, so the newest by ``order`` is staged.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        if keys:
            df = newest(df, keys, order or [c for c in df.columns if c not in keys])
        options = {"url": url, "dbtable": stage, "truncate": "true", **(properties or {})}
        df.write.format("jdbc").mode("overwrite").options(**options).save()
        columns = df.columns
        body = merge_statement(target, stage, keys, columns) if keys else insert_statement(target, stage, columns)
        commit_batch(connect, ledger, batch_id, [body])

    return write

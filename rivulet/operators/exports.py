"""Declarative export jobs (P14, P15): table, partition, fields and filter to a keyed target."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.operators.predicates import partition_equals
from rivulet.sinks.keyed import MergedTable


@dataclass(frozen=True)
class ExportSource:
    table: str
    partition: dict[str, str]
    fields: tuple[str, ...]
    where: Callable[[], Column] | None = None


@dataclass(frozen=True)
class ExportTarget:
    """An index and its documents' id; ``delete_config`` names the values of fields, as they are
    in the source, that take a document away; a ``partial`` target sets the exported fields alone."""

    index: str
    id_column: str
    delete_config: dict[str, str] = field(default_factory=dict)
    mapping: dict[str, str] = field(default_factory=dict)
    partial: bool = False


@dataclass(frozen=True)
class ExportSpec:
    source: ExportSource
    target: ExportTarget


def event_day(app: str, dt: str, event: str = "") -> Column:
    """Filter template: one app, day and event partition."""
    return partition_equals({"app": app, "dt": dt, "event": event})


def export_rows(spec: ExportSpec, load: Callable[[str], DataFrame]) -> DataFrame:
    """The rows a spec selects, with fields renamed by the target's mapping."""
    source = spec.source
    rows = load(source.table).where(partition_equals(source.partition))
    if source.where is not None:
        rows = rows.where(source.where())
    mapping = spec.target.mapping
    return rows.select(*[rows[f].alias(mapping.get(f, f)) for f in source.fields])


def deleted(target: ExportTarget) -> Column:
    """Whether an exported row takes its document away: all fields of the delete configuration have their value."""
    gone = F.lit(bool(target.delete_config))
    for name, value in target.delete_config.items():
        gone = gone & (F.col(target.mapping.get(name, name)).cast("string") == value)
    return F.coalesce(gone, F.lit(False))


def index_writer(tables: Mapping[str, MergedTable]) -> Callable[[ExportTarget, DataFrame], None]:
    """Writes each spec's rows as the next batch of its index: sets documents or fields of them, or takes them away."""
    batches = dict.fromkeys(tables, 0)

    def write(target: ExportTarget, rows: DataFrame) -> None:
        index = tables[target.index]
        keep = rows.where(~deleted(target))
        changes = index.partial(keep) if target.partial else index.full(keep)
        if target.delete_config:
            changes = changes.unionByName(index.removed(rows.where(deleted(target))))
        index.upsert(changes, batches[target.index])
        batches[target.index] += 1

    return write


def run_exports(
    registry: Iterable[object],
    load: Callable[[str], DataFrame],
    write: Callable[[ExportTarget, DataFrame], None],
) -> list[str]:
    """Run every spec of a registry; members that are no specs are skipped."""
    done = []
    for member in registry:
        if isinstance(member, ExportSpec):
            write(member.target, export_rows(member, load))
            done.append(member.target.index)
    return done

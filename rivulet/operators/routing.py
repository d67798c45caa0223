"""Rows sent along predicate edges (T15) and late rows set aside."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rivulet.session import settle

Transform = Callable[[DataFrame], DataFrame]
Sink = Callable[[DataFrame, int], None]
# A row as a struct to the row after a point, or to a condition.
RowTransform = Callable[[Column], Column]


@dataclass
class Route:
    """Named transforms linked by predicate edges; points without a transform are ends.

    A row follows every edge whose predicate holds, so it may reach several ends
    or none. Roots are the points with edges out and none in.
    """

    transforms: dict[str, Transform] = field(default_factory=dict)
    sinks: dict[str, Sink | None] = field(default_factory=dict)
    edges: list[tuple[str, str, Column]] = field(default_factory=list)

    def point(self, name: str, transform: Transform) -> Route:
        self.transforms[name] = transform
        return self

    def end(self, name: str, sink: Sink | None = None) -> Route:
        self.sinks[name] = sink
        return self

    def edge(self, start: str, to: str, predicate: Column | None = None) -> Route:
        for name in (start, to):
            if name not in self.transforms and name not in self.sinks:
                raise ValueError(f"edge names an unknown point: {name}")
        if start in self.sinks:
            raise ValueError(f"end point {start} has no way out")
        self.edges.append((start, to, F.lit(True) if predicate is None else predicate))
        return self

    def roots(self) -> list[str]:
        entered = {to for _, to, _ in self.edges}
        return sorted({start for start, _, _ in self.edges} - entered)

    def ends(self, df: DataFrame) -> dict[str, list[DataFrame]]:
        """Per end point the DataFrames that reach it, one per path."""
        reached: dict[str, list[DataFrame]] = {name: [] for name in self.sinks}

        def follow(name: str, rows: DataFrame, path: tuple[str, ...]) -> None:
            if name in path:
                raise ValueError(f"points form a cycle at {name}")
            if name in self.sinks:
                reached[name].append(rows)
                return
            out = self.transforms[name](rows)
            for start, to, predicate in self.edges:
                if start == name:
                    follow(to, out.where(predicate), (*path, name))

        for root in self.roots():
            follow(root, df, ())
        return reached

    def combined(self, df: DataFrame, label: str = "end") -> DataFrame:
        """All end points' rows in one DataFrame, labelled; ends must agree in schema."""
        union = None
        for name, parts in self.ends(df).items():
            for part in parts:
                labelled = part.select(F.lit(name).alias(label), "*")
                union = labelled if union is None else union.union(labelled)
        if union is None:
            raise ValueError("no end point is reachable")
        return union

    def write(self, df: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` body: keep the batch and write every end point's sink."""
        df.persist()
        try:
            for name, parts in self.ends(df).items():
                sink = self.sinks[name]
                if sink is not None and parts:
                    rows = parts[0]
                    for part in parts[1:]:
                        rows = rows.union(part)
                    sink(rows, batch_id)
        finally:
            df.unpersist()


@dataclass
class RowRoute:
    """A route whose transforms and predicates are expressions over one row, evaluated in one pass.

    Points are compiled in topological order into columns of one projection: the row as it is after the
    point, NULL if it does not get there. Paths share the columns of the points they share;
    a point that several edges enter has a column for each row that may arrive. The source is
    scanned once, whatever the number of paths. Predicates that are NULL do not hold.
    """

    transforms: dict[str, RowTransform] = field(default_factory=dict)
    sinks: dict[str, Sink | None] = field(default_factory=dict)
    edges: list[tuple[str, str, RowTransform | None]] = field(default_factory=list)

    def point(self, name: str, transform: RowTransform) -> RowRoute:
        self.transforms[name] = transform
        return self

    def end(self, name: str, sink: Sink | None = None) -> RowRoute:
        self.sinks[name] = sink
        return self

    def edge(self, start: str, to: str, predicate: RowTransform | None = None) -> RowRoute:
        for name in (start, to):
            if name not in self.transforms and name not in self.sinks:
                raise ValueError(f"edge names an unknown point: {name}")
        if start in self.sinks:
            raise ValueError(f"end point {start} has no way out")
        self.edges.append((start, to, predicate))
        return self

    def roots(self) -> list[str]:
        entered = {to for _, to, _ in self.edges}
        return sorted({start for start, _, _ in self.edges} - entered)

    def ordered(self) -> list[str]:
        """Points that a root reaches, each after those with edges to it."""
        order, state = [], {}

        def visit(name: str) -> None:
            if state.get(name) == "open":
                raise ValueError(f"points form a cycle at {name}")
            if name not in state:
                state[name] = "open"
                for start, to, _ in self.edges:
                    if start == name:
                        visit(to)
                state[name] = "done"
                order.append(name)

        for root in self.roots():
            visit(root)
        return order[::-1]

    def compiled(self, df: DataFrame) -> tuple[DataFrame, dict[str, list[str]]]:
        """The rows with a column per point and arrival, and the columns of each end that is reached."""
        order = self.ordered()
        if not any(name in self.sinks for name in order):
            raise ValueError("no end point is reachable")
        rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))
        roots, held = set(self.roots()), {}
        for i, name in enumerate(order):
            arrivals = [F.col("_row")] if name in roots else []
            for start, to, predicate in self.edges:
                if to == name:
                    for c in held.get(start, []):
                        row = F.col(c)
                        arrivals.append(row if predicate is None else F.when(row.isNotNull() & predicate(row), row))
            held[name] = [f"_at_{i}_{k}" for k in range(len(arrivals))]
            rows = rows.withColumns(dict(zip(held[name], arrivals)))
            if name in self.transforms:
                after = {c: F.when(F.col(c).isNotNull(), self.transforms[name](F.col(c))) for c in held[name]}
                rows = rows.withColumns(after)
        return rows, {name: held[name] for name in order if name in self.sinks}

    def combined(self, df: DataFrame, label: str = "end") -> DataFrame:
        """All end points' rows in one DataFrame, labelled; ends must agree in schema."""
        rows, ends = self.compiled(df)
        arrived = [
            F.when(F.col(c).isNotNull(), F.struct(F.lit(name).alias("end"), F.col(c).alias("row"))) for name in sorted(ends) for c in ends[name]
        ]
        out = rows.select(F.explode(F.array(*arrived)).alias("_e")).where("_e IS NOT NULL")
        return out.select(F.col("_e.end").alias(label), "_e.row.*")

    def write(self, df: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` body: one pass writes what reaches an end, from which each sink takes its own."""
        rows, ends = self.compiled(df)
        names = {name: f"_end_{i}" for i, name in enumerate(sorted(ends))}
        reached = None
        for columns in ends.values():
            for c in columns:
                reached = F.col(c).isNotNull() if reached is None else reached | F.col(c).isNotNull()
        kept = settle(rows.where(reached).select(*[F.array(*ends[n]).alias(c) for n, c in names.items()]), "routed")
        for name, column in names.items():
            sink = self.sinks[name]
            if sink is not None:
                sink(kept.select(F.explode(column).alias("_r")).where("_r IS NOT NULL").select("_r.*"), batch_id)


def late_split(df: DataFrame, age_seconds: Column, limit: int, describe: Column) -> DataFrame:
    """Tag rows ``main`` or ``late``; late ones carry a message instead.

    One pass gives both outputs; filter on ``output`` to write them apart.
    """
    main = age_seconds < limit
    return df.withColumn("age_seconds", age_seconds).withColumns(
        {
            "output": F.when(main, "main").otherwise("late"),
            "message": F.when(~main, describe),
        }
    )

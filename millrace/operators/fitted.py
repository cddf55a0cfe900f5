"""Fitted column parameters: a few numbers per column, optionally per group."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.sources.files import read_document, write_document


@dataclass(frozen=True)
class Fitted:
    """`values` holds column -> parameter -> value; with `by`, `table` holds one struct of
    parameters per column and group instead, and stays a distributed table."""

    kind: str
    params: tuple[str, ...]
    columns: tuple[str, ...]
    by: tuple[str, ...] = ()
    values: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    table: DataFrame | None = None

    def to_df(self, spark: SparkSession | None = None) -> DataFrame:
        """Long form: by..., column, parameters."""
        if self.table is not None:
            cells = [
                F.struct(F.lit(c).alias("column"), *[F.col(f"_p{i}")[p].alias(p) for p in self.params])
                for i, c in enumerate(self.columns)
            ]
            keys = [col(b) for b in self.by]
            return self.table.select(*keys, F.explode(F.array(*cells)).alias("cell")).select(*keys, "cell.*")
        text = any(isinstance(v, str) for row in self.values.values() for v in row.values())
        schema = ", ".join(["column string", *[f"{p} {'string' if text else 'double'}" for p in self.params]])
        rows = [
            (c, *[v if v is None or text else float(v) for v in (self.values[c][p] for p in self.params)])
            for c in self.columns
        ]
        return spark.createDataFrame(rows, schema)

    @staticmethod
    def from_df(df: DataFrame, kind: str) -> "Fitted":
        """Read back the long form of a model without groups (one row per column)."""
        params = tuple(c for c in df.columns if c != "column")
        rows = {r["column"]: {p: r[p] for p in params} for r in df.collect()}
        return Fitted(kind, params, tuple(rows), values=rows)

    def save(self, spark: SparkSession, path: str) -> None:
        """Keep the model, grouped or not, in a new folder."""
        if self.table is not None:
            self.table.write.parquet(f"{path}/groups")
        document = {"kind": self.kind, "params": self.params, "columns": self.columns, "by": self.by}
        write_document(spark, f"{path}/model", {**document, "grouped": self.table is not None, "values": dict(self.values)})

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Fitted":
        found = read_document(spark, f"{path}/model")
        table = spark.read.parquet(f"{path}/groups") if found["grouped"] else None
        return Fitted(found["kind"], tuple(found["params"]), tuple(found["columns"]), tuple(found["by"]), found["values"], table)

    def transform(
        self,
        df: DataFrame,
        change: Callable[[str, Callable[[str], Column]], Column],
        columns: Sequence[str] | None = None,
    ) -> DataFrame:
        """Replace each fitted column by `change(column, parameter lookup)` in one projection."""
        wanted = [c for c in (columns or self.columns) if c in df.columns]
        source = df
        if self.table is not None:
            keys = self.table.select(
                *[col(b).alias(f"_by{i}") for i, b in enumerate(self.by)],
                *[F.col(f"_p{i}") for i in range(len(self.columns))],
            )
            same = reduce(
                lambda a, b: a & b,
                [df[f"`{b}`"].eqNullSafe(keys[f"_by{i}"]) for i, b in enumerate(self.by)],
            )
            source = df.join(keys, same, "left")
        place = {c: i for i, c in enumerate(self.columns)}

        def lookup(column: str) -> Callable[[str], Column]:
            if self.table is not None:
                return lambda p: F.col(f"_p{place[column]}")[p]
            return lambda p: F.lit(self.values[column][p])

        changed = {c: change(c, lookup(c)) for c in wanted}
        return source.select(*[changed[c].alias(c) if c in changed else col(c) for c in df.columns])


def pack(df: DataFrame, by: Sequence[str], parts: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Group keys plus one parameter struct per column, the layout `Fitted.table` expects."""
    return df.select(
        *[col(b) for b in by],
        *[F.struct(*[e.alias(p) for p, e in part.items()]).alias(f"_p{i}") for i, part in enumerate(parts)],
    )

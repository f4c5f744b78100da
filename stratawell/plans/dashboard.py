"""The set of tables a dashboard reads, from one pass over the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratawell.functions.storage import unused_name
from stratawell.operators.reporting import time_bucket


@dataclass(frozen=True)
class Grouped:
    """Measures by dimensions."""

    dims: Sequence[str]
    aggs: Mapping[str, Column]

    def grouped_by(self) -> dict[str, Column]:
        return {dim: F.col(dim) for dim in self.dims}

    def finish(self, rows: DataFrame) -> DataFrame:
        return rows


@dataclass(frozen=True)
class Series:
    """Measures per day, week, month, quarter or year."""

    time_col: str
    grain: str
    aggs: Mapping[str, Column]
    dims: Sequence[str] = ()

    def grouped_by(self) -> dict[str, Column]:
        dims = {dim: F.col(dim) for dim in self.dims}
        return {self.grain: time_bucket(self.time_col, self.grain), **dims}

    def finish(self, rows: DataFrame) -> DataFrame:
        return rows


@dataclass(frozen=True)
class Headline:
    """One row of totals."""

    aggs: Mapping[str, Column]

    def grouped_by(self) -> dict[str, Column]:
        return {}

    def finish(self, rows: DataFrame) -> DataFrame:
        return rows


@dataclass(frozen=True)
class Ranking:
    """The ``n`` groups that are largest by the first measure, ties by dimensions."""

    dims: Sequence[str]
    aggs: Mapping[str, Column]
    n: int

    def grouped_by(self) -> dict[str, Column]:
        return {dim: F.col(dim) for dim in self.dims}

    def finish(self, rows: DataFrame) -> DataFrame:
        ranked_by = next(iter(self.aggs))
        return rows.orderBy(F.col(ranked_by).desc_nulls_last(), *self.dims).limit(self.n)


Panel = Grouped | Series | Headline | Ranking


def dashboard_dataset(df: DataFrame, spec: Mapping[str, Panel], out: str) -> dict[str, DataFrame]:
    """One aggregated table per panel, all from one scan of ``df``.

    The groups of all panels are made in one aggregation, as grouping sets, and
    written to ``out``, a directory for each panel; the tables read these.  A
    row is counted once for each panel, before anything is shuffled.
    """
    spark = df.sparkSession
    dims: dict[tuple[str, str], str] = {}
    columns: list[Column] = []
    aggs: list[Column] = []
    sets: list[list[str]] = []
    for name, panel in spec.items():
        if not panel.aggs:
            raise ValueError(f"panel {name} measures nothing")
        own = []
        for dim, column in panel.grouped_by().items():
            dims[name, dim] = inner = unused_name(df.columns, f"_dim{len(dims)}")
            columns.append(column.alias(inner))
            own.append(inner)
        sets.append(own)
    numbered = {name: unused_name(df.columns, f"_panel{i}") for i, name in enumerate(spec)}
    # Which set a group belongs to: a constant of its own for each panel joins the group's columns.
    prepared = df.select("*", *columns, *[F.lit(i).alias(p) for i, p in enumerate(numbered.values())])
    for panel_no, (name, panel) in enumerate(spec.items()):
        sets[panel_no].append(numbered[name])
        aggs += [column.alias(f"_agg{panel_no}_{i}") for i, column in enumerate(panel.aggs.values())]
    every = [*dims.values(), *numbered.values()]
    grouped = prepared.groupingSets([[F.col(c) for c in one] for one in sets], *every).agg(*aggs)
    number = F.coalesce(*[F.col(p) for p in numbered.values()])
    made = grouped.withColumn("panel__part", number)
    made.write.mode("overwrite").partitionBy("panel__part").parquet(out)
    schema = made.schema
    stored = spark.read.schema(schema).parquet(out)
    tables = {}
    for panel_no, (name, panel) in enumerate(spec.items()):
        rows = stored.filter(F.col("panel__part") == panel_no).select(
            *[F.col(dims[name, dim]).alias(dim) for dim in panel.grouped_by()],
            *[F.col(f"_agg{panel_no}_{i}").alias(agg) for i, agg in enumerate(panel.aggs)],
        )
        tables[name] = panel.finish(rows)
    return tables

"""Panels of a dashboard that are kept up to date load by load.

What is stored for a load are states of measures that can be merged: sums, counts, extremes, and
sketches of distinct values and of quantiles.  A panel merges the states of all loads, so rows of loads
taken before are never read again; a load that comes again replaces its own states, and what it had
added is gone with them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratawell.functions import storage, versions
from stratawell.functions.storage import unused_name
from stratawell.plans.dashboard import Panel

_PANEL = "panel__part"


@dataclass(frozen=True)
class Measure:
    """A measure by its states.

    ``states`` are aggregates of rows, ``merges`` aggregates of such states that give states again, in
    the same order, and ``finish`` makes the measure of them.
    """

    states: tuple[Column, ...]
    merges: tuple[Callable[[Column], Column], ...]
    finish: Callable[..., Column]


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _added(state: Column) -> Column:
    """A sum of counts, which is 0 of none."""
    return F.coalesce(F.sum(state), F.lit(0).cast("bigint"))


def rows() -> Measure:
    return Measure((F.count(F.lit(1)),), (_added,), lambda n: n)


def total(value: str | Column, scale: int) -> Measure:
    """The sum of money-like numbers, exact in units of 10**-scale, whatever the loads and their order.

    Values are rounded to the nearest unit.  Up to 1e24 they are added as decimals; larger ones, infinite
    ones and NaN as doubles.  The sum of none is NULL.
    """
    plain = _col(value).cast("double")
    usual = F.abs(plain) <= 1e24
    units = F.rint(plain * 10**scale).cast("decimal(38,0)")
    states = F.sum(F.when(usual, units)), F.sum(F.when(~usual, plain))

    def finish(whole: Column, rest: Column) -> Column:
        unit = F.lit(f"1e-{scale}").cast(f"decimal({scale + 1},{scale})")
        exact = (whole * unit).cast("double")
        return F.when(rest.isNull(), exact).otherwise(rest + F.coalesce(exact, F.lit(0.0)))

    return Measure(states, (F.sum, F.sum), finish)


def mean(value: str | Column, scale: int) -> Measure:
    """:func:`total` over the number of values that are not NULL; NULL of none."""
    inner = total(value, scale)

    def finish(n: Column, *of_total: Column) -> Column:
        return F.when(n > 0, inner.finish(*of_total) / n)

    return Measure((F.count(_col(value)), *inner.states), (_added, *inner.merges), finish)


def smallest(value: str | Column) -> Measure:
    return Measure((F.min(_col(value)),), (F.min,), lambda x: x)


def largest(value: str | Column) -> Measure:
    return Measure((F.max(_col(value)),), (F.max,), lambda x: x)


def about_distinct(value: str | Column, bits: int = 12) -> Measure:
    """About how many different values there are: a HyperLogLog sketch of 2**bits bytes or less.

    The standard error is 1.04 / sqrt(2**bits), 1.6 per cent by default.  NULLs do not count.
    """
    sketch = F.hll_sketch_agg(_col(value).cast("string"), bits)
    return Measure(
        (sketch,), (F.hll_union_agg,), lambda s: F.coalesce(F.hll_sketch_estimate(s), F.lit(0).cast("bigint"))
    )


def about_quantile(value: str | Column, share: float, size: int = 200) -> Measure:
    """The value at about a share of all: a KLL sketch, whose ranks are off by 1.65 per cent at size 200.

    NULLs do not count; the quantile of none is NULL.
    """
    plain = _col(value).cast("double")
    states = F.count(plain), F.kll_sketch_agg_double(plain, size)

    def finish(n: Column, sketch: Column) -> Column:
        return F.when(n > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(share)))

    return Measure(states, (_added, F.kll_merge_agg_double), finish)


class _Layout:
    """Names of the columns in which the states of all panels are stored."""

    def __init__(self, spec: Mapping[str, Panel], taken: list[str] = []):
        self.spec = spec
        self.dims = {
            (name, dim): unused_name(taken, f"_dim{i}")
            for i, (name, dim) in enumerate(
                (name, dim) for name, panel in spec.items() for dim in panel.grouped_by()
            )
        }

    def dims_of(self, name: str) -> dict[str, str]:
        return {dim: self.dims[name, dim] for dim in self.spec[name].grouped_by()}

    def states_of(self, name: str) -> dict[str, list[tuple[str, Column, Callable]]]:
        """For each measure of a panel the column, aggregate and merge of each state."""
        number = list(self.spec).index(name)
        return {
            agg: [
                (f"_state{number}_{i}_{j}", state, merge)
                for j, (state, merge) in enumerate(zip(measure.states, measure.merges))
            ]
            for i, (agg, measure) in enumerate(self.spec[name].aggs.items())
        }


def _described(spec: Mapping[str, Panel]) -> dict[str, list[list[str]]]:
    return {
        name: [list(panel.grouped_by()), [f"{agg}/{len(m.states)}" for agg, m in panel.aggs.items()]]
        for name, panel in spec.items()
    }


def _states(df: DataFrame, spec: Mapping[str, Panel]) -> DataFrame:
    """The states of all panels, from one scan: as grouping sets, each row counted once a panel."""
    layout = _Layout(spec)
    inner = {place: unused_name(df.columns, name) for place, name in layout.dims.items()}
    marks = [unused_name(df.columns, f"_panel{i}") for i in range(len(spec))]
    columns = [
        column.alias(inner[name, dim])
        for name, panel in spec.items()
        for dim, column in panel.grouped_by().items()
    ]
    prepared = df.select("*", *columns, *[F.lit(i).alias(mark) for i, mark in enumerate(marks)])
    sets = [
        [*[F.col(inner[name, dim]) for dim in panel.grouped_by()], F.col(mark)]
        for (name, panel), mark in zip(spec.items(), marks)
    ]
    aggs = [
        F.when(F.coalesce(*map(F.col, marks)) == i, state).alias(column)
        for i, name in enumerate(spec)
        for states in layout.states_of(name).values()
        for column, state, _ in states
    ]
    grouped = prepared.groupingSets(sets, *inner.values(), *marks).agg(*aggs)
    return grouped.select(
        *[F.col(inner[place]).alias(name) for place, name in layout.dims.items()],
        *[c for c in grouped.columns if c.startswith("_state")],
        F.coalesce(*map(F.col, marks)).alias(_PANEL),
    )


def _merged(stored: DataFrame, spec: Mapping[str, Panel], name: str) -> DataFrame:
    """The states of one panel, merged over loads."""
    layout, number = _Layout(spec), list(spec).index(name)
    merges = [
        merge(F.col(column)).alias(column)
        for states in layout.states_of(name).values()
        for column, _, merge in states
    ]
    mine = stored.filter(F.col(_PANEL) == number)
    return mine.groupBy(*layout.dims_of(name).values()).agg(*merges)


def _stored(spark: SparkSession, out: str, state: dict) -> DataFrame:
    schema = T._parse_datatype_json_string(state["schema"])
    runs = sorted(set(state["loads"].values()))
    folders = [
        f"{out}/states/{run}/{name}"
        for run in runs
        for name in storage.entries(spark, f"{out}/states/{run}")
        if name.startswith(f"{_PANEL}=")
    ]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{out}/states").parquet(*folders)


def update_panels(df: DataFrame, spec: Mapping[str, Panel], out: str, load: int | str) -> None:
    """Take a load into the panels of a dashboard; ``df`` has the rows of that load alone.

    ``spec`` is as for :func:`~stratawell.plans.dashboard.dashboard_dataset`, with the measures of this
    module.  A load that was taken before is replaced, also by no rows.  Only ``df`` is read, once.
    The panels of an output are fixed by its first call.  A call that dies changes nothing and may be
    repeated (``functions.versions``).  One writer at a time.
    """
    spark = df.sparkSession
    for name, panel in spec.items():
        if not panel.aggs:
            raise ValueError(f"panel {name} measures nothing")
    at = versions.version(spark, out)
    state = at.state
    if state and state["spec"] != _described(spec):
        raise ValueError(f"{out} has other panels: {state['spec']}")
    if str(load) in state.get("closed", []):
        raise ValueError(f"load {load} was merged with others and cannot be replaced")
    made, run = _states(df, spec), versions.new_run()
    made.write.partitionBy(_PANEL).parquet(f"{out}/states/{run}")
    new = {
        "spec": _described(spec),
        "schema": made.schema.json(),
        "loads": state.get("loads", {}) | {str(load): run},
        "closed": state.get("closed", []),
    }
    versions.commit(spark, out, at, new)
    versions.sweep(spark, out, [f"{out}/states"])


def merge_loads(spark: SparkSession, spec: Mapping[str, Panel], out: str) -> None:
    """Merge the states of all loads taken so far into one, so that panels stay quick to read.

    These loads can then not be replaced any more.
    """
    at = versions.version(spark, out)
    state = at.state
    if len(set(state.get("loads", {}).values())) < 2:
        return
    stored, schema = _stored(spark, out, state), T._parse_datatype_json_string(state["schema"])
    parts = []
    for number, name in enumerate(spec):
        one = _merged(stored, spec, name).withColumn(_PANEL, F.lit(number))
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in one.columns]
        parts.append(one.select("*", *missing).select(*schema.names))
    run = versions.new_run()
    reduce(DataFrame.unionByName, parts).write.partitionBy(_PANEL).parquet(f"{out}/states/{run}")
    loads = list(state["loads"])
    versions.commit(spark, out, at, state | {"loads": dict.fromkeys(loads, run), "closed": loads})
    versions.sweep(spark, out, [f"{out}/states"])


def read_panels(spark: SparkSession, spec: Mapping[str, Panel], out: str) -> dict[str, DataFrame]:
    """One table per panel, over all loads taken so far; only stored states are read."""
    state = versions.version(spark, out).state
    if not state:
        raise ValueError(f"no load was taken into {out}")
    if state["spec"] != _described(spec):
        raise ValueError(f"{out} has other panels: {state['spec']}")
    stored, layout = _stored(spark, out, state), _Layout(spec)
    tables = {}
    for name, panel in spec.items():
        merged = _merged(stored, spec, name)
        figures = [
            measure.finish(*[F.col(column) for column, _, _ in states]).alias(agg)
            for (agg, states), measure in zip(layout.states_of(name).items(), panel.aggs.values())
        ]
        dims = [F.col(column).alias(dim) for dim, column in layout.dims_of(name).items()]
        tables[name] = panel.finish(merged.select(*dims, *figures))
    return tables

"""Rules that a row keeps or breaks by what is in other rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratawell.functions.storage import unused_name


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in names]


def _whole(names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [c.isNotNull() for c in _columns(names)])


@dataclass(frozen=True)
class Unique:
    """No two rows have the same values in ``columns``; a NULL is equal to nothing.

    Of several rows the first by ``order``, and then by ``key``, keeps the rule, and the others name its
    key.  Rows of ``layer``, the same columns taken in before, come before all of them.
    """

    columns: Sequence[str]
    key: str
    order: Sequence[str] = ()
    layer: DataFrame | None = None

    def broken(self, df: DataFrame, name: str, out: str) -> DataFrame:
        place = [*self.order, self.key]
        own, first = unused_name([*df.columns, out], "_own"), unused_name([*df.columns, out], "_first")
        theirs = [unused_name([*df.columns, out], f"_{c}") for c in self.columns]

        def firsts(rows: DataFrame, layer: int) -> DataFrame:
            number = F.struct(F.lit(layer).alias("layer"), *_columns(place))
            return rows.filter(_whole(self.columns)).select(
                *[c.alias(t) for c, t in zip(_columns(self.columns), theirs)], number.alias(first)
            )

        rows = firsts(df, 1)
        if self.layer is not None:
            rows = rows.unionByName(firsts(self.layer, 0))
        # One row of each group and task goes to the shuffle.
        least = rows.groupBy(*theirs).agg(F.min(first).alias(first))
        same = reduce(
            lambda a, b: a & b, [c == F.col(t) for c, t in zip(_columns(self.columns), theirs)]
        )
        met = df.withColumn(own, F.struct(F.lit(1).alias("layer"), *_columns(place))).join(least, same, "left")
        other = F.concat(F.lit(f"{name}:"), F.col(first)[self.key].cast("string"))
        is_other = F.col(first).isNotNull() & (F.col(first) != F.col(own))
        return met.withColumn(out, F.when(is_other, F.coalesce(other, F.lit(name)))).drop(own, first, *theirs)


@dataclass(frozen=True)
class Refers:
    """The values in ``columns`` are those of a row in ``layer``, in ``to``; a NULL refers to nothing.

    A row that breaks it names the values.
    """

    columns: Sequence[str]
    layer: DataFrame
    to: Sequence[str] = ()

    def broken(self, df: DataFrame, name: str, out: str) -> DataFrame:
        taken = [*df.columns, out]
        theirs = [unused_name(taken, f"_{c}") for c in self.columns]
        there = unused_name([*taken, *theirs], "_there")
        known = self.layer.select(
            *[c.alias(t) for c, t in zip(_columns(self.to or self.columns), theirs)]
        )
        known = known.filter(_whole(theirs)).distinct().withColumn(there, F.lit(True))
        same = reduce(
            lambda a, b: a & b, [c == F.col(t) for c, t in zip(_columns(self.columns), theirs)]
        )
        values = F.concat_ws("/", *[c.cast("string") for c in _columns(self.columns)])
        lost = _whole(self.columns) & F.col(there).isNull()
        met = df.join(known, same, "left")
        return met.withColumn(out, F.when(lost, F.concat(F.lit(f"{name}:"), values))).drop(there, *theirs)


@dataclass(frozen=True)
class Usual:
    """A number is not farther than ``spread`` times the distance of two quantiles outside of them.

    The quantiles are those of all rows, from a KLL sketch that is merged from all tasks, so they are
    off by about 1.65 per cent of ranks.  They are taken before the rows are judged: one row goes to the
    driver.  A NULL is usual, a NaN is not.  A row that breaks it names the bounds.
    """

    column: str
    spread: float = 3.0
    low: float = 0.25
    high: float = 0.75

    def broken(self, df: DataFrame, name: str, out: str) -> DataFrame:
        value = F.col(f"`{self.column}`").cast("double")
        sketch = F.kll_sketch_agg_double(F.when(~F.isnan(value), value))
        row = df.agg(sketch.alias("s"), F.count(F.when(~F.isnan(value), value)).alias("n"))
        low, high = row.select(
            *[
                F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("s", F.lit(share)))
                for share in (self.low, self.high)
            ]
        ).first()
        if low is None:
            return df.withColumn(out, F.when(F.isnan(value), F.lit(name)))
        reach = self.spread * (high - low)
        first, last = low - reach, high + reach
        odd = F.isnan(value) | ~value.between(first, last)
        return df.withColumn(out, F.when(odd, F.lit(f"{name}:{first:g}..{last:g}")))


RowRule = Unique | Refers | Usual


def tag_row_rules(df: DataFrame, rules: Mapping[str, RowRule], col: str = "reasons") -> DataFrame:
    """Add the rules that each row breaks, each with what in other rows it breaks them by.

    All rows and columns are kept.  If there is a column ``col`` of reasons already, as of ``tag_valid``,
    the reasons are added to it.  ``df`` is read once for each rule, so pass a stored one.
    """
    columns, tags = list(df.columns), []
    for name, rule in rules.items():
        tags.append(unused_name([*df.columns, col], f"_broken{len(tags)}"))
        df = rule.broken(df, name, tags[-1])
    reasons = F.array_compact(F.array(*_columns(tags)))
    if col in columns:
        reasons = F.concat(F.coalesce(F.col(col), F.array().cast("array<string>")), reasons)
    kept = [c for c in columns if c != col]
    return df.select(*_columns(kept), reasons.alias(col))

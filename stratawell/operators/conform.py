"""Typing and validity: the row-wise steps of the refined layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratawell.functions.cleaning import Field


def conform(df: DataFrame, mapping: Sequence[Field]) -> DataFrame:
    """Trim, lower-case, rename and cast; a value that does not fit becomes NULL."""
    raw_types = df.select(*[f.raw() for f in mapping]).schema
    return df.select(*[f.typed(raw_types[f.name].dataType) for f in mapping])


def names_where(flags: Sequence[tuple[str, Column]]) -> Column:
    """The names whose flag, which is never NULL, is true.

    By functions that Spark compiles: one with a lambda, such as ``array_compact``, has all columns of
    its projection interpreted.
    """
    if not flags:
        return F.array()
    return F.concat(*[F.array_repeat(F.lit(name), flag.cast("int")) for name, flag in flags])


def broken_rules(rules: Mapping[str, Column]) -> Column:
    """Names of the rules a row breaks; a rule that is NULL counts as broken."""
    return names_where([(name, ~F.coalesce(rule, F.lit(False))) for name, rule in rules.items()])


def tag_valid(df: DataFrame, rules: Mapping[str, Column], col: str = "reasons") -> DataFrame:
    """Add the broken rules of each row, so that one pass can serve both outcomes."""
    return df.withColumn(col, broken_rules(rules))


def split_valid(
    df: DataFrame, rules: Mapping[str, Column], col: str = "reasons"
) -> tuple[DataFrame, DataFrame]:
    """Split rows into accepted ones and quarantined ones with their reasons.

    Each row lands on exactly one side.  The two sides are two plans over the
    same input: where both are written and the input is costly, write
    :func:`tag_valid` once and filter the result instead.
    """
    if not rules:
        raise ValueError("no rules given")
    # A filter drops NULL like false, so the plain conjunction is NULL-safe
    # here and, unlike a wrapped one, reaches the scan.
    sound = reduce(lambda a, b: a & b, rules.values())
    broken = ~F.coalesce(sound, F.lit(False))
    return df.filter(sound), tag_valid(df.filter(broken), rules, col)

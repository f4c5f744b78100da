"""Fields that land but are not in the schema: kept as they came, reported, and taken into it."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rest_of(text: str, schema: T.StructType, options: dict[str, str]) -> Column:
    """The fields of a JSON object that a schema has not, as a map to VARIANT; NULL if there are none.

    A field whose name differs from a column's in case only is outside the schema unless the session
    reads names without case.
    """
    parsed = F.from_json(text, "map<string,variant>", {"mode": "PERMISSIVE", **options})
    known = F.array(*[F.lit(name) for name in schema.names]).cast("array<string>")
    rest = F.map_filter(parsed, lambda name, value: ~F.array_contains(known, name))
    return F.when(F.size(rest) > 0, rest)


def drift_report(df: DataFrame, rest_col: str, file_col: str | None = None) -> DataFrame:
    """(file, field, type, n): the fields outside the schema, with what was seen of each in each file.

    ``type`` is the narrowest that holds all values seen: whole numbers widen to decimals and to
    doubles, objects and arrays are merged field by field, and what has nothing in common is ``VARIANT``.
    ``n`` counts rows.  ``file`` is NULL without a ``file_col``.  Types are merged in each task before
    anything is shuffled, so the shuffle has a row per task, file and field.
    """
    file = F.lit(None).cast("string") if file_col is None else F.col(f"`{file_col}`")
    each = df.select(file.alias("file"), F.explode(F.col(f"`{rest_col}`")).alias("field", "value"))
    return each.groupBy("file", "field").agg(
        F.schema_of_variant_agg("value").alias("type"), F.count(F.lit(1)).alias("n")
    )


def _ddl(kind: str) -> str:
    """A type that a report names as one that a schema can have."""
    kind = re.sub(r"\bOBJECT<", "STRUCT<", kind)
    return re.sub(r"\bVOID\b", "STRING", kind)


def widened(df: DataFrame, rest_col: str, schema: T.StructType) -> T.StructType:
    """The schema with the fields that were seen outside it, in the order of their names.

    Each has the narrowest type that holds what all files had of it; a field of which only NULLs were
    seen is a string.  To the driver goes a row for each field.
    """
    each = df.select(F.explode(F.col(f"`{rest_col}`")).alias("field", "value"))
    seen = each.groupBy("field").agg(F.schema_of_variant_agg("value").alias("type")).collect()
    more = [
        T.StructField(row["field"], T._parse_datatype_string(_ddl(row["type"]))) for row in seen
    ]
    return T.StructType([*schema.fields, *sorted(more, key=lambda field: field.name)])

"""Catalog namespaces for the layers."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote

from pyspark.sql import SparkSession

from stratawell.functions import storage


def create_layers(spark: SparkSession, names: Iterable[str], root: str) -> dict[str, str]:
    """Create one schema per layer under ``root`` if missing; return their locations.

    A schema that exists elsewhere is an error, since tables would silently be
    created in the other place.
    """
    locations = {}
    for name in names:
        location = storage.qualify(spark, f"{root.rstrip('/')}/{name}")
        quoted = location.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}` LOCATION '{quoted}'")
        actual = storage.qualify(spark, spark.catalog.getDatabase(name).locationUri)
        # The catalog may report the location as a URI, with blanks encoded.
        if unquote(actual) != unquote(location):
            raise ValueError(f"schema {name} lies at {actual}, not at {location}")
        locations[name] = location
    return locations

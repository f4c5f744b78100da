"""File sources: delimited files, landing directories, layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratawell.functions import storage, versions
from stratawell.operators.bronze import PART
from stratawell.operators.decode import decode_json


# Formats whose readers can keep the text of a record they cannot parse.
TEXT_FORMATS = ("csv", "json", "xml")


def _with_corrupt(schema: T.StructType, corrupt_col: str | None) -> T.StructType:
    if corrupt_col is None:
        return schema
    # A new list: StructType shares and would extend the caller's own fields.
    return T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])


def _every_column_read(schema: T.StructType) -> Column:
    """True, but only known when every column of a row has been read."""
    seen = F.xxhash64(*[F.col(f"`{f.name}`").isNull() for f in schema.fields])
    return seen >= F.lit(-(2**63))


def _keep_whole_record(df: DataFrame, schema: T.StructType, corrupt_col: str | None) -> DataFrame:
    """Make the corrupt column read every data column.

    Text readers convert only the columns a query selects, so a bad value in an
    unselected column would go unnoticed and the row would look sound.
    """
    if corrupt_col is None:
        return df
    always = _every_column_read(schema)
    return df.withColumn(corrupt_col, F.when(always, F.col(f"`{corrupt_col}`")))


def csv_source(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    header: bool = True,
    corrupt_col: str | None = None,
    whole: bool = False,
    **options,
) -> DataFrame:
    """Read delimited files into a typed table.

    The header is checked against the schema, so files whose columns come in
    another order fail instead of being read by position.  With ``corrupt_col``
    the text of a record that differs from the schema (a value of the wrong
    type, too few or too many fields) is kept there beside whatever could be
    parsed; without it, such a record fails the query unless ``mode`` is given.
    Only the columns that a query selects are looked at, unless ``whole`` is true:
    then every column is read, and a bad value in any of them counts.  Empty text and NULL both read as NULL.  Files stay splittable
    unless ``multiLine`` is set.
    """
    reader = (
        spark.read.schema(_with_corrupt(schema, corrupt_col))
        .option("header", header)
        .option("enforceSchema", not header)
        .options(**({"mode": "FAILFAST"} if corrupt_col is None else {}))
        .options(**options)
    )
    if corrupt_col is not None:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
    rows = _keep_whole_record(reader.csv(path), schema, corrupt_col)
    return rows.filter(_every_column_read(schema)) if whole else rows


def file_stream(
    spark: SparkSession,
    directory: str,
    fmt: str,
    schema: T.StructType,
    max_files: int | None = None,
    max_bytes: int | None = None,
    corrupt_col: str | None = None,
    rest_col: str | None = None,
    **options,
) -> DataFrame:
    """Read files landing in a directory as a stream.

    ``max_files`` or ``max_bytes`` (not both) bounds one micro-batch; give one
    of them whenever a backlog may be large, and size it by the bytes wanted per
    output file.  A file is taken once, by name: rewriting it in place is not
    noticed.

    Columns outside ``schema`` are dropped, unless ``rest_col`` names a column for
    them, a map from names to VARIANT.  That is for JSON files with a record on each
    line; it takes a ``corrupt_col``, by default ``_corrupt``, so nothing is lost:
    a record is parsed, with what is outside the schema, or kept as its text.
    """
    if max_files is not None and max_bytes is not None:
        raise ValueError("give max_files or max_bytes, not both")
    if corrupt_col is not None and fmt not in TEXT_FORMATS:
        raise ValueError(f"{fmt} files have no corrupt records to keep")
    if rest_col is not None and fmt != "json":
        raise ValueError(f"{fmt} files have no fields outside their schema to keep")
    if rest_col is not None:
        reader = spark.readStream.format("text")
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        if max_bytes is not None:
            reader = reader.option("maxBytesPerTrigger", max_bytes)
        lines = reader.load(directory).filter(F.trim("value") != "")
        return decode_json(lines, schema, "value", corrupt_col or "_corrupt", rest_col=rest_col, **options)
    reader = (
        spark.readStream.format(fmt)
        .schema(_with_corrupt(schema, corrupt_col))
        .options(**options)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if corrupt_col is not None:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
    return _keep_whole_record(reader.load(directory), schema, corrupt_col)


def read_layer(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read one layer as input of the next; filters and columns reach the scan.

    With ``schema`` a layer that holds no rows yet, or does not exist, is empty.
    Columns that exist for directories only are left out.  Of a table kept in
    versions, such as that of ``upsert_partitions``, the newest is read.
    """
    at = versions.version(spark, path)
    if at.number:
        return versions.read_parts(spark, path, at.state["column"], at.state["parts"], schema)
    if schema is None:
        layer = spark.read.parquet(path)
        return layer.select(*[F.col(f"`{c}`") for c in layer.columns if not c.endswith(PART)])
    if not storage.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*[F.col(f"`{c}`") for c in schema.names])

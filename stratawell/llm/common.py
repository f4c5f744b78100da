"""Helpers of the operators: step tables in a shared folder, words, Arrow columns.

Operators run in steps.  What a later step reads more than once is written as Parquet below
``spark.checkpoint.dir``, which every executor can reach, so a lost executor costs only the tasks
it was running.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What steps run under: small Arrow batches, as texts may be long, and no shuffle files kept
#: beyond the step that wrote them.
STEP_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/stratawell-llm/{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for a while."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class Steps:
    """Step tables of one run of an operator, in a folder of their own."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = shared_folder(spark)
        self._count = 0

    def save(self, df: DataFrame) -> DataFrame:
        """The same rows, written and read again."""
        self._count += 1
        path = f"{self.folder}/step{self._count}"
        with settings(self.spark, STEP_SETTINGS):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        """Delete step tables that nothing reads any more."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for table in tables:
            for folder in {path.rsplit("/", 1)[0] for path in table.inputFiles()}:
                if f"{self.folder.rpartition('/')[2]}/step" in folder:
                    at = jvm.org.apache.hadoop.fs.Path(folder)
                    at.getFileSystem(conf).delete(at, True)


def unused(df: DataFrame, name: str) -> str:
    """The name, or one made of it that no column has, whatever its case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def id_bucket(column: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo a number; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lowest_hashes(place: Column, rows: int, wanted: int) -> Column:
    """Whether a 64-bit hash is among the lowest, in a share that holds four times ``wanted`` of ``rows``.

    What is then ranked is bounded whatever the number of rows.
    """
    share = min(1.0, 4 * wanted / max(rows, 1))
    return place <= F.lit(min((1 << 63) - 1, int(share * (1 << 64)) - (1 << 63)))

"""Paths on whichever file system Spark is configured for."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _resolve(spark, path)
    return fs.exists(hadoop_path)


def has_entries(spark: SparkSession, path: str) -> bool:
    """True if the directory exists and holds anything; lists one entry only."""
    fs, hadoop_path = _resolve(spark, path)
    return fs.exists(hadoop_path) and fs.listStatusIterator(hadoop_path).hasNext()


def qualify(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, so two spellings compare equal."""
    fs, hadoop_path = _resolve(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one short text file, with its directory, replacing it if present."""
    fs, hadoop_path = _resolve(spark, path)
    out = fs.create(hadoop_path, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a short file; None if there is no such file."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def claim(spark: SparkSession, path: str, text: str, wait: float = 5.0) -> str:
    """Create a short text file unless it is there; returns the text it then has.

    Of several callers at once one creates the file, and all get that one's text.  A file that
    stays empty for ``wait`` seconds was left by a caller that died before writing it: it is taken over.
    """
    fs, hadoop_path = _resolve(spark, path)
    try:
        out = fs.create(hadoop_path, False)
    except Exception as error:
        until = time.monotonic() + wait
        while not (found := read_text(spark, path)) and time.monotonic() < until:
            time.sleep(0.1)
        if found:
            return found
        if found is None:
            raise error
        write_text(spark, path, text)
        return read_text(spark, path) or text
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    return text


def rename_new(spark: SparkSession, path: str, target: str) -> None:
    """Rename a file to a name that is free; raises if it is taken."""
    fs, hadoop_path = _resolve(spark, path)
    _, to = _resolve(spark, target)
    if fs.exists(to) or not fs.rename(hadoop_path, to):
        fs.delete(hadoop_path, False)
        raise RuntimeError(f"{target} is there already: another writer was at work")


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a directory with all in it, if it is there."""
    fs, hadoop_path = _resolve(spark, path)
    fs.delete(hadoop_path, True)


def entries(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory; of none that is missing."""
    fs, hadoop_path = _resolve(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the warehouse where that is unset.

    Driver and executors must share this folder.  On a cluster a default warehouse, which is a folder
    of the driver's machine, is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if root.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set spark.checkpoint.dir: {root} is a folder of the driver alone")
    return root.rstrip("/")


def workspace(spark: SparkSession) -> str:
    """A fresh directory below the folder that driver and executors share."""
    return f"{shared_root(spark)}/stratawell/{uuid.uuid4().hex}"


def unused_name(taken: list[str], name: str) -> str:
    """The name, or one made of it that is not taken, whatever its case."""
    known = {one.lower() for one in taken}
    while name.lower() in known:
        name = f"_{name}"
    return name

"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_open: list[list[str]] = []  # for each scratch() that is open, the folders made within


def build_session(name: str = "wattloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the library's settings; extra keys use _ for the dots."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | {k.replace("_", "."): v for k, v in extra.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Where it is unset, a local session gets a folder of its own; on a cluster that
    is an error, as each executor would write to its own disk.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="wattloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str, *, lasting: bool = False) -> str:
    """A path of its own in the shared folder; unless lasting, an open scratch() deletes it at its end."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _open and not lasting:
        _open[-1].append(path)
    return path


def stage(df: DataFrame, name: str, *, lasting: bool = False) -> DataFrame:
    """df written to the shared folder and read again.

    It cuts the lineage: what comes after survives the loss of any executor
    without running what came before again.
    """
    path = new_folder(df.sparkSession, name, lasting=lasting)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, on any file system that Spark can reach."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged within, and isn't lasting, is deleted at the end; results must be written by then."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            remove(spark, path)

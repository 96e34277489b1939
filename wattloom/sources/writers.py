"""Writing partitions, reports and tables, and looking after them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, partition: Sequence[str], *, sort: Sequence[str] = (), fmt: str = "parquet", mode: str = "overwrite", blooms: Mapping[str, int] | None = None, max_records: int | None = None, spread: int = 1) -> None:
    """Write by partition columns; overwriting replaces only the partitions that df has rows for.

    sort: order within files.  blooms: column -> expected distinct values.
    Rows are dealt by partition, and adaptive execution divides a large partition among
    tasks by its size and puts small ones together.  spread: files that one partition is dealt
    over in any case, by a hash of the sort columns.
    """
    if spread > 1:
        dealt = df.repartition(*partition, F.pmod(F.xxhash64(*(sort or df.columns)), F.lit(spread)))
    else:
        dealt = df.hint("rebalance", *(f"`{c}`" for c in partition))
    ordered = dealt.sortWithinPartitions(*partition, *sort)
    writer = ordered.write.format(fmt).mode(mode).partitionBy(*partition).option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    for column, ndv in (blooms or {}).items():
        if fmt == "parquet":
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option(f"parquet.bloom.filter.expected.ndv#{column}", str(ndv))
    if fmt == "orc" and blooms:
        writer = writer.option("orc.bloom.filter.columns", ",".join(blooms))
    writer.save(path)


def write_plain(df: DataFrame, path: str, *, fmt: str = "parquet") -> None:
    """Replace an unpartitioned table."""
    df.write.format(fmt).mode("overwrite").save(path)


def write_report(df: DataFrame, path: str, *, sep: str = ",") -> None:
    """One text file with a header; for reports, which are small."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def insert_into(df: DataFrame, table: str, **constants: object) -> None:
    """Append by column name, with constant columns."""
    full = df.withColumns({k: F.lit(v) for k, v in constants.items()})
    wanted = df.sparkSession.table(table).schema
    full.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted.fields]).write.insertInto(table)


def truncate_partition(spark: SparkSession, table: str, **values: str) -> None:
    """Drop one partition of a catalogue table, if it is there."""
    spec = ", ".join(f"{k}='{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def old_partitions(spark: SparkSession, table: str, column: str, keep_from: str) -> list[str]:
    """Values of a partition column before keep_from, by its own order as text."""
    parts = spark.sql(f"SHOW PARTITIONS {table}").select(F.regexp_extract("partition", rf"(?:^|/){column}=([^/]+)", 1).alias("v")).distinct()
    return [r["v"] for r in parts.where(F.col("v") < keep_from).orderBy("v").collect()]


def drop_old_partitions(spark: SparkSession, table: str, column: str, keep_from: str, *, dry_run: bool = True) -> list[str]:
    """Partitions older than keep_from; they are dropped only with dry_run=False."""
    found = old_partitions(spark, table, column, keep_from)
    if not dry_run:
        for value in found:
            truncate_partition(spark, table, **{column: value})
    return found


def sync_partitions(spark: SparkSession, table: str) -> None:
    """Make the catalogue know partitions that were written as files."""
    spark.catalog.recoverPartitions(table)


def union_view(frames: Mapping[str, DataFrame], name: str, *, column: str = "opco") -> DataFrame:
    """A view over one table for each company, each held to its own rows."""
    parts = [df.where(F.col(column) == company) for company, df in frames.items()]
    whole = reduce(DataFrame.unionByName, parts)
    whole.createOrReplaceTempView(name)
    return whole


def current_run_view(df: DataFrame, run: str, name: str, *, order: Sequence[str] = ("aggr_type", "opco", "usage_dt", "register")) -> DataFrame:
    """A view of one run, in order."""
    current = df.where(F.col("run_dt") == run).orderBy(*order)
    current.createOrReplaceTempView(name)
    return current

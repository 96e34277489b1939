"""Duplicates, unions and incremental merges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: str, *, ties: Sequence[str] = ()) -> DataFrame:
    """The row of each key that is latest; of equally late ones the greatest by the tie columns, then by all others that have an order.

    An aggregate with partial results before the shuffle, so that a key with very
    many rows is no single task.  Null keys are keys like others.
    """
    others = [f.name for f in df.schema.fields if f.name not in (order, *ties, *keys) and "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    order_by = F.struct(*[F.col(f"`{c}`") for c in (order, *ties, *others)])
    rest = [c for c in df.columns if c not in keys]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order_by).alias("__row"))
    return latest.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def drop_all_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once; every copy of a repeated key goes."""
    once = df.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n = 1").drop("__n")
    condition = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    return df.alias("l").join(once.alias("r"), condition, "left_semi")


def drop_null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows, by column name; types follow the first frame."""
    first = frames[0]
    same = [first, *(f.select(*[F.col(f"`{x.name}`").cast(x.dataType).alias(x.name) for x in first.schema.fields]) for f in frames[1:])]
    return reduce(DataFrame.unionByName, same)


def touched_partitions(df: DataFrame, partition: Sequence[str]) -> DataFrame:
    """The partitions that a batch has rows for."""
    return df.select(*partition).distinct()


def merge_incremental(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], *, order: str, partition: Sequence[str], ties: Sequence[str] = ()) -> DataFrame:
    """The touched partitions as they are after the batch: incoming and stored rows, the latest of each key.

    The result replaces just those partitions (see writers.write_partitioned).
    Incoming rows win against stored ones of the same time.
    """
    touched = touched_partitions(incoming, partition)
    base = stored.join(touched, list(partition), "left_semi")
    both = union_all([incoming.withColumn("__new", F.lit(1)), base.withColumn("__new", F.lit(0))])
    return dedupe_latest(both, keys, order, ties=["__new", *ties]).drop("__new")


def merge_full(incoming: DataFrame, keys: Sequence[str], *, order: str, day: str, days: str, ties: Sequence[str] = ()) -> DataFrame:
    """The first load of a range of days, 'from~to' inclusive, without a stored base."""
    first, last = days.split("~")
    return dedupe_latest(incoming.where(F.col(day).between(first, last)), keys, order, ties=ties)


def find_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, and how many."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")

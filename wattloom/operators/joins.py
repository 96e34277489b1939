"""Joins by what they are for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .back import join_back


def enrich(df: DataFrame, dim: DataFrame, on: Sequence[str], *, columns: Sequence[str] | None = None, one_row: bool = False) -> DataFrame:
    """Columns of a dimension, where it has the key (left outer).

    Equal rows of the dimension count once.  A key with several different rows
    multiplies rows of df, unless one_row keeps the smallest.
    """
    dim = dim.select(*on, *(columns or [c for c in dim.columns if c not in on])).distinct()
    if one_row:
        rest = [c for c in dim.columns if c not in on]
        dim = dim.groupBy(*on).agg(F.min(F.struct(*rest)).alias("__r")).select(*on, "__r.*")
    return df.join(dim, list(on), "left")


def attach(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows that have a partner, with its columns (inner)."""
    return df.join(other, list(on), "inner")


def not_exists(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows without a partner; a null key has none."""
    return df.join(other.select(*on).distinct(), list(on), "left_anti")


def exists(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(other.select(*on).distinct(), list(on), "left_semi")


def arg_min(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The rows with the smallest value of their key, all of them on a tie."""
    least = df.groupBy(*keys).agg(F.min(value).alias("__least"))
    return join_back(df, least, keys).where(F.col(value) == F.col("__least")).drop("__least")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence, k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def dense_rank(df: DataFrame, keys: Sequence[str], order: Sequence, out: str = "rank") -> DataFrame:
    return df.withColumn(out, F.dense_rank().over(Window.partitionBy(*keys).orderBy(*order)))

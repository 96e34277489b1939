"""Interval series: complete days and dense day vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def complete_days(df: DataFrame, keys: Sequence[str], *, value: str = "value", expected: int = 96, positive: bool = True) -> DataFrame:
    """Keys whose rows are as many as expected, without nulls, and (positive) all above 0.

    Rows are counted, not distinct slots.
    """
    kept = df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.col(value).isNull().cast("int")).alias("nulls"), F.min(value).alias("least"))
    full = (F.col("n") == expected) & (F.col("nulls") == 0)
    return kept.where(full & (F.col("least") > 0) if positive else full).select(*keys)


def keep_complete(df: DataFrame, keys: Sequence[str], *, value: str = "value", expected: int = 96, positive: bool = True) -> DataFrame:
    """The rows of complete days: one window over the keys, no join."""
    w = Window.partitionBy(*keys)
    v = F.col(value)
    flagged = df.withColumns({"__n": F.count("*").over(w), "__nulls": F.sum(v.isNull().cast("int")).over(w), "__least": F.min(v).over(w)})
    full = (F.col("__n") == expected) & (F.col("__nulls") == 0)
    return flagged.where(full & (F.col("__least") > 0) if positive else full).drop("__n", "__nulls", "__least")


def pivot_day(df: DataFrame, keys: Sequence[str], *, slot: str = "slot", value: str = "value", out: str = "curve") -> DataFrame:
    """One array for each key, in slot order; a slot that repeats counts with its smallest value."""
    once = df.groupBy(*keys, slot).agg(F.min(value).alias("__v"))
    pairs = F.array_sort(F.collect_list(F.struct(F.col(slot).alias("s"), F.col("__v").alias("v"))))
    return once.groupBy(*keys).agg(F.transform(pairs, lambda p: p["v"]).alias(out))


def explode_day(df: DataFrame, keys: Sequence[str], *, curve: str = "curve", slot: str = "slot", value: str = "value") -> DataFrame:
    """The long form of arrays: one row for each element."""
    return df.select(*keys, F.posexplode(curve).alias(slot, value)).withColumn(value, F.col(value).cast("double"))

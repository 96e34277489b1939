"""One-hot features of classified events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_ids(rules: DataFrame) -> list[str]:
    """The distinct pivot ids of a rule table, in order; a rule table is small."""
    return [r[0] for r in rules.select("pivot_id").where("pivot_id is not null").distinct().orderBy("pivot_id").collect()]


def one_hot(df: DataFrame, ids: Sequence[str], *, column: str = "pivot_id") -> DataFrame:
    """A column for each id: 1 where the row has it, else 0."""
    return df.select(*df.columns, *[F.coalesce((F.col(column) == i).cast("long"), F.lit(0)).alias(i) for i in dict.fromkeys(ids)])


def event_counts(df: DataFrame, keys: Sequence[str], ids: Sequence[str]) -> DataFrame:
    """Sums of the one-hot columns by key."""
    return df.groupBy(*keys).agg(*[F.sum(i).alias(i) for i in dict.fromkeys(ids)])

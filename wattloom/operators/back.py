"""Aggregates joined back to the rows they come from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_back(df: DataFrame, found: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """df with the other columns of an aggregate by the keys; null keys are keys like others.

    The keys are joined as one struct.  Structs are equal where their fields are, nulls
    included, and a join on them is dealt anew: an aggregate by the keys themselves would
    leave its rows as they lie, and adaptive execution then can't split a frequent key's rows.
    """
    taken = {c.lower() for c in (*df.columns, *found.columns)}
    names = []
    for name in ("__left", "__right"):
        while name in taken:
            name += "_"
        names.append(name)
    key = F.struct(*[F.col(f"`{k}`") for k in keys])
    rest = [F.col(f"`{c}`") for c in found.columns if c not in keys]
    left = df.withColumn(names[0], key)
    return left.join(found.select(key.alias(names[1]), *rest), F.col(names[0]) == F.col(names[1]), how).drop(*names)

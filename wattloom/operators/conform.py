"""Operators that bring tables to one shape."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import conform as fn


def map_codes(df: DataFrame, codes: DataFrame, *, name: str, code: str = "code", other: str = "XX") -> DataFrame:
    """df with `code` looked up by `name`; codes has the columns of those names."""
    known = codes.select(F.col(name).alias("__name"), F.col(code).alias("__code")).dropDuplicates(["__name"])
    return df.join(known, F.col(name) == F.col("__name"), "left").withColumn(code, F.coalesce("__code", F.lit(other))).drop("__name", "__code")


def codes_for(codes: DataFrame, wanted: Sequence[str], *, code: str = "code", name: str = "name") -> DataFrame:
    """The names of short codes; no rows for a code that is not known."""
    return codes.where(F.col(code).isin(list(wanted))).select(code, name).distinct()


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts by name; what does not fit becomes null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def split_valid(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that have all required columns, and the others."""
    valid = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    return df.where(valid), df.where(~valid)


def filter_channel(df: DataFrame, channels: Mapping[str, Sequence[str]], *, unit: str, group: str = "opco", unit_col: str = "uom", channel_col: str = "channel", default: Sequence[str] = ()) -> DataFrame:
    """Readings of a unit in the channels that its company uses (default: of any other)."""
    fits = F.col(channel_col).isin(list(default)) & ~F.col(group).isin(list(channels)) if default else F.lit(False)
    for company, names in channels.items():
        fits = fits | ((F.col(group) == company) & F.col(channel_col).isin(list(names)))
    return df.where((F.col(unit_col) == unit) & fits)


def with_slots(df: DataFrame, *, ts: str = "ts", minutes: int = 15, value: str = "value") -> DataFrame:
    """day, slot and is_null of readings on the grid."""
    t = F.col(ts)
    return df.where(fn.on_grid(t, minutes)).withColumns({"day": F.to_date(t), "slot": fn.slot_of(t, minutes), "is_null": F.col(value).isNull().cast("int")})


def stamp_run(df: DataFrame, run_ts: str, **constants: object) -> DataFrame:
    """update_dttm and run_id of a run's clock, which is passed in, and constant columns."""
    stamp = F.lit(run_ts).cast("timestamp")
    return df.withColumns({"update_dttm": F.date_format(stamp, "yyyy-MM-dd HH:mm:ss"), "run_id": F.unix_timestamp(stamp)} | {k: F.lit(v) for k, v in constants.items()})


def fill_nulls(df: DataFrame, value: float = 0, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.fill(value, list(subset) if subset else None)


def conform_union(wide: DataFrame, narrow: DataFrame, filler: Column | None = None) -> DataFrame:
    """The rows of both in the columns of the first; what the second lacks gets the filler ('' for strings, else null)."""
    columns = []
    for f in wide.schema.fields:
        if f.name in narrow.columns:
            columns.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
        else:
            empty = filler if filler is not None else F.lit("" if f.dataType.simpleString() == "string" else None)
            columns.append(empty.cast(f.dataType).alias(f.name))
    return wide.unionByName(narrow.select(*columns))


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))

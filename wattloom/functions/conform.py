"""Scalar expressions that conform text, dates, slots and codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import INTERVALS_A_DAY, USAGE_FLAGS


def parse_date(text: Column, formats: Sequence[str] = ("yyyy-MM-dd", "yyyy/MM/dd")) -> Column:
    """The first format that fits; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats])


def floor_date(day: Column, floor: str = "1900-01-01") -> Column:
    """Days before the floor become the floor; null stays null."""
    return F.when(day.isNotNull(), F.greatest(day, F.lit(floor).cast("date")))


def on_grid(ts: Column, minutes: int = 15) -> Column:
    """Whether a time lies on a boundary of so many minutes."""
    return F.pmod(F.unix_timestamp(ts), F.lit(minutes * 60)) == 0


def slot_of(ts: Column, minutes: int = 15) -> Column:
    """The number of the slot within its day, from 0."""
    return F.floor((F.hour(ts) * 60 + F.minute(ts)) / minutes).cast("int")


def quality_class(code: Column, actual: Sequence[str], yes: str = "REGULAR", no: str = "ESTIMATE") -> Column:
    """yes for the given codes, no for all others and for null."""
    return F.when(code.isin(list(actual)), yes).otherwise(no)


def usage_type(flag: Column, kinds: Sequence[tuple[str, str]] = USAGE_FLAGS, other: str = "un") -> Column:
    out = F.lit(other)
    for value, kind in reversed(kinds):
        out = F.when(flag == value, kind).otherwise(out)
    return out


def interval_bucket(count: Column, expected: int = INTERVALS_A_DAY) -> Column:
    """'<n', 'n' or '>n' of a count that may be text; null where it is no number."""
    n = count.try_cast("int")
    return F.when(n > expected, f">{expected}").when(n < expected, f"<{expected}").when(n == expected, str(expected))


def usage_where(value: Column, condition: Column) -> Column:
    """The value where the condition holds, else 0."""
    return F.when(condition, value).otherwise(F.lit(0).cast("double"))


def split_field(text: Column, part: int, separator: str = "-") -> Column:
    """Part of a joined id, counted from 1; null beyond the last."""
    return F.get(F.split(text, rf"\Q{separator}\E"), F.lit(part - 1))


def decile_digit(p: Column, as_text_digit: bool = False) -> Column:
    """0 to 9 for a probability.

    as_text_digit: the first decimal digit, so 1.0 gives 0; else 1.0 gives 9.
    """
    tenth = F.floor(F.round(p * 10, 9)).cast("int")
    return F.pmod(tenth, F.lit(10)) if as_text_digit else F.when(tenth.isNotNull(), F.least(tenth, F.lit(9)))


def percent_off(source: Column, target: Column) -> Column:
    """(source - target) / source * 100, two decimals, as decimal(7,4); null where it has none."""
    share = F.try_divide(source - target, source.cast("double")) * 100
    return F.nanvl(F.round(share, 2), F.lit(0.0)).try_cast("decimal(7,4)")

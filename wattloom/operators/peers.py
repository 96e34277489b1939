"""Meters against the others of their group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors
from .back import join_back
from .series import explode_day


def group_size(df: DataFrame, group: Sequence[str], out: str = "group_size") -> DataFrame:
    """Rows of the group, attached to each; rows without a group are one."""
    sizes = df.groupBy(*group).agg(F.count("*").alias(out))
    return join_back(df, sizes, group)


def distinct_group_size(df: DataFrame, group: Sequence[str], member: str, out: str = "group_size") -> DataFrame:
    """Distinct members of the group, attached to each row."""
    sizes = df.groupBy(*group).agg(F.count_distinct(member).alias(out))
    return join_back(df, sizes, group)


def group_curve(df: DataFrame, group: Sequence[str], *, curve: str = "curve", out: str = "group_curve", peers_of: str | None = None) -> DataFrame:
    """The mean of all curves of a group, element by element; peers_of: a member column, and only groups of two members or more."""
    if peers_of:
        several = df.groupBy(*group).agg(F.min(peers_of).alias("__lo"), F.max(peers_of).alias("__hi")).where("__lo < __hi").select(*group)
        df = df.join(several, list(group), "left_semi")
    means = explode_day(df, group, curve=curve).groupBy(*group, "slot").agg(F.avg("value").alias("v"))
    pairs = F.array_sort(F.collect_list(F.struct("slot", "v")))
    return means.groupBy(*group).agg(F.transform(pairs, lambda p: p["v"]).alias(out))


def peer_curve(df: DataFrame, group: Sequence[str], member: str, *, curve: str = "curve", out: str = "peer_curve") -> DataFrame:
    """For each row, the mean curve of the group's other members.

    Sums of the group less sums of the member itself (all its rows): linear in
    the rows, where a join of the group with itself would be quadratic.  A member
    without peers has no row.
    """
    long = explode_day(df, [*group, member], curve=curve)
    own = long.groupBy(*group, member, "slot").agg(F.sum("value").alias("own"), F.count("value").alias("n_own"))
    whole = own.groupBy(*group, "slot").agg(F.sum("own").alias("total"), F.sum("n_own").alias("n"))
    left = own.join(whole, [*group, "slot"]).where("n > n_own").withColumn("v", (F.col("total") - F.col("own")) / (F.col("n") - F.col("n_own")))
    pairs = F.array_sort(F.collect_list(F.struct("slot", "v")))
    peers = left.groupBy(*group, member).agg(F.transform(pairs, lambda p: p["v"]).alias(out))
    return df.join(peers, [*group, member])


def compare_curves(df: DataFrame, *, curve: str = "curve", other: str = "peer_curve") -> DataFrame:
    """distance, cosine and mismatch of two curves."""
    x, y = F.col(curve), F.col(other)
    return df.withColumns({"distance": vectors.euclid_of_unit(x, y), "cosine": vectors.cosine(x, y), "mismatch": vectors.shape_mismatch(x, y)})


def zscore(df: DataFrame, group: Sequence[str], columns: Sequence[str], *, least: int = 2) -> DataFrame:
    """<c>_mean, <c>_stddev and <c>_z within groups of more than `least` rows; null in smaller ones.  Rows without a group are one.

    Group statistics are aggregated and joined back, so a large group is no
    single task.
    """
    stats = df.groupBy(*group).agg(F.count("*").alias("__n"), *[f(c).alias(f"{c}_{n}") for c in columns for f, n in ((F.avg, "mean"), (F.stddev_samp, "stddev"))])
    big = F.col("__n") > least
    out = join_back(df, stats, group)
    return out.withColumns(
        {f"{c}_z": F.when(big, F.try_divide(F.col(c) - F.col(f"{c}_mean"), F.col(f"{c}_stddev"))) for c in columns}
        | {f"{c}_{n}": F.when(big, F.col(f"{c}_{n}")) for c in columns for n in ("mean", "stddev")}
    ).drop("__n")


def median_over_days(df: DataFrame, keys: Sequence[str], columns: Sequence[str], *, accuracy: int = 10000, exact: bool = False) -> DataFrame:
    """median_<c> of each key: the lower median, up to `accuracy` unless exact."""
    if exact:
        return df.groupBy(*keys).agg(*[F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{c}`)").alias(f"median_{c}") for c in columns])
    return df.groupBy(*keys).agg(*[F.percentile_approx(c, 0.5, accuracy).alias(f"median_{c}") for c in columns])


def exact_median(df: DataFrame, keys: Sequence[str], column: str, out: str = "median") -> DataFrame:
    return df.groupBy(*keys).agg(F.median(column).alias(out))


def attach_medians(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Medians joined back to the rows they come from."""
    return join_back(df, median_over_days(df, keys, columns), keys)


def peer_score(df: DataFrame, group: Sequence[str], member: str, *, curve: str = "curve") -> DataFrame:
    """Each member's curve against its peers': distance, cosine, mismatch and their z-scores."""
    compared = compare_curves(peer_curve(df, group, member, curve=curve), curve=curve)
    return zscore(compared, group, ["distance", "mismatch"])


"""Alerts on reconciled tables; each is a DataFrame that is empty when all is well."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ISSUE_BOTH, ISSUE_SOURCE, ISSUE_SOURCE_QUALITY, ISSUE_TARGET, ISSUE_TARGET_QUALITY, NO_ISSUE
from .dedupe import find_duplicates


def alert_mismatch(df: DataFrame, *, percent: float, start: str | None = None, shortfall: float = 5.0) -> DataFrame:
    """Days whose difference exceeds the percentage, or that fall short of their company's best day.

    df: a reconciled table by usage date.  The best day is taken over all days of
    the run, those before `start` included.  Where a value equals its threshold,
    no issue is named.
    """
    best = df.groupBy("opco").agg(F.max("tgt_cnt").alias("best_cnt"))
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    short = F.coalesce(F.try_divide((F.col("best_cnt") - F.col("src_cnt")).cast("double"), F.col("best_cnt").cast("double")) * 100, F.lit(0.0))
    found = df.join(best, "opco").withColumn("pct_short", short)
    found = found.where(F.col("usage_dt") > start) if start else found
    parts = [zero(c) for c in ("pct_cnt", "pct_meters", "pct_usage")]
    over = (parts[0] > percent) | (parts[1] > percent) | (parts[2] > percent)
    under = (parts[0] < percent) & (parts[1] < percent) & (parts[2] < percent)
    issue = F.when(over & (F.col("pct_short") > shortfall), ISSUE_BOTH).when(under & (F.col("pct_short") > shortfall), ISSUE_SOURCE).when(over & (F.col("pct_short") < shortfall), ISSUE_TARGET)
    return found.where(over | (F.col("pct_short") > shortfall)).withColumn("issue", issue)


def alert_quality(shares: DataFrame, *, percent: float) -> DataFrame:
    """Days on which the target's share of estimated intervals exceeds the percentage; shares: see audit.quality_share."""
    def share(side: str, kind: str) -> Column:
        return F.try_divide(F.col(f"{side}_{kind}").cast("double"), F.col(f"{side}_total").cast("double")) * 100

    named = shares.withColumns({f"{s}_{k}_pct": share(s, k) for s in ("src", "tgt") for k in ("regular", "estimate")} | {f"diff_{k}": F.col(f"src_{k}") - F.col(f"tgt_{k}") for k in ("regular", "estimate", "total")})
    issue = F.when(F.col("src_estimate_pct") > percent, ISSUE_SOURCE_QUALITY.format(percent)).when(F.col("tgt_estimate_pct") > percent, ISSUE_TARGET_QUALITY.format(percent)).otherwise(NO_ISSUE)
    return named.withColumn("issue", issue).where(F.col("tgt_estimate_pct") > percent)


def alert_duplicates(df: DataFrame, keys: Sequence[str], *, where: Column | None = None) -> DataFrame:
    """Reading keys that occur more than once."""
    return find_duplicates(df.where(where) if where is not None else df, keys)


def reprocess_list(alerts: DataFrame, *, exact: bool = False) -> DataFrame:
    """Company and day of every target issue; exact: not those that are issues of both sides."""
    hit = F.col("issue") == ISSUE_TARGET if exact else F.col("issue").contains(ISSUE_TARGET)
    return alerts.where(hit).select("opco", "usage_dt").distinct()

"""The whole audit: aggregates of both sides, their reconciliation, and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import REGULAR_SOURCE_CODES, REGULAR_TARGET_CODES
from ..operators import alerts, audit, rollup
from ..operators.dedupe import union_all
from ..session import stage
from .ledger import Ledger, Run


def source_aggregates(df: DataFrame, actual: Sequence[str] = REGULAR_SOURCE_CODES, *, expected: int = 96, before: str | None = None, registers: Sequence[str] | None = None) -> DataFrame:
    """All five, from one pass over the measurements.  registers: those that are audited, such as constants.AUDITED_REGISTERS; all if not given."""
    days = stage(audit.source_days(df, expected=expected, before=before), "source-days")
    return stage(audit.source_all(days, actual, expected=expected, registers=registers, tasks=audit.tasks_for(days)), "source-aggregates")  # a few rows, which are read for each kind


def target_aggregates(df: DataFrame, actual: Sequence[str] = REGULAR_TARGET_CODES, *, quarantined: DataFrame | None = None, days: DataFrame | None = None) -> DataFrame:
    """All five, from one pass over the readings and one over the quarantined ones."""
    each = stage(audit.target_days(df, days=days, quarantined=quarantined), "target-days")
    return stage(audit.target_all(each, actual, **audit.deal_for(each)), "target-aggregates")


def source_rollup(df: DataFrame, actual: Sequence[str] = REGULAR_SOURCE_CODES, *, expected: int = 96, before: str | None = None, registers: Sequence[str] | None = None) -> DataFrame:
    """source_aggregates with the meters of four of the five counted in bitmaps (operators.rollup); nothing is staged but the meters' numbers."""
    days = audit.source_days(df, expected=expected, before=before)
    meters = days.groupBy(*audit.DAY, "condition").agg(F.sum("cnt").alias("n"), F.sum("total").alias("use"))
    counts = audit.source_interval_count(days, actual, expected=expected, registers=registers)
    return union_all([rollup.rolled_up(meters, actual, numbers=rollup.numbered(df, "serial"), registers=registers), counts])


def target_rollup(df: DataFrame, actual: Sequence[str] = REGULAR_TARGET_CODES, *, quarantined: DataFrame | None = None, days: DataFrame | None = None, one_count: bool = False) -> DataFrame:
    """target_aggregates likewise; one_count: meters of both arms counted once."""
    each = audit.target_days(df, days=days, quarantined=quarantined)
    serials = df.select("serial") if quarantined is None else union_all([df.select("serial"), quarantined.select("serial")])
    rolled = rollup.rolled_up(each, actual, numbers=rollup.numbered(serials, "serial"), one_count=one_count, all_arms=False, tasks=audit.tasks_for(serials))
    return union_all([rolled, audit.target_interval_count(each)])


PARTITION = ("opco", "usage_dt")
MOST_LISTED = 100_000


def listed_only(df: DataFrame, listed: DataFrame, *, known: int | None = None) -> DataFrame:
    """Rows of df in the listed partitions (company and day).

    The list is sent to all tasks if it has at most MOST_LISTED rows (known: their number), so a
    partitioned table is pruned by it before it is read; a longer list is most of the table anyway.
    """
    named = listed.select(*PARTITION).where("opco IS NOT NULL AND usage_dt > ''").distinct()  # a filter, without which Spark sees nothing to prune by
    count = named.count() if known is None else known
    return df.join(F.broadcast(named) if count <= MOST_LISTED else named, list(PARTITION), "left_semi")


def audit_target(run: Run, readings: DataFrame, days_path: str, aggregates_path: str, actual: Sequence[str] = REGULAR_TARGET_CODES, *, quarantined: DataFrame | None = None) -> None:
    """Stage in a run the target's days and the five aggregates of them, both by company and day."""
    run.write(audit.target_days(readings, quarantined=quarantined), days_path, PARTITION)
    days = run.staged(days_path)
    run.write(audit.target_all(days, actual, **audit.deal_for(days)), aggregates_path, PARTITION)


def re_audit(ledger: Ledger, owner: str, listed: DataFrame, readings: DataFrame, days_path: str, aggregates_path: str, actual: Sequence[str] = REGULAR_TARGET_CODES, *, quarantined: DataFrame | None = None) -> int:
    """Audit the listed companies and days again (alerts.reprocess_list), and replace only them in both tables; how many there were.

    All keys of the aggregates hold company and day, so the rest of the tables stays as a full audit would make
    it.  A listed partition without readings is not replaced: nothing says that its rows are to go.
    """
    wanted = stage(listed.select(*PARTITION).distinct(), "listed")
    n = wanted.count()
    if n:
        run = ledger.begin(owner)
        try:
            some = listed_only(quarantined, wanted, known=n) if quarantined is not None else None
            audit_target(run, listed_only(readings, wanted, known=n), days_path, aggregates_path, actual, quarantined=some)
        except Exception:
            run.abort()
            raise
        run.commit(re_audited=n)
    return n


def reconcile_all(source: DataFrame, target: DataFrame, *, expected: int = 96, run: str | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Interval counts by bucket and both sides' keys; all else from the source's keys.

    The kind of an aggregate is a literal in each, so either half of the plan keeps
    only its own aggregates, and none is computed twice.
    """
    is_count = F.col("aggr_type") == "INTERVAL_COUNT"
    one = {"run": run, "exclude": exclude}
    counts = audit.reconcile_bucketed(source.where(is_count), target.where(is_count), expected=expected, **one)
    return union_all([audit.reconcile(source.where(~is_count), target.where(~is_count), target_only=False, **one), counts])


def audit_alerts(reconciled: DataFrame, *, percent: float, start: str | None = None) -> dict[str, DataFrame]:
    by_date = reconciled.where("aggr_type = 'USAGE_DATE'")
    mismatch = alerts.alert_mismatch(by_date, percent=percent, start=start)
    quality = reconciled.where("aggr_type = 'DATA_QUALITY'")
    quality = quality.where(F.col("usage_dt") > start) if start else quality
    return {"mismatch": mismatch, "reprocess": alerts.reprocess_list(mismatch), "quality": alerts.alert_quality(audit.quality_share(quality), percent=percent)}

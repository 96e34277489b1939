"""Reconciliation of two systems' readings.

Both sides are brought to one aggregate shape, `KEYS` plus interval count, usage
and meters, and then compared.

Source measurements: opco, usage_type, usage_dt, register, condition, serial,
cnt, total, average, config_id, component_id.
Target readings: opco, usage_type, usage_dt, register, quality, serial, uom,
value.  Quarantined readings: the same with a flag instead of usage_type.
Totals are summed as double.

Every aggregate is a roll-up of one table for each side, of a meter's day by
register, condition and configuration: `source_days` and `target_days`; `source_all` and
`target_all` make all five of it, dealt by meter and day once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import ENERGY_REGISTER_PREFIX, ENERGY_UNITS, INTERVALS_A_DAY, REGULAR_SOURCE_CODES, REGULAR_TARGET_CODES
from ..functions import conform as fn
from .dedupe import union_all
from .joins import dense_rank

#: Reconciled tables that hold several runs have run_dt before these.
KEYS = ["opco", "aggr_type", "usage_dt", "usage_type", "register", "quality", "intervals"]
MEASURES = ["cnt", "usage", "meters"]


def _shape(df: DataFrame, aggr_type: str, keys: Sequence[str], cnt: Column, usage: Column, meters: Column) -> DataFrame:
    """Aggregated to KEYS; the keys that an aggregate doesn't use are empty."""
    grouped = df.groupBy(*keys).agg(cnt.cast("long").alias("cnt"), usage.cast("double").alias("usage"), meters.cast("long").alias("meters"))
    columns = [F.lit(aggr_type).alias(k) if k == "aggr_type" else F.col(k) if k in keys else F.lit("").alias(k) for k in KEYS]
    return grouped.select(*columns, *MEASURES)


def _source(df: DataFrame, before: str | None, registers: Sequence[str] | None) -> DataFrame:
    df = df.where(F.col("usage_type") == "interval")
    df = df.where(F.col("usage_dt") < before) if before else df
    return df.where(F.col("register").isin(list(registers))) if registers else df


def _sums(df: DataFrame, aggr_type: str, keys: Sequence[str]) -> DataFrame:
    return _shape(df, aggr_type, keys, F.sum("cnt"), F.sum(F.col("total").cast("double")), F.count_distinct("serial"))


def source_by_date(df: DataFrame, *, before: str | None = None, registers: Sequence[str] | None = None) -> DataFrame:
    return _sums(_source(df, before, registers), "USAGE_DATE", ["opco", "usage_dt", "usage_type"])


def source_by_uom(df: DataFrame, *, before: str | None = None) -> DataFrame:
    return _sums(_source(df, before, None), "UOM", ["opco", "usage_dt", "usage_type", "register"])


def source_by_quality(df: DataFrame, actual: Sequence[str] = REGULAR_SOURCE_CODES, *, before: str | None = None, registers: Sequence[str] | None = None) -> DataFrame:
    """actual: the condition codes of a regular reading."""
    classed = _source(df, before, registers).withColumn("quality", fn.quality_class(F.col("condition"), actual))
    return _sums(classed, "DATA_QUALITY", ["opco", "usage_dt", "usage_type", "register", "quality"])


def source_zero_usage(df: DataFrame, *, before: str | None = None, registers: Sequence[str] | None = None) -> DataFrame:
    """Meters whose total is 0; they are counted by meter and condition."""
    keys = ["opco", "usage_dt", "usage_type", "register", "condition"]
    each = _source(df, before, registers).groupBy(*keys, "serial").agg(F.sum("cnt").alias("cnt"), F.sum(F.col("total").cast("double")).alias("total")).where("total = 0")
    return _shape(each.withColumnRenamed("condition", "quality"), "ZERO_USAGE", ["opco", "usage_dt", "usage_type", "register", "quality"], F.sum("cnt"), F.sum("total"), F.count("serial"))


def rank_configs(df: DataFrame) -> DataFrame:
    """row_num: 1 for the rows of the latest configuration of a meter, day and register."""
    return dense_rank(df, ["opco", "usage_type", "usage_dt", "serial", "register"], [F.desc("config_id"), F.desc("component_id")], "row_num")


DAY = ["opco", "usage_type", "usage_dt", "register", "serial"]
#: Rows dealt by these need no other shuffle to be grouped by any keys that hold them.
DEALT = ["opco", "usage_dt", "serial"]


def _kind(aggr_type: str, register: Column | None = None, quality: Column | None = None) -> Column:
    given = {"aggr_type": F.lit(aggr_type), "register": register, "quality": quality}
    return F.struct(*[(F.lit("") if c is None else c).alias(k) for k, c in given.items()])


#: A task's hash tables have a few rows for each of these, so memory does not grow with the table.
ROWS_A_TASK = 200_000


def tasks_for(df: DataFrame) -> int:
    """Tasks to deal rows over; staged ones are counted by their files."""
    return max(1, -(-df.count() // ROWS_A_TASK))


#: A company's day is cut by meters into pieces of a task's rows over this, so that tasks get about as many rows each.
PIECES_A_TASK = 16


def deal_for(days: DataFrame) -> dict[str, int]:
    """tasks to deal rows over, and the pieces of a company's day; staged ones are counted by their files."""
    total, most = days.groupBy("opco", "usage_dt").count().agg(F.sum("count"), F.max("count")).first()
    return {"tasks": max(1, -(-(total or 0) // ROWS_A_TASK)), "pieces": max(1, -(-(most or 0) * PIECES_A_TASK // ROWS_A_TASK))}


def _dealt(days: DataFrame, tasks: int | None) -> DataFrame:
    return days.repartition(tasks, *DEALT) if tasks else days.repartition(*DEALT)


def _by_meter(days: DataFrame, kinds: Sequence[Column], sums: Sequence[str], tasks: int | None) -> DataFrame:
    """A meter's sums in each kind of aggregate, after one shuffle for all of them; kinds: null where a row has no part."""
    held = [c for c in ("arm", "opco", "usage_type", "usage_dt", "serial") if c in days.columns]
    rows = _dealt(days, tasks).select(*held, *sums, F.explode(F.array_compact(F.array(*kinds))).alias("k")).select(*held, *sums, "k.*")
    return rows.groupBy(*held, "aggr_type", "register", "quality").agg(*[F.sum(c).alias(c) for c in sums])


def _of_meters(each: DataFrame, intervals: Column, cnt: str, usage: str) -> DataFrame:
    """Meters' sums (_by_meter) added up; a meter has one row for each arm, so a count of rows counts meters."""
    found = each.withColumn("intervals", intervals).groupBy(*KEYS).agg(F.sum(cnt).cast("long").alias("cnt"), F.sum(usage).cast("double").alias("usage"), F.count("serial").cast("long").alias("meters"))
    return found.select(*KEYS, *MEASURES)


def source_days(df: DataFrame, *, expected: int = INTERVALS_A_DAY, before: str | None = None) -> DataFrame:
    """Measurements summed by a meter's day, register, condition and configuration.

    cnt and total are sums over all; of these, n_full, full_total (complete days)
    and n_other, other_cnt, other_total (the others).
    """
    full = F.col("cnt") == expected
    other = F.col("cnt") != expected
    total = F.col("total").cast("double")
    parts = [F.count_if(full).alias("n_full"), F.sum(F.when(full, total)).alias("full_total"), F.count_if(other).alias("n_other"), F.sum(F.when(other, F.col("cnt"))).alias("other_cnt"), F.sum(F.when(other, total)).alias("other_total")]
    return _source(df, before, None).groupBy(*DAY, "condition", "config_id", "component_id").agg(F.sum("cnt").alias("cnt"), F.sum(total).alias("total"), *parts)


def source_interval_count(df: DataFrame, actual: Sequence[str] = REGULAR_SOURCE_CODES, *, expected: int = INTERVALS_A_DAY, before: str | None = None, registers: Sequence[str] | None = None, tasks: int | None = None) -> DataFrame:
    """By intervals in a meter's day: complete actual days, complete estimated ones of meters without, and the latest configuration's others, summed.

    df: measurements, or source_days of them.
    """
    days = _source(df, before, registers)
    days = _dealt(days if "n_full" in df.columns else source_days(days, expected=expected), tasks)
    real = fn.quality_class(F.col("condition"), actual, "A", "E") == "A"
    configs = days.groupBy(*DAY, "config_id", "component_id").agg(
        F.sum(F.when(real, F.col("n_full")).otherwise(0)).alias("n_real"), F.sum(F.when(real, F.col("full_total"))).alias("real_total"),
        F.sum(F.when(real, 0).otherwise(F.col("n_full"))).alias("n_est"), F.sum(F.when(~real, F.col("full_total"))).alias("est_total"),
        F.sum("n_other").alias("n_other"), F.sum("other_cnt").alias("other_cnt"), F.sum("other_total").alias("other_total"),
    )
    latest = F.max_by(F.struct("n_est", "est_total", "n_other", "other_cnt", "other_total"), F.struct("config_id", "component_id"))
    meters = configs.groupBy(*DAY).agg(F.sum("n_real").alias("n_real"), F.sum("real_total").alias("real_total"), latest.alias("l"))
    # A complete day counts by its actual measurements, or else by the latest configuration's estimated ones.
    n_full = F.when(F.col("n_real") > 0, F.col("n_real")).otherwise(F.col("l.n_est"))
    full_total = F.when(F.col("n_real") > 0, F.col("real_total")).otherwise(F.col("l.est_total"))
    row = lambda n, cnt, total: F.when(n > 0, F.struct(cnt.cast("double").alias("cnt"), total.cast("double").alias("total"), F.when(n > 0, cnt).cast("int").cast("string").alias("intervals")))
    complete = row(n_full, n_full * expected, full_total).withField("intervals", F.lit(str(expected)))
    others = row(F.col("l.n_other"), F.col("l.other_cnt"), F.col("l.other_total"))
    each = meters.select(*DAY, F.explode(F.array_compact(F.array(complete, others))).alias("p")).select(*DAY, "p.*")
    return _sums(each, "INTERVAL_COUNT", ["opco", "usage_dt", "usage_type", "register", "intervals"])


def source_all(days: DataFrame, actual: Sequence[str] = REGULAR_SOURCE_CODES, *, expected: int = INTERVALS_A_DAY, registers: Sequence[str] | None = None, tasks: int | None = None) -> DataFrame:
    """The five aggregates of source_days: four in one pass, and source_interval_count.  tasks: how many meters are dealt over; left to Spark if not given."""
    counts = F.col("register").isin(list(registers)) if registers else F.lit(True)
    register, condition = F.col("register"), F.col("condition")
    kinds = [F.when(counts, _kind("USAGE_DATE")), _kind("UOM", register), F.when(counts, _kind("DATA_QUALITY", register, fn.quality_class(condition, actual))), F.when(counts, _kind("ZERO_USAGE", register, condition))]
    each = _by_meter(days, kinds, ["cnt", "total"], tasks).where("aggr_type <> 'ZERO_USAGE' OR total = 0")
    return union_all([_of_meters(each, F.lit(""), "cnt", "total"), source_interval_count(days, actual, expected=expected, registers=registers, tasks=tasks)])


def target_days(df: DataFrame, *, days: DataFrame | None = None, quarantined: DataFrame | None = None) -> DataFrame:
    """Readings of both arms summed by a meter's day, register and condition: n, and use (the usage that counts); arm 0: readings, 1: quarantined ones.

    days: usage_dt of the audit; their number decides how they are joined.
    """
    keys = ["arm", "opco", "usage_type", "usage_dt", "register", "condition", "serial"]
    within = lambda d: d.join(days.select("usage_dt").distinct(), "usage_dt", "left_semi") if days is not None else d
    shaped = lambda d: d if "condition" in d.columns else d.withColumnRenamed("quality", "condition")
    arms = [shaped(within(df)).withColumns({"arm": F.lit(0), "use": fn.usage_where(F.col("value").cast("double"), F.col("uom").isin(*ENERGY_UNITS))})]
    if quarantined is not None:
        energy = F.col("register").startswith(ENERGY_REGISTER_PREFIX)
        arms.append(shaped(within(quarantined)).withColumns({"arm": F.lit(1), "usage_type": fn.usage_type(F.col("flag")), "use": fn.usage_where(F.col("value").try_cast("int").cast("double"), energy)}))
    return union_all([a.select(*keys, "use") for a in arms]).groupBy(*keys).agg(F.count("*").alias("n"), F.sum("use").alias("use"))


def _days_of(df: DataFrame, days: DataFrame | None = None, quarantined: DataFrame | None = None) -> DataFrame:
    """df as target_days, if it isn't yet."""
    return df if "arm" in df.columns else target_days(df, days=days, quarantined=quarantined)


def _target_sums(df: DataFrame, aggr_type: str, keys: Sequence[str], one_count: bool) -> DataFrame:
    """Distinct meters are counted for each arm and added; one_count: over both arms together."""
    each = df.groupBy(*keys, *([] if one_count else ["arm"]), "serial").agg(F.sum("n").alias("n"), F.sum("use").alias("use"))
    return _shape(each, aggr_type, keys, F.sum("n"), F.sum("use"), F.count("serial"))


def target_all(days: DataFrame, actual: Sequence[str] = REGULAR_TARGET_CODES, *, tasks: int | None = None, pieces: int = 1) -> DataFrame:
    """The five aggregates of target_days, which are read twice and dealt once.

    A meter's day has one row for each register, with its sums by quality beside each other; the first of
    them counts the meter by date. These rows are summed where they lie, and only the sums become rows of each kind.
    Zero usage needs no meters, as target_days has a row for each condition.

    tasks and pieces as by deal_for; tasks are left to Spark if not given.
    """
    piece, meter = ["opco", "usage_dt", "piece"], ["serial", "usage_dt", "opco", "piece", "arm", "usage_type"]
    quality, n, use, known, first_arm = fn.quality_class(F.col("condition"), actual), F.col("n"), F.col("use"), F.col("serial").isNotNull(), F.col("arm") == 0
    classes = ["REGULAR", "ESTIMATE"]
    by_class = [a for q in classes for a in (F.count_if(quality == q).alias(f"{q}_rows"), F.sum(F.when(quality == q, n)).alias(f"{q}_n"), F.sum(F.when(quality == q, use)).alias(f"{q}_use"))]
    dealt = days.withColumn("piece", F.pmod(F.xxhash64("serial"), F.lit(pieces))).repartition(*([tasks] if tasks else []), *piece)
    registers = dealt.groupBy(*meter, "register").agg(F.sum(n).alias("n"), F.sum(use).alias("use"), *by_class).withColumn("nth", F.row_number().over(Window.partitionBy(*meter).orderBy("register")))
    sums_by_class = [a for q in classes for a in (F.sum(f"{q}_rows").alias(f"{q}_rows"), F.sum(f"{q}_n").alias(f"{q}_n"), F.sum(f"{q}_use").alias(f"{q}_use"), F.count_if(known & (F.col(f"{q}_rows") > 0)).alias(f"{q}_meters"))]
    sums = registers.groupBy(*piece, "arm", "usage_type", "register", "n").agg(F.sum(n).alias("cnt"), F.sum(use).alias("usage"), F.count("serial").alias("meters"), F.count_if(known & (F.col("nth") == 1)).alias("meters_by_date"), *sums_by_class)

    def kind(aggr_type: str, cnt: str = "cnt", usage: str = "usage", meters: str = "meters", **keys: Column) -> Column:
        given = {"aggr_type": F.lit(aggr_type), "register": F.col("register"), "quality": F.lit(""), "intervals": F.lit("")} | keys
        return F.struct(*[c.alias(k) for k, c in given.items()], *[F.col(c).alias(m) for m, c in zip(MEASURES, (cnt, usage, meters))])

    kinds = [kind("USAGE_DATE", meters="meters_by_date", register=F.lit("")), kind("UOM"), F.when(first_arm, kind("INTERVAL_COUNT", intervals=n.cast("string")))]
    kinds += [F.when(first_arm & (F.col(f"{q}_rows") > 0), kind("DATA_QUALITY", f"{q}_n", f"{q}_use", f"{q}_meters", quality=F.lit(q))) for q in classes]
    counted = sums.select("opco", "usage_dt", "usage_type", F.explode(F.array(*kinds)).alias("k")).where("k IS NOT NULL").select("opco", "usage_dt", "usage_type", "k.*")
    zero = days.where("use = 0").select("opco", F.lit("ZERO_USAGE").alias("aggr_type"), "usage_dt", "usage_type", "register", F.col("condition").alias("quality"), F.lit("").alias("intervals"), n.alias("cnt"), use.alias("usage"), known.cast("long").alias("meters"))
    found = union_all([counted.select(*KEYS, *MEASURES), zero]).groupBy(*KEYS).agg(F.sum("cnt").cast("long").alias("cnt"), F.sum("usage").cast("double").alias("usage"), F.sum("meters").cast("long").alias("meters"))
    return found.select(*KEYS, *MEASURES)


def target_by_date(df: DataFrame, *, days: DataFrame | None = None, quarantined: DataFrame | None = None, registers: Sequence[str] | None = None, one_count: bool = False) -> DataFrame:
    """This and the next four take readings, or target_days of them."""
    each = _days_of(df, days, quarantined)
    each = each.where(F.col("register").isin(list(registers))) if registers else each
    return _target_sums(each, "USAGE_DATE", ["opco", "usage_dt", "usage_type"], one_count)


def target_by_uom(df: DataFrame, *, days: DataFrame | None = None, quarantined: DataFrame | None = None, one_count: bool = False) -> DataFrame:
    return _target_sums(_days_of(df, days, quarantined), "UOM", ["opco", "usage_dt", "usage_type", "register"], one_count)


def target_by_quality(df: DataFrame, actual: Sequence[str] = REGULAR_TARGET_CODES, *, days: DataFrame | None = None) -> DataFrame:
    """Without quarantined readings; the target's codes of a regular reading may be fewer than the source's."""
    classed = _days_of(df, days).where("arm = 0").withColumn("quality", fn.quality_class(F.col("condition"), actual))
    return _target_sums(classed, "DATA_QUALITY", ["opco", "usage_dt", "usage_type", "register", "quality"], True)


def target_zero_usage(df: DataFrame, *, days: DataFrame | None = None, quarantined: DataFrame | None = None) -> DataFrame:
    zero = _days_of(df, days, quarantined).where("use = 0").withColumnRenamed("condition", "quality")
    return _shape(zero, "ZERO_USAGE", ["opco", "usage_dt", "usage_type", "register", "quality"], F.sum("n"), F.sum("use"), F.count("serial"))


def target_interval_count(df: DataFrame, *, days: DataFrame | None = None) -> DataFrame:
    """Meters by the number of their day's intervals."""
    keys = ["opco", "usage_dt", "usage_type", "register"]
    each = _days_of(df, days).where("arm = 0").groupBy(*keys, "serial").agg(F.sum("n").alias("cnt"), F.sum("use").alias("use")).withColumn("intervals", F.col("cnt").cast("string"))
    return _shape(each, "INTERVAL_COUNT", [*keys, "intervals"], F.sum("cnt"), F.sum("use"), F.count("serial"))


def _keys(*sides: DataFrame) -> list[str]:
    """KEYS, after run_dt where all sides have it."""
    return ["run_dt"] * all("run_dt" in df.columns for df in sides) + KEYS


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str] | None = None, *, target_only: bool = True, run: str | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """Both sides by key: counts, usage, meters, differences and percentages.

    keys: KEYS, and run_dt if both sides have it, unless given.  run: this run
    alone; exclude: days that are left out on both sides.  target_only: keys that
    only the target has are kept (full outer); without them the join starts from
    the source.
    """
    keys = keys or _keys(source, target)
    source, target = (d.where(F.col("run_dt") == run) if run else d for d in (source, target))
    source, target = (d.where(~F.col("usage_dt").isin(list(exclude))) if exclude else d for d in (source, target))
    s = source.select(*keys, *[F.col(m).alias(f"src_{m}") for m in MEASURES])
    t = target.select(*keys, *[F.col(m).alias(f"tgt_{m}") for m in MEASURES])
    both = s.join(t, list(keys), "full_outer" if target_only else "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return both.select(
        *keys,
        zero("src_cnt").alias("src_cnt"),
        zero("tgt_cnt").alias("tgt_cnt"),
        (zero("src_cnt") - zero("tgt_cnt")).alias("diff_cnt"),
        fn.percent_off(F.col("src_cnt"), F.col("tgt_cnt")).alias("pct_cnt"),
        zero("src_usage").cast("double").alias("src_usage"),
        zero("tgt_usage").cast("double").alias("tgt_usage"),
        (F.col("src_usage") - F.col("tgt_usage")).try_cast("decimal(9,2)").alias("diff_usage"),
        fn.percent_off(F.col("src_usage"), F.col("tgt_usage")).alias("pct_usage"),
        F.col("src_meters"),
        F.col("tgt_meters"),
        (F.col("src_meters") - F.col("tgt_meters")).alias("diff_meters"),
        fn.percent_off(F.col("src_meters"), zero("tgt_meters")).alias("pct_meters"),
    )


def bucketed(df: DataFrame, *, expected: int = INTERVALS_A_DAY) -> DataFrame:
    """Interval counts put into under, at and over the expected number, and summed."""
    return df.withColumn("intervals", fn.interval_bucket(F.col("intervals"), expected)).groupBy(*_keys(df)).agg(*[F.sum(m).alias(m) for m in MEASURES])


def reconcile_bucketed(source: DataFrame, target: DataFrame, *, expected: int = INTERVALS_A_DAY, run: str | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    return reconcile(bucketed(source, expected=expected), bucketed(target, expected=expected), run=run, exclude=exclude)


def quality_share(df: DataFrame, keys: Sequence[str] = ("opco", "usage_dt", "usage_type")) -> DataFrame:
    """Regular, estimated and all intervals of a reconciled table, on both sides."""
    def of(side: str, quality: str) -> Column:
        return F.sum(F.when(F.col("quality") == quality, F.col(f"{side}_cnt")).otherwise(0))

    parts = [of(s, q).alias(f"{s}_{n}") for s in ("src", "tgt") for q, n in (("REGULAR", "regular"), ("ESTIMATE", "estimate"))]
    return df.groupBy(*keys).agg(*parts, F.sum("src_cnt").alias("src_total"), F.sum("tgt_cnt").alias("tgt_total"))

"""Distinct meters that can be added up: bitmaps of meter numbers, rolled up to any grain.

A count of distinct meters can't be summed over days, registers or conditions, so each
aggregate would count from the readings again.  A bitmap can be united: meters are
numbered 1, 2, 3 and so on, the meters of the finest groups become bitmaps of 32,768
numbers, and coarser groups are the unions of finer ones.  Counts stay exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import conform as fn
from ..session import stage
from .audit import KEYS, MEASURES
from .dedupe import union_all


def numbered(df: DataFrame, column: str) -> DataFrame:
    """(column, number): its different values, null left out, numbered from 1 without gaps.

    Values are numbered within tasks; the driver adds up how many each task has.
    """
    values = stage(df.select(column).where(F.col(column).isNotNull()).distinct().withColumn("__id", F.monotonically_increasing_id()), "numbers")
    part = F.shiftright("__id", 33).cast("int")
    sizes = sorted((r["part"], r["count"]) for r in values.groupBy(part.alias("part")).count().collect())  # a row for each task
    bases, total = [], 1
    for p, n in sizes:
        bases.append((p, total))
        total += n
    known = df.sparkSession.createDataFrame(bases, "__part int, __base long")
    within = F.col("__id") - F.shiftleft(part.cast("long"), 33)
    return values.withColumn("__part", part).join(F.broadcast(known), "__part").select(column, (F.col("__base") + within).alias("number"))


def rolled_up(days: DataFrame, actual: Sequence[str], *, numbers: DataFrame | None = None, registers: Sequence[str] | None = None, one_count: bool = False, all_arms: bool = True, tasks: int | None = None) -> DataFrame:
    """Usage by date, by register, by quality and zero usage, in audit.KEYS and MEASURES, from one pass over meters' days.

    days: arm, opco, usage_type, usage_dt, register, condition, serial, n, use, one row for each.  numbers: the
    meters' (numbered), if they can be had without the days.
    registers: those that count, but for the aggregate by register.  Meters of two arms are
    counted in each; one_count: once.  tasks: how many rows are dealt over; left to Spark if not given.  all_arms: the aggregate by quality has all arms, and not just arm 0.
    """
    days = days.withColumn("arm", F.lit(0)) if "arm" not in days.columns else days
    coded = days.join(numbered(days, "serial") if numbers is None else numbers, "serial", "left")
    counts = F.col("register").isin(list(registers)) if registers else F.lit(True)
    finest = ["arm", "opco", "usage_dt", "usage_type", "register", "quality", "condition", "counts"]
    zero = F.col("use") == 0
    base = (
        coded.withColumns({"quality": fn.quality_class(F.col("condition"), actual), "counts": counts, "bucket": F.bitmap_bucket_number("number")})
        .repartition(*([tasks] if tasks else []), "opco", "usage_dt", "bucket")  # rows are dealt, so that each bitmap is made by one task alone
        .groupBy(*finest, "bucket")
        .agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"),
            F.sum("n").alias("n"),
            F.sum("use").alias("use"),
            F.count_if(zero & F.col("serial").isNotNull()).alias("zero_meters"),
            F.count_if(zero).alias("zero_rows"),
            F.sum(F.when(zero, F.col("n"))).alias("zero_n"),
        )
    )
    united = base.withColumn("side", F.lit(0) if one_count else F.col("arm"))
    date = ["side", "opco", "usage_dt", "usage_type", "counts", "bucket"]
    first = ~F.lit(all_arms) & (F.col("arm") > 0)  # rows that the aggregate by quality leaves out
    united = united.withColumn("quality", F.when(~first, F.col("quality")))
    sets = united.groupingSets([date, [*date, "register"], [*date, "register", "quality"]], *date, "register", "quality").agg(F.grouping_id().alias("level"), F.bitmap_or_agg("bits").alias("bits"), F.sum("n").alias("n"), F.sum("use").alias("use"))
    levels = sorted({3, 1, 0}, reverse=True)  # bits of the columns that are left out: register and quality, quality, none
    kinds = dict(zip(levels, ("USAGE_DATE", "UOM", "DATA_QUALITY"), strict=True))
    named = sets.withColumn("aggr_type", F.element_at(F.create_map(*(F.lit(x) for kv in kinds.items() for x in kv)), F.col("level").cast("int")))
    named = named.where((F.col("aggr_type") == "UOM") | F.col("counts")).where((F.col("aggr_type") != "DATA_QUALITY") | F.col("quality").isNotNull())
    keys = {"register": F.when(F.col("aggr_type") == "USAGE_DATE", "").otherwise(F.col("register")), "quality": F.when(F.col("aggr_type") == "DATA_QUALITY", F.col("quality")).otherwise(""), "intervals": F.lit("")}
    counted = named.withColumns(keys).groupBy(*KEYS).agg(F.sum("n").cast("long").alias("cnt"), F.sum("use").cast("double").alias("usage"), F.sum(F.bitmap_count("bits")).cast("long").alias("meters"))
    nothing = base.where("counts AND zero_rows > 0").withColumns({"quality": F.col("condition"), "aggr_type": F.lit("ZERO_USAGE"), "intervals": F.lit("")})
    nothing = nothing.groupBy(*KEYS).agg(F.sum("zero_n").cast("long").alias("cnt"), F.lit(0.0).alias("usage"), F.sum("zero_meters").cast("long").alias("meters"))
    return union_all([counted.select(*KEYS, *MEASURES), nothing.select(*KEYS, *MEASURES)])

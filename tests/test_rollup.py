import random

from pyspark.sql import functions as F

from wattloom.operators import audit, rollup
from wattloom.operators.dedupe import union_all

KEYS = "arm int, opco string, usage_type string, usage_dt string, register string, condition string, serial string, n long, use double"


def _days(spark, meters=40, rows=700):
    random.seed(3)
    seen = {(random.randrange(2), random.choice("AB"), "interval", random.choice(["d1", "d2"]), random.choice(["E-KWH", "KVAR"]), random.choice("123"), random.choice([*(f"s{k}" for k in range(meters)), None])) for _ in range(rows)}
    return spark.createDataFrame([(*k, random.randrange(1, 9), random.choice([0.0, 0.0, 1.5])) for k in sorted(seen, key=str)], KEYS)


def _sorted(df):
    return sorted(tuple(str(x) for x in r) for r in df.collect())


def test_rolled_up_meters_equal_distinct_counts(spark):
    days = _days(spark)
    for one in (False, True):
        plain = [audit.target_by_date(days, registers=["E-KWH"], one_count=one), audit.target_by_uom(days, one_count=one), audit.target_by_quality(days.where("register = 'E-KWH'"), ["1"]), audit.target_zero_usage(days.where("register = 'E-KWH'"))]
        assert _sorted(rollup.rolled_up(days, ["1"], registers=["E-KWH"], one_count=one, all_arms=False)) == _sorted(union_all(plain))


def test_meters_beyond_one_bitmap(spark):
    wide = spark.range(70_000).select(F.lit("A").alias("opco"), F.lit("interval").alias("usage_type"), F.lit("d").alias("usage_dt"), F.concat(F.lit("R"), (F.col("id") % 2).cast("string")).alias("register"), F.lit("1").alias("condition"), F.concat(F.lit("m"), (F.col("id") % 50_000).cast("string")).alias("serial"), F.lit(1).alias("n"), F.lit(2.0).alias("use"))
    found = {(r["aggr_type"], r["register"]): (r["cnt"], r["meters"]) for r in rollup.rolled_up(wide.groupBy(*wide.columns[:6]).agg(F.sum("n").alias("n"), F.sum("use").alias("use")), ["1"]).collect()}
    assert found == {("USAGE_DATE", ""): (70_000, 50_000), ("UOM", "R0"): (35_000, 25_000), ("UOM", "R1"): (35_000, 25_000), ("DATA_QUALITY", "R0"): (35_000, 25_000), ("DATA_QUALITY", "R1"): (35_000, 25_000)}


def test_numbers_have_no_gaps(spark):
    frame = spark.createDataFrame([(f"s{k % 37}",) for k in range(200)] + [(None,)], "serial string").repartition(7)
    assert sorted(r["number"] for r in rollup.numbered(frame, "serial").collect()) == list(range(1, 38))
    assert rollup.numbered(frame.limit(0), "serial").count() == 0


def test_no_days(spark):
    assert rollup.rolled_up(_days(spark).limit(0), ["1"]).count() == 0


def test_all_aggregates_share_one_shuffle_of_meters(spark):
    """Each aggregate shuffled all meters' days for itself, and two of them several times over (Expand)."""
    days = _days(spark)
    apart = [audit.target_by_date(days), audit.target_by_uom(days), audit.target_by_quality(days, ["1"]), audit.target_zero_usage(days), audit.target_interval_count(days)]
    found = audit.target_all(days, ["1"])
    assert _sorted(found) == _sorted(union_all(apart))
    plan = found._jdf.queryExecution().sparkPlan().toString() + found._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("hashpartitioning(") == 2 and "Expand" not in plan
    assert "Expand" not in audit.target_by_date(days)._jdf.queryExecution().executedPlan().toString()


def test_each_bitmap_is_made_by_one_task(spark):
    """Rows were grouped where they lay, so each task made nearly all bitmaps and sent them on."""
    plan = rollup.rolled_up(_days(spark), ["1"], all_arms=False)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    lines = [x for x in plan.splitlines() if "bitmap_construct_agg" in x or "Exchange hashpartitioning" in x]
    made = [k for k, x in enumerate(lines) if "bitmap_construct_agg" in x]
    assert made and made == list(range(made[0], made[0] + len(made)))  # no shuffle between partial and final
    assert "usage_dt" in lines[made[-1] + 1] and "REPARTITION_BY_COL" in lines[made[-1] + 1]


def _made(df, kind):
    """Rows that a kind of node made in a plan that has run."""
    from py4j.java_gateway import is_instance_of

    sql, found = "org.apache.spark.sql.execution", []

    def walk(node):
        for name, inner in (("adaptive.AdaptiveSparkPlanExec", "executedPlan"), ("adaptive.QueryStageExec", "plan")):
            if is_instance_of(df.sparkSession.sparkContext._gateway, node, f"{sql}.{name}"):
                return walk(getattr(node, inner)())
        if node.nodeName() == kind:
            found.append(node.metrics().apply("numOutputRows").value())
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_meters_are_summed_before_kinds_are_made(spark):
    """Each meter's day became a row of every kind, up to five of them, and was grouped again by meter."""
    meters = [(arm, "A", "interval", "d1", register, condition, f"s{k}", 1, 0.0 if k % 2 else 1.5) for k in range(500) for arm, register, condition in ((0, "E-KWH", "1"), (0, "E-KWH", "2"), (0, "KVAR", "1"), (1, "KVAR", "1"))]
    days = spark.createDataFrame(meters, KEYS)
    found = audit.target_all(days, ["1"])
    apart = [audit.target_by_date(days), audit.target_by_uom(days), audit.target_by_quality(days, ["1"]), audit.target_zero_usage(days), audit.target_interval_count(days)]
    assert _sorted(found) == _sorted(union_all(apart))
    assert 0 < _made(found, "Generate") <= 30


def test_pieces_change_nothing(spark, monkeypatch):
    days = _days(spark, rows=1500)
    whole = _sorted(audit.target_all(days, ["1"]))
    monkeypatch.setattr(audit, "ROWS_A_TASK", 100)
    deal = audit.deal_for(days)
    most = max(r["count"] for r in days.groupBy("opco", "usage_dt").count().collect())
    assert deal == {"tasks": -(-days.count() // 100), "pieces": -(-most * audit.PIECES_A_TASK // 100)} and deal["pieces"] > 16
    assert _sorted(audit.target_all(days, ["1"], **deal)) == whole
    assert audit.deal_for(days.limit(0)) == {"tasks": 1, "pieces": 1} and audit.target_all(days.limit(0), ["1"]).count() == 0

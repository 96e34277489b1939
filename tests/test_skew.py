import pytest
from pyspark.sql import functions as F

from wattloom.operators import dedupe, joins, peers
from wattloom.sources import readers

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "12",
}


@pytest.fixture
def hot(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    rows = spark.range(60_000).select(F.col("id"), F.when(F.col("id") % 10 > 0, "hot").when(F.col("id") % 20 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), (F.col("id") % 500).cast("string"))).alias("g"), (F.col("id") * 7919 % 1000).cast("double").alias("v"))
    yield rows.repartition(12)
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


OPERATORS = {
    "group_size": lambda d: peers.group_size(d, ["g"]),
    "distinct_group_size": lambda d: peers.distinct_group_size(d, ["g"], "v"),
    "zscore": lambda d: peers.zscore(d, ["g"], ["v"]),
    "attach_medians": lambda d: peers.attach_medians(d, ["g"], ["v"]),
    "arg_min": lambda d: joins.arg_min(d, ["g"], "v"),
    "latest_snapshot": lambda d: readers.latest_snapshot(d, "v", ["g"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_a_hot_group_is_split_and_null_groups_stay(hot, name):
    found = OPERATORS[name](hot)
    rows = found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    # These two join on the value as well, so a hot group is dealt over all tasks from the start.
    wanted = "hashpartitioning(knownfloatingpointnormalized(normalizenanandzero(v" if name in ("arg_min", "latest_snapshot") else "skew=true"
    assert wanted in plan.split("Initial Plan")[0], plan
    nulls = [r for r in rows if r["g"] is None]
    if name in ("arg_min", "latest_snapshot"):
        at = [r["v"] for r in hot.where("g IS NULL").collect()]
        assert nulls and {r["v"] for r in nulls} == {min(at) if name == "arg_min" else max(at)}
    else:
        assert len(rows) == 60_000 and len(nulls) == 3_000
    if name == "group_size":
        assert {r["group_size"] for r in nulls} == {3_000} and {r["group_size"] for r in rows if r["g"] == "hot"} == {54_000}


def test_equally_late_rows_do_not_depend_on_their_order(spark):
    rows = [(1, 5, "a", None, [1]), (1, 5, "b", {"x": 1}, [2]), (1, 5, "b", {"x": 1}, [1]), (2, None, "c", None, None)]
    kept = []
    for order in (rows, rows[::-1]):
        frame = spark.createDataFrame(order, "k int, t int, s string, m map<string,int>, l array<int>").coalesce(1)
        kept.append(sorted((r["k"], r["s"], r["l"]) for r in dedupe.dedupe_latest(frame, ["k"], "t").collect()))
    assert kept[0] == kept[1] == [(1, "b", [2]), (2, "c", None)]


def test_struct_keys_of_several_columns(spark):
    frame = spark.createDataFrame([(None, 1, 1.0), (None, 1, 3.0), ("a", None, 5.0), ("a", None, 5.0), ("a", 2, 9.0)], "g string, h int, v double")
    sizes = {(r["g"], r["h"]): r["group_size"] for r in peers.group_size(frame, ["g", "h"]).collect()}
    assert sizes == {(None, 1): 2, ("a", None): 2, ("a", 2): 1}


def test_a_large_partition_is_written_by_several_tasks(spark, tmp_path):
    from wattloom.sources import files, writers

    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        rows = spark.range(200_000).select("id", F.when(F.col("id") % 50 > 0, "big").otherwise(F.concat(F.lit("p"), (F.col("id") % 200).cast("string"))).alias("day.of"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        writers.write_partitioned(rows.withColumnRenamed("day.of", "day"), f"{tmp_path}/t", ["day"], sort=["id"])
        count = lambda p: len([n for n in files.Folder(spark, f"{tmp_path}/t").names(p) if n.endswith(".parquet")])
        assert count("day=big") == 4 and count("day=p0") == 1  # at most one for each task that read the rows
        assert spark.read.parquet(f"{tmp_path}/t").count() == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes") if old is None else spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)


def test_no_task_ranks_all_pairs_of_a_full_cube(spark, monkeypatch):
    """Queries that crowd in one cube are dealt over tasks, by the pairs that they make."""
    from wattloom.operators import ties

    monkeypatch.setattr(ties, "MOST_PAIRS", 2_000, raising=False)
    q = spark.range(900).selectExpr("id AS q_id", "1.5 + id / 10000 AS q_x", "1.5 AS q_y", "1.5 AS q_z")
    c = spark.range(20).selectExpr("id AS c_id", "1.2 + id / 100 AS c_x", "1.5 AS c_y", "1.5 AS c_z").unionByName(spark.range(20, 24).selectExpr("id AS c_id", "2.5 AS c_x", "1.5 AS c_y", "id / 12 AS c_z"))
    found = ties.near_pairs(q, c, 1.0)
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 900 * 24 == found.select("q_id", "c_id").distinct().count()
    assert max(sizes) <= 8_000

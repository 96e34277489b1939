import pytest
from pyspark.sql import functions as F

from wattloom.operators import audit
from wattloom.plans import audit as plan
from wattloom.plans.ledger import Ledger
from wattloom.session import stage
from wattloom.sources import files, writers

SCHEMA = "opco string, usage_type string, usage_dt string, register string, quality string, serial string, uom string, value double"


def _rows(day, opco, n, value):
    return [(opco, "interval", day, "E-KWH", str(501000 + k % 2), f"s{k}", "KWH", value * (k % 3)) for k in range(n)]


def _tables(spark, root):
    return [sorted((tuple(str(x) for x in r) for r in spark.read.parquet(f"{root}/{n}").select(*c).collect())) for n, c in (("days", ["opco", "usage_dt", "serial", "n", "use"]), ("aggregates", [*audit.KEYS, "cnt", "usage", "meters"]))]


@pytest.fixture
def stored(spark, tmp_path):
    root = str(tmp_path)
    rows = [r for d in ("2024-01-01", "2024-01-02", "2024-01-03") for o in ("A", "B") for r in _rows(d, o, 6, 1.5)]
    writers.write_partitioned(spark.createDataFrame(rows, SCHEMA), f"{root}/readings", plan.PARTITION)
    book = Ledger(spark, f"{root}/ledger")
    run = book.begin("audit")
    plan.audit_target(run, spark.read.schema(SCHEMA).parquet(f"{root}/readings"), f"{root}/days", f"{root}/aggregates")
    run.commit()
    return root, rows, book


def test_only_listed_partitions_are_read_and_replaced(spark, stored):
    root, rows, book = stored
    fixed = _rows("2024-01-02", "B", 9, 2.5)
    writers.write_partitioned(spark.createDataFrame(fixed, SCHEMA), f"{root}/readings", plan.PARTITION)
    # What is not listed can't be read any more; a re-audit has no need to.
    for part in ("opco=A/usage_dt=2024-01-01", "opco=B/usage_dt=2024-01-03"):
        folder = files.Folder(spark, f"{root}/readings/{part}")
        for name in folder.names():
            folder.delete(name)
        folder.create("part-0.parquet", "this is no Parquet file")
    listed = spark.createDataFrame([("B", "2024-01-02"), ("B", "2024-01-02"), ("C", "2024-01-01")], "opco string, usage_dt string")
    before = files.Folder(spark, f"{root}/days").names("opco=A/usage_dt=2024-01-02")
    assert plan.re_audit(book, "audit", listed, spark.read.schema(SCHEMA).parquet(f"{root}/readings"), f"{root}/days", f"{root}/aggregates") == 2
    assert files.Folder(spark, f"{root}/days").names("opco=A/usage_dt=2024-01-02") == before
    whole = [r for r in rows if (r[0], r[2]) != ("B", "2024-01-02")] + fixed
    full = Ledger(spark, f"{root}/full-ledger").begin("full")
    plan.audit_target(full, spark.createDataFrame(whole, SCHEMA), f"{root}/full/days", f"{root}/full/aggregates")
    full.commit()
    assert _tables(spark, root) == _tables(spark, f"{root}/full")


def test_the_plan_prunes_partitions(spark, stored):
    root, _, _ = stored
    listed = stage(spark.createDataFrame([("B", "2024-01-02")], "opco string, usage_dt string"), "listed")
    found = plan.listed_only(spark.read.schema(SCHEMA).parquet(f"{root}/readings"), listed)
    assert found.count() == 6 and {(r["opco"], r["usage_dt"]) for r in found.collect()} == {("B", "2024-01-02")}
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("dynamicpruningexpression") == 2  # by company and by day


def test_nothing_listed_changes_nothing(spark, stored):
    root, _, book = stored
    before = _tables(spark, root)
    listed = spark.createDataFrame([], "opco string, usage_dt string")
    assert plan.re_audit(book, "audit", listed, spark.read.schema(SCHEMA).parquet(f"{root}/readings"), f"{root}/days", f"{root}/aggregates") == 0
    assert _tables(spark, root) == before and len(book.history()) == 1


def test_a_long_list_is_joined(spark, stored, monkeypatch):
    root, _, _ = stored
    monkeypatch.setattr(plan, "MOST_LISTED", 1)
    listed = spark.createDataFrame([("B", "2024-01-02"), ("A", "2024-01-03")], "opco string, usage_dt string")
    found = plan.listed_only(spark.read.schema(SCHEMA).parquet(f"{root}/readings"), listed)
    assert found.groupBy("opco").agg(F.count("*").alias("n")).count() == 2

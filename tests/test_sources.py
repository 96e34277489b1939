import importlib
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.operators import rules
from wattloom.sources import readers, writers
from wattloom.streaming import events as stream

SCHEMA = "k string, v double, opco string, day string"


def _rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
def test_overwriting_replaces_only_what_is_written(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1.0, "X", "d1"), ("b", 2.0, "X", "d2"), ("c", 3.0, "Y", "d1")], SCHEMA)
    writers.write_partitioned(df, path, ["opco", "day"], sort=["k"], fmt=fmt, blooms={"k": 100}, spread=2)
    writers.write_partitioned(spark.createDataFrame([("n", 9.0, "X", "d1")], SCHEMA), path, ["opco", "day"], fmt=fmt)
    back = readers.read_partitions(spark, path, SCHEMA, fmt=fmt)
    assert _rows(back, "k", "opco", "day") == [("b", "X", "d2"), ("c", "Y", "d1"), ("n", "X", "d1")]
    pruned = readers.read_days(spark, path, SCHEMA, "d1", "d1", day="day", fmt=fmt, opco="X")
    assert _rows(pruned, "k") == [("n",)]
    assert "PartitionFilters: [isnotnull(day" in pruned._jdf.queryExecution().toString()
    writers.write_partitioned(spark.createDataFrame([("z", 9.0, "X", "d1")], SCHEMA), path, ["opco", "day"], fmt=fmt, mode="append")
    assert back.sparkSession.read.schema(SCHEMA).format(fmt).load(path).count() == 4


def test_files_hold_at_most_so_many_records(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_partitioned(spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit("X").alias("opco")), path, ["opco"], max_records=10)
    assert len(list((tmp_path / "t" / "opco=X").glob("*.parquet"))) == 10


def test_delimited_text(spark, tmp_path):
    for k, sep in enumerate("\t~,"):
        (tmp_path / f"f{k}").write_text(f"a{sep}1\nb{sep}x\n")
        got = readers.read_delimited(spark, [str(tmp_path / f"f{k}")], "s string, n int", sep=sep)
        assert _rows(got, "s", "n") == [("a", 1), ("b", None)]


def test_new_runs_and_path_columns(spark, tmp_path):
    root = str(tmp_path / "runs")
    for run in ("20240101_000000", "20240102_000000"):
        spark.createDataFrame([(run[-8:], 1.0)], "k string, v double").write.orc(f"{root}/run_dt={run}")
    schema = "k string, v double, run_dt string"
    every, mark = readers.read_new_runs(spark, root, schema)
    assert every.count() == 2 and mark == "20240102_000000"
    some, mark = readers.read_new_runs(spark, root, schema, mark="20240101_000000")
    assert some.count() == 1 and mark == "20240102_000000"
    none, mark = readers.read_new_runs(spark, root, schema, mark="20240102_000000")
    assert none.count() == 0 and mark == "20240102_000000"
    files = spark.read.schema("k string, v double").orc(f"{root}/run_dt=20240101_000000")
    assert readers.with_path_partitions(files, ["run_dt", "opco"]).select("run_dt", "opco").first() == ("20240101_000000", None)
    assert readers.existing_paths(spark, [root, root + "-not"]) == [root]


def test_jdbc_options():
    plain = readers.jdbc_options("jdbc:x", "select 1")
    assert plain == {"url": "jdbc:x", "dbtable": "(select 1) q", "fetchsize": "10000"}
    split = readers.jdbc_options("jdbc:x", "select 1", column="id", bounds=(0, 9), partitions=3, properties={"user": "u"})
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "3" and split["user"] == "u"


def test_dates_and_snapshots(spark):
    assert [str(r["day"]) for r in readers.date_range(spark, "2024-02-28", "2024-03-01").collect()] == ["2024-02-28", "2024-02-29", "2024-03-01"]
    df = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("b", "2"), ("c", "1")], "k string, d string")
    assert _rows(readers.latest_snapshot(df, "d"), "k") == [("a",), ("b",)]
    assert _rows(readers.latest_snapshot(df, "d", ["k"]), "k", "d") == [("a", "2"), ("b", "2"), ("c", "1")]
    assert readers.dates_text(readers.distinct_dates(df, "d", "2"), "d").first()["dates"] == "'1'"
    assert readers.latest_snapshot(df.limit(0), "d").count() == 0


def test_tables_views_and_reports(spark, tmp_path):
    spark.sql("drop table if exists audit_runs")
    spark.createDataFrame([("a", 1, "20230101")], "k string, n int, run_dt string").write.partitionBy("run_dt").saveAsTable("audit_runs")
    spark.conf.set("hive.exec.dynamic.partition.mode", "nonstrict")
    writers.insert_into(spark.createDataFrame([(2, "b")], "n long, k string"), "audit_runs", run_dt="20230201")
    assert _rows(spark.table("audit_runs"), "k", "n", "run_dt") == [("a", 1, "20230101"), ("b", 2, "20230201")]
    assert writers.drop_old_partitions(spark, "audit_runs", "run_dt", "20230115") == ["20230101"]
    assert spark.table("audit_runs").count() == 2
    writers.drop_old_partitions(spark, "audit_runs", "run_dt", "20230115", dry_run=False)
    writers.sync_partitions(spark, "audit_runs")
    assert [r[0] for r in spark.sql("show partitions audit_runs").collect()] == ["run_dt=20230201"]
    spark.sql("drop table audit_runs")
    x = spark.createDataFrame([("X", 1), ("Y", 2)], "opco string, n int")
    assert _rows(writers.union_view({"X": x, "Y": x}, "all_opcos"), "opco", "n") == [("X", 1), ("Y", 2)] and spark.table("all_opcos").count() == 2
    runs = spark.createDataFrame([("r1", "T", "X", "d", "g"), ("r2", "T", "X", "d", "g")], "run_dt string, aggr_type string, opco string, usage_dt string, register string")
    assert writers.current_run_view(runs, "r2", "now").count() == 1
    writers.write_report(x, str(tmp_path / "report"))
    (file,) = (tmp_path / "report").glob("*.csv")
    assert file.read_text().splitlines()[0] == "opco,n"
    writers.write_plain(x, str(tmp_path / "plain"))
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 2


def test_stream_merges_late_and_repeated_events(spark, tmp_path):
    schema = "id long, event_type string, reason string, day string, t int"
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    table = rules.load_rules(spark.createDataFrame([("1", "t", "1", "x", "Y", 1, "p", 1, "A", "", "Y")], rules.RULES))

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        q = stream.classify_stream(spark, source, T._parse_datatype_string(schema), table, out, str(tmp_path / "ck"), key=["id"], order="t", partition=["day"])
        q.awaitTermination()

    arrive([(1, "t", "ax", "d1", 1), (2, "t", "bx", "d2", 1)])
    arrive([(1, "t", "cx", "d1", 2), (3, "t", "late x", "d2", 1), (4, "u", "x", "d1", 1)])
    got = spark.read.schema(schema + ", regex_id string, curated_reason string").parquet(out)
    assert _rows(got, "id", "curated_reason", "day") == [(1, "cY", "d1"), (2, "bY", "d2"), (3, "late Y", "d2")]
    batch = spark.createDataFrame([("a", "2024-01-01 00:05:00"), ("a", "2024-01-01 00:20:00")], "k string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    assert stream.windowed_counts(batch, ts="ts", keys=["k"]).count() == 2


def test_entry_works_without_the_optional_subpackage(monkeypatch):
    for name in [m for m in sys.modules if m.startswith(("wattloom.llm", "__spark_entry__", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "wattloom.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert "peer_score" in names and "pipeline" not in names and not any(n.startswith("op") and n[2].isdigit() for n in names)
    assert set(entry.oracle_sql()) <= names
    monkeypatch.delitem(sys.modules, "__spark_entry__")

from wattloom import run_queries
from wattloom.operators import rules
from wattloom.streaming import events as event_stream

SCHEMA = "serial string, event_type string, ts timestamp, reason string, day string"
RULES = [("1", "a", "1", "low", "L", 1, "p1", 1, "A", "", "t"), ("2", "a", "1", "(", "", 1, "p2", 1, "A", "", "t")]


def _run(spark, root, files, **options):
    flow = event_stream.classify_latest_stream(spark, f"{root}/source", SCHEMA, spark.createDataFrame(RULES, rules.RULES), root, key=["serial", "event_type"], order="ts", partition=["day"], late=3600.0, files=1, **options)
    flow.awaitTermination()


def _file(spark, root, rows):
    frame = spark.createDataFrame(rows, "serial string, event_type string, ts string, reason string, day string")
    frame.selectExpr("serial", "event_type", "CAST(ts AS timestamp) AS ts", "reason", "day").coalesce(1).write.mode("append").parquet(f"{root}/source")


def _rows(spark, root, name, *columns):
    return sorted((tuple(r) for r in spark.read.parquet(f"{root}/{name}").select(*columns).collect()), key=str)


def test_latest_events_are_kept_over_runs(spark, tmp_path):
    root = str(tmp_path)
    _file(spark, root, [("s1", "a", "2024-01-01 10:00:00", "low 1", "d"), ("s1", "a", "2024-01-01 09:00:00", "low 0", "d"), ("s2", "b", "2024-01-01 10:00:00", "x", "d"), ("s3", "a", None, "low 9", "d")])
    _run(spark, root, 1)
    want = [("s1", "a", "L 1", None), ("s2", "b", None, "new event type|b"), ("s3", "a", "L 9", None)]
    columns = ("serial", "event_type", "curated_reason", "error")
    assert _rows(spark, root, "events", *columns) == want
    # older than the latest but in time; older by more than an hour; newer and without a match; the first time of a key
    _file(spark, root, [("s1", "a", "2024-01-01 09:30:00", "low 2", "d"), ("s2", "b", "2024-01-01 08:00:00", "y", "d")])
    _file(spark, root, [("s1", "a", "2024-01-01 11:00:00", "high", "d"), ("s3", "a", "2024-01-01 11:00:00", "low 3", "d")])
    _run(spark, root, 1)
    assert _rows(spark, root, "events", *columns) == [("s1", "a", None, "no_regex_applied"), ("s2", "b", None, "new event type|b"), ("s3", "a", "L 3", None)]
    assert _rows(spark, root, "errors", "serial", "reason", "error", "source_mode") == [("s1", "high", "no_regex_applied", "incr"), ("s2", "x", "new event type|b", "incr"), ("s2", "y", "late", "incr")]
    assert {r[0] for r in _rows(spark, root, "wrong_rules", "search")} == {"("}


def test_stream_equals_one_batch_whatever_the_order_of_files(spark, tmp_path):
    rows = [(f"s{k % 7}", "a", f"2024-01-0{1 + k * 5 % 9} 0{k % 10}:00:00", f"{'low' if k % 3 else 'odd'} {k}", "d") for k in range(60)]
    for name, order in (("one", [rows]), ("many", [rows[40:], rows[:20], rows[20:40]])):
        for part in order:
            _file(spark, f"{tmp_path}/{name}", part)
        _run(spark, f"{tmp_path}/{name}", 1)
    columns = ("serial", "event_type", "ts", "curated_reason", "error")
    one, many = (_rows(spark, f"{tmp_path}/{n}", "events", *columns) for n in ("one", "many"))
    assert one == many and len(one) == 7


def test_late_events_of_the_query_are_older_than_a_day(spark):
    root = run_queries.latest_stream(spark, "/root/testdata/sf0.001")
    late = spark.read.parquet(f"{root}/errors").where("error = 'late'")
    latest = spark.read.parquet(f"{root}/events").selectExpr("user_id", "event_type", "ts AS latest")
    assert late.count() and not late.join(latest, ["user_id", "event_type"]).where("ts >= latest - INTERVAL 1 DAY").count()


def test_python_is_called_for_groups_and_not_for_each_key(spark, tmp_path):
    """The state has a row for each group at most, though keys are many; null keys and those of equal text stay apart."""
    root, many = str(tmp_path), event_stream.GROUPS * 3
    keys = [(f"s{k}", "a") for k in range(many)] + [(None, "a"), ("", "a"), ("null", "a")]
    _file(spark, root, [(s, t, "2024-01-01 10:00:00", f"low {s}", "d") for s, t in keys])
    _run(spark, root, 1)
    _file(spark, root, [(s, t, "2024-01-01 08:00:00" if k % 2 else "2024-01-01 11:00:00", f"low new {s}", "d") for k, (s, t) in enumerate(keys)])
    _run(spark, root, 1)
    state = spark.read.format("statestore").load(f"{root}/checkpoint")
    assert 0 < state.count() <= event_stream.GROUPS
    found = _rows(spark, root, "events", "serial", "curated_reason")
    assert len(found) == len(keys) and dict(found) == {s: None if s is None else f"L {s}" if k % 2 else f"L new {s}" for k, (s, _) in enumerate(keys)}  # no rule is tried on a null key
    late = [s for s, e in _rows(spark, root, "errors", "serial", "error") if e == "late"]
    assert sorted(late) == sorted(s for k, (s, _) in enumerate(keys) if k % 2)

import datetime
import itertools

import pytest
from pyspark.sql import functions as F

from wattloom import run_queries
from wattloom.plans import ledger
from wattloom.sources import files, readers

SCHEMA = "user_id long, event_type string, day string, ts long, event_id long, run_dt string"


class Crash(Exception):
    pass


def _write(spark, root, *runs):
    for run, rows in runs:
        spark.createDataFrame([(*r, run) for r in rows], SCHEMA).write.partitionBy("run_dt").mode("append").parquet(f"{root}/source")


def _load(spark, root, owner="hourly", **options):
    book = ledger.Ledger(spark, f"{root}/ledger")
    read = lambda mark: readers.read_new_runs(spark, f"{root}/source", SCHEMA, mark=mark, fmt="parquet")
    return ledger.load_new_runs(book, owner, read, run_queries.merge_events(f"{root}/events", f"{root}/summary"), **options)


def _tables(spark, root):
    events = sorted(tuple(r) for r in spark.read.parquet(f"{root}/events").selectExpr("user_id", "event_type", "CAST(day AS STRING)", "ts", "event_id").collect())
    summary = sorted(tuple(r) for r in spark.read.parquet(f"{root}/summary").selectExpr("CAST(day AS STRING)", "event_type", "n").collect())
    return events, summary


FIRST = ("20240101_000000", [(1, "a", "d1", 1, 10), (1, "a", "d1", 2, 11), (2, "b", "d2", 1, 12)])
SECOND = ("20240201_000000", [(1, "a", "d1", 3, 20), (3, "b", "d1", 1, 21), (9, "a", "d3", 1, 22)])
WANT = ([(1, "a", "d1", 3, 20), (2, "b", "d2", 1, 12), (3, "b", "d1", 1, 21), (9, "a", "d3", 1, 22)], [("d1", "a", 1), ("d1", "b", 1), ("d2", "b", 1), ("d3", "a", 1)])


def test_a_crash_at_any_step_changes_nothing(spark, tmp_path, monkeypatch):
    """Each call that changes a file is the last one once; a rerun under the same name must end with the same tables."""
    at = itertools.count()
    limit = [None]

    def failing(f):
        def run(*args, **kw):
            if limit[0] is not None and next(at) == limit[0]:
                raise Crash
            return f(*args, **kw)

        return run

    for name in ("create", "move", "delete"):
        monkeypatch.setattr(files.Folder, name, failing(getattr(files.Folder, name)))
    monkeypatch.setattr(ledger.Run, "abort", lambda self: None)  # a process that died does not tidy up
    crashed = 0
    for step in range(40):
        root = f"{tmp_path}/{step}"
        limit[0] = None
        _write(spark, root, FIRST)
        assert _load(spark, root)
        before = _tables(spark, root)
        _write(spark, root, SECOND)
        at, limit[0] = itertools.count(), step
        try:
            _load(spark, root)
        except Crash:
            crashed += 1
            limit[0] = None
            book = ledger.Ledger(spark, f"{root}/ledger")
            outcome = book.history()[-1][2]
            if outcome == "open":
                assert _tables(spark, root) == before and book.state()["mark"] == FIRST[0]
            with pytest.raises(ledger.Busy):
                book.begin("another") if outcome != "done" else _busy()
            _load(spark, root)
        limit[0] = None
        assert _tables(spark, root) == WANT and ledger.Ledger(spark, f"{root}/ledger").state() == {"mark": SECOND[0]}
        assert not [n for n in files.Folder(spark, f"{root}/ledger").names() if n.startswith("staged") and step < 2]
        if not crashed or step >= crashed:
            break
    assert crashed >= 8


def _busy():
    raise ledger.Busy


def test_runs_one_after_the_other(spark, tmp_path):
    root = str(tmp_path)
    _write(spark, root, FIRST)
    assert _load(spark, root) and not _load(spark, root)
    book = ledger.Ledger(spark, f"{root}/ledger")
    assert [h[1:] for h in book.history()] == [("hourly", "done"), ("hourly", "aborted")]
    _write(spark, root, SECOND)
    assert _load(spark, root) and _tables(spark, root) == WANT


def test_a_writer_that_was_taken_over_is_refused(spark, tmp_path):
    root = str(tmp_path)
    book = ledger.Ledger(spark, f"{root}/ledger")
    slow = book.begin("one")
    slow.write(spark.createDataFrame([("x", 1)], "day string, n int"), f"{root}/t", ["day"])
    with pytest.raises(ledger.Busy):
        book.begin("two")
    fast = book.begin("two", take_over=True)
    fast.write(spark.createDataFrame([("x", 2)], "day string, n int"), f"{root}/t", ["day"])
    with pytest.raises(ledger.Busy):
        slow.commit(mark="1")
    fast.commit(mark="2")
    assert [r["n"] for r in spark.read.parquet(f"{root}/t").collect()] == [2] and book.state() == {"mark": "2"}
    assert not files.Folder(spark, f"{root}/ledger").exists("staged-000000000001")


def test_a_failed_step_leaves_tables_and_mark(spark, tmp_path):
    root = str(tmp_path)
    _write(spark, root, FIRST)
    _load(spark, root)
    before = _tables(spark, root)
    _write(spark, root, SECOND)

    def steps(run, rows):
        run_queries.merge_events(f"{root}/events", f"{root}/summary")(run, rows)
        raise Crash

    book = ledger.Ledger(spark, f"{root}/ledger")
    with pytest.raises(Crash):
        ledger.load_new_runs(book, "hourly", lambda mark: readers.read_new_runs(spark, f"{root}/source", SCHEMA, mark=mark, fmt="parquet"), steps)
    assert _tables(spark, root) == before and book.state() == {"mark": FIRST[0]} and book.history()[-1][2] == "aborted"


def test_windows_advance_with_the_ledger(spark, tmp_path):
    book = ledger.Ledger(spark, f"{tmp_path}/ledger")
    seen = []
    days = lambda run, a, b: seen.append((str(a), str(b)))
    for today in (datetime.date(2024, 3, 10), datetime.date(2024, 3, 10), datetime.date(2024, 3, 20)):
        ledger.load_window(book, "daily", today, 5, days, early_if_ahead=False)
    assert seen == [("2024-02-29", "2024-03-05"), ("2024-03-05", "2024-03-10")]
    assert book.state()["window_end"] == "2024-03-10"


def test_runs_that_were_not_read_are_kept(spark, tmp_path):
    root = str(tmp_path)
    _write(spark, root, FIRST, SECOND, ("20240301_000000", FIRST[1]))
    _load(spark, root)
    _write(spark, root, ("20240302_000000", FIRST[1]))
    book = ledger.Ledger(spark, f"{root}/ledger")
    drop = lambda **kw: ledger.drop_old_runs(spark, f"{root}/source", ledger=book, **kw)
    assert drop(before="20240215") == ["run_dt=20240101_000000", "run_dt=20240201_000000"]
    left = lambda: [n for n in files.Folder(spark, f"{root}/source").names() if "=" in n]
    assert len(left()) == 4
    drop(before="20250101", dry_run=False)
    assert left() == ["run_dt=20240302_000000"]
    fresh = ledger.Ledger(spark, f"{root}/other")
    assert ledger.drop_old_runs(spark, f"{root}/source", ledger=fresh, before="20250101", dry_run=False) == []


@pytest.fixture
def database(spark):
    url = run_queries.derby(spark)
    rows = [(k, "FPO"[k % 3], k * 10.0, f"it's {k}") for k in range(-50, 150)] + [(None, "F", 1.0, "null key")]
    frame = spark.createDataFrame(rows, "id long, code string, price double, note string")
    options = {"url": url + ";create=true", "driver": run_queries.DERBY, "dbtable": "items", "createTableColumnTypes": "code VARCHAR(3), note VARCHAR(40)"}
    frame.write.format("jdbc").options(**options).save()
    yield url, rows
    run_queries.drop_derby(spark, url)


@pytest.mark.parametrize("even", [False, True])
def test_jdbc_filters_in_the_database_over_several_connections(spark, database, even):
    url, rows = database
    wanted = readers.company_query("items", ["id", "code", "price", "note"], column="code", codes=["F", "P"])
    found = readers.read_jdbc(spark, url=url, query=wanted, column="id", partitions=5, even=even, driver=run_queries.DERBY)
    assert found.rdd.getNumPartitions() == 5
    sizes = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 5 and (not even or max(sizes) <= 31)
    want = [r for r in rows if r[1] in "FP"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    narrow = found.where("price > 300").select("id")
    plan = narrow._jdf.queryExecution().executedPlan().toString()
    assert 'WHERE "code" IN (\'F\', \'P\')' in plan and "PushedFilters: [*IsNotNull(price), *GreaterThan(price,300.0)]" in plan and "note" not in plan.split("ReadSchema")[1]
    assert sorted(r["id"] for r in narrow.collect()) == sorted(r[0] for r in want if r[2] > 300)


def test_jdbc_without_codes_or_rows(spark, database):
    url, _ = database
    for codes in ([], ["none"], ["F' OR '1'='1"]):
        wanted = readers.company_query("items", ["id"], column="code", codes=codes)
        assert readers.read_jdbc(spark, url=url, query=wanted, column="id", driver=run_queries.DERBY).count() == 0

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from wattloom.functions import conform as fn
from wattloom.functions import geo, vectors
from wattloom.operators import alerts, audit, conform, dedupe, features, joins, model, peers, rules, series, ties
from wattloom.plans import audit as audit_plan
from wattloom.plans import events as event_plan
from wattloom.plans import ties as tie_plan
from wattloom.plans.windows import advance_window


def _rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_complete_days_count_rows_and_need_positive_values(spark):
    def day(serial, values):
        return [(serial, k, v) for k, v in enumerate(values)]

    data = day("full", [1.0] * 4) + day("short", [1.0] * 3) + day("long", [1.0] * 5) + day("null", [1.0, None, 1.0, 1.0]) + day("zero", [1.0, 0.0, 1.0, 1.0]) + [("twice", 0, 1.0)] * 2 + day("twice", [1.0, 1.0])
    df = spark.createDataFrame(data, "serial string, slot int, value double")
    assert _rows(series.complete_days(df, ["serial"], expected=4), "serial") == [("full",), ("twice",)]
    assert {r["serial"] for r in series.keep_complete(df, ["serial"], expected=4).collect()} == {"full", "twice"}
    curves = {r["serial"]: r["curve"] for r in series.pivot_day(df, ["serial"]).collect()}
    assert curves["full"] == [1.0] * 4 and len(curves["twice"]) == 2


@pytest.mark.parametrize("seed", [1, 2])
def test_peer_curve_equals_the_self_join(spark, seed):
    random.seed(seed)
    data = [(f"m{k}", f"g{k % 4}", [random.random() for _ in range(5)]) for k in range(14)] + [("m0", "g0", [random.random() for _ in range(5)]), ("alone", "g9", [1.0] * 5)]
    df = spark.createDataFrame(data, "serial string, pole string, curve array<double>")
    got = {(r["serial"], tuple(r["curve"])): r["peer_curve"] for r in peers.peer_curve(df, ["pole"], "serial").collect()}
    for serial, pole, curve in data:
        others = [c for s, p, c in data if p == pole and s != serial]
        if not others:
            assert (serial, tuple(curve)) not in got
        else:
            want = [sum(c[k] for c in others) / len(others) for k in range(5)]
            assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got[serial, tuple(curve)], want, strict=True))


def test_vectors(spark):
    random.seed(3)
    pairs = [([random.random() for _ in range(8)], [random.random() for _ in range(8)]) for _ in range(30)] + [([0.0] * 8, [1.0] * 8), ([3.0], [3.0])]
    df = spark.createDataFrame(pairs, "x array<double>, y array<double>")
    x, y = F.col("x"), F.col("y")
    found = df.select("x", "y", vectors.cosine(x, y).alias("c"), vectors.euclid_of_unit(x, y).alias("d"), vectors.shape_mismatch(x, y).alias("m"), vectors.normalize(x).alias("n"), vectors.euclid(x, y).alias("e")).collect()
    for r in found:
        a, b = r["x"], r["y"]
        na, nb = math.hypot(*a), math.hypot(*b)
        up = lambda v: [p >= q for p, q in zip(v, [0.0, *v[:-1]], strict=True)]
        assert r["m"] == sum(p != q for p, q in zip(up(a), up(b), strict=True))
        assert math.isclose(r["e"], math.dist(a, b))
        if not na:
            assert r["c"] is None and r["d"] is None and r["n"] == [None] * 8
            continue
        c = sum(p * q for p, q in zip(a, b, strict=True)) / na / nb
        assert math.isclose(r["c"], c) and math.isclose(r["d"], math.sqrt(max(0, 2 - 2 * c)), abs_tol=1e-7)
        assert math.isclose(r["d"], math.dist([p / na for p in a], [q / nb for q in b]), abs_tol=1e-7)


def test_zscore_of_small_and_constant_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 1.0), ("b", 5.0), ("c", 2.0), ("c", 2.0), ("c", 2.0)], "g string, v double")
    got = _rows(peers.zscore(df, ["g"], ["v"]), "g", "v", "v_z")
    assert got == sorted([("a", 1.0, -1.0), ("a", 2.0, 0.0), ("a", 3.0, 1.0), ("b", 1.0, None), ("b", 5.0, None)] + [("c", 2.0, None)] * 3, key=str)


def test_conforming_expressions(spark):
    df = spark.createDataFrame([("2022/11/16", "1850-05-05", "96", 1.0), ("2022-11-16", "2001-02-03", "95", 0.05), ("16.11.2022", None, "x", 0.7), (None, "1900-01-01", "97", 1e-5)], "a string, b string, n string, p double")
    got = df.select(fn.parse_date(F.col("a")).alias("a"), fn.floor_date(F.col("b").cast("date")).alias("b"), fn.interval_bucket(F.col("n")).alias("n"), fn.decile_digit(F.col("p")).alias("d"), fn.decile_digit(F.col("p"), True).alias("t")).collect()
    assert [tuple(r) for r in got] == [(date(2022, 11, 16), date(1900, 1, 1), "96", 9, 0), (date(2022, 11, 16), date(2001, 2, 3), "<96", 0, 0), (None, None, None, 7, 7), (None, date(1900, 1, 1), ">96", 0, 0)]
    assert spark.range(1).select(fn.decile_digit(F.lit(None).cast("double"))).first()[0] is None
    parts = spark.createDataFrame([("a-b-c",), ("a",), (None,)], "s string").select(fn.split_field(F.col("s"), 3).alias("x")).collect()
    assert [r["x"] for r in parts] == ["c", None, None]
    readings = spark.createDataFrame([("2024-01-01 00:15:00", 1.0), ("2024-01-01 23:45:00", None), ("2024-01-01 00:16:00", 1.0)], "ts string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    assert _rows(conform.with_slots(readings), "slot", "is_null") == [(1, 0), (95, 1)]


def test_unions_and_codes(spark):
    wide = spark.createDataFrame([(1, "x", 2.0)], "k int, s string, v double")
    narrow = spark.createDataFrame([("7",)], "k string")
    assert _rows(conform.conform_union(wide, narrow), "k", "s", "v") == [(1, "x", 2.0), (7, "", None)]
    codes = spark.createDataFrame([("Long Name", "LN")], "name string, code string")
    df = spark.createDataFrame([("Long Name",), ("other",), (None,)], "name string")
    assert _rows(conform.map_codes(df, codes, name="name"), "code") == [("LN",), ("XX",), ("XX",)]
    assert conform.codes_for(codes, ["ZZ"]).count() == 0


def test_dedupe_and_merge(spark):
    schema = "k string, day string, t int, v string"
    stored = spark.createDataFrame([("a", "d1", 1, "old"), ("b", "d1", 5, "stays"), ("c", "d2", 1, "untouched"), (None, "d1", 1, "null key")], schema)
    incoming = spark.createDataFrame([("a", "d1", 1, "same time"), ("b", "d1", 4, "older"), ("n", "d3", 1, "new"), ("n", "d3", 2, "newer")], schema)
    merged = dedupe.merge_incremental(stored, incoming, ["k"], order="t", partition=["day"])
    assert _rows(merged, "k", "v") == sorted([("a", "same time"), ("b", "stays"), (None, "null key"), ("n", "newer")], key=str)
    once = dedupe.dedupe_latest(merged, ["k"], "t")
    assert _rows(once, *schema_names(once)) == _rows(dedupe.dedupe_latest(once, ["k"], "t"), *schema_names(once))
    full = dedupe.merge_full(dedupe.union_all([stored, incoming]), ["k"], order="t", day="day", days="d1~d2", ties=["v"])
    assert _rows(full, "k", "v") == sorted([("a", "same time"), ("b", "stays"), ("c", "untouched"), (None, "null key")], key=str)
    assert _rows(dedupe.drop_all_duplicates(dedupe.union_all([stored, incoming]), ["k"]), "k") == sorted([("c",), (None,)], key=str)
    assert dedupe.drop_null_rows(stored, ["k"]).count() == 3


def schema_names(df):
    return df.columns


def _rules(spark):
    rows = [("2", "t", "1", "b+", "B", 1, "p2", 1, "A", "", " B "), ("10", "t", "1", "a", None, 1, "p1", 1, "A", "", "x"), ("3", "u", "1", "z*", "Z", 1, "p2", 1, "A", "", "Z")]
    return rules.load_rules(spark.createDataFrame(rows, rules.RULES))


def test_rules(spark):
    events = spark.createDataFrame([(1, "t", "bb"), (2, "t", "a^b~"), (3, "t", "c"), (4, "u", "none"), (5, "w", "b"), (6, "t", None)], "id long, event_type string, reason string")
    got = rules.classify(events, _rules(spark), key=["id"])
    assert _rows(got, "id", "regex_id", "curated_reason") == [(1, "2", "B"), (2, "10", "^b~")]  # "10" comes before "2" as text
    every = {r["id"]: [tuple(m) for m in r["matches"]] for r in rules.classify_all(events, _rules(spark), key=["id"]).collect()}
    assert every == {1: [("2", "B")], 2: [("10", "^b~"), ("2", "a^B~")]}
    assert _rows(rules.unmatched(events, _rules(spark), key=["id"]), "id") == [(3,), (4,), (6,)]
    assert _rows(rules.unknown_type(events, _rules(spark)), "id", "error") == [(5, "new event type|w")]
    assert _rows(rules.unknown_title(got, _rules(spark)), "id", "error") == [(2, "new report title|^b~")]
    titled = rules.with_titles(got, _rules(spark)).where("pivot_id is not null")
    ids = features.pivot_ids(_rules(spark))
    assert ids == ["p1", "p2"]
    hot = features.one_hot(titled, [*ids, "p1"])
    assert _rows(hot, "id", "p1", "p2") == [(1, 0, 1)]
    assert _rows(features.event_counts(hot, ["event_type"], ids), "event_type", "p1", "p2") == [("t", 0, 1)]
    good, bad = rules.split_patterns(spark.createDataFrame([("1", "t", "1", "(", "", 1, "p", 1, "A", "", "")], rules.RULES).unionByName(_rules(spark)))
    assert good.count() == 3 and [r["search"] for r in bad.collect()] == ["("]


def test_event_plan(spark):
    schema = "tracking_id string, serial string, event_time string, event_type string, reason string, opco string, event_dt string, update_dttm string"
    incoming = spark.createDataFrame([("1", "s1", "t1", "t", "bb", "X", "d1", "2"), ("2", "s2", "t1", "w", "bb", "X", "d1", "2")], schema)
    stored = spark.createDataFrame([("1", "s1", "t1", "t", "old", "X", "d1", "1"), ("9", "s9", "t1", "t", "a", "X", "d1", "1"), ("8", "s9", "t1", "t", "a", "X", "d0", "1")], schema)
    premises = spark.createDataFrame([("s1", "p1"), ("s9", "p1")], "serial string, pole string")
    out = event_plan.classify_events(incoming, stored, premises, _rules(spark))
    assert _rows(out["classified"], "tracking_id", "curated_reason", "pole", "group_size") == [("1", "B", "p1", 2), ("9", "", "p1", 2)]
    assert _rows(out["unknown_type"], "tracking_id") == [("2",)] and out["unmatched"].count() == 0
    table, errors = event_plan.feature_table(out["classified"], _rules(spark))
    assert _rows(table, "tracking_id", "p2") == [("1", 1)] and _rows(errors, "tracking_id") == [("9",)]


def _audit(spark, rows):
    return spark.createDataFrame([("A", "USAGE_DATE", d, "interval", "", "", "", c, float(u), m) for d, c, u, m in rows], "opco string, aggr_type string, usage_dt string, usage_type string, register string, quality string, intervals string, cnt long, usage double, meters long")


def test_reconcile(spark):
    same = _audit(spark, [("d1", 10, 5, 2), ("d2", 0, 0, 0)])
    assert all(r["diff_cnt"] == 0 and not r["pct_cnt"] for r in audit.reconcile(same, same).collect())
    found = {r["usage_dt"]: r for r in audit.reconcile(_audit(spark, [("d1", 100, 50, 10), ("d3", 7, 1, 1)]), _audit(spark, [("d1", 90, 50, 10), ("d2", 5, 5, 5)])).collect()}
    assert float(found["d1"]["pct_cnt"]) == 10 and found["d2"]["diff_cnt"] == -5 and found["d2"]["pct_cnt"] is None and found["d3"]["diff_cnt"] == 7
    assert float(found["d3"]["pct_meters"]) == 100 and found["d3"]["pct_cnt"] is None
    assert audit.reconcile(same, _audit(spark, [("d9", 1, 1, 1)]), target_only=False).count() == 2
    large = audit.reconcile(_audit(spark, [("d1", 1, 1e12, 1)]), _audit(spark, [("d1", 10**9, 0, 1)])).first()
    assert large["diff_usage"] is None and large["pct_cnt"] is None  # beyond their decimals


def test_alerts(spark):
    source = _audit(spark, [("d1", 100, 100, 10), ("d2", 100, 100, 10), ("d3", 50, 50, 5), ("d4", 50, 50, 5), ("d5", 100, 100, 10)])
    target = _audit(spark, [("d1", 100, 100, 10), ("d2", 90, 90, 9), ("d3", 50, 50, 5), ("d4", 40, 40, 4), ("d5", 97, 97, 10)])
    found = alerts.alert_mismatch(audit.reconcile(source, target), percent=3)
    assert _rows(found, "usage_dt", "issue") == [("d2", "TARGET ISSUE"), ("d3", "SOURCE ISSUE"), ("d4", "SOURCE AND TARGET ISSUE")]
    assert _rows(alerts.reprocess_list(found), "usage_dt") == [("d2",), ("d4",)]
    assert _rows(alerts.reprocess_list(found, exact=True), "usage_dt") == [("d2",)]
    shares = spark.createDataFrame([(102053270, 7451033, 109504303, 102053270, 7442477, 109495747)], "src_regular long, src_estimate long, src_total long, tgt_regular long, tgt_estimate long, tgt_total long")
    row = alerts.alert_quality(shares, percent=3).first()
    assert round(row["src_estimate_pct"], 4) == 6.8043 and round(row["tgt_estimate_pct"], 4) == 6.797 and row["diff_estimate"] == 8556
    assert row["issue"].startswith("SOURCE") and alerts.alert_quality(shares, percent=7).count() == 0


def test_interval_counts(spark):
    schema = "opco string, usage_type string, usage_dt string, register string, condition string, serial string, cnt double, total double, config_id long, component_id long"
    row = lambda serial, cnt, condition, config=1: ("A", "interval", "d", "R", condition, serial, float(cnt), 1.0, config, 1)
    df = spark.createDataFrame([row("m1", 96, "act"), row("m1", 96, "est", 2), row("m2", 96, "est", 2), row("m2", 96, "est", 1), row("m3", 50, "act"), row("m3", 40, "est"), row("m4", 97, "act")], schema)
    got = _rows(audit.source_interval_count(df, ["act"]), "intervals", "cnt", "meters")
    assert got == [("90", 90, 1), ("96", 192, 2), ("97", 97, 1)]
    buckets = _rows(audit.bucketed(audit.source_interval_count(df, ["act"])), "intervals", "cnt")
    assert buckets == [("96", 192), ("<96", 90), (">96", 97)]


def test_audit_plan_without_losses(spark):
    schema = "opco string, usage_type string, usage_dt string, register string, condition string, serial string, cnt double, total double, config_id long, component_id long"
    df = spark.createDataFrame([("A", "interval", "d", "R", "act", f"m{k}", 96.0, 1.0, 1, 1) for k in range(5)], schema)
    found = audit_plan.source_aggregates(df, ["act"])
    compared = audit_plan.reconcile_all(found, found)
    assert compared.where("diff_cnt <> 0").count() == 0 and compared.count() == 4
    assert all(a.count() == 0 for a in audit_plan.audit_alerts(compared, percent=2).values())


def test_target_counts_meters_of_both_arms(spark):
    readings = spark.createDataFrame([("A", "interval", "d", "R", "q", "m1", "KWH", 2.0), ("A", "interval", "d", "R", "q", "m1", "VOLT", 9.0)], "opco string, usage_type string, usage_dt string, register string, quality string, serial string, uom string, value double")
    held = spark.createDataFrame([("A", "D1IN", "d", "E-KWH", "q", "m1", "3"), ("A", "D1IN", "d", "X", "q", "m2", "x")], "opco string, flag string, usage_dt string, register string, quality string, serial string, value string")
    assert _rows(audit.target_by_date(readings, quarantined=held), "cnt", "usage", "meters") == [(4, 5.0, 3)]
    assert _rows(audit.target_by_date(readings, quarantined=held, one_count=True), "cnt", "usage", "meters") == [(4, 5.0, 2)]
    days = spark.createDataFrame([("e",)], "usage_dt string")
    assert audit.target_by_date(readings, days=days).count() == 0


def test_geography(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (52.2296756, 21.0122287, 52.406374, 16.9251681), (1.0, 2.0, 1.0, 2.0), (None, 1.0, 1.0, 1.0), (10.0, 179.9, 10.0, -179.9)], "a double, b double, c double, d double")
    got = df.select(geo.geodesic_ft(*map(F.col, "abcd")).alias("g"), geo.haversine_ft(*map(F.col, "abcd")).alias("h")).collect()
    assert math.isclose(got[0]["g"], 111319.491 * geo.FEET_PER_M, rel_tol=1e-7)
    assert math.isclose(got[1]["g"], 279352.901604 * geo.FEET_PER_M, rel_tol=1e-7)
    assert got[2]["g"] == 0 and got[3]["g"] is None and got[3]["h"] is None
    assert all(math.isclose(r["g"], r["h"], rel_tol=6e-3) for r in got[:2]) and got[4]["h"] < 80_000 and got[4]["g"] < 80_000


def test_k_nearest_against_brute_force(spark):
    random.seed(4)
    poles = [(k, random.uniform(-1, 1), random.uniform(-1, 1)) for k in range(150)] + [(200, 89.9, 10.0), (201, 89.9, -170.0), (202, 0.5, 179.999), (203, 0.5, -179.999), (204, 0.0, 0.0), (205, 0.0, 0.0), (206, None, 1.0)]
    meters = [(k, random.uniform(-1, 1), random.uniform(-1, 1)) for k in range(25)] + [(50, 90.0, 0.0), (51, 0.5, 180.0), (52, 0.0, 0.0), (53, None, None)]
    m = spark.createDataFrame(meters, "meter long, lat double, long double")
    p = spark.createDataFrame(poles, "pole long, lat double, long double")

    def xyz(lat, long):
        a, b = math.radians(lat), math.radians(long)
        return math.cos(a) * math.cos(b), math.cos(a) * math.sin(b), math.sin(a)

    got = {}
    for r in ties.k_nearest(m, p, k=4).collect():
        got.setdefault(r["meter"], []).append((r["rank"], round(r["dist_ft"], 3), r["pole"]))
    for k, lat, long in meters:
        if lat is None:
            assert k not in got
            continue
        want = sorted((round(math.dist(xyz(lat, long), xyz(a, b)) * geo.EARTH_KM * geo.FEET_PER_KM, 3), i) for i, a, b in poles if a is not None)[:4]
        assert [d for _, d, _ in sorted(got[k])] == pytest.approx([d for d, _ in want], abs=0.01)
    few = ties.k_nearest(m.limit(3), p.limit(2), k=4)
    assert few.count() == 6


def test_a_stack_of_equal_places_changes_neither_rounds_nor_pairs(spark, monkeypatch):
    random.seed(15)
    poles = [(k, 50 + random.random() / 5, 8 + random.random() / 5) for k in range(1000)]
    stack = [(5000 + k, 50.1, 8.1) for k in range(500)]
    meters = [(k, 50 + random.random() / 5, 8 + random.random() / 5) for k in range(60)] + [(99, 50.1, 8.1)]
    frame = lambda rows, name: spark.createDataFrame(rows, f"{name} int, lat double, long double")
    widths: list[float] = []
    plain = ties.near_pairs
    monkeypatch.setattr(ties, "near_pairs", lambda q, c, width: widths.append(width) or plain(q, c, width))
    found, counts = [], []
    for rows in (poles, poles + stack):
        widths.clear()
        found.append({(r["meter"], r["rank"]): r["pole"] for r in ties.k_nearest(frame(meters, "meter"), frame(rows, "pole"), k=4).collect()})
        counts.append(list(widths))
    assert counts[0] == counts[1]
    assert [found[1][99, n] for n in (1, 2, 3, 4)] == [5000, 5001, 5002, 5003]
    assert all(found[0][m, 1] == found[1][m, 1] or found[1][m, 1] >= 5000 for m in range(60))


def test_k_nearest_of_a_town_and_a_stray_place(spark):
    random.seed(14)
    n, k = 10_000, 5
    town = [(i, 40 + random.uniform(0, 0.05), -80 + random.uniform(0, 0.05)) for i in range(n)]
    p = spark.createDataFrame([*town, (n, 0.0, 0.0)], "pole long, lat double, long double")
    m = spark.createDataFrame([*((i, a, b) for i, a, b in town[:2000]), (n, 0.0, 1.0)], "meter long, lat double, long double")
    c, q = ties._placed(p, "pole", "lat", "long", "c"), ties._placed(m, "meter", "lat", "long", "q")
    width = ties.start_width(c, k, geo.EARTH_KM * 4)
    assert ties.near_pairs(q, c, width).count() < 2000 * 27 * 8 * k / 2  # in proportion to the queries; one cube for the town would give 20 million
    got = ties.k_nearest(m, p, k=k)
    assert got.groupBy("meter").count().where(f"count <> {k}").count() == 0
    assert got.where("meter = pole and dist_ft < 0.01").count() == 2000
    stray = {r["rank"]: r["pole"] for r in got.where(f"meter = {n}").collect()}
    assert stray[1] == n


def test_group_curve_of_peers_only(spark):
    df = spark.createDataFrame([("g", "a", [1.0, 2.0]), ("g", "b", [3.0, 4.0]), ("h", "a", [9.0, 9.0]), ("h", "a", [7.0, 7.0])], "pole string, serial string, curve array<double>")
    assert _rows(peers.group_curve(df, ["pole"]), "pole", "group_curve") == [("g", [2.0, 3.0]), ("h", [8.0, 8.0])]
    assert _rows(peers.group_curve(df, ["pole"], peers_of="serial"), "pole", "group_curve") == [("g", [2.0, 3.0])]


def test_reconcile_by_run(spark):
    rows = [("r1", "d1", 10), ("r1", "d2", 5), ("r2", "d1", 7), ("r2", "d9", 1)]
    side = lambda data: _audit(spark, [(d, n, n, 1) for _, d, n in data]).drop("run_dt").join(spark.createDataFrame([(r, d, n) for r, d, n in data], "run_dt string, usage_dt string, cnt long"), ["usage_dt", "cnt"])
    source, target = side(rows), side([("r1", "d1", 9), ("r1", "d2", 5), ("r2", "d1", 7), ("r2", "d9", 4)])
    assert _rows(audit.reconcile(source, target), "run_dt", "usage_dt", "diff_cnt") == [("r1", "d1", 1), ("r1", "d2", 0), ("r2", "d1", 0), ("r2", "d9", -3)]
    assert _rows(audit.reconcile(source, target, run="r2", exclude=["d9"]), "usage_dt", "diff_cnt") == [("d1", 0)]
    counts = [d.withColumns({"aggr_type": F.lit("INTERVAL_COUNT"), "intervals": F.lit("95")}) for d in (source, target)]
    assert _rows(audit.reconcile_bucketed(*counts, run="r1"), "run_dt", "intervals", "diff_cnt") == [("r1", "<96", 0), ("r1", "<96", 1)]


def test_rules_that_do_not_compile_are_set_aside(spark):
    bad = spark.createDataFrame([("0", "t", "1", "(", "", 1, "p", 1, "A", "", ""), ("00", "t", "1", None, "", 1, "p", 1, "A", "", "")], rules.RULES)
    schema = "tracking_id string, serial string, event_time string, event_type string, reason string, opco string, event_dt string, update_dttm string"
    incoming = spark.createDataFrame([("1", "s1", "t1", "t", "bb", "X", "d1", "2"), (None, "s1", "t1", "t", "bb", "X", "d1", "2")], schema)
    premises = spark.createDataFrame([("s1", "p1")], "serial string, pole string")
    out = event_plan.classify_events(incoming, None, premises, _rules(spark).unionByName(rules.load_rules(bad)))
    assert _rows(out["classified"], "tracking_id", "regex_id") == [("1", "2")] and _rows(out["wrong_rules"], "regex_id") == [("0",), ("00",)]
    assert _rows(out["unmatched"], "tracking_id") == [(None,)]


def test_tie_plan(spark):
    random.seed(5)
    shapes = {f"p{k}": [random.uniform(100, 130) for _ in range(4)] for k in range(3)}
    where = {f"p{k}": (40 + k / 1000, -80.0) for k in range(3)}
    mapping, readings = [], []
    for k in range(9):
        told, true = f"p{k // 3}", "p2" if k == 0 else f"p{k // 3}"
        mapping.append((f"s{k}", told, "2024-01-01", where[told][0], -80.0, where[told][0], -80.0))
        readings += [(f"s{k}", "c", "V", f"2024-01-0{d} 00:{15 * s:02d}:00", shapes[true][s] + random.random() / 10) for d in (1, 2) for s in range(4)]
    mapping.append(("s0", "p9", "2023-01-01", 1.0, 1.0, 1.0, 1.0))  # an older snapshot
    m = spark.createDataFrame(mapping, "serial string, pole string, asof_dt string, premise_lat double, premise_long double, pole_lat double, pole_long double")
    r = spark.createDataFrame(readings, "serial string, channel string, uom string, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    summary = tie_plan.voltage_summary(r, m, expected=4)
    assert summary.count() == 18 and summary.where("group_size <> 3").count() == 0
    worst = summary.groupBy("serial").agg(F.avg("distance").alias("d")).orderBy(F.desc("d")).first()
    assert worst["serial"] == "s0"
    current = m.where("asof_dt = '2024-01-01'")
    scores = spark.createDataFrame([("s0", "p0", 0.93), ("s4", "p1", 0.2)], "serial string, pole string, pred_1 double")
    for criterion in ("min_day", "min_median"):
        found = tie_plan.re_tie(scores, current, summary, k=3, criterion=criterion).collect()
        assert [(x["serial"], x["current_pole"], x["new_pole"]) for x in found] == [("s0", "p0", "p2")]
        every = tie_plan.re_tie(scores.withColumns({"premise": F.lit("pr"), "median_distance": F.lit(0.5), "y_pred": F.lit(1)}), m.withColumn("mount", F.lit("PAD")), summary, k=3, criterion=criterion).collect()
        assert [(x["serial"], x["new_pole"], x["premise"], x["orig_median_distance"], x["y_pred"], x["mount"], x["rank"]) for x in every] == [("s0", "p2", "pr", 0.5, 1, "PAD", 3)]
    gis = spark.createDataFrame([("pr1", "p1", "1", "2"), ("pr2", None, "1", "2")], "premise string, pole string, premise_long string, premise_lat string")
    linked, bad = tie_plan.meter_map(gis, spark.createDataFrame([("pr1", "s1")], "premise string, serial string"))
    assert _rows(linked, "serial", "pole") == [("s1", "p1")] and bad.count() == 1


def test_joins(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    dim = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (2, "z")], "k int, w string")
    assert _rows(joins.enrich(df, dim, ["k"]), "k", "w") == sorted([(1, "x"), (2, "y"), (2, "z"), (None, None)], key=str)
    assert _rows(joins.enrich(df, dim, ["k"], one_row=True), "k", "w") == sorted([(1, "x"), (2, "y"), (None, None)], key=str)
    assert _rows(joins.not_exists(df, dim, ["k"]), "v") == [("c",)] and joins.exists(df, dim, ["k"]).count() == 2 and joins.attach(df, dim, ["k"]).count() == 4
    tied = spark.createDataFrame([("m", 1, 2.0), ("m", 2, 2.0), ("m", 3, 3.0)], "m string, p int, d double")
    assert _rows(joins.arg_min(tied, ["m"], "d"), "p") == [(1,), (2,)]


def test_forest(spark):
    random.seed(6)
    data = [(k, *(random.random() for _ in range(4))) for k in range(300)]
    df = spark.createDataFrame([(*r, int(r[1] > 0.6)) for r in data], "id long, distance_ft double, median_distance double, median_distance_z double, median_mismatch double, label int")
    train, test = model.stratified_split(df, "label", "id")
    assert train.count() + test.count() == 300 and abs(train.count() - 210) < 10
    best = model.train_forest(train, key="id", folds=2, grid={"numTrees": [10], "maxDepth": [3], "minInstancesPerNode": [1, 3]})
    scored = model.score_forest(best, test.unionByName(spark.createDataFrame([(999, 0.1, 0.1, None, 0.1, 0)], df.schema)))
    assert scored.where("id = 999").count() == 0
    right = {(r["label"], r["y_pred"]): r["n"] for r in model.confusion(scored).collect()}
    assert sum(n for (a, b), n in right.items() if a == b) / sum(right.values()) > 0.9


def test_windows_of_runs():
    today = date(2023, 3, 28)
    assert advance_window("", today, 14) == (date(2023, 2, 28), date(2023, 3, 14))
    assert advance_window(None, today, 14) == (date(2023, 2, 28), date(2023, 3, 14))
    assert advance_window("2023-03-20", today, 14) is None
    assert advance_window("2023-03-20", today, 7, early_if_ahead=False) is None
    assert advance_window("2023-03-01", today, 7, early_if_ahead=False) == (date(2023, 3, 1), date(2023, 3, 8))
    assert advance_window("2023-04-01", today, 14) == (date(2023, 4, 1), date(2023, 4, 15))

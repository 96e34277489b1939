"""The registered queries of the library's operators, with the SQL they are checked by.

The driver's tables stand in for meter data: embeddings for daily curves, events
for device events, lineitem for measurements and readings, orders and customers
for snapshots and maps.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import conform as fn
from .functions import geo, vectors
from .operators import alerts, audit, conform, dedupe, features, joins, model, peers, rules, series, ties
from .plans import audit as audit_plan
from .plans import events as event_plan
from .plans import ties as tie_plan
from .session import new_folder, stage
from .sources import readers, writers
from .streaming import events as event_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- series and peers ---------------------------------------------------------

_CURVES = """
    e AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
    g AS (SELECT label, i, sum(v) AS s, count(*) AS n FROM e GROUP BY label, i),
    p AS (SELECT e.vec_id, e.label, e.i, e.v, (g.s - e.v) / (g.n - 1) AS w FROM e JOIN g USING (label, i) WHERE g.n > 1),
    d AS (SELECT *, v >= lag(v, 1, 0.0) OVER o AS a, w >= lag(w, 1, 0.0) OVER o AS b FROM p WINDOW o AS (PARTITION BY vec_id ORDER BY i)),
    m AS (SELECT vec_id, label, sum(v * w) / (sqrt(sum(v * v)) * sqrt(sum(w * w))) AS cosine, count(*) FILTER (a <> b)::INT AS mismatch FROM d GROUP BY vec_id, label),
    c AS (SELECT *, sqrt(greatest(0, 2 - 2 * cosine)) AS distance FROM m)"""


@query(f"""WITH {_CURVES},
    z AS (SELECT label, count(*) AS n, avg(distance) AS dm, stddev_samp(distance) AS ds, avg(mismatch) AS mm, stddev_samp(mismatch) AS ms FROM c GROUP BY label)
    SELECT vec_id, label, round(distance, 6) AS distance, round(cosine, 6) AS cosine, mismatch,
           round(CASE WHEN n > 2 AND ds <> 0 THEN (distance - dm) / ds END, 5) AS distance_z, round(CASE WHEN n > 2 AND ms <> 0 THEN (mismatch - mm) / ms END, 5) AS mismatch_z
    FROM c JOIN z USING (label)""")
def peer_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector against the mean of its label's others."""
    curves = _t(spark, sf_dir, "embeddings").withColumnRenamed("embedding", "curve")
    scored = peers.peer_score(curves, ["label"], "vec_id")
    return scored.select("vec_id", "label", F.round("distance", 6).alias("distance"), F.round("cosine", 6).alias("cosine"), "mismatch", F.round("distance_z", 5).alias("distance_z"), F.round("mismatch_z", 5).alias("mismatch_z"))


@query("""SELECT label, (i - 1)::INT AS slot, round(avg(v), 6) AS value FROM (
    SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY label, i""")
def group_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = peers.group_curve(_t(spark, sf_dir, "embeddings"), ["label"], curve="embedding")
    return series.explode_day(means, ["label"], curve="group_curve").withColumn("value", F.round("value", 6))


@query("""SELECT vec_id, round(sqrt(list_dot_product(list_transform(embedding, lambda x: x::DOUBLE), list_transform(embedding, lambda x: x::DOUBLE))), 6) AS norm FROM embeddings""")
def vector_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "embeddings").select("vec_id", F.round(vectors.l2_norm(F.col("embedding")), 6).alias("norm"))


@query("""SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) = 4 AND count(*) FILTER (l_quantity IS NULL) = 0 AND min(l_quantity) > 0""")
def complete_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.complete_days(_t(spark, sf_dir, "lineitem"), ["l_orderkey"], value="l_quantity", expected=4)


@query("""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) = 4 AND min(l_quantity) > 0)""")
def keep_complete_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return series.keep_complete(lines, ["l_orderkey"], value="l_quantity", expected=4)


@query("""SELECT l_orderkey, string_agg(q::VARCHAR, ',' ORDER BY l_linenumber) AS curve, count(*)::INT AS n_slots FROM (
    SELECT l_orderkey, l_linenumber, min(l_quantity)::INT AS q FROM lineitem GROUP BY 1, 2) GROUP BY l_orderkey""")
def pivot_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    curves = series.pivot_day(_t(spark, sf_dir, "lineitem"), ["l_orderkey"], slot="l_linenumber", value="l_quantity")
    return curves.select("l_orderkey", F.array_join(F.transform("curve", lambda v: v.cast("int").cast("string")), ",").alias("curve"), F.size("curve").alias("n_slots"))


@query("""SELECT user_id, event_type, quantile_disc(value, 0.5) AS median_value, round(median(value), 4) AS exact_median FROM events GROUP BY user_id, event_type""")
def median_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, keys = _t(spark, sf_dir, "events"), ["user_id", "event_type"]
    exact = peers.exact_median(events, keys, "value", "exact_median").withColumn("exact_median", F.round("exact_median", 4))
    return peers.median_over_days(events, keys, ["value"], exact=True).join(exact, keys)


@query("""WITH s AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n, avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS d FROM orders GROUP BY 1, 2)
    SELECT o_orderkey, round(CASE WHEN n > 2 THEN (o_totalprice - m) / nullif(d, 0) END, 5) AS z FROM orders JOIN s USING (o_orderpriority, o_orderstatus)""")
def price_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = peers.zscore(_t(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"], ["o_totalprice"])
    return scored.select("o_orderkey", F.round("o_totalprice_z", 5).alias("z"))


@query("""SELECT event_id, ts::DATE::VARCHAR AS day, ((extract(hour FROM ts) * 60 + extract(minute FROM ts)) // 15)::INT AS slot FROM events WHERE extract(minute FROM ts) % 15 = 0""")
def on_grid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose minute is on a quarter of an hour."""
    events = _t(spark, sf_dir, "events").withColumn("ts", F.date_trunc("minute", "ts"))
    return conform.with_slots(events).select("event_id", F.col("day").cast("string").alias("day"), "slot")


@query("""SELECT time_bucket(INTERVAL '15 minutes', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2""")
def windowed_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_stream.windowed_counts(_t(spark, sf_dir, "events"), ts="ts", keys=["event_type"]).select("start", "event_type", "n")


# ---- conform ------------------------------------------------------------------


@query("""SELECT c_custkey, coalesce('C' || (n_nationkey % 7)::VARCHAR, 'XX') AS code FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 15) n ON c_nationkey = n_nationkey""")
def map_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations below 15 have a code; all others are XX."""
    codes = _t(spark, sf_dir, "nation").where("n_nationkey < 15").select(F.col("n_nationkey").alias("name"), F.concat(F.lit("C"), (F.col("n_nationkey") % 7).cast("string")).alias("code"))
    customers = _t(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("name"))
    return conform.map_codes(customers, codes, name="name").select("c_custkey", "code")


@query("""SELECT r_name AS code, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE', 'NOWHERE')""")
def codes_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = _t(spark, sf_dir, "nation").join(_t(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("code"), F.col("n_name").alias("name"))
    return conform.codes_for(pairs, ["ASIA", "EUROPE", "NOWHERE"])


@query("""SELECT DISTINCT p_type AS code, p_brand AS name FROM part WHERE p_type IN (SELECT p_type FROM part GROUP BY 1 ORDER BY 1 LIMIT 3)""")
def codes_for_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brands that parts of the first three types have."""
    parts = _t(spark, sf_dir, "part").select(F.col("p_type").alias("code"), F.col("p_brand").alias("name")).distinct()
    first = [r["code"] for r in parts.select("code").distinct().orderBy("code").limit(3).collect()]
    return conform.codes_for(parts, first)


_DATE_TEXT = {0: "yyyy-MM-dd", 1: "yyyy/MM/dd", 2: "dd.MM.yyyy"}


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN o_orderdate::DATE::VARCHAR END AS day FROM orders""")
def parse_date_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates written in three ways, of which two are read."""
    orders = _t(spark, sf_dir, "orders")
    kind = F.col("o_orderkey") % 3
    text = F.when(kind == 0, F.date_format("o_orderdate", _DATE_TEXT[0])).when(kind == 1, F.date_format("o_orderdate", _DATE_TEXT[1])).otherwise(F.date_format("o_orderdate", _DATE_TEXT[2]))
    return orders.select("o_orderkey", fn.parse_date(text).cast("string").alias("day"))


@query("""SELECT o_orderkey, greatest(CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END, CASE WHEN o_orderstatus <> 'P' THEN DATE '1998-01-01' END)::VARCHAR AS day FROM orders""")
def floor_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", fn.floor_date(day, "1998-01-01").cast("string").alias("day"))


@query("""SELECT l_orderkey, CASE WHEN n > 4 THEN '>4' WHEN n < 4 THEN '<4' ELSE '4' END AS bucket, n AS lines FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)""")
def interval_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = conform.count_by(_t(spark, sf_dir, "lineitem"), "l_orderkey")
    return counts.select("l_orderkey", fn.interval_bucket(F.col("n").cast("string"), 4).alias("bucket"), F.col("n").alias("lines"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, least(floor(round(l_discount * 100, 9)), 9)::INT AS decile, (floor(round(l_discount * 100, 9))::INT % 10)::INT AS digit FROM lineitem""")
def decile_digit(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("l_discount") * 10
    return _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", fn.decile_digit(p).alias("decile"), fn.decile_digit(p, True).alias("digit"))


@query("""SELECT s_suppkey, split_part(s_name, '#', 2) AS number, CASE WHEN s_nationkey % 3 = 0 THEN 'scalar' WHEN s_nationkey % 3 = 1 THEN 'interval' ELSE 'un' END AS kind, CASE WHEN s_nationkey IN (1, 2, 3) THEN 'REGULAR' ELSE 'ESTIMATE' END AS quality FROM supplier""")
def classify_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a joined name, and two kinds of codes."""
    flag = F.element_at(F.array(F.lit("D1SC"), F.lit("D1IN"), F.lit("else")), F.col("s_nationkey") % 3 + 1)
    return _t(spark, sf_dir, "supplier").select("s_suppkey", fn.split_field(F.col("s_name"), 2, "#").alias("number"), fn.usage_type(flag).alias("kind"), fn.quality_class(F.col("s_nationkey").cast("string"), ["1", "2", "3"]).alias("quality"))


@query("""SELECT event_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS INT) AS k, NULL::DOUBLE AS bad FROM events""")
def cast_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").select("event_id", F.regexp_extract("props", "[0-9]+", 0).alias("k"), F.col("event_type").alias("bad"))
    return conform.cast_columns(events, {"k": "int", "bad": "double"})


@query("""SELECT 'valid' AS part, count(*) AS n FROM events WHERE value > 50 AND user_id % 5 <> 0 UNION ALL SELECT 'invalid', count(*) FROM events WHERE NOT (value > 50 AND user_id % 5 <> 0)""")
def split_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").select("event_id", F.when(F.col("value") > 50, F.col("value")).alias("value"), F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("user_id"))
    parts = zip(("valid", "invalid"), conform.split_valid(events, ["value", "user_id"]), strict=True)
    return dedupe.union_all([df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n") for name, df in parts])


@query("""SELECT event_id FROM events WHERE user_id % 2 = 0 AND ((user_id % 3 = 0 AND event_type IN ('view', 'click')) OR (user_id % 3 = 1 AND event_type = 'error') OR (user_id % 3 = 2 AND event_type = 'signup'))""")
def filter_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").withColumns({"opco": (F.col("user_id") % 3).cast("string"), "uom": F.when(F.col("user_id") % 2 == 0, "VOLT").otherwise("KWH")})
    return conform.filter_channel(events, {"0": ["view", "click"], "1": ["error"]}, unit="VOLT", channel_col="event_type", default=["signup"]).select("event_id")


@query("""SELECT o_orderkey, '2024-02-01 03:04:05' AS update_dttm, 1706756645::BIGINT AS run_id, coalesce(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END, 0) AS price FROM orders""")
def stamp_and_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("price"))
    return conform.stamp_run(conform.fill_nulls(orders), "2024-02-01 03:04:05")


@query("""SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, '' FROM supplier""")
def conform_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return conform.conform_union(wide, _t(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")))


# ---- sources and snapshots ----------------------------------------------------


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM orders JOIN (SELECT o_custkey, max(o_orderdate) AS d FROM orders GROUP BY 1) m USING (o_custkey) WHERE o_orderdate = d""")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.latest_snapshot(_t(spark, sf_dir, "orders"), "o_orderdate", ["o_custkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("""SELECT o_orderkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def latest_snapshot_of_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.latest_snapshot(_t(spark, sf_dir, "orders"), "o_orderdate").select("o_orderkey")


@query("""SELECT DISTINCT o_orderdate::DATE::VARCHAR AS day FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'""")
def distinct_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _t(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return readers.distinct_dates(days, "day", "1996-01-01").select(F.col("day").cast("string").alias("day"))


@query("""SELECT string_agg('''' || d || '''', ',' ORDER BY d) AS dates FROM (SELECT DISTINCT o_orderdate::DATE::VARCHAR AS d FROM orders WHERE o_orderdate < TIMESTAMP '1995-03-01')""")
def dates_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _t(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return readers.dates_text(readers.distinct_dates(days, "day", "1995-03-01"), "day")


# ---- joins, ranks, duplicates -------------------------------------------------


@query("""SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")
def enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = _t(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    customers = joins.enrich(_t(spark, sf_dir, "customer"), nations, ["c_nationkey"], columns=["n_name"]).withColumnRenamed("c_custkey", "o_custkey")
    return joins.enrich(_t(spark, sf_dir, "orders"), customers, ["o_custkey"], columns=["c_name", "n_name"]).select("o_orderkey", "c_name", "n_name")


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE l_returnflag = 'A' AND NOT EXISTS (SELECT 1 FROM lineitem m WHERE m.l_returnflag = 'R' AND m.l_orderkey = l.l_orderkey AND m.l_linestatus = l.l_linestatus)""")
def not_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem")
    left = joins.not_exists(lines.where("l_returnflag = 'A'"), lines.where("l_returnflag = 'R'"), ["l_orderkey", "l_linestatus"])
    return left.select("l_orderkey", "l_linenumber", "l_partkey")


@query("""SELECT c_custkey, count(*) OVER (PARTITION BY c_nationkey) AS group_size FROM customer""")
def group_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peers.group_size(_t(spark, sf_dir, "customer"), ["c_nationkey"]).select("c_custkey", "group_size")


@query("""SELECT o_orderkey, n AS group_size FROM orders JOIN (SELECT o_orderpriority, o_orderstatus, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1, 2) USING (o_orderpriority, o_orderstatus)""")
def distinct_group_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peers.distinct_group_size(_t(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"], "o_custkey").select("o_orderkey", "group_size")


@query("""SELECT o_custkey, o_orderkey FROM orders JOIN (SELECT o_custkey, min(o_totalprice) AS p FROM orders GROUP BY 1) m USING (o_custkey) WHERE o_totalprice = p""")
def arg_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.arg_min(_t(spark, sf_dir, "orders"), ["o_custkey"], "o_totalprice").select("o_custkey", "o_orderkey")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, dense_rank() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_partkey DESC, l_orderkey DESC)::INT AS row_num FROM lineitem""")
def rank_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = joins.dense_rank(_t(spark, sf_dir, "lineitem"), ["l_suppkey", "l_returnflag"], [F.desc("l_partkey"), F.desc("l_orderkey")], "row_num")
    return ranked.select("l_orderkey", "l_linenumber", "l_partkey", "row_num")


@query("""SELECT * FROM (SELECT s_nationkey, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey)::INT AS rank FROM supplier) WHERE rank <= 3""")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.top_k(_t(spark, sf_dir, "supplier"), ["s_nationkey"], [F.desc("s_acctbal"), F.col("s_suppkey")], 3).select("s_nationkey", "s_suppkey", "rank")


@query("""SELECT event_id, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.dedupe_latest(_t(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", ties=["event_id"]).select("event_id", "user_id", "event_type", "value")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem) WHERE n = 1""")
def drop_all_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.drop_all_duplicates(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31' GROUP BY 1, 2 HAVING count(*) > 1""")
def find_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    within = F.col("l_shipdate").between("1996-01-01", "1999-12-31")
    return alerts.alert_duplicates(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], where=within)


@query("""WITH new AS (SELECT user_id, event_type, ts::DATE AS day, ts, value * 2 AS value, event_id, 1 AS fresh FROM events WHERE ts >= TIMESTAMP '2024-01-16' OR event_id % 50 = 0),
    old AS (SELECT user_id, event_type, ts::DATE AS day, ts, value, event_id, 0 AS fresh FROM events WHERE ts < TIMESTAMP '2024-01-16'),
    un AS (SELECT * FROM new UNION ALL SELECT * FROM old WHERE (event_type, day) IN (SELECT event_type, day FROM new))
    SELECT event_id, user_id, event_type, day::VARCHAR AS day, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY ts DESC, fresh DESC, event_id DESC) AS r FROM un) WHERE r = 1""")
def merge_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second half month, with some earlier events sent again, merged into the first."""
    events = _t(spark, sf_dir, "events").withColumn("day", F.to_date("ts")).select("event_id", "user_id", "event_type", "day", "ts", "value")
    incoming = events.where("ts >= timestamp'2024-01-16' or event_id % 50 = 0").withColumn("value", F.col("value") * 2)
    merged = dedupe.merge_incremental(events.where("ts < timestamp'2024-01-16'"), incoming, ["user_id", "event_type", "day"], order="ts", partition=["event_type", "day"], ties=["event_id"])
    return merged.select("event_id", "user_id", "event_type", F.col("day").cast("string").alias("day"), "value")


@query("""SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-12') WHERE r = 1""")
def merge_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return dedupe.merge_full(events, ["user_id", "event_type"], order="ts", day="day", days="2024-01-05~2024-01-12", ties=["event_id"]).select("event_id", "user_id", "event_type")


# ---- rules and features -------------------------------------------------------

RULE_ROWS = [
    ("1", "click", r"click \{\"k\": 9[0-9]\}", "high click", "cr1"),
    ("10", "click", r"[0-9]+\}$", "N", "cr2"),
    ("2", "click", r"\{\"k\": ", "", "cr3"),
    ("3", "error", r"error .*[02468]\}", "even error", "cr4"),
    ("4", "view", r"view \{\"k\": [0-9]\}", "low view", "cr5"),
    ("5", "view", r"k", None, "cr6"),
    ("6", "signup", r"never", "x", "cr7"),
]
_RULES_SQL = """r(regex_id, type, pat, rep, pv) AS (VALUES
      ('1', 'click', 'click \\{"k": 9[0-9]\\}', 'high click', 'cr1'), ('10', 'click', '[0-9]+\\}$', 'N', 'cr2'), ('2', 'click', '\\{"k": ', '', 'cr3'),
      ('3', 'error', 'error .*[02468]\\}', 'even error', 'cr4'), ('4', 'view', 'view \\{"k": [0-9]\\}', 'low view', 'cr5'), ('5', 'view', 'k', '', 'cr6'), ('6', 'signup', 'never', 'x', 'cr7')),
    ev AS (SELECT event_id, event_type, user_id, event_type || ' ' || props AS reason FROM events),
    hit AS (SELECT ev.event_id, ev.event_type, ev.user_id, ev.reason, r.regex_id, regexp_replace(reason, pat, rep, 'g') AS curated_reason FROM ev JOIN r ON event_type = type WHERE regexp_extract(reason, pat) <> ''),
    cl AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY regex_id) AS n FROM hit) WHERE n = 1)"""


def _rules(spark: SparkSession) -> DataFrame:
    rows = [(i, t, "1", p, r, 1, v, 1, "A", "", r) for i, t, p, r, v in RULE_ROWS]
    return rules.load_rules(spark.createDataFrame(rows, rules.RULES))


def _reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "events").select("event_id", "event_type", "user_id", F.concat_ws(" ", "event_type", "props").alias("reason"))


@query(f"WITH {_RULES_SQL} SELECT event_id, regex_id, curated_reason FROM cl")
def classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.classify(_reasons(spark, sf_dir), _rules(spark), key=["event_id"]).select("event_id", "regex_id", "curated_reason")


@query(f"WITH {_RULES_SQL} SELECT event_id, string_agg(regex_id || '~' || curated_reason, '^' ORDER BY regex_id) AS matches FROM hit GROUP BY event_id")
def classify_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.classify_all(_reasons(spark, sf_dir), _rules(spark), key=["event_id"])
    return found.select("event_id", F.array_join(F.transform("matches", lambda m: F.concat_ws("~", m["regex_id"], m["curated_reason"])), "^").alias("matches"))


@query(f"WITH {_RULES_SQL} SELECT event_id, 'no_regex_applied' AS error FROM ev WHERE event_type IN (SELECT type FROM r) AND event_id NOT IN (SELECT event_id FROM hit)")
def unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.unmatched(_reasons(spark, sf_dir), _rules(spark), key=["event_id"]).select("event_id", "error")


@query(f"WITH {_RULES_SQL} SELECT event_id, 'new event type|' || event_type AS error FROM ev WHERE event_type NOT IN (SELECT type FROM r)")
def unknown_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.unknown_type(_reasons(spark, sf_dir), _rules(spark)).select("event_id", "error")


@query(f"WITH {_RULES_SQL} SELECT event_id, 'new report title|' || curated_reason AS error FROM cl LEFT JOIN r ON cl.regex_id = r.regex_id AND trim(curated_reason) = trim(rep) WHERE r.regex_id IS NULL")
def unknown_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.classify(_reasons(spark, sf_dir), _rules(spark), key=["event_id"])
    return rules.unknown_title(found, _rules(spark)).select("event_id", "error")


_ONE_HOT = ", ".join(f"(pv = 'cr{i}')::BIGINT AS cr{i}" for i in range(1, 8))


@query(f"WITH {_RULES_SQL} SELECT event_id, {_ONE_HOT} FROM cl JOIN r ON cl.regex_id = r.regex_id AND trim(curated_reason) = trim(rep)")
def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = event_plan.feature_table(_classified(spark, sf_dir), _rules(spark), key=["event_id"], order="user_id")[0]
    return table.select("event_id", *[f"cr{i}" for i in range(1, 8)])


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.classify(_reasons(spark, sf_dir), _rules(spark), key=["event_id"])


@query(f"WITH {_RULES_SQL} SELECT user_id, {', '.join(f'''count(*) FILTER (pv = 'cr{i}') AS cr{i}''' for i in range(1, 8))} FROM cl JOIN r ON cl.regex_id = r.regex_id AND trim(curated_reason) = trim(rep) GROUP BY user_id")
def event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = event_plan.feature_table(_classified(spark, sf_dir), _rules(spark), key=["event_id"], order="user_id")[0]
    return features.event_counts(table, ["user_id"], [f"cr{i}" for i in range(1, 8)])


# ---- audit --------------------------------------------------------------------

ACTUAL = ["1", "2", "3", "4"]
EXPECTED = 24
_SRC = """s AS (SELECT l_returnflag AS opco, CASE WHEN l_linenumber = 7 THEN 'scalar' ELSE 'interval' END AS usage_type, strftime(l_shipdate, '%Y-%m') AS usage_dt,
      CASE WHEN l_linestatus = 'F' THEN 'E-KWH' ELSE 'KVAR' END AS register, l_linenumber::VARCHAR AS condition, l_suppkey::VARCHAR AS serial,
      l_quantity AS cnt, CASE WHEN l_discount = 0 THEN 0 ELSE l_extendedprice END AS total, l_partkey AS config_id, l_orderkey AS component_id FROM lineitem),
    si AS (SELECT * FROM s WHERE usage_type = 'interval' AND usage_dt < '2001-06')"""
_TGT = """t AS (SELECT l_returnflag AS opco, 'interval' AS usage_type, strftime(l_shipdate, '%Y-%m') AS usage_dt, CASE WHEN l_linestatus = 'F' THEN 'E-KWH' ELSE 'KVAR' END AS register,
      l_linenumber::VARCHAR AS quality, l_suppkey::VARCHAR AS serial, CASE WHEN l_linestatus = 'F' AND l_discount > 0 THEN l_extendedprice ELSE 0 END AS use FROM lineitem WHERE l_orderkey % 97 <> 0),
    q AS (SELECT l_returnflag AS opco, CASE WHEN l_linenumber < 3 THEN 'scalar' WHEN l_linenumber < 6 THEN 'interval' ELSE 'un' END AS usage_type, strftime(l_shipdate, '%Y-%m') AS usage_dt,
      CASE WHEN l_linestatus = 'F' THEN 'E-KWH' ELSE 'KVAR' END AS register, l_linenumber::VARCHAR AS quality, l_suppkey::VARCHAR AS serial,
      CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END AS use FROM lineitem WHERE l_orderkey % 97 = 0)"""


def _register() -> Column:
    return F.when(F.col("l_linestatus") == "F", "E-KWH").otherwise("KVAR")


def _measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    return _t(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("opco"), F.when(n == 7, "scalar").otherwise("interval").alias("usage_type"), F.date_format("l_shipdate", "yyyy-MM").alias("usage_dt"), _register().alias("register"),
        n.cast("string").alias("condition"), F.col("l_suppkey").cast("string").alias("serial"), F.col("l_quantity").alias("cnt"), F.when(F.col("l_discount") == 0, 0.0).otherwise(F.col("l_extendedprice")).alias("total"),
        F.col("l_partkey").alias("config_id"), F.col("l_orderkey").alias("component_id"),
    )


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _t(spark, sf_dir, "lineitem").where("l_orderkey % 97 <> 0")
    return lines.select(
        F.col("l_returnflag").alias("opco"), F.lit("interval").alias("usage_type"), F.date_format("l_shipdate", "yyyy-MM").alias("usage_dt"), _register().alias("register"), F.col("l_linenumber").cast("string").alias("quality"),
        F.col("l_suppkey").cast("string").alias("serial"), F.when(F.col("l_linestatus") == "F", "KWH").otherwise("VOLT").alias("uom"), F.when(F.col("l_discount") > 0, F.col("l_extendedprice")).otherwise(0.0).alias("value"),
    )


def _quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    flag = F.when(n < 3, "D1SC").when(n < 6, "D1IN").otherwise("other")
    lines = _t(spark, sf_dir, "lineitem").where("l_orderkey % 97 = 0")
    return lines.select(
        F.col("l_returnflag").alias("opco"), flag.alias("flag"), F.date_format("l_shipdate", "yyyy-MM").alias("usage_dt"), _register().alias("register"), n.cast("string").alias("quality"),
        F.col("l_suppkey").cast("string").alias("serial"), F.col("l_quantity").cast("int").cast("string").alias("value"),
    )


def _money(df: DataFrame, *columns: str) -> DataFrame:
    """Sums of cents, rounded so that the order of summation does not show."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), 2) for c in columns or ("usage",)})


def _agg(source: str, kind: str, keys: str, cnt: str = "sum(cnt)", usage: str = "sum(total)", meters: str = "count(DISTINCT serial)") -> str:
    used = [k.strip() for k in keys.split(",")]
    columns = ", ".join(f"'{kind}' AS aggr_type" if k == "aggr_type" else k if k in used else f"'' AS {k}" for k in audit.KEYS)
    return f"SELECT {columns}, ({cnt})::BIGINT AS cnt, round({usage}, 2) AS usage, ({meters})::BIGINT AS meters FROM {source} GROUP BY {keys}"


_S_QUALITY = "(SELECT *, CASE WHEN condition IN ('1', '2', '3', '4') THEN 'REGULAR' ELSE 'ESTIMATE' END AS quality FROM si)"


@query(f"WITH {_SRC} {_agg('si', 'USAGE_DATE', 'opco, usage_dt, usage_type')}")
def audit_source_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(audit.source_by_date(_measurements(spark, sf_dir), before="2001-06"))


@query(f"WITH {_SRC} {_agg('si', 'UOM', 'opco, usage_dt, usage_type, register')}")
def audit_source_by_uom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(audit.source_by_uom(_measurements(spark, sf_dir), before="2001-06"))


@query(f"WITH {_SRC} {_agg(_S_QUALITY, 'DATA_QUALITY', 'opco, usage_dt, usage_type, register, quality')}")
def audit_source_by_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(audit.source_by_quality(_measurements(spark, sf_dir), ACTUAL, before="2001-06"))


_ZERO = "(SELECT opco, usage_dt, usage_type, register, condition AS quality, serial, sum(cnt) AS cnt, sum(total) AS total FROM si GROUP BY ALL HAVING sum(total) = 0)"


@query(f"WITH {_SRC} {_agg(_ZERO, 'ZERO_USAGE', 'opco, usage_dt, usage_type, register, quality', meters='count(serial)')}")
def audit_source_zero_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(audit.source_zero_usage(_measurements(spark, sf_dir), before="2001-06"))


_COUNTS = f"""rk AS (SELECT *, dense_rank() OVER (PARTITION BY opco, usage_type, usage_dt, serial, register ORDER BY config_id DESC, component_id DESC) AS n, CASE WHEN condition IN ('1', '2', '3', '4') THEN 'A' ELSE 'E' END AS a FROM si),
    act AS (SELECT * FROM rk WHERE cnt = {EXPECTED} AND a = 'A'),
    est AS (SELECT * FROM rk WHERE cnt = {EXPECTED} AND n = 1 AND NOT EXISTS (SELECT 1 FROM act WHERE act.opco = rk.opco AND act.usage_type = rk.usage_type AND act.usage_dt = rk.usage_dt AND act.register = rk.register AND act.serial = rk.serial)),
    oth AS (SELECT opco, usage_type, usage_dt, register, serial, sum(cnt) AS cnt, sum(total) AS total FROM rk WHERE cnt <> {EXPECTED} AND n = 1 GROUP BY ALL),
    ev3 AS (SELECT opco, usage_type, usage_dt, register, serial, cnt, total FROM act UNION ALL SELECT opco, usage_type, usage_dt, register, serial, cnt, total FROM est UNION ALL SELECT opco, usage_type, usage_dt, register, serial, cnt, total FROM oth),
    ev4 AS (SELECT *, cnt::INT::VARCHAR AS intervals FROM ev3)"""


@query(f"WITH {_SRC}, {_COUNTS} {_agg('ev4', 'INTERVAL_COUNT', 'opco, usage_dt, usage_type, register, intervals')}")
def audit_source_interval_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(audit.source_interval_count(_measurements(spark, sf_dir), ACTUAL, expected=EXPECTED, before="2001-06"))


def _two_arms(kind: str, keys: str) -> str:
    arms = " UNION ALL ".join(f"({_agg(x, kind, keys, 'count(*)', 'sum(use)')})" for x in ("t", "q"))
    return f"SELECT {', '.join(audit.KEYS)}, sum(cnt)::BIGINT AS cnt, round(sum(usage), 2) AS usage, sum(meters)::BIGINT AS meters FROM ({arms}) GROUP BY {', '.join(audit.KEYS)}"


@query(f"WITH {_TGT} {_two_arms('USAGE_DATE', 'opco, usage_dt, usage_type')}")
def audit_target_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(audit.target_by_date(_readings(spark, sf_dir), quarantined=_quarantined(spark, sf_dir)))


_ONE = "(SELECT * FROM t UNION ALL SELECT * FROM q)"


@query(f"WITH {_TGT} {_agg(_ONE, 'USAGE_DATE', 'opco, usage_dt, usage_type', 'count(*)', 'sum(use)')}")
def audit_target_by_date_one_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meters of both arms counted once."""
    return _money(audit.target_by_date(_readings(spark, sf_dir), quarantined=_quarantined(spark, sf_dir), one_count=True))


@query(f"WITH {_TGT} {_two_arms('UOM', 'opco, usage_dt, usage_type, register')}")
def audit_target_by_uom(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(audit.target_by_uom(_readings(spark, sf_dir), quarantined=_quarantined(spark, sf_dir)))


_T_QUALITY = "(SELECT * EXCLUDE quality, CASE WHEN quality = '1' THEN 'REGULAR' ELSE 'ESTIMATE' END AS quality FROM t)"


@query(f"WITH {_TGT} {_agg(_T_QUALITY, 'DATA_QUALITY', 'opco, usage_dt, usage_type, register, quality', 'count(*)', 'sum(use)')}")
def audit_target_by_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(audit.target_by_quality(_readings(spark, sf_dir), ["1"]))


_TZERO = "(" + " UNION ALL ".join(f"SELECT opco, usage_dt, usage_type, register, quality, serial, count(*) AS cnt, sum(use) AS use FROM {x} GROUP BY ALL HAVING sum(use) = 0" for x in ("t", "q")) + ")"


@query(f"WITH {_TGT} {_agg(_TZERO, 'ZERO_USAGE', 'opco, usage_dt, usage_type, register, quality', usage='sum(use)', meters='count(serial)')}")
def audit_target_zero_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(audit.target_zero_usage(_readings(spark, sf_dir), quarantined=_quarantined(spark, sf_dir)))


_TCOUNT = "(SELECT opco, usage_dt, usage_type, register, serial, count(*) AS cnt, sum(use) AS use, count(*)::VARCHAR AS intervals FROM t GROUP BY opco, usage_dt, usage_type, register, serial)"


@query(f"WITH {_TGT} {_agg(_TCOUNT, 'INTERVAL_COUNT', 'opco, usage_dt, usage_type, register, intervals', usage='sum(use)')}")
def audit_target_interval_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _money(audit.target_interval_count(_readings(spark, sf_dir)))


def _both(spark: SparkSession, sf_dir: str, make: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Two systems: all measurements, and those that are not lost on the way; each has rows that the other lacks."""
    every = _measurements(spark, sf_dir)
    return make(every.where("config_id % 89 <> 0 and usage_dt <> '1995-02'")), make(every.where("component_id % 13 <> 0 and usage_dt <> '1995-01' and not (usage_dt = '1996-05' and opco = 'A')"))


_PAIR = _SRC.split("si AS")[0] + """a AS (SELECT * FROM s WHERE usage_type = 'interval' AND config_id % 89 <> 0 AND usage_dt <> '1995-02'),
    b AS (SELECT * FROM s WHERE usage_type = 'interval' AND component_id % 13 <> 0 AND usage_dt <> '1995-01' AND NOT (usage_dt = '1996-05' AND opco = 'A'))"""


def _compared(left: str, right: str, join: str) -> str:
    keys = ", ".join(audit.KEYS)
    pct = lambda x, y: f"TRY_CAST(round((x.src_{x} - {y}) / nullif(x.src_{x}::DOUBLE, 0) * 100, 2) AS DECIMAL(7,4))::DOUBLE"
    return f"""SELECT {keys}, coalesce(src_cnt, 0) AS src_cnt, coalesce(tgt_cnt, 0) AS tgt_cnt, coalesce(src_cnt, 0) - coalesce(tgt_cnt, 0) AS diff_cnt, {pct('cnt', 'tgt_cnt')} AS pct_cnt,
      coalesce(src_usage, 0) AS src_usage, coalesce(tgt_usage, 0) AS tgt_usage, TRY_CAST(src_usage - tgt_usage AS DECIMAL(9,2))::DOUBLE AS diff_usage, {pct('usage', 'tgt_usage')} AS pct_usage,
      src_meters::DOUBLE AS src_meters, tgt_meters::DOUBLE AS tgt_meters, (src_meters - tgt_meters)::DOUBLE AS diff_meters, {pct('meters', 'coalesce(y.tgt_meters, 0)')} AS pct_meters
      FROM (SELECT {keys}, cnt AS src_cnt, usage AS src_usage, meters AS src_meters FROM ({left})) x {join} JOIN (SELECT {keys}, cnt AS tgt_cnt, usage AS tgt_usage, meters AS tgt_meters FROM ({right})) y USING ({keys})"""


_DATE_KEYS = "opco, usage_dt, usage_type"
_PAIR_BY_DATE = _compared(_agg("a", "USAGE_DATE", _DATE_KEYS), _agg("b", "USAGE_DATE", _DATE_KEYS), "LEFT")


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in df.columns if c.startswith("pct_") or c.endswith("_meters") or c == "diff_usage"})


def _by_date(spark: SparkSession, sf_dir: str, target_only: bool) -> DataFrame:
    source, target = _both(spark, sf_dir, audit.source_by_date)
    return audit.reconcile(_money(source), _money(target), target_only=target_only)


@query(f"WITH {_PAIR} {_PAIR_BY_DATE}")
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_by_date(spark, sf_dir, False))


@query(f"WITH {_PAIR} {_compared(_agg('a', 'USAGE_DATE', _DATE_KEYS), _agg('b', 'USAGE_DATE', _DATE_KEYS), 'FULL')}")
def reconcile_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_by_date(spark, sf_dir, True))


def _bucketed(x: str) -> str:
    each = f"(SELECT *, CASE WHEN cnt > {EXPECTED} THEN '>{EXPECTED}' WHEN cnt < {EXPECTED} THEN '<{EXPECTED}' ELSE '{EXPECTED}' END AS intervals FROM (SELECT opco, usage_dt, usage_type, register, cnt, sum(cnt) AS c, sum(total) AS total, count(DISTINCT serial) AS m FROM {x} GROUP BY opco, usage_dt, usage_type, register, cnt))"
    return _agg(each, "INTERVAL_COUNT", "opco, usage_dt, usage_type, register, intervals", cnt="sum(c)", meters="sum(m)")


@query(f"WITH {_PAIR} {_compared(_bucketed('a'), _bucketed('b'), 'FULL')}")
def reconcile_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval counts of every length, put into under, at and over the expected."""

    def counts(df: DataFrame) -> DataFrame:
        found = df.where("usage_type = 'interval'").groupBy("opco", "usage_dt", "usage_type", "register", F.col("cnt").cast("int").cast("string").alias("intervals")).agg(F.sum("cnt").cast("long").alias("cnt"), F.sum("total").alias("usage"), F.count_distinct("serial").alias("meters"))
        return found.withColumns({"aggr_type": F.lit("INTERVAL_COUNT"), "quality": F.lit("")})

    source, target = _both(spark, sf_dir, counts)
    source, target = (_money(audit.bucketed(x, expected=EXPECTED)) for x in (source, target))
    return _shown(audit.reconcile(source, target))


_SHORT = "coalesce((best_cnt - src_cnt)::DOUBLE / nullif(best_cnt, 0)::DOUBLE * 100, 0)"


def _alert_sql(percent: float) -> str:
    parts = [f"coalesce({c}, 0)" for c in ("pct_cnt", "pct_meters", "pct_usage")]
    over, under = " OR ".join(f"{p} > {percent}" for p in parts), " AND ".join(f"{p} < {percent}" for p in parts)
    return f"""c AS ({_PAIR_BY_DATE}), best AS (SELECT opco, max(tgt_cnt) AS best_cnt FROM c GROUP BY opco), f AS (SELECT c.*, best_cnt, {_SHORT} AS short FROM c JOIN best USING (opco) WHERE usage_dt > '1995-03'),
      al AS (SELECT *, CASE WHEN ({over}) AND short > 5 THEN 'SOURCE AND TARGET ISSUE' WHEN ({under}) AND short > 5 THEN 'SOURCE ISSUE' WHEN ({over}) AND short < 5 THEN 'TARGET ISSUE' END AS issue FROM f WHERE ({over}) OR short > 5)"""


def _mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.alert_mismatch(_by_date(spark, sf_dir, False), percent=8, start="1995-03")


@query(f"WITH {_PAIR}, {_alert_sql(8)} SELECT opco, usage_dt, src_cnt, tgt_cnt, round(short, 4) AS pct_short, issue FROM al")
def alert_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mismatches(spark, sf_dir).select("opco", "usage_dt", "src_cnt", "tgt_cnt", F.round("pct_short", 4).alias("pct_short"), "issue")


@query(f"WITH {_PAIR}, {_alert_sql(8)} SELECT DISTINCT opco, usage_dt FROM al WHERE issue LIKE '%TARGET ISSUE%'")
def reprocess_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts.reprocess_list(_mismatches(spark, sf_dir))


def _quality_of(x: str) -> str:
    return f"SELECT opco, usage_dt, usage_type, sum(CASE WHEN condition IN ('1', '2', '3', '4') THEN cnt ELSE 0 END)::BIGINT AS r, sum(CASE WHEN condition IN ('1', '2', '3', '4') THEN 0 ELSE cnt END)::BIGINT AS e, sum(cnt)::BIGINT AS n FROM {x} GROUP BY ALL"


@query(f"""WITH {_PAIR}, j AS (SELECT x.opco, x.usage_dt, x.r AS src_regular, x.e AS src_estimate, x.n AS src_total, coalesce(y.r, 0) AS tgt_regular, coalesce(y.e, 0) AS tgt_estimate, coalesce(y.n, 0) AS tgt_total FROM ({_quality_of('a')}) x LEFT JOIN ({_quality_of('b')}) y USING (opco, usage_dt, usage_type))
    SELECT opco, usage_dt, src_regular, src_estimate, src_total, tgt_regular, tgt_estimate, tgt_total, round(tgt_estimate / tgt_total::DOUBLE * 100, 4) AS tgt_estimate_pct,
      CASE WHEN src_estimate / src_total::DOUBLE * 100 > 33 THEN 'SOURCE NON REGULAR INTERVAL COUNT > 33%' ELSE 'TARGET NON REGULAR INTERVAL COUNT > 33%' END AS issue FROM j WHERE tgt_total > 0 AND tgt_estimate / tgt_total::DOUBLE * 100 > 33""")
def alert_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _both(spark, sf_dir, lambda d: audit.source_by_quality(d, ACTUAL))
    shares = audit.quality_share(audit.reconcile(source, target)).where("src_total > 0")
    return alerts.alert_quality(shares, percent=33).select("opco", "usage_dt", "src_regular", "src_estimate", "src_total", "tgt_regular", "tgt_estimate", "tgt_total", F.round("tgt_estimate_pct", 4).alias("tgt_estimate_pct"), "issue")


_ALL_SOURCE = " UNION ALL ".join(
    f"({x})" for x in (
        _agg("si", "USAGE_DATE", "opco, usage_dt, usage_type"), _agg("si", "UOM", "opco, usage_dt, usage_type, register"), _agg(_S_QUALITY, "DATA_QUALITY", "opco, usage_dt, usage_type, register, quality"),
        _agg(_ZERO, "ZERO_USAGE", "opco, usage_dt, usage_type, register, quality", meters="count(serial)"), _agg("ev4", "INTERVAL_COUNT", "opco, usage_dt, usage_type, register, intervals"),
    )
)
_ALL_TARGET = " UNION ALL ".join(
    f"({x})" for x in (
        _two_arms("USAGE_DATE", "opco, usage_dt, usage_type"), _two_arms("UOM", "opco, usage_dt, usage_type, register"), _agg(_T_QUALITY, "DATA_QUALITY", "opco, usage_dt, usage_type, register, quality", "count(*)", "sum(use)"),
        _agg(_TZERO, "ZERO_USAGE", "opco, usage_dt, usage_type, register, quality", usage="sum(use)", meters="count(serial)"), _agg(_TCOUNT, "INTERVAL_COUNT", "opco, usage_dt, usage_type, register, intervals", usage="sum(use)"),
    )
)


def _in_buckets(x: str) -> str:
    n = "TRY_CAST(intervals AS INT)"
    columns = ", ".join(f"CASE WHEN {n} > {EXPECTED} THEN '>{EXPECTED}' WHEN {n} < {EXPECTED} THEN '<{EXPECTED}' WHEN {n} = {EXPECTED} THEN '{EXPECTED}' END AS intervals" if k == "intervals" else k for k in audit.KEYS)
    return f"SELECT {columns}, sum(cnt)::BIGINT AS cnt, round(sum(usage), 2) AS usage, sum(meters)::BIGINT AS meters FROM {x} WHERE aggr_type = 'INTERVAL_COUNT' GROUP BY ALL"


_PLAIN = "SELECT * FROM {} WHERE aggr_type <> 'INTERVAL_COUNT'"


@query(f"""WITH {_SRC}, {_COUNTS}, {_TGT}, sa AS ({_ALL_SOURCE}), ta AS ({_ALL_TARGET})
    ({_compared(_PLAIN.format('sa'), _PLAIN.format('ta'), 'LEFT')}) UNION ALL ({_compared(_in_buckets('sa'), _in_buckets('ta'), 'FULL')})""")
def audit_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole audit, from both systems' rows to the reconciled table."""
    source = audit_plan.source_aggregates(_measurements(spark, sf_dir), ACTUAL, expected=EXPECTED, before="2001-06")
    target = audit_plan.target_aggregates(_readings(spark, sf_dir), ["1"], quarantined=_quarantined(spark, sf_dir))
    return _money(_shown(audit_plan.reconcile_all(_money(source), _money(target), expected=EXPECTED)), "src_usage", "tgt_usage")


_RUNS = "(SELECT *, strftime(ts, '%Y%m%d') AS run_dt, event_type AS opco, user_id::VARCHAR AS serial, (ts::DATE)::VARCHAR AS usage_dt FROM events)"


def _run_side(where: str) -> str:
    return f"SELECT run_dt, opco, usage_dt, count(*)::BIGINT AS cnt, count(DISTINCT serial)::BIGINT AS meters FROM {_RUNS} WHERE {where} GROUP BY ALL"


@query(f"""SELECT run_dt, opco, usage_dt, coalesce(x.cnt, 0) AS src_cnt, coalesce(y.cnt, 0) AS tgt_cnt, coalesce(x.cnt, 0) - coalesce(y.cnt, 0) AS diff_cnt FROM ({_run_side("event_id % 7 <> 0 AND usage_dt <> '2024-01-03'")}) x FULL JOIN ({_run_side("event_id % 5 <> 0 AND usage_dt <> '2024-01-03'")}) y USING (run_dt, opco, usage_dt)""")
def reconcile_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two systems' runs in one table each, without an excluded day; each event type is a company, each day a run."""
    day = F.to_date("ts").cast("string")
    events = _t(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyyMMdd").alias("run_dt"), F.col("event_type").alias("opco"), F.col("user_id").alias("serial"), day.alias("usage_dt"))
    empty = {k: F.lit("") for k in audit.KEYS if k not in ("opco", "usage_dt")}
    side = lambda d: d.groupBy("run_dt", "opco", "usage_dt").agg(F.count("*").alias("cnt"), F.count_distinct("serial").alias("meters")).withColumns(empty | {"usage": F.lit(0.0)})
    found = audit.reconcile(side(events.where("event_id % 7 <> 0")), side(events.where("event_id % 5 <> 0")), exclude=["2024-01-03"])
    return found.select("run_dt", "opco", "usage_dt", "src_cnt", "tgt_cnt", "diff_cnt")


# ---- geography, ties, model ---------------------------------------------------

_PLACES = "pl AS (SELECT vec_id, label, round(embedding[1]::DOUBLE * 80, 4) AS lat, round(embedding[2]::DOUBLE * 170, 4) AS long FROM embeddings)"
_XYZ = "xy AS (SELECT vec_id, label, 6371.0 * cos(radians(lat)) * cos(radians(long)) AS x, 6371.0 * cos(radians(lat)) * sin(radians(long)) AS y, 6371.0 * sin(radians(lat)) AS z FROM pl)"


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    return _t(spark, sf_dir, "embeddings").select("vec_id", "label", F.round(e[0].cast("double") * 80, 4).alias("lat"), F.round(e[1].cast("double") * 170, 4).alias("long"))


@query(f"""WITH {_PLACES} SELECT vec_id, round(2 * 6371.0 * 3280.84 * asin(sqrt(least(1, pow(sin((radians(52.5) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(52.5)) * pow(sin(radians(13.4 - long) / 2), 2)))), 2) AS feet FROM pl""")
def great_circle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(spark, sf_dir).select("vec_id", F.round(geo.haversine_ft(F.col("lat"), F.col("long"), F.lit(52.5), F.lit(13.4)), 2).alias("feet"))


_B, _F = 6378137.0 * (1 - 1 / 298.257223563), 1 / 298.257223563
_VINCENTY = f"""WITH RECURSIVE {_PLACES}, u AS (
      SELECT vec_id, lat, long, atan({1 - _F} * tan(radians(lat))) AS u1, atan({1 - _F} * tan(radians(52.5))) AS u2,
             radians((13.4 - long + 540) - 360 * floor((13.4 - long + 540) / 360) - 180) AS l FROM pl
    ), it(vec_id, n, lam, ss, cs, ca, cm) AS (
      SELECT vec_id, 0, l, 0.0::DOUBLE, 1.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM u
      UNION ALL
      SELECT vec_id, n + 1, l + (1 - c) * {_F} * sa * (atan2(ss, cs) + c * ss * (cm + c * cs * (2 * cm * cm - 1))), ss, cs, ca, cm FROM (
        SELECT *, {_F / 16} * ca * (4 + {_F} * (4 - 3 * ca)) AS c FROM (
          SELECT *, cs - coalesce(2 * sin(u1) * sin(u2) / nullif(ca, 0), cs) AS cm FROM (
            SELECT *, 1 - sa * sa AS ca FROM (
              SELECT *, coalesce(cos(u1) * cos(u2) * sin(lam) / nullif(ss, 0), 0) AS sa FROM (
                SELECT it.vec_id, n, lam, u1, u2, l, sqrt(pow(cos(u2) * sin(lam), 2) + pow(cos(u1) * sin(u2) - sin(u1) * cos(u2) * cos(lam), 2)) AS ss,
                       sin(u1) * sin(u2) + cos(u1) * cos(u2) * cos(lam) AS cs
                FROM it JOIN u ON it.vec_id = u.vec_id WHERE n < 20)))))
    ), v AS (
      SELECT *, ca * {(6378137.0**2 - _B**2) / _B**2} AS w FROM it WHERE n = 20
    ), g AS (
      SELECT *, 1 + w / 16384 * (4096 + w * (-768 + w * (320 - 175 * w))) AS a, w / 1024 * (256 + w * (-128 + w * (74 - 47 * w))) AS b FROM v
    )
    SELECT vec_id, round({_B * 3.280839895} * a * (atan2(ss, cs) - b * ss * (cm + b / 4 * (cs * (2 * cm * cm - 1) - b / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))), 1) AS feet FROM g"""


@query(_VINCENTY)
def geodesic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feet on the ellipsoid to one place."""
    return _places(spark, sf_dir).select("vec_id", F.round(geo.geodesic_ft(F.col("lat"), F.col("long"), F.lit(52.5), F.lit(13.4)), 1).alias("feet"))


_NEAR = f"""{_PLACES}, {_XYZ}, n AS (SELECT q.vec_id AS meter, c.vec_id AS pole, sqrt(pow(q.x - c.x, 2) + pow(q.y - c.y, 2) + pow(q.z - c.z, 2)) * 3280.84 AS dist_ft FROM xy q, xy c WHERE q.vec_id % 3 = 0 AND c.vec_id % 3 <> 0),
    nr AS (SELECT *, row_number() OVER (PARTITION BY meter ORDER BY dist_ft, pole)::INT AS rank FROM n)"""


def _near(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    places = _places(spark, sf_dir)
    return ties.k_nearest(places.where("vec_id % 3 = 0").withColumnRenamed("vec_id", "meter"), places.where("vec_id % 3 <> 0").withColumnRenamed("vec_id", "pole"), k=k)


@query(f"WITH {_NEAR} SELECT meter, pole, round(dist_ft, 1) AS dist_ft, rank FROM nr WHERE rank <= 10")
def k_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near(spark, sf_dir, 10).withColumn("dist_ft", F.round("dist_ft", 1))


@query(f"WITH {_NEAR} SELECT meter, pole, dense_rank() OVER (PARTITION BY meter ORDER BY dist_ft)::INT AS neighbour FROM nr WHERE rank <= 5")
def neighbour_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ties.neighbour_rank(_near(spark, sf_dir, 5)).select("meter", "pole", "neighbour")


_TIE = f"""{_NEAR}, cd AS (SELECT meter, pole FROM nr WHERE rank <= 5),
    el AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
    ds AS (SELECT meter, pole, (a.i - 1) // 16 AS day, sqrt(greatest(0, 2 - 2 * sum(a.v * b.v) / (sqrt(sum(a.v * a.v)) * sqrt(sum(b.v * b.v))))) AS distance FROM cd JOIN el a ON a.vec_id = meter JOIN el b ON b.vec_id = pole AND a.i = b.i GROUP BY ALL),
    md AS (SELECT meter, pole, quantile_disc(distance, 0.5) AS median_distance, min(distance) AS least_distance FROM ds GROUP BY ALL)"""


def _proposals(spark: SparkSession, sf_dir: str, criterion: str) -> DataFrame:
    """Each vector is four days of 16 slots; the five nearest places are candidates."""
    days = _t(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda d: F.slice("embedding", d * 16 + 1, 16))).alias("day", "curve"))
    distances = ties.candidate_distances(_near(spark, sf_dir, 5), days.withColumnRenamed("vec_id", "meter"), days.withColumnRenamed("vec_id", "pole"))
    best = ties.propose_tie(distances, criterion=criterion)
    return best.select("meter", "pole", F.round("median_distance", 6).alias("median_distance"), F.round("least_distance", 6).alias("least_distance"))


@query(f"WITH {_TIE} SELECT meter, pole, round(median_distance, 6) AS median_distance, round(least_distance, 6) AS least_distance FROM md JOIN (SELECT meter, min(least_distance) AS m FROM md GROUP BY 1) USING (meter) WHERE least_distance = m")
def propose_tie_min_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _proposals(spark, sf_dir, "min_day")


@query(f"WITH {_TIE} SELECT meter, pole, round(median_distance, 6) AS median_distance, round(least_distance, 6) AS least_distance FROM md JOIN (SELECT meter, min(median_distance) AS m FROM md GROUP BY 1) USING (meter) WHERE median_distance = m")
def propose_tie_min_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _proposals(spark, sf_dir, "min_median")


def text_shares(docs: DataFrame) -> DataFrame:
    """doc_id, and of its text the shares of marks, stops and capitals and the logarithm of its length."""
    text = F.col("text")
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    share = lambda kind: F.regexp_count(text, F.lit(kind)) / n
    return docs.select("doc_id", share(r"[|#$%&*!]").alias("marks"), share(r"[.?]").alias("stops"), share(r"[A-Z]").alias("capitals"), F.log1p(n).alias("size"))


@query()
def score_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest that tells labelled documents of low quality apart by simple shares."""
    docs = stage(text_shares(_t(spark, sf_dir, "documents")), "text-shares", lasting=True)  # training reads them many times, and texts once
    names = ["marks", "stops", "capitals", "size"]
    known = docs.join(_t(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("label")), "doc_id")
    train, _ = model.stratified_split(known, "label", "doc_id")
    found = model.train_forest(train, features=names, key="doc_id", folds=2, grid={"numTrees": [20], "maxDepth": [5]})
    return model.score_forest(found, docs, features=names).select("doc_id", "y_pred", F.round("pred_0", 6).alias("pred_0"), F.round("pred_1", 6).alias("pred_1"))


@query("""SELECT o_orderkey, (o_orderstatus = 'F')::INT AS y_pred, (o_orderstatus <> 'F')::INT::DOUBLE AS pred_0, (o_orderstatus = 'F')::INT::DOUBLE AS pred_1 FROM orders""")
def train_and_score_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest on clear cases: each feature alone tells the label, so every tree must, whichever features it is given."""
    final = (F.col("o_orderstatus") == "F").cast("int")
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", final.alias("label"), *[(final * 10 + F.pmod(F.xxhash64(F.lit(k), "o_orderkey"), F.lit(4))).cast("double").alias(name) for k, name in enumerate(model.FEATURES)])
    train, _ = model.stratified_split(orders, "label", "o_orderkey")
    found = model.train_forest(train, key="o_orderkey", folds=2, grid={"numTrees": [10], "maxDepth": [3]})
    return model.score_forest(found, orders).select("o_orderkey", "y_pred", "pred_0", "pred_1")


_BETTER = f"""SELECT md.meter AS serial, md.meter + 1 AS current_pole, (md.meter % 10)::INT AS decile, md.pole AS new_pole, round(least_distance, 6) AS pred_distance, round(median_distance, 6) AS pred_median_distance, round(dist_ft, 1) AS dist_ft, rank, md.meter * 2 AS premise
    FROM md JOIN (SELECT meter, min(least_distance) AS m FROM md GROUP BY 1) b ON md.meter = b.meter AND least_distance = m JOIN nr ON nr.meter = md.meter AND nr.pole = md.pole AND rank <= 5 WHERE md.meter % 10 >= 7"""


@query(f"WITH {_TIE} {_BETTER}")
def re_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suspect meters, the poles near them in the latest of two snapshots, and the pole whose curve fits best."""
    places = _places(spark, sf_dir)
    is_pole = F.col("vec_id") % 3 != 0
    now = places.select(F.col("vec_id").alias("serial"), F.col("vec_id").alias("pole"), F.col("lat").alias("premise_lat"), F.col("long").alias("premise_long"), F.when(is_pole, F.col("lat")).alias("pole_lat"), F.when(is_pole, F.col("long")).alias("pole_long"), F.lit("2024-01-02").alias("asof_dt"))
    before = now.withColumns({"premise_lat": F.lit(0.0), "pole_lat": F.lit(0.0), "asof_dt": F.lit("2024-01-01")})
    days = _t(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda d: F.slice("embedding", d * 16 + 1, 16))).alias("day", "curve"))
    summary = days.select(F.col("vec_id").alias("serial"), F.col("vec_id").alias("pole"), "day", "curve", F.col("curve").alias("group_curve"))
    scores = places.where("vec_id % 3 = 0").select(F.col("vec_id").alias("serial"), (F.col("vec_id") + 1).alias("pole"), ((F.col("vec_id") % 10) / 10).alias("pred_1"), (F.col("vec_id") * 2).alias("premise"))
    found = tie_plan.re_tie(scores, now.unionByName(before), summary, k=5)
    return found.select("serial", "current_pole", "decile", "new_pole", F.round("pred_distance", 6).alias("pred_distance"), F.round("pred_median_distance", 6).alias("pred_median_distance"), F.round("dist_ft", 1).alias("dist_ft"), "rank", "premise")


@query("""SELECT label, (i - 1)::INT AS slot, round(avg(v), 6) AS value FROM (
    SELECT vec_id, label * 1000 + vec_id % 97 AS label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings) JOIN (
    SELECT label * 1000 + vec_id % 97 AS label FROM embeddings GROUP BY 1 HAVING count(DISTINCT vec_id) > 1) USING (label) GROUP BY label, i""")
def group_curve_of_peers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean curves of small groups, without those of one member."""
    small = _t(spark, sf_dir, "embeddings").withColumn("label", (F.col("label") * 1000 + F.col("vec_id") % 97).cast("long"))
    means = peers.group_curve(small, ["label"], curve="embedding", peers_of="vec_id")
    return series.explode_day(means, ["label"], curve="group_curve").withColumn("value", F.round("value", 6))


@query("""SELECT vec_id, (i - 1)::INT AS slot, round(v / n, 6) AS value FROM (
    SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v, sqrt(list_dot_product(list_transform(embedding, lambda x: x::DOUBLE), list_transform(embedding, lambda x: x::DOUBLE))) AS n FROM embeddings)""")
def normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = _t(spark, sf_dir, "embeddings").select("vec_id", vectors.normalize(F.col("embedding")).alias("curve"))
    return series.explode_day(unit, ["vec_id"]).withColumn("value", F.round("value", 6))


# ---- joins with a partner, medians, nulls ---------------------------------------


@query("""SELECT l_orderkey, l_linenumber, l_partkey, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    return joins.attach(_t(spark, sf_dir, "lineitem"), orders, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "o_orderpriority")


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
def exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pending = _t(spark, sf_dir, "orders").where("o_orderstatus = 'P'").withColumnRenamed("o_orderkey", "l_orderkey")
    return joins.exists(_t(spark, sf_dir, "lineitem"), pending, ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("""SELECT o_orderkey, m AS median_o_totalprice FROM orders JOIN (SELECT o_custkey, quantile_disc(o_totalprice, 0.5) AS m FROM orders GROUP BY 1) USING (o_custkey)""")
def attach_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peers.attach_medians(_t(spark, sf_dir, "orders"), ["o_custkey"], ["o_totalprice"]).select("o_orderkey", "median_o_totalprice")


@query("""SELECT event_id FROM events WHERE value > 50 AND user_id % 5 <> 0""")
def drop_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _t(spark, sf_dir, "events").select("event_id", F.when(F.col("value") > 50, F.col("value")).alias("value"), F.when(F.col("user_id") % 5 != 0, F.col("user_id")).alias("user_id"))
    return dedupe.drop_null_rows(events, ["value", "user_id"]).select("event_id")


@query("""SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE::VARCHAR AS day FROM orders""")
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day between the first and the last order."""
    first, last = _t(spark, sf_dir, "orders").agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    return readers.date_range(spark, first, last).select(F.col("day").cast("string").alias("day"))


# ---- files and tables: written in the shared folder and read back ----------------

_ORDER = "o_orderkey long, o_totalprice double, o_orderstatus string, month string"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("month"))


@query("""SELECT event_id, event_type, value FROM events""")
def read_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "delimited")
    _t(spark, sf_dir, "events").select("event_id", "event_type", "value").write.option("sep", "~").csv(path)
    return readers.read_delimited(spark, path, "event_id long, event_type string, value double", sep="~")


_SOME_DAYS = """SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS month FROM orders WHERE o_orderstatus = 'F' AND strftime(o_orderdate, '%Y-%m') BETWEEN '1995-03' AND '1996-11'"""


def _some_days(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    path = new_folder(spark, f"orders-{fmt}")
    writers.write_partitioned(_orders(spark, sf_dir), path, ["o_orderstatus", "month"], sort=["o_orderkey"], fmt=fmt, blooms={"o_orderkey": 1000})
    return readers.read_days(spark, path, _ORDER, "1995-03", "1996-11", day="month", fmt=fmt, o_orderstatus="F").select("o_orderkey", "o_totalprice", "month")


@query(_SOME_DAYS)
def read_days_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _some_days(spark, sf_dir, "parquet")


@query(_SOME_DAYS)
def read_days_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _some_days(spark, sf_dir, "orc")


@query("""SELECT o_orderkey, (year(o_orderdate) || '0101_000000') AS run_dt FROM orders WHERE year(o_orderdate) > 1995""")
def read_new_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each year's orders are a run; those up to 1995 have been read."""
    path = new_folder(spark, "runs")
    runs = _t(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.year("o_orderdate").cast("string"), F.lit("0101_000000")).alias("run_dt"))
    writers.write_partitioned(runs, path, ["run_dt"], fmt="orc")
    return readers.read_new_runs(spark, path, "o_orderkey long, run_dt string", mark="19950101_000000")[0]


@query("""SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m') AS month FROM orders""")
def with_path_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "by-path")
    writers.write_partitioned(_orders(spark, sf_dir), path, ["o_orderstatus", "month"])
    files = spark.read.schema("o_orderkey long").option("recursiveFileLookup", "true").parquet(path)
    return readers.with_path_partitions(files, ["o_orderstatus", "month"]).select("o_orderkey", "o_orderstatus", "month")


@query("""SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P')""")
def existing_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "existing")
    writers.write_partitioned(_orders(spark, sf_dir), path, ["o_orderstatus"])
    return spark.read.schema("o_orderkey long").parquet(*readers.existing_paths(spark, [f"{path}/o_orderstatus={x}" for x in ("F", "none", "P")]))


@query("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 0""")
def write_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second write replaces the partitions that it has rows for, and no others."""
    path, orders = new_folder(spark, "replaced"), _orders(spark, sf_dir).drop("month")
    writers.write_partitioned(orders, path, ["o_orderstatus"], sort=["o_orderkey"], spread=3, max_records=10_000)
    writers.write_partitioned(orders.where("o_orderstatus = 'F' and o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2), path, ["o_orderstatus"])
    return readers.read_partitions(spark, path, "o_orderkey long, o_totalprice double, o_orderstatus string")


@query("""SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'""")
def append_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, orders = new_folder(spark, "appended"), _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    for part in (orders, orders.where("o_orderstatus = 'P'")):
        writers.write_partitioned(part, path, ["o_orderstatus"], fmt="orc", mode="append")
    return readers.read_partitions(spark, path, "o_orderkey long, o_orderstatus string", fmt="orc")


@query("""SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0""")
def write_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, customers = new_folder(spark, "plain"), _t(spark, sf_dir, "customer")
    writers.write_plain(customers.select("c_custkey", "c_name"), path)
    writers.write_plain(customers.where("c_acctbal > 0").select("c_custkey", "c_name"), path)
    return spark.read.schema("c_custkey long, c_name string").parquet(path)


@query("""SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey""")
def write_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report in order, as one text file with a header."""
    path = new_folder(spark, "report")
    writers.write_report(conform.count_by(_t(spark, sf_dir, "orders"), "o_custkey").orderBy("o_custkey"), path)
    return spark.read.schema("o_custkey long, n long").option("header", True).csv(path)


def _stored(df: DataFrame, *partition: str) -> str:
    """The name of a new table of df in the shared folder."""
    name = f"wattloom_{uuid.uuid4().hex}"
    df.write.partitionBy(*partition).option("path", new_folder(df.sparkSession, "table")).saveAsTable(name)
    return name


@query("""SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment ELSE 'LATE' END AS segment FROM customer""")
def insert_into(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_mktsegment").alias("segment"))
    name = _stored(customers.where("segment = 'BUILDING'"), "segment")
    writers.insert_into(customers.where("segment <> 'BUILDING'").select("c_name", "c_custkey"), name, segment="LATE")
    return spark.table(name).select("c_custkey", "c_name", "segment")


@query("""SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'""")
def truncate_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _stored(_t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment")
    writers.truncate_partition(spark, name, c_mktsegment="BUILDING")
    return spark.table(name)


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders WHERE strftime(o_orderdate, '%Y-%m') >= '1996-02'""")
def drop_old_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _stored(_orders(spark, sf_dir).select("o_orderkey", "month"), "month")
    writers.drop_old_partitions(spark, name, "month", "1996-02", dry_run=False)
    return spark.table(name)


@query("""SELECT c_custkey, c_mktsegment FROM customer""")
def sync_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions that were written as files, behind the catalogue's back."""
    customers = _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    name = _stored(customers.where("c_mktsegment = 'BUILDING'"), "c_mktsegment")
    path = spark.sql(f"DESCRIBE FORMATTED {name}").where("col_name = 'Location'").first()["data_type"]
    customers.where("c_mktsegment <> 'BUILDING'").write.mode("append").partitionBy("c_mktsegment").parquet(path)
    writers.sync_partitions(spark, name)
    return spark.table(name)


@query("""SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'P')""")
def union_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    writers.union_view({"F": orders, "P": orders}, "wattloom_by_status", column="o_orderstatus")
    return spark.table("wattloom_by_status")


@query("""SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'P'""")
def current_run_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one status are the run."""
    runs = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.col("o_orderstatus").alias("run_dt"))
    writers.current_run_view(runs, "P", "wattloom_run", order=("o_orderpriority", "o_orderkey"))
    return spark.table("wattloom_run").select("o_orderkey", "o_orderpriority")


@query(f"WITH {_RULES_SQL} SELECT event_id, regex_id, curated_reason FROM cl")
def classify_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event files taken up as a stream, classified, and merged into a table by day."""
    source, out, marks = (new_folder(spark, n) for n in ("event-files", "event-table", "stream-marks"))
    events = _reasons(spark, sf_dir).join(_t(spark, sf_dir, "events").select("event_id", F.to_date("ts").cast("string").alias("day"), "ts"), "event_id")
    events.write.parquet(source)
    event_stream.classify_stream(spark, source, events.schema, _rules(spark), out, marks, key=["event_id"], order="ts", partition=["day"]).awaitTermination()
    return spark.read.parquet(out).select("event_id", "regex_id", "curated_reason")


from . import run_queries  # noqa: E402, F401  registers more

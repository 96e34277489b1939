"""Every registered query of the library against its SQL in DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from wattloom.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def sql():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


def _cell(v):
    if v is None or v != v:
        return None
    return round(float(v), 4) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(([_cell(r[c]) for c in columns] for r in df.collect()), key=str)
    if name not in ORACLE_SQL:
        assert got
        return
    result = sql.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(([_cell(r[names.index(c)]) for c in columns] for r in result.fetchall()), key=str)
    assert got == want


def test_median_of_a_hot_user_is_exact(spark, tmp_path):
    n = 400_000
    values = spark.range(n).selectExpr("1L AS user_id", "'a' AS event_type", f"CAST((id * 7919) % {n} AS DOUBLE) AS value")
    values.write.parquet(f"{tmp_path}/events.parquet")
    assert [r["median_value"] for r in QUERIES["median_by_user"](spark, str(tmp_path)).collect()] == [n // 2 - 1]

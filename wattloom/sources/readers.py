"""Reading declared schemas from files, partitions, new runs and databases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.back import join_back

def read_delimited(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str, *, sep: str = ",", header: bool = False) -> DataFrame:
    """Text with a declared schema; any separator, any number of paths."""
    return spark.read.schema(schema).option("sep", sep).option("header", header).csv(paths if isinstance(paths, str) else list(paths))


def read_partitions(spark: SparkSession, root: str, schema: T.StructType | str, *, fmt: str = "parquet", where: Column | str | None = None) -> DataFrame:
    """A partitioned table, with a filter on partition columns that prunes directories."""
    df = spark.read.schema(schema).format(fmt).load(root)
    return df.where(where) if where is not None else df


def read_days(spark: SparkSession, root: str, schema: T.StructType | str, first: str, last: str, *, day: str = "usage_dt", fmt: str = "parquet", **equal: str) -> DataFrame:
    """Days first to last, both included, of the partitions that equal the given values."""
    df = read_partitions(spark, root, schema, fmt=fmt, where=F.col(day).between(first, last))
    for name, value in equal.items():
        df = df.where(F.col(name) == value)
    return df


def read_new_runs(spark: SparkSession, root: str, schema: T.StructType | str, *, mark: str | None = None, run: str = "run_dt", fmt: str = "orc") -> tuple[DataFrame, str | None]:
    """Rows of runs after the mark, all without one, and the greatest run.

    Runs are named yyyyMMdd_HHmmss, so they compare as text.  The second value is
    the mark to store once the rows have been dealt with.
    """
    df = read_partitions(spark, root, schema, fmt=fmt)
    new = df.where(F.col(run).cast("string") > mark) if mark else df
    return new, new.agg(F.max(F.col(run).cast("string"))).first()[0] or mark


def with_path_partitions(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns from name=value segments of the file's path, wherever they stand."""
    path = F.col("_metadata.file_path")
    found = {n: F.regexp_extract(path, rf"/{n}=([^/]+)", 1) for n in names}
    return df.withColumns({n: F.when(v != "", F.url_decode(v)) for n, v in found.items()})


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that there are, on any file system that Spark can read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = [(p, jvm.org.apache.hadoop.fs.Path(p)) for p in paths]
    return [p for p, h in at if h.getFileSystem(conf).exists(h)]


def _literal(value: object) -> str:
    return str(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else "'" + str(value).replace("'", "''") + "'"


def company_query(table: str, columns: Sequence[str], *, column: str, codes: Sequence[object], quote: str = '"') -> str:
    """A query of a table's columns, filtered by company codes in the database; no codes, no rows."""
    name = lambda c: f"{quote}{c.replace(quote, quote * 2)}{quote}"
    where = f"{name(column)} IN ({', '.join(map(_literal, codes))})" if codes else "1 = 0"
    return f"SELECT {', '.join(map(name, columns))} FROM {table} WHERE {where}"


def jdbc_options(url: str, query: str, *, driver: str | None = None, fetch_size: int = 10_000, column: str | None = None, bounds: tuple[object, object] | None = None, partitions: int = 8, properties: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of a read whose query runs in the database, by several connections if it has a column to split on."""
    options = {"url": url, "dbtable": f"({query}) q", "fetchsize": str(fetch_size)} | ({"driver": driver} if driver else {})
    if column and bounds:
        options |= {"partitionColumn": column, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]), "numPartitions": str(partitions)}
    return options | dict(properties or {})


def read_jdbc(spark: SparkSession, *, url: str, query: str, column: str | None = None, bounds: tuple[object, object] | None = None, partitions: int = 8, even: bool = False, quote: str = '"', **options) -> DataFrame:
    """The rows of a query that runs in the database; filters and columns that are asked of the result go there as well.

    column: it is read in `partitions` ranges of this column, each by a connection of its
    own; rows where it is null come with the first.  Without bounds the database is asked
    for the least and the greatest value.  Ranges have the same width, so where values
    crowd, even=True deals whole numbers by their remainder instead.
    """
    if column and even:
        name = quote + column.replace(quote, quote * 2) + quote
        predicates = [f"ABS(MOD({name}, {partitions})) = {k}" + (f" OR {name} IS NULL" if not k else "") for k in range(partitions)]
        made = jdbc_options(url, query, **options)
        return spark.read.jdbc(made.pop("url"), made.pop("dbtable"), predicates=predicates, properties=made)
    if column and bounds is None:
        name = quote + column.replace(quote, quote * 2) + quote
        ends = spark.read.format("jdbc").options(**jdbc_options(url, f"SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM ({query}) b", **options)).load().first()
        bounds = None if ends[0] is None else (ends[0], ends[1])
    return spark.read.format("jdbc").options(**jdbc_options(url, query, column=column, bounds=bounds, partitions=partitions, **options)).load()


def latest_snapshot(df: DataFrame, as_of: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of the latest as-of date, of all or of each key: one plan, no action.  A null key is a key; a row without a date is never the latest."""
    if keys:
        latest = df.groupBy(*keys).agg(F.max(as_of).alias("__latest"))
        return join_back(df, latest, keys).where(F.col(as_of) == F.col("__latest")).drop("__latest")
    latest = df.agg(F.max(as_of).alias("__latest"))
    return df.join(F.broadcast(latest), F.col(as_of) == F.col("__latest"), "left_semi")  # one row


def date_range(spark: SparkSession, first: str | date, last: str | date, out: str = "day") -> DataFrame:
    """Every day from first to last."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date"), F.expr("interval 1 day"))).alias(out))


def distinct_dates(df: DataFrame, day: str, before: str, out: str | None = None) -> DataFrame:
    return df.where(F.col(day) < before).select(F.col(day).alias(out or day)).distinct()


def dates_text(days: DataFrame, day: str) -> DataFrame:
    """One row: the dates, quoted and in order."""
    return days.agg(F.array_join(F.transform(F.array_sort(F.collect_set(F.col(day).cast("string"))), lambda d: F.concat(F.lit("'"), d, F.lit("'"))), ",").alias("dates"))


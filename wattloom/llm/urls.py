"""URL filters: host-suffix and path-prefix rules, matched by hash prefixes.

Every distinct URL is expanded into the (host suffix, path prefix) expressions
that a rule could have, each expression is hashed, and the hashes are joined with
the rules' on their first bytes.  A hit counts once the full digests agree.  Of
the rules that fit a URL, the longest wins.  Built-in functions only.

Edge cases: a null URL, or one without "://", has an empty host and path and
meets no rule.  A rule that is given twice counts once; of equal rules with
different verdicts, block wins.  Repeated rows each get the verdict of their URL.  No rules: every
URL gets the default.  Columns of the input other than the URL are kept as they
are, whatever their names, unless they are named like a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))


def url_host(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """From the host's end up to "?", "#" or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def make_rules(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(verdict, "host/path") pairs as a rules table: verdict, rule, host, path."""
    rows = [(verdict, rule, rule.partition("/")[0].translate(str.maketrans(UPPER, LOWER)), "/" + rule.partition("/")[2]) for verdict, rule in rules]
    return spark.createDataFrame(rows, "verdict string, rule string, host string, path string")


def _expression(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def filter_urls(pages: DataFrame, rules: DataFrame, *, url: str = "url", prefix_chars: int = 8, default: str = "allow") -> DataFrame:
    """pages with host, path, rule and verdict.

    rules: verdict, rule (its name), host, path, a path that starts with "/" or
    is empty.  prefix_chars: hexadecimal digits of the digest that are joined on.
    The shapes of rules (labels and characters) are a list in the plan; it has a row
    for each pair of them that occurs, however many rules there are.
    The pages' shuffles carry distinct URLs and (for the way back) the kept columns.
    """
    distinct = (
        pages.where(F.col(f"`{url}`").isNotNull())
        .select(F.col(f"`{url}`").alias("__url"))
        .distinct()
        .select("__url", url_host(F.col("__url")).alias("host"), url_path(F.col("__url")).alias("path"))
    )
    rules = (
        rules.groupBy("host", "path")
        .agg(F.max(F.struct("verdict", "rule")).alias("r"))
        .select("host", "path", "r.verdict", "r.rule", F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars"))
        .withColumn("digest", _expression(F.col("host"), F.col("path")))
        .withColumn("short", F.substring("digest", 1, prefix_chars))
    )
    # The expressions that rules have: so many labels of the host, so many characters of the path.
    shapes = rules.agg(F.array_sort(F.collect_set(F.struct("labels", "chars"))).alias("shapes"))
    shapes = [(s["labels"], s["chars"]) for s in shapes.first()["shapes"]]
    kinds = F.array(*[F.struct(F.lit(a).alias("labels"), F.lit(b).alias("chars")) for a, b in shapes]) if shapes else F.expr("cast(array() as array<struct<labels:int,chars:int>>)")
    expanded = (
        distinct.where((F.col("host") != "") | (F.col("path") != ""))
        .withColumn("n_labels", F.size(F.split("host", r"\.")))
        .withColumn("n_chars_", F.length("path"))
        .select("__url", "host", "path", F.explode(F.filter(kinds, lambda s: (s["labels"] <= F.col("n_labels")) & (s["chars"] <= F.col("n_chars_")))).alias("s"))
        .select("__url", F.expr("substring_index(host, '.', -s.labels)").alias("h"), F.expr("substring(path, 1, s.chars)").alias("p"))
        .withColumn("full", _expression(F.col("h"), F.col("p")))
        .withColumn("short", F.substring("full", 1, prefix_chars))
    )
    hits = (
        expanded.join(rules.select("short", "digest", "verdict", "rule", "host", "path"), "short")
        .where((F.col("full") == F.col("digest")) & (F.col("h") == F.col("host")) & (F.col("p") == F.col("path")))
        .groupBy("__url")
        .agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.length(F.concat("host", "path")), F.length("host"))).alias("__hit"))
    )
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    left = pages.select(*kept)
    key, hit, spread = fresh(left, "__url", "__hit", "__spread")
    # The hits' key is no longer known to be what they lie by, so both sides are dealt and a frequent URL's
    # pages can be split; pages without a URL, which have no hit, are dealt by number.
    told = hits.select(F.concat("__url", F.lit("")).alias(key), F.lit(0).alias(spread), F.col("__hit").alias(hit))
    number = F.when(F.col(f"`{url}`").isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(4096)).cast("int")).otherwise(0)
    joined = left.withColumns({key: F.col(f"`{url}`"), spread: number}).join(told, [key, spread], "left")
    found = {"host": url_host(F.col(key)), "path": url_path(F.col(key)), "rule": F.col(f"{hit}.rule"), "verdict": F.coalesce(F.col(f"{hit}.verdict"), F.lit(default))}
    return joined.select(*kept, *[c.alias(n) for n, c in found.items()])

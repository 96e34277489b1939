"""Classification of free text by a table of regular expressions.

Rules: regex_id, event_type, search, replacement, pivot_id, status, title.  The
rules of each event type are one array, and each event meets the array of its type:
nothing runs once per type, and no event is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A rule table of up to so many rows is sent to all executors; a larger one is joined on the event type.
BROADCAST_RULES = 20_000

RULES = "regex_id string, event_type string, seq string, search string, replacement string, pivot_group long, pivot_id string, print_order long, status string, descr string, title string"


def load_rules(raw: DataFrame, *, active: Sequence[str] | None = None) -> DataFrame:
    """Distinct rules; a null replacement is the empty string."""
    rules = raw.withColumn("replacement", F.coalesce("replacement", F.lit(""))).distinct()
    return rules.where(F.col("status").isin(list(active))) if active else rules


def split_patterns(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rules whose pattern compiles, and the others with what is wrong (problem); one check for each different pattern.

    The patterns, not the rules' other columns, go to the driver, where Java
    compiles them as the executors would.
    """
    spark = rules.sparkSession
    compiler = spark.sparkContext._jvm.java.util.regex.Pattern

    def problem(pattern: str | None) -> str | None:
        if not pattern:
            return "empty pattern"
        try:
            compiler.compile(pattern)
        except Exception as e:  # py4j wraps what Java throws
            return str(getattr(e, "java_exception", e)).splitlines()[0]
        return None

    found = [(r["search"], problem(r["search"])) for r in rules.select("search").distinct().collect()]
    wrong = spark.createDataFrame([(p or "", why) for p, why in found if why], "__search string, problem string").distinct()
    key = F.coalesce("search", F.lit(""))
    good = rules.join(F.broadcast(wrong), key == F.col("__search"), "left_anti")  # a part of a rule table
    return good, rules.join(F.broadcast(wrong), key == F.col("__search")).drop("__search")


def _by_type(rules: DataFrame) -> DataFrame:
    """(__type, __rules): the rules of each event type, in order of regex_id as text."""
    each = rules.select(F.col("event_type").alias("__type"), F.struct("regex_id", "search", "replacement").alias("r"))
    arrays = each.groupBy("__type").agg(F.array_sort(F.collect_list("r")).alias("__rules"))
    return F.broadcast(arrays) if rules.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES else arrays


def matched(events: DataFrame, rules: DataFrame, *, key: Sequence[str], event_type: str = "event_type", reason: str = "reason") -> DataFrame:
    """Events of a known type with __matches: regex_id and curated_reason of each rule whose pattern finds something that is not empty.

    In order of regex_id as text; an event whose key holds a null has none.
    """
    text = F.col(f"`{reason}`")
    hits = F.filter("__rules", lambda r: F.call_function("regexp_extract", text, r["search"], F.lit(0)) != "")
    found = F.array_sort(F.transform(hits, lambda r: F.struct(r["regex_id"].alias("regex_id"), F.regexp_replace(text, r["search"], r["replacement"]).alias("curated_reason"))))
    whole = reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in key])
    none = F.array().cast("array<struct<regex_id:string,curated_reason:string>>")
    joined = events.join(_by_type(rules), F.col(f"`{event_type}`") == F.col("__type"))
    return joined.select(*[F.col(f"`{c}`") for c in events.columns], F.when(whole, F.coalesce(found, none)).otherwise(none).alias("__matches"))


def matches(events: DataFrame, rules: DataFrame, *, event_type: str = "event_type", reason: str = "reason", key: Sequence[str]) -> DataFrame:
    """A row for each event and rule of its type whose pattern finds something that is not empty."""
    return matched(events, rules, key=key, event_type=event_type, reason=reason).select(*key, F.inline("__matches"))


def first_match(found: DataFrame) -> DataFrame:
    """Of matched events, those with a match, and the first rule's regex_id and curated_reason."""
    kept = [F.col(f"`{c}`") for c in found.columns if c != "__matches"]
    return found.select(*kept, F.inline(F.slice("__matches", 1, 1)))  # a filter would be pushed down and match a second time


def no_match(found: DataFrame) -> DataFrame:
    """Of matched events, those without a match, with the error."""
    return found.where(F.size("__matches") == 0).drop("__matches").withColumn("error", F.lit("no_regex_applied"))


def classify(events: DataFrame, rules: DataFrame, *, key: Sequence[str], event_type: str = "event_type", reason: str = "reason") -> DataFrame:
    """Events of a known type with the first matching rule (by regex_id as text): regex_id and curated_reason."""
    return first_match(matched(events, rules, key=key, event_type=event_type, reason=reason))


def classify_all(events: DataFrame, rules: DataFrame, *, key: Sequence[str], event_type: str = "event_type", reason: str = "reason") -> DataFrame:
    """Key and all matches in order of regex_id."""
    found = matched(events, rules, key=key, event_type=event_type, reason=reason)
    return found.where(F.size("__matches") > 0).select(*key, F.col("__matches").alias("matches"))


def unmatched(events: DataFrame, rules: DataFrame, *, key: Sequence[str], event_type: str = "event_type", reason: str = "reason") -> DataFrame:
    """Events of a known type that no rule matches, or whose key holds a null."""
    return no_match(matched(events, rules, key=key, event_type=event_type, reason=reason))


def unknown_type(events: DataFrame, rules: DataFrame, *, event_type: str = "event_type") -> DataFrame:
    types = rules.select(F.col("event_type").alias(event_type)).distinct()
    return events.join(types, event_type, "left_anti").withColumn("error", F.concat_ws("|", F.lit("new event type"), F.col(event_type)))


def with_titles(classified: DataFrame, rules: DataFrame) -> DataFrame:
    """pivot_id of the rule whose id and trimmed title equal the event's; null if there is none."""
    titles = rules.select(F.col("regex_id").alias("__id"), F.trim("title").alias("__title"), "pivot_id").distinct()
    return classified.join(titles, (F.col("regex_id") == F.col("__id")) & (F.trim("curated_reason") == F.col("__title")), "left").drop("__id", "__title")


def unknown_title(classified: DataFrame, rules: DataFrame) -> DataFrame:
    found = with_titles(classified, rules).where("pivot_id is null").drop("pivot_id")
    return found.withColumn("error", F.concat_ws("|", F.lit("new report title"), F.col("curated_reason")))

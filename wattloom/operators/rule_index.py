"""Matching by very many rules, through an index of what their patterns require.

A pattern like `meter .* failed: [0-9]+` can't match a text without `failed: `.  Of each rule's longest
required run of plain characters, the four that the fewest rules share are its gram; an event
meets only the rules of its type whose gram its text holds, by an equi-join on type
and gram.  Rules whose pattern requires no four characters in a row are tried on all events
of their type, as rules.matched does.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import rules as rule_ops

GRAM = 4
#: An index of up to so many rows is sent to all tasks; events are shuffled by gram for a larger one.
BROADCAST_INDEX = 200_000


def _skip_class(pattern: str, i: int) -> int:
    """The place after the character class that begins at i."""
    depth, i = 1, i + 1
    if i < len(pattern) and pattern[i] == "^":
        i += 1
    if i < len(pattern) and pattern[i] == "]":
        i += 1
    while i < len(pattern) and depth:
        depth += {"[": 1, "]": -1}.get(pattern[i], 0)
        i += 2 if pattern[i] == "\\" else 1
    return i


def _skip_group(pattern: str, i: int) -> int:
    """The place after the group that begins at i."""
    depth, i = 1, i + 1
    while i < len(pattern) and depth:
        if pattern[i] == "[":
            i = _skip_class(pattern, i)
            continue
        depth += {"(": 1, ")": -1}.get(pattern[i], 0)
        i += 2 if pattern[i] == "\\" else 1
    return i


def required_literal(pattern: str) -> str:
    """The longest run of plain characters that every match holds, as far as it can be told; '' if none can.

    It leans to the short side: groups, classes and what may be missing end a run, and
    patterns with flags, lookarounds, quoting, numbered or named characters have none.
    """
    if "(?" in pattern or any(f"\\{c}" in pattern for c in "QExuUpPckN0"):
        return ""
    runs, run, i, n = [], "", 0, len(pattern)
    while i < n:
        c = pattern[i]
        atom = ""
        if c == "|" or c in "*+?{":
            return ""
        if c == "(":
            i = _skip_group(pattern, i)
        elif c == "[":
            i = _skip_class(pattern, i)
        elif c == "\\":
            atom = "" if pattern[i + 1 : i + 2].isalnum() else pattern[i + 1 : i + 2]
            i += 2
        else:
            atom = "" if c in ".^$" else c
            i += 1
        many = pattern[i : i + 1]
        if many in ("*", "?", "{"):
            atom = ""
            i = pattern.find("}", i) + 1 if many == "{" else i + 1
            if not i:
                return ""
        elif many == "+":
            i += 1
        if many in ("*", "?", "{", "+") and many and pattern[i : i + 1] in ("?", "+"):
            i += 1  # as few or as many as there are
        if atom:
            run += atom
        if not atom or many == "+":
            runs.append(run)
            run = ""
    return max([*runs, run], key=len)


def indexed(rules: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rules with their gram, and rules without one."""
    literal = F.udf(lambda p: required_literal(p or ""), "string")  # once for each rule
    told = stage(rules.select("regex_id", "event_type", "search", "replacement").distinct().withColumn("literal", literal("search")).withColumn("__rule", F.monotonically_increasing_id()), "rules")
    long = told.where(F.length("literal") >= GRAM)
    grams = long.select("__rule", "event_type", F.explode(F.array_distinct(_grams(F.col("literal")))).alias("gram"))
    common = grams.groupBy("event_type", "gram").agg(F.count("*").alias("n"))
    rarest = grams.join(common, ["event_type", "gram"]).groupBy("__rule").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    return stage(long.join(rarest, "__rule").drop("__rule", "literal"), "rule-index"), told.where(F.length("literal") < GRAM).drop("__rule", "literal")


def _grams(text: Column) -> Column:
    places = F.when(F.length(text) >= GRAM, F.sequence(F.lit(1), F.length(text) - GRAM + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda k: F.substring(text, k, F.lit(GRAM)))


def matched(events: DataFrame, rules: DataFrame, *, key: Sequence[str], event_type: str = "event_type", reason: str = "reason") -> DataFrame:
    """rules.matched, for tables of very many rules: the same events, with the same __matches."""
    known, rest = indexed(rules)
    numbered = stage(events.withColumn("__event", F.monotonically_increasing_id()), "events")
    text, kind = F.col(f"`{reason}`"), F.col(f"`{event_type}`")
    whole = reduce(Column.__and__, [F.col(f"`{k}`").isNotNull() for k in key])
    held = numbered.where(whole).select("__event", kind.alias("__kind"), text.alias("__text"), F.explode(F.array_distinct(_grams(text))).alias("__gram"))
    small = known.limit(BROADCAST_INDEX + 1).count() <= BROADCAST_INDEX
    met = held.join(F.broadcast(known) if small else known, (F.col("__kind") == F.col("event_type")) & (F.col("__gram") == F.col("gram")))
    hits = met.where(F.call_function("regexp_extract", "__text", "search", F.lit(0)) != "")
    found = hits.groupBy("__event").agg(F.collect_list(F.struct("regex_id", F.regexp_replace("__text", F.col("search"), F.col("replacement")).alias("curated_reason"))).alias("__more"))

    none = F.array().cast("array<struct<regex_id:string,curated_reason:string>>")
    tried = rule_ops.matched(numbered, rest, key=key, event_type=event_type, reason=reason).select("__event", "__matches")
    types = rules.select(F.col("event_type").alias("__type")).distinct()
    here = numbered.join(types, kind == F.col("__type"), "left_semi").join(tried, "__event", "left").join(found, "__event", "left")
    both = F.array_sort(F.concat(F.coalesce("__matches", none), F.coalesce("__more", none)))
    return here.select(*[F.col(f"`{c}`") for c in events.columns], both.alias("__matches"))

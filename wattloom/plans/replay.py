"""Judging stored events again when the rule table changes: just those that the change can move.

An event is stored as classified (regex_id, curated_reason) or in quarantine (error).  Of the rules,
some are gone and some are fresh; a changed rule is both.

- In quarantine, no rule that stayed matches, so only fresh rules of an event's type
  are tried; and an event of an unknown type moves when its type becomes known, one of a
  known type when its type is known no more.
- A classified event whose rule is gone is judged by all rules anew.
- One whose rule stayed has a match with that rule, and none with rules that stayed and come
  before it, so only fresh rules that come before it are tried.

All others stay as they are, unread but for their type and rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import rules as rule_ops
from ..session import stage

USED = ["regex_id", "event_type", "search", "replacement"]


@dataclass
class Judged:
    classified: DataFrame
    quarantine: DataFrame  # with error
    wrong_rules: DataFrame


def judge(events: DataFrame, rules: DataFrame, *, key: Sequence[str]) -> Judged:
    """Each event by all rules: classified, or in quarantine with its error."""
    known, wrong = rule_ops.split_patterns(rule_ops.load_rules(rules))
    found = stage(rule_ops.matched(events, known, key=key), "matched")
    return Judged(rule_ops.first_match(found), rule_ops.no_match(found).unionByName(rule_ops.unknown_type(events, known)), wrong)


def changes(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rules that are gone and rules that are fresh, by what decides a match and its text."""
    mine, theirs = (rule_ops.load_rules(r).select(*USED).distinct() for r in (old, new))
    return mine.exceptAll(theirs), theirs.exceptAll(mine)


def replay(classified: DataFrame, quarantine: DataFrame, old: DataFrame, new: DataFrame, *, key: Sequence[str]) -> Judged:
    """What judge would make of all events with the new rules; classified and quarantine: what it made of them with the old."""
    before, _ = rule_ops.split_patterns(rule_ops.load_rules(old))
    after, wrong = rule_ops.split_patterns(rule_ops.load_rules(new))
    gone, fresh = (stage(d, "rule-changes") for d in changes(before, after))
    after = stage(after, "rules")
    types = lambda d: d.select("event_type").distinct()
    events = [c for c in quarantine.columns if c != "error"]

    # Which classified events can move: their rule is gone, or a fresh rule of their type comes before it.
    lost = classified.join(gone.select("event_type", "regex_id").distinct(), ["event_type", "regex_id"], "left_semi")
    stayed = classified.join(gone.select("event_type", "regex_id").distinct(), ["event_type", "regex_id"], "left_anti")
    least = fresh.groupBy("event_type").agg(F.min("regex_id").alias("__least"))
    open_ = stayed.join(F.broadcast(least), "event_type", "left")  # a row for each event type
    fixed = open_.where("__least IS NULL OR __least >= regex_id").select(*classified.columns)
    tried = open_.where("__least < regex_id").select(*classified.columns)
    kept_rule = tried.withColumnsRenamed({"regex_id": "__id", "curated_reason": "__text"})
    again = stage(rule_ops.matched(kept_rule, fresh, key=key), "tried")
    first = F.get("__matches", F.lit(0))
    better = first.isNotNull() & (first["regex_id"] < F.col("__id"))
    moved = {"regex_id": F.when(better, first["regex_id"]).otherwise(F.col("__id")), "curated_reason": F.when(better, first["curated_reason"]).otherwise(F.col("__text"))}
    tried = again.withColumns(moved).select(*classified.columns)

    # Which quarantined events can move: their type has fresh rules, or is known from now on, or no more.
    was, now = types(before), types(after)
    turned = was.exceptAll(now).unionByName(now.exceptAll(was)).unionByName(types(fresh)).distinct()
    rest = quarantine.join(turned, "event_type", "left_anti").select(*quarantine.columns)
    waiting = quarantine.join(turned, "event_type", "left_semi").select(*events)
    known = stage(rule_ops.matched(waiting, fresh.unionByName(after.join(types(fresh), "event_type", "left_anti").select(*USED)), key=key), "waiting")
    judged = judge(lost.select(*events), after, key=key)
    order = classified.columns
    return Judged(
        fixed.unionByName(tried).unionByName(rule_ops.first_match(known).select(*order)).unionByName(judged.classified.select(*order)),
        rest.unionByName(rule_ops.no_match(known)).unionByName(rule_ops.unknown_type(waiting, after)).unionByName(judged.quarantine).select(*quarantine.columns),
        wrong,
    )

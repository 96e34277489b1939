"""From device events to classified events, errors and one-hot features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dedupe, features, joins, peers, rules
from ..session import stage

KEY = ["tracking_id", "serial", "event_time", "event_type"]


def classify_events(incoming: DataFrame, stored: DataFrame | None, premises: DataFrame, rule_table: DataFrame, *, key: Sequence[str] = KEY, partition: Sequence[str] = ("opco", "event_dt"), order: str = "update_dttm") -> dict[str, DataFrame]:
    """classified, and the two kinds of errors, of the partitions that the batch touches; and wrong_rules, whose patterns don't compile and aren't used."""
    if stored is None:
        merged = dedupe.dedupe_latest(incoming, key, order)
    else:
        merged = dedupe.merge_incremental(stored, incoming, key, order=order, partition=partition)
    placed = joins.enrich(merged, peers.distinct_group_size(premises, ["pole"], "serial"), ["serial"])
    known, wrong = rules.split_patterns(rules.load_rules(rule_table))
    found = stage(rules.matched(placed, known, key=key), "matched")  # each event is matched once
    return {
        "classified": rules.first_match(found),
        "unmatched": rules.no_match(found),
        "unknown_type": rules.unknown_type(placed, known),
        "wrong_rules": wrong,
    }


def feature_table(classified: DataFrame, rule_table: DataFrame, *, key: Sequence[str] = KEY, order: str = "update_dttm") -> tuple[DataFrame, DataFrame]:
    """One-hot rows of events whose text is a rule's title, and the errors of the others."""
    latest = dedupe.dedupe_latest(classified, key, order)
    ids = features.pivot_ids(rule_table)
    titled = rules.with_titles(latest, rule_table).where(F.col("pivot_id").isNotNull())
    return features.one_hot(titled, ids).na.fill(0), rules.unknown_title(latest, rule_table)

"""From interval readings and the meter map to scored and proposed ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import conform, peers, series, ties
from ..session import stage
from ..sources import readers


def meter_map(gis: DataFrame, premises: DataFrame, addresses: DataFrame | None = None, *, required: Sequence[str] = ("premise", "pole", "premise_long", "premise_lat")) -> tuple[DataFrame, DataFrame]:
    """Valid map rows with their meters' serials (and addresses), and the invalid rows."""
    good, bad = conform.split_valid(gis, required)
    linked = good.distinct().join(premises, "premise")
    if addresses is not None:
        linked = linked.join(addresses.distinct(), "serial", "left")
    return linked, bad


def voltage_summary(readings: DataFrame, mapping: DataFrame, *, expected: int = 96, minutes: int = 15, value: str = "value") -> DataFrame:
    """One row for each meter and complete day: curves, comparison with peers, z-scores, medians.

    readings: serial, channel, uom, ts, value.  mapping: serial, pole, asof_dt and
    what else is to be kept; its latest snapshot counts.
    """
    keys = ["serial", "day", "channel", "uom"]
    slots = conform.with_slots(readings, minutes=minutes, value=value)
    days = series.pivot_day(series.keep_complete(slots, keys, value=value, expected=expected), keys, value=value)
    current = readers.latest_snapshot(mapping, "asof_dt")
    tied = days.join(peers.group_size(current, ["pole"]), "serial")
    summary = peers.peer_score(tied, ["pole", "day"], "serial")
    whole = peers.group_curve(tied, ["pole", "day"])
    medians = ["distance", "mismatch", "distance_z"]
    return peers.attach_medians(summary.join(whole, ["pole", "day"], "left"), ["serial", "pole", "channel", "uom"], medians)


#: What a score row tells of a suspect meter, besides serial, pole and the probabilities.
SUSPECT = ("premise", "circuit_nb", "circuit_nm", "station_nb", "station_nm", "distance_ft", "group_size", "median_distance", "median_distance_z", "median_mismatch", "y_pred", "pred_0", "pred_1")


def re_tie(scores: DataFrame, mapping: DataFrame, summary: DataFrame, *, k: int = 10, least_decile: int = 7, criterion: str = "min_day", as_of: str = "asof_dt") -> DataFrame:
    """A better pole for each suspect meter, by its curve against those of the nearest poles.

    mapping: its latest snapshot counts, where it has an as-of date.  The result has
    serial, current_pole, mount (of the mapping), decile and of SUSPECT what scores
    has, the medians as orig_median_*; and new_pole, pred_distance (the smallest of
    any day), pred_median_distance, dist_ft and rank of the proposal.
    """
    current = readers.latest_snapshot(mapping, as_of) if as_of in mapping.columns else mapping
    mount = ["mount"] if "mount" in current.columns else []
    places = current.select("serial", F.col("premise_lat").alias("lat"), F.col("premise_long").alias("long"), *mount).distinct()
    known = [c for c in SUSPECT if c in scores.columns]
    suspect = ties.suspects(scores, least=least_decile).select("serial", F.col("pole").alias("current_pole"), "decile", *[F.col(c).alias(f"orig_{c}" if c.startswith("median_") else c) for c in known]).distinct()
    poles = current.select("pole", F.col("pole_lat").alias("lat"), F.col("pole_long").alias("long")).distinct()
    near = stage(ties.k_nearest(suspect.select("serial").distinct().join(places, "serial"), poles, k=k, query_id="serial"), "near-poles")
    curves = summary.select("serial", "day", "curve")
    wholes = summary.groupBy("pole", "day").agg(F.min("group_curve").alias("curve"))  # one and the same in all rows of a pole's day
    distances = ties.candidate_distances(near, curves, wholes, meter="serial")
    best = ties.propose_tie(distances, criterion=criterion, meter="serial")
    proposed = best.select("serial", F.col("pole").alias("new_pole"), F.col("least_distance").alias("pred_distance"), F.col("median_distance").alias("pred_median_distance"))
    ranked = near.select("serial", F.col("pole").alias("new_pole"), "dist_ft", "rank")
    whole = proposed.join(ranked, ["serial", "new_pole"]).join(suspect, "serial")
    return whole.join(places.select("serial", *mount).distinct(), "serial") if mount else whole

"""Nearest transformers, and which of them fits a meter's curve best."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import conform as fn
from ..functions import geo, vectors
from ..session import stage
from .joins import arg_min, dense_rank


def _placed(df: DataFrame, id_col: str, lat: str, long: str, prefix: str) -> DataFrame:
    at = geo.to_cartesian(F.col(lat), F.col(long))
    known = df.where(F.col(lat).isNotNull() & F.col(long).isNotNull() & F.col(id_col).isNotNull())
    return known.select(F.col(id_col).alias(f"{prefix}_id"), *[at[k].alias(f"{prefix}_{k}") for k in "xyz"]).distinct()


def _cell(prefix: str, width: float) -> list:
    return [F.floor(F.col(f"{prefix}_{d}") / width).alias(f"__{d}") for d in "xyz"]


def start_width(candidates: DataFrame, k: int, most: float, crowd: int = 8) -> float:
    """The largest cube width, by halves from `most`, at which no cube holds more than crowd * k candidates; at least a millimetre.

    The fullest cube decides, and not the extent of all, which a single stray place
    would set.  Two counts over the candidates: at every seventh level, and at those
    between.
    """
    lowest = 44

    def first(levels: range) -> int:
        width = F.lit(most) / F.pow(F.lit(2.0), F.col("__level"))
        cells = candidates.select("*", F.explode(F.array(*map(F.lit, levels))).alias("__level")).select("__level", *[F.floor(F.col(f"c_{d}") / width).alias(f"__{d}") for d in "xyz"])
        fullest = cells.groupBy("__level", *[f"__{d}" for d in "xyz"]).count().groupBy("__level").agg(F.max("count").alias("n"))
        return min((r["__level"] for r in fullest.where(F.col("n") <= crowd * k).collect()), default=lowest)

    level = first(range(0, lowest + 1, 7))
    return max(1e-6, most / 2 ** (first(range(level - 6, level + 1)) if level else 0))


#: Pairs that one task makes and ranks, about.
MOST_PAIRS = 500_000
_AXES = ["__x", "__y", "__z"]


def _around(cells: DataFrame) -> DataFrame:
    """Each row in its own cube and in the 26 around it."""
    for d in _AXES:
        cells = cells.withColumn("__s", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn(d, F.col(d) + F.col("__s")).drop("__s")
    return cells


def near_pairs(queries: DataFrame, candidates: DataFrame, width: float) -> DataFrame:
    """(q_id, c_id, dist_ft): each query with the candidates of its own cube and the 26 around it.

    Both sides are small next to the pairs, so it is the pairs of each cube, counted before, that decide
    over how many tasks cubes are dealt.  In a cube with more than MOST_PAIRS of them the queries are dealt over
    several tasks, each with all of its candidates.
    """
    around, cells = _around(queries.select("*", *_cell("q", width))), candidates.select("*", *_cell("c", width))
    asking = _around(queries.groupBy(*_cell("q", width)).agg(F.count("*").alias("__q"))).groupBy(*_AXES).agg(F.sum("__q").alias("__q"))
    pairs = asking.join(cells.groupBy(*_AXES).agg(F.count("*").alias("__c")), _AXES).select(*_AXES, (F.col("__q") * F.col("__c")).alias("__pairs"))
    every, most = pairs.agg(F.sum("__pairs"), F.max("__pairs")).first()
    if (most or 0) > MOST_PAIRS:
        full = F.broadcast(pairs.where(F.col("__pairs") > MOST_PAIRS).select(*_AXES, F.ceil(F.col("__pairs") / MOST_PAIRS).alias("__n")))  # at most a row for MOST_PAIRS pairs
        parts = F.coalesce("__n", F.lit(1))
        around = around.join(full, _AXES, "left").withColumn("__part", F.pmod(F.xxhash64("q_id"), parts)).drop("__n")
        cells = cells.join(full, _AXES, "left").withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1))).drop("__n")
    else:
        around, cells = (d.withColumn("__part", F.lit(0).cast("long")) for d in (around, cells))
    tasks = max(1, -(-(every or 0) // MOST_PAIRS))
    around, cells = (d.repartition(tasks, *_AXES, "__part") for d in (around, cells))
    dist = geo.chord_ft({d: F.col(f"q_{d}") for d in "xyz"}, {d: F.col(f"c_{d}") for d in "xyz"})
    return around.join(cells, [*_AXES, "__part"]).select("q_id", "c_id", dist.alias("dist_ft"))


def k_nearest(queries: DataFrame, candidates: DataFrame, *, k: int = 10, query_id: str = "meter", candidate_id: str = "pole", lat: str = "lat", long: str = "long") -> DataFrame:
    """(query, candidate, dist_ft, rank): the k nearest by the chord through the earth.

    Space is cut into cubes, and each query meets the candidates of its own and the
    26 cubes around it by an equi-join.  What is found within one cube's width is
    certain; queries with fewer than k such candidates go on with cubes of four
    times the width, until one cube holds the earth.  The first width is that at which
    the fullest cube holds a few times k candidates, so where places are dense each
    query meets a bounded number of them, and only queries far from most places see
    wider cubes.  Of candidates at one place only the k smallest take part, as ties go to
    the smaller: a stack of them (a usual default in address data) counts as k.  Poles and the date line need
    no special case.
    """
    q = stage(_placed(queries, query_id, lat, long, "q"), "nearest-queries")
    place = Window.partitionBy("c_x", "c_y", "c_z").orderBy("c_id")
    c = stage(_placed(candidates, candidate_id, lat, long, "c").withColumn("__n", F.row_number().over(place)).where(F.col("__n") <= k).drop("__n"), "nearest-candidates")
    most = geo.EARTH_KM * 4
    width = start_width(c, k, most)
    done = None
    while True:
        ranked = near_pairs(q, c, width).withColumn("rank", F.row_number().over(Window.partitionBy("q_id").orderBy("dist_ft", "c_id"))).where(F.col("rank") <= k)
        ranked = stage(ranked, "nearest")
        last = width >= most
        sure = ranked.where(F.col("dist_ft") <= width * geo.FEET_PER_KM).groupBy("q_id").agg(F.count("*").alias("n")).where(F.lit(True) if last else F.col("n") >= k).select("q_id")
        found = ranked if last else ranked.join(sure, "q_id", "left_semi")
        done = found if done is None else done.unionByName(found)
        if last:
            break
        q = stage(q.join(sure, "q_id", "left_anti"), "nearest-queries")
        if q.isEmpty():
            break
        width = min(most, width * 4)
    return done.select(F.col("q_id").alias(query_id), F.col("c_id").alias(candidate_id), "dist_ft", F.col("rank").cast("int").alias("rank"))


def neighbour_rank(df: DataFrame, meter: str = "meter", distance: str = "dist_ft") -> DataFrame:
    """Dense rank of each meter's candidates by distance."""
    return dense_rank(df, [meter], [F.col(distance)], "neighbour")


def suspects(scores: DataFrame, *, p: str = "pred_1", least: int = 7, as_text_digit: bool = False) -> DataFrame:
    """Meters whose score lies in the given decile or above."""
    return scores.withColumn("decile", fn.decile_digit(F.col(p), as_text_digit)).where(F.col("decile") >= least)


def candidate_distances(candidates: DataFrame, meter_curves: DataFrame, pole_curves: DataFrame, *, meter: str = "meter", pole: str = "pole", day: str = "day") -> DataFrame:
    """(meter, pole, day, distance): a meter's daily curve against each candidate's."""
    m = meter_curves.select(meter, day, F.col("curve").alias("__m"))
    p = pole_curves.select(pole, day, F.col("curve").alias("__p"))
    both = candidates.select(meter, pole).distinct().join(m, meter).join(p, [pole, day])
    return both.select(meter, pole, day, vectors.euclid_of_unit(F.col("__m"), F.col("__p")).alias("distance"))


def propose_tie(distances: DataFrame, *, criterion: str = "min_day", meter: str = "meter", pole: str = "pole", day: str = "day") -> DataFrame:
    """The best candidate of each meter, with its median distance.

    min_day: the pole of the smallest distance on any day; min_median: the pole
    of the smallest median over days.  All of them on a tie.
    """
    medians = distances.groupBy(meter, pole).agg(F.percentile_approx("distance", 0.5).alias("median_distance"), F.min("distance").alias("least_distance"))
    value = {"min_day": "least_distance", "min_median": "median_distance"}[criterion]
    return arg_min(medians, [meter], value)

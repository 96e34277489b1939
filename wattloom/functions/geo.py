"""Distances on the earth as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
FEET_PER_KM = 3280.84
#: WGS-84
MAJOR_M, FLATTENING = 6378137.0, 1 / 298.257223563
FEET_PER_M = 3.280839895


def to_cartesian(lat: Column, long: Column, radius: float = EARTH_KM) -> dict[str, Column]:
    """x, y, z on a sphere."""
    a, b = F.radians(lat), F.radians(long)
    return {"x": F.lit(radius) * F.cos(a) * F.cos(b), "y": F.lit(radius) * F.cos(a) * F.sin(b), "z": F.lit(radius) * F.sin(a)}


def haversine_ft(lat1: Column, long1: Column, lat2: Column, long2: Column) -> Column:
    """Feet along a great circle; null if any coordinate is."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(long2 - long1) / 2), 2)
    return F.when(h.isNotNull(), F.lit(2 * EARTH_KM * FEET_PER_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0)))))


def chord_ft(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Feet straight through the sphere, between two results of to_cartesian."""
    return F.sqrt(sum((F.pow(a[k] - b[k], 2) for k in "xyz"), F.lit(0.0))) * FEET_PER_KM


def geodesic_ft(lat1: Column, long1: Column, lat2: Column, long2: Column, steps: int = 20) -> Column:
    """Feet on the WGS-84 ellipsoid, by Vincenty's inverse formula with a fixed number of steps.

    The iteration is a fold over the steps, so the expression does not grow with
    them.  It does not converge for nearly antipodal points; those are off by
    fractions of a percent.
    """
    f, a = FLATTENING, MAJOR_M
    b = a * (1 - f)
    u1, u2 = F.atan((1 - f) * F.tan(F.radians(lat1))), F.atan((1 - f) * F.tan(F.radians(lat2)))
    between = F.radians(F.pmod(long2 - long1 + 540, F.lit(360.0)) - 180)
    begin = F.struct(between.alias("lam"), F.lit(0.0).alias("ss"), F.lit(1.0).alias("cs"), F.lit(1.0).alias("ca"), F.lit(0.0).alias("cm"))

    def step(s: Column, _: Column) -> Column:
        lam = s["lam"]
        ss = F.sqrt(F.pow(F.cos(u2) * F.sin(lam), 2) + F.pow(F.cos(u1) * F.sin(u2) - F.sin(u1) * F.cos(u2) * F.cos(lam), 2))
        cs = F.sin(u1) * F.sin(u2) + F.cos(u1) * F.cos(u2) * F.cos(lam)
        first = F.struct(lam.alias("lam"), ss.alias("ss"), cs.alias("cs"))
        return F.element_at(F.transform(F.array(first), angle), 1)

    def angle(s: Column) -> Column:
        sa = F.coalesce(F.try_divide(F.cos(u1) * F.cos(u2) * F.sin(s["lam"]), s["ss"]), F.lit(0.0))
        ca = 1 - sa * sa
        cm = s["cs"] - F.coalesce(F.try_divide(2 * F.sin(u1) * F.sin(u2), ca), s["cs"])
        c = F.lit(f / 16) * ca * (4 + f * (4 - 3 * ca))
        sigma = F.atan2(s["ss"], s["cs"])
        lam = between + (1 - c) * f * sa * (sigma + c * s["ss"] * (cm + c * s["cs"] * (2 * cm * cm - 1)))
        return F.struct(lam.alias("lam"), s["ss"].alias("ss"), s["cs"].alias("cs"), ca.alias("ca"), cm.alias("cm"))

    def length(s: Column) -> Column:
        u = s["ca"] * ((a * a - b * b) / (b * b))
        big_a = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
        big_b = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
        cm, cs, ss = s["cm"], s["cs"], s["ss"]
        ds = big_b * ss * (cm + big_b / 4 * (cs * (2 * cm * cm - 1) - big_b / 6 * cm * (4 * ss * ss - 3) * (4 * cm * cm - 3)))
        return F.lit(b * FEET_PER_M) * big_a * (F.atan2(ss, cs) - ds)

    found = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), begin, step, length)
    known = lat1.isNotNull() & long1.isNotNull() & lat2.isNotNull() & long2.isNotNull()
    return F.when(known & (lat1 == lat2) & (long1 == long2), F.lit(0.0)).when(known, found)

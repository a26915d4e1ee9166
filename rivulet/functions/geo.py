"""Points, distances and polygon tests in degrees (WGS84)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from rivulet.functions.clean import col

EARTH_RADIUS_M = 6371008.8
# WGS84 ellipsoid.
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, however often it is used there."""
    return F.element_at(F.transform(F.array(value), body), 1)


SETTLED = 1e-11


def make_point(lon: Column | str, lat: Column | str) -> Column:
    """NULL unless both coordinates exist."""
    lon, lat = col(lon).cast("double"), col(lat).cast("double")
    return F.when(lon.isNotNull() & lat.isNotNull(),
                  F.struct(lon.alias("lon"), lat.alias("lat")))


def haversine_m(lon1, lat1, lon2, lat2) -> Column:
    """Spherical distance, the cheap variant."""
    x1, y1, x2, y2 = (F.radians(col(c).cast("double")) for c in (lon1, lat1, lon2, lat2))
    half = (F.pow(F.sin((y2 - y1) / 2), F.lit(2.0))
            + F.cos(y1) * F.cos(y2) * F.pow(F.sin((x2 - x1) / 2), F.lit(2.0)))
    # least() would turn a missing coordinate into the antipodal distance
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.when(half > 1, F.lit(1.0)).otherwise(half)))


def distance_m(lon1, lat1, lon2, lat2, rounds: int = 8) -> Column:
    """Ellipsoidal distance (Vincenty's inverse formula).

    NULL where the angle has not settled within ``rounds`` (points almost opposite
    each other): its last step must be below SETTLED radians, some 0.1 mm.
    """
    b = WGS84_A * (1 - WGS84_F)
    x1, y1, x2, y2 = (F.radians(col(c).cast("double")) for c in (lon1, lat1, lon2, lat2))
    start = F.struct(
        (x2 - x1).alias("dl"),
        F.atan((1 - WGS84_F) * F.tan(y1)).alias("u1"),
        F.atan((1 - WGS84_F) * F.tan(y2)).alias("u2"))

    def angles(p: Column, lam: Column) -> Column:
        su1, cu1, su2, cu2 = F.sin(p["u1"]), F.cos(p["u1"]), F.sin(p["u2"]), F.cos(p["u2"])
        east = cu2 * F.sin(lam)
        north = cu1 * su2 - su1 * cu2 * F.cos(lam)
        cos_s = su1 * su2 + cu1 * cu2 * F.cos(lam)
        first = F.struct(F.sqrt(east * east + north * north).alias("ss"), cos_s.alias("cs"))

        def second(s: Column) -> Column:
            sin_a = F.when(s["ss"] == 0, F.lit(0.0)).otherwise(
                cu1 * cu2 * F.sin(lam) / F.nullif(s["ss"], F.lit(0.0)))
            return F.struct(s["ss"].alias("ss"), s["cs"].alias("cs"),
                            F.atan2(s["ss"], s["cs"]).alias("sigma"),
                            sin_a.alias("sa"), (1 - sin_a * sin_a).alias("ca2"))

        def third(s: Column) -> Column:
            mid = F.when(s["ca2"] == 0, F.lit(0.0)).otherwise(
                s["cs"] - 2 * su1 * su2 / F.nullif(s["ca2"], F.lit(0.0)))
            return F.struct(*[s[k].alias(k) for k in ("ss", "cs", "sigma", "sa", "ca2")],
                            mid.alias("cm"))

        return let(let(first, second), third)

    def refine(p: Column, lam: Column) -> Column:
        def step(s: Column) -> Column:
            c = WGS84_F / 16 * s["ca2"] * (4 + WGS84_F * (4 - 3 * s["ca2"]))
            return p["dl"] + (1 - c) * WGS84_F * s["sa"] * (
                s["sigma"] + c * s["ss"] * (s["cm"] + c * s["cs"] * (2 * s["cm"] * s["cm"] - 1)))
        return let(angles(p, lam), step)

    def length(s: Column) -> Column:
        u2 = s["ca2"] * (WGS84_A ** 2 - b ** 2) / b ** 2
        big_a = 1 + u2 / 16384 * (4096 + u2 * (-768 + u2 * (320 - 175 * u2)))
        big_b = u2 / 1024 * (256 + u2 * (-128 + u2 * (74 - 47 * u2)))
        cm2 = s["cm"] * s["cm"]
        delta = big_b * s["ss"] * (s["cm"] + big_b / 4 * (
            s["cs"] * (2 * cm2 - 1)
            - big_b / 6 * s["cm"] * (4 * s["ss"] * s["ss"] - 3) * (4 * cm2 - 3)))
        return b * big_a * (s["sigma"] - delta)

    def solve(p: Column) -> Column:
        first = F.struct(p["dl"].alias("at"), F.lit(None).cast("double").alias("moved"))

        def again(acc: Column, _round: Column) -> Column:
            return let(refine(p, acc["at"]), lambda v: F.struct(
                v.alias("at"), F.abs(v - acc["at"]).alias("moved")))

        last = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), first, again)
        return let(last, lambda v: F.when(v["moved"] <= SETTLED, let(angles(p, v["at"]), length)))

    return let(start, solve)


def ring_area(ring: Column | str) -> Column:
    """Planar area of a closed or open ring of ``struct<lon,lat>`` (shoelace)."""
    ring = col(ring)
    n = F.size(ring)

    def cross(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, i % n + 1)
        return a["lon"] * b["lat"] - b["lon"] * a["lat"]

    return F.abs(F.aggregate(F.transform(F.sequence(F.lit(1), n), cross), F.lit(0.0),
                             lambda acc, v: acc + v)) / 2


def point_in_ring(lon: Column | str, lat: Column | str, ring: Column | str) -> Column:
    """Ray casting; works for concave rings."""
    ring = col(ring)
    n = F.size(ring)

    def edge(i: Column) -> Column:
        a, b = F.element_at(ring, i), F.element_at(ring, i % n + 1)
        return F.struct(a["lon"].alias("ax"), a["lat"].alias("ay"), b["lon"].alias("bx"), b["lat"].alias("by"))

    return odd_crossings(lon, lat, F.transform(F.sequence(F.lit(1), n), edge))


def odd_crossings(lon: Column | str, lat: Column | str, edges: Column | str) -> Column:
    """Whether a ray east of the point crosses an odd number of ``struct<ax,ay,bx,by>`` edges.

    True inside, for the edges of a ring as for those of all rings of a polygon with holes
    and parts. Edges without a place count as not crossed.
    """
    x, y = col(lon).cast("double"), col(lat).cast("double")

    def crossed(e: Column) -> Column:
        spans = (e["ay"] > y) != (e["by"] > y)
        at = F.try_divide((e["bx"] - e["ax"]) * (y - e["ay"]), e["by"] - e["ay"]) + e["ax"]
        return F.coalesce((spans & (x < at)).cast("int"), F.lit(0))

    hits = F.aggregate(col(edges), F.lit(0), lambda acc, e: acc + crossed(e))
    return hits % 2 == 1

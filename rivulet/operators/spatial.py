"""Nearest grid point and point-in-polygon without cross joins.

Both build tiles on the small side and reach them by equality, so the work is
proportional to the points plus the few tiles each point can touch. Polygons are tested
against the edges of one latitude strip, not against whole rings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType

from rivulet.functions.geo import let, odd_crossings, ring_area

EDGES = 16  # of a polygon in a latitude strip, about


def _squared(dx: Column, dy: Column) -> Column:
    # nine decimals absorb floating noise, so that exact ties stay ties
    return F.round(dx * dx + dy * dy, 9)


def nearest(points: DataFrame, grid: DataFrame, key: str, lat: str, lon: str,
            grid_lat: str = "era5_latitude", grid_lon: str = "era5_longitude",
            step: float = 0.1, k: int = 1) -> DataFrame:
    """The ``k`` closest grid points in planar degrees; ties go to the lower lat, then lon.

    With ``k`` above 1 there is a row for each of them, with its ``rank`` from 1; a point has
    fewer only where the grid has.

    The grid is snapped to ``step``, so a tile of 4x4 steps holds at most 16
    points. A point looks up its own tile
    among grid points copied into the 3x3 tiles around them; that answer is
    final when the last of them is no farther than one tile. The remaining points (over sea,
    abroad) go through a pyramid of tight tile boxes, which is exact at any
    distance. No driver-side job is run.
    """
    size = 4 * step
    cells = grid.select(F.col(grid_lat).alias("_glat"), F.col(grid_lon).alias("_glon")).distinct()
    cells = cells.select("_glat", "_glon", F.col("_glat").cast("double").alias("_y"),
                         F.col("_glon").cast("double").alias("_x"))
    ring = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    around = (cells.withColumn("_dx", F.explode(ring)).withColumn("_dy", F.explode(ring))
              .select((F.floor(F.col("_x") / size) + F.col("_dx")).alias("_tx"),
                      (F.floor(F.col("_y") / size) + F.col("_dy")).alias("_ty"),
                      F.struct("_y", "_x", "_glat", "_glon").alias("_c"))
              .groupBy("_tx", "_ty").agg(F.collect_list("_c").alias("_cands")))
    px, py = F.col(lon).cast("double"), F.col(lat).cast("double")
    placed = (points.withColumn("_px", px).withColumn("_py", py)
              .withColumn("_tx", F.floor(F.col("_px") / size))
              .withColumn("_ty", F.floor(F.col("_py") / size)))
    scored = placed.join(around, ["_tx", "_ty"], "left").withColumn("_best", _closest("_cands", k))
    last = F.try_element_at("_best", F.lit(k))["_d2"]
    settled = F.coalesce(last <= size * size, F.lit(False))
    kept = [F.col(f"`{c}`") for c in points.columns]
    near = scored.where(settled).select(*kept, "_best")
    # the others alone meet the pyramid's answers; near points take no part in that join
    far = scored.where(~settled).select(*kept, "_px", "_py")
    found = _pyramid(far.select(key, "_px", "_py"), cells, key, step, k)
    both = near.unionByName(far.join(found, key).select(*kept, "_best"))
    place = [F.col("_c._glat").alias(grid_lat), F.col("_c._glon").alias(grid_lon)]
    if k == 1:
        return both.withColumn("_c", F.element_at("_best", 1)).select(*kept, *place)
    return both.select(*kept, F.posexplode("_best").alias("_n", "_c")).select(
        *kept, *place, (F.col("_n") + 1).alias("rank"))


def _closest(candidates: str, k: int) -> Column:
    """The k candidates nearest to (_px, _py), nearest first; NULL without candidates."""
    scored = F.transform(candidates, lambda c: F.struct(
        _squared(c["_x"] - F.col("_px"), c["_y"] - F.col("_py")).alias("_d2"),
        c["_glat"].alias("_glat"), c["_glon"].alias("_glon")))
    if k == 1:
        return F.when(F.col(candidates).isNotNull(), F.array(F.array_min(scored)))
    return F.slice(F.array_sort(scored), 1, k)


def _boxes(cells: DataFrame, size: float, parent: float | None) -> DataFrame:
    keys = [F.floor(F.col("_x") / size).alias("_ix"), F.floor(F.col("_y") / size).alias("_iy")]
    if parent:
        keys += [F.floor(F.col("_x") / parent).alias("_ox"),
                 F.floor(F.col("_y") / parent).alias("_oy")]
    names = ["_ix", "_iy", "_ox", "_oy"][:len(keys)]
    return (cells.select(*keys, "_x", "_y").groupBy(*names)
            .agg(F.min("_x").alias("x0"), F.max("_x").alias("x1"),
                 F.min("_y").alias("y0"), F.max("_y").alias("y1"), F.count("*").alias("n")))


def _span(b: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """Squared distance to the nearest and to the farthest point of a box."""
    zero = F.lit(0.0)
    near_x = F.greatest(b["x0"] - x, zero, x - b["x1"])
    near_y = F.greatest(b["y0"] - y, zero, y - b["y1"])
    far_x = F.greatest(F.abs(x - b["x0"]), F.abs(x - b["x1"]))
    far_y = F.greatest(F.abs(y - b["y0"]), F.abs(y - b["y1"]))
    return near_x * near_x + near_y * near_y, far_x * far_x + far_y * far_y


def _survivors(boxes: Column, x: Column, y: Column, bound: Column | None, k: int) -> Column:
    """Boxes that can hold one of the k nearest points.

    Boxes by their farthest point, nearest first: where their points come to k, that
    distance holds k points, so a box beyond it holds none of the k nearest.
    """
    spans = F.transform(boxes, lambda b: F.struct(
        b.alias("b"), _span(b, x, y)[0].alias("lo"), _span(b, x, y)[1].alias("hi")))

    def reach(items: Column) -> Column:
        if k == 1:
            return F.array_min(F.transform(items, lambda i: i["hi"]))
        ordered = F.array_sort(F.transform(items, lambda i: F.struct(i["hi"].alias("hi"), i["b"]["n"].alias("n"))))
        start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("hi"))
        return F.aggregate(ordered, start, lambda acc, i: F.when(acc["n"] >= k, acc).otherwise(
            F.struct((acc["n"] + i["n"]).alias("n"), i["hi"].alias("hi"))), lambda acc: acc["hi"])

    def keep(items: Column) -> Column:
        best = reach(items)
        limit = best if bound is None else F.least(best, bound)
        return let(limit, lambda cut: F.transform(
            F.filter(items, lambda i: i["lo"] <= cut + 1e-9),
            lambda i: F.struct(i["b"].alias("b"), cut.alias("cut"))))

    return let(spans, keep)


def _pyramid(far: DataFrame, cells: DataFrame, key: str, step: float, k: int) -> DataFrame:
    big, small = 64 * step, 8 * step
    top = _boxes(cells, big, None)
    # one row: the list of occupied top tiles, at most (360/6.4) * (180/6.4) of them
    tops = top.agg(F.collect_list(F.struct("_ix", "_iy", "x0", "x1", "y0", "y1", "n")).alias("t"))
    level1 = far.withColumn("_tops", tops.scalar()).select(
        key, "_px", "_py", F.explode(_survivors(F.col("_tops"), F.col("_px"), F.col("_py"), None, k))
        .alias("_s")).select(key, "_px", "_py", F.col("_s.b._ix").alias("_ox"),
                             F.col("_s.b._iy").alias("_oy"), F.col("_s.cut").alias("_cut"))
    # at most 64 small tiles per top tile, 64 points per small tile
    children = _boxes(cells, small, big).groupBy("_ox", "_oy").agg(
        F.collect_list(F.struct("_ix", "_iy", "x0", "x1", "y0", "y1", "n")).alias("_kids"))
    level2 = level1.join(children, ["_ox", "_oy"]).select(
        key, "_px", "_py",
        F.explode(_survivors(F.col("_kids"), F.col("_px"), F.col("_py"), F.col("_cut"), k))
        .alias("_s")).select(key, "_px", "_py", F.col("_s.b._ix").alias("_ix"),
                             F.col("_s.b._iy").alias("_iy"))
    leaves = (cells.select(F.floor(F.col("_x") / small).alias("_ix"),
                           F.floor(F.col("_y") / small).alias("_iy"),
                           F.struct("_y", "_x", "_glat", "_glon").alias("_c"))
              .groupBy("_ix", "_iy").agg(F.collect_list("_c").alias("_cands")))
    best = level2.join(leaves, ["_ix", "_iy"]).select(key, _closest("_cands", k).alias("_best"))
    if k == 1:
        return best.groupBy(key).agg(F.min("_best").alias("_best"))
    # at most k of each leaf that the bound has left
    return best.groupBy(key).agg(F.slice(F.array_sort(F.flatten(F.collect_list("_best"))), 1, k).alias("_best"))


def _parts(shape: Column, depth: int) -> Column:
    """Any of the three nestings as parts of rings."""
    for _ in range(3 - depth):
        shape = F.array(shape)
    kept = F.transform(F.filter(shape, lambda part: part.isNotNull()),
                       lambda part: F.filter(part, lambda ring: F.size(ring) >= 3))
    return F.filter(kept, lambda part: F.size(part) > 0)


def _nesting(df: DataFrame, shape: str) -> int:
    kind, depth = df.select(shape).schema[0].dataType, 0
    while isinstance(kind, ArrayType):
        kind, depth = kind.elementType, depth + 1
    if depth not in (1, 2, 3):
        raise ValueError(f"{shape} is no ring, list of rings or list of parts")
    return depth


def _edges(parts: Column) -> Column:
    def around(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1))
        return F.zip_with(ring, following, lambda a, b: F.struct(
            a["lon"].alias("ax"), a["lat"].alias("ay"), b["lon"].alias("bx"), b["lat"].alias("by")))

    edges = F.flatten(F.transform(F.flatten(parts), around))
    # a level edge crosses no ray, nor does one without a place
    return F.filter(edges, lambda e: (e["ay"] != e["by"]) & e["ax"].isNotNull() & e["bx"].isNotNull())


def contains_join(points: DataFrame, polygons: DataFrame, key: str, lon: str, lat: str,
                  ring: str, code: str, attrs: Sequence[str] = ()) -> DataFrame:
    """Smallest polygon that contains each point (inner: uncovered points drop out).

    ``ring`` is a ring of ``struct<lon,lat>``, a polygon (list of rings: outline, then its
    holes) or a list of such polygons, its parts. Rings of fewer than three points hold
    nothing; a polygon without rings is dropped. Size is the planar area, without holes;
    ties go to the lower ``code``.

    A polygon's bounding box is filed under tiles of a quarter of its extent or more, 5x5
    at most; a point visits one tile for each tile size in use. The edges are filed apart,
    under latitude strips of their polygon, so a point inside the box meets the edges of
    one strip only: an odd number of them east of it means inside, whatever the rings. A
    strip holds some 16 edges, and strips are no lower than the mean edge is high, so
    the strips hold at most three times the edges.
    """
    parts = _parts(F.col(ring), _nesting(polygons, ring))
    every = F.flatten(F.flatten("_parts"))
    lons, lats = F.transform(every, lambda p: p["lon"]), F.transform(every, lambda p: p["lat"])
    shapes = polygons.select(parts.alias("_parts"), code, *attrs).where(F.size("_parts") > 0).select(
        "_parts", code, *attrs, F.sha2(F.to_json("_parts"), 256).alias("_shape"), _edges(F.col("_parts")).alias("_edges"),
        F.array_min(lons).alias("_x0"), F.array_max(lons).alias("_x1"),
        F.array_min(lats).alias("_y0"), F.array_max(lats).alias("_y1"))
    n, height = F.size("_edges"), F.col("_y1") - F.col("_y0")
    rise = F.aggregate("_edges", F.lit(0.0), lambda acc, e: acc + F.abs(e["by"] - e["ay"]))
    strips = F.greatest(F.lit(1.0), F.least(F.ceil(n / EDGES), F.floor(F.try_divide(height * n, rise))))
    shapes = shapes.withColumn("_strips", strips.cast("int"))

    def strip(y: Column) -> Column:
        # grows with y, so a point between the ends of an edge is in a strip between theirs
        at = F.floor(F.try_divide(y - F.col("_y0"), height) * F.col("_strips")).cast("int")
        return F.least(F.col("_strips") - 1, at)

    filed_edges = (shapes.dropDuplicates(["_shape"])
                   .select("_shape", "_strips", "_y0", "_y1", F.explode("_edges").alias("_e"))
                   .withColumn("_strip", F.explode(F.sequence(
                       strip(F.least("_e.ay", "_e.by")), strip(F.greatest("_e.ay", "_e.by")))))
                   .groupBy("_shape", "_strip").agg(F.collect_list("_e").alias("_near")))

    extent = F.greatest(F.col("_x1") - F.col("_x0"), height, F.lit(2.0 ** -4))
    area = F.aggregate(F.transform("_parts", lambda part: ring_area(part[0]) - F.aggregate(
        F.transform(F.slice(part, 2, F.size(part)), ring_area), F.lit(0.0), lambda acc, hole: acc + hole)),
        F.lit(0.0), lambda acc, v: acc + v)
    boxes = shapes.select(code, *attrs, "_shape", "_strips", "_x0", "_x1", "_y0", "_y1", area.alias("_area"),
                          (F.ceil(F.log2(extent)) - 2).cast("int").alias("_level"))
    tile = F.pow(F.lit(2.0), F.col("_level"))
    filed = (boxes.withColumn("_tx", F.explode(F.sequence(F.floor(F.col("_x0") / tile), F.floor(F.col("_x1") / tile))))
             .withColumn("_ty", F.explode(F.sequence(F.floor(F.col("_y0") / tile), F.floor(F.col("_y1") / tile)))))
    # one row: the tile sizes in use, a dozen at most
    levels = boxes.agg(F.collect_set("_level").alias("levels")).scalar()
    x, y = F.col(lon).cast("double"), F.col(lat).cast("double")
    visits = (points.select(key, x.alias("_x"), y.alias("_y"))
              .where(F.col("_x").isNotNull() & F.col("_y").isNotNull())
              .withColumn("_level", F.explode(levels))
              .withColumn("_tx", F.floor(F.col("_x") / tile))
              .withColumn("_ty", F.floor(F.col("_y") / tile)))
    near = (visits.join(filed, ["_level", "_tx", "_ty"])
            .where(F.col("_x").between(F.col("_x0"), F.col("_x1"))
                   & F.col("_y").between(F.col("_y0"), F.col("_y1")))
            .withColumn("_strip", strip(F.col("_y"))))
    inside = near.join(filed_edges, ["_shape", "_strip"]).where(odd_crossings("_x", "_y", "_near"))
    best = inside.groupBy(key).agg(
        F.min_by(F.struct(code, *attrs), F.struct("_area", code)).alias("_hit"))
    return best.select(key, *[F.col(f"_hit.{c}").alias(c) for c in (code, *attrs)])

from __future__ import annotations

import math
import random
from datetime import date, datetime, timedelta
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from rivulet.functions.geo import haversine_m
from rivulet.operators import (dedup, indices, joins, quality, refresh, reshape, spatial,
                               summaries, windows)

NORMAL = NormalDist()


# ---- joins and dedup ------------------------------------------------------------------

def test_salted_joins_equal_plain_joins_on_a_hot_key(spark):
    rows = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, None)
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("k"))
    ref = spark.createDataFrame([("hot", 1), ("k2", 2), ("k5", 3)], "k string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = rows.join(ref, "k", how)
        salted = joins.salted_join(rows, ref, "k", how, spread=["id"], salt=5)
        assert sorted(map(str, salted.select(*plain.columns).collect())) == sorted(
            map(str, plain.collect()))
    assert joins.keep_known(rows, ref.where("false"), "k").count() == 0


def test_entity_match_takes_the_separator_literally(spark):
    stations = spark.createDataFrame([("s", "A1|B2"), ("t", "B2"), ("u", None)], "k string, codes string")
    entities = spark.createDataFrame([("B2", "b")], "code_eh string, label string")
    got = {r.k: (r.code_eh, r.matched_by) for r in joins.match_entity(
        stations, entities, "k", "codes", attrs=["label"], sep="|").collect()}
    assert got == {"s": ("B2", "ANY"), "t": ("B2", "PRIMARY"), "u": (None, None)}


def test_first_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    best = dedup.first_per_key(df, ["k"], [("v", "desc")])
    assert {tuple(r) for r in best.collect()} == {(0, 999), (1, 997), (2, 998)}
    plan = best._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_nulls_sort_last_in_dedup(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5.0, 2), ("b", None, 3)],
                               "k string, v double, i int")
    assert {(r.k, r.i) for r in dedup.first_per_key(df, ["k"], [("v", "desc")]).collect()} == {
        ("a", 2), ("b", 3)}


# ---- spatial --------------------------------------------------------------------------

def test_nearest_equals_brute_force_near_and_far(spark):
    rng = random.Random(5)
    cells = [(x / 10, y / 10) for x in range(-20, 60) for y in range(420, 480) if rng.random() < 0.3]
    points = [(f"p{i}", rng.uniform(-25, 40), rng.uniform(30, 60)) for i in range(250)]
    points += [("tie", 0.05, 45.05)]
    grid = spark.createDataFrame([(y, x) for x, y in cells], "la double, lo double").select(
        F.col("la").cast("decimal(6,1)").alias("era5_latitude"),
        F.col("lo").cast("decimal(6,1)").alias("era5_longitude"))
    df = spark.createDataFrame(points, "k string, x double, y double")
    got = {r.k: (float(r.era5_latitude), float(r.era5_longitude))
           for r in spatial.nearest(df, grid, "k", "y", "x").collect()}
    for k, x, y in points:
        best = min((round((cx - x) ** 2 + (cy - y) ** 2, 9), cy, cx) for cx, cy in cells)
        assert got[k] == (best[1], best[2])


def test_nearest_on_a_grid_around_the_world(spark):
    rng = random.Random(9)
    cells = [(round(rng.uniform(-180, 180), 1), round(rng.uniform(-90, 90), 1)) for _ in range(1500)]
    points = [(f"p{i}", rng.uniform(-180, 180), rng.uniform(-90, 90)) for i in range(120)]
    grid = spark.createDataFrame([(y, x) for x, y in cells], "la double, lo double").select(
        F.col("la").cast("decimal(6,1)").alias("era5_latitude"),
        F.col("lo").cast("decimal(6,1)").alias("era5_longitude"))
    got = {r.k: (float(r.era5_latitude), float(r.era5_longitude)) for r in spatial.nearest(
        spark.createDataFrame(points, "k string, x double, y double"), grid, "k", "y", "x").collect()}
    for k, x, y in points:
        best = min((round((cx - x) ** 2 + (cy - y) ** 2, 9), cy, cx) for cx, cy in cells)
        assert got[k] == (best[1], best[2])


@pytest.mark.parametrize("k", [2, 4, 30])
def test_k_nearest_equal_brute_force(spark, k):
    rng = random.Random(k)
    cells = sorted({(round(rng.uniform(-20, 20), 1), round(rng.uniform(30, 60), 1)) for _ in range(700)}
                   | {(x / 10, 45.0) for x in range(0, 12)})
    points = [(f"p{i}", rng.uniform(-60, 60), rng.uniform(0, 80)) for i in range(120)]
    points += [("tie", 0.45, 45.0), ("on", 0.5, 45.0)] + [(f"d{i}", rng.uniform(0, 1), 45.02) for i in range(20)]
    grid = spark.createDataFrame([(y, x) for x, y in cells], "la double, lo double").select(
        F.col("la").cast("decimal(6,1)").alias("era5_latitude"),
        F.col("lo").cast("decimal(6,1)").alias("era5_longitude"))
    got = {}
    for r in spatial.nearest(spark.createDataFrame(points, "k string, x double, y double"), grid, "k", "y", "x",
                             k=k).collect():
        got.setdefault(r.k, []).append((r["rank"], float(r.era5_latitude), float(r.era5_longitude)))
    for name, x, y in points:
        best = sorted((round((cx - x) ** 2 + (cy - y) ** 2, 9), cy, cx) for cx, cy in cells)[:k]
        assert sorted(got[name]) == [(i + 1, cy, cx) for i, (_, cy, cx) in enumerate(best)]
    few = grid.limit(1)
    assert spatial.nearest(spark.createDataFrame(points, "k string, x double, y double"), few, "k", "y", "x",
                           k=k).count() == len(points)


def test_polygon_join_prefers_the_smaller(spark):
    def box(x0, y0, x1, y1):
        return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]

    shapes = spark.createDataFrame(
        [("big", box(-10.0, 30.0, 30.0, 60.0)), ("small", box(1.0, 44.0, 2.0, 45.0)),
         ("concave", [(5.0, 45.0), (9.0, 45.0), (9.0, 49.0), (7.0, 46.0), (5.0, 49.0)])],
        "code string, ring array<struct<lon:double,lat:double>>")
    points = spark.createDataFrame(
        [("a", 1.5, 44.5), ("b", 3.0, 44.5), ("c", 50.0, 50.0), ("d", 7.0, 48.0), ("e", 5.5, 46.0)],
        "k string, x double, y double")
    hit = spatial.contains_join(points, shapes, "k", "x", "y", "ring", "code")
    assert dict(hit.collect()) == {"a": "small", "b": "big", "d": "big", "e": "concave"}


def plainly_inside(x, y, rings):
    odd = False
    for ring in rings:
        for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1]):
            odd ^= (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax
    return odd


def test_polygons_with_holes_and_parts_against_plain_rays(spark):
    rng = random.Random(31)

    def star(cx, cy, low, high, n):
        turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
        return [(cx + rng.uniform(low, high) * math.cos(t), cy + rng.uniform(low, high) * math.sin(t)) for t in turns]

    comb = [(float(i) / 50, 40.0 if i % 2 else 50.0) for i in range(400)] + [(8.0, 39.0), (0.0, 39.0)]
    shapes = {
        "coast": [[star(3, 45, 3, 4, 3000), star(3, 45, .5, 2, 400)], [star(20, 46, 2, 3, 900)]],
        "comb": [[comb]],
        "small": [[star(3, 45, .8, 1, 12), star(3, 45, .1, .3, 5)]],
        "thin": [[[(-9.0, 45.0), (31.0, 45.001), (31.0, 45.002)]]],
        "line": [[[(0.0, 45.0), (9.0, 45.0)]]], "none": None, "bare": [[], None]}
    polygons = spark.createDataFrame(
        list(shapes.items()), "code string, parts array<array<array<struct<lon:double,lat:double>>>>")
    polygons = polygons.unionAll(polygons.where("code = 'coast'").withColumn("code", F.lit("twin")))
    points = [(i, rng.uniform(-10, 31), rng.uniform(38.5, 51)) for i in range(1500)]
    points += [(2000 + i, rng.uniform(2, 4), rng.uniform(44, 46)) for i in range(300)]
    points += [(3000, None, 45.0), (3001, 30.0, 45.0015)]
    places = spark.createDataFrame(points, "k int, x double, y double").repartition(4)

    def area(code):
        flat = lambda r: abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:] + r[:1]))) / 2
        return sum(flat(part[0]) - sum(map(flat, part[1:])) for part in shapes[code])

    # the twins tie: the lower code wins
    order = sorted(["thin", "small", "coast", "comb"], key=area)
    want = {}
    for k, x, y in points:
        hits = [c for c in order if x is not None and plainly_inside(x, y, [r for part in shapes[c] for r in part])]
        if hits:
            want[k] = hits[0]
    assert set(want.values()) == {"thin", "small", "coast", "comb"}
    hit = spatial.contains_join(places, polygons, "k", "x", "y", "parts", "code")
    assert dict(hit.collect()) == want
    # a polygon column (outline and holes) is a list of one part less
    one = polygons.where("code = 'small'").select("code", F.col("parts")[0].alias("rings"))
    got = spatial.contains_join(places, one, "k", "x", "y", "rings", "code")
    assert {r.k for r in got.collect()} == {
        k for k, x, y in points if x is not None and plainly_inside(x, y, shapes["small"][0])}
    assert spatial.contains_join(places, polygons.limit(0), "k", "x", "y", "parts", "code").count() == 0
    with pytest.raises(ValueError):
        spatial.contains_join(places, polygons, "k", "x", "y", "code", "code")


# ---- climate --------------------------------------------------------------------------

def test_hourly_to_daily(spark):
    rng, rows, want = random.Random(12), [], {}
    for lat, lon in ((43.2, -0.7), (43.2, -0.6), (50.9, 7.4)):
        for day in range(3):
            some = [round(rng.uniform(-12, 30), 3) for _ in range(rng.randint(5, 24))]
            for hour, celsius in enumerate(some):
                rows.append((datetime(2022, 2, 27) + timedelta(days=day, hours=hour),
                             lat + rng.uniform(-1e-9, 1e-9), lon + rng.uniform(-1e-9, 1e-9), celsius + 273.15))
            want[str(date(2022, 2, 27) + timedelta(days=day)), lat, lon] = (
                sum(some) / len(some), min(some), max(some))
    rows += [(datetime(2022, 2, 27, h), 10.0, 10.0, float("nan")) for h in range(24)]  # no reading, no day
    df = spark.createDataFrame(rows, "time timestamp, latitude double, longitude double, t2m double")
    got = {(str(r.time), float(r.latitude), float(r.longitude)): (r.t2m_mean, r.t2m_min, r.t2m_max)
           for r in summaries.hourly_to_daily(df).collect()}
    assert set(got) == set(want)
    for key, values in want.items():
        assert got[key] == pytest.approx(values, abs=0.0051)
        assert all(round(v, 2) == v for v in got[key])


def glo_by_moments(values):
    """Location, scale and shape by gamma functions, from moments at positions (i - 0.35) / n."""
    x, n = sorted(values), len(values)
    above = [1 - (i + 0.65) / n for i in range(n)]
    a0, a1, a2 = (sum(v * p ** r for v, p in zip(x, above)) / n for r in range(3))
    l2, l3 = a0 - 2 * a1, a0 - 6 * a1 + 6 * a2
    k = -l3 / l2
    both = math.gamma(1 + k) * math.gamma(1 - k)
    return a0 - l2 / both / k * (1 - both), l2 / both, k


def draws(rng, n, xi, alpha, k):
    return [xi + alpha / k * (1 - (1 / u - 1) ** k) for u in (rng.uniform(0.002, 0.998) for _ in range(n))]


def test_glo_fit(spark):
    rng = random.Random(77)
    groups = {f"g{i}": draws(rng, n, xi, alpha, k) for i, (n, xi, alpha, k) in enumerate(
        [(37, 3.0, 11.0, 0.12), (81, -250.0, 90.0, -0.21), (150, 0.0, 0.5, 0.05)])}
    holes = groups["g0"] + [None] * 5 + [float("nan")]
    odd = {"few": groups["g0"][:3], "same": [-7.25] * 25, "holes": holes,
           "heavy": [0.0] * 40 + [-1e9] * 250}
    df = spark.createDataFrame([(g, v) for g, vs in (groups | odd).items() for v in vs], "g string, v double")
    fit = {r.g: r for r in indices.fit_glo(df, ["g"], "v").collect()}
    for g, values in groups.items():
        assert fit[g].reason is None and fit[g].n == len(values)
        assert (fit[g].glo_xi, fit[g].glo_alpha, fit[g].glo_k) == pytest.approx(glo_by_moments(values), rel=1e-8)
    assert fit["holes"].n == 37 and fit["holes"].glo_k == pytest.approx(fit["g0"].glo_k)
    assert fit["few"].reason == "n_insuffisant" and fit["same"].reason == "l2_degenere"
    assert fit["few"].glo_alpha is None and fit["same"].glo_k is None


def test_reference_fit_reports_every_group(spark):
    rng = random.Random(5)
    rows = [(i, v) for i in range(6) for v in draws(rng, 4 if i < 2 else 40, 1.0, 2.0, 0.1)]
    df = spark.createDataFrame(rows, "cell int, v double")
    report = indices.coverage_report(indices.fit_reference(df, ["cell"], "v")).collect()
    assert {(r.outcome, r.n_groups, round(r.pct, 1)) for r in report} == {
        ("ok", 4, 66.7), ("n_annees_insuffisant", 2, 33.3)}


# ---- station indices ------------------------------------------------------------------

def station(spark, first, last, code="s", every=None):
    rows, i = [], 0
    rng = random.Random(1)
    for year in range(first, last + 1):
        for month in range(1, 13):
            value = 100 + 2 * math.sin(2 * math.pi * month / 12) + rng.gauss(0, 0.5)
            if every and i % every == 0:
                value = -1.0
            rows.append((code, date(year, month, 1), value))
            i += 1
    return spark.createDataFrame(rows, "code string, mois date, val double")


@pytest.mark.parametrize("first, last, flag, start", [
    (1991, 2020, "normale", "1991-01-01"), (2014, 2024, "provisoire", "2014-01-01"),
    (2008, 2037, "adaptee", "2010-01-01")])
def test_reference_ladder(spark, first, last, flag, start):
    grid = indices.reference_grid(station(spark, first, last), "code", "mois", "val").collect()
    assert len(grid) == 12 and {r.flag for r in grid} == {flag}
    assert {str(r.baseline_start) for r in grid} == {start}
    assert all(len(r.quantile_grid) == 99 for r in grid)
    assert all(r.quantile_grid == sorted(r.quantile_grid) for r in grid)


def test_reference_grid_thin_and_positive(spark):
    thin = indices.reference_grid(station(spark, 2015, 2020), "code", "mois", "val").collect()
    assert len(thin) == 12 and all(r.quantile_grid is None for r in thin)
    positive = indices.reference_grid(station(spark, 1991, 2020, every=7), "code", "mois", "val",
                                      positive_only=True).collect()
    assert all(r.quantile_grid[0] > 0 for r in positive)
    only_bad = spark.createDataFrame([("x", date(2000, 1, 1), -1.0)],
                                     "code string, mois date, val double")
    rows = indices.reference_grid(only_bad, "code", "mois", "val", positive_only=True).collect()
    assert [(r.flag, r.n_years, r.quantile_grid) for r in rows] == [("provisoire", 0, None)] * 12


def test_missing_month_borrows_the_nearest_lower_one(spark):
    series = station(spark, 1991, 2020).where("month(mois) not in (6, 12)")
    grid = {r.month: r.quantile_grid
            for r in indices.reference_grid(series, "code", "mois", "val").collect()}
    assert grid[6] == grid[5] and grid[12] == grid[1]


def test_history_scoring_equals_single_scoring(spark):
    series = station(spark, 1991, 2024)
    grid = indices.reference_grid(series, "code", "mois", "val")
    history = indices.score_series(series, grid, "code", "mois", "val")
    last = indices.score_series(indices.last_rows(series, "code", "mois"), grid, "code", "mois", "val")
    top = history.orderBy(F.desc("mois")).first()
    assert (top.z, top.index_class) == tuple(last.select("z", "index_class").first())


def test_percentiles_keep_plateaus_exact(spark):
    values = [24.1] * 4 + [30.3]
    df = spark.createDataFrame([("a", v) for v in values], "k string, v double")
    grid = summaries.percentile_vector(df, ["k"], "v").first()["grid"]
    assert grid[:75] == [24.1] * 75 and grid[75] > 24.1


def test_percentiles_by_rank_selection_equal_sorting(spark):
    rng = random.Random(4)
    inf, nan = float("inf"), float("nan")
    groups = {"a": [rng.gauss(0, 1) for _ in range(900)], "b": [rng.choice([1.5, 2.5, 7.0]) for _ in range(700)],
              "c": [10.0 ** rng.randint(-20, 20) for _ in range(600)] + [-1e308, 1e308], "d": [3.0] * 500,
              None: [rng.random() for _ in range(400)], "e": [5.0, 1.0], "f": [-inf] * 90 + [inf] * 5 + [1.0] * 300,
              "g": [nan] * 3 + [rng.random() for _ in range(200)]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("e", None)], "k string, v double")
    exact = {r.k: (r.grid, r.n) for r in summaries.percentile_vector(df, ["k"], "v", most=None).collect()}
    for most in (150,):
        got = {r.k: (r.grid, r.n) for r in summaries.percentile_vector(df, ["k"], "v", most=most).collect()}
        assert got.keys() == groups.keys()
        for k in got:
            assert repr(got[k]) == repr(exact[k])


def test_percentiles_of_ten_million_values_in_one_group(spark):
    df = spark.range(10_000_000).selectExpr("'x' as k", "cast(pmod(id * 7919, 10000019) as double) as v")
    row = summaries.percentile_vector(df, ["k"], "v", probs=[0.0, 0.25, 0.5, 0.9, 1.0]).first()
    assert row.n == 10_000_000
    values = sorted(i * 7919 % 10_000_019 for i in range(10_000_000))
    for p, g in zip([0.0, 0.25, 0.5, 0.9, 1.0], row.grid):
        low = int(p * 9_999_999)
        a, b = values[low], values[min(low + 1, 9_999_999)]
        assert g == pytest.approx(a + (b - a) * (p * 9_999_999 - low), abs=1e-6)


def test_kernel_index_equals_brute_force(spark):
    series = station(spark, 2000, 2012)
    got = indices.latest_spli(series, "code", "mois", "val").first()
    values = [r.val for r in series.orderBy("mois").collect() if r.mois.month == 12]
    n, mean = len(values), sum(values) / len(values)
    sd = math.sqrt(sum((v - mean) ** 2 for v in values) / (n - 1))
    cdf = sum(NORMAL.cdf((values[-1] - v) / (sd * n ** -0.2)) for v in values) / n
    assert got.z == round(NORMAL.inv_cdf(min(max(cdf, 0.001), 0.999)), 3)
    short = indices.latest_spli(station(spark, 2000, 2003), "code", "mois", "val").first()
    assert (short.z, short.index_class) == (None, "UNKNOWN")


def test_gamma_index_equals_a_grid_search(spark):
    series = station(spark, 2000, 2012, every=11)
    got = indices.latest_ssfi(series, "code", "mois", "val", rounds=8).first()
    usable = [r for r in series.orderBy("mois").collect() if r.val > 0]
    values = [r.val for r in usable if r.mois.month == usable[-1].mois.month]
    mean = sum(values) / len(values)
    mean_log = sum(math.log(v) for v in values) / len(values)

    def loglik(a):
        return (a - 1) * mean_log - a - a * math.log(mean / a) - math.lgamma(a)

    lo, hi = 1.0, 1e7
    for _ in range(300):
        a, b = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        lo, hi = (a, hi) if loglik(a) < loglik(b) else (lo, b)
    z = got.z
    shape = (lo + hi) / 2
    # the gamma law is close to normal at this shape (cube-root transform)
    ratio = (usable[-1].val / mean) ** (1 / 3)
    approx = (ratio - (1 - 1 / (9 * shape))) * 3 * math.sqrt(shape)
    assert z == pytest.approx(approx, abs=0.01)


# ---- quality --------------------------------------------------------------------------

def test_checks_raise_by_severity(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    warn = quality.Check("v_present", lambda d: quality.not_null(d, "v"), "warn")
    hard = quality.Check("k_small", lambda d: quality.accepted_range(d, "k", hi=1))
    assert quality.run_checks(df, [warn])[0] == {"check": "v_present", "failing": 1, "status": "warn"}
    with pytest.raises(quality.CheckFailed, match="k_small"):
        quality.run_checks(df, [warn, hard], audit=str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/k_small").first().k == 2


def test_row_checks_are_counted_together(spark, tmp_path):
    df = spark.range(100)
    checks = [quality.Check("small", bad=F.col("id") >= 90, severity="warn"),
              quality.Check("known", bad=F.col("id").isNull()),
              quality.Check("single", lambda d: quality.unique(d, ["id"]))]
    report = quality.run_checks(df, checks, audit=str(tmp_path))
    assert [(r["check"], r["failing"], r["status"]) for r in report] == [
        ("small", 10, "warn"), ("known", 0, "pass"), ("single", 0, "pass")]
    assert spark.read.parquet(f"{tmp_path}/small").count() == 10


def test_an_empty_referential_is_an_error(spark):
    df = spark.range(3)
    assert quality.require_parent(df, df, "ids").count() == 3
    with pytest.raises(Exception, match="ids: the referential has no rows"):
        quality.require_parent(df, df.where("false"), "ids").collect()


def test_presence_checks(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="missing columns"):
        quality.require_columns(df, ["a", "t2m"])
    with pytest.raises(ValueError, match="no rows"):
        quality.require_nonempty(df.where("false"))


def test_completeness_monitor(spark):
    days = [(date(2024, m, 1),) for m in range(1, 13) if m != 5 for _ in range(10 if m != 7 else 2)]
    df = spark.createDataFrame(days, "d date")
    with pytest.raises(quality.CheckFailed, match="2024-05: MISSING.*2024-07: PARTIAL"):
        quality.completeness_failures({"x": (df, "d")}, "2025-01-15", months=12)
    empty = quality.completeness(df.where("false"), "d", "2025-01-15").collect()
    assert {r.status for r in empty} == {"MISSING"}


# ---- refresh --------------------------------------------------------------------------

def test_update_window():
    now = date(2024, 6, 30)
    assert refresh.update_window(date(2024, 6, 20), now, 5) == (date(2024, 6, 18), date(2024, 6, 25), "ok")
    assert refresh.update_window(None, now, 5) == (date(2024, 4, 26), date(2024, 6, 25), "empty")
    assert refresh.update_window(datetime(2023, 1, 1), now, 5)[2] == "gap"
    assert refresh.update_window(date(2024, 6, 29), now, 5)[2] == "up_to_date"


@pytest.mark.parametrize("start, end, want", [
    ("2024-02-01", "2024-02-29", [(2, 1, 29)]), ("2023-02-01", "2023-03-01", [(2, 1, 28), (3, 1, 1)]),
    ("2024-01-01", "2024-01-01", [(1, 1, 1)]), ("2024-01-10", "2024-02-03", [(1, 10, 31), (2, 1, 3)])])
def test_window_days(spark, start, end, want):
    df = spark.createDataFrame([(start, end)], "a string, b string").selectExpr(
        "date(a) as a", "date(b) as b")
    rows = reshape.window_months(df, "a", "b").orderBy("month").collect()
    assert [(r.month, r.first_day, r.last_day) for r in rows] == want


def test_months_recompute_keeps_row_context_over_gaps(spark):
    days = [("s", date(y, m, 3), float(100 * y + m)) for y in range(2010, 2020) for m in range(1, 13)
            if (y + m) % 3]
    daily = spark.createDataFrame(days, "k string, d date, v double")

    def aggregate(df):
        return summaries.monthly_summary(df, ["k"], "d", "m", {"v": F.avg("v")})

    def roll(df):
        return windows.change_vs(windows.rolling_mean(df, ["k"], "m", "v", 12, "r"), ["k"], "m", "v",
                                 12, "c")

    full = roll(aggregate(daily))
    again = refresh.recompute_months(aggregate, roll, daily, "d", full, "m", months=25)
    assert sorted(map(tuple, again.select(*full.columns).collect())) == sorted(
        map(tuple, full.collect()))


def test_distance_column_is_null_safe(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert df.select(haversine_m("a", "b", "b", "b")).first()[0] is None


# ---- shuffles and tasks of the station facts -----------------------------------------

def _exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def _flow_days(spark):
    labels = ("code_departement nom_departement code_region libelle_region libelle_station libelle_site"
              " type_site code_cours_eau libelle_cours_eau").split()
    weather = "temperature_2m total_precipitation potential_evaporation era5_latitude era5_longitude".split()
    rows = [(s, "S" + s[1:], q, f"2001-{m:02d}-{d:02d}", float(m * d), *[f"{s}{c}{d}" for c in labels],
             *[float(d)] * 5)
            for s in ("H1", "H2") for q in ("H", "QmnJ") for m in (1, 2, 3) for d in (3, 1, 2)]
    names = ["code_station", "code_site", "grandeur_hydro_elab", "date", "resultat_obs_elab", *labels, *weather]
    return spark.createDataFrame(rows, names).withColumn("date", F.col("date").cast("date"))


def test_station_months_move_once(spark):
    from rivulet.plans import facts

    monthly = facts.build_fct_monthly_hydro(_flow_days(spark))
    assert _exchanges(monthly) == 1
    rows = {(r["code_station"], r["grandeur_hydro_elab"], str(r["mois"])): r for r in monthly.collect()}
    assert len(rows) == 12
    march = rows["H1", "H", "2001-03-01"]
    assert (march["resultat_moyen"], march["nb_jours_mesures"], march["libelle_site"]) == (6.0, 3, "H1libelle_site1")
    assert (march["resultat_moy_mobile_3m"], march["variation_resultat_vs_mois_prec"]) == (4.0, 2.0)


def test_measures_of_the_winning_readings(spark):
    """The narrow table holds what the wide one does, where values tie too."""
    from rivulet.plans import staging

    rest = ["date_prod", "code_statut", "libelle_statut", "code_methode", "libelle_methode",
            "code_qualification", "libelle_qualification", "longitude", "latitude"]
    rows = [(site, station, "2001-01-02", quantity, value, f"2001-01-0{1 + i % 5} 06:00:00", *["1"] * 8)
            for i, (site, station, quantity, value) in enumerate([
                ("S1", "H3", "H", "7"), ("S1", "H2", "H", "7"), ("S1", None, "H", "7"), ("S1", "H1", "H", "5"),
                ("S2", "H9", "H", "1"), ("S2", "H9", "H", "1"), ("S2", "H9", "QmnJ", "NULL"), ("S?", "H1", "H", "3")])]
    raw = spark.createDataFrame(rows, ["code_site", "code_station", "date_obs_elab", "grandeur_hydro_elab",
                                       "resultat_obs_elab", *rest])
    sites = spark.createDataFrame([("S1", 1), ("S2", 2)], ["code_site", "geometry"])
    wide = staging.build_stg_hydrometry_obs_elab(raw, sites)
    narrow = staging.build_stg_hydrometry_obs_elab(raw, sites, measures_only=True)
    assert set(narrow.columns) == {"date_obs_elab", "resultat_obs_elab", "code_site", "grandeur_hydro_elab",
                                   "code_station"}
    assert sorted(narrow.collect()) == sorted(wide.select(*narrow.columns).collect())
    assert sorted(r["code_station"] for r in narrow.collect()) == ["H2", "H9"]


def _chain(spark):
    """A chain over two days of one level station and one river station."""
    from checks import chain

    def nulls(names, kind="string"):
        return [F.lit(None).cast(kind).alias(c) for c in names.split()]

    t = chain.Chain(spark, "")
    days = spark.createDataFrame([("ST1", "2001-01-02", 1.0), ("ST1", "2001-01-03", 3.0)], "c string, d string, v double")
    cell = [F.lit("45.0").cast("decimal(6,1)").alias(c) for c in ("era5_latitude", "era5_longitude")]
    t.__dict__ |= {
        "daily_levels": days.select(F.col("c").alias("code_bss"), F.col("d").cast("date").alias("date_mesure"),
                                    F.col("v").alias("niveau_nappe_eau"), F.col("v").alias("profondeur_nappe")),
        "daily_flows": days.select(F.lit("S1").alias("code_site"), F.col("c").alias("code_station"),
                                   F.col("d").cast("date").alias("date_obs_elab"), F.lit("H").alias("grandeur_hydro_elab"),
                                   F.col("v").alias("resultat_obs_elab"), F.lit(1).alias("nb_obs")),
        "mapping": spark.range(1).select(F.lit("ST1").alias("code_bss"), *cell, *nulls(
            "codes_bdlisa code_commune_insee nom_commune altitude_station code_departement nom_departement code_eh"
            " libelle_eh niveau_eh etat_eh nature_eh milieu_eh theme_eh origine_eh station_latitude station_longitude")),
        "hydro_mapping": spark.range(1).select(F.lit("ST1").alias("code_station"), *cell, *nulls(
            "code_departement nom_departement code_region libelle_region code_commune_site libelle_commune"
            " libelle_station libelle_site type_site surface_bv code_zone_hydro_site code_cours_eau libelle_cours_eau"
            " uri_cours_eau station_latitude station_longitude era5_distance_m")),
        "weather": spark.createDataFrame(
            [("45.0", "2001-01-02", 1.0)], "x string, d string, v double").select(
            F.col("x").cast("decimal(6,1)").alias("latitude"), F.col("x").cast("decimal(6,1)").alias("longitude"),
            F.col("d").cast("date").alias("era5_date"),
            *[F.col("v").alias(c) for c in ("temperature_2m", "total_precipitation", "potential_evaporation")])}
    return t


def test_a_series_builds_only_its_own_kind(spark, monkeypatch):
    from checks import chain

    settled = []
    monkeypatch.setattr(chain, "settle", lambda df, name, **_: settled.append((name, df.columns)) or df)
    t = _chain(spark)
    assert [r["val"] for r in t.series["piezo"].collect()] == [2.0]
    assert t.grids["piezo"].count() == 12
    assert settled == [("series_piezo", ["code", "mois", "val", "_tie"])]
    assert set(t.grids) == {"piezo", "hydro"} and [r["val"] for r in t.series["hydro"].collect()] == [2.0]
    with pytest.raises(KeyError):
        t.series["other"]


def test_a_series_plans_its_days(spark, monkeypatch):
    """Days that only the months of a series read are not written as a table first."""
    from checks import chain

    settled = []
    monkeypatch.setattr(chain, "settle", lambda df, name, **_: settled.append(name) or df)
    t = _chain(spark)
    days = t.__dict__.pop("daily_levels")
    monkeypatch.setattr(chain.Chain, "levels", None)
    monkeypatch.setattr(chain.facts, "build_int_daily_measurements", lambda levels: days)
    assert [r["val"] for r in t.series["piezo"].collect()] == [2.0]
    assert settled == ["series_piezo"] and "daily_levels" not in t.__dict__
    stored = t.daily_levels
    assert settled == ["series_piezo", "daily_levels"] and t.pruned("daily_levels", "fact_levels") is stored


def test_cell_days_are_dealt_from_one_calendar(spark, tmp_path, monkeypatch):
    from checks import chain

    settled = []
    monkeypatch.setattr(chain, "settle", lambda df, name, **_: settled.append(name) or df)
    spark.createDataFrame([(1, "2001-05-30", 2.0), (1, "2001-06-02", 3.0), (1, "2001-06-02", 4.0)],
                          "l_suppkey int, day string, l_quantity double").selectExpr(
        "l_suppkey", "CAST(day AS DATE) AS l_shipdate", "l_quantity").write.parquet(f"{tmp_path}/lineitem.parquet")
    t = chain.Chain(spark, str(tmp_path))
    rain, temps = t("raw_rain"), t("raw_temps")
    assert settled == ["cell_calendar"]
    found = rain.groupBy(F.to_date("time").cast("string").alias("d")).agg(F.sort_array(F.collect_list(
        F.col("total_precipitation"))).alias("r")).orderBy("d").collect()
    assert [(x["d"], x["r"]) for x in found] == [("2001-05-30", [2.0]), ("2001-05-31", [0.0]),
                                                 ("2001-06-01", [0.0, 1.0]), ("2001-06-02", [7.0, 8.0])]
    assert temps.count() == 4


def test_years_do_not_write_days_and_months_first(spark, monkeypatch):
    """One write, and the rolling months that no year reads are left out of the plan."""
    from checks import chain, registry
    from rivulet.sources import tables

    registry.load()
    settled = []
    note = lambda df, name, **_: settled.append((name, df)) or df
    monkeypatch.setattr(chain, "settle", note)
    monkeypatch.setattr(tables, "settle", note)
    for query, name, column in (("fct_yearly_stats", "yearly_levels", "niveau_moyen_annuel"),
                                ("fct_yearly_hydro", "yearly_flows", "resultat_moyen_annuel")):
        settled.clear()
        rows = registry.BUILDERS[query](_chain(spark)).collect()
        assert [(r["annee"], r[column], r["nb_jours_mesures_annuel"]) for r in rows] == [(2001, 2.0, 2)]
        assert [n for n, _ in settled] == [name]
        assert "mobile_12m" not in settled[0][1]._jdf.queryExecution().optimizedPlan().toString()
    t = _chain(spark)
    t.__dict__["fact_levels"] = stored = t.pruned("fact_levels")
    assert t.pruned("fact_levels") is stored

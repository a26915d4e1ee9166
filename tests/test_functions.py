from __future__ import annotations

import math
import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from rivulet.functions import calendar, classes, clean, climate, geo, stats

NORMAL = NormalDist()


def one(spark, *cols):
    row = spark.range(1).select(*cols).first()
    return row[0] if len(cols) == 1 else tuple(row)


def gamma_p(a: float, x: float) -> float:
    term = total = 1.0
    for n in range(1, 4000):
        term *= x / (a + n)
        total += term
    return total * math.exp(a * math.log(x) - x - math.lgamma(a + 1))


BOUNDS = [-1.75, -1.28, -0.84, 0.84, 1.28, 1.75]
NAMES = ["EXTREMEMENT_BAS", "TRES_BAS", "BAS", "NORMAL", "HAUT", "TRES_HAUT", "EXTREMEMENT_HAUT"]


def test_seven_classes(spark):
    cases = [(b, NAMES[i + 1]) for i, b in enumerate(BOUNDS)]
    cases += [(math.nextafter(b, -math.inf), NAMES[i]) for i, b in enumerate(BOUNDS)]
    cases += [((a + b) / 2, NAMES[i + 1]) for i, (a, b) in enumerate(zip(BOUNDS, BOUNDS[1:]))]
    df = spark.createDataFrame(cases, "z double, label string")
    assert df.where(classes.classify("z") != F.col("label")).collect() == []


def test_seven_classes_unknown(spark):
    assert one(spark, classes.classify(F.lit(None).cast("double")),
               classes.classify(F.lit(float("nan")))) == ("UNKNOWN", "UNKNOWN")


def test_normal_quantile_and_cdf(spark):
    rows = spark.range(1, 2000).select((F.col("id") / 2000).alias("p")).select(
        "p", stats.norm_ppf("p").alias("z")).withColumn("back", stats.norm_cdf("z")).collect()
    assert max(abs(r.z - NORMAL.inv_cdf(r.p)) for r in rows) < 1e-14
    assert max(abs(r.back - r.p) for r in rows) < 1e-14
    assert one(spark, stats.norm_ppf(F.lit(0.0)), stats.norm_ppf(F.lit(1.0))) == (None, None)
    assert abs(one(spark, stats.norm_ppf(F.lit(1e-20))) - NORMAL.inv_cdf(1e-20)) < 1e-12


def test_gamma_cdf(spark):
    cases = [(4.0, 2.0), (4.0, 20.0), (30.0, 60.0), (100.0, 120.0), (0.3, 0.05), (900.0, 910.0)]
    df = spark.createDataFrame(cases, "a double, x double")
    for row in df.select("a", "x", stats.gamma_cdf("x", "a").alias("p"),
                         stats.lgamma("a").alias("lg")).collect():
        assert abs(row.p - gamma_p(row.a, row.x)) < 1e-9
        assert abs(row.lg - math.lgamma(row.a)) < 1e-12 * max(1.0, abs(row.lg))
    assert one(spark, stats.gamma_cdf(F.lit(-1.0), F.lit(2.0)),
               stats.gamma_cdf(F.lit(1e6), F.lit(2.0))) == (0.0, 1.0)


def test_spi(spark):
    rng, lit = random.Random(3), F.lit
    cases = [(rng.uniform(1, 90), rng.uniform(0.8, 6), rng.uniform(4, 20), rng.uniform(0, 0.4))
             for _ in range(30)]
    df = spark.createDataFrame(cases, "x double, shape double, scale double, dry double")
    for r in df.withColumn("got", stats.spi("x", "shape", "scale", "dry")).collect():
        p = r.dry + (1 - r.dry) * gamma_p(r.shape, r.x / r.scale)
        assert r.got == pytest.approx(NORMAL.inv_cdf(min(max(p, 0.001), 0.999)), abs=0.00051)
    # a dry month, a month beyond the clip, and laws that cannot be
    assert one(spark, stats.spi(lit(0.0), lit(1.7), lit(9.0), lit(0.31))) == round(NORMAL.inv_cdf(0.31), 3)
    assert one(spark, stats.spi(lit(7e5), lit(1.7), lit(9.0), lit(0.1))) == round(NORMAL.inv_cdf(0.999), 3)
    assert one(spark, stats.spi(lit(8.0), lit(1.7), lit(-9.0), lit(0.1)),
               stats.spi(lit(8.0), lit(float("nan")), lit(9.0), lit(0.1))) == (None, None)


def test_sti(spark):
    lit = F.lit
    assert one(spark, stats.sti(lit(3.4), lit(5.1), lit(0.8)),
               stats.sti(lit(-7.3), lit(-7.3), lit(0.0))) == (-2.125, None)


def test_spei(spark):
    lit, a, k, xi = F.lit, 7.5, -0.22, 4.0
    for x in (-3.0, 2.5, 4.0, 11.0, 30.0):
        p = 1 / (1 + (1 - k * (x - xi) / a) ** (1 / k))
        assert one(spark, stats.spei(lit(x), lit(a), lit(k), lit(xi))) == pytest.approx(
            NORMAL.inv_cdf(min(max(p, 0.001), 0.999)), abs=0.00051)
    beyond = xi + a / k - 5  # below the least value this law can give
    assert one(spark, stats.spei(lit(beyond), lit(a), lit(k), lit(xi))) is None
    assert one(spark, stats.spei(lit(xi), lit(0.0), lit(k), lit(xi))) is None


def test_grid_interpolation(spark):
    grid = [float(i) for i in range(1, 50)] + [50.0] * 10 + [float(i) for i in range(51, 91)]
    df = spark.createDataFrame([(v, grid) for v in (-5.0, 1.0, 10.5, 50.0, 90.0, 400.0)],
                               "v double, g array<double>")
    got = [r[0] for r in df.select(stats.grid_probability("v", "g")).collect()]
    assert got == pytest.approx([0.01, 0.01, 0.105, 0.59, 0.99, 0.99])
    assert one(spark, stats.grid_to_zscore(F.lit(1.0), F.lit(None).cast("array<double>"))) is None
    even = spark.createDataFrame([([float(i) for i in range(1, 100)],)], "g array<double>")
    assert even.select(stats.grid_class_bounds("g")).first()[0] == pytest.approx(
        [4.01, 10.03, 20.05, 79.95, 89.97, 95.99])


def test_distances(spark):
    lit = F.lit
    d = one(spark, geo.distance_m(lit(144.424868), lit(-37.951033), lit(143.926496), lit(-37.652821)))
    assert d == pytest.approx(54972.2273, abs=0.05)
    assert one(spark, geo.distance_m(lit(1.0), lit(2.0), lit(1.0), lit(2.0))) == 0.0
    # almost opposite points: the angle does not settle, so no number is given
    assert one(spark, geo.distance_m(lit(0.0), lit(0.3), lit(179.7), lit(-0.2))) is None
    assert one(spark, geo.haversine_m(lit(0.0), lit(0.0), lit(1.0), lit(0.0))) == pytest.approx(
        111195.08, abs=0.01)


def test_concave_polygon(spark):
    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0)]
    df = spark.createDataFrame([(ring, 2.0, 0.5), (ring, 2.0, 3.0), (ring, 3.8, 3.0)],
                               "r array<struct<lon:double,lat:double>>, x double, y double")
    inside = [r[0] for r in df.select(geo.point_in_ring("x", "y", "r")).collect()]
    assert inside == [True, False, True]
    assert df.select(geo.ring_area("r")).first()[0] == 10.0


def test_casts(spark):
    df = spark.createDataFrame([(" 12.6 ",), ("",), ("NULL",), (None,)], "c string")
    assert [r[0] for r in df.select(clean.clean_int("c")).collect()] == [13, None, None, None]
    bad = spark.createDataFrame([("12x",), ("NaN",), ("12.0",), ("7",)], "c string")
    assert [r[0] for r in bad.select(clean.to_int_or_null("c")).collect()] == [None, None, None, 7]
    assert [r[0] for r in bad.select(clean.to_float_or_null("c")).collect()] == [None, None, 12.0, 7.0]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.select(clean.clean_numeric("c")).collect()
    assert one(spark, clean.snap(F.lit(48.09999999999995))) == one(spark, clean.snap(F.lit(48.1)))


def test_calendar(spark):
    day = F.lit("2021-01-03").cast("date")
    parts = calendar.date_parts(day)
    assert one(spark, parts["week"], parts["iso_day_of_week"], parts["is_weekend"]) == (53, 7, True)
    assert str(one(spark, calendar.shift(F.lit("2024-02-29").cast("date"), years=1))) == "2025-02-28"


def test_hargreaves_needs_all_temperatures(spark):
    lit = F.lit
    assert one(spark, climate.hargreaves_et0(lit(10.0), lit(15.0), lit(None).cast("double"),
                                             lit(20.0))) is None
    assert one(spark, climate.hargreaves_et0(lit(10.0), lit(-30.0), lit(-40.0), lit(-20.0))) == 0.0
    ra = one(spark, climate.extraterrestrial_radiation(lit(-20.0), lit(246)))
    assert ra == pytest.approx(32.2 * 0.408, abs=0.05)      # published worked example


def test_sql_names_equal_the_columns(spark):
    from rivulet.functions import sql

    sql.register_functions(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(x / 7 - 3, 0.3 + i % 5, 0.5 + i % 3, (i % 11) / 10, (i % 9) / 5 - 0.9) for i, x in enumerate(range(80))]
    rows += [(None, 1.0, 1.0, 0.5, 0.1), (nan, 1.0, 1.0, 0.5, 0.1), (inf, 1.0, 1.0, 0.5, 0.1), (2.0, -1.0, 1.0, nan, 0.0),
             (50.0, 3.0, 0.1, 1e-9, 1e-8), (0.0, 2.0, 1.0, 1.0, 1.5), (45.0, 30.0, 1.5, 0.0, -0.3)]
    df = spark.createDataFrame(rows, "x double, a double, b double, q double, k double")
    df.createOrReplaceTempView("sql_names")
    got = spark.sql("""SELECT norm_ppf(q) AS a, norm_cdf(x) AS b, log_gamma(b) AS c, gamma_cdf(x, a, b) AS d,
                       spi(x, a, b, q) AS e, sti(x, a, b) AS f, spei(x, b, k, q) AS g, classify(x) AS h FROM sql_names""")
    want = df.select(stats.norm_ppf("q"), stats.norm_cdf("x"), stats.lgamma("b"), stats.gamma_cdf("x", "a", F.col("b")),
                     stats.spi("x", "a", "b", "q"), stats.sti("x", "a", "b"), stats.spei("x", "b", "k", "q"),
                     classes.classify("x"))
    for a, b in zip(got.collect(), want.collect()):
        assert [repr(v) for v in a[4:]] == [repr(v) for v in b[4:]]
        assert [v if v is None or v != v else pytest.approx(v, rel=1e-13) for v in a[:4]] == list(b[:4]) or any(
            v is not None and v != v for v in a[:4])

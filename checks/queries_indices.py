"""Standardized station indices."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import REFERENCE, classify_sql, gamma_cdf_sql, norm_cdf_sql, norm_ppf_sql
from rivulet.functions import stats
from rivulet.operators import indices
from rivulet.plans import climate

_LO, _HI, _YEARS, _PER = REFERENCE
_WINDOW = "s code flag; d baseline_start baseline_end; i n_years"

query("reference_window", _WINDOW, "SELECT * FROM piezo_window")(
    lambda t: indices.reference_window(t.series["piezo"], "code", "mois", (_LO, _HI), _YEARS))

# the same ladder where the fixed period is too short: the best decade window
query("reference_window_adapted", "s code flag; d baseline_start baseline_end; i n_years", f"""
SELECT code, 'adaptee' AS flag, make_date(s, 1, 1) AS baseline_start,
       make_date(s + 29, 12, 31) AS baseline_end, ny AS n_years FROM (
  SELECT *, row_number() OVER (PARTITION BY code ORDER BY ny DESC, s) AS rk FROM (
    SELECT v.code, b.s, COUNT(DISTINCT year(v.mois)) AS ny FROM piezo_series v
    JOIN (SELECT UNNEST([1990, 2000]) AS s) b ON year(v.mois) BETWEEN b.s AND b.s + 29
    GROUP BY 1, 2) c WHERE ny >= {_YEARS}) q WHERE rk = 1""")(
    lambda t: indices.reference_window(t.series["piezo"], "code", "mois", (1960, 1989), _YEARS))

query("reference_window_short", "s code flag; d baseline_start baseline_end; i n_years", """
SELECT code, 'provisoire' AS flag, MIN(mois) AS baseline_start, MAX(mois) AS baseline_end,
       COUNT(DISTINCT year(mois)) AS n_years FROM piezo_series GROUP BY 1""")(
    lambda t: indices.reference_window(t.series["piezo"], "code", "mois"))

_GRID = "s type code flag; i month p n_years; f value; d baseline_start baseline_end"
query("station_reference_stats", _GRID, """
SELECT type, code, month, p, value, flag, n_years, baseline_start, baseline_end FROM (
  SELECT 'piezo' AS type, code, month, UNNEST(range(1, 100)) AS p, UNNEST(quantile_grid) AS value, flag,
         n_years, baseline_start, baseline_end FROM piezo_grid
  UNION ALL
  SELECT 'hydro', code, month, UNNEST(range(1, 100)), UNNEST(quantile_grid), flag, n_years,
         baseline_start, baseline_end FROM hydro_grid) x""")(
    lambda t: climate.build_station_reference_stats(t.grids)
    .select("*", F.posexplode("quantile_grid").alias("i", "value")).withColumn("p", F.col("i") + 1))

@query("borrowed_months", "s code; i month; b own_grid", """
SELECT t.code, t.month, o.n IS NOT NULL AS own_grid
FROM (SELECT DISTINCT code, UNNEST(range(1, 13)) AS month FROM piezo_series) t
LEFT JOIN (SELECT code, month(mois) AS m, COUNT(*) AS n FROM piezo_series
           WHERE mois BETWEEN DATE '1995-01-01' AND DATE '1999-12-31' GROUP BY 1, 2
           HAVING COUNT(*) >= 5) o ON t.code = o.code AND t.month = o.m""")
def borrowed_months(t):
    """Months with five values keep their own grid; the first percentile tells whose it is."""
    series = t.series["piezo"]
    grid = indices.reference_grid(series, "code", "mois", "val", (_LO, _HI), _YEARS, 5)
    inside = series.where(F.col("mois").between("1995-01-01", "1999-12-31"))
    own = inside.groupBy("code", F.month("mois").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.percentile(F.col("val"), F.lit(0.01)).alias("p1"))
    first = F.try_element_at("quantile_grid", F.lit(1))
    return grid.join(own, ["code", "month"], "left").withColumn(
        "own_grid", F.coalesce((F.col("n") >= 5) & (F.abs(first - F.col("p1")) < 1e-9), F.lit(False)))


query("grid_zscores", "s code index_class flag; d mois; f val z", f"""
SELECT code, mois, val, flag, z, {classify_sql('z')} AS index_class FROM piezo_z""")(
    lambda t: indices.score_series(t.series["piezo"], t.grids["piezo"], "code", "mois", "val"))

query("class_boundaries", "s code; i month k; f bound", """
SELECT code, month, k, quantile_grid[CAST(floor(c) AS INTEGER)]
       + (quantile_grid[CAST(floor(c) AS INTEGER) + 1] - quantile_grid[CAST(floor(c) AS INTEGER)])
       * (c - floor(c)) AS bound
FROM piezo_grid CROSS JOIN (SELECT UNNEST(range(1, 7)) AS k,
  UNNEST([4.01, 10.03, 20.05, 79.95, 89.97, 95.99]) AS c) cut""")(
    lambda t: t.grids["piezo"].select(
        "code", "month", F.posexplode(stats.grid_class_bounds("quantile_grid")).alias("i", "bound"))
    .withColumn("k", F.col("i") + 1))

query("seven_classes", "s index_class; l n", f"""
SELECT {classify_sql('z')} AS index_class, COUNT(*) AS n FROM piezo_z GROUP BY 1""")(
    lambda t: indices.score_series(t.series["piezo"], t.grids["piezo"], "code", "mois", "val")
    .groupBy("index_class").agg(F.count(F.lit(1)).alias("n")))

query("fct_monthly_index", "s type code index_class flag; d month; f z", f"""
SELECT type, code, mois AS month, z, {classify_sql('z')} AS index_class, flag FROM (
  SELECT 'piezo' AS type, code, mois, z, flag FROM piezo_z
  UNION ALL SELECT 'hydro', code, mois, z, flag FROM (
    SELECT *, row_number() OVER (PARTITION BY code, mois ORDER BY tie, val) AS rk FROM hydro_z) h
  WHERE rk = 1) x""")(lambda t: climate.build_fct_monthly_index(t.series, t.grids))

query("station_current_index", "s code type index_name index_class; f index_value;"
      " d ref_month baseline_start baseline_end", f"""
SELECT code, type, index_name, z AS index_value, {classify_sql('z')} AS index_class, mois AS ref_month,
       baseline_start, baseline_end FROM (
  SELECT *, 'piezo' AS type, 'IPS' AS index_name, row_number() OVER (PARTITION BY code ORDER BY mois DESC) AS rk
  FROM piezo_z UNION ALL
  SELECT *, 'hydro', 'SSFI', row_number() OVER (PARTITION BY code ORDER BY mois DESC, tie DESC, val)
  FROM hydro_z) x WHERE rk = 1""")(
    lambda t: climate.build_station_current_index(t.series, t.grids))

_PLAIN = """(SELECT code_bss AS code, CAST(date_trunc('month', date_mesure) AS DATE) AS mois,
       AVG(niveau_nappe_eau) AS val FROM daily_levels GROUP BY 1, 2)"""


def _plain(t):
    return t.plain_monthly.select(F.col("code_bss").alias("code"), "mois",
                                  F.col("niveau_moyen").alias("val"))


_LAST = f"""SELECT code, COUNT(*) AS n, MAX(mois) AS last, arg_max(val, mois) AS x
  FROM {_PLAIN} s GROUP BY 1 HAVING COUNT(*) >= 60"""
_KERNEL = f"""SELECT v.code, l.x, v.val, COUNT(*) OVER (PARTITION BY v.code) AS k,
       stddev_samp(v.val) OVER (PARTITION BY v.code) AS sd
  FROM {_PLAIN} v JOIN ({_LAST}) l ON v.code = l.code AND month(v.mois) = month(l.last)"""
_PHI = f"""SELECT code, {norm_cdf_sql('u')} AS phi
  FROM (SELECT *, (x - val) / (sd * pow(k, -0.2)) AS u FROM ({_KERNEL}) k1 WHERE k >= 5) k2"""
_SPLI = f"""SELECT code, round({norm_ppf_sql('p')}, 3) AS z FROM (
  SELECT code, least(greatest(AVG(phi), 0.001), 0.999) AS p FROM ({_PHI}) k3 GROUP BY 1) k4"""
query("latest_spli", "s code index_class; f z", f"""
SELECT c.code, z, {classify_sql('z')} AS index_class
FROM (SELECT DISTINCT code FROM {_PLAIN} s) c LEFT JOIN ({_SPLI}) k ON c.code = k.code""")(
    lambda t: indices.latest_spli(_plain(t), "code", "mois", "val", min_per_month=5))



def _newton_sql(rows: str, rounds: int = 8) -> str:
    """ln(a) - digamma(a) = s, round by round as nested subqueries."""
    sums = [" + ".join(f"1/pow(a+{j},{p})" for j in range(8)) for p in (1, 2)]
    sql = f"SELECT *, (3-s+sqrt((s-3)*(s-3)+24*s))/(12*s) AS a FROM ({rows}) r WHERE s > 0"
    for _ in range(rounds):
        sql = f"SELECT *, a+8 AS b, 1/((a+8)*(a+8)) AS i FROM ({sql}) n0"
        sql = (f"SELECT *, ln(b) - 1/(2*b) - i*(1.0/12 - i*(1.0/120 - i*(1.0/252 - i/240))) - ({sums[0]}) AS psi,"
               f" 1/b + i/2 + i/b*(1.0/6 - i*(1.0/30 - i*(1.0/42 - i/30))) + ({sums[1]}) AS psi1 FROM ({sql}) n1")
        sql = (f"SELECT code, x, mean, s, greatest(a - (ln(a)-psi-s)/(1/a-psi1), a/10) AS a FROM ({sql}) n2")
    return sql


_POSITIVE = f"(SELECT * FROM {_PLAIN} p0 WHERE val > 0)"
_LAST_POSITIVE = f"""SELECT code, MAX(mois) AS last, arg_max(val, mois) AS x
  FROM {_POSITIVE} s GROUP BY 1 HAVING COUNT(*) >= 60"""
_GAMMA = f"""SELECT v.code, any_value(l.x) AS x, AVG(v.val) AS mean, ln(AVG(v.val)) - AVG(ln(v.val)) AS s
  FROM {_POSITIVE} v JOIN ({_LAST_POSITIVE}) l ON v.code = l.code AND month(v.mois) = month(l.last)
  GROUP BY 1 HAVING COUNT(*) >= 5"""
_SSFI = f"""SELECT code, round({norm_ppf_sql('p')}, 3) AS z FROM (
  SELECT code, least(greatest({gamma_cdf_sql('u', 'a')}, 0.001), 0.999) AS p
  FROM (SELECT code, a, x * a / mean AS u FROM ({_newton_sql(_GAMMA)}) g0) g1) g2"""
query("latest_ssfi", "s code index_class; f z", f"""
SELECT c.code, z, {classify_sql('z')} AS index_class
FROM (SELECT DISTINCT code FROM {_PLAIN} s) c LEFT JOIN ({_SSFI}) k ON c.code = k.code""")(
    lambda t: indices.latest_ssfi(_plain(t), "code", "mois", "val", min_per_month=5))

"""Climate grid, normals, SPEI reference and gridded indices."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import (INDEX_END, INDEX_START, NORMALS, classify_sql, gamma_cdf_sql, norm_cdf_sql,
                          norm_ppf_sql)
from rivulet.functions import sql, stats
from rivulet.operators import indices
from rivulet.operators.joins import attach_normals
from rivulet.plans import climate
from rivulet.sources import files

_START, _END, _YEARS = NORMALS
_CELL = "era5_latitude era5_longitude"

query("grid_record_normalisation", "t time; f latitude longitude temperature_2m total_precipitation"
      " potential_evaporation; s source_file_id", """
SELECT time, latitude, longitude, temperature_2m + 273.15 - 273.15 AS temperature_2m,
       total_precipitation / 1000 * 1000 AS total_precipitation,
       potential_evaporation / 1000 * 1000 AS potential_evaporation, 'batch_1' AS source_file_id
FROM raw_rain""")(
    lambda t: files.normalize_grid_records(t("raw_rain").select(
        F.col("time").alias("valid_time"), "latitude", "longitude",
        (F.col("temperature_2m") + 273.15).alias("t2m"),
        (F.col("total_precipitation") / 1000).alias("tp"),
        (F.col("potential_evaporation") / 1000).alias("pev")), "batch_1"))

query("bronze_inventory", "s source_file_id; l n_rows; t first_time last_time", """
SELECT source_file_id, COUNT(*) AS n_rows, MIN(time) AS first_time, MAX(time) AS last_time
FROM raw_rain GROUP BY 1""")(lambda t: files.load_inventory(t("raw_rain")))

query("fct_era5_monthly_grid", f"f {_CELL} temperature_moyenne temperature_min temperature_max"
      " precipitation_totale etp_totale bilan_hydrique etp_pev_era5; d mois; l nb_jours nb_jours_temp;"
      " b mois_complet temp_complet", "SELECT * FROM monthly_grid")(
    lambda t: climate.build_fct_era5_monthly_grid(t.rain, t.temps))

query("fct_era5_climatology_grid", f"f {_CELL} precip_moyenne precip_stddev prob_zero gamma_alpha"
      " gamma_beta temp_moyenne temp_stddev; i mois_calendaire fenetre; l nb_annees nb_annees_temp",
      "SELECT * FROM normals")(
    lambda t: climate.build_fct_era5_climatology_grid(t.monthly_grid, _START, _END))

query("fct_era5_spei_climatology_grid", f"f {_CELL} glo_alpha glo_k glo_xi; i mois_calendaire fenetre"
      " nb_annees", "SELECT *, n AS nb_annees FROM spei_params")(lambda t: t.spei_params)

query("glo_fit", f"f {_CELL} glo_alpha glo_k glo_xi; i mois_calendaire fenetre; l n; s reason",
      "SELECT * FROM spei_fits")(lambda t: t.spei_fits)

query("glo_coverage", "s outcome; i fenetre; l n_groups; f pct", """
SELECT fenetre, coalesce(reason, 'ok') AS outcome, COUNT(*) AS n_groups,
       round(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY fenetre), 1) AS pct
FROM spei_fits GROUP BY 1, 2""")(lambda t: indices.coverage_report(t.spei_fits, ["fenetre"]))

query("normals_with_spei", f"f {_CELL} gamma_alpha glo_alpha glo_k; i mois_calendaire fenetre", """
SELECT n.era5_latitude, n.era5_longitude, n.mois_calendaire, n.fenetre, n.gamma_alpha, s.glo_alpha, s.glo_k
FROM normals n LEFT JOIN spei_params s USING (era5_latitude, era5_longitude, mois_calendaire, fenetre)""")(
    lambda t: attach_normals(t.normals, t.spei_params))

_INDEX = f"f {_CELL} spi sti spei; d month; i fenetre"
query("fct_era5_indices_grid", _INDEX, "SELECT * FROM grid_index")(
    lambda t: climate.build_fct_era5_indices_grid(
        t.monthly_grid, t.normals, t.spei_params, INDEX_END, start=INDEX_START, min_years=_YEARS))


@query("indices_nightly_upsert", _INDEX, "SELECT * FROM grid_index")
def indices_nightly_upsert(t):
    """A stale target, then the last three months rescored: equal to the full history."""
    full = climate.build_fct_era5_indices_grid(t.monthly_grid, t.normals, t.spei_params, INDEX_END,
                                               start=INDEX_START, min_years=_YEARS)
    recent = F.col("month") >= F.lit("2001-08-01").cast("date")
    stale = full.withColumn("spi", F.when(recent, F.lit(9.0)).otherwise(F.col("spi")))
    return climate.build_fct_era5_indices_grid(t.monthly_grid, t.normals, t.spei_params, INDEX_END,
                                               target=stale, months=3, min_years=_YEARS)


@query("indices_nightly_partition", _INDEX, "SELECT * FROM grid_index")
def indices_nightly_partition(t):
    """The same as a stored table: the first run fills it, the second rewrites the last years."""
    path = t.scratch("indices")
    args = (path, t.monthly_grid, t.normals, t.spei_params)
    climate.store_fct_era5_indices_grid(*args, "2001-06-01", start=INDEX_START, min_years=_YEARS)
    return climate.store_fct_era5_indices_grid(*args, INDEX_END, months=12, min_years=_YEARS)


# ---- distribution functions on data-driven arguments -------------------------------

_RANKED = """(SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice,
       (l_extendedprice - 800) / 110000 AS p, l_extendedprice / 12000 - 4 AS x,
       l_extendedprice / 3000 AS g, l_quantity / 4 + 0.3 AS a FROM lineitem) r"""
_KEYS = "l l_orderkey l_partkey; i l_linenumber"


def _ranked(t):
    price = F.col("l_extendedprice")
    return t("lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", ((price - 800) / 110000).alias("p"),
        (price / 12000 - 4).alias("x"), (price / 3000).alias("g"),
        (F.col("l_quantity") / 4 + 0.3).alias("a"))


query("normal_quantile", _KEYS + "; f z", f"SELECT *, {norm_ppf_sql('p')} AS z FROM {_RANKED}")(
    lambda t: _ranked(t).withColumn("z", stats.norm_ppf("p")))
query("normal_cdf", _KEYS + "; f c", f"SELECT *, {norm_cdf_sql('x')} AS c FROM {_RANKED}")(
    lambda t: _ranked(t).withColumn("c", stats.norm_cdf("x")))
query("gamma_cdf", _KEYS + "; f c", f"SELECT *, {gamma_cdf_sql('g', 'a')} AS c FROM {_RANKED}")(
    lambda t: _ranked(t).withColumn("c", stats.gamma_cdf("g", "a")))
query("log_gamma", _KEYS + "; f v", f"SELECT *, lgamma(a) AS v FROM {_RANKED}")(
    lambda t: _ranked(t).withColumn("v", stats.lgamma("a")))


@query("sql_functions", _KEYS + "; f z c gc; s index_class",
       f"SELECT *, {norm_ppf_sql('p')} AS z, {norm_cdf_sql('x')} AS c, {gamma_cdf_sql('g', 'a')} AS gc,"
       f" {classify_sql(norm_ppf_sql('p'))} AS index_class FROM {_RANKED}")
def sql_functions(t):
    """The functions by their SQL names, in SQL text only."""
    sql.register_functions(t.spark)
    return t.spark.sql("""SELECT *, norm_ppf(p) AS z, norm_cdf(x) AS c, gamma_cdf(g, a, 1D) AS gc,
                          classify(norm_ppf(p)) AS index_class FROM {ranked}""", ranked=_ranked(t))

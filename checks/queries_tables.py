"""The composed station tables, their rejects and the data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.chain import READING_TASK
from checks.registry import query
from checks.views import AS_OF, ct, num, top1
from rivulet.functions import clean
from rivulet.operators import quality, summaries
from rivulet.operators.dedup import first_per_key
from rivulet.plans import facts, staging
from rivulet.sources import files, tables

# ---- silver ----------------------------------------------------------------------

query("stg_piezo_stations", "f x y altitude_station; d date_debut_mesure date_fin_mesure; t date_maj;"
      " i nb_mesures_piezo; s code_bss code_commune_insee nom_commune code_departement"
      " nom_departement codes_bdlisa bss_id libelle_pe", "SELECT * FROM stg_stations")(
    lambda t: staging.build_stg_piezo_stations(t("raw_stations")))
query("stg_piezo_chroniques", "d date_mesure; f niveau_nappe_eau profondeur_nappe; s code_bss",
      "SELECT * FROM stg_levels")(lambda t: t.levels)
query("stg_hydrometry_sites", "f longitude_site latitude_site surface_bv; s code_site code_departement"
      " libelle_departement libelle_site type_site code_commune_site libelle_commune code_region"
      " libelle_region code_zone_hydro_site; t date_maj_site", "SELECT * FROM stg_sites")(
    lambda t: staging.build_stg_hydrometry_sites(t.raw_sites))
query("stg_hydrometry_stations", "d date_ouverture_station date_fermeture_station; t date_maj_station;"
      " f longitude_station latitude_station altitude_ref_alti_station; s code_station code_site"
      " code_departement libelle_station libelle_site code_cours_eau libelle_cours_eau"
      " uri_cours_eau libelle_departement", "SELECT * FROM stg_hydro_stations")(
    lambda t: staging.build_stg_hydrometry_stations(t("raw_hydro_stations"), t.sites))
query("stg_hydrometry_obs_elab", "d date_obs_elab; f resultat_obs_elab longitude latitude; s code_site"
      " grandeur_hydro_elab code_station code_statut libelle_statut code_methode libelle_methode"
      " code_qualification libelle_qualification; t date_prod; f site_lon site_lat", """
SELECT f.*, s.longitude_site AS site_lon, s.latitude_site AS site_lat
FROM stg_flows f JOIN stg_sites s ON f.code_site = s.code_site""")(
    lambda t: t.flows.withColumns({"site_lon": F.col("geometry.lon"),
                                   "site_lat": F.col("geometry.lat")}))
query("stg_era5_timeseries", "f latitude longitude temperature_2m total_precipitation"
      " potential_evaporation; t time created_at; s source_file_id", "SELECT * FROM stg_rain")(
    lambda t: staging.build_stg_era5_timeseries(t("raw_rain")))
query("stg_era5_daily_temp_stats", "f latitude longitude t2m_mean t2m_min t2m_max; t time created_at;"
      " s source_file_id", "SELECT * FROM stg_temps")(
    lambda t: staging.build_stg_era5_daily_temp_stats(t("raw_temps")))
query("stg_tme_entites", "s tme_id code_eh libelle_eh ordre_abs_eh niveau_eh libelle_niveau_eh"
      " inclus_eh etat_eh libelle_etat_eh nature_eh libelle_nature_eh milieu_eh libelle_milieu_eh"
      " theme_eh libelle_theme_eh origine_eh libelle_origine_eh", "SELECT * FROM stg_tme")(
    lambda t: staging.build_stg_tme_entites(t("raw_entites")))

# ---- rejects ---------------------------------------------------------------------

_LEVEL_REASON = f"""CASE WHEN {ct('date_mesure')} IS NULL THEN 'DATE_MESURE_NULL'
       WHEN {ct('code_bss')} IS NULL THEN 'CODE_BSS_NULL'
       WHEN {num('niveau_nappe_eau')} IS NULL AND {num('profondeur_nappe')} IS NULL THEN 'AUCUNE_MESURE'
       WHEN {ct('code_bss')} NOT IN (SELECT code_bss FROM stg_stations) THEN 'STATION_INEXISTANTE' END"""
_LEVEL_REJECTS = (f"SELECT * FROM (SELECT *, {_LEVEL_REASON} AS rejection_reason FROM raw_levels) r "
                  "WHERE rejection_reason IS NOT NULL")
query("piezo_chroniques_rejected", "s _dlt_id code_bss date_mesure niveau_nappe_eau profondeur_nappe"
      " rejection_reason", _LEVEL_REJECTS)(
    lambda t: staging.build_piezo_chroniques_rejected(t("raw_levels"), t.stations))
query("hydrometry_stations_rejected", "s _dlt_id code_station code_site rejection_reason", f"""
SELECT * FROM (SELECT *, CASE WHEN {ct('code_station')} IS NULL THEN 'CODE_STATION_NULL'
  WHEN {ct('code_site')} NOT IN (SELECT code_site FROM stg_sites) THEN 'CODE_SITE_NOT_IN_SITES'
  WHEN {ct('longitude_station')} IS NULL OR {ct('latitude_station')} IS NULL THEN 'COORDS_NULL' END
  AS rejection_reason FROM raw_hydro_stations) r WHERE rejection_reason IS NOT NULL""")(
    lambda t: staging.build_hydrometry_stations_rejected(t("raw_hydro_stations"), t.sites))
query("hydrometry_obs_rejected", "s _dlt_id code_site date_obs_elab resultat_obs_elab rejection_reason", f"""
SELECT * FROM (SELECT *, CASE WHEN {ct('code_site')} IS NULL THEN 'CODE_SITE_NULL'
  WHEN {ct('code_site')} NOT IN (SELECT code_site FROM stg_sites) THEN 'CODE_SITE_NOT_IN_SITES'
  WHEN {ct('date_obs_elab')} IS NULL THEN 'DATE_OBS_ELAB_NULL'
  WHEN {ct('grandeur_hydro_elab')} IS NULL THEN 'GRANDEUR_HYDRO_NULL'
  WHEN {num('resultat_obs_elab')} IS NULL THEN 'RESULTAT_OBS_NULL' END AS rejection_reason
  FROM raw_flows) r WHERE rejection_reason IS NOT NULL""")(
    lambda t: staging.build_hydrometry_obs_rejected(t("raw_flows"), t.sites))
query("accepted_rows", "s _dlt_id code_bss", f"""
SELECT _dlt_id, code_bss FROM raw_levels WHERE {_LEVEL_REASON} IS NULL""")(
    lambda t: quality.split_rejects(t("raw_levels"), staging.piezo_chroniques_rules(), t.stations,
                                    "code_bss")[0])


def _stored_split(t):
    return tables.store_split(quality.labelled_rejects(
        t("raw_levels"), staging.piezo_chroniques_rules(), t.stations, "code_bss"), t.scratch("split"))


query("stored_accepts", "s _dlt_id code_bss", f"""
SELECT _dlt_id, code_bss FROM raw_levels WHERE {_LEVEL_REASON} IS NULL""")(
    lambda t: _stored_split(t)[0])
query("stored_rejects", "s _dlt_id code_bss date_mesure niveau_nappe_eau profondeur_nappe"
      " rejection_reason", _LEVEL_REJECTS)(lambda t: _stored_split(t)[1])
query("reject_volume", "s rejection_reason; l n",
      f"SELECT rejection_reason, COUNT(*) AS n FROM ({_LEVEL_REJECTS}) x GROUP BY 1")(
    lambda t: summaries.reject_volume(
        staging.build_piezo_chroniques_rejected(t("raw_levels"), t.stations)))


@query("new_rejects_only", "s _dlt_id rejection_reason", f"""
SELECT _dlt_id, rejection_reason FROM ({_LEVEL_REJECTS}) x
WHERE date_mesure IS NULL OR CAST(date_mesure AS DATE) >= DATE '2000-01-01'""")
def new_rejects_only(t):
    rejects = staging.build_piezo_chroniques_rejected(t("raw_levels"), t.stations)
    logged = rejects.where("cast(date_mesure as date) < date '2000-01-01'")
    return quality.append_rejects(logged, rejects)


# ---- intermediate ----------------------------------------------------------------

query("int_daily_measurements", "s code_bss; d date_mesure; f niveau_nappe_eau profondeur_nappe",
      "SELECT * FROM daily_levels")(lambda t: facts.build_int_daily_measurements(t.levels))
query("int_hydro_daily_measurements", "s code_site code_station grandeur_hydro_elab; d date_obs_elab;"
      " f resultat_obs_elab; i nb_obs", "SELECT * FROM daily_flows")(lambda t: t.daily_flows)
query("int_era5_grid_points", "f era5_latitude era5_longitude lon lat", """
SELECT *, era5_longitude AS lon, era5_latitude AS lat FROM grid_points""")(
    lambda t: facts.build_int_era5_grid_points(t.rain).withColumns(
        {"lon": F.col("geom.lon"), "lat": F.col("geom.lat")}))
query("int_station_era5_mapping", "s code_bss; f era5_latitude era5_longitude station_latitude"
      " station_longitude era5_distance_m altitude_station; s codes_bdlisa code_commune_insee"
      " nom_commune code_departement nom_departement code_eh libelle_eh niveau_eh libelle_niveau_eh"
      " etat_eh libelle_etat_eh nature_eh libelle_nature_eh milieu_eh libelle_milieu_eh theme_eh"
      " libelle_theme_eh origine_eh libelle_origine_eh", "SELECT * FROM mapping")(
    lambda t: t.mapping)
query("int_hydro_station_era5_mapping", "s code_station code_site; f station_latitude"
      " station_longitude era5_latitude era5_longitude era5_distance_m surface_bv;"
      " s code_departement nom_departement libelle_station libelle_site code_cours_eau"
      " libelle_cours_eau uri_cours_eau code_commune_site libelle_commune code_region libelle_region"
      " code_zone_hydro_site type_site", "SELECT * FROM hydro_mapping")(lambda t: t.hydro_mapping)
query("int_era5_for_all_stations", "f latitude longitude temperature_2m total_precipitation"
      " potential_evaporation; d era5_date", "SELECT * FROM weather")(lambda t: t.weather)

# ---- facts -----------------------------------------------------------------------

query("piezo_daily_chroniques", "s code_bss; d date; f niveau_nappe_eau profondeur_nappe temperature_2m"
      " total_precipitation potential_evaporation altitude_station station_latitude"
      " station_longitude era5_latitude era5_longitude; s codes_bdlisa code_commune_insee"
      " nom_commune code_departement nom_departement code_eh libelle_eh niveau_eh etat_eh nature_eh"
      " milieu_eh theme_eh origine_eh", "SELECT * FROM fact_levels")(lambda t: t.fact_levels)
query("hydro_daily_chroniques", "s code_site code_station; d date; s grandeur_hydro_elab;"
      " f resultat_obs_elab temperature_2m total_precipitation potential_evaporation surface_bv"
      " station_latitude station_longitude era5_latitude era5_longitude era5_distance_m; i nb_obs;"
      " s code_departement nom_departement code_region libelle_region code_commune_site"
      " libelle_commune libelle_station libelle_site type_site code_zone_hydro_site code_cours_eau"
      " libelle_cours_eau uri_cours_eau", "SELECT * FROM fact_flows")(lambda t: t.fact_flows)
_MONTH_WEATHER = (" temperature_moyenne temperature_min temperature_max precipitation_totale"
                  " evaporation_moyenne era5_latitude era5_longitude precipitation_moy_mobile_12m")
MONTHLY_LEVELS = (
    "s code_bss code_departement nom_departement code_eh libelle_eh; d mois; f niveau_moyen"
    " niveau_min niveau_max amplitude_mensuelle niveau_stddev profondeur_moyenne profondeur_min"
    " profondeur_max" + _MONTH_WEATHER + " niveau_moy_mobile_3m niveau_moy_mobile_12m"
    " variation_niveau_vs_mois_prec variation_niveau_vs_annee_prec; l nb_jours_mesures")
query("fct_monthly_chroniques", MONTHLY_LEVELS, "SELECT * FROM monthly_levels")(
    lambda t: facts.build_fct_monthly_chroniques(t.pruned("fact_levels")))
query("fct_monthly_hydro", "s code_station code_site grandeur_hydro_elab code_departement"
      " nom_departement code_region libelle_region libelle_station libelle_site type_site"
      " code_cours_eau libelle_cours_eau; d mois; f resultat_moyen resultat_min resultat_max"
      " amplitude_mensuelle resultat_stddev" + _MONTH_WEATHER + " resultat_moy_mobile_3m"
      " resultat_moy_mobile_12m variation_resultat_vs_mois_prec variation_resultat_vs_annee_prec;"
      " l nb_jours_mesures", "SELECT * FROM monthly_flows")(
    lambda t: facts.build_fct_monthly_hydro(t.fact_flows))
_YEAR = (" temperature_moyenne_annuelle temperature_min_annuelle temperature_max_annuelle"
         " precipitation_totale_annuelle evaporation_moyenne_annuelle era5_latitude era5_longitude"
         " variation_precipitation_vs_annee_prec; l nb_jours_mesures_annuel nb_mois_mesures")
YEARLY_LEVELS = (
    "s code_bss code_departement nom_departement code_eh libelle_eh classification_niveau_annuel;"
    " i annee; f niveau_moyen_annuel niveau_min_annuel niveau_max_annuel amplitude_annuelle"
    " niveau_stddev_annuel profondeur_moyenne_annuelle bilan_hydrique_annuel"
    " variation_niveau_vs_annee_prec variation_niveau_pct percentile_niveau_historique"
    " percentile_precipitation_historique niveau_moy_mobile_5ans" + _YEAR)
query("fct_yearly_stats", YEARLY_LEVELS, "SELECT * FROM yearly_levels")(
    lambda t: tables.settle(facts.build_fct_yearly_stats(t.pruned("monthly_levels")), "yearly_levels",
                            task_bytes=READING_TASK))
query("fct_yearly_hydro", "s code_station code_site grandeur_hydro_elab code_departement"
      " nom_departement code_region libelle_region libelle_station libelle_site"
      " classification_resultat_annuel; i annee; f resultat_moyen_annuel resultat_min_annuel"
      " resultat_max_annuel amplitude_annuelle resultat_stddev_annuel"
      " variation_resultat_vs_annee_prec percentile_resultat_historique" + _YEAR,
      "SELECT * FROM yearly_flows")(
    lambda t: tables.settle(facts.build_fct_yearly_hydro(t.pruned("monthly_flows")), "yearly_flows",
                            task_bytes=READING_TASK))

# ---- dimensions ------------------------------------------------------------------

# slopes per second that split the stations of the given tables; compared times 1e9
_STEEP, _ALARMING = 1e-8, 3e-8

query("dim_piezo_stations", "s code_bss bss_id nom_commune code_commune_insee code_departement"
      " nom_departement codes_bdlisa classification_derniere_annee tendance_classification"
      " niveau_alerte qualite_tendance; d date_debut_mesure date_fin_mesure premiere_mesure"
      " derniere_mesure; f altitude_station longitude latitude niveau_moyen_global niveau_min_absolu"
      " niveau_max_absolu niveau_stddev_global amplitude_totale profondeur_moyenne_globale"
      " temperature_moyenne_globale precipitation_moyenne_mensuelle niveau_derniere_annee"
      " percentile_derniere_annee slope_niveau r2_niveau slope_precipitation; i nb_mesures_source"
      " derniere_annee; l nb_mesures_total nb_mois_total nb_mois_tendance", f"""
SELECT * EXCLUDE (slope_niveau, slope_precipitation), slope_niveau * 1e9 AS slope_niveau,
       slope_precipitation * 1e9 AS slope_precipitation FROM (
SELECT s.*, s.x AS longitude, s.y AS latitude, s.nb_mesures_piezo AS nb_mesures_source, d.*
       EXCLUDE (code_bss), g.* EXCLUDE (code_bss), t.* EXCLUDE (code_bss),
       l.annee AS derniere_annee, l.niveau_moyen_annuel AS niveau_derniere_annee,
       l.classification_niveau_annuel AS classification_derniere_annee,
       l.percentile_niveau_historique AS percentile_derniere_annee,
       CASE WHEN slope_niveau IS NULL THEN 'INSUFFISANT' WHEN slope_niveau > {_STEEP} THEN 'HAUSSE'
            WHEN slope_niveau < -{_STEEP} THEN 'BAISSE' ELSE 'STABLE' END AS tendance_classification,
       CASE WHEN slope_niveau < -{_ALARMING} THEN 'ALERTE' WHEN slope_niveau < -{_STEEP} THEN 'VIGILANCE'
            ELSE 'NORMAL' END AS niveau_alerte,
       CASE WHEN r2_niveau IS NULL THEN 'NON_CALCULEE' WHEN r2_niveau >= 0.5 THEN 'FIABLE'
            WHEN r2_niveau >= 0.2 THEN 'INDICATIVE' ELSE 'FAIBLE' END AS qualite_tendance
FROM stg_stations s
LEFT JOIN (SELECT code_bss, MIN(date) AS premiere_mesure, MAX(date) AS derniere_mesure
           FROM fact_levels GROUP BY 1) d ON s.code_bss = d.code_bss
LEFT JOIN (SELECT code_bss, SUM(nb_jours_mesures) AS nb_mesures_total, COUNT(*) AS nb_mois_total,
             AVG(niveau_moyen) AS niveau_moyen_global, MIN(niveau_min) AS niveau_min_absolu,
             MAX(niveau_max) AS niveau_max_absolu, stddev_samp(niveau_moyen) AS niveau_stddev_global,
             MAX(niveau_max) - MIN(niveau_min) AS amplitude_totale,
             AVG(profondeur_moyenne) AS profondeur_moyenne_globale,
             AVG(temperature_moyenne) AS temperature_moyenne_globale,
             AVG(precipitation_totale) AS precipitation_moyenne_mensuelle
           FROM monthly_levels GROUP BY 1) g ON s.code_bss = g.code_bss
LEFT JOIN (SELECT code_bss, regr_slope(niveau_moyen, epoch(mois)) AS slope_niveau,
             regr_r2(niveau_moyen, epoch(mois)) AS r2_niveau,
             regr_slope(precipitation_totale, epoch(mois)) AS slope_precipitation,
             COUNT(*) AS nb_mois_tendance FROM monthly_levels
           WHERE mois >= DATE '{AS_OF}' - INTERVAL 60 MONTH GROUP BY 1 HAVING COUNT(*) >= 24) t
  ON s.code_bss = t.code_bss
LEFT JOIN ({top1('SELECT * FROM yearly_levels', 'code_bss', 'annee DESC')}) l
  ON s.code_bss = l.code_bss) d""")(
    lambda t: facts.build_dim_piezo_stations(
        t.stations, t.fact_levels, t.monthly_levels, t.yearly_levels, AS_OF, steep=_STEEP,
        alarming=_ALARMING).withColumns({c: F.col(c) * 1e9 for c in (
            "slope_niveau", "slope_precipitation")}))
_LIFE = """SELECT code_station, grandeur_hydro_elab, SUM(nb_jours_mesures) AS nb_jours_total,
             COUNT(*) AS nb_mois_total, AVG(resultat_moyen) AS resultat_moyen_global,
             MIN(resultat_min) AS resultat_min_global, MAX(resultat_max) AS resultat_max_global,
             stddev_samp(resultat_moyen) AS resultat_stddev_global
           FROM monthly_flows GROUP BY 1, 2"""
query("dim_hydro_stations", "s code_station libelle_station code_site libelle_site code_cours_eau"
      " nom_cours_eau uri_cours_eau code_departement nom_departement statut_station"
      " grandeur_hydro_principale classification_resultat_dern_annee; d date_ouverture_station"
      " date_fermeture_station premiere_mesure derniere_mesure; f longitude_station latitude_station"
      " resultat_moyen_global resultat_min_global resultat_max_global resultat_stddev_global"
      " resultat_moyen_dern_annee percentile_resultat_dern_annee; l nb_jours_total nb_mois_total;"
      " i annee_dernier_bilan", f"""
SELECT s.*, s.libelle_cours_eau AS nom_cours_eau, s.libelle_departement AS nom_departement,
       CASE WHEN date_fermeture_station IS NULL OR date_fermeture_station > DATE '{AS_OF}'
            THEN 'ACTIVE' ELSE 'FERMEE' END AS statut_station,
       g.grandeur_hydro_elab AS grandeur_hydro_principale, d.premiere_mesure, d.derniere_mesure,
       g.nb_jours_total, g.nb_mois_total, g.resultat_moyen_global, g.resultat_min_global,
       g.resultat_max_global, g.resultat_stddev_global, y.annee AS annee_dernier_bilan,
       y.resultat_moyen_annuel AS resultat_moyen_dern_annee,
       y.classification_resultat_annuel AS classification_resultat_dern_annee,
       y.percentile_resultat_historique AS percentile_resultat_dern_annee
FROM stg_hydro_stations s
LEFT JOIN (SELECT code_station, MIN(date) AS premiere_mesure, MAX(date) AS derniere_mesure
           FROM fact_flows GROUP BY 1) d ON s.code_station = d.code_station
LEFT JOIN ({top1(_LIFE, 'code_station', 'nb_jours_total DESC NULLS LAST, grandeur_hydro_elab')}) g
  ON s.code_station = g.code_station
LEFT JOIN ({top1('SELECT * FROM yearly_flows', 'code_station, grandeur_hydro_elab', 'annee DESC')}) y
  ON s.code_station = y.code_station AND g.grandeur_hydro_elab = y.grandeur_hydro_elab""")(
    lambda t: facts.build_dim_hydro_stations(t.hydro_stations, t.fact_flows, t.monthly_flows,
                                             t.yearly_flows, AS_OF))
query("dim_date", "d date; i year quarter month week day_of_year iso_day_of_week; b is_weekend", """
SELECT date, year(date) AS year, quarter(date) AS quarter, month(date) AS month, week(date) AS week,
       dayofyear(date) AS day_of_year, isodow(date) AS iso_day_of_week,
       isodow(date) IN (6, 7) AS is_weekend
FROM (SELECT CAST(UNNEST(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT MIN(d) AS a, MAX(d) AS b FROM (
        SELECT date_mesure AS d FROM daily_levels UNION ALL SELECT date_obs_elab FROM daily_flows) u) v) w""")(
    lambda t: facts.build_dim_date(t.daily_levels.withColumnRenamed("date_mesure", "date"),
                                   t.daily_flows.withColumnRenamed("date_obs_elab", "date"),
                                   as_of=AS_OF))
query("dim_geography", "s code_commune nom_commune code_departement nom_departement code_region"
      " nom_region", """
SELECT code_commune, MAX(nom_commune) AS nom_commune, code_departement,
       MAX(nom_departement) AS nom_departement, MAX(code_region) AS code_region,
       MAX(nom_region) AS nom_region
FROM (SELECT code_commune_insee AS code_commune, nom_commune, code_departement, nom_departement,
             CAST(NULL AS VARCHAR) AS code_region, CAST(NULL AS VARCHAR) AS nom_region FROM stg_stations
      UNION ALL SELECT code_commune_site, libelle_commune, code_departement, libelle_departement,
             code_region, libelle_region FROM stg_sites) u
WHERE code_departement IS NOT NULL GROUP BY 1, 3""")(
    lambda t: facts.build_dim_geography(t.stations, t.sites))

# ---- data quality ----------------------------------------------------------------

query("check_not_null", "s _dlt_id", "SELECT _dlt_id FROM raw_levels WHERE date_mesure IS NULL")(
    lambda t: quality.not_null(t("raw_levels"), "date_mesure"))
query("check_unique", "l l_orderkey n; i l_linenumber", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")(
    lambda t: quality.unique(t("lineitem"), ["l_orderkey", "l_linenumber"]))
query("check_accepted_values", "s _dlt_id grandeur_hydro_elab", """
SELECT _dlt_id, grandeur_hydro_elab FROM raw_flows WHERE grandeur_hydro_elab NOT IN ('QmnJ', 'QmxJ')""")(
    lambda t: quality.accepted_values(t("raw_flows"), "grandeur_hydro_elab", ["QmnJ", "QmxJ"]))
query("check_relationships", "s code_bss; d date_mesure", """
SELECT code_bss, date_mesure FROM best_levels
WHERE code_bss NOT IN (SELECT code_bss FROM stg_stations)""")(
    lambda t: quality.relationships(_best(t), "code_bss", t.stations, spread=["date_mesure"]))
query("check_accepted_range", "f latitude longitude total_precipitation; t time", """
SELECT * FROM stg_rain WHERE (total_precipitation < 0 OR total_precipitation > 60)
  AND time >= TIMESTAMP '1996-01-01'""")(
    lambda t: quality.accepted_range(t.rain, "total_precipitation", 0, 60, "time >= '1996-01-01'"))
query("check_expression", "f latitude longitude t2m_mean t2m_min t2m_max; t time", """
SELECT * FROM raw_temps WHERE NOT coalesce(t2m_min <= t2m_mean - 4 AND t2m_mean <= t2m_max, FALSE)""")(
    lambda t: quality.expression_is_true(t("raw_temps"),
                                         "t2m_min <= t2m_mean - 4 and t2m_mean <= t2m_max"))
query("source_freshness", "t latest; i age_days; s status", f"""
SELECT MAX(o_orderdate) AS latest, DATE '{AS_OF}' - CAST(MAX(o_orderdate) AS DATE) AS age_days,
       CASE WHEN DATE '{AS_OF}' - CAST(MAX(o_orderdate) AS DATE) > 365 THEN 'error'
            WHEN DATE '{AS_OF}' - CAST(MAX(o_orderdate) AS DATE) > 30 THEN 'warn' ELSE 'pass' END AS status
FROM orders""")(lambda t: quality.freshness(t("orders"), "o_orderdate", AS_OF, 30, 365))
_COUNTS = f"""SELECT c.m, COUNT(e.o_orderkey) AS n FROM (
  SELECT CAST(UNNEST(generate_series(date_trunc('month', DATE '{AS_OF}') - INTERVAL 13 MONTH,
       date_trunc('month', DATE '{AS_OF}') - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS m) c
LEFT JOIN orders e ON date_trunc('month', e.o_orderdate) = c.m GROUP BY 1"""
query("month_completeness", "d m; l n; f median; s status", f"""
SELECT m, n, median, CASE WHEN n = 0 THEN 'MISSING' WHEN n < median * 50 / 100 THEN 'PARTIAL'
       ELSE 'OK' END AS status
FROM ({_COUNTS}) a CROSS JOIN (SELECT quantile_cont(n, 0.5) AS median FROM ({_COUNTS}) b WHERE n > 0) d""")(
    lambda t: quality.completeness(t("orders"), "o_orderdate", AS_OF))


def _best(t):
    rows = t("raw_levels").select(
        clean.clean_date("date_mesure").alias("date_mesure"),
        clean.clean_numeric("niveau_nappe_eau").alias("niveau_nappe_eau"),
        clean.clean_numeric("profondeur_nappe").alias("profondeur_nappe"),
        clean.clean_text("code_bss").alias("code_bss"))
    rows = quality.require_any(quality.require_not_null(rows, ["date_mesure", "code_bss"]),
                               ["niveau_nappe_eau", "profondeur_nappe"])
    return first_per_key(rows, ["code_bss", "date_mesure"], [("niveau_nappe_eau", "desc")])


# ---- entity files ------------------------------------------------------------------

_EATTR = files.ENTITY_ATTRIBUTES


def _entity_union() -> str:
    parts = [f"SELECT {i} AS file_no, tme_id, TRIM(code_eh) AS code_eh, "
             + ", ".join(f"NULLIF({a}, '') AS {a}" for a in _EATTR) + f" FROM {name}"
             for i, name in enumerate(("entities_a", "entities_b"))]
    score = " + ".join(f"CASE WHEN {a} IS NULL THEN 0 ELSE 1 END" for a in _EATTR)
    return (f"SELECT *, {score} AS score FROM ({' UNION ALL '.join(parts)}) u "
            "WHERE regexp_matches(code_eh, '[A-Za-z]')")


query("merge_best_entities", "s tme_id code_eh " + " ".join(_EATTR), top1(
    _entity_union(), "code_eh", "score DESC, file_no, tme_id NULLS LAST, "
    + ", ".join(f"{a} NULLS LAST" for a in _EATTR)))(
    lambda t: files.merge_best_attributes([t("entities_a"), t("entities_b")]))
query("entity_code_stats", "l n_codes n_with_letter n_regional", """
SELECT COUNT(*) AS n_codes, COUNT(CASE WHEN regexp_matches(code_eh, '[A-Za-z]') THEN 1 END) AS n_with_letter,
       COUNT(CASE WHEN regexp_matches(code_eh, '^0[0-9]{2}[A-Za-z]') THEN 1 END) AS n_regional
FROM entities_a""")(lambda t: files.entity_code_stats(t("entities_a")))
query("header_harmonisation", "s tme_id code_eh " + " ".join(_EATTR), """
SELECT tme_id, code_eh, libelle_eh, ordre_abs_eh, niveau_eh, NULL AS inclus_eh, etat_eh, nature_eh,
       NULL AS milieu_eh, NULL AS theme_eh, NULL AS origine_eh FROM raw_entites""")(
    lambda t: files.harmonize_headers(t("raw_entites").select(
        F.col("tme_id").alias("id"), F.col("code_eh").alias("Code EH"),
        F.col("libelle_eh").alias("LibelleEH"), F.col("ordre_abs_eh").alias("OrdreAbsEH"),
        F.col("niveau_eh").alias(" NIVEAU EH"), F.col("etat_eh").alias("Etat_EH"),
        F.col("nature_eh").alias("nature_eh"), F.lit("x").alias("unrelated"))))


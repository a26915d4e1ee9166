"""Gold tables of the station chain: daily, monthly and yearly facts, dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.functions import geo
from rivulet.functions.calendar import date_parts
from rivulet.functions.clean import in_bbox, snap
from rivulet.functions.classes import (alert_level, pct_change, quintile_class, station_status,
                                       trend_class, trend_quality)
from rivulet.operators import joins, spatial
from rivulet.operators.dedup import first_per_key, latest_row
from rivulet.operators.refresh import lookback_filter, map_new, newer_than
from rivulet.operators.reshape import date_series, overall_bounds, union_distinct
from rivulet.operators.summaries import (annual_balance, coverage, daily_mean, geography,
                                         lifetime_stats, linear_trend, min_count,
                                         monthly_summary, spread, yearly_summary)
from rivulet.operators.windows import frame, series

BOX = (41.0, 52.0, -5.5, 10.0)
WEATHER = ["temperature_2m", "total_precipitation", "potential_evaporation"]
ENTITY_ATTRS = ["libelle_eh", "niveau_eh", "libelle_niveau_eh", "etat_eh", "libelle_etat_eh",
                "nature_eh", "libelle_nature_eh", "milieu_eh", "libelle_milieu_eh", "theme_eh",
                "libelle_theme_eh", "origine_eh", "libelle_origine_eh"]


def build_int_daily_measurements(chroniques: DataFrame, target: DataFrame | None = None,
                                 days: int = 7) -> DataFrame:
    if target is not None:
        chroniques = lookback_filter(chroniques, target, "date_mesure", days)
    return daily_mean(chroniques, ["code_bss"], "date_mesure",
                      ["niveau_nappe_eau", "profondeur_nappe"])


def build_int_hydro_daily_measurements(obs: DataFrame, stations: DataFrame,
                                       target: DataFrame | None = None, days: int = 7
                                       ) -> DataFrame:
    if target is not None:
        obs = lookback_filter(obs, target, "date_obs_elab", days)
    daily = daily_mean(obs, ["code_site", "code_station", "grandeur_hydro_elab"],
                       "date_obs_elab", ["resultat_obs_elab"], with_count="nb_obs")
    return joins.keep_known(daily, stations, "code_station").select(
        "code_site", "code_station", "date_obs_elab", "grandeur_hydro_elab",
        "resultat_obs_elab", "nb_obs")


def build_int_era5_grid_points(timeseries: DataFrame) -> DataFrame:
    cells = timeseries.select(snap("latitude").alias("era5_latitude"),
                              snap("longitude").alias("era5_longitude"))
    return (cells.where("era5_latitude is not null and era5_longitude is not null").distinct()
            .withColumn("geom", geo.make_point("era5_longitude", "era5_latitude")))


def _nearest_cell(stations: DataFrame, grid: DataFrame, key: str, lat: str, lon: str,
                  distance) -> DataFrame:
    inside = stations.where(in_bbox(lat, lon, BOX))
    found = spatial.nearest(inside, grid, key, lat, lon)
    return found.withColumn("era5_distance_m",
                            distance(lon, lat, "era5_longitude", "era5_latitude"))


def build_int_station_era5_mapping(stations: DataFrame, grid: DataFrame, entities: DataFrame,
                                   mapped: DataFrame | None = None, recompute_all: bool = False,
                                   distance=geo.distance_m) -> DataFrame:
    """Station -> nearest cell and entity: first listed code, any listed code, polygon."""

    def build(todo: DataFrame) -> DataFrame:
        inside = todo.where(in_bbox("y", "x", BOX)).select(
            "code_bss", "x", "y", "geometry", "codes_bdlisa", "code_commune_insee",
            "nom_commune", "altitude_station", "code_departement", "nom_departement")
        matched = joins.match_entity(inside, entities, "code_bss", "codes_bdlisa",
                                     attrs=ENTITY_ATTRS)
        missed = matched.where("matched_by is null").select("code_bss", "x", "y")
        around = spatial.contains_join(missed, entities, "code_bss", "x", "y", "geometry",
                                       "code_eh", ENTITY_ATTRS)
        filled = joins.coalesce_sources(matched, ["code_eh", *ENTITY_ATTRS], around, "code_bss")
        located = _nearest_cell(inside.select("code_bss", "x", "y"), grid, "code_bss", "y", "x",
                                distance).drop("x", "y")
        filled = filled.join(located, "code_bss")
        return filled.select(
            "code_bss", "era5_latitude", "era5_longitude", F.col("y").alias("station_latitude"),
            F.col("x").alias("station_longitude"), F.col("geometry").alias("geom"),
            "era5_distance_m", "codes_bdlisa", "code_commune_insee", "nom_commune",
            "altitude_station", "code_departement", "nom_departement",
            F.coalesce("code_eh", "primary_code").alias("code_eh"), *ENTITY_ATTRS)

    if mapped is None:
        return build(stations)
    return map_new(stations, mapped, "code_bss", build, recompute_all)


SITE_ATTRS = ["surface_bv", "code_commune_site", "libelle_commune", "code_region",
              "libelle_region", "code_zone_hydro_site", "type_site"]


def build_int_hydro_station_era5_mapping(stations: DataFrame, sites: DataFrame, grid: DataFrame,
                                         mapped: DataFrame | None = None,
                                         recompute_all: bool = False,
                                         distance=geo.distance_m) -> DataFrame:
    def build(todo: DataFrame) -> DataFrame:
        located = _nearest_cell(todo, grid, "code_station", "latitude_station",
                                "longitude_station", distance)
        full = joins.enrich(located, sites, "code_site", SITE_ATTRS)
        return full.select(
            "code_station", "code_site", F.col("latitude_station").alias("station_latitude"),
            F.col("longitude_station").alias("station_longitude"),
            F.col("geometry").alias("geom"), "era5_latitude", "era5_longitude",
            "era5_distance_m", "code_departement",
            F.col("libelle_departement").alias("nom_departement"), "libelle_station",
            "libelle_site", "code_cours_eau", "libelle_cours_eau", "uri_cours_eau", *SITE_ATTRS)

    if mapped is None:
        return build(stations)
    return map_new(stations, mapped, "code_station", build, recompute_all)


def build_int_era5_for_all_stations(timeseries: DataFrame, temps: DataFrame,
                                    *mappings: DataFrame, target: DataFrame | None = None
                                    ) -> DataFrame:
    """Daily weather of the cells some station uses; rain drives, temperature joins.

    Incremental runs keep the days after the target's last one (the caller that
    must not lose back-filled days leaves ``target`` out or upserts).
    """
    cells = union_distinct(*[m.select(F.col("era5_latitude").alias("latitude"),
                                      F.col("era5_longitude").alias("longitude"))
                             for m in mappings])
    key = ["latitude", "longitude", "era5_date"]

    def daily(df: DataFrame, *measures: str) -> DataFrame:
        rows = df.select(snap("latitude").alias("latitude"), snap("longitude").alias("longitude"),
                         F.to_date("time").alias("era5_date"), "created_at", *measures)
        rows = joins.restrict_to_cells(rows, cells, ["latitude", "longitude"])
        if target is not None:
            rows = newer_than(rows, target, "era5_date")
        return first_per_key(rows, key, [("created_at", "desc")]).drop("created_at")

    rain = daily(timeseries.where("total_precipitation is not null "
                                  "and potential_evaporation is not null"),
                 "total_precipitation", "potential_evaporation")
    warm = daily(temps, "t2m_mean").withColumnRenamed("t2m_mean", "temperature_2m")
    return joins.left_align(rain, warm, key).select(*key, *WEATHER)


def build_piezo_daily_chroniques(measurements: DataFrame, mapping: DataFrame, weather: DataFrame,
                                 since: Column | None = None) -> DataFrame:
    """Daily groundwater fact; ``since`` bounds both sources for a partial recompute."""
    meta = ["codes_bdlisa", "code_commune_insee", "nom_commune", "altitude_station",
            "code_departement", "nom_departement", "code_eh", "libelle_eh", "niveau_eh",
            "etat_eh", "nature_eh", "milieu_eh", "theme_eh", "origine_eh", "station_latitude",
            "station_longitude", "era5_latitude", "era5_longitude"]
    rows, days = measurements.withColumnRenamed("date_mesure", "date"), weather
    if since is not None:
        rows, days = rows.where(F.col("date") >= since), days.where(F.col("era5_date") >= since)
    fact = joins.join_weather(rows, mapping.select("code_bss", *meta), days, "code_bss", "date")
    return fact.select("code_bss", "date", "niveau_nappe_eau", "profondeur_nappe", *WEATHER, *meta)


def build_hydro_daily_chroniques(measurements: DataFrame, mapping: DataFrame, weather: DataFrame,
                                 since: Column | None = None) -> DataFrame:
    meta = ["code_departement", "nom_departement", "code_region", "libelle_region",
            "code_commune_site", "libelle_commune", "libelle_station", "libelle_site",
            "type_site", "surface_bv", "code_zone_hydro_site", "code_cours_eau",
            "libelle_cours_eau", "uri_cours_eau", "station_latitude", "station_longitude",
            "era5_latitude", "era5_longitude", "era5_distance_m"]
    rows, days = measurements.withColumnRenamed("date_obs_elab", "date"), weather
    if since is not None:
        rows, days = rows.where(F.col("date") >= since), days.where(F.col("era5_date") >= since)
    fact = joins.join_weather(rows, mapping.select("code_station", *meta), days,
                              "code_station", "date")
    return fact.select("code_site", "code_station", "date", "grandeur_hydro_elab",
                       "resultat_obs_elab", "nb_obs", *WEATHER, *meta)


def _monthly_weather() -> dict[str, Column]:
    return {
        "temperature_moyenne": F.avg("temperature_2m"),
        "temperature_min": F.min("temperature_2m"),
        "temperature_max": F.max("temperature_2m"),
        "precipitation_totale": F.sum("total_precipitation"),
        "evaporation_moyenne": F.avg("potential_evaporation"),
        "nb_jours_mesures": F.count(F.lit(1)),
        "era5_latitude": F.min("era5_latitude"),
        "era5_longitude": F.min("era5_longitude"),
    }


def aggregate_monthly_chroniques(daily: DataFrame) -> DataFrame:
    """One shuffle, by station, serves the months and the windows over them: days of a month
    are too few and too spread out for partial sums to shrink, and a station has one row a day."""
    daily = daily.repartition("code_bss")
    spec = {c: F.min(c) for c in ("code_departement", "nom_departement", "code_eh", "libelle_eh")}
    spec |= spread("niveau_nappe_eau", "niveau", "amplitude_mensuelle", "niveau_stddev")
    spec |= {"profondeur_moyenne": F.avg("profondeur_nappe"),
             "profondeur_min": F.min("profondeur_nappe"),
             "profondeur_max": F.max("profondeur_nappe")}
    return monthly_summary(daily, ["code_bss"], "date", "mois", spec | _monthly_weather())


def _roll_monthly(monthly: DataFrame, keys: list[str], mean: str, prefix: str) -> DataFrame:
    rows = series(keys, "mois")
    return monthly.withColumns({
        f"{prefix}_moy_mobile_3m": F.avg(mean).over(frame(keys, "mois", 3)),
        f"{prefix}_moy_mobile_12m": F.avg(mean).over(frame(keys, "mois", 12)),
        "precipitation_moy_mobile_12m": F.avg("precipitation_totale").over(
            frame(keys, "mois", 12)),
        f"variation_{prefix}_vs_mois_prec": F.col(mean) - F.lag(mean, 1).over(rows),
        f"variation_{prefix}_vs_annee_prec": F.col(mean) - F.lag(mean, 12).over(rows),
    })


def roll_monthly_chroniques(monthly: DataFrame) -> DataFrame:
    return _roll_monthly(monthly, ["code_bss"], "niveau_moyen", "niveau")


def build_fct_monthly_chroniques(daily: DataFrame) -> DataFrame:
    return roll_monthly_chroniques(aggregate_monthly_chroniques(daily))


def aggregate_monthly_hydro(daily: DataFrame) -> DataFrame:
    """One shuffle, by station and quantity, as in ``aggregate_monthly_chroniques``."""
    daily = daily.repartition("code_station", "grandeur_hydro_elab")
    spec = {c: F.min(c) for c in ("code_departement", "nom_departement", "code_region",
                                  "libelle_region", "libelle_station", "libelle_site",
                                  "type_site", "code_cours_eau", "libelle_cours_eau")}
    spec |= spread("resultat_obs_elab", "resultat", "amplitude_mensuelle", "resultat_stddev")
    return monthly_summary(daily, ["code_station", "code_site", "grandeur_hydro_elab"], "date",
                           "mois", spec | _monthly_weather())


def roll_monthly_hydro(monthly: DataFrame) -> DataFrame:
    return _roll_monthly(monthly, ["code_station", "grandeur_hydro_elab"], "resultat_moyen",
                         "resultat")


def build_fct_monthly_hydro(daily: DataFrame) -> DataFrame:
    return roll_monthly_hydro(aggregate_monthly_hydro(daily))


def _yearly_measure(prefix: str) -> dict[str, Column]:
    return {
        f"{prefix}_moyen_annuel": F.avg(f"{prefix}_moyen"),
        f"{prefix}_min_annuel": F.min(f"{prefix}_min"),
        f"{prefix}_max_annuel": F.max(f"{prefix}_max"),
        "amplitude_annuelle": F.max(f"{prefix}_max") - F.min(f"{prefix}_min"),
        f"{prefix}_stddev_annuel": F.stddev_samp(f"{prefix}_moyen"),
    }


def _yearly_weather() -> dict[str, Column]:
    return {
        "temperature_moyenne_annuelle": F.avg("temperature_moyenne"),
        "temperature_min_annuelle": F.min("temperature_min"),
        "temperature_max_annuelle": F.max("temperature_max"),
        "precipitation_totale_annuelle": F.sum("precipitation_totale"),
        "evaporation_moyenne_annuelle": F.avg("evaporation_moyenne"),
    }


def _yearly_counts() -> dict[str, Column]:
    return {
        "nb_jours_mesures_annuel": F.sum("nb_jours_mesures"),
        "nb_mois_mesures": F.count(F.lit(1)),
        "era5_latitude": F.min("era5_latitude"),
        "era5_longitude": F.min("era5_longitude"),
    }


def build_fct_yearly_stats(monthly: DataFrame) -> DataFrame:
    key = ["code_bss"]
    spec = {c: F.min(c) for c in ("code_departement", "nom_departement", "code_eh", "libelle_eh")}
    spec |= _yearly_measure("niveau")
    spec |= {"profondeur_moyenne_annuelle": F.avg("profondeur_moyenne")}
    spec |= _yearly_weather()
    spec |= {"bilan_hydrique_annuel": annual_balance("precipitation_totale",
                                                     "evaporation_moyenne", "mois")}
    yearly = yearly_summary(monthly, key, "mois", "annee", spec | _yearly_counts())
    by_year = series(key, "annee")
    ranked = yearly.withColumns({
        "_level": F.lag("niveau_moyen_annuel").over(by_year),
        "_rain": F.lag("precipitation_totale_annuelle").over(by_year),
        "niveau_moy_mobile_5ans": F.avg("niveau_moyen_annuel").over(frame(key, "annee", 5)),
        "percentile_niveau_historique": F.percent_rank().over(series(key, "niveau_moyen_annuel")),
        "percentile_precipitation_historique": F.percent_rank().over(
            series(key, "precipitation_totale_annuelle")),
    })
    return ranked.select(
        *yearly.columns,
        (F.col("niveau_moyen_annuel") - F.col("_level")).alias("variation_niveau_vs_annee_prec"),
        (F.col("precipitation_totale_annuelle") - F.col("_rain"))
        .alias("variation_precipitation_vs_annee_prec"),
        pct_change("niveau_moyen_annuel", "_level").alias("variation_niveau_pct"),
        "percentile_niveau_historique", "percentile_precipitation_historique",
        quintile_class("percentile_niveau_historique").alias("classification_niveau_annuel"),
        "niveau_moy_mobile_5ans")


def build_fct_yearly_hydro(monthly: DataFrame) -> DataFrame:
    key = ["code_station", "grandeur_hydro_elab"]
    spec = {c: F.min(c) for c in ("code_departement", "nom_departement", "code_region",
                                  "libelle_region", "libelle_station", "libelle_site")}
    spec |= _yearly_measure("resultat") | _yearly_weather() | _yearly_counts()
    yearly = yearly_summary(monthly, ["code_station", "code_site", "grandeur_hydro_elab"],
                            "mois", "annee", spec)
    by_year = series(key, "annee")
    ranked = yearly.withColumns({
        "_value": F.lag("resultat_moyen_annuel").over(by_year),
        "_rain": F.lag("precipitation_totale_annuelle").over(by_year),
        "percentile_resultat_historique": F.percent_rank().over(
            series(key, "resultat_moyen_annuel")),
    })
    return ranked.select(
        *yearly.columns,
        (F.col("resultat_moyen_annuel") - F.col("_value"))
        .alias("variation_resultat_vs_annee_prec"),
        (F.col("precipitation_totale_annuelle") - F.col("_rain"))
        .alias("variation_precipitation_vs_annee_prec"),
        "percentile_resultat_historique",
        quintile_class("percentile_resultat_historique").alias("classification_resultat_annuel"))


def build_dim_piezo_stations(stations: DataFrame, daily: DataFrame, monthly: DataFrame,
                             yearly: DataFrame, as_of: str, trend_years: int = 5,
                             min_trend_months: int = 24, steep: float = 1e-4,
                             alarming: float = 5e-4) -> DataFrame:
    """``steep`` and ``alarming`` are slopes per second from which a trend has a class."""
    key = "code_bss"
    dates = coverage(daily, key, "date")
    life = lifetime_stats(monthly, [key], {
        "nb_mesures_total": F.sum("nb_jours_mesures"), "nb_mois_total": F.count(F.lit(1)),
        "niveau_moyen_global": F.avg("niveau_moyen"), "niveau_min_absolu": F.min("niveau_min"),
        "niveau_max_absolu": F.max("niveau_max"),
        "niveau_stddev_global": F.stddev_samp("niveau_moyen"),
        "amplitude_totale": F.max("niveau_max") - F.min("niveau_min"),
        "profondeur_moyenne_globale": F.avg("profondeur_moyenne"),
        "temperature_moyenne_globale": F.avg("temperature_moyenne"),
        "precipitation_moyenne_mensuelle": F.avg("precipitation_totale")})
    since = F.add_months(F.lit(as_of).cast("date"), -12 * trend_years)
    rain = F.regr_slope(F.col("precipitation_totale"),
                        (F.unix_date("mois").cast("bigint") * 86400).cast("double"))
    trend = min_count(linear_trend(monthly, key, "mois", "niveau_moyen", since, "_niveau",
                                   with_n="nb_mois_tendance",
                                   extra={"slope_precipitation": rain}),
                      "nb_mois_tendance", min_trend_months)
    last = latest_row(yearly, [key], [("annee", "desc")]).select(
        key, F.col("annee").alias("derniere_annee"),
        F.col("niveau_moyen_annuel").alias("niveau_derniere_annee"),
        F.col("classification_niveau_annuel").alias("classification_derniere_annee"),
        F.col("percentile_niveau_historique").alias("percentile_derniere_annee"))
    joined = stations
    for part in (dates, life, trend, last):
        joined = joined.join(part, key, "left")
    return joined.select(
        key, "bss_id", "nom_commune", "code_commune_insee", "code_departement",
        "nom_departement", "codes_bdlisa", "altitude_station", F.col("x").alias("longitude"),
        F.col("y").alias("latitude"), F.col("geometry").alias("geom"), "date_debut_mesure",
        "date_fin_mesure", F.col("nb_mesures_piezo").alias("nb_mesures_source"),
        "nb_mesures_total", "nb_mois_total", "premiere_mesure", "derniere_mesure",
        "niveau_moyen_global", "niveau_min_absolu", "niveau_max_absolu", "niveau_stddev_global",
        "amplitude_totale", "profondeur_moyenne_globale", "temperature_moyenne_globale",
        "precipitation_moyenne_mensuelle", "derniere_annee", "niveau_derniere_annee",
        "classification_derniere_annee", "percentile_derniere_annee", "slope_niveau",
        "r2_niveau", "slope_precipitation", "nb_mois_tendance",
        trend_class("slope_niveau", steep).alias("tendance_classification"),
        alert_level("slope_niveau", -alarming, -steep).alias("niveau_alerte"),
        trend_quality("r2_niveau").alias("qualite_tendance"),
        F.current_timestamp().alias("date_calcul"))


def build_dim_hydro_stations(stations: DataFrame, daily: DataFrame, monthly: DataFrame,
                             yearly: DataFrame, as_of: str) -> DataFrame:
    key, quantity = "code_station", "grandeur_hydro_elab"
    dates = coverage(daily, key, "date")
    life = lifetime_stats(monthly, [key, quantity], {
        "nb_jours_total": F.sum("nb_jours_mesures"), "nb_mois_total": F.count(F.lit(1)),
        "resultat_moyen_global": F.avg("resultat_moyen"),
        "resultat_min_global": F.min("resultat_min"),
        "resultat_max_global": F.max("resultat_max"),
        "resultat_stddev_global": F.stddev_samp("resultat_moyen")})
    principal = first_per_key(life, [key], [("nb_jours_total", "desc")], ties=[quantity])
    last = latest_row(yearly, [key, quantity], [("annee", "desc")]).select(
        key, quantity, F.col("annee").alias("annee_dernier_bilan"),
        F.col("resultat_moyen_annuel").alias("resultat_moyen_dern_annee"),
        F.col("classification_resultat_annuel").alias("classification_resultat_dern_annee"),
        F.col("percentile_resultat_historique").alias("percentile_resultat_dern_annee"))
    facts = principal.join(last, [key, quantity], "left")
    joined = stations.join(dates, key, "left").join(facts, key, "left")
    return joined.select(
        key, "libelle_station", "code_site", "libelle_site", "code_cours_eau",
        F.col("libelle_cours_eau").alias("nom_cours_eau"), "uri_cours_eau", "code_departement",
        F.col("libelle_departement").alias("nom_departement"), "date_ouverture_station",
        "date_fermeture_station", "longitude_station", "latitude_station", "geometry",
        station_status("date_fermeture_station", as_of).alias("statut_station"),
        F.col(quantity).alias("grandeur_hydro_principale"), "premiere_mesure", "derniere_mesure",
        "nb_jours_total", "nb_mois_total", "resultat_moyen_global", "resultat_min_global",
        "resultat_max_global", "resultat_stddev_global", "annee_dernier_bilan",
        "resultat_moyen_dern_annee", "classification_resultat_dern_annee",
        "percentile_resultat_dern_annee")


def build_dim_date(*facts: DataFrame, as_of: str, date: str = "date") -> DataFrame:
    days = date_series(overall_bounds(*facts, date=date), as_of)
    return days.select("date", *[c.alias(n) for n, c in date_parts("date").items()])


def build_dim_geography(piezo_stations: DataFrame, hydro_sites: DataFrame) -> DataFrame:
    piezo = piezo_stations.select(F.col("code_commune_insee").alias("code_commune"),
                                  "nom_commune", "code_departement", "nom_departement")
    hydro = hydro_sites.select(
        F.col("code_commune_site").alias("code_commune"),
        F.col("libelle_commune").alias("nom_commune"), "code_departement",
        F.col("libelle_departement").alias("nom_departement"), "code_region",
        F.col("libelle_region").alias("nom_region"))
    return geography(piezo, hydro).select(
        "code_commune", "nom_commune", "code_departement", "nom_departement", "code_region",
        "nom_region")

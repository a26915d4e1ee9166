"""Silver tables and their reject trails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rivulet.functions.clean import (clean_date, clean_int, clean_numeric, clean_text,
                                     clean_timestamp, decode, snap)
from rivulet.functions.geo import make_point
from rivulet.operators.dedup import first_per_key
from rivulet.operators.joins import enrich, keep_known
from rivulet.operators.quality import (append_rejects, require_any, require_not_null,
                                       require_parent, split_rejects)
from rivulet.operators.refresh import lookback_bound, newer_than, since_bound
from rivulet.operators.reshape import select_with_rest

LOADER_COLUMNS = ["_dlt_load_id", "_dlt_id"]


def _text(*names: str) -> list[Column]:
    return [clean_text(n).alias(n) for n in names]


def _number(*names: str) -> list[Column]:
    return [clean_numeric(n).alias(n) for n in names]


def build_stg_piezo_stations(raw: DataFrame) -> DataFrame:
    typed = [*_number("x", "y", "altitude_station"),
             clean_date("date_debut_mesure").alias("date_debut_mesure"),
             clean_date("date_fin_mesure").alias("date_fin_mesure"),
             clean_timestamp("date_maj").alias("date_maj"),
             clean_int("nb_mesures_piezo").alias("nb_mesures_piezo"),
             *_text("code_bss", "code_commune_insee", "nom_commune", "code_departement",
                    "nom_departement", "codes_bdlisa")]
    known = ["x", "y", "altitude_station", "date_debut_mesure", "date_fin_mesure", "date_maj",
             "nb_mesures_piezo", "code_bss", "code_commune_insee", "nom_commune",
             "code_departement", "nom_departement", "codes_bdlisa"]
    rows = select_with_rest(raw, typed, [*known, *LOADER_COLUMNS])
    rows = require_not_null(rows, ["code_bss", "date_debut_mesure", "x", "y"])
    latest = first_per_key(rows, ["code_bss"], [("date_maj", "desc")])
    return latest.withColumn("geometry", make_point("x", "y"))


def piezo_chroniques_rules() -> list[tuple[str, Column]]:
    return [
        ("DATE_MESURE_NULL", clean_text("date_mesure").isNull()),
        ("CODE_BSS_NULL", clean_text("code_bss").isNull()),
        ("AUCUNE_MESURE", clean_numeric("niveau_nappe_eau").isNull()
         & clean_numeric("profondeur_nappe").isNull()),
        ("STATION_INEXISTANTE", ~F.col("_known")),
    ]


def build_stg_piezo_chroniques(raw: DataFrame, stations: DataFrame,
                               target: DataFrame | None = None, days: int = 7,
                               reprocess_from: str | None = None) -> DataFrame:
    """Highest level of the day per station. Incremental when ``target`` is given.

    The station test comes after the reduction to one row per station and day,
    where a very chatty station weighs no more than its number of days.
    """
    incremental = target is not None or reprocess_from is not None
    if incremental:
        bound = lookback_bound(target, "date_mesure", days, reprocess_from)
        raw = since_bound(raw, bound)
    typed = raw.select(clean_date("date_mesure").alias("date_mesure"),
                       *_number("niveau_nappe_eau", "profondeur_nappe"), *_text("code_bss"))
    rows = require_any(require_not_null(typed, ["date_mesure", "code_bss"]),
                       ["niveau_nappe_eau", "profondeur_nappe"])
    if incremental:
        rows = rows.where(F.col("date_mesure") >= F.lit(bound))
    best = first_per_key(rows, ["code_bss", "date_mesure"], [("niveau_nappe_eau", "desc")])
    return keep_known(require_parent(best, stations, "stations"), stations, "code_bss")


def build_piezo_chroniques_rejected(raw: DataFrame, stations: DataFrame,
                                    logged: DataFrame | None = None) -> DataFrame:
    _ok, bad = split_rejects(raw, piezo_chroniques_rules(), stations, "code_bss")
    return bad if logged is None else append_rejects(logged, bad)


SITE_NUMBERS = ["longitude_site", "latitude_site", "altitude_site", "coordonnee_x_site",
                "coordonnee_y_site", "surface_bv"]
SITE_COLUMNS = [
    "longitude_site", "latitude_site", "altitude_site", "code_site", "code_departement",
    "libelle_site", "type_site", "coordonnee_x_site", "coordonnee_y_site", "code_projection",
    "code_systeme_alti_site", "surface_bv", "statut_site", "premier_mois_etiage_site",
    "premier_mois_annee_hydro_site", "influence_generale_site", "code_entite_hydro_site",
    "code_troncon_hydro_site", "code_commune_site", "code_zone_hydro_site", "libelle_commune",
    "code_region", "libelle_region", "code_cours_eau", "libelle_cours_eau", "uri_cours_eau",
    "grandeur_hydro", "date_maj_site", "libelle_departement",
    "commentaire_influence_generale_site", "commentaire_site", "type_contexte_loi_stat_site",
    "type_loi_site"]


def build_stg_hydrometry_sites(raw: DataFrame) -> DataFrame:
    def typed(name: str) -> Column:
        if name == "date_maj_site":
            return clean_timestamp(name).alias(name)
        return (clean_numeric(name) if name in SITE_NUMBERS else clean_text(name)).alias(name)

    rows = require_not_null(raw.select(*[typed(c) for c in SITE_COLUMNS]),
                            ["code_site", "longitude_site", "latitude_site"])
    latest = first_per_key(rows, ["code_site"], [("date_maj_site", "desc")])
    return latest.withColumn("geometry", make_point("longitude_site", "latitude_site"))


def build_stg_hydrometry_stations(raw: DataFrame, sites: DataFrame) -> DataFrame:
    rows = raw.select(
        clean_date("date_ouverture_station").alias("date_ouverture_station"),
        clean_date("date_fermeture_station").alias("date_fermeture_station"),
        clean_timestamp("date_maj_station").alias("date_maj_station"),
        *_number("longitude_station", "latitude_station", "altitude_ref_alti_station"),
        *_text("code_station", "code_site", "code_departement", "libelle_station", "libelle_site",
               "code_cours_eau", "libelle_cours_eau", "uri_cours_eau", "libelle_departement"))
    rows = require_not_null(rows, ["code_station", "longitude_station", "latitude_station"])
    latest = first_per_key(keep_known(
        require_parent(rows, sites, "sites"), sites, "code_site", spread=["code_station", "date_maj_station"]), ["code_station"],
                           [("date_maj_station", "desc")])
    return latest.withColumn("geometry", make_point("longitude_station", "latitude_station"))


def hydrometry_stations_rules() -> list[tuple[str, Column]]:
    return [
        ("CODE_STATION_NULL", clean_text("code_station").isNull()),
        ("CODE_SITE_NOT_IN_SITES", ~F.col("_known")),
        ("COORDS_NULL", clean_text("longitude_station").isNull()
         | clean_text("latitude_station").isNull()),
    ]


def build_hydrometry_stations_rejected(raw: DataFrame, sites: DataFrame,
                                       logged: DataFrame | None = None) -> DataFrame:
    _ok, bad = split_rejects(raw, hydrometry_stations_rules(), sites, "code_site")
    return bad if logged is None else append_rejects(logged, bad)


def build_stg_hydrometry_obs_elab(raw: DataFrame, sites: DataFrame,
                                  target: DataFrame | None = None, days: int = 7,
                                  reprocess_from: str | None = None,
                                  keys: tuple[str, ...] = ("code_site", "date_obs_elab",
                                                           "grandeur_hydro_elab"),
                                  measures_only: bool = False) -> DataFrame:
    """Highest value per site, day and quantity; ``keys`` may name the station instead.

    ``measures_only`` keeps day, value, site, quantity and station. They lead the tie-break,
    so the winning rows have the same ones; the other columns are neither parsed nor moved.
    """
    incremental = target is not None or reprocess_from is not None
    if incremental:
        bound = lookback_bound(target, "date_obs_elab", days, reprocess_from)
        raw = since_bound(raw, bound)
    measures = [clean_date("date_obs_elab").alias("date_obs_elab"), *_number("resultat_obs_elab"),
                *_text("code_site", "grandeur_hydro_elab", "code_station")]
    rest = [clean_timestamp("date_prod").alias("date_prod"),
            *_text("code_statut", "libelle_statut", "code_methode", "libelle_methode",
                   "code_qualification", "libelle_qualification"),
            *_number("longitude", "latitude")]
    rows = raw.select(*measures, *([] if measures_only else rest))
    rows = require_not_null(rows, ["code_site", "date_obs_elab", "grandeur_hydro_elab",
                                   "resultat_obs_elab"])
    if incremental:
        rows = rows.where(F.col("date_obs_elab") >= F.lit(bound))
    best = first_per_key(rows, list(keys), [("resultat_obs_elab", "desc")])
    known = keep_known(require_parent(best, sites, "sites"), sites, "code_site")
    return known if measures_only else enrich(known, sites, "code_site", ["geometry"])


def hydrometry_obs_rules() -> list[tuple[str, Column]]:
    return [
        ("CODE_SITE_NULL", clean_text("code_site").isNull()),
        ("CODE_SITE_NOT_IN_SITES", ~F.col("_known")),
        ("DATE_OBS_ELAB_NULL", clean_text("date_obs_elab").isNull()),
        ("GRANDEUR_HYDRO_NULL", clean_text("grandeur_hydro_elab").isNull()),
        ("RESULTAT_OBS_NULL", clean_numeric("resultat_obs_elab").isNull()),
    ]


def build_hydrometry_obs_rejected(raw: DataFrame, sites: DataFrame,
                                  logged: DataFrame | None = None) -> DataFrame:
    _ok, bad = split_rejects(raw, hydrometry_obs_rules(), sites, "code_site")
    return bad if logged is None else append_rejects(logged, bad)


def _stg_grid(raw: DataFrame, required: str, measures: list[str], target: DataFrame | None,
              reprocess_from: str | None, newer_by: str) -> DataFrame:
    rows = require_not_null(raw, ["time", "latitude", "longitude", required])
    if target is not None or reprocess_from is not None:
        rows = newer_than(rows, target, newer_by, reprocess_from=reprocess_from)
    typed = rows.select(snap("latitude").alias("latitude"), snap("longitude").alias("longitude"),
                        *[F.col(m).cast("double").alias(m) for m in measures],
                        F.col("time").cast("timestamp_ntz").alias("time"),
                        "source_file_id", "created_at")
    latest = first_per_key(typed, ["latitude", "longitude", "time"], [("created_at", "desc")])
    return latest.withColumn("geometry", make_point("longitude", "latitude"))


def build_stg_era5_timeseries(raw: DataFrame, target: DataFrame | None = None,
                              reprocess_from: str | None = None,
                              newer_by: str = "created_at") -> DataFrame:
    """Latest load wins per cell and time. Incremental runs take what was loaded
    since (``newer_by='time'`` restores the by-measure-time rule, which skips
    back-filled data)."""
    return _stg_grid(raw, "temperature_2m",
                     ["temperature_2m", "total_precipitation", "potential_evaporation"],
                     target, reprocess_from, newer_by)


def build_stg_era5_daily_temp_stats(raw: DataFrame, target: DataFrame | None = None,
                                    reprocess_from: str | None = None,
                                    newer_by: str = "created_at") -> DataFrame:
    return _stg_grid(raw, "t2m_mean", ["t2m_mean", "t2m_min", "t2m_max"], target,
                     reprocess_from, newer_by)


# Published code lists of hydrogeological entities.
NIVEAU = {"1": "National", "2": "Régional", "3": "Local"}
ETAT = {"0": "Indéterminé", "1": "Libre seul", "2": "Libre et captif", "3": "Captif seul",
        "4": "Libre recouvert", "5": "Captif recouvert", "6": "Libre et captif recouvert",
        "X": "Non qualifié"}
NATURE = {"0": "Domaine non aquifère", "3": "Système aquifère", "4": "Domaine aquifère",
          "5": "Unité aquifère", "6": "Entité hydrogéologique non définie", "7": "Alluvions"}
MILIEU = {"0": "Indéterminé", "1": "Poreux", "2": "Fissuré", "3": "Karstique",
          "4": "Poreux et fissuré", "5": "Poreux et karstique", "6": "Fissuré et karstique",
          "7": "Poreux, fissuré et karstique", "8": "Double porosité (poreux et fissuré)",
          "9": "Double porosité (poreux et karstique)",
          "10": "Double porosité (fissuré et karstique)", "X": "Non qualifié"}
THEME = {"0": "Indéterminé", "1": "Sédimentaire", "2": "Socle", "3": "Volcanique",
         "4": "Alluvial", "5": "Intensément plissé"}


def build_stg_tme_entites(raw: DataFrame) -> DataFrame:
    rows = raw.where(F.trim("code_eh") != "")
    latest = first_per_key(rows, ["code_eh"], [("tme_id", "desc")])
    ring = ("geometry" if "geometry" in raw.columns
            else F.lit(None).cast("array<struct<lon:double,lat:double>>").alias("geometry"))
    return latest.select(
        "tme_id", "code_eh", F.nullif(F.trim("libelle_eh"), F.lit("")).alias("libelle_eh"),
        "ordre_abs_eh", "niveau_eh", decode("niveau_eh", NIVEAU).alias("libelle_niveau_eh"),
        "inclus_eh", "etat_eh", decode("etat_eh", ETAT).alias("libelle_etat_eh"),
        "nature_eh", decode("nature_eh", NATURE).alias("libelle_nature_eh"),
        "milieu_eh", decode("milieu_eh", MILIEU).alias("libelle_milieu_eh"),
        "theme_eh", decode("theme_eh", THEME).alias("libelle_theme_eh"),
        "origine_eh", F.lit(None).cast("string").alias("libelle_origine_eh"), ring)

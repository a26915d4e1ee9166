"""Derived tables in DuckDB SQL, the independent side of the comparison."""

from __future__ import annotations

import math

from checks.adapters import AS_OF, DUCKDB
from rivulet.plans import staging

NORMALS = ("1996-01-01", "2001-01-01", 4)      # start, end, minimum years
REFERENCE = (1995, 1999, 4, 4)                  # period, minimum years, minimum per month


# The published coefficients of AS 241, ascending powers, numerators and
# denominators for the centre, the flanks and the far tails.
PPND_A = [3.3871328727963665, 133.14166789178438, 1971.5909503065513, 13731.69376550946,
          45921.95393154987, 67265.7709270087, 33430.57558358813, 2509.0809287301227]
PPND_B = [1.0, 42.31333070160091, 687.1870074920579, 5394.196021424751, 21213.794301586597,
          39307.89580009271, 28729.085735721943, 5226.495278852854]
PPND_C = [1.4234371107496835, 4.630337846156546, 5.769497221460691, 3.6478483247632045,
          1.2704582524523684, 0.2417807251774506, 0.022723844989269184, 0.0007745450142783414]
PPND_D = [1.0, 2.053191626637759, 1.6763848301838038, 0.6897673349851, 0.14810397642748008,
          0.015198666563616457, 0.0005475938084995345, 1.0507500716444169e-09]
PPND_E = [6.657904643501103, 5.463784911164114, 1.7848265399172913, 0.29656057182850487,
          0.026532189526576124, 0.0012426609473880784, 2.7115555687434876e-05,
          2.0103343992922881e-07]
PPND_F = [1.0, 0.599832206555888, 0.1369298809227358, 0.014875361290850615, 0.0007868691311456133,
          1.8463183175100548e-05, 1.421511758316446e-07, 2.0442631033899397e-15]
# The published coefficients of Hart's normal tail and where it ends.
HART_NUM = [220.206867912376, 221.213596169931, 112.079291497871, 33.912866078383,
            6.37396220353165, 0.700383064443688, 0.0352624965998911]
HART_DEN = [440.413735824752, 793.826512519948, 637.333633378831, 296.564248779674,
            86.7807322029461, 16.064177579207, 1.75566716318264, 0.0883883476483184]
HART_SPLIT = 7.07106781186547


def ct(c: str) -> str:
    return f"NULLIF(NULLIF(TRIM({c}), ''), 'NULL')"


def num(c: str) -> str:
    return f"CAST({ct(c)} AS DOUBLE)"


def day(c: str) -> str:
    return f"CAST({ct(c)} AS DATE)"


def top1(source: str, keys: str, order: str, columns: str = "*") -> str:
    return (f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY {order}) AS rn FROM ({source}) src) ranked WHERE rn = 1")


def poly(x: str, ascending: list[float]) -> str:
    text = repr(float(ascending[-1]))
    for c in reversed(ascending[:-1]):
        text = f"({text}*{x}+({c!r}))"
    return text


def norm_ppf_sql(p: str) -> str:
    """AS 241 as text; ``p`` is used many times, so pass a column name."""
    q, r = f"({p}-0.5)", f"(0.180625-({p}-0.5)*({p}-0.5))"
    t = f"sqrt(-ln(least({p},1-{p})))"
    near, far = f"({t}-1.6)", f"({t}-5.0)"
    return (f"CASE WHEN {p}<=0 OR {p}>=1 THEN NULL WHEN abs({q})<=0.425 "
            f"THEN {q}*{poly(r, PPND_A)}/{poly(r, PPND_B)} ELSE sign({q})*("
            f"CASE WHEN {t}<=5 THEN {poly(near, PPND_C)}/{poly(near, PPND_D)} "
            f"ELSE {poly(far, PPND_E)}/{poly(far, PPND_F)} END) END")


def norm_cdf_sql(x: str) -> str:
    a = f"abs({x})"
    tail = f"({a}+0.65)"
    for n in (4, 3, 2, 1):
        tail = f"({a}+{n}.0/{tail})"
    inner = f"exp(-{a}*{a}/2)*{poly(a, HART_NUM)}/{poly(a, HART_DEN)}"
    upper = (f"(CASE WHEN {a}>37 THEN 0.0 WHEN {a}<{HART_SPLIT} THEN {inner} "
             f"ELSE exp(-{a}*{a}/2)/{tail}/{math.sqrt(2 * math.pi)!r} END)")
    return f"CASE WHEN {x}>0 THEN 1-{upper} ELSE {upper} END"


def gamma_cdf_sql(u: str, a: str) -> str:
    """Sum of the series' terms through lgamma, well past its largest term."""
    return (f"CASE WHEN {u} IS NULL OR {a} IS NULL OR {a}<=0 THEN NULL WHEN {u}<=0 THEN 0.0 "
            f"WHEN {u}>{a}+40*sqrt({a})+50 THEN 1.0 ELSE least(1.0, list_sum(list_transform("
            f"range(0, CAST(ceil(greatest({u}-{a},0)+12*sqrt({u})+80) AS BIGINT)), lambda n: exp(({a}+n)*ln({u})-{u}-lgamma({a}+n+1))))) END")


def clip(p: str) -> str:
    return f"CASE WHEN {p} IS NOT NULL THEN least(greatest({p},0.001),0.999) END"


def haversine_sql(lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    return (f"2*6371008.8*asin(sqrt(least(1.0,"
            f"pow(sin((radians({lat2})-radians({lat1}))/2),2)+cos(radians({lat1}))"
            f"*cos(radians({lat2}))*pow(sin((radians({lon2})-radians({lon1}))/2),2))))")


def decode_sql(c: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {c} {whens} END"


SNAP_LAT = "CAST(ROUND(latitude, 1) AS DECIMAL(6,1))"
SNAP_LON = "CAST(ROUND(longitude, 1) AS DECIMAL(6,1))"
BBOX = "{y} BETWEEN 41.0 AND 52.0 AND {x} BETWEEN -5.5 AND 10.0"

D = DUCKDB.copy()

# ---- silver ------------------------------------------------------------------
D["stg_stations"] = top1(f"""
SELECT {num('x')} AS x, {num('y')} AS y, {num('altitude_station')} AS altitude_station,
       {day('date_debut_mesure')} AS date_debut_mesure, {day('date_fin_mesure')} AS date_fin_mesure,
       CAST({ct('date_maj')} AS TIMESTAMP) AS date_maj,
       CAST(ROUND(CAST({ct('nb_mesures_piezo')} AS DECIMAL(18,4))) AS INTEGER) AS nb_mesures_piezo,
       {ct('code_bss')} AS code_bss, {ct('code_commune_insee')} AS code_commune_insee,
       {ct('nom_commune')} AS nom_commune, {ct('code_departement')} AS code_departement,
       {ct('nom_departement')} AS nom_departement, {ct('codes_bdlisa')} AS codes_bdlisa,
       bss_id, libelle_pe
FROM raw_stations
WHERE {ct('code_bss')} IS NOT NULL AND {ct('date_debut_mesure')} IS NOT NULL
  AND {num('x')} IS NOT NULL AND {num('y')} IS NOT NULL""",
    "code_bss", "date_maj DESC NULLS LAST", "* EXCLUDE rn")
D["clean_levels"] = f"""
SELECT {day('date_mesure')} AS date_mesure, {num('niveau_nappe_eau')} AS niveau_nappe_eau,
       {num('profondeur_nappe')} AS profondeur_nappe, {ct('code_bss')} AS code_bss
FROM raw_levels WHERE {day('date_mesure')} IS NOT NULL AND {ct('code_bss')} IS NOT NULL
  AND ({num('niveau_nappe_eau')} IS NOT NULL OR {num('profondeur_nappe')} IS NOT NULL)"""
D["best_levels"] = top1("SELECT * FROM clean_levels", "code_bss, date_mesure",
                        "niveau_nappe_eau DESC NULLS LAST, profondeur_nappe NULLS LAST",
                        "* EXCLUDE rn")
D["stg_levels"] = ("SELECT * FROM best_levels WHERE code_bss IN "
                   "(SELECT code_bss FROM stg_stations)")
D["stg_sites"] = top1(f"""
SELECT {num('longitude_site')} AS longitude_site, {num('latitude_site')} AS latitude_site,
       {ct('code_site')} AS code_site, {ct('code_departement')} AS code_departement,
       {ct('libelle_departement')} AS libelle_departement, {ct('libelle_site')} AS libelle_site,
       {ct('type_site')} AS type_site, {num('surface_bv')} AS surface_bv,
       {ct('code_commune_site')} AS code_commune_site, {ct('libelle_commune')} AS libelle_commune,
       {ct('code_region')} AS code_region, {ct('libelle_region')} AS libelle_region,
       {ct('code_zone_hydro_site')} AS code_zone_hydro_site,
       CAST({ct('date_maj_site')} AS TIMESTAMP) AS date_maj_site
FROM raw_sites WHERE {num('longitude_site')} IS NOT NULL AND {num('latitude_site')} IS NOT NULL""",
    "code_site", "date_maj_site DESC NULLS LAST", "* EXCLUDE rn")
D["stg_hydro_stations"] = top1(f"""
SELECT {day('date_ouverture_station')} AS date_ouverture_station,
       {day('date_fermeture_station')} AS date_fermeture_station,
       CAST({ct('date_maj_station')} AS TIMESTAMP) AS date_maj_station,
       {num('longitude_station')} AS longitude_station,
       {num('latitude_station')} AS latitude_station,
       {num('altitude_ref_alti_station')} AS altitude_ref_alti_station,
       {ct('code_station')} AS code_station, {ct('code_site')} AS code_site,
       {ct('code_departement')} AS code_departement, {ct('libelle_station')} AS libelle_station,
       {ct('libelle_site')} AS libelle_site, {ct('code_cours_eau')} AS code_cours_eau,
       {ct('libelle_cours_eau')} AS libelle_cours_eau, {ct('uri_cours_eau')} AS uri_cours_eau,
       {ct('libelle_departement')} AS libelle_departement
FROM raw_hydro_stations WHERE {ct('code_station')} IS NOT NULL
  AND {num('longitude_station')} IS NOT NULL AND {num('latitude_station')} IS NOT NULL
  AND {ct('code_site')} IN (SELECT code_site FROM stg_sites)""",
    "code_station", "date_maj_station DESC NULLS LAST", "* EXCLUDE rn")
D["stg_flows"] = top1(f"""
SELECT {day('date_obs_elab')} AS date_obs_elab, {num('resultat_obs_elab')} AS resultat_obs_elab,
       {ct('code_site')} AS code_site, {ct('grandeur_hydro_elab')} AS grandeur_hydro_elab,
       {ct('code_station')} AS code_station, CAST({ct('date_prod')} AS TIMESTAMP) AS date_prod,
       {ct('code_statut')} AS code_statut, {ct('libelle_statut')} AS libelle_statut,
       {ct('code_methode')} AS code_methode, {ct('libelle_methode')} AS libelle_methode,
       {ct('code_qualification')} AS code_qualification,
       {ct('libelle_qualification')} AS libelle_qualification,
       {num('longitude')} AS longitude, {num('latitude')} AS latitude
FROM raw_flows WHERE {day('date_obs_elab')} IS NOT NULL AND {num('resultat_obs_elab')} IS NOT NULL
  AND {ct('code_site')} IN (SELECT code_site FROM stg_sites)""",
    "code_site, date_obs_elab, grandeur_hydro_elab",
    "resultat_obs_elab DESC, code_station, date_prod, code_statut, libelle_statut, code_methode, "
    "libelle_methode, code_qualification, libelle_qualification, longitude, latitude",
    "* EXCLUDE rn")
D["stg_rain"] = top1(f"""
SELECT {SNAP_LAT} AS latitude, {SNAP_LON} AS longitude, temperature_2m, total_precipitation,
       potential_evaporation, time, source_file_id, created_at FROM raw_rain""",
    "latitude, longitude, time", "created_at DESC NULLS LAST", "* EXCLUDE rn")
D["stg_temps"] = top1(f"""
SELECT {SNAP_LAT} AS latitude, {SNAP_LON} AS longitude, t2m_mean, t2m_min, t2m_max, time,
       source_file_id, created_at FROM raw_temps WHERE t2m_mean IS NOT NULL""",
    "latitude, longitude, time", "created_at DESC NULLS LAST", "* EXCLUDE rn")
D["stg_tme"] = top1(f"""
SELECT tme_id, code_eh, NULLIF(TRIM(libelle_eh), '') AS libelle_eh, ordre_abs_eh, niveau_eh,
       {decode_sql('niveau_eh', staging.NIVEAU)} AS libelle_niveau_eh, inclus_eh, etat_eh,
       {decode_sql('etat_eh', staging.ETAT)} AS libelle_etat_eh, nature_eh,
       {decode_sql('nature_eh', staging.NATURE)} AS libelle_nature_eh, milieu_eh,
       {decode_sql('milieu_eh', staging.MILIEU)} AS libelle_milieu_eh, theme_eh,
       {decode_sql('theme_eh', staging.THEME)} AS libelle_theme_eh, origine_eh,
       CAST(NULL AS STRING) AS libelle_origine_eh
FROM raw_entites WHERE TRIM(code_eh) <> ''""",
    "code_eh", "tme_id DESC", "* EXCLUDE rn")

# ---- intermediate --------------------------------------------------------------
D["daily_levels"] = """
SELECT code_bss, date_mesure, AVG(niveau_nappe_eau) AS niveau_nappe_eau,
       AVG(profondeur_nappe) AS profondeur_nappe FROM stg_levels GROUP BY 1, 2"""
D["daily_flows"] = """
SELECT code_site, code_station, date_obs_elab, grandeur_hydro_elab,
       AVG(resultat_obs_elab) AS resultat_obs_elab, CAST(COUNT(*) AS INTEGER) AS nb_obs
FROM stg_flows WHERE code_station IN (SELECT code_station FROM stg_hydro_stations)
GROUP BY 1, 2, 3, 4"""
D["grid_points"] = ("SELECT DISTINCT latitude AS era5_latitude, longitude AS era5_longitude "
                    "FROM stg_rain")


def nearest_sql(stations: str, key: str, y: str, x: str) -> str:
    return top1(f"""
SELECT s.*, g.era5_latitude, g.era5_longitude,
       round((CAST(g.era5_longitude AS DOUBLE) - s.{x}) * (CAST(g.era5_longitude AS DOUBLE) - s.{x})
           + (CAST(g.era5_latitude AS DOUBLE) - s.{y}) * (CAST(g.era5_latitude AS DOUBLE) - s.{y}), 9)
         AS d2
FROM {stations} s CROSS JOIN grid_points g WHERE {BBOX.format(y='s.' + y, x='s.' + x)}""",
        key, "d2, era5_latitude, era5_longitude", "* EXCLUDE (rn, d2)")


D["located_stations"] = nearest_sql("stg_stations", "code_bss", "y", "x")
D["listed_codes"] = """
SELECT code_bss, pos, TRIM(tok) AS code FROM (
  SELECT code_bss, UNNEST(range(0, len(string_split(codes_bdlisa, ',')))) AS pos,
         UNNEST(string_split(codes_bdlisa, ',')) AS tok FROM located_stations) t
WHERE TRIM(tok) <> ''"""
D["entity_hits"] = top1("""
SELECT l.code_bss, l.pos, t.* FROM listed_codes l JOIN stg_tme t ON TRIM(t.code_eh) = l.code""",
    "code_bss", "pos, code_eh", "* EXCLUDE rn")
D["box_hits"] = top1("""
SELECT s.code_bss, b.code_eh, b.libelle_eh, (b.x1 - b.x0) * (b.y1 - b.y0) AS area
FROM located_stations s JOIN boxes b ON s.x BETWEEN b.x0 AND b.x1 AND s.y BETWEEN b.y0 AND b.y1
WHERE s.code_bss NOT IN (SELECT code_bss FROM entity_hits)""",
    "code_bss", "area, code_eh", "* EXCLUDE rn")
_ATTRS = ["libelle_eh", "niveau_eh", "libelle_niveau_eh", "etat_eh", "libelle_etat_eh",
          "nature_eh", "libelle_nature_eh", "milieu_eh", "libelle_milieu_eh", "theme_eh",
          "libelle_theme_eh", "origine_eh", "libelle_origine_eh"]
D["mapping"] = f"""
SELECT s.code_bss, s.era5_latitude, s.era5_longitude, s.y AS station_latitude,
       s.x AS station_longitude,
       {haversine_sql('s.x', 's.y', 's.era5_longitude', 's.era5_latitude')} AS era5_distance_m,
       s.codes_bdlisa, s.code_commune_insee, s.nom_commune, s.altitude_station,
       s.code_departement, s.nom_departement,
       COALESCE(h.code_eh, b.code_eh, NULLIF(TRIM(split_part(COALESCE(s.codes_bdlisa, ''), ',', 1)), ''))
         AS code_eh,
       COALESCE(h.libelle_eh, b.libelle_eh) AS libelle_eh, {', '.join('h.' + a for a in _ATTRS[1:])}
FROM located_stations s LEFT JOIN entity_hits h USING (code_bss)
LEFT JOIN box_hits b USING (code_bss)"""
D["located_hydro"] = nearest_sql("stg_hydro_stations", "code_station", "latitude_station",
                                 "longitude_station")
D["hydro_mapping"] = f"""
SELECT s.code_station, s.code_site, s.latitude_station AS station_latitude,
       s.longitude_station AS station_longitude, s.era5_latitude, s.era5_longitude,
       {haversine_sql('s.longitude_station', 's.latitude_station', 's.era5_longitude', 's.era5_latitude')}
         AS era5_distance_m,
       s.code_departement, s.libelle_departement AS nom_departement, s.libelle_station,
       s.libelle_site, s.code_cours_eau, s.libelle_cours_eau, s.uri_cours_eau, t.surface_bv,
       t.code_commune_site, t.libelle_commune, t.code_region, t.libelle_region,
       t.code_zone_hydro_site, t.type_site
FROM located_hydro s LEFT JOIN stg_sites t ON s.code_site = t.code_site"""
D["used_cells"] = """
SELECT era5_latitude AS latitude, era5_longitude AS longitude FROM mapping
UNION SELECT era5_latitude, era5_longitude FROM hydro_mapping"""
D["weather"] = """
SELECT r.latitude, r.longitude, CAST(r.time AS DATE) AS era5_date, t.t2m_mean AS temperature_2m,
       r.total_precipitation, r.potential_evaporation
FROM stg_rain r JOIN used_cells c ON r.latitude = c.latitude AND r.longitude = c.longitude
LEFT JOIN stg_temps t ON r.latitude = t.latitude AND r.longitude = t.longitude
 AND CAST(r.time AS DATE) = CAST(t.time AS DATE)"""

# ---- facts ---------------------------------------------------------------------
D["fact_levels"] = """
SELECT m.code_bss, m.date_mesure AS date, m.niveau_nappe_eau, m.profondeur_nappe, e.temperature_2m,
       e.total_precipitation, e.potential_evaporation, p.codes_bdlisa, p.code_commune_insee,
       p.nom_commune, p.altitude_station, p.code_departement, p.nom_departement, p.code_eh,
       p.libelle_eh, p.niveau_eh, p.etat_eh, p.nature_eh, p.milieu_eh, p.theme_eh, p.origine_eh,
       p.station_latitude, p.station_longitude, p.era5_latitude, p.era5_longitude
FROM daily_levels m LEFT JOIN mapping p USING (code_bss)
LEFT JOIN weather e ON p.era5_latitude = e.latitude AND p.era5_longitude = e.longitude
 AND m.date_mesure = e.era5_date"""
D["fact_flows"] = """
SELECT m.code_site, m.code_station, m.date_obs_elab AS date, m.grandeur_hydro_elab,
       m.resultat_obs_elab, m.nb_obs, e.temperature_2m, e.total_precipitation,
       e.potential_evaporation, p.code_departement, p.nom_departement, p.code_region,
       p.libelle_region, p.code_commune_site, p.libelle_commune, p.libelle_station, p.libelle_site,
       p.type_site, p.surface_bv, p.code_zone_hydro_site, p.code_cours_eau, p.libelle_cours_eau,
       p.uri_cours_eau, p.station_latitude, p.station_longitude, p.era5_latitude,
       p.era5_longitude, p.era5_distance_m
FROM daily_flows m LEFT JOIN hydro_mapping p ON m.code_station = p.code_station
LEFT JOIN weather e ON p.era5_latitude = e.latitude AND p.era5_longitude = e.longitude
 AND m.date_obs_elab = e.era5_date"""
_WEATHER_AGG = """AVG(temperature_2m) AS temperature_moyenne, MIN(temperature_2m) AS temperature_min,
       MAX(temperature_2m) AS temperature_max, SUM(total_precipitation) AS precipitation_totale,
       AVG(potential_evaporation) AS evaporation_moyenne,
       COUNT(*) AS nb_jours_mesures, MIN(era5_latitude) AS era5_latitude,
       MIN(era5_longitude) AS era5_longitude"""


def rolling(keys: str, mean: str, p: str) -> str:
    w = f"PARTITION BY {keys} ORDER BY mois"
    return f"""
       AVG({mean}) OVER ({w} ROWS 2 PRECEDING) AS {p}_moy_mobile_3m,
       AVG({mean}) OVER ({w} ROWS 11 PRECEDING) AS {p}_moy_mobile_12m,
       AVG(precipitation_totale) OVER ({w} ROWS 11 PRECEDING) AS precipitation_moy_mobile_12m,
       {mean} - LAG({mean}) OVER ({w}) AS variation_{p}_vs_mois_prec,
       {mean} - LAG({mean}, 12) OVER ({w}) AS variation_{p}_vs_annee_prec"""


D["month_levels"] = f"""
SELECT code_bss, CAST(date_trunc('month', date) AS DATE) AS mois,
       MIN(code_departement) AS code_departement, MIN(nom_departement) AS nom_departement,
       MIN(code_eh) AS code_eh, MIN(libelle_eh) AS libelle_eh,
       AVG(niveau_nappe_eau) AS niveau_moyen, MIN(niveau_nappe_eau) AS niveau_min,
       MAX(niveau_nappe_eau) AS niveau_max,
       MAX(niveau_nappe_eau) - MIN(niveau_nappe_eau) AS amplitude_mensuelle,
       stddev_samp(niveau_nappe_eau) AS niveau_stddev, AVG(profondeur_nappe) AS profondeur_moyenne,
       MIN(profondeur_nappe) AS profondeur_min, MAX(profondeur_nappe) AS profondeur_max,
       {_WEATHER_AGG} FROM fact_levels GROUP BY 1, 2"""
D["monthly_levels"] = (f"SELECT *, {rolling('code_bss', 'niveau_moyen', 'niveau')} "
                       "FROM month_levels")
D["month_flows"] = f"""
SELECT code_station, code_site, grandeur_hydro_elab, CAST(date_trunc('month', date) AS DATE) AS mois,
       MIN(code_departement) AS code_departement, MIN(nom_departement) AS nom_departement,
       MIN(code_region) AS code_region, MIN(libelle_region) AS libelle_region,
       MIN(libelle_station) AS libelle_station, MIN(libelle_site) AS libelle_site,
       MIN(type_site) AS type_site, MIN(code_cours_eau) AS code_cours_eau,
       MIN(libelle_cours_eau) AS libelle_cours_eau,
       AVG(resultat_obs_elab) AS resultat_moyen, MIN(resultat_obs_elab) AS resultat_min,
       MAX(resultat_obs_elab) AS resultat_max,
       MAX(resultat_obs_elab) - MIN(resultat_obs_elab) AS amplitude_mensuelle,
       stddev_samp(resultat_obs_elab) AS resultat_stddev,
       {_WEATHER_AGG} FROM fact_flows GROUP BY 1, 2, 3, 4"""
D["monthly_flows"] = (
    f"SELECT *, {rolling('code_station, grandeur_hydro_elab', 'resultat_moyen', 'resultat')} "
    "FROM month_flows")
_YEAR_WEATHER = """AVG(temperature_moyenne) AS temperature_moyenne_annuelle,
       MIN(temperature_min) AS temperature_min_annuelle,
       MAX(temperature_max) AS temperature_max_annuelle,
       SUM(precipitation_totale) AS precipitation_totale_annuelle,
       AVG(evaporation_moyenne) AS evaporation_moyenne_annuelle"""
_YEAR_COUNTS = """CAST(SUM(nb_jours_mesures) AS BIGINT) AS nb_jours_mesures_annuel,
       COUNT(*) AS nb_mois_mesures, MIN(era5_latitude) AS era5_latitude,
       MIN(era5_longitude) AS era5_longitude"""


def quintile_sql(p: str) -> str:
    return (f"CASE WHEN {p} < 0.2 THEN 'TRES_BAS' WHEN {p} < 0.4 THEN 'BAS' "
            f"WHEN {p} < 0.6 THEN 'NORMAL' WHEN {p} < 0.8 THEN 'HAUT' ELSE 'TRES_HAUT' END")


D["year_levels"] = f"""
SELECT code_bss, CAST(year(mois) AS INTEGER) AS annee, MIN(code_departement) AS code_departement,
       MIN(nom_departement) AS nom_departement, MIN(code_eh) AS code_eh,
       MIN(libelle_eh) AS libelle_eh, AVG(niveau_moyen) AS niveau_moyen_annuel,
       MIN(niveau_min) AS niveau_min_annuel, MAX(niveau_max) AS niveau_max_annuel,
       MAX(niveau_max) - MIN(niveau_min) AS amplitude_annuelle,
       stddev_samp(niveau_moyen) AS niveau_stddev_annuel,
       AVG(profondeur_moyenne) AS profondeur_moyenne_annuelle, {_YEAR_WEATHER},
       SUM(precipitation_totale) - SUM(evaporation_moyenne * day(last_day(mois)))
         AS bilan_hydrique_annuel, {_YEAR_COUNTS}
FROM monthly_levels GROUP BY 1, 2"""
D["yearly_levels"] = f"""
SELECT * EXCLUDE (prev_level, prev_rain), niveau_moyen_annuel - prev_level AS variation_niveau_vs_annee_prec,
       precipitation_totale_annuelle - prev_rain AS variation_precipitation_vs_annee_prec,
       CASE WHEN prev_level IS NOT NULL AND prev_level <> 0
            THEN (niveau_moyen_annuel - prev_level) / abs(prev_level) * 100 END AS variation_niveau_pct,
       {quintile_sql('percentile_niveau_historique')} AS classification_niveau_annuel
FROM (SELECT *, LAG(niveau_moyen_annuel) OVER (PARTITION BY code_bss ORDER BY annee) AS prev_level,
             LAG(precipitation_totale_annuelle) OVER (PARTITION BY code_bss ORDER BY annee) AS prev_rain,
             AVG(niveau_moyen_annuel) OVER (PARTITION BY code_bss ORDER BY annee ROWS 4 PRECEDING)
               AS niveau_moy_mobile_5ans,
             percent_rank() OVER (PARTITION BY code_bss ORDER BY niveau_moyen_annuel NULLS LAST)
               AS percentile_niveau_historique,
             percent_rank() OVER (PARTITION BY code_bss ORDER BY precipitation_totale_annuelle NULLS LAST)
               AS percentile_precipitation_historique
      FROM year_levels) y"""
D["year_flows"] = f"""
SELECT code_station, code_site, grandeur_hydro_elab, CAST(year(mois) AS INTEGER) AS annee,
       MIN(code_departement) AS code_departement, MIN(nom_departement) AS nom_departement,
       MIN(code_region) AS code_region, MIN(libelle_region) AS libelle_region,
       MIN(libelle_station) AS libelle_station, MIN(libelle_site) AS libelle_site,
       AVG(resultat_moyen) AS resultat_moyen_annuel, MIN(resultat_min) AS resultat_min_annuel,
       MAX(resultat_max) AS resultat_max_annuel,
       MAX(resultat_max) - MIN(resultat_min) AS amplitude_annuelle,
       stddev_samp(resultat_moyen) AS resultat_stddev_annuel, {_YEAR_WEATHER}, {_YEAR_COUNTS}
FROM monthly_flows GROUP BY 1, 2, 3, 4"""
_HK = "PARTITION BY code_station, grandeur_hydro_elab ORDER BY"
D["yearly_flows"] = f"""
SELECT * EXCLUDE (prev_value, prev_rain),
       resultat_moyen_annuel - prev_value AS variation_resultat_vs_annee_prec,
       precipitation_totale_annuelle - prev_rain AS variation_precipitation_vs_annee_prec,
       {quintile_sql('percentile_resultat_historique')} AS classification_resultat_annuel
FROM (SELECT *, LAG(resultat_moyen_annuel) OVER ({_HK} annee) AS prev_value,
             LAG(precipitation_totale_annuelle) OVER ({_HK} annee) AS prev_rain,
             percent_rank() OVER ({_HK} resultat_moyen_annuel NULLS LAST)
               AS percentile_resultat_historique FROM year_flows) y"""

# ---- climate -------------------------------------------------------------------
_DOY = "EXTRACT(DOY FROM day)"
_DECL = f"(0.409*sin({_DOY}*2*pi()/365-1.39))"
_PHI = "radians(CAST(latitude AS DOUBLE))"
_SUNSET = f"acos(greatest(least(-tan({_PHI})*tan({_DECL}),1.0),-1.0))"
RA_SQL = (f"0.408*(24*60/pi())*0.0820*(1+0.033*cos({_DOY}*2*pi()/365))*({_SUNSET}*sin({_PHI})"
          f"*sin({_DECL})+cos({_PHI})*cos({_DECL})*sin({_SUNSET}))")
D["et0_days"] = f"""
SELECT latitude, longitude, day, t2m_mean, t2m_min, t2m_max,
       greatest(0.0023*{RA_SQL}*(t2m_mean+17.8)*sqrt(greatest(t2m_max-t2m_min,0)),0) AS et0
FROM (SELECT *, CAST(time AS DATE) AS day FROM stg_temps) t"""
D["monthly_grid"] = """
SELECT *, precipitation_totale - etp_totale AS bilan_hydrique,
       nb_jours = day(last_day(mois)) AS mois_complet,
       nb_jours_temp = day(last_day(mois)) AS temp_complet
FROM (SELECT r.latitude AS era5_latitude, r.longitude AS era5_longitude,
             CAST(date_trunc('month', r.time) AS DATE) AS mois,
             AVG(t.t2m_mean) AS temperature_moyenne, MIN(t.t2m_min) AS temperature_min,
             MAX(t.t2m_max) AS temperature_max, SUM(r.total_precipitation) AS precipitation_totale,
             SUM(t.et0) AS etp_totale, SUM(-r.potential_evaporation) AS etp_pev_era5,
             COUNT(*) AS nb_jours, COUNT(t.t2m_mean) AS nb_jours_temp
      FROM stg_rain r LEFT JOIN et0_days t ON r.latitude = t.latitude
       AND r.longitude = t.longitude AND CAST(r.time AS DATE) = t.day GROUP BY 1, 2, 3) g"""


def windowed(measure_sql: str, start: str, end: str, warmup: str) -> str:
    """UNION ALL over the four windows of a query template with {w} and {p}."""
    parts = [measure_sql.format(
        w=w, win=f"(PARTITION BY era5_latitude, era5_longitude ORDER BY mois ROWS {w - 1} PRECEDING)")
        for w in (1, 3, 6, 12)]
    return "\nUNION ALL\n".join(parts)


_START, _END, _MIN = NORMALS
D["normal_base"] = (f"SELECT * FROM monthly_grid WHERE mois_complet AND mois >= DATE '{_START}' - "
                    f"INTERVAL 12 MONTH AND mois < DATE '{_END}'")
D["normal_windows"] = windowed("""
SELECT era5_latitude, era5_longitude, month(mois) AS mois_calendaire, {w} AS fenetre, p AS rain,
       CASE WHEN nt = {w} THEN t END AS temp, b AS balance
FROM (SELECT *, SUM(precipitation_totale) OVER {win} AS p, SUM(bilan_hydrique) OVER {win} AS b,
             AVG(CASE WHEN temp_complet THEN temperature_moyenne END) OVER {win} AS t,
             COUNT(*) OVER {win} AS n, COUNT(CASE WHEN temp_complet THEN 1 END) OVER {win} AS nt
      FROM normal_base) x WHERE n = {w} AND mois >= DATE '""" + _START + "'", "", "", "")
D["normals"] = """
SELECT era5_latitude, era5_longitude, mois_calendaire, fenetre, nb_annees, precip_moyenne,
       precip_stddev, prob_zero,
       CASE WHEN var_pos > 0 THEN mean_pos * mean_pos / var_pos END AS gamma_alpha,
       CASE WHEN mean_pos > 0 AND var_pos > 0 THEN var_pos / mean_pos END AS gamma_beta,
       nb_annees_temp, temp_moyenne, temp_stddev
FROM (SELECT era5_latitude, era5_longitude, mois_calendaire, fenetre, COUNT(*) AS nb_annees,
             AVG(rain) AS precip_moyenne, stddev_samp(rain) AS precip_stddev,
             AVG(CASE WHEN rain <= 0 THEN 1.0 ELSE 0.0 END) AS prob_zero,
             AVG(rain) FILTER (WHERE rain > 0) AS mean_pos,
             var_samp(rain) FILTER (WHERE rain > 0) AS var_pos,
             COUNT(temp) AS nb_annees_temp, AVG(temp) AS temp_moyenne,
             stddev_samp(temp) AS temp_stddev
      FROM normal_windows GROUP BY 1, 2, 3, 4) s"""


def glo_sql(samples: str, keys: str, x: str, min_years: int) -> str:
    """L-moment fit in the gamma-function form (the Spark side uses the sine form)."""
    return f"""
SELECT {keys}, n, CASE WHEN reason IS NULL THEN a END AS glo_alpha,
       CASE WHEN reason IS NULL THEN k END AS glo_k,
       CASE WHEN reason IS NULL THEN CASE WHEN abs(k) < 1e-6 THEN l1
         ELSE l1 - a * (1/k - pi()/sin(k*pi())) END END AS glo_xi, reason
FROM (SELECT *, CASE WHEN n < {min_years} THEN 'n_annees_insuffisant' WHEN n < 4 THEN 'n_insuffisant'
             WHEN l2 <= 0 THEN 'l2_degenere' WHEN abs(k) >= 1 THEN 'k_hors_domaine'
             WHEN a <= 0 THEN 'alpha_invalide' END AS reason
      FROM (SELECT *, CASE WHEN abs(k) < 1e-6 THEN l2
                   WHEN abs(k) < 1 THEN l2 / (gamma(1+k) * gamma(1-k)) END AS a
            FROM (SELECT *, CASE WHEN l2 > 0 THEN -l3 / l2 END AS k
                  FROM (SELECT {keys}, COUNT({x}) AS n, AVG({x}) AS l1,
                               AVG({x}) - 2*SUM((1-(i-0.35)/m)*{x})/COUNT({x}) AS l2,
                               AVG({x}) - 6*SUM((1-(i-0.35)/m)*{x})/COUNT({x})
                                 + 6*SUM((1-(i-0.35)/m)*(1-(i-0.35)/m)*{x})/COUNT({x}) AS l3
                        FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {x}) AS i,
                                     COUNT(*) OVER (PARTITION BY {keys}) AS m
                              FROM {samples} WHERE {x} IS NOT NULL) r GROUP BY {keys}) m) k1) k2) k3"""


_CELLKEY = "era5_latitude, era5_longitude, mois_calendaire, fenetre"
D["spei_fits"] = glo_sql("normal_windows", _CELLKEY, "balance", _MIN)
D["spei_params"] = "SELECT * FROM spei_fits WHERE reason IS NULL"
INDEX_START, INDEX_END = "1996-01-01", "2001-11-01"
D["index_windows"] = "\nUNION ALL\n".join(f"""
SELECT era5_latitude, era5_longitude, mois, {w} AS fenetre, p, b, t FROM (
  SELECT *, SUM(precipitation_totale) OVER win AS p, SUM(bilan_hydrique) OVER win AS b,
         AVG(temperature_moyenne) OVER win AS t, COUNT(*) OVER win AS n
  FROM monthly_grid WHERE mois_complet AND mois >= DATE '{INDEX_START}' - INTERVAL {w - 1} MONTH
   AND mois < DATE '{INDEX_END}'
  WINDOW win AS (PARTITION BY era5_latitude, era5_longitude ORDER BY mois ROWS {w - 1} PRECEDING)) x
WHERE n = {w} AND mois >= DATE '{INDEX_START}'""" for w in (1, 3, 6, 12))
D["index_inputs"] = f"""
SELECT r.*, c.gamma_alpha, c.gamma_beta, c.prob_zero, c.temp_moyenne, c.temp_stddev,
       s.glo_alpha, s.glo_k, s.glo_xi, c.nb_annees >= {_MIN} AS enough
FROM index_windows r JOIN normals c ON r.era5_latitude = c.era5_latitude
 AND r.era5_longitude = c.era5_longitude AND c.mois_calendaire = month(r.mois)
 AND c.fenetre = r.fenetre
LEFT JOIN spei_params s ON r.era5_latitude = s.era5_latitude
 AND r.era5_longitude = s.era5_longitude AND s.mois_calendaire = month(r.mois)
 AND s.fenetre = r.fenetre"""
_U = "(greatest(p,0)/gamma_beta)"
D["index_probs"] = f"""
SELECT era5_latitude, era5_longitude, mois AS month, fenetre,
       CASE WHEN enough AND gamma_alpha > 0 AND gamma_beta > 0 THEN
         coalesce(prob_zero,0)+(1-coalesce(prob_zero,0))*({gamma_cdf_sql(_U, 'gamma_alpha')}) END AS ps,
       CASE WHEN enough AND temp_stddev > 0 THEN round((t-temp_moyenne)/temp_stddev, 3) END AS sti,
       CASE WHEN NOT enough OR b IS NULL THEN NULL
            WHEN abs(glo_k) < 1e-6 THEN 1/(1+exp(-(b-glo_xi)/glo_alpha))
            WHEN 1-glo_k*(b-glo_xi)/glo_alpha > 0
            THEN 1/(1+pow(1-glo_k*(b-glo_xi)/glo_alpha, 1/glo_k)) END AS pe
FROM index_inputs"""
D["index_clipped"] = (f"SELECT * EXCLUDE (ps, pe), {clip('ps')} AS ps, {clip('pe')} AS pe "
                      "FROM index_probs")
D["grid_index"] = (f"SELECT era5_latitude, era5_longitude, month, fenetre, "
                   f"round({norm_ppf_sql('ps')}, 3) AS spi, sti, "
                   f"round({norm_ppf_sql('pe')}, 3) AS spei FROM index_clipped")

# ---- station indices -------------------------------------------------------------
_LO, _HI, _YEARS, _PER = REFERENCE


def reference_views(tag: str, source: str, code: str, value: str, tie: str, positive: bool) -> None:
    keep = " AND val > 0" if positive else ""
    D[f"{tag}_series"] = (f"SELECT {code} AS code, mois, {value} AS val, {tie} AS tie FROM {source} "
                          f"WHERE {value} IS NOT NULL AND {value} < 1e8 AND {value} > -1e4")
    D[f"{tag}_window"] = f"""
SELECT r.code,
       CASE WHEN r.inside >= {_YEARS} THEN DATE '{_LO}-01-01' WHEN b.s IS NOT NULL
            THEN make_date(b.s, 1, 1) ELSE r.d0 END AS baseline_start,
       CASE WHEN r.inside >= {_YEARS} THEN DATE '{_HI}-12-31' WHEN b.s IS NOT NULL
            THEN make_date(b.s + 29, 12, 31) ELSE r.d1 END AS baseline_end,
       CASE WHEN r.inside >= {_YEARS} THEN 'normale' WHEN b.s IS NOT NULL THEN 'adaptee'
            ELSE 'provisoire' END AS flag,
       CAST(CASE WHEN r.inside >= {_YEARS} THEN r.inside WHEN b.s IS NOT NULL THEN b.ny
            ELSE r.ny END AS INTEGER) AS n_years
FROM (SELECT code, COUNT(DISTINCT year(mois)) AS ny, MIN(mois) AS d0, MAX(mois) AS d1,
             COUNT(DISTINCT CASE WHEN year(mois) BETWEEN {_LO} AND {_HI} THEN year(mois) END) AS inside
      FROM {tag}_series WHERE TRUE{keep} GROUP BY 1) r
LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY ny DESC, s) AS rk
           FROM (SELECT v.code, b.s, COUNT(DISTINCT year(v.mois)) AS ny
                 FROM {tag}_series v JOIN (
                   SELECT code, UNNEST(range(CAST(floor(MIN(year(mois)) / 10) * 10 AS BIGINT),
                                             MAX(year(mois)) + 1, 10)) AS s
                   FROM {tag}_series WHERE TRUE{keep} GROUP BY code) b ON v.code = b.code
                 WHERE year(v.mois) BETWEEN b.s AND b.s + 29{keep} GROUP BY 1, 2) c
           WHERE ny >= {_YEARS}) q WHERE rk = 1) b ON r.code = b.code"""
    probs = ", ".join(f"{i / 100}" for i in range(1, 100))
    # quantile_cont weighs both neighbours and blurs plateaus by one ulp
    at = "CAST(floor(q * (len(vals) - 1)) AS INTEGER)"
    D[f"{tag}_own"] = f"""
SELECT code, m, list_transform([{probs}], lambda q: vals[{at} + 1]
         + (vals[least({at} + 2, len(vals))] - vals[{at} + 1]) * (q * (len(vals) - 1) - {at})) AS grid
FROM (SELECT v.code, month(v.mois) AS m, list(v.val ORDER BY v.val) AS vals
      FROM {tag}_series v JOIN {tag}_window w ON v.code = w.code
      WHERE v.mois BETWEEN w.baseline_start AND w.baseline_end{keep}
      GROUP BY 1, 2 HAVING COUNT(*) >= {_PER}) g"""
    D[f"{tag}_grid"] = f"""
SELECT t.code, t.month, n.grid AS quantile_grid, w.baseline_start, w.baseline_end,
       coalesce(w.flag, 'provisoire') AS flag, coalesce(w.n_years, 0) AS n_years
FROM (SELECT DISTINCT code, UNNEST(range(1, 13)) AS month FROM {tag}_series) t
LEFT JOIN {tag}_window w ON t.code = w.code
LEFT JOIN (SELECT * FROM (SELECT c.code, c.month, o.grid, row_number() OVER (
             PARTITION BY c.code, c.month
             ORDER BY least(abs(c.month - o.m), 12 - abs(c.month - o.m)), o.m) AS rk
           FROM (SELECT DISTINCT code, UNNEST(range(1, 13)) AS month FROM {tag}_series) c
           JOIN {tag}_own o ON c.code = o.code) x WHERE rk = 1) n
  ON t.code = n.code AND t.month = n.month"""
    i = "len(list_filter(g.quantile_grid, lambda x: x <= v.val))"
    D[f"{tag}_rank"] = f"""
SELECT v.*, g.quantile_grid, g.flag, g.baseline_start, g.baseline_end, {i} AS i
FROM {tag}_series v LEFT JOIN {tag}_grid g ON v.code = g.code AND month(v.mois) = g.month"""
    D[f"{tag}_prob"] = f"""
SELECT code, mois, tie, val, flag, baseline_start, baseline_end,
       CASE WHEN quantile_grid IS NOT NULL THEN least(greatest((
         CASE WHEN i = 0 THEN 1.0 WHEN i = 99 THEN 99.0
              ELSE i + (val - quantile_grid[i]) / (quantile_grid[i + 1] - quantile_grid[i]) END
         ) / 100, 0.001), 0.999) END AS p FROM {tag}_rank"""
    D[f"{tag}_z"] = f"SELECT *, round({norm_ppf_sql('p')}, 3) AS z FROM {tag}_prob"


reference_views("piezo", "monthly_levels", "code_bss", "niveau_moyen", "''", False)
reference_views("hydro", "monthly_flows", "code_station", "resultat_moyen", "grandeur_hydro_elab",
                True)


def classify_sql(z: str) -> str:
    return (f"CASE WHEN {z} IS NULL THEN 'UNKNOWN' WHEN {z} < -1.75 THEN 'EXTREMEMENT_BAS' "
            f"WHEN {z} < -1.28 THEN 'TRES_BAS' WHEN {z} < -0.84 THEN 'BAS' "
            f"WHEN {z} < 0.84 THEN 'NORMAL' WHEN {z} < 1.28 THEN 'HAUT' "
            f"WHEN {z} < 1.75 THEN 'TRES_HAUT' ELSE 'EXTREMEMENT_HAUT' END")


VIEWS = D
__all__ = ["VIEWS", "AS_OF"]

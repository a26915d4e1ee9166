"""Cleaning, predicates, deduplication, joins, summaries, windows, reshaping, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.views import (AS_OF, BBOX, RA_SQL, ct, haversine_sql, nearest_sql, num, quintile_sql,
                          top1)
from rivulet.functions import calendar, classes, clean, climate, geo
from rivulet.operators import dedup, joins, quality, reshape, spatial, summaries, windows
from rivulet.sources import files

# ---- casts and predicates ------------------------------------------------------

query("numeric_coercion", "s _dlt_id; f niveau_nappe_eau profondeur_nappe; l timestamp_mesure", """
SELECT _dlt_id, TRY_CAST(TRIM(niveau_nappe_eau) AS DOUBLE) AS niveau_nappe_eau,
       TRY_CAST(TRIM(profondeur_nappe) AS DOUBLE) AS profondeur_nappe,
       CASE WHEN regexp_matches(TRIM(timestamp_mesure), '^[+-]?[0-9]+$')
            THEN CAST(timestamp_mesure AS BIGINT) END AS timestamp_mesure
FROM raw_levels""")(lambda t: files.coerce_numeric(t("raw_levels")))


@query("silver_casts", "s code; f x; i nb; d debut fin; t maj; s _dlt_id", f"""
SELECT {ct('code_bss')} AS code, {num('x')} AS x,
       CAST(ROUND(CAST({ct('nb_mesures_piezo')} AS DECIMAL(18,4))) AS INTEGER) AS nb,
       CAST({ct('date_debut_mesure')} AS DATE) AS debut,
       CAST({ct('date_fin_mesure')} AS DATE) AS fin,
       CAST({ct('date_maj')} AS TIMESTAMP) AS maj, _dlt_id FROM raw_stations""")
def silver_casts(t):
    return t("raw_stations").select(
        clean.clean_text("code_bss").alias("code"), clean.clean_numeric("x").alias("x"),
        clean.clean_int("nb_mesures_piezo").alias("nb"),
        clean.clean_date("date_debut_mesure").alias("debut"),
        clean.clean_date("date_fin_mesure").alias("fin"),
        clean.clean_timestamp("date_maj").alias("maj"), "_dlt_id")


@query("lenient_casts", "s _dlt_id; f level as_number; d day", f"""
SELECT _dlt_id, TRY_CAST({ct('niveau_nappe_eau')} AS DOUBLE) AS level,
       TRY_CAST({ct('code_bss')} AS DOUBLE) AS as_number,
       TRY_CAST({ct('date_mesure')} AS DATE) AS day FROM raw_levels""")
def lenient_casts(t):
    return t("raw_levels").select(
        "_dlt_id", clean.clean_numeric("niveau_nappe_eau", strict=False).alias("level"),
        clean.clean_numeric("code_bss", strict=False).alias("as_number"),
        clean.clean_date("date_mesure", strict=False).alias("day"))


@query("required_fields", "s _dlt_id code; d day; f level depth", f"""
SELECT _dlt_id, {ct('code_bss')} AS code, CAST({ct('date_mesure')} AS DATE) AS day,
       {num('niveau_nappe_eau')} AS level, {num('profondeur_nappe')} AS depth FROM raw_levels
WHERE {ct('code_bss')} IS NOT NULL AND {ct('date_mesure')} IS NOT NULL
  AND ({num('niveau_nappe_eau')} IS NOT NULL OR {num('profondeur_nappe')} IS NOT NULL)""")
def required_fields(t):
    typed = t("raw_levels").select(
        "_dlt_id", clean.clean_text("code_bss").alias("code"),
        clean.clean_date("date_mesure").alias("day"),
        clean.clean_numeric("niveau_nappe_eau").alias("level"),
        clean.clean_numeric("profondeur_nappe").alias("depth"))
    return quality.require_any(quality.require_not_null(typed, ["code", "day"]),
                               ["level", "depth"])


query("bounding_box", "s code_bss; f x y", f"""
SELECT code_bss, x, y FROM stg_stations WHERE {BBOX.format(y='y', x='x')}""")(
    lambda t: t.stations.where(clean.in_bbox("y", "x")))

query("sentinel_filter", "s _dlt_id; f value", f"""
SELECT _dlt_id, {num('resultat_obs_elab')} AS value FROM raw_flows
WHERE {num('resultat_obs_elab')} > 5000 AND {num('resultat_obs_elab')} < 80000""")(
    lambda t: t("raw_flows").select(
        "_dlt_id", clean.clean_numeric("resultat_obs_elab").alias("value"))
    .where(clean.within_sentinels("value", 5000, 80000)))

query("coordinate_snap", "f latitude longitude; l n", """
SELECT CAST(ROUND(latitude, 1) AS DECIMAL(6,1)) AS latitude,
       CAST(ROUND(longitude, 1) AS DECIMAL(6,1)) AS longitude, COUNT(*) AS n
FROM raw_rain GROUP BY 1, 2""")(
    lambda t: t("raw_rain").groupBy(clean.snap("latitude").alias("latitude"),
                                    clean.snap("longitude").alias("longitude"))
    .agg(F.count(F.lit(1)).alias("n")))

query("station_points", "s code_bss; f lon lat", "SELECT code_bss, x AS lon, y AS lat FROM stg_stations")(
    lambda t: t.stations.select("code_bss", geo.make_point("x", "y").alias("p"))
    .select("code_bss", "p.lon", "p.lat"))

query("code_lists", "s _dlt_id first_code all_codes; i n_codes", """
SELECT _dlt_id, NULLIF(TRIM(split_part(COALESCE(codes_bdlisa, ''), ',', 1)), '') AS first_code,
       array_to_string(list_filter(list_transform(string_split(COALESCE(codes_bdlisa, ''), ','),
         lambda x: TRIM(x)), lambda x: x <> ''), '|') AS all_codes,
       len(list_filter(list_transform(string_split(COALESCE(codes_bdlisa, ''), ','),
         lambda x: TRIM(x)), lambda x: x <> '')) AS n_codes FROM raw_stations""")(
    lambda t: t("raw_stations").select(
        "_dlt_id", clean.first_token("codes_bdlisa").alias("first_code"),
        F.array_join(clean.tokens("codes_bdlisa"), "|").alias("all_codes"),
        F.size(clean.tokens("codes_bdlisa")).alias("n_codes")))

query("pass_through_columns", "s code_bss bss_id libelle_pe _dlt_load_id", f"""
SELECT {ct('code_bss')} AS code_bss, bss_id, libelle_pe, _dlt_load_id FROM raw_stations""")(
    lambda t: reshape.select_with_rest(
        t("raw_stations"), [clean.clean_text("code_bss").alias("code_bss")],
        ["code_bss", "x", "y", "_dlt_id"]))

query("station_status", "s code_station statut; d date_fermeture_station", f"""
SELECT code_station, date_fermeture_station, CASE WHEN date_fermeture_station IS NULL
       OR date_fermeture_station > DATE '{AS_OF}' THEN 'ACTIVE' ELSE 'FERMEE' END AS statut
FROM stg_hydro_stations""")(
    lambda t: t.hydro_stations.withColumn(
        "statut", classes.station_status("date_fermeture_station", AS_OF)))

_PLAIN = """SELECT code_bss, CAST(date_trunc('month', date_mesure) AS DATE) AS mois,
       AVG(niveau_nappe_eau) AS niveau_moyen, MIN(niveau_nappe_eau) AS niveau_min,
       MAX(niveau_nappe_eau) AS niveau_max,
       MAX(niveau_nappe_eau) - MIN(niveau_nappe_eau) AS amplitude_mensuelle,
       stddev_samp(niveau_nappe_eau) AS niveau_stddev, COUNT(*) AS nb_jours_mesures,
       AVG(profondeur_nappe) AS profondeur FROM daily_levels GROUP BY 1, 2"""
_M = f"({_PLAIN}) m"
_W = "PARTITION BY code_bss ORDER BY mois"


@query("threshold_classes", "s code_bss trend alert quality quintile; d mois; f pct", f"""
SELECT code_bss, mois, CASE WHEN d IS NULL THEN 'INSUFFISANT' WHEN d > 2 THEN 'HAUSSE'
       WHEN d < -2 THEN 'BAISSE' ELSE 'STABLE' END AS trend,
       CASE WHEN d < -5 THEN 'ALERTE' WHEN d < -2 THEN 'VIGILANCE' ELSE 'NORMAL' END AS alert,
       CASE WHEN d IS NULL THEN 'NON_CALCULEE' WHEN d >= 0.5 THEN 'FIABLE'
            WHEN d >= 0.2 THEN 'INDICATIVE' ELSE 'FAIBLE' END AS quality,
       {quintile_sql('p')} AS quintile,
       CASE WHEN prev <> 0 THEN (niveau_moyen - prev) / abs(prev) * 100 END AS pct
FROM (SELECT *, niveau_moyen - prev AS d FROM (
  SELECT *, LAG(niveau_moyen) OVER ({_W}) AS prev,
         percent_rank() OVER (PARTITION BY code_bss ORDER BY niveau_moyen NULLS LAST) AS p
  FROM {_M}) a) b""")
def threshold_classes(t):
    df = windows.previous(t.plain_monthly, ["code_bss"], "mois", ["niveau_moyen"])
    df = windows.history_percentile(df, ["code_bss"], "niveau_moyen", "p")
    df = df.withColumn("d", F.col("niveau_moyen") - F.col("niveau_moyen_prec"))
    return df.select(
        "code_bss", "mois", classes.trend_class("d", 2).alias("trend"),
        classes.alert_level("d", -5, -2).alias("alert"), classes.trend_quality("d").alias("quality"),
        classes.quintile_class("p").alias("quintile"),
        classes.pct_change("niveau_moyen", "niveau_moyen_prec").alias("pct"))


# ---- first row per key ---------------------------------------------------------

query("best_reading_per_day", "s code_bss; d date_mesure; f niveau_nappe_eau profondeur_nappe",
      "SELECT * FROM best_levels")(
    lambda t: dedup.dedup_latest(
        required_fields(t).select(F.col("code").alias("code_bss"), F.col("day").alias("date_mesure"),
                                  F.col("level").alias("niveau_nappe_eau"),
                                  F.col("depth").alias("profondeur_nappe")),
        ["code_bss", "date_mesure"], [("niveau_nappe_eau", "desc")]))

query("principal_quantity", "s l_suppkey l_returnflag", top1("""
SELECT l_suppkey, l_returnflag, SUM(CAST(l_quantity AS BIGINT)) AS q FROM lineitem GROUP BY 1, 2""",
      "l_suppkey", "q DESC, l_returnflag", "l_suppkey, l_returnflag"))(
    lambda t: dedup.principal_category(
        t("lineitem").select("l_suppkey", "l_returnflag", F.col("l_quantity").cast("bigint")
                             .alias("q")), "l_suppkey", "l_returnflag", "q"))

query("latest_year_per_station", "s code_bss; i annee; l n", top1("""
SELECT code_bss, CAST(year(date_mesure) AS INTEGER) AS annee, COUNT(*) AS n FROM daily_levels
GROUP BY 1, 2""", "code_bss", "annee DESC", "code_bss, annee, n"))(
    lambda t: dedup.latest_row(
        t.daily_levels.groupBy("code_bss", F.year("date_mesure").alias("annee"))
        .agg(F.count(F.lit(1)).alias("n")), ["code_bss"], [("annee", "desc")]))

query("last_readings", "s code_bss; d date_mesure; f niveau_nappe_eau", """
SELECT code_bss, date_mesure, niveau_nappe_eau FROM daily_levels
ORDER BY date_mesure DESC, code_bss, niveau_nappe_eau LIMIT 100""")(
    lambda t: dedup.last_n(t.daily_levels.select("code_bss", "date_mesure", "niveau_nappe_eau"),
                           "date_mesure", 100))

query("grid_cells", "f era5_latitude era5_longitude", "SELECT * FROM grid_points")(
    lambda t: dedup.distinct_points(t.grid_points, "era5_latitude", "era5_longitude"))

# ---- joins -----------------------------------------------------------------------

_RAWKEY = ct("code_bss")
query("known_stations_only", "s _dlt_id code_bss", f"""
SELECT _dlt_id, {_RAWKEY} AS code_bss FROM raw_levels
WHERE {_RAWKEY} IN (SELECT code_bss FROM stg_stations)""")(
    lambda t: joins.keep_known(
        t("raw_levels").select("_dlt_id", clean.clean_text("code_bss").alias("code_bss")),
        t.stations, "code_bss", spread=["_dlt_id"]))

query("unknown_station_rows", "s _dlt_id code_bss", f"""
SELECT _dlt_id, {_RAWKEY} AS code_bss FROM raw_levels
WHERE NOT EXISTS (SELECT 1 FROM stg_stations s WHERE s.code_bss = {_RAWKEY.replace('code_bss', 'raw_levels.code_bss')})""")(
    lambda t: joins.drop_known(
        t("raw_levels").select("_dlt_id", clean.clean_text("code_bss").alias("code_bss")),
        t.stations, "code_bss", spread=["_dlt_id"]))

query("station_enrichment", "s code_bss nom_commune code_departement; d date_mesure; f niveau_nappe_eau", """
SELECT l.code_bss, l.date_mesure, l.niveau_nappe_eau, s.nom_commune, s.code_departement
FROM best_levels l LEFT JOIN stg_stations s ON l.code_bss = s.code_bss""")(
    lambda t: joins.enrich(
        _best(t), t.stations, "code_bss",
                           ["nom_commune", "code_departement"]))


def _best(t):
    rows = required_fields(t).select(
        F.col("day").alias("date_mesure"), F.col("level").alias("niveau_nappe_eau"),
        F.col("depth").alias("profondeur_nappe"), F.col("code").alias("code_bss"))
    return dedup.first_per_key(rows, ["code_bss", "date_mesure"], [("niveau_nappe_eau", "desc")])


query("cells_in_use", "f latitude longitude; d day; l rain", """
SELECT d.latitude, d.longitude, d.day, d.rain FROM cell_days d WHERE EXISTS (
  SELECT 1 FROM used_cells c WHERE c.latitude = CAST(ROUND(d.latitude, 1) AS DECIMAL(6,1))
   AND c.longitude = CAST(ROUND(d.longitude, 1) AS DECIMAL(6,1)))""")(
    lambda t: joins.restrict_to_cells(
        t("cell_days").withColumns({"la": clean.snap("latitude"), "lo": clean.snap("longitude")}),
        reshape.union_distinct(
            t.mapping.select(F.col("era5_latitude").alias("la"), F.col("era5_longitude").alias("lo")),
            t.hydro_mapping.select(F.col("era5_latitude").alias("la"),
                                   F.col("era5_longitude").alias("lo"))), ["la", "lo"]))

query("rain_with_temperature", "f latitude longitude total_precipitation t2m_mean; t time", """
SELECT r.latitude, r.longitude, r.time, r.total_precipitation, t.t2m_mean
FROM stg_rain r LEFT JOIN stg_temps t USING (latitude, longitude, time)""")(
    lambda t: joins.left_align(
        t.rain.select("latitude", "longitude", "time", "total_precipitation"),
        t.temps.select("latitude", "longitude", "time", "t2m_mean"),
        ["latitude", "longitude", "time"]))

query("nearest_cell", "s code_bss; f era5_latitude era5_longitude", "SELECT * FROM located_stations")(
    lambda t: spatial.nearest(t.stations.where(clean.in_bbox("y", "x")), t.grid_points, "code_bss",
                              "y", "x"))

query("nearest_cell_any_distance", "s code_bss; f era5_latitude era5_longitude", top1("""
SELECT s.code_bss, g.era5_latitude, g.era5_longitude,
       round((CAST(g.era5_longitude AS DOUBLE) - (s.x + 20)) * (CAST(g.era5_longitude AS DOUBLE) - (s.x + 20))
           + (CAST(g.era5_latitude AS DOUBLE) - (s.y - 15)) * (CAST(g.era5_latitude AS DOUBLE) - (s.y - 15)), 9) AS d2
FROM stg_stations s CROSS JOIN grid_points g""", "code_bss", "d2, era5_latitude, era5_longitude"))(
    lambda t: spatial.nearest(
        t.stations.select("code_bss", (F.col("y") - 15).alias("y"), (F.col("x") + 20).alias("x")),
        t.grid_points, "code_bss", "y", "x"))

query("nearest_cells_k4", "s code_bss; f era5_latitude era5_longitude; i rank", """
SELECT code_bss, era5_latitude, era5_longitude, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY code_bss ORDER BY d2, era5_latitude, era5_longitude) AS rank FROM (
    SELECT s.code_bss, g.era5_latitude, g.era5_longitude,
           round((CAST(g.era5_longitude AS DOUBLE) - (s.x + s.o)) * (CAST(g.era5_longitude AS DOUBLE) - (s.x + s.o))
               + (CAST(g.era5_latitude AS DOUBLE) - s.y) * (CAST(g.era5_latitude AS DOUBLE) - s.y), 9) AS d2
    FROM (SELECT code_bss, x, y, CASE WHEN length(code_bss) % 2 = 0 THEN 30 ELSE 0 END AS o FROM stg_stations) s
    CROSS JOIN grid_points g) d) r WHERE rank <= 4""")(
    lambda t: spatial.nearest(
        t.stations.select("code_bss", "y", (F.col("x") + F.when(F.length("code_bss") % 2 == 0, 30).otherwise(0))
                          .alias("x")), t.grid_points, "code_bss", "y", "x", k=4))

query("cell_distance", "s code_bss; f metres", f"""
SELECT code_bss, {haversine_sql('x', 'y', 'era5_longitude', 'era5_latitude')} AS metres
FROM located_stations""")(
    lambda t: nearest_cells(t).withColumn(
        "metres", geo.haversine_m("x", "y", "era5_longitude", "era5_latitude")))


def nearest_cells(t):
    return spatial.nearest(t.stations.where(clean.in_bbox("y", "x")), t.grid_points, "code_bss",
                           "y", "x")


def vincenty_sql(source: str, key: str, lon1: str, lat1: str, lon2: str, lat2: str) -> str:
    """The eight rounds as nested subqueries."""
    f, a = geo.WGS84_F, geo.WGS84_A
    sql = (f"SELECT {key}, radians({lon2})-radians({lon1}) AS dl, radians({lon2})-radians({lon1}) AS lam,"
           f" atan((1-{f!r})*tan(radians({lat1}))) AS u1, atan((1-{f!r})*tan(radians({lat2}))) AS u2"
           f" FROM {source}")
    angle = ("SELECT *, CASE WHEN ca2 = 0 THEN 0 ELSE cs - 2*sin(u1)*sin(u2)/ca2 END AS cm FROM ("
             "SELECT *, 1-sa*sa AS ca2 FROM (SELECT *, atan2(ss,cs) AS sg,"
             " CASE WHEN ss = 0 THEN 0 ELSE cos(u1)*cos(u2)*sin(lam)/ss END AS sa FROM ("
             "SELECT *, sqrt(pow(cos(u2)*sin(lam),2)+pow(cos(u1)*sin(u2)-sin(u1)*cos(u2)*cos(lam),2)) AS ss,"
             " sin(u1)*sin(u2)+cos(u1)*cos(u2)*cos(lam) AS cs FROM ({}) v0) v1) v2) v3")
    for _ in range(8):
        c = f"({f!r}/16*ca2*(4+{f!r}*(4-3*ca2)))"
        sql = (f"SELECT {key}, dl, u1, u2, dl+(1-{c})*{f!r}*sa*(sg+{c}*ss*(cm+{c}*cs*(2*cm*cm-1)))"
               f" AS lam FROM ({angle.format(sql)}) it")
    b = a * (1 - f)
    return (f"SELECT {key}, {b!r}*ba*(sg-bb*ss*(cm+bb/4*(cs*(2*cm*cm-1)-bb/6*cm*(4*ss*ss-3)*(4*cm*cm-3))))"
            f" AS metres FROM (SELECT *, 1+q/16384*(4096+q*(-768+q*(320-175*q))) AS ba,"
            f" q/1024*(256+q*(-128+q*(74-47*q))) AS bb FROM (SELECT *, ca2*{(a*a-b*b)/(b*b)!r} AS q"
            f" FROM ({angle.format(sql)}) w0) w1) w2")


query("cell_distance_ellipsoid", "s code_bss; f metres",
      "SELECT code_bss, round(metres, 3) AS metres FROM ("
      + vincenty_sql("located_stations", "code_bss", "x", "y", "era5_longitude", "era5_latitude")
      + ") v")(
    lambda t: nearest_cells(t).withColumn(
        "metres", F.round(geo.distance_m("x", "y", "era5_longitude", "era5_latitude"), 3)))

query("entity_match", "s code_bss code_eh libelle_eh matched_by", """
SELECT s.code_bss, h.code_eh, h.libelle_eh, CASE WHEN h.pos = 0 THEN 'PRIMARY'
       WHEN h.pos > 0 THEN 'ANY' END AS matched_by
FROM located_stations s LEFT JOIN entity_hits h USING (code_bss)""")(
    lambda t: joins.match_entity(t.stations.where(clean.in_bbox("y", "x")), t.entities, "code_bss",
                                 "codes_bdlisa", attrs=["libelle_eh"]))

query("smallest_polygon", "s code_bss code_eh libelle_eh", top1("""
SELECT s.code_bss, b.code_eh, b.libelle_eh, (b.x1 - b.x0) * (b.y1 - b.y0) AS area FROM stg_stations s
JOIN boxes b ON s.x BETWEEN b.x0 AND b.x1 AND s.y BETWEEN b.y0 AND b.y1""",
      "code_bss", "area, code_eh"))(
    lambda t: spatial.contains_join(t.stations, t.boxes, "code_bss", "x", "y", "geometry",
                                    "code_eh", ["libelle_eh"]))

# boxes with a diamond cut out of the middle and a second part thirteen degrees east; all in
# binary fractions, so that equal areas are equal
query("smallest_polygon_parts", "s code_bss code_eh libelle_eh", top1("""
SELECT s.code_bss, b.code_eh, b.libelle_eh,
       (b.x1 - b.x0) * (b.y1 - b.y0) * 0.8125 AS area FROM stg_stations s
JOIN boxes b ON (s.x BETWEEN b.x0 AND b.x1 AND s.y BETWEEN b.y0 AND b.y1
                 AND abs(s.x - (b.x0 + b.x1) / 2) / (b.x1 - b.x0)
                   + abs(s.y - (b.y0 + b.y1) / 2) / (b.y1 - b.y0) > 0.375)
  OR (s.x BETWEEN b.x0 + 13 AND b.x0 + 13 + (b.x1 - b.x0) * 0.375
      AND s.y BETWEEN b.y0 AND b.y0 + (b.y1 - b.y0) * 0.25)""",
      "code_bss", "area, code_eh"))(
    lambda t: spatial.contains_join(t.stations, t.pierced_boxes, "code_bss", "x", "y", "geometry",
                                    "code_eh", ["libelle_eh"]))

query("recently_active", "s code_bss", f"""
SELECT DISTINCT code_bss FROM daily_levels WHERE date_mesure >= DATE '{AS_OF}' - INTERVAL 60 DAY""")(
    lambda t: joins.recent_keys(t.daily_levels, "code_bss", "date_mesure", AS_OF, 60))

_MONTHS = f"""SELECT CAST(UNNEST(generate_series(date_trunc('month', DATE '{AS_OF}') - INTERVAL 13 MONTH,
       date_trunc('month', DATE '{AS_OF}') - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS DATE) AS m"""
query("months_with_zero_fill", "d m; l n", f"""
SELECT c.m, COUNT(e.o_orderkey) AS n FROM ({_MONTHS}) c
LEFT JOIN orders e ON date_trunc('month', e.o_orderdate) = c.m GROUP BY 1""")(
    lambda t: joins.fill_months(joins.monthly_counts(t("orders"), "o_orderdate"),
                                reshape.month_series(t("orders"), AS_OF), "m", "n"))

query("temperature_bias", "f latitude longitude bias_mean bias_stddev; l n", """
SELECT latitude, longitude, AVG(r.temperature_2m - t.t2m_mean) AS bias_mean,
       stddev_samp(r.temperature_2m - t.t2m_mean) AS bias_stddev, COUNT(*) AS n
FROM stg_rain r JOIN stg_temps t USING (latitude, longitude, time) GROUP BY 1, 2""")(
    lambda t: joins.bias_stats(t.rain, t.temps, ["latitude", "longitude", "time"],
                               "temperature_2m", "t2m_mean", by=["latitude", "longitude"]))

query("network_stations", "s code_bss nom_commune", """
SELECT code_bss, nom_commune FROM stg_stations
WHERE code_bss IN (SELECT code_bss FROM network)""")(
    lambda t: joins.restrict_to_network(t.stations, t("network"), "code_bss"))

query("network_by_new_code", "s bss_id code_bss", """
SELECT bss_id, code_bss FROM stg_stations
WHERE bss_id IN (SELECT code_bss_nouveau FROM network)""")(
    lambda t: joins.restrict_to_network(t.stations, t("network"), "bss_id", "code_bss_nouveau"))

# ---- summaries -------------------------------------------------------------------

query("hourly_to_daily", "d time; f latitude longitude t2m_mean t2m_min t2m_max", """
SELECT CAST(time AS DATE) AS time, CAST(ROUND(latitude, 1) AS DECIMAL(6,1)) AS latitude,
       CAST(ROUND(longitude, 1) AS DECIMAL(6,1)) AS longitude, round_even(AVG(c), 2) AS t2m_mean,
       round_even(MIN(c), 2) AS t2m_min, round_even(MAX(c), 2) AS t2m_max
FROM (SELECT *, CASE WHEN isnan(t2m) THEN NULL ELSE t2m - 273.15 END AS c FROM hourly) h
GROUP BY 1, 2, 3 HAVING AVG(c) IS NOT NULL""")(
    lambda t: summaries.hourly_to_daily(t("hourly")))

query("monthly_station_summary", "s code_bss; d mois; l nb_jours_mesures; f niveau_moyen niveau_min"
      " niveau_max amplitude_mensuelle niveau_stddev profondeur", f"SELECT * FROM {_M}")(
    lambda t: t.plain_monthly)

query("annual_water_balance", "s l_suppkey; i annee; f balance", """
SELECT l_suppkey, CAST(year(mois) AS INTEGER) AS annee,
       SUM(rain) - SUM(evap * day(last_day(mois))) AS balance
FROM (SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS mois, SUM(l_quantity) AS rain,
             AVG(l_discount) AS evap FROM lineitem GROUP BY 1, 2) m GROUP BY 1, 2""")(
    lambda t: summaries.yearly_summary(
        summaries.monthly_summary(t("lineitem"), ["l_suppkey"], "l_shipdate", "mois",
                                  {"rain": F.sum("l_quantity"), "evap": F.avg("l_discount")}),
        ["l_suppkey"], "mois", "annee",
        {"balance": summaries.annual_balance("rain", "evap", "mois")}))

query("station_coverage", "s code_bss; d premiere_mesure derniere_mesure", """
SELECT code_bss, MIN(date_mesure) AS premiere_mesure, MAX(date_mesure) AS derniere_mesure
FROM daily_levels GROUP BY 1""")(lambda t: summaries.coverage(t.daily_levels, "code_bss", "date_mesure"))

query("lifetime_statistics", "s code_bss; l nb_mesures_total nb_mois_total; f moyenne deviation amplitude", f"""
SELECT code_bss, SUM(nb_jours_mesures) AS nb_mesures_total, COUNT(*) AS nb_mois_total,
       AVG(niveau_moyen) AS moyenne, stddev_samp(niveau_moyen) AS deviation,
       MAX(niveau_max) - MIN(niveau_min) AS amplitude FROM {_M} GROUP BY 1""")(
    lambda t: summaries.lifetime_stats(t.plain_monthly, ["code_bss"], {
        "nb_mesures_total": F.sum("nb_jours_mesures"), "nb_mois_total": F.count(F.lit(1)),
        "moyenne": F.avg("niveau_moyen"), "deviation": F.stddev_samp("niveau_moyen"),
        "amplitude": F.max("niveau_max") - F.min("niveau_min")}))

query("linear_trend", "s code_bss; l n; f slope intercept r2", f"""
SELECT code_bss, n, slope * 1e9 AS slope, intercept, r2 FROM (
  SELECT code_bss, COUNT(*) AS n, regr_slope(niveau_moyen, epoch(mois)) AS slope,
         regr_intercept(niveau_moyen, epoch(mois)) AS intercept, regr_r2(niveau_moyen, epoch(mois)) AS r2
  FROM {_M} WHERE mois >= DATE '{AS_OF}' - INTERVAL 60 MONTH GROUP BY 1) x WHERE n >= 24""")(
    lambda t: summaries.min_count(summaries.linear_trend(
        t.plain_monthly, "code_bss", "mois", "niveau_moyen",
        calendar.shift(F.lit(AS_OF).cast("date"), years=-5), with_n="n"), "n", 24)
    .withColumn("slope", F.col("slope") * 1e9))

query("positive_moments", "f latitude longitude mean_pos var_pos p_zero; l n_wet; f wet_mean wet_sd", """
SELECT latitude, longitude, AVG(rain) FILTER (WHERE rain > 0) AS mean_pos,
       var_samp(rain) FILTER (WHERE rain > 0) AS var_pos,
       AVG(CASE WHEN rain <= 0 THEN 1.0 ELSE 0.0 END) AS p_zero, COUNT(NULLIF(rain, 0)) AS n_wet,
       AVG(NULLIF(rain, 0)) AS wet_mean, stddev_samp(NULLIF(rain, 0)) AS wet_sd
FROM cell_days GROUP BY 1, 2""")(
    lambda t: t("cell_days").withColumn("wet", F.nullif("rain", F.lit(0)))
    .groupBy("latitude", "longitude").agg(*summaries.positive_moments("rain"),
                                          *summaries.valid_stats("wet", "n_wet", "wet_mean", "wet_sd")))

query("coverage_by_department", "s code_departement; l n_stations n_rows; d first_day last_day", """
SELECT s.code_departement, COUNT(DISTINCT l.code_bss) AS n_stations, COUNT(*) AS n_rows,
       MIN(date_mesure) AS first_day, MAX(date_mesure) AS last_day
FROM daily_levels l LEFT JOIN stg_stations s USING (code_bss) GROUP BY 1""")(
    lambda t: summaries.coverage_by(
        joins.enrich(t.daily_levels, t.stations, "code_bss", ["code_departement"]),
        ["code_departement"], "code_bss", "date_mesure"))

query("fill_rates", "f niveau profondeur code", f"""
SELECT round(100.0 * COUNT(n) / COUNT(*), 1) AS niveau, round(100.0 * COUNT(p) / COUNT(*), 1) AS profondeur,
       round(100.0 * COUNT(c) / COUNT(*), 1) AS code
FROM (SELECT {num('niveau_nappe_eau')} AS n, {num('profondeur_nappe')} AS p, code_bss AS c FROM raw_levels) x""")(
    lambda t: summaries.fill_rate(t("raw_levels").select(
        clean.clean_numeric("niveau_nappe_eau").alias("niveau"),
        clean.clean_numeric("profondeur_nappe").alias("profondeur"),
        F.col("code_bss").alias("code")), ["niveau", "profondeur", "code"]))

query("median_of_nonzero_counts", "s o_orderpriority; f median", """
SELECT o_orderpriority, quantile_cont(n, 0.5) AS median FROM (
  SELECT o_orderpriority, date_trunc('month', o_orderdate) AS m, COUNT(*) AS n FROM orders GROUP BY 1, 2) c
WHERE n > 0 GROUP BY 1""")(
    lambda t: summaries.median_nonzero(
        t("orders").groupBy("o_orderpriority", calendar.month_start("o_orderdate").alias("m"))
        .agg(F.count(F.lit(1)).alias("n")), "n", ["o_orderpriority"]))

_P99 = ", ".join(str(i / 100) for i in range(1, 100))
query("percentile_vectors", "s code_bss; i month p; l n; f value", f"""
SELECT code_bss, month, n, UNNEST(range(1, 100)) AS p, UNNEST(grid) AS value FROM (
  SELECT code_bss, CAST(month(mois) AS INTEGER) AS month, COUNT(niveau_moyen) AS n,
         quantile_cont(niveau_moyen, [{_P99}]) AS grid FROM {_M} WHERE niveau_moyen IS NOT NULL GROUP BY 1, 2) g""")(
    lambda t: summaries.percentile_vector(
        t.plain_monthly.withColumn("month", F.month("mois")), ["code_bss", "month"], "niveau_moyen")
    .select("code_bss", "month", "n", F.posexplode("grid").alias("i", "value"))
    .withColumn("p", F.col("i") + 1))

# ---- windows ---------------------------------------------------------------------

@query("rolling_and_lagged", "s code_bss; d mois; f m3 m12 vs_1 vs_12 cal_12", f"""
SELECT a.code_bss, a.mois, m3, m12, vs_1, vs_12, a.niveau_moyen - b.niveau_moyen AS cal_12
FROM (SELECT *, AVG(niveau_moyen) OVER ({_W} ROWS 2 PRECEDING) AS m3,
             AVG(niveau_moyen) OVER ({_W} ROWS 11 PRECEDING) AS m12,
             niveau_moyen - LAG(niveau_moyen) OVER ({_W}) AS vs_1,
             niveau_moyen - LAG(niveau_moyen, 12) OVER ({_W}) AS vs_12 FROM {_M}) a
LEFT JOIN {_M.replace(') m', ') b')} ON a.code_bss = b.code_bss AND b.mois = a.mois - INTERVAL 12 MONTH""")
def rolling_and_lagged(t):
    key = ["code_bss"]
    df = windows.rolling_mean(t.plain_monthly, key, "mois", "niveau_moyen", 3, "m3")
    df = windows.rolling_mean(df, key, "mois", "niveau_moyen", 12, "m12")
    df = windows.change_vs(df, key, "mois", "niveau_moyen", 1, "vs_1")
    df = windows.change_vs(df, key, "mois", "niveau_moyen", 12, "vs_12")
    return windows.change_vs_month(df, key, "mois", "niveau_moyen", 12, "cal_12")


@query("history_percentile", "s code_bss; i annee; f mean p prev m5", """
SELECT code_bss, annee, mean, percent_rank() OVER (PARTITION BY code_bss ORDER BY mean NULLS LAST) AS p,
       LAG(mean) OVER (PARTITION BY code_bss ORDER BY annee) AS prev,
       AVG(mean) OVER (PARTITION BY code_bss ORDER BY annee ROWS 4 PRECEDING) AS m5
FROM (SELECT code_bss, CAST(year(date_mesure) AS INTEGER) AS annee,
             CASE WHEN AVG(niveau_nappe_eau) < 27 THEN NULL ELSE AVG(niveau_nappe_eau) END AS mean
      FROM daily_levels GROUP BY 1, 2) y""")
def history_percentile(t):
    mean = F.avg("niveau_nappe_eau")
    df = t.daily_levels.groupBy("code_bss", F.year("date_mesure").alias("annee")).agg(
        F.when(mean < 27, F.lit(None)).otherwise(mean).alias("mean"))
    df = windows.history_percentile(df, ["code_bss"], "mean", "p")
    df = windows.previous(df, ["code_bss"], "annee", ["mean"])
    df = windows.rolling_mean(df, ["code_bss"], "annee", "mean", 5, "m5")
    return df.withColumnRenamed("mean_prec", "prev")


@query("rolling_sums_with_guards", "f era5_latitude era5_longitude rain_6 temp_6; d mois; l n_6 nt_6", """
SELECT era5_latitude, era5_longitude, mois, SUM(precipitation_totale) OVER w AS rain_6,
       AVG(CASE WHEN temp_complet THEN temperature_moyenne END) OVER w AS temp_6,
       COUNT(*) OVER w AS n_6, COUNT(CASE WHEN temp_complet THEN 1 END) OVER w AS nt_6
FROM monthly_grid WINDOW w AS (PARTITION BY era5_latitude, era5_longitude ORDER BY mois ROWS 5 PRECEDING)""")
def rolling_sums_with_guards(t):
    cell = ["era5_latitude", "era5_longitude"]
    df = windows.rolling_sum(t.monthly_grid, cell, "mois", "precipitation_totale", 6, "rain_6")
    df = windows.rolling_mean_if(df, cell, "mois", "temperature_moyenne", "temp_complet", 6, "temp_6")
    df = windows.rolling_count(df, cell, "mois", 6, "n_6")
    return windows.rolling_count(df, cell, "mois", 6, "nt_6", "temp_complet")


query("rolled_balance", "f era5_latitude era5_longitude bilan_cumul; d mois", """
SELECT * FROM (
  SELECT era5_latitude, era5_longitude, mois, SUM(bilan_hydrique) OVER w AS bilan_cumul, COUNT(*) OVER w AS n
  FROM monthly_grid WHERE mois >= DATE '1995-10-01' AND mois < DATE '2001-01-01'
  WINDOW w AS (PARTITION BY era5_latitude, era5_longitude ORDER BY mois ROWS 3 PRECEDING)) x
WHERE n = 4 AND mois >= DATE '1996-01-01'""")(
    lambda t: windows.rolled_balance(t.monthly_grid, ["era5_latitude", "era5_longitude"], "mois",
                                     "bilan_hydrique", 4, "1996-01-01", "2001-01-01", "bilan_cumul"))

# ---- reshaping -------------------------------------------------------------------

query("used_cells", "f latitude longitude", "SELECT * FROM used_cells")(
    lambda t: reshape.union_distinct(*[
        m.select(F.col("era5_latitude").alias("latitude"), F.col("era5_longitude").alias("longitude"))
        for m in (t.mapping, t.hydro_mapping)]))

query("union_with_missing_columns", "s code region; l n", """
SELECT code_bss AS code, NULL AS region, COUNT(*) AS n FROM stg_stations GROUP BY 1
UNION ALL SELECT code_site, code_region, COUNT(*) FROM stg_sites GROUP BY 1, 2""")(
    lambda t: reshape.union_all(
        t.stations.groupBy(F.col("code_bss").alias("code")).agg(F.count(F.lit(1)).alias("n")),
        t.sites.groupBy(F.col("code_site").alias("code"), F.col("code_region").alias("region"))
        .agg(F.count(F.lit(1)).alias("n")), fill_missing=True))

query("overall_date_bounds", "d min_date max_date", """
SELECT MIN(d) AS min_date, MAX(d) AS max_date FROM (
  SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem UNION ALL SELECT CAST(o_orderdate AS DATE) FROM orders) x""")(
    lambda t: reshape.overall_bounds(
        t("lineitem").select(F.to_date("l_shipdate").alias("d")),
        t("orders").select(F.to_date("o_orderdate").alias("d")), date="d"))

query("window_unpivot", "s l_suppkey; d mois; i fenetre; f total", """
SELECT l_suppkey, mois, 1 AS fenetre, q1 AS total FROM w WHERE n1 = 1
UNION ALL SELECT l_suppkey, mois, 3, q3 FROM w WHERE n3 = 3
UNION ALL SELECT l_suppkey, mois, 12, q12 FROM w WHERE n12 = 12""".replace(" FROM w ", """ FROM (
  SELECT *, SUM(q) OVER (PARTITION BY l_suppkey ORDER BY mois) AS q1c, q AS q1,
         SUM(q) OVER (PARTITION BY l_suppkey ORDER BY mois ROWS 2 PRECEDING) AS q3,
         SUM(q) OVER (PARTITION BY l_suppkey ORDER BY mois ROWS 11 PRECEDING) AS q12, 1 AS n1,
         COUNT(*) OVER (PARTITION BY l_suppkey ORDER BY mois ROWS 2 PRECEDING) AS n3,
         COUNT(*) OVER (PARTITION BY l_suppkey ORDER BY mois ROWS 11 PRECEDING) AS n12
  FROM (SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS mois, SUM(l_quantity) AS q
        FROM lineitem GROUP BY 1, 2) g) w """))(
    lambda t: reshape.unpivot_windows(
        summaries.monthly_summary(t("lineitem"), ["l_suppkey"], "l_shipdate", "mois",
                                  {"q": F.sum("l_quantity")})
        .withColumns({k: v for w in (1, 3, 12) for k, v in
                      windows.rolled_columns(["l_suppkey"], "mois", w, sums=["q"]).items()}),
        ["l_suppkey", "mois"], (1, 3, 12), {"total": "q"}))

query("calendar_template", "s code_bss; i month; l n", f"""
SELECT s.code_bss, m.month, COUNT(r.mois) AS n FROM stg_stations s
CROSS JOIN (SELECT UNNEST(range(1, 13)) AS month) m
LEFT JOIN {_M.replace(') m', ') r')} ON r.code_bss = s.code_bss AND month(r.mois) = m.month GROUP BY 1, 2""")(
    lambda t: reshape.calendar_template(t.stations.select("code_bss")).join(
        t.plain_monthly.select("code_bss", F.month("mois").alias("month"), "mois"),
        ["code_bss", "month"], "left").groupBy("code_bss", "month").agg(F.count("mois").alias("n")))

query("tagged_union", "s code type; l n", """
SELECT code_bss AS code, 'piezo' AS type, COUNT(*) AS n FROM daily_levels GROUP BY 1
UNION ALL SELECT code_station, 'hydro', COUNT(*) FROM daily_flows GROUP BY 1""")(
    lambda t: reshape.tag_union({
        "piezo": t.daily_levels.groupBy(F.col("code_bss").alias("code")).agg(F.count(F.lit(1)).alias("n")),
        "hydro": t.daily_flows.groupBy(F.col("code_station").alias("code"))
        .agg(F.count(F.lit(1)).alias("n"))}))

# ---- scalar functions --------------------------------------------------------------

query("date_parts", "d day; i year quarter month week day_of_year iso_day_of_week; b is_weekend; l n", """
SELECT CAST(o_orderdate AS DATE) AS day, year(o_orderdate) AS year, quarter(o_orderdate) AS quarter,
       month(o_orderdate) AS month, week(o_orderdate) AS week, dayofyear(o_orderdate) AS day_of_year,
       isodow(o_orderdate) AS iso_day_of_week, isodow(o_orderdate) IN (6, 7) AS is_weekend, COUNT(*) AS n
FROM orders GROUP BY ALL""")(
    lambda t: t("orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    .select("day", "n", *[c.alias(k) for k, c in calendar.date_parts("day").items()]))

query("date_arithmetic", "s _dlt_id; d month_start minus_week plus_year; i days; l epoch; t loaded", """
SELECT _dlt_id, CAST(date_trunc('month', d) AS DATE) AS month_start, d - INTERVAL 7 DAY AS minus_week,
       d + INTERVAL 1 YEAR AS plus_year, day(last_day(d)) AS days, epoch(d) AS epoch,
       make_timestamp(CAST(_dlt_load_id AS BIGINT) * 1000000) AS loaded
FROM (SELECT *, CAST(date_mesure AS DATE) AS d FROM raw_levels) x""")(
    lambda t: t("raw_levels").withColumn("d", clean.clean_date("date_mesure")).select(
        "_dlt_id", calendar.month_start("d").alias("month_start"),
        calendar.shift("d", days=-7).alias("minus_week"), calendar.shift("d", years=1).alias("plus_year"),
        calendar.days_in_month("d").alias("days"), calendar.epoch_seconds("d").alias("epoch"),
        calendar.load_time("_dlt_load_id").alias("loaded")))

query("reference_evapotranspiration", "f latitude longitude ra et0; d day", f"""
SELECT latitude, longitude, day, {RA_SQL} AS ra,
       greatest(0.0023*{RA_SQL}*(t2m_mean+17.8)*sqrt(greatest(t2m_max-t2m_min,0)),0) AS et0
FROM (SELECT *, CAST(time AS DATE) AS day FROM stg_temps) t""")(
    lambda t: t.temps.withColumn("day", F.to_date("time"))
    .withColumn("ra", climate.extraterrestrial_radiation("latitude", F.dayofyear("day")))
    .withColumn("et0", climate.hargreaves_et0("ra", "t2m_mean", "t2m_min", "t2m_max")))

query("gamma_moments", "f latitude longitude alpha beta", """
SELECT latitude, longitude, CASE WHEN v > 0 THEN m * m / v END AS alpha,
       CASE WHEN m > 0 AND v > 0 THEN v / m END AS beta
FROM (SELECT latitude, longitude, AVG(rain) FILTER (WHERE rain > 0) AS m,
             var_samp(rain) FILTER (WHERE rain > 0) AS v FROM cell_days GROUP BY 1, 2) x""")(
    lambda t: t("cell_days").groupBy("latitude", "longitude").agg(*summaries.positive_moments("rain"))
    .withColumns(dict(zip(("alpha", "beta"), climate.gamma_moments("mean_pos", "var_pos")))))

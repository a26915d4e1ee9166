"""Domain-shaped inputs derived from the driver tables.

One SQL text per input serves both engines; ``{name}`` stands for a driver
table or another adapter. Text defects (blanks, literal NULLs, unknown parents)
are derived from key arithmetic on every row; no rows are left out.

Stations are suppliers, readings are line items, so the inputs grow with the
scale factor while the calendar stays at seven years.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

AS_OF = "2001-11-05"

_CELL_LAT = "CAST(420 + {s} * 53 % 90 AS DOUBLE) / 10"
_CELL_LON = "CAST(-50 + {s} * 37 % 140 AS DOUBLE) / 10"

_STATION = """
SELECT {blank} || CAST(s_suppkey AS STRING) AS code_bss,
       'BSS' || CAST(100000 + s_suppkey AS STRING) AS bss_id,
       CAST(CAST(-5 + (s_suppkey * 37 % 140) / 10.0 + (s_suppkey * 3 % 10) / 10.0 - 0.49
            AS DECIMAL(9,2)) AS STRING) AS x,
       CASE WHEN s_acctbal < 0 THEN NULL ELSE
       CAST(CAST(42 + (s_suppkey * 53 % 90) / 10.0 + (s_suppkey * 7 % 10) / 10.0 - 0.47
            AS DECIMAL(9,2)) AS STRING) END AS y,
       CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS STRING) AS altitude_station,
       '1995-01-01' AS date_debut_mesure,
       CASE WHEN s_suppkey % 3 = 0 THEN 'NULL' ELSE '2001-12-31' END AS date_fin_mesure,
       {updated} AS date_maj,
       CAST(CAST(s_acctbal / 100 AS DECIMAL(9,1)) AS STRING) AS nb_mesures_piezo,
       'C' || CAST(s_suppkey % 37 AS STRING) AS code_commune_insee,
       {label} || CAST(s_suppkey % 37 AS STRING) AS nom_commune,
       CASE WHEN s_suppkey % 29 = 7 THEN '' ELSE CAST(s_nationkey AS STRING) END
         AS code_departement,
       n_name AS nom_departement,
       CASE s_suppkey % 4 WHEN 0 THEN NULL
            WHEN 1 THEN '0' || CAST(s_suppkey * 5 AS STRING) || 'AA'
            WHEN 2 THEN ' , 0' || CAST(s_suppkey * 3 AS STRING) || 'AA'
            ELSE 'XX9, 0' || CAST(s_suppkey * 4 AS STRING) || 'AA,0'
                 || CAST(s_suppkey * 2 AS STRING) || 'AA' END AS codes_bdlisa,
       s_name AS libelle_pe,
       CAST(s_suppkey AS STRING) || '-{rev}' AS _dlt_id,
       CAST(946684800 + s_suppkey AS STRING) AS _dlt_load_id
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey"""

_RAIN = """
SELECT CAST(day AS TIMESTAMP) AS time, latitude{noise} AS latitude, longitude AS longitude,
       CAST(8 + EXTRACT(MONTH FROM day) AS DOUBLE) AS temperature_2m,
       CAST(rain{plus} AS DOUBLE) AS total_precipitation,
       CAST(-(1 + (EXTRACT(DOY FROM day) + cell) % 5) AS DOUBLE) AS potential_evaporation,
       {tag} || CAST(EXTRACT(YEAR FROM day) AS STRING) AS source_file_id,
       CAST('{loaded}' AS TIMESTAMP) AS created_at
FROM {{cell_days}}"""

SHARED = {
    # readings: dirty text, hot keys, duplicates per day
    "raw_levels": """
SELECT CASE WHEN l_orderkey % 103 = 0 THEN NULL
            WHEN l_linenumber = 1 THEN ' ST' || CAST(l_suppkey AS STRING)
            ELSE 'ST' || CAST(l_suppkey AS STRING) END AS code_bss,
       CASE WHEN l_orderkey % 101 = 0 THEN NULL
            ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS date_mesure,
       CASE WHEN l_orderkey % 97 = 0 THEN 'NULL' WHEN l_orderkey % 89 = 0 THEN ''
            ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS niveau_nappe_eau,
       CASE WHEN l_orderkey % 97 = 0 THEN ' '
            ELSE CAST(CAST(ROUND(l_discount * 100) AS INT) AS STRING) END AS profondeur_nappe,
       CASE WHEN l_linenumber = 2 THEN '12.0'
            ELSE CAST(l_orderkey AS STRING) END AS timestamp_mesure,
       concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING),
                 CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING),
                 CAST(CAST(l_shipdate AS DATE) AS STRING),
                 CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS STRING)) AS _dlt_id,
       CAST(883612800 + l_orderkey AS STRING) AS _dlt_load_id
FROM {lineitem}""",
    "raw_stations": (
        _STATION.format(blank="' ST'", updated="'2001-01-01T00:00:00'", label="'Old '", rev=0)
        + "\nUNION ALL\n"
        + _STATION.format(blank="'ST'", rev=1, label="'Commune '", updated=(
            "CASE WHEN s_suppkey % 5 = 0 THEN 'NULL' ELSE '2001-06-01 12:30:00' END"))),
    "raw_sites": """
SELECT 'S' || CAST(CAST(FLOOR(s_suppkey / 2) AS BIGINT) AS STRING) AS code_site,
       CAST(CAST(-5 + (s_suppkey * 37 % 140) / 10.0 AS DECIMAL(9,2)) AS STRING) AS longitude_site,
       CASE WHEN s_acctbal > 9500 THEN 'NULL' ELSE
       CAST(CAST(42 + (s_suppkey * 53 % 90) / 10.0 AS DECIMAL(9,2)) AS STRING) END
         AS latitude_site,
       CAST(s_nationkey AS STRING) AS code_departement, n_name AS libelle_departement,
       'Site ' || CAST(s_suppkey AS STRING) AS libelle_site, 'REEL' AS type_site,
       CAST(CAST(s_suppkey * 3 AS INT) AS STRING) AS surface_bv,
       'C' || CAST(s_suppkey % 37 AS STRING) AS code_commune_site,
       'Commune ' || CAST(s_suppkey % 37 AS STRING) AS libelle_commune,
       CAST(n_regionkey AS STRING) AS code_region,
       'Region ' || CAST(n_regionkey AS STRING) AS libelle_region,
       'Z' || CAST(s_suppkey % 11 AS STRING) AS code_zone_hydro_site,
       '2001-0' || CAST(1 + s_suppkey % 9 AS STRING) || '-01T00:00:00' AS date_maj_site
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "raw_hydro_stations": """
SELECT CASE WHEN s_suppkey % 31 = 11 THEN '' ELSE 'H' || CAST(s_suppkey AS STRING) END
         AS code_station,
       CASE WHEN s_acctbal < 0 THEN 'S?'
            ELSE 'S' || CAST(CAST(FLOOR(s_suppkey / 2) AS BIGINT) AS STRING) END AS code_site,
       CAST(CAST(-5 + (s_suppkey * 37 % 140) / 10.0 + (s_suppkey * 3 % 10) / 10.0 - 0.49
            AS DECIMAL(9,2)) AS STRING) AS longitude_station,
       CASE WHEN s_suppkey % 23 = 5 THEN NULL ELSE
       CAST(CAST(42 + (s_suppkey * 53 % 90) / 10.0 + (s_suppkey * 7 % 10) / 10.0 - 0.47
            AS DECIMAL(9,2)) AS STRING) END AS latitude_station,
       CAST(s_suppkey % 500 AS STRING) AS altitude_ref_alti_station,
       CAST(s_nationkey AS STRING) AS code_departement, n_name AS libelle_departement,
       s_name AS libelle_station,
       'Site ' || CAST(s_suppkey AS STRING) AS libelle_site,
       'R' || CAST(s_suppkey % 13 AS STRING) AS code_cours_eau,
       'River ' || CAST(s_suppkey % 13 AS STRING) AS libelle_cours_eau,
       'http://example.org/river/R' || CAST(s_suppkey % 13 AS STRING) AS uri_cours_eau,
       '1994-05-17' AS date_ouverture_station,
       CASE s_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN '2001-06-30' ELSE '2003-01-01' END
         AS date_fermeture_station,
       '2001-0' || CAST(1 + s_suppkey % 9 AS STRING) || '-15' AS date_maj_station,
       CAST(s_suppkey AS STRING) AS _dlt_id
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    "raw_flows": """
SELECT 'S' || CAST(CAST(FLOOR(l_suppkey / 2) AS BIGINT) AS STRING) AS code_site,
       'H' || CAST(l_suppkey AS STRING) AS code_station,
       CASE WHEN l_orderkey % 101 = 0 THEN NULL
            ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS date_obs_elab,
       CASE l_returnflag WHEN 'A' THEN 'QmnJ' WHEN 'N' THEN 'QmxJ' ELSE 'H' END
         AS grandeur_hydro_elab,
       CASE WHEN l_orderkey % 97 = 0 THEN 'NULL'
            ELSE CAST(CAST(ROUND(l_extendedprice) AS BIGINT) AS STRING) END AS resultat_obs_elab,
       CAST(CAST(l_shipdate AS DATE) AS STRING) || ' 06:00:00' AS date_prod,
       CAST(l_linenumber AS STRING) AS code_statut, l_linestatus AS libelle_statut,
       CAST(l_linenumber % 3 AS STRING) AS code_methode, 'Method' AS libelle_methode,
       CAST(l_linenumber % 4 AS STRING) AS code_qualification, 'Good' AS libelle_qualification,
       CAST(CAST(-5 + (l_suppkey * 37 % 140) / 10.0 AS DECIMAL(9,2)) AS STRING) AS longitude,
       CAST(CAST(42 + (l_suppkey * 53 % 90) / 10.0 AS DECIMAL(9,2)) AS STRING) AS latitude,
       concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING),
                 CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING),
                 CAST(CAST(l_shipdate AS DATE) AS STRING),
                 CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS STRING)) AS _dlt_id
FROM {lineitem}""",
    # climate: one 0.1 degree cell per supplier, a gap-free calendar per cell
    "cell_rain": f"""
SELECT {_CELL_LAT.format(s='l_suppkey')} AS latitude, {_CELL_LON.format(s='l_suppkey')} AS longitude,
       CAST(l_shipdate AS DATE) AS day, SUM(CAST(l_quantity AS BIGINT)) AS rain
FROM {{lineitem}} GROUP BY 1, 2, 3""",
    "cell_days": """
SELECT d.latitude, d.longitude, d.cell, d.day, COALESCE(r.rain, 0) AS rain
FROM {cell_calendar} d LEFT JOIN {cell_rain} r
  ON d.latitude = r.latitude AND d.longitude = r.longitude AND d.day = r.day""",
    "raw_rain": (
        _RAIN.format(noise="", plus="", tag="'first_'", loaded="2001-12-01 00:00:00")
        + "\nUNION ALL\n"
        + _RAIN.format(noise=" + 0.000000001", plus=" + 1", tag="'again_'",
                       loaded="2001-12-02 00:00:00")
        + "\nWHERE day >= DATE '2001-06-01'"),
    "raw_temps": """
SELECT CAST(day AS TIMESTAMP) AS time, latitude, longitude,
       CASE WHEN EXTRACT(DOY FROM day) = 100 + cell % 200 AND EXTRACT(YEAR FROM day) >= 1999
            THEN NULL ELSE CAST(mean AS DOUBLE) END AS t2m_mean,
       CAST(mean - 4 - EXTRACT(DOY FROM day) % 3 AS DOUBLE) AS t2m_min,
       CAST(mean + 5 + EXTRACT(DOY FROM day) % 4 AS DOUBLE) AS t2m_max,
       'temps_' || CAST(EXTRACT(YEAR FROM day) AS STRING) AS source_file_id,
       CAST('2001-12-01 00:00:00' AS TIMESTAMP) AS created_at
FROM (SELECT *, 2 + FLOOR(EXTRACT(MONTH FROM day) * (13 - EXTRACT(MONTH FROM day)) / 3)
             + (EXTRACT(YEAR FROM day) * 7 + cell) % 5 + EXTRACT(DOY FROM day) % 2 AS mean
      FROM {cell_days}) days""",
    "hourly": f"""
SELECT ts AS time, {_CELL_LAT.format(s='user_id')} AS latitude,
       {_CELL_LON.format(s='user_id')} AS longitude,
       CASE WHEN event_type = 'error' THEN CAST('NaN' AS DOUBLE)
            ELSE FLOOR(value) + 273.15 END AS t2m
FROM {{events}}""",
    # entities: three raw versions per code, attributes partly blank
    "raw_entites": """
SELECT CAST(p_partkey AS STRING) AS tme_id,
       '0' || CAST(CAST(FLOOR(p_partkey / 3) AS BIGINT) AS STRING) || 'AA' AS code_eh,
       CASE WHEN p_size % 5 = 0 THEN ' ' ELSE p_name END AS libelle_eh,
       CAST(p_size AS STRING) AS ordre_abs_eh, CAST(p_partkey % 4 AS STRING) AS niveau_eh,
       p_brand AS inclus_eh,
       CASE WHEN p_partkey % 9 = 8 THEN 'X' ELSE CAST(p_partkey % 9 AS STRING) END AS etat_eh,
       CAST(p_size % 8 AS STRING) AS nature_eh,
       CASE WHEN p_size % 13 = 12 THEN 'X' ELSE CAST(p_size % 13 AS STRING) END AS milieu_eh,
       CAST(p_size % 7 AS STRING) AS theme_eh, p_type AS origine_eh
FROM {part}""",
    "entities_a": """
SELECT CAST(p_partkey AS STRING) AS tme_id,
       CASE WHEN p_size % 10 = 3 THEN CAST(p_partkey AS STRING)
            ELSE ' 0' || CAST(CAST(FLOOR(p_partkey / 2) AS BIGINT) AS STRING) || 'AA' END AS code_eh,
       p_name AS libelle_eh, '' AS ordre_abs_eh, CAST(p_partkey % 4 AS STRING) AS niveau_eh,
       CASE WHEN p_size % 2 = 0 THEN '' ELSE p_brand END AS inclus_eh, '' AS etat_eh,
       CAST(p_size % 8 AS STRING) AS nature_eh, '' AS milieu_eh, '' AS theme_eh, '' AS origine_eh
FROM {part}""",
    "entities_b": """
SELECT CAST(p_partkey AS STRING) AS tme_id,
       '0' || CAST(CAST(FLOOR(p_partkey / 3) AS BIGINT) AS STRING) || 'AA' AS code_eh,
       '' AS libelle_eh, CAST(p_size AS STRING) AS ordre_abs_eh,
       CASE WHEN p_size % 3 = 0 THEN '' ELSE CAST(p_partkey % 4 AS STRING) END AS niveau_eh,
       p_brand AS inclus_eh, '' AS etat_eh, CAST(p_size % 8 AS STRING) AS nature_eh,
       '' AS milieu_eh, CASE WHEN p_size % 4 = 0 THEN '5' ELSE '' END AS theme_eh,
       '' AS origine_eh
FROM {part}""",
    # nested rectangles; stations never lie on an edge
    "boxes": """
SELECT 'N' || CAST(n_nationkey AS STRING) AS code_eh, n_name AS libelle_eh,
       CAST(-5 + (n_nationkey % 5) * 3 AS DOUBLE) AS x0,
       CAST(-5 + (n_nationkey % 5) * 3 + 3 + n_nationkey % 4 AS DOUBLE) AS x1,
       CAST(42 + FLOOR(n_nationkey / 5) * 2 AS DOUBLE) AS y0,
       CAST(42 + FLOOR(n_nationkey / 5) * 2 + 2 + n_nationkey % 3 AS DOUBLE) AS y1
FROM {nation}""",
    "network": """
SELECT 'ST' || CAST(s_suppkey AS STRING) AS code_bss,
       'BSS' || CAST(100000 + s_suppkey AS STRING) AS code_bss_nouveau
FROM {supplier} WHERE s_acctbal > 4000""",
}

_CALENDAR = (
    "SELECT latitude, longitude, cell, {each} AS day FROM ("
    f"SELECT {_CELL_LAT.format(s='l_suppkey')} AS latitude,"
    f" {_CELL_LON.format(s='l_suppkey')} AS longitude,"
    " MIN(l_suppkey) AS cell, MIN(CAST(l_shipdate AS DATE)) AS d0,"
    " MAX(CAST(l_shipdate AS DATE)) AS d1 FROM {{lineitem}} GROUP BY 1, 2) spans")

SPARK = SHARED | {
    "cell_calendar": _CALENDAR.format(each="EXPLODE(SEQUENCE(d0, d1))")}
DUCKDB = SHARED | {
    "cell_calendar": _CALENDAR.format(
        each="CAST(UNNEST(generate_series(d0, d1, INTERVAL 1 DAY)) AS DATE)")}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


class Inputs:
    """Driver tables and adapters of one scale factor, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        text = SPARK[name]
        needs = set(_PLACEHOLDER.findall(text))
        return self.spark.sql(text, **{n: self(n) for n in needs})


def cte_chain(sql: str, views: dict[str, str]) -> str:
    """Prefix ``sql`` with the CTEs it names, directly or through others."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\w+", text)):
            if word in views and word not in order and views[word] is not text:
                visit(views[word])
                if word not in order:
                    order.append(word)

    visit(sql)
    if not order:
        return sql
    bodies = ",\n".join(f"{n} AS ({_PLACEHOLDER.sub(r'\1', views[n]).strip()})" for n in order)
    return f"WITH {bodies}\n{sql.strip()}"

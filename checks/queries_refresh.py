"""Incremental refresh, sinks, landed files and streams.

Sinks and streams write below the shared folder of the session and return what
they stored, so their result is comparable like any other query.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.queries_tables import MONTHLY_LEVELS, YEARLY_LEVELS
from checks.registry import query
from checks.views import AS_OF, SNAP_LAT, SNAP_LON, top1
from rivulet.functions import clean, geo
from rivulet.operators import joins, quality, refresh, reshape
from rivulet.plans import climate, facts, staging
from rivulet.sources import files, tables
from rivulet.streaming import landing

_DAILY = "s code_bss; d date_mesure; f niveau_nappe_eau profondeur_nappe"
_CUT = f"DATE '{AS_OF}' - INTERVAL 90 DAY"


def _day(text: str):
    return F.lit(text).cast("date")


def _stale(df, day: str, since: str, value: str):
    """The table as it was before corrections arrived: newer rows missing, recent ones off."""
    return df.where(F.col(day) < _day(since)).withColumn(
        value, F.when(F.col(day) >= F.date_sub(_day(since), 60), F.col(value) - 1)
        .otherwise(F.col(value)))


def _undated(df, day: str, like: str, code=None):
    """The rows of one day once more, without a day; the tables of rejects hold such rows."""
    rows = df.where(F.col(day) == _day(like)).withColumn(day, F.lit(None).cast("date"))
    return rows if code is None else rows.withColumn("code_bss", code)


def _undated_sql(table: str, day: str, like: str, code: str = "code_bss") -> str:
    return f"""
SELECT {code} AS code_bss, CAST(NULL AS DATE) AS {day}, niveau_nappe_eau, profondeur_nappe
FROM {table} WHERE {day} = DATE '{like}'"""


_ALL_DAYS = "SELECT code_bss, date_mesure, niveau_nappe_eau, profondeur_nappe FROM daily_levels"
_UNDATED = _undated_sql("daily_levels", "date_mesure", "1999-03-03")


# ---- pure refresh queries --------------------------------------------------------

query("replace_recent_window", "s code_bss; d date_mesure; f niveau_nappe_eau", f"""
SELECT code_bss, date_mesure, niveau_nappe_eau - CASE WHEN date_mesure < {_CUT} THEN 1 ELSE 0 END
  AS niveau_nappe_eau FROM daily_levels""")(
    lambda t: refresh.replace_recent(
        t.daily_levels.withColumn("niveau_nappe_eau", F.col("niveau_nappe_eau") - 1),
        t.daily_levels, "date_mesure", 90, AS_OF).select("code_bss", "date_mesure", "niveau_nappe_eau"))

query("replace_range", "s code_bss; d date_mesure; f niveau_nappe_eau", """
SELECT code_bss, date_mesure, niveau_nappe_eau
  - CASE WHEN date_mesure BETWEEN DATE '1998-03-10' AND DATE '1999-02-05' THEN 0 ELSE 1 END
  AS niveau_nappe_eau FROM daily_levels""")(
    lambda t: refresh.replace_range(
        t.daily_levels.withColumn("niveau_nappe_eau", F.col("niveau_nappe_eau") - 1),
        t.daily_levels, "date_mesure", "1998-03-10", "1999-02-05"))

query("update_window_per_station", "s l_suppkey; d window_start window_end; s window_status", f"""
SELECT l_suppkey, greatest(last - 2, DATE '{AS_OF}' - 5 - 60) AS window_start,
       DATE '{AS_OF}' - 5 AS window_end,
       CASE WHEN greatest(last - 2, DATE '{AS_OF}' - 65) >= DATE '{AS_OF}' - 5 THEN 'up_to_date'
            WHEN last - 2 < DATE '{AS_OF}' - 65 THEN 'gap' ELSE 'ok' END AS window_status
FROM (SELECT l_suppkey, MAX(CAST(l_shipdate AS DATE)) AS last FROM lineitem GROUP BY 1) m""")(
    lambda t: t("lineitem").groupBy("l_suppkey").agg(F.max(F.to_date("l_shipdate")).alias("last"))
    .withColumns(refresh.update_window_columns("last", _day(AS_OF), 5)))

query("window_month_days", "s o_custkey; i year month first_day last_day", """
SELECT o_custkey, year(m) AS year, month(m) AS month, day(greatest(m, a)) AS first_day,
       day(least(last_day(m), b)) AS last_day
FROM (SELECT *, CAST(UNNEST(generate_series(date_trunc('month', a), date_trunc('month', b),
             INTERVAL 1 MONTH)) AS DATE) AS m
      FROM (SELECT o_custkey, MIN(CAST(o_orderdate AS DATE)) AS a, MAX(CAST(o_orderdate AS DATE)) AS b
            FROM orders GROUP BY 1) w) x""")(
    lambda t: reshape.window_months(
        t("orders").groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("a"),
                                             F.max(F.to_date("o_orderdate")).alias("b")), "a", "b"))

query("distinct_keys", "s key", "SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS key FROM lineitem")(
    lambda t: files.distinct_keys(t("lineitem").withColumnRenamed("l_partkey", "key"), "key"))

query("key_batches", "l batch n_keys", """
SELECT batch, COUNT(*) AS n_keys FROM (
  SELECT (row_number() OVER (ORDER BY key) - 1) // 100 AS batch
  FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS key FROM orders) k) b GROUP BY 1""")(
    lambda t: files.key_batches(t("orders").withColumnRenamed("o_custkey", "key"), "key", 100)
    .groupBy("batch").agg(F.countDistinct("key").alias("n_keys")))

_LEDGER = """SELECT 'load' AS job, CAST(year(o_orderdate) AS STRING) AS partition,
       CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'failed' END AS status,
       o_orderdate AS logged_at, o_orderkey FROM orders"""


@query("backfill_pending", "s partition", f"""
SELECT partition FROM (SELECT *, row_number() OVER (PARTITION BY partition ORDER BY logged_at DESC, o_orderkey DESC) AS rk
  FROM ({_LEDGER}) l) x WHERE rk = 1 AND status <> 'completed'
UNION SELECT CAST(y AS STRING) FROM (SELECT UNNEST(range(1990, 1995)) AS y) z""")
def backfill_pending(t):
    ledger = t("orders").select(
        F.lit("load").alias("job"), F.year("o_orderdate").cast("string").alias("partition"),
        F.when(F.col("o_orderstatus") == "F", "completed").otherwise("failed").alias("status"),
        F.struct("o_orderdate", "o_orderkey").alias("at"))
    years = t("orders").select(F.explode(F.sequence(F.lit(1990), F.year("o_orderdate")))
                               .alias("partition")).distinct()
    years = years.select(F.col("partition").cast("string"))
    return tables.pending_partitions(years, ledger, "load")


_LOOK = "(SELECT MAX(date_mesure) FROM daily_levels WHERE date_mesure < DATE '2000-06-01')"
query("lookback_window", _DAILY, f"""
SELECT * FROM stg_levels WHERE date_mesure >= {_LOOK} - INTERVAL 7 DAY""")(
    lambda t: refresh.lookback_filter(t.levels, t.daily_levels.where("date_mesure < '2000-06-01'"),
                                      "date_mesure", 7))

query("reprocess_from", _DAILY, "SELECT * FROM stg_levels WHERE date_mesure >= DATE '1999-11-15'")(
    lambda t: refresh.lookback_filter(t.levels, t.daily_levels, "date_mesure",
                                      reprocess_from="1999-11-15"))

query("newer_loads", "f latitude longitude total_precipitation; t time created_at", """
SELECT * FROM raw_rain WHERE created_at > (SELECT MAX(created_at) FROM raw_rain
  WHERE created_at < TIMESTAMP '2001-12-02')""")(
    lambda t: refresh.newer_than(t("raw_rain"), t("raw_rain").where("created_at < '2001-12-02'"),
                                 "created_at"))


@query("incremental_staging", _DAILY, "SELECT * FROM stg_levels")
def incremental_staging(t):
    """Stored silver up to mid-2001 plus an upsert of the look-back window: equal to a rebuild.

    Bronze is stored by the year of the reading, so only the last years are read.
    """
    old, bronze = t.levels.where("date_mesure < '2001-06-01'"), t.scratch("bronze")
    (t("raw_levels").withColumn("year", F.year(clean.clean_date("date_mesure")))
     .write.partitionBy("year").parquet(bronze))
    new = staging.build_stg_piezo_chroniques(t.spark.read.parquet(bronze), t.stations, target=old, days=7)
    return refresh.upsert(old, new, ["code_bss", "date_mesure"])


@query("incremental_climate_staging", "f latitude longitude total_precipitation; t time created_at",
       "SELECT * FROM stg_rain")
def incremental_climate_staging(t):
    """Keyed on load time, re-loaded days replace the stored ones."""
    old = staging.build_stg_era5_timeseries(t("raw_rain").where("created_at < '2001-12-02'"))
    new = staging.build_stg_era5_timeseries(t("raw_rain"), target=old)
    return refresh.upsert(old, new, ["latitude", "longitude", "time"])


query("upsert_by_key", _DAILY, f"{_ALL_DAYS} UNION ALL {_UNDATED}")(
    lambda t: refresh.upsert(
        _stale(t.daily_levels, "date_mesure", "2001-03-01", "niveau_nappe_eau").unionByName(
            _undated(t.daily_levels, "date_mesure", "1999-03-03")),
        t.daily_levels.where("date_mesure >= '2000-12-01'"), ["code_bss", "date_mesure"]))


@query("upsert_partition", _DAILY, f"{_ALL_DAYS} UNION ALL {_UNDATED} UNION ALL "
       + _undated_sql("daily_levels", "date_mesure", "1999-03-04", "code_bss || '-2'"))
def upsert_partition(t):
    """Undated rows are stored, and more of them under other keys come with the corrections."""
    path = t.scratch("upsert")
    tables.upsert_table(_stale(t.daily_levels, "date_mesure", "2001-03-01", "niveau_nappe_eau")
                        .unionByName(_undated(t.daily_levels, "date_mesure", "1999-03-03")),
                        path, ["code_bss", "date_mesure"], "date_mesure")
    more = _undated(t.daily_levels, "date_mesure", "1999-03-04", F.concat("code_bss", F.lit("-2")))
    return tables.upsert_table(t.daily_levels.where("date_mesure >= '2000-12-01'").unionByName(more),
                               path, ["code_bss", "date_mesure"], "date_mesure")


@query("upsert_moved_key", "l o_orderkey; d o_orderdate; f o_totalprice",
       "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_totalprice FROM orders")
def upsert_moved_key(t):
    """Some orders were stored under a wrong year; corrections by order number alone find them."""
    path = t.scratch("moved")
    orders = t("orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice")
    wrong = F.col("o_orderkey") % 9 == 0
    tables.upsert_moved(orders.where("o_orderkey % 5 <> 1").withColumn("o_orderdate", F.when(
        wrong, F.add_months("o_orderdate", 12 * (1 + F.col("o_orderkey") % 3))).otherwise(F.col("o_orderdate"))),
        path, ["o_orderkey"], "o_orderdate", parts=16)
    return tables.upsert_moved(orders.where(wrong | (F.col("o_orderkey") % 5 == 1)), path, ["o_orderkey"],
                               "o_orderdate", parts=16)


_FACT = "s code_bss; d date; f niveau_nappe_eau temperature_2m total_precipitation era5_latitude"


@query("recent_fact_recompute", _FACT, "SELECT * FROM fact_levels")
def recent_fact_recompute(t):
    """A month of stale rows, rebuilt from both sources cut at the same day."""
    stale = _stale(t.fact_levels, "date", "2001-10-20", "niveau_nappe_eau")
    stale = t.fact_levels.where(F.col("date") < _day("2001-08-21")).unionByName(
        stale.where(F.col("date") >= _day("2001-08-21")))
    return refresh.recompute_recent(
        lambda cut: facts.build_piezo_daily_chroniques(t.daily_levels, t.mapping, t.weather, cut),
        stale, "date", AS_OF, days=90)


@query("recent_months_recompute", MONTHLY_LEVELS, "SELECT * FROM monthly_levels")
def recent_months_recompute(t):
    """The last 25 months again, with the stored months as rolling context."""
    stale = t.monthly_levels.withColumn("niveau_moyen", F.when(
        F.col("mois") >= _day("2001-01-01"), F.lit(0.0)).otherwise(F.col("niveau_moyen")))
    return refresh.recompute_months(facts.aggregate_monthly_chroniques,
                                    facts.roll_monthly_chroniques, t.pruned("fact_levels"),
                                    "date", stale, "mois")


@query("active_stations_recompute", YEARLY_LEVELS, "SELECT * FROM yearly_levels")
def active_stations_recompute(t):
    active = joins.recent_keys(t.fact_levels, "code_bss", "date", AS_OF, 60)
    stale = t.yearly_levels.join(active.withColumn("_hit", F.lit(True)), "code_bss", "left")
    stale = stale.withColumn("amplitude_annuelle", F.when(
        F.col("_hit"), F.lit(-1.0)).otherwise(F.col("amplitude_annuelle"))).drop("_hit")
    return refresh.recompute_active(facts.build_fct_yearly_stats, t.monthly_levels, active, stale,
                                    "code_bss")


@query("recent_grid_recompute", "f era5_latitude era5_longitude precipitation_totale etp_totale; d mois;"
       " l nb_jours", "SELECT * FROM monthly_grid")
def recent_grid_recompute(t):
    stale = t.monthly_grid.where("mois < '2001-10-01'").withColumn("etp_totale", F.when(
        F.col("mois") >= _day("2001-08-01"), F.lit(0.0)).otherwise(F.col("etp_totale")))
    return refresh.recompute_recent(
        lambda cut: climate.build_fct_era5_monthly_grid(t.rain, t.temps, cut), stale, "mois",
        AS_OF, months=3)


@query("map_new_stations", "s code_bss code_eh; f era5_latitude era5_longitude era5_distance_m",
       "SELECT * FROM mapping")
def map_new_stations(t):
    """Half the stations are mapped already; only the others are computed."""
    mapped = t.mapping.where("code_departement > '3'")
    return facts.build_int_station_era5_mapping(t.stations, t.grid_points, t.entities, mapped,
                                                distance=geo.haversine_m)


# ---- landed files ------------------------------------------------------------------

_EVENT = "l event_id; s event_type; f value; t ts"


def _landed(t, name: str):
    """Events as text, written with ';' and with ',', some types with line breaks and quotes.

    Each file begins with its header; one row of each kind repeats it.
    """
    folder = t.scratch(name)
    names = ["Event_ID", " Event_Type ", "VALUE", "ts"]
    odd = F.concat(F.col("event_type"), F.lit('\n"two"; and, \n\nfour'))
    rows = t("events").select(
        F.col("event_id").cast("string").alias(names[0]),
        F.when(F.col("event_id") % 7 == 0, odd).otherwise(F.col("event_type")).alias(names[1]),
        F.when(F.col("event_type") == "error", "").otherwise(F.col("value").cast("string"))
        .alias(names[2]), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(names[3]))
    early = F.col("ts") < "2024-01-15"
    again = t.spark.createDataFrame([tuple(names)], rows.schema)
    for part, sep in ((rows.where(early), ";"), (rows.where(~early), ",")):
        (part.union(again).write.mode("append").option("ignoreLeadingWhiteSpace", "false")
         .option("ignoreTrailingWhiteSpace", "false").option("emptyValue", "").option("escape", '"')
         .csv(folder, sep=sep, header=True))
    return folder


query("csv_payload_scan", _EVENT, """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN event_type || chr(10) || '"two"; and, ' || chr(10) || chr(10) || 'four'
       ELSE event_type END AS event_type, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, ts
FROM events
UNION ALL SELECT NULL, ' Event_Type ', NULL, NULL FROM range(2)""")(
    lambda t: files.coerce_numeric(
        files.read_payload_csv(t.spark, _landed(t, "payload")), {"event_id": "int", "value": "float"})
    .withColumn("ts", F.try_to_timestamp("ts")))


@query("presence_validation", "f latitude longitude total_precipitation; t time",
       "SELECT * FROM raw_rain")
def presence_validation(t):
    """A batch with its variables passes; one without a variable or without rows is refused."""
    rain = t("raw_rain")
    for bad in (rain.drop("total_precipitation"), rain.where("false")):
        try:
            files.require_grid_records(bad, ["time", "total_precipitation"])
        except ValueError:
            continue
        raise AssertionError("an unusable batch was accepted")
    return files.require_grid_records(rain, ["time", "latitude", "longitude", "total_precipitation"])


query("source_fallback", "s n_name; l n_nationkey", "SELECT n_name, n_nationkey FROM nation")(
    lambda t: files.first_nonempty(
        t.spark, None, t("nation").where("n_nationkey < 0"), lambda: t("nation"),
        t("region"), schema=t("nation").schema))


@query("seed_table", "s code_bss code_bss_nouveau; f longitude latitude dernier_ips; i derniere_classe;"
       " d derniere_date_calcul", """
SELECT CAST(o_orderkey AS VARCHAR) AS code_bss,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'N' || CAST(o_custkey AS VARCHAR) END AS code_bss_nouveau,
       o_totalprice / 1000 AS longitude, o_totalprice / 2000 AS latitude, o_totalprice / 3000 AS dernier_ips,
       o_orderkey % 5 AS derniere_classe, CAST(o_orderdate AS DATE) AS derniere_date_calcul FROM orders""")
def seed_table(t):
    """Orders written as a seed file with a header, then loaded with declared types."""
    folder = t.scratch("seed")
    price = F.col("o_totalprice").cast("double")
    (t("orders").select(
        F.col("o_orderkey").cast("string").alias("code_bss"),
        F.when(F.col("o_orderkey") % 7 != 0, F.concat(F.lit("N"), "o_custkey")).alias("code_bss_nouveau"),
        (price / 1000).alias("longitude"), (price / 2000).alias("latitude"),
        (F.col("o_orderkey") % 5).alias("derniere_classe"), (price / 3000).alias("dernier_ips"),
        F.to_date("o_orderdate").alias("derniere_date_calcul"))
     .write.csv(folder, header=True))
    return files.load_seed(t.spark, folder)


@query("entity_files", "s code_eh libelle_eh niveau_eh", """
SELECT CAST(s_suppkey AS VARCHAR) || 'AA' AS code_eh,
       CASE WHEN s_suppkey % 2 = 0 THEN 'Système ' || s_name END AS libelle_eh,
       CASE WHEN s_suppkey % 2 = 1 THEN CAST(s_nationkey AS VARCHAR) END AS niveau_eh FROM supplier""")
def entity_files(t):
    """One folder: Latin-1 files with semicolons and UTF-8 files with commas, headers spelled differently."""
    folder = t.scratch("entities")
    code = F.concat(F.col("s_suppkey").cast("string"), F.lit("AA"))
    even = F.col("s_suppkey") % 2 == 0
    (t("supplier").where(even).select(code.alias("Code entité"), F.concat(F.lit("Système "), "s_name")
                                      .alias("Libelle EH"))
     .write.mode("append").csv(folder, sep=";", header=True, encoding="ISO-8859-1"))
    (t("supplier").where(~even).select(code.alias("code_eh"), F.col("s_nationkey").alias("NiveauEH"),
                                       F.col("s_name").alias("other"))
     .write.mode("append").csv(folder, sep=",", header=True))
    return files.read_entity_csv(t.spark, folder)


def _checks():
    return [quality.Check("priced", severity="warn", bad=F.col("o_totalprice") < 20000),
            quality.Check("dated", severity="warn", bad=F.col("o_orderdate").isNull()),
            quality.Check("one_per_customer", lambda d: quality.unique(d, ["o_custkey"]), "warn")]


query("severity_report", "s name status; l failing", """
SELECT name, failing, CASE WHEN failing = 0 THEN 'pass' ELSE 'warn' END AS status FROM (
  SELECT 'priced' AS name, COUNT(*) FILTER (o_totalprice < 20000) AS failing FROM orders
  UNION ALL SELECT 'dated', COUNT(*) FILTER (o_orderdate IS NULL) FROM orders
  UNION ALL SELECT 'one_per_customer', COUNT(*) FROM (
    SELECT o_custkey FROM orders GROUP BY 1 HAVING COUNT(*) > 1) m) r""")(
    lambda t: t.spark.createDataFrame(
        [(r["check"], r["status"], r["failing"]) for r in quality.run_checks(t("orders"), _checks())],
        "name string, status string, failing bigint"))


@query("stored_failures", "l o_orderkey; f o_totalprice",
       "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 20000")
def stored_failures(t):
    folder = t.scratch("audit")
    quality.run_checks(t("orders"), _checks(), audit=folder)
    return t.spark.read.parquet(f"{folder}/priced")


@query("replace_table", "s code_bss; f x y", "SELECT * FROM stg_stations")
def replace_table(t):
    path = t.scratch("replace")
    tables.refresh_replace(t.stations.where("x > 0"), path)
    return tables.refresh_replace(t.stations, path)


@query("replace_year_partition", _DAILY, "SELECT * FROM daily_levels")
def replace_year_partition(t):
    path = t.scratch("years")
    off = t.daily_levels.withColumn("niveau_nappe_eau", F.when(
        F.year("date_mesure") == 1998, F.lit(0.0)).otherwise(F.col("niveau_nappe_eau")))
    tables.upsert_table(off, path, ["code_bss", "date_mesure"], "date_mesure")
    return tables.refresh_partition(t.daily_levels, path, "date_mesure", 1998, ["code_bss"])


def _stored_levels(t, name: str, rows=None):
    """A table of levels by year with undated rows in it."""
    path = t.scratch(name)
    rows = t.daily_levels if rows is None else rows
    tables.upsert_table(rows.unionByName(_undated(t.daily_levels, "date_mesure", "1999-03-03")), path,
                        ["code_bss", "date_mesure"], "date_mesure", ["code_bss"])
    return path


@query("replace_recent_partition", _DAILY, f"{_ALL_DAYS} UNION ALL {_UNDATED}")
def replace_recent_partition(t):
    path = _stored_levels(t, "recent", _stale(t.daily_levels, "date_mesure", "2001-09-15",
                                              "niveau_nappe_eau"))
    return tables.refresh_recent(t.daily_levels, path, "date_mesure", 120, AS_OF, ["code_bss"])


@query("replace_range_partition", _DAILY, f"""
{_ALL_DAYS} WHERE date_mesure NOT BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
UNION ALL {_ALL_DAYS} WHERE date_mesure BETWEEN DATE '1997-01-01' AND DATE '1997-06-30'
UNION ALL {_UNDATED}""")
def replace_range_partition(t):
    """The new batch only covers half of the range; the rest of the range empties."""
    path = _stored_levels(t, "range")
    return tables.refresh_range(t.daily_levels.where("date_mesure <= '1997-06-30'"), path,
                                "date_mesure", "1997-01-01", "1997-12-31")


@query("emptied_year_partition", _DAILY, f"""
{_ALL_DAYS} WHERE year(date_mesure) <> 1997 UNION ALL {_UNDATED}""")
def emptied_year_partition(t):
    path = _stored_levels(t, "emptied")
    return tables.refresh_range(t.daily_levels.where("date_mesure < '1990-01-01'"), path,
                                "date_mesure", "1997-01-01", "1997-12-31")


# ---- recomputed facts in partitioned tables -----------------------------------------

def _by_year(t, df, day: str, name: str) -> str:
    path = t.scratch(name)
    df.withColumn("year", F.year(day)).write.partitionBy("year").parquet(path)
    return path


@query("recent_fact_partition", _FACT, "SELECT * FROM fact_levels")
def recent_fact_partition(t):
    stale = t.pruned("fact_levels").withColumn("niveau_nappe_eau", F.when(
        F.col("date") >= F.date_sub(_day(AS_OF), 90), F.lit(-1.0)).otherwise(F.col("niveau_nappe_eau")))
    path = _by_year(t, stale, "date", "fact")
    return tables.recompute_recent_table(
        t.spark, path, "date", AS_OF, lambda cut: facts.build_piezo_daily_chroniques(
            t.daily_levels, t.mapping, t.weather, cut), days=90, sort=["code_bss"])


@query("recent_months_partition", MONTHLY_LEVELS, "SELECT * FROM monthly_levels")
def recent_months_partition(t):
    stale = t.monthly_levels.withColumn("niveau_moyen", F.when(
        F.col("mois") >= _day("2001-01-01"), F.lit(0.0)).otherwise(F.col("niveau_moyen")))
    return tables.recompute_months_table(
        _by_year(t, stale, "mois", "monthly"), facts.aggregate_monthly_chroniques,
        facts.roll_monthly_chroniques, t.pruned("fact_levels"), "date", "mois")


@query("active_stations_partition", YEARLY_LEVELS, "SELECT * FROM yearly_levels")
def active_stations_partition(t):
    active = joins.recent_keys(t.fact_levels, "code_bss", "date", AS_OF, 60)
    stale = t.yearly_levels.join(active.withColumn("_hit", F.lit(True)), "code_bss", "left")
    stale = stale.withColumn("amplitude_annuelle", F.when(
        F.col("_hit"), F.lit(-1.0)).otherwise(F.col("amplitude_annuelle"))).drop("_hit")
    path = t.scratch("yearly")
    tables.with_key_part(stale, "code_bss", 8).write.partitionBy(tables.KEY_PART).parquet(path)
    return tables.recompute_active_table(path, facts.build_fct_yearly_stats, t.monthly_levels, active,
                                         "code_bss", parts=8)


@query("recent_grid_partition", "f era5_latitude era5_longitude precipitation_totale etp_totale; d mois;"
       " l nb_jours", "SELECT * FROM monthly_grid")
def recent_grid_partition(t):
    stale = t.monthly_grid.where("mois < '2001-10-01'").withColumn("etp_totale", F.when(
        F.col("mois") >= _day("2001-08-01"), F.lit(0.0)).otherwise(F.col("etp_totale")))
    return tables.recompute_recent_table(
        t.spark, _by_year(t, stale, "mois", "grid"), "mois", AS_OF,
        lambda cut: climate.build_fct_era5_monthly_grid(t.rain, t.temps, cut), months=3)


@query("export_parquet", "s code_bss; f x y", "SELECT * FROM stg_stations")
def export_parquet(t):
    out = t.scratch("export")
    tables.export_tables({"stations": t.stations, "none": t.stations.where("false")}, out)
    return t.spark.read.parquet(f"{out}/stations")


@query("export_tsv", _DAILY, "SELECT * FROM daily_levels")
def export_tsv(t):
    out = t.scratch("export")
    tables.export_tables({"daily": t.daily_levels}, out, "tsv")
    return t.spark.read.csv(f"{out}/daily", sep="\t", header=True, schema=t.daily_levels.schema)


@query("read_batches", "s code_bss; d date_mesure; f niveau_nappe_eau", "SELECT * FROM daily_levels")
def read_batches(t):
    root = t.scratch("batches")
    cut = F.col("date_mesure") < _day("1998-01-01")
    t.daily_levels.where(cut).drop("profondeur_nappe").write.parquet(f"{root}/a")
    t.daily_levels.where(~cut).write.parquet(f"{root}/b")
    return files.read_batches(t.spark, [f"{root}/a", f"{root}/b"])


@query("backfill_run", "s partition status", """
SELECT CAST(year(o_orderdate) AS STRING) AS partition,
       CASE WHEN year(o_orderdate) = 1998 THEN 'failed' ELSE 'completed' END AS status
FROM orders GROUP BY 1, 2""")
def backfill_run(t):
    """One partition fails for good; a second run retries only that one."""
    ledger, out = t.scratch("ledger"), t.scratch("loads")
    years = [str(r[0]) for r in t("orders").select(F.year("o_orderdate")).distinct().collect()]

    def load(year: str) -> None:
        if year == "1998":
            raise RuntimeError("source is down")
        t("orders").where(F.year("o_orderdate") == int(year)).write.mode("error").parquet(f"{out}/{year}")

    tables.run_backfill(t.spark, "load", years, load, ledger, keep_going=True)
    tables.run_backfill(t.spark, "load", years, load, ledger, keep_going=True)
    return tables.read_ledger(t.spark, ledger).groupBy("partition").agg(
        F.max_by("status", "at").alias("status"))


# ---- streams -----------------------------------------------------------------------

@query("landed_file_stream", _EVENT, """
SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value, ts
FROM events""")
def landed_file_stream(t):
    """Two runs over a growing folder; each file is appended once, whatever the order of its columns."""
    folder, table, mark = t.scratch("landing"), t.scratch("bronze"), t.scratch("mark")
    rows = t("events").select(
        F.col("event_id").cast("string").alias("event_id"), "event_type",
        F.when(F.col("event_type") == "error", "").otherwise(F.col("value").cast("string"))
        .alias("value"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"))
    early = F.col("ts") < "2024-01-15"
    landings = ((rows.where(early), ";"), (rows.where(~early).select("ts", "value", "event_type", "event_id"), ","))
    for part, sep in landings:
        part.write.mode("append").option("emptyValue", "").csv(folder, sep=sep, header=True)
        landing.ingest_payloads(t.spark, folder, table, mark).awaitTermination()
    stored = tables.read_table(t.spark, table)
    return files.coerce_numeric(stored, {"event_id": "int", "value": "float"}).withColumn(
        "ts", F.to_timestamp("ts"))


_BEST = top1("SELECT user_id, CAST(ts AS DATE) AS day, value, event_id FROM events",
             "user_id, day", "value DESC, event_id", "user_id, day, value, event_id")


def _events(t):
    return t("events").select("user_id", F.to_date("ts").alias("day"), "value", "event_id")


def _landings(t, *parts):
    """Land each part in turn and give the stream over the folder so far, one run per landing."""
    folder = t.scratch("landed")
    for part in parts:
        part.write.mode("append").parquet(folder)
        yield t.spark.readStream.schema(parts[0].schema).parquet(folder)


@query("stream_keep_best", "l user_id event_id; d day; f value", _BEST)
def stream_keep_best(t):
    """Corrections replace stored rows: the second landing repeats all keys with final values."""
    rows = _events(t)
    first = rows.withColumn("value", F.col("value") - 1000)
    table, mark = t.scratch("upsert"), t.scratch("mark")
    for stream in _landings(t, first, rows):
        landing.stream_upsert(stream, table, mark, ["user_id", "day"],
                              [("value", "desc"), ("event_id", "asc")], "day", horizon=60
                              ).awaitTermination()
    return tables.read_table(t.spark, table)


@query("stream_late_rows", "l user_id event_id; d day; s rejection_reason", """
SELECT user_id, event_id, CAST(ts AS DATE) AS day, 'LATE' AS rejection_reason FROM events
WHERE CAST(ts AS DATE) < (SELECT MAX(CAST(ts AS DATE)) FROM events WHERE ts >= TIMESTAMP '2024-01-20')
  - INTERVAL 12 DAY AND ts < TIMESTAMP '2024-01-20'""")
def stream_late_rows(t):
    """The end of the month lands first; rows more than 12 days older go to the rejects."""
    rows, cut = _events(t), _day("2024-01-20")
    table, rejects, mark = t.scratch("upsert"), t.scratch("late"), t.scratch("mark")
    for stream in _landings(t, rows.where(F.col("day") >= cut), rows.where(F.col("day") < cut)):
        landing.stream_upsert(stream, table, mark, ["user_id", "day"],
                              [("value", "desc"), ("event_id", "asc")], "day", horizon=12,
                              rejects=rejects).awaitTermination()
    return t.spark.read.parquet(rejects)


@query("stream_hourly_to_daily", "d time; f latitude longitude t2m_mean t2m_min t2m_max", f"""
SELECT CAST(time AS DATE) AS time, {SNAP_LAT} AS latitude, {SNAP_LON} AS longitude,
       AVG(c) AS t2m_mean, MIN(c) AS t2m_min, MAX(c) AS t2m_max
FROM (SELECT *, CASE WHEN isnan(t2m) THEN NULL ELSE t2m - 273.15 END AS c FROM hourly) h
WHERE CAST(time AS DATE) < CAST((SELECT MAX(time) FROM hourly) - INTERVAL 1 DAY AS DATE)
GROUP BY 1, 2, 3 HAVING AVG(c) IS NOT NULL""")
def stream_hourly_to_daily(t):
    """Closed days equal the batch; the days the watermark has not passed stay open."""
    rows = t("hourly")
    half = F.col("time") < F.lit("2024-01-16").cast("timestamp")
    table, mark = t.scratch("daily"), t.scratch("mark")
    for stream in _landings(t, rows.where(half), rows.where(~half)):
        daily = landing.stream_hourly_to_daily(stream, digits=8)
        landing.ingest_stream(daily, table, mark).awaitTermination()
    return t.spark.read.parquet(table)



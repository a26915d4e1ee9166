"""Gold tables of the climate grid and of the standardized indices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rivulet.functions.calendar import days_in_month, month_start
from rivulet.functions.clean import snap, within_sentinels
from rivulet.functions.climate import (extraterrestrial_radiation, gamma_moments, hargreaves_et0)
from rivulet.operators import indices
from rivulet.operators.dedup import first_per_key
from rivulet.operators.indices import CELL, WINDOWS
from rivulet.operators.joins import attach_normals, left_align
from rivulet.operators.refresh import upsert
from rivulet.operators.reshape import tag_union, unpivot_windows
from rivulet.operators.summaries import positive_moments, valid_stats
from rivulet.sources.tables import exists, upsert_table


def _daily(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    rows = df.select(snap("latitude").alias("latitude"), snap("longitude").alias("longitude"),
                     F.to_date("time").alias("jour"), "created_at", *measures)
    return first_per_key(rows, ["latitude", "longitude", "jour"],
                         [("created_at", "desc")]).drop("created_at")


def build_fct_era5_monthly_grid(timeseries: DataFrame, temps: DataFrame,
                                since=None) -> DataFrame:
    """Monthly cell summary: rain drives, temperature and ET0 join by cell and day.

    ``since`` (a date column) bounds both sources for a partial recompute. The
    two deduplications and the join share (latitude, longitude, jour), so each
    source is shuffled once.
    """
    if since is not None:
        timeseries = timeseries.where(F.col("time") >= since)
        temps = temps.where(F.col("time") >= since)
    rain = _daily(timeseries, ["total_precipitation", "potential_evaporation"])
    warm = _daily(temps, ["t2m_mean", "t2m_min", "t2m_max"])
    joined = left_align(rain, warm, ["latitude", "longitude", "jour"])
    radiated = joined.withColumn(
        "_ra", extraterrestrial_radiation("latitude", F.dayofyear("jour")))
    daily = radiated.withColumn("_et0", hargreaves_et0("_ra", "t2m_mean", "t2m_min", "t2m_max"))
    grouped = daily.groupBy(F.col("latitude").alias("era5_latitude"),
                            F.col("longitude").alias("era5_longitude"),
                            month_start("jour").alias("mois")).agg(
        F.avg("t2m_mean").alias("temperature_moyenne"),
        F.min("t2m_min").alias("temperature_min"), F.max("t2m_max").alias("temperature_max"),
        F.sum("total_precipitation").alias("precipitation_totale"),
        F.sum("_et0").alias("etp_totale"),
        F.sum(-F.col("potential_evaporation")).alias("etp_pev_era5"),
        F.count(F.lit(1)).alias("nb_jours"), F.count("t2m_mean").alias("nb_jours_temp"))
    full = days_in_month("mois")
    return grouped.select(
        *CELL, "mois", "temperature_moyenne", "temperature_min", "temperature_max",
        "precipitation_totale", "etp_totale",
        (F.col("precipitation_totale") - F.col("etp_totale")).alias("bilan_hydrique"),
        "etp_pev_era5", "nb_jours", (F.col("nb_jours") == full).alias("mois_complet"),
        "nb_jours_temp", (F.col("nb_jours_temp") == full).alias("temp_complet"))


def build_fct_era5_climatology_grid(monthly: DataFrame, start: str = "1991-01-01",
                                    end: str = "2021-01-01", warmup: int = 12,
                                    windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Normals per cell, calendar month and window. One shuffle, by cell."""
    base = indices.month_window(monthly, start, end, warmup).select(
        *CELL, "mois", "precipitation_totale", "temperature_moyenne", "temp_complet")
    rolled = indices.roll_wide(base, start, windows, sums=["precipitation_totale"],
                               means_if=[("temperature_moyenne", "temp_complet")])
    # a temperature counts only when every month of its window is complete
    checked = rolled.withColumns({
        f"_temp_{w}": F.when(F.col(f"n_temp_complet_{w}") == w, F.col(f"temperature_moyenne_{w}"))
        for w in windows})
    samples = unpivot_windows(checked, [*CELL, F.month("mois").alias("mois_calendaire")], windows,
                              {"_rain": "precipitation_totale", "_temp": "_temp"})
    stats = samples.groupBy(*CELL, "mois_calendaire", "fenetre").agg(
        F.count(F.lit(1)).alias("nb_annees"), F.avg("_rain").alias("precip_moyenne"),
        F.stddev_samp("_rain").alias("precip_stddev"), *positive_moments("_rain"),
        *valid_stats("_temp", "nb_annees_temp", "temp_moyenne", "temp_stddev"))
    alpha, beta = gamma_moments("mean_pos", "var_pos")
    return stats.select(
        *CELL, "mois_calendaire", "fenetre", "nb_annees", "precip_moyenne", "precip_stddev",
        F.col("p_zero").alias("prob_zero"), alpha.alias("gamma_alpha"), beta.alias("gamma_beta"),
        "nb_annees_temp", "temp_moyenne", "temp_stddev")


def fit_spei_reference(monthly: DataFrame, start: str = "1991-01-01", end: str = "2021-01-01",
                       warmup: int = 12, windows: Sequence[int] = WINDOWS,
                       min_years: int = indices.MIN_YEARS_REF) -> DataFrame:
    """GLO fit of every cell, calendar month and window, with the reject reason."""
    base = indices.month_window(monthly, start, end, warmup).select(*CELL, "mois", "bilan_hydrique")
    samples = indices.roll_long(base, start, {"bilan_cumul": "bilan_hydrique"}, windows,
                                sums=["bilan_hydrique"])
    samples = samples.withColumn("mois_calendaire", F.month("mois"))
    return indices.fit_reference(samples, [*CELL, "mois_calendaire", "fenetre"], "bilan_cumul",
                                 min_years)


def build_fct_era5_spei_climatology_grid(monthly: DataFrame, **params) -> DataFrame:
    fits = fit_spei_reference(monthly, **params)
    return fits.where("reason is null").select(
        *CELL, "mois_calendaire", "fenetre", "glo_alpha", "glo_k", "glo_xi",
        F.col("n").cast("int").alias("nb_annees"), F.current_timestamp().alias("computed_at"))


INDEX_KEYS = [*CELL, "month", "fenetre"]


def _scored(monthly: DataFrame, normals: DataFrame, spei_params: DataFrame, as_of: str,
            months: int | None, start: str, min_years: int) -> DataFrame:
    """All months from ``start``, or the last ``months`` before the month of ``as_of``."""
    if months is not None:
        total = int(as_of[:4]) * 12 + int(as_of[5:7]) - 1 - months
        start = f"{total // 12:04d}-{total % 12 + 1:02d}-01"
    scored = indices.grid_indices(monthly, attach_normals(normals, spei_params), start,
                                  as_of[:7] + "-01", min_years=min_years)
    return scored.withColumn("computed_at", F.current_timestamp())


def build_fct_era5_indices_grid(monthly: DataFrame, normals: DataFrame,
                                spei_params: DataFrame, as_of: str,
                                target: DataFrame | None = None, months: int = 3,
                                start: str = "1950-01-01",
                                min_years: int = indices.MIN_YEARS_REF) -> DataFrame:
    """Full history without a target; with one, the last months are rescored and upserted."""
    fresh = _scored(monthly, normals, spei_params, as_of, None if target is None else months,
                    start, min_years)
    return fresh if target is None else upsert(target, fresh, INDEX_KEYS)


def store_fct_era5_indices_grid(path: str, monthly: DataFrame, normals: DataFrame,
                                spei_params: DataFrame, as_of: str, months: int = 3,
                                start: str = "1950-01-01",
                                min_years: int = indices.MIN_YEARS_REF) -> DataFrame:
    """The nightly job on a table partitioned by year: only the years of the last months
    are rewritten. The first run stores the whole history."""
    first = not exists(monthly.sparkSession, path)
    fresh = _scored(monthly, normals, spei_params, as_of, None if first else months, start,
                    min_years)
    return upsert_table(fresh, path, INDEX_KEYS, "month", sort=CELL)


# ---- station indices ---------------------------------------------------------

def _clean_series(df: DataFrame, code: str, value: str, ties: str | None) -> DataFrame:
    kept = df.where(F.col(value).isNotNull() & within_sentinels(value))
    extra = [F.col(ties).alias("_tie")] if ties else [F.lit("").alias("_tie")]
    return kept.select(F.col(code).alias("code"), F.col("mois"),
                       F.col(value).cast("double").alias("val"), *extra)


def station_series(piezo: DataFrame, hydro: DataFrame) -> dict[str, DataFrame]:
    """Monthly values per domain. Rivers keep all quantities of a station in one series."""
    return {"piezo": _clean_series(piezo, "code_bss", "niveau_moyen", None),
            "hydro": _clean_series(hydro, "code_station", "resultat_moyen",
                                   "grandeur_hydro_elab")}


INDEX_NAMES = {"piezo": "IPS", "hydro": "SSFI"}
POSITIVE_ONLY = {"piezo": False, "hydro": True}


def reference_grids(series: dict[str, DataFrame], **params) -> dict[str, DataFrame]:
    return {kind: indices.reference_grid(df, "code", "mois", "val",
                                         positive_only=POSITIVE_ONLY[kind], **params)
            for kind, df in series.items()}


def build_station_reference_stats(grids: dict[str, DataFrame]) -> DataFrame:
    tagged = tag_union(grids)
    return tagged.select("type", "code", "month", "quantile_grid", "baseline_start",
                         "baseline_end", "flag", "n_years",
                         F.current_timestamp().alias("computed_at"))


def build_fct_monthly_index(series: dict[str, DataFrame], grids: dict[str, DataFrame]
                            ) -> DataFrame:
    """All months scored against the fixed grid; one row per type, code and month."""
    scored = tag_union({k: indices.score_series(series[k], grids[k], "code", "mois", "val")
                        for k in series})
    single = first_per_key(scored, ["type", "code", "mois"], [("_tie", "asc")], ties=["val"])
    return single.select("type", "code", F.col("mois").alias("month"), "z", "index_class", "flag",
                         F.current_timestamp().alias("computed_at"))


def build_station_current_index(series: dict[str, DataFrame], grids: dict[str, DataFrame]
                                ) -> DataFrame:
    """The last month of each station. A last value <= 0 is scored too."""
    parts = {}
    for kind, df in series.items():
        last = first_per_key(df, ["code"], [("mois", "desc"), ("_tie", "desc")], ties=["val"])
        scored = indices.score_series(last, grids[kind], "code", "mois", "val")
        parts[kind] = scored.withColumn("index_name", F.lit(INDEX_NAMES[kind]))
    return tag_union(parts).select(
        "code", "type", "index_name", F.col("z").alias("index_value"), "index_class",
        F.col("mois").alias("ref_month"), "baseline_start", "baseline_end",
        F.current_timestamp().alias("computed_at"))

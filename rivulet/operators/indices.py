"""Standardized drought indices on station series and on climate grids."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.functions import stats
from rivulet.functions.classes import classify
from rivulet.functions.geo import let
from rivulet.operators.dedup import first_per_key
from rivulet.operators.reshape import calendar_template, unpivot_windows
from rivulet.operators.summaries import percentile_vector
from rivulet.operators.windows import rolled_columns

WINDOWS = (1, 3, 6, 12)
CELL = ("era5_latitude", "era5_longitude")
MIN_YEARS_REF = 25
MIN_FIT_SAMPLES = 4
REFERENCE_PERIOD = (1991, 2020)
MIN_YEARS = 15
MIN_PER_MONTH = 10
MIN_MONTHS = 60


# ---- generalized logistic law ------------------------------------------------

def fit_glo(samples: DataFrame, keys: Sequence[str], value: str,
            min_samples: int = MIN_FIT_SAMPLES) -> DataFrame:
    """L-moment fit per group: glo_alpha, glo_k, glo_xi, reason, n.

    Plotting positions need the rank inside the group. A group is one cell,
    calendar month and window, so it holds one value per reference year.
    Gamma(1+k)Gamma(1-k) = k*pi / sin(k*pi) removes the gamma function.
    """
    keys = list(keys)
    x = F.col(value).cast("double")
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    clean = samples.select(*keys, F.when(finite, x).alias("_x"))
    group = Window.partitionBy(*keys)
    ranked = clean.withColumns({
        "_i": F.row_number().over(group.orderBy(F.col("_x").asc_nulls_last())),
        "_n": F.count("_x").over(group.orderBy(F.col("_x").asc_nulls_last()).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))})
    below = 1 - (F.col("_i") - 0.35) / F.col("_n")
    moments = ranked.groupBy(*keys).agg(
        F.count("_x").alias("n"), F.avg("_x").alias("_w0"),
        F.avg(F.when(F.col("_n") > 0, below * F.col("_x"))).alias("_w1"),
        F.avg(F.when(F.col("_n") > 0, below * below * F.col("_x"))).alias("_w2"))
    lam2 = F.col("_w0") - 2 * F.col("_w1")
    lam3 = F.col("_w0") - 6 * F.col("_w1") + 6 * F.col("_w2")
    shaped = moments.withColumn("_l2", lam2).withColumn(
        "_k", F.when(F.col("_l2") > 0, -lam3 / F.when(F.col("_l2") > 0, F.col("_l2"))))
    flat = F.abs("_k") < stats.NEAR_ZERO_K
    turn = F.when(~flat & (F.abs("_k") < 1), F.col("_k") * math.pi)
    alpha = F.when(flat, F.col("_l2")).otherwise(F.col("_l2") * F.sin(turn) / turn)
    fitted = shaped.withColumn("_a", alpha)
    xi = F.when(flat, F.col("_w0")).otherwise(
        F.col("_w0") - F.col("_a") * (math.pi / turn - math.pi / F.sin(turn)))
    reason = (F.when(F.col("n") < min_samples, F.lit("n_insuffisant"))
              .when(F.col("_l2").isNull() | (F.col("_l2") <= 0), F.lit("l2_degenere"))
              .when(F.col("_k").isNull() | (F.abs("_k") >= 1), F.lit("k_hors_domaine"))
              .when(F.col("_a").isNull() | F.isnan("_a") | (F.col("_a") <= 0),
                    F.lit("alpha_invalide")))
    full = fitted.withColumn("_xi", xi).withColumn("reason", reason)
    ok = F.col("reason").isNull()
    return full.select(*keys, F.when(ok, F.col("_a")).alias("glo_alpha"),
                       F.when(ok, F.col("_k")).alias("glo_k"),
                       F.when(ok, F.col("_xi")).alias("glo_xi"), "reason", "n")


def fit_reference(samples: DataFrame, keys: Sequence[str], value: str,
                  min_years: int = MIN_YEARS_REF) -> DataFrame:
    """``fit_glo`` with a minimum sample, whose reason takes precedence."""
    fitted = fit_glo(samples, keys, value)
    thin = F.col("n") < min_years
    return fitted.select(
        *keys, *[F.when(~thin, F.col(c)).alias(c) for c in ("glo_alpha", "glo_k", "glo_xi")],
        F.when(thin, F.lit("n_annees_insuffisant")).otherwise(F.col("reason")).alias("reason"),
        "n")


def coverage_report(fits: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Groups per outcome and their share of all groups, in percent."""
    counts = fits.groupBy(*by, F.coalesce("reason", F.lit("ok")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("n_groups"))
    total = F.sum("n_groups").over(Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1)))
    return counts.withColumn("pct", F.round(100.0 * F.col("n_groups") / total, 1))


# ---- gridded SPI, STI, SPEI --------------------------------------------------

def month_window(monthly: DataFrame, start: str, end: str, warmup: int) -> DataFrame:
    """Complete months of [start, end) and ``warmup`` months before."""
    first = F.add_months(F.lit(start).cast("date"), -warmup)
    return monthly.where(F.col("mois_complet") & (F.col("mois") >= first)
                         & (F.col("mois") < F.lit(end).cast("date")))


def roll_wide(base: DataFrame, start: str, windows: Sequence[int] = WINDOWS,
              own_warmup: bool = False, **measures) -> DataFrame:
    """All window lengths side by side: one shuffle by cell, one sort.

    With ``own_warmup`` a window of w months may only use the w - 1 months
    before ``start``, although longer windows read further back.
    """
    wide: dict[str, Column] = {}
    for w in windows:
        since = F.add_months(F.lit(start).cast("date"), 1 - w) if own_warmup else None
        wide |= rolled_columns(CELL, "mois", w, since=since, **measures)
    return base.withColumns(wide).where(F.col("mois") >= F.lit(start).cast("date"))


def roll_long(base: DataFrame, start: str, columns: dict[str, str],
              windows: Sequence[int] = WINDOWS, **measures) -> DataFrame:
    """One row per cell, month and full window; still partitioned by cell."""
    rolled = roll_wide(base, start, windows, **measures)
    return unpivot_windows(rolled, [*CELL, "mois"], windows, columns)


PARAMETERS = ("nb_annees", "gamma_alpha", "gamma_beta", "prob_zero", "temp_moyenne",
              "temp_stddev", "glo_alpha", "glo_k", "glo_xi")


def pack_parameters(params: DataFrame) -> DataFrame:
    """One row per cell: map from calendar month and window to its parameters (12 x windows)."""
    slot = F.col("mois_calendaire") * 100 + F.col("fenetre")
    entry = F.struct(slot.cast("int"), F.struct(*PARAMETERS))
    return params.groupBy(*CELL).agg(F.map_from_entries(F.collect_list(entry)).alias("_params"))


def grid_indices(monthly: DataFrame, params: DataFrame, start: str, end: str,
                 windows: Sequence[int] = WINDOWS, min_years: int = MIN_YEARS_REF) -> DataFrame:
    """SPI, STI and SPEI per cell, month and window in [start, end).

    ``params`` (normals with the SPEI parameters attached) is packed to one row
    per cell and joined on the cell before the windows are unpivoted: the
    rolling windows are already partitioned by cell, so the four-fold rows are
    never shuffled. Combinations without parameters give no row; indices of a
    reference shorter than ``min_years`` are NULL.
    """
    base = month_window(monthly, start, end, max(windows) - 1)
    rolled = roll_wide(base, start, windows, own_warmup=True,
                       sums=["precipitation_totale", "bilan_hydrique"],
                       means=["temperature_moyenne"])
    joined = rolled.join(pack_parameters(params), list(CELL))
    rows = unpivot_windows(
        joined, [*CELL, "mois", "_params"], windows,
        {"_rain": "precipitation_totale", "_balance": "bilan_hydrique",
         "_temp": "temperature_moyenne"})
    slot = (F.month("mois") * 100 + F.col("fenetre")).cast("int")
    found = rows.withColumn("p", F.try_element_at("_params", slot)).where(F.col("p").isNotNull())
    enough = F.col("p.nb_annees") >= min_years
    probed = found.select(
        *CELL, F.col("mois").alias("month"), F.col("fenetre").cast("smallint").alias("fenetre"),
        F.when(enough, stats.spi_probability("_rain", "p.gamma_alpha", "p.gamma_beta",
                                             "p.prob_zero")).alias("_p_spi"),
        F.when(enough, stats.sti("_temp", "p.temp_moyenne", "p.temp_stddev")).alias("sti"),
        F.when(enough, stats.spei_probability("_balance", "p.glo_alpha", "p.glo_k", "p.glo_xi"))
        .alias("_p_spei"))
    return probed.select(*CELL, "month", "fenetre",
                         F.bround(stats.norm_ppf("_p_spi"), 3).alias("spi"), "sti",
                         F.bround(stats.norm_ppf("_p_spei"), 3).alias("spei"))


# ---- station reference grid --------------------------------------------------

def reference_window(df: DataFrame, key: str, month: str,
                     period: tuple[int, int] = REFERENCE_PERIOD,
                     min_years: int = MIN_YEARS) -> DataFrame:
    """Baseline per station: normale, else adaptee, else provisoire.

    One row per (station, year) carries everything: years inside the fixed
    period, the decades whose 30-year window covers the year, and the bounds of
    the record.
    """
    lo, hi = period
    years = df.groupBy(key, F.year(month).alias("_y")).agg(
        F.min(month).alias("_first"), F.max(month).alias("_last"))
    record = years.groupBy(key).agg(
        F.count(F.lit(1)).alias("_all"), F.min("_first").alias("_first"),
        F.max("_last").alias("_last"), F.min("_y").alias("_y0"), F.max("_y").alias("_y1"),
        F.count(F.when(F.col("_y").between(lo, hi), F.lit(1))).alias("_in"))
    decade = F.floor(F.col("_y") / 10) * 10
    starts = years.select(key, "_y", F.explode(F.sequence(decade - 20, decade, F.lit(10)))
                          .alias("_s"))
    counted = starts.groupBy(key, "_s").agg(F.count(F.lit(1)).alias("_ny"))
    # candidate windows start in a decade of the record itself
    bounded = counted.join(record.select(key, "_y0", "_y1"), key).where(
        F.col("_s").between(F.floor(F.col("_y0") / 10) * 10, F.floor(F.col("_y1") / 10) * 10)
        & (F.col("_ny") >= min_years))
    best = bounded.groupBy(key).agg(
        F.min(F.struct((-F.col("_ny")).alias("neg"), "_s")).alias("_best"))
    chosen = record.join(best, key, "left")
    normal = F.col("_in") >= min_years
    adapted = F.col("_best").isNotNull()
    jan, dec = lo, hi

    def day(year: Column, suffix: str) -> Column:
        return F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit(suffix)).cast("date")

    start = F.col("_best._s")
    return chosen.select(
        key,
        F.when(normal, F.lit(f"{jan:04d}-01-01").cast("date")).when(adapted, day(start, "-01-01"))
        .otherwise(F.col("_first")).alias("baseline_start"),
        F.when(normal, F.lit(f"{dec:04d}-12-31").cast("date"))
        .when(adapted, day(start + 29, "-12-31")).otherwise(F.col("_last")).alias("baseline_end"),
        F.when(normal, F.lit("normale")).when(adapted, F.lit("adaptee"))
        .otherwise(F.lit("provisoire")).alias("flag"),
        F.when(normal, F.col("_in")).when(adapted, -F.col("_best.neg"))
        .otherwise(F.col("_all")).cast("int").alias("n_years"))


def reference_grid(df: DataFrame, key: str, month: str, value: str,
                   period: tuple[int, int] = REFERENCE_PERIOD, min_years: int = MIN_YEARS,
                   min_per_month: int = MIN_PER_MONTH, positive_only: bool = False) -> DataFrame:
    """Twelve rows per station: percentile grid and its baseline.

    A calendar month with too few values borrows the grid of the nearest month
    on the circle that has enough (the lower month on a tie). A station without
    usable values keeps its twelve rows with NULL grids.
    """
    stations = df.select(key).distinct()
    values = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    if positive_only:
        values = values.where(F.col(value) > 0)
    values = values.select(key, month, F.col(value).cast("double").alias("_v"))
    window = reference_window(values, key, month, period, min_years)
    inside = values.join(window.select(key, "baseline_start", "baseline_end"), key).where(
        F.col(month).between(F.col("baseline_start"), F.col("baseline_end")))
    grids = (percentile_vector(inside.withColumn("_m", F.month(month)), [key, "_m"], "_v", most=None)
             .where(F.col("n") >= min_per_month))
    # at most 12 grids of 99 numbers per station
    own = grids.groupBy(key).agg(F.collect_list(F.struct("_m", "grid")).alias("_grids"))
    template = calendar_template(stations.join(window, key, "left").join(own, key, "left"))
    nearest = F.array_min(F.transform("_grids", lambda g: F.struct(
        F.least(F.abs(F.col("month") - g["_m"]), 12 - F.abs(F.col("month") - g["_m"])).alias("d"),
        g["_m"].alias("m"))))["m"]
    picked = F.filter("_grids", lambda g: g["_m"] == F.col("_near"))
    return (template.withColumn("_near", nearest)
            .select(key, "month", F.element_at(picked, 1)["grid"].alias("quantile_grid"),
                    "baseline_start", "baseline_end",
                    F.coalesce("flag", F.lit("provisoire")).alias("flag"),
                    F.coalesce("n_years", F.lit(0)).alias("n_years")))


def score_series(df: DataFrame, grid: DataFrame, key: str, month: str, value: str) -> DataFrame:
    """Every row of the series against its station's grid: z, class, baseline."""
    ref = grid.withColumnRenamed("month", "_cal")
    joined = df.withColumn("_cal", F.month(month)).join(ref, [key, "_cal"], "left")
    scored = joined.withColumn("_p", stats.grid_probability(value, "quantile_grid"))
    scored = scored.withColumn("z", F.bround(stats.norm_ppf("_p"), 3))
    return scored.withColumn("index_class", classify("z")).drop("_cal", "_p", "quantile_grid")


def last_rows(df: DataFrame, key: str, month: str, ties: Sequence[str] = ()) -> DataFrame:
    return first_per_key(df, [key], [(month, "desc"), *[(t, "desc") for t in ties]])


# ---- indices of the latest month from a fitted law ---------------------------

def _latest_group(df: DataFrame, key: str, month: str, value: str, min_months: int,
                  min_per_month: int) -> DataFrame:
    """Rows of the calendar month of each station's last row, with that last value.

    A station has one value per month, so its group has one value per year.
    """
    usable = df.where(F.col(value).isNotNull()).select(
        key, F.col(month).alias("_d"), F.col(value).cast("double").alias("_v"))
    last = usable.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.max("_d").alias("_last"),
                                   F.max_by("_v", "_d").alias("_x")).where(
        F.col("_n") >= min_months)
    rows = usable.join(last, key).where(F.month("_d") == F.month("_last"))
    sized = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_k"), F.avg("_v").alias("_mean"),
                                  F.stddev_samp("_v").alias("_sd"),
                                  F.avg(F.when(F.col("_v") > 0, F.log("_v"))).alias("_logmean"))
    return rows.join(sized.where(F.col("_k") >= min_per_month), key)


def latest_spli(df: DataFrame, key: str, month: str, value: str, min_months: int = MIN_MONTHS,
                min_per_month: int = MIN_PER_MONTH) -> DataFrame:
    """Gaussian-kernel index of the last month.

    The kernel CDF at x is the mean of Phi((x - x_i) / h) with Scott's
    bandwidth h = n^(-1/5) * sd; no numeric integration is needed.
    """
    rows = _latest_group(df, key, month, value, min_months, min_per_month)
    h = F.col("_sd") * F.pow(F.col("_k").cast("double"), F.lit(-0.2))
    near = rows.withColumn("_u", (F.col("_x") - F.col("_v")) / F.nullif(h, F.lit(0.0)))
    cdf = (near.withColumn("_phi", stats.norm_cdf("_u")).groupBy(key)
           .agg(stats.clip_probability(F.avg("_phi")).alias("_p")))
    return _with_unknown(df, cdf, key)


def latest_ssfi(df: DataFrame, key: str, month: str, value: str, min_months: int = MIN_MONTHS,
                min_per_month: int = MIN_PER_MONTH, rounds: int = 8) -> DataFrame:
    """Gamma (maximum likelihood, location 0) index of the last positive month."""
    rows = _latest_group(df.where(F.col(value) > 0), key, month, value, min_months, min_per_month)
    group = rows.groupBy(key).agg(F.first("_x").alias("_x"), F.first("_mean").alias("_mean"),
                                  F.first("_logmean").alias("_logmean"))
    s = F.log("_mean") - F.col("_logmean")
    fitted = group.withColumn("_s", s).withColumn("_a", F.when(F.col("_s") > 0, _gamma_shape(
        F.when(F.col("_s") > 0, F.col("_s")), rounds)))
    cdf = fitted.select(key, stats.clip_probability(
        stats.gamma_cdf("_x", "_a", F.col("_mean") / F.col("_a"))).alias("_p"))
    return _with_unknown(df, cdf, key)


def _gamma_shape(s: Column, rounds: int) -> Column:
    """Solve ln(a) - digamma(a) = s by Newton steps from a closed-form start."""
    start = (3 - s + F.sqrt((s - 3) * (s - 3) + 24 * s)) / (12 * s)

    def psi(a: Column) -> tuple[Column, Column]:
        """digamma and trigamma, moved to a + 8 where the asymptotic series is exact."""
        b = a + 8
        i2 = 1 / (b * b)
        tail = F.log(b) - 1 / (2 * b) - i2 * (1 / 12 - i2 * (1 / 120 - i2 * (1 / 252 - i2 / 240)))
        tail1 = 1 / b + i2 / 2 + i2 / b * (1 / 6 - i2 * (1 / 30 - i2 * (1 / 42 - i2 / 30)))
        for j in range(8):
            tail = tail - 1 / (a + j)
            tail1 = tail1 + 1 / ((a + j) * (a + j))
        return tail, tail1

    def step(a: Column) -> Column:
        digamma, trigamma = psi(a)
        moved = a - (F.log(a) - digamma - s) / (1 / a - trigamma)
        return F.greatest(moved, a / 10)

    return let(start, lambda a0: F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)), a0, lambda a, _i: step(a)))


def _with_unknown(df: DataFrame, cdf: DataFrame, key: str) -> DataFrame:
    scored = df.select(key).distinct().join(cdf, key, "left")
    scored = scored.withColumn("z", F.bround(stats.norm_ppf("_p"), 3))
    return scored.select(key, "z", classify("z").alias("index_class"))

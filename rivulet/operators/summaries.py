"""Group summaries. Every aggregate here combines map-side before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rivulet.functions.calendar import days_in_month, epoch_seconds, month_start
from rivulet.functions.clean import nan_to_null, snap
from rivulet.operators.reshape import union_all
from rivulet.sources.tables import settle

PERCENTS = [p / 100 for p in range(1, 100)]


def daily_mean(df: DataFrame, keys: Sequence[str], day: str, values: Sequence[str],
               with_count: str | None = None) -> DataFrame:
    aggs = [F.avg(v).alias(v) for v in values]
    if with_count:
        aggs.append(F.count(F.lit(1)).cast("int").alias(with_count))
    return df.groupBy(*keys, day).agg(*aggs)


def hourly_to_daily(df: DataFrame, time: str = "time", kelvin: str = "t2m", digits: int = 2,
                    lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Kelvin readings to daily mean, minimum and maximum in Celsius per 0.1 degree cell.

    NaN counts as missing; a cell-day without any value (sea) gives no row.
    """
    celsius = nan_to_null(F.col(kelvin).cast("double")) - 273.15
    readings = df.select(F.to_date(time).alias("time"), snap(lat).alias("latitude"),
                         snap(lon).alias("longitude"), celsius.alias("_t"))
    return (readings.groupBy("time", "latitude", "longitude")
            .agg(F.bround(F.avg("_t"), digits).alias("t2m_mean"),
                 F.bround(F.min("_t"), digits).alias("t2m_min"),
                 F.bround(F.max("_t"), digits).alias("t2m_max"))
            .where(F.col("t2m_mean").isNotNull()))


def monthly_summary(df: DataFrame, keys: Sequence[str], day: str, month: str,
                    spec: Mapping[str, Column]) -> DataFrame:
    """``spec`` maps output names to aggregate expressions over one month."""
    return (df.groupBy(*keys, month_start(day).alias(month))
            .agg(*[expr.alias(name) for name, expr in spec.items()]))


def yearly_summary(monthly: DataFrame, keys: Sequence[str], month: str, year: str,
                   spec: Mapping[str, Column]) -> DataFrame:
    return (monthly.groupBy(*keys, F.year(month).alias(year))
            .agg(*[expr.alias(name) for name, expr in spec.items()]))


def spread(value: str, prefix: str, amplitude: str, deviation: str) -> dict[str, Column]:
    """Mean, minimum, maximum, amplitude and sample deviation of one measure."""
    return {
        f"{prefix}_moyen": F.avg(value), f"{prefix}_min": F.min(value),
        f"{prefix}_max": F.max(value), amplitude: F.max(value) - F.min(value),
        deviation: F.stddev_samp(value),
    }


def annual_balance(rain: str, evaporation: str, month: str) -> Column:
    """Total rain minus mean daily evaporation weighted by calendar days."""
    return F.sum(rain) - F.sum(F.col(evaporation) * days_in_month(month))


def coverage(df: DataFrame, key: Sequence[str] | str, day: str, first: str = "premiere_mesure",
             last: str = "derniere_mesure") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.min(day).alias(first), F.max(day).alias(last))


def lifetime_stats(monthly: DataFrame, keys: Sequence[str], spec: Mapping[str, Column]
                   ) -> DataFrame:
    return monthly.groupBy(*keys).agg(*[expr.alias(name) for name, expr in spec.items()])


def min_count(df: DataFrame, n: str, at_least: int) -> DataFrame:
    """HAVING count >= at_least."""
    return df.where(F.col(n) >= at_least)


def linear_trend(df: DataFrame, key: Sequence[str] | str, month: str, value: str, since: Column,
                 prefix: str = "", with_n: str | None = None,
                 extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Slope (units per second), intercept and R2 of a value on the epoch."""
    keys = [key] if isinstance(key, str) else list(key)
    x = epoch_seconds(month).cast("double")
    aggs = [F.regr_slope(F.col(value), x).alias(f"slope{prefix}"),
            F.regr_intercept(F.col(value), x).alias(f"intercept{prefix}"),
            F.regr_r2(F.col(value), x).alias(f"r2{prefix}")]
    if with_n:
        aggs.append(F.count(F.lit(1)).alias(with_n))
    aggs += [expr.alias(name) for name, expr in (extra or {}).items()]
    return df.where(F.col(month) >= since).groupBy(*keys).agg(*aggs)


def positive_moments(x: str, prefix: str = "") -> list[Column]:
    """Mean and variance of the positive values, share of the others."""
    value = F.col(x)
    positive = F.when(value > 0, value)
    return [F.avg(positive).alias(f"{prefix}mean_pos"), F.var_samp(positive).alias(f"{prefix}var_pos"),
            F.avg((value <= 0).cast("double")).alias(f"{prefix}p_zero")]


def valid_stats(x: str, n: str, mean: str, sd: str) -> list[Column]:
    return [F.count(x).alias(n), F.avg(x).alias(mean), F.stddev_samp(x).alias(sd)]


def geography(*frames: DataFrame) -> DataFrame:
    """One label per (commune, département), the largest one; NULL codes group together."""
    labels = ["nom_commune", "nom_departement", "code_region", "nom_region"]
    both = union_all(*frames, fill_missing=True)
    return (both.where(F.col("code_departement").isNotNull())
            .groupBy("code_commune", "code_departement")
            .agg(*[F.max(c).alias(c) for c in labels]))


def coverage_by(df: DataFrame, group: Sequence[str], station: str, day: str) -> DataFrame:
    return df.groupBy(*group).agg(
        F.countDistinct(station).alias("n_stations"), F.count(F.lit(1)).alias("n_rows"),
        F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def reject_volume(rejects: DataFrame, reason: str = "rejection_reason") -> DataFrame:
    return rejects.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))


def fill_rate(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Percentage of non-NULL values, one decimal."""
    total = F.count(F.lit(1))
    return df.agg(*[F.round(F.try_divide(100.0 * F.count(c), total), 1).alias(c) for c in cols])


def median_nonzero(df: DataFrame, n: str, by: Sequence[str] = ()) -> DataFrame:
    return (df.where(F.col(n) > 0).groupBy(*by)
            .agg(F.percentile(F.col(n), F.lit(0.5)).alias("median")))


def percentile_vector(df: DataFrame, keys: Sequence[str], value: str,
                      probs: Sequence[float] = PERCENTS, name: str = "grid",
                      most: int | None = 100_000) -> DataFrame:
    """Exact percentiles by linear interpolation, plus the sample size ``n``.

    Groups of up to ``most`` values are sorted as one array. In larger ones the wanted ranks
    are selected (``ranked_values``): no task sees a group. ``most`` None says that no group can
    be large, as with series at a calendar grain, and saves the count. NaN is the largest value.
    Spark's own ``percentile`` weighs both neighbours, which is off by one ulp
    between equal values; a percentile grid needs its plateaus exact.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_x"))

    def grid_of(at) -> Column:
        """The interpolated values, given the value at a rank from 0."""
        def one(p: Column) -> Column:
            position = p * (F.col("n") - 1)
            low = F.floor(position)
            a, b = at(low), at(F.least(low + 1, F.col("n") - 1))
            return F.when(a == b, a).otherwise(a + (b - a) * (position - low))

        return F.transform(F.array(*[F.lit(float(p)) for p in probs]), one)

    def small(some: DataFrame) -> DataFrame:
        return some.groupBy(*keys).agg(F.array_sort(F.collect_list("_x")).alias("_v")).withColumn(
            "n", F.size("_v").cast("bigint")).select(
            *keys, grid_of(lambda r: F.element_at("_v", (r + 1).cast("int"))).alias(name), "n")

    if most is None:
        return small(rows)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    large = settle(sizes.where(F.col("n") > most), "large_groups")
    if large.isEmpty():
        return small(rows)
    few = rows.join(large.select(*keys), _null_safe(rows, large, keys), "left_anti")
    wanted = large.withColumn("_low", F.explode(F.array(*[
        F.floor(F.lit(float(p)) * (F.col("n") - 1)) for p in probs]))).select(
        *keys, "n", F.explode(F.array("_low", F.least(F.col("_low") + 1, F.col("n") - 1))).alias("rank")).distinct()
    found = ranked_values(rows, keys, "_x", wanted.select(*keys, "rank"), most).groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "_x"))).alias("_at"))
    big = found.join(large, _null_safe(found, large, keys)).select(
        *[found[k] for k in keys], grid_of(lambda r: F.element_at("_at", r)).alias(name), "n")
    return union_all(small(few), big)


def _null_safe(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & a[k].eqNullSafe(b[k])
    return out


BINS = 4096


def ranked_values(rows: DataFrame, keys: Sequence[str], value: str, wanted: DataFrame, most: int) -> DataFrame:
    """(keys, rank, value): the values at the wanted ranks (from 0) of each group, exactly.

    Each round counts values in bins of equal width, per group, before anything moves; the
    running counts tell which bins hold a wanted rank. Bins of up to ``most`` values are sorted,
    bins of one value are known, the others are cut into bins in the next round. A round
    narrows a range BINS times, so rounds are few; other values are never moved.
    """
    keys = list(keys)
    names = [f"_k{i}" for i in range(len(keys))]
    rows = rows.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(value).alias("_x"))
    at = F.struct(*names)  # equal also where a part is NULL
    rows = rows.select(at.alias("_g"), "_x")
    # open ranges: values low..high of a group, of which `before` others of the group are smaller
    todo = wanted.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], "rank").select(at.alias("_g"), "rank")
    ranges = rows.join(todo.select("_g").distinct(), "_g", "left_semi").groupBy("_g").agg(
        F.min("_x").alias("low"), F.max("_x").alias("high")).select(
        "_g", F.lit(0).alias("range"), "low", "high", F.lit(0).cast("bigint").alias("before"))
    ranges = settle(ranges, "ranges")
    todo = settle(todo.withColumn("range", F.lit(0)), "wanted")
    done = []
    while not todo.isEmpty():
        inside = rows.join(ranges, "_g").where("_x BETWEEN low AND high")
        # halves first: the width of a range may overflow; NaN and infinities have bins of their own
        share = (F.col("_x") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)
        number = F.when(F.isnan("_x"), BINS + 1).when(F.col("_x") == float("inf"), BINS).when(
            F.col("_x") == -float("inf"), -1).when(F.col("low") == F.col("high"), 0).otherwise(
            F.least(F.floor(F.nanvl(share, F.lit(0.0)) * BINS), F.lit(BINS - 1)))
        binned = inside.withColumn("bin", number.cast("int"))
        counts = binned.groupBy("_g", "range", "before", "bin").agg(
            F.count(F.lit(1)).alias("size"), F.min("_x").alias("low"), F.max("_x").alias("high"))
        running = Window.partitionBy("_g", "range").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.withColumn("start", F.col("before") + F.coalesce(F.sum("size").over(running), F.lit(0)))
        hits = settle(todo.join(placed, ["_g", "range"]).where(
            "rank >= start AND rank < start + size").select(
            "_g", "rank", "range", "bin", "start", "size", "low", "high"), "hits")
        one = F.col("low") == F.col("high")  # NaN equals itself here
        done.append(hits.where(one).select("_g", "rank", F.col("low").alias("_x")))
        short = hits.where(~one & (F.col("size") <= most))
        values = binned.drop("low", "high", "before").join(
            short.select("_g", "range", "bin").distinct(), ["_g", "range", "bin"], "left_semi").groupBy(
            "_g", "range", "bin").agg(F.array_sort(F.collect_list("_x")).alias("_v"))
        done.append(settle(short.join(values, ["_g", "range", "bin"]).select(
            "_g", "rank", F.element_at("_v", (F.col("rank") - F.col("start") + 1).cast("int")).alias("_x")),
            "ranked"))
        later = hits.where(~one & (F.col("size") > most)).withColumn(
            "range", F.dense_rank().over(Window.partitionBy("_g").orderBy("range", "bin")))
        ranges = settle(later.select("_g", "range", "low", "high", F.col("start").alias("before")).distinct(), "ranges")
        todo = settle(later.select("_g", "rank", "range"), "wanted")
    out = done[0] if done else wanted.limit(0).withColumn("_g", at)
    for more in done[1:]:
        out = out.union(more)
    return out.select(*[F.col(f"_g.{n}").alias(k) for k, n in zip(keys, names)], "rank", F.col("_x").alias(value))

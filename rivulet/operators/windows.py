"""Row windows over calendar-grained series.

The partitions are (station | cell) series with one row per month or year, so a
window partition is as long as the record, never as long as the raw data.
Columns that share keys and order share one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F


def series(keys: Sequence[str], order: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())


def frame(keys: Sequence[str], order: str, w: int) -> WindowSpec:
    """The current row and the ``w - 1`` rows before it."""
    return series(keys, order).rowsBetween(1 - w, 0)


def rolling_mean(df: DataFrame, keys: Sequence[str], order: str, col: str, w: int, name: str
                 ) -> DataFrame:
    return df.withColumn(name, F.avg(col).over(frame(keys, order, w)))


def rolling_sum(df: DataFrame, keys: Sequence[str], order: str, col: str, w: int, name: str
                ) -> DataFrame:
    return df.withColumn(name, F.sum(col).over(frame(keys, order, w)))


def rolling_mean_if(df: DataFrame, keys: Sequence[str], order: str, col: str, flag: str, w: int,
                    name: str) -> DataFrame:
    """Mean over the flagged rows of the frame only."""
    value = F.when(F.col(flag), F.col(col))
    return df.withColumn(name, F.avg(value).over(frame(keys, order, w)))


def rolling_count(df: DataFrame, keys: Sequence[str], order: str, w: int, name: str,
                  flag: str | None = None) -> DataFrame:
    counted = F.count(F.when(F.col(flag), F.lit(1))) if flag else F.count(F.lit(1))
    return df.withColumn(name, counted.over(frame(keys, order, w)))


def previous(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], n: int = 1,
             suffix: str = "_prec") -> DataFrame:
    window = series(keys, order)
    return df.withColumns({f"{c}{suffix}": F.lag(c, n).over(window) for c in cols})


def change_vs(df: DataFrame, keys: Sequence[str], order: str, col: str, n: int, name: str
              ) -> DataFrame:
    """Difference to the n-th row before, whatever month that row is."""
    return df.withColumn(name, F.col(col) - F.lag(col, n).over(series(keys, order)))


def change_vs_month(df: DataFrame, keys: Sequence[str], month: str, col: str, n: int, name: str
                    ) -> DataFrame:
    """Calendar-true variant: difference to the row exactly n months earlier, else NULL."""
    before = df.select(*keys, F.add_months(month, n).alias(month), F.col(col).alias("_before"))
    return (df.join(before, [*keys, month], "left")
            .withColumn(name, F.col(col) - F.col("_before")).drop("_before")
            .select(*df.columns, name))


def history_percentile(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """percent_rank with NULLs last, so that they do not shift the other ranks."""
    window = Window.partitionBy(*keys).orderBy(F.col(col).asc_nulls_last())
    return df.withColumn(name, F.percent_rank().over(window))


def rolled_columns(keys: Sequence[str], order: str, w: int, sums: Sequence[str] = (),
                   means: Sequence[str] = (), means_if: Sequence[tuple[str, str]] = (),
                   since: Column | None = None) -> dict[str, Column]:
    """All aggregates of one window length under one shared frame.

    Names: ``<column>_<w>``; ``n_<w>`` counts the rows of the frame and
    ``n_<flag>_<w>`` those that carry the flag. With ``since`` only rows from
    there on count, so a frame that reaches further back is not full.
    """
    window = frame(keys, order, w)
    out = {f"{c}_{w}": F.sum(c).over(window) for c in sums}
    out |= {f"{c}_{w}": F.avg(c).over(window) for c in means}
    for value, flag in means_if:
        out[f"{value}_{w}"] = F.avg(F.when(F.col(flag), F.col(value))).over(window)
        out[f"n_{flag}_{w}"] = F.count(F.when(F.col(flag), F.lit(1))).over(window)
    counted = F.lit(1) if since is None else F.when(F.col(order) >= since, F.lit(1))
    out[f"n_{w}"] = F.count(counted).over(window)
    return out


def rolled_balance(monthly: DataFrame, keys: Sequence[str], month: str, value: str, w: int,
                   start: str, end: str, name: str) -> DataFrame:
    """Full rolling sums in [start, end); the w - 1 months before ``start`` warm up the frame."""
    first = F.add_months(F.lit(start).cast("date"), 1 - w)
    base = monthly.where((F.col(month) >= first) & (F.col(month) < F.lit(end).cast("date")))
    rolled = base.withColumns({
        name: F.sum(value).over(frame(keys, month, w)),
        "_n": F.count(F.lit(1)).over(frame(keys, month, w))})
    return rolled.where((F.col("_n") == w) & (F.col(month) >= F.lit(start).cast("date"))).drop("_n")

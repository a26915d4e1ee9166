"""Unions, unpivots and calendar generators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def union_all(*frames: DataFrame, fill_missing: bool = False) -> DataFrame:
    """UNION ALL by name; missing columns become typed NULLs on request."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*[f.distinct() for f in frames]).distinct()


def overall_bounds(*frames: DataFrame, date: str) -> DataFrame:
    """One row: smallest and largest date over all frames."""
    parts = [f.agg(F.min(date).alias("min_date"), F.max(date).alias("max_date")) for f in frames]
    return union_all(*parts).agg(F.min("min_date").alias("min_date"),
                                 F.max("max_date").alias("max_date"))


def date_series(bounds: DataFrame, as_of: str, default_start: str = "2000-01-01",
                start: str = "min_date", end: str = "max_date", name: str = "date") -> DataFrame:
    """Every day between two bound columns, with defaults for an empty source."""
    first = F.coalesce(F.col(start), F.lit(default_start).cast("date"))
    last = F.coalesce(F.col(end), F.lit(as_of).cast("date"))
    return bounds.select(F.explode(F.sequence(first, last)).alias(name))


def month_series(df: DataFrame, as_of: str, n: int = 13, name: str = "m") -> DataFrame:
    """The ``n`` complete months before ``as_of``; ``df`` only lends its session."""
    this_month = F.trunc(F.lit(as_of).cast("date"), "month")
    months = F.sequence(F.add_months(this_month, -n), F.add_months(this_month, -1),
                        F.expr("interval 1 month"))
    return df.sparkSession.range(1).select(F.explode(months).alias(name))


def window_months(windows: DataFrame, start: str, end: str) -> DataFrame:
    """Months a date window touches, with the first and last day inside the window."""
    month = F.col("_m")
    return (windows.withColumn("_m", F.explode(F.sequence(
                F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))))
            .select(*windows.columns, F.year(month).alias("year"), F.month(month).alias("month"),
                    F.dayofmonth(F.greatest(month, F.col(start))).alias("first_day"),
                    F.dayofmonth(F.least(F.last_day(month), F.col(end))).alias("last_day")))


def unpivot_windows(df: DataFrame, keep: Sequence[Column | str], windows: Sequence[int],
                    columns: Mapping[str, str], guard: str | None = "n",
                    window_name: str = "fenetre") -> DataFrame:
    """``<source>_<w>`` columns to one row per window length.

    ``columns`` maps output names to source prefixes. With ``guard`` a row is
    emitted only when ``<guard>_<w>`` equals w (the frame is full).
    """
    structs = []
    for w in windows:
        fields = [F.lit(w).alias(window_name),
                  *[F.col(f"{src}_{w}").alias(out) for out, src in columns.items()]]
        if guard:
            fields.append((F.col(f"{guard}_{w}") == w).alias("_full"))
        structs.append(F.struct(*fields))
    kept = [F.col(c) if isinstance(c, str) else c for c in keep]
    rows = df.select(*kept, F.inline(F.array(*structs)))
    return rows.where("_full").drop("_full") if guard else rows


def calendar_template(keys: DataFrame, name: str = "month") -> DataFrame:
    """Twelve rows per key, also for months without data."""
    return keys.withColumn(name, F.explode(F.sequence(F.lit(1), F.lit(12))))


def tag_union(frames: Mapping[str, DataFrame], name: str = "type") -> DataFrame:
    return union_all(*[df.withColumn(name, F.lit(tag)) for tag, df in frames.items()])


def select_with_rest(df: DataFrame, exprs: Sequence[Column], drop: Sequence[str]) -> DataFrame:
    """Chosen expressions first, then every other source column unchanged."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in set(drop)]
    return df.select(*exprs, *rest)

"""First row per key under an ordering.

``row_number() == 1`` is planned with a per-task group limit before the
shuffle, so at most one row per key leaves each map task however hot the key.
Ties are broken on the remaining columns, which makes reruns identical.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

Order = Sequence[tuple[str, str]]
_UNORDERED = (T.MapType, T.VariantType)


def ordering(order: Order) -> list[Column]:
    """(column, 'asc' | 'desc') pairs; NULLs come last either way."""
    return [F.col(c).desc_nulls_last() if way == "desc" else F.col(c).asc_nulls_last()
            for c, way in order]


def tie_break(df: DataFrame, used: Sequence[str]) -> list[Column]:
    return [F.col(f"`{f.name}`").asc_nulls_last() for f in df.schema.fields
            if f.name not in used and not isinstance(f.dataType, _UNORDERED)]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Order,
                  ties: Sequence[str] | None = None) -> DataFrame:
    used = [*keys, *(c for c, _ in order)]
    rest = tie_break(df, used) if ties is None else ordering([(t, "asc") for t in ties])
    window = Window.partitionBy(*keys).orderBy(*ordering(order), *rest)
    return (df.withColumn("_rank", F.row_number().over(window))
            .where("_rank = 1").drop("_rank"))


dedup_latest = first_per_key
latest_row = first_per_key


def principal_category(df: DataFrame, key: Sequence[str] | str, category: str,
                       weight: str) -> DataFrame:
    """The category with the largest total weight per key."""
    keys = [key] if isinstance(key, str) else list(key)
    totals = df.groupBy(*keys, category).agg(F.sum(weight).alias(weight))
    return first_per_key(totals, keys, [(weight, "desc")]).select(*keys, category)


def last_n(df: DataFrame, order: str, n: int) -> DataFrame:
    """Latest ``n`` rows of one series (planned as a top-k, not a full sort)."""
    return df.orderBy(*ordering([(order, "desc")]), *tie_break(df, [order])).limit(n)


def distinct_points(df: DataFrame, lat: str, lon: str) -> DataFrame:
    return df.select(lat, lon).where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).distinct()

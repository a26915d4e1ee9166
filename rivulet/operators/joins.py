"""Joins between series, referentials and grids.

No broadcast hints: Spark broadcasts a side when its size estimate (or, under
AQE, its measured size) is below the threshold and sort-merges otherwise, and
AQE splits skewed sort-merge partitions, those of NULL keys too. Where a session
has AQE off, ``salted_join`` can spread the left side over sub-keys derived from a
row identifier; the result is the same with any salt.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from rivulet.functions.calendar import month_start
from rivulet.functions.clean import first_token


def _list(keys: Sequence[str] | str) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str] | str, how: str,
                spread: Sequence[str] = (), salt: int = 1) -> DataFrame:
    """Equi-join that tolerates a hot (or NULL) key on the left side.

    A plain join leaves the splitting to AQE. With a ``salt`` the rows of a key are
    dealt to that many tasks by ``spread``, left columns that differ between them such
    as a row identifier, and ``right``, which must hold each key once, is repeated as
    often. ``how`` is one that never emits unmatched right rows.
    """
    if how not in {"inner", "left", "left_semi", "left_anti"}:
        raise ValueError(f"unsupported join type: {how}")
    keys = _list(keys)
    if not spread or salt <= 1:
        return left.join(right, keys, how)
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    bucket = F.pmod(F.xxhash64(*spread), F.lit(salt)).cast("int")
    return left.withColumn("_salt", bucket).join(copies, [*keys, "_salt"], how).drop("_salt")


def keep_known(df: DataFrame, ref: DataFrame, key: Sequence[str] | str,
               spread: Sequence[str] = ()) -> DataFrame:
    """Keep rows whose key exists in the referential; an empty referential gives no rows."""
    keys = _list(key)
    return salted_join(df, ref.select(*keys).distinct(), keys, "left_semi", spread)


def drop_known(df: DataFrame, ref: DataFrame, key: Sequence[str] | str,
               spread: Sequence[str] = ()) -> DataFrame:
    """NOT EXISTS."""
    keys = _list(key)
    return salted_join(df, ref.select(*keys).distinct(), keys, "left_anti", spread)


def flag_known(df: DataFrame, ref: DataFrame, key: Sequence[str] | str, flag: str,
               spread: Sequence[str] = ()) -> DataFrame:
    """Add a boolean existence column instead of filtering."""
    keys = _list(key)
    known = ref.select(*keys).distinct().withColumn(flag, F.lit(True))
    joined = salted_join(df, known, keys, "left", spread)
    return joined.withColumn(flag, F.coalesce(F.col(flag), F.lit(False))).select(*df.columns, flag)


def enrich(df: DataFrame, dim: DataFrame, key: Sequence[str] | str,
           cols: Sequence[str], spread: Sequence[str] = ()) -> DataFrame:
    """Left join of dimension columns by a key that is unique in ``dim``."""
    keys = _list(key)
    return salted_join(df, dim.select(*keys, *cols), keys, "left", spread)


def join_weather(facts: DataFrame, mapping: DataFrame, grid: DataFrame, key: str, day: str,
                 cell: tuple[str, str] = ("era5_latitude", "era5_longitude"),
                 grid_cell: tuple[str, str] = ("latitude", "longitude"),
                 grid_day: str = "era5_date") -> DataFrame:
    """Facts -> their cell -> that cell's weather of the day, both left joins.

    The weather join is keyed on (lat, lon, day): a popular cell is spread over
    its days. Only the cell of a station goes through it; the station's other
    attributes join last, so they are not shuffled by day. ``mapping`` holds one row
    per station, ``grid`` one per cell-day.
    """
    located = facts.join(mapping.select(key, *cell), key, "left")
    rest = [c for c in mapping.columns if c not in cell]
    weather = grid.select(
        F.col(grid_cell[0]).alias(cell[0]), F.col(grid_cell[1]).alias(cell[1]),
        F.col(grid_day).alias(day),
        *[c for c in grid.columns if c not in (*grid_cell, grid_day)])
    return located.join(weather, [*cell, day], "left").join(mapping.select(*rest), key, "left")


def restrict_to_cells(grid: DataFrame, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    return grid.join(cells.select(*keys).distinct(), list(keys), "left_semi")


def left_align(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two sources that share their grain."""
    return a.join(b, list(keys), "left")


def recent_keys(df: DataFrame, key: str, day: str, as_of: date | str, days: int = 7) -> DataFrame:
    """Keys with a row in the last ``days`` days before ``as_of``."""
    since = F.date_sub(F.lit(str(as_of)).cast("date"), days)
    return df.where(F.col(day) >= since).select(key).distinct()


def restrict_to_network(df: DataFrame, seed: DataFrame, key: str, seed_key: str | None = None
                        ) -> DataFrame:
    """Only stations of an official list; the list may name its code differently."""
    codes = seed.select(F.col(seed_key or key).alias(key)).where(F.col(key).isNotNull()).distinct()
    return df.join(codes, key, "left_semi")


def fill_months(counts: DataFrame, months: DataFrame, month: str, n: str) -> DataFrame:
    """Every month of the calendar, with 0 where nothing was counted."""
    return (months.join(counts.select(month, n), month, "left")
            .withColumn(n, F.coalesce(F.col(n), F.lit(0))))


def attach_normals(normals: DataFrame, spei_params: DataFrame,
                   keys: Sequence[str] = ("era5_latitude", "era5_longitude",
                                          "mois_calendaire", "fenetre")) -> DataFrame:
    """Normals with the SPEI parameters where a fit exists (left join).

    Together with the inner join of ``grid_indices`` this is the parameter
    lookup of the index job; an empty SPEI table only leaves SPEI NULL.
    """
    keys = list(keys)
    return normals.join(spei_params.select(*keys, "glo_alpha", "glo_k", "glo_xi"), keys, "left")


def bias_stats(a: DataFrame, b: DataFrame, keys: Sequence[str], x: str, y: str,
               by: Sequence[str] = ()) -> DataFrame:
    """Mean, sample deviation and count of x - y over the rows both sources have."""
    pairs = a.select(*keys, F.col(x).alias("_x")).join(b.select(*keys, F.col(y).alias("_y")),
                                                       list(keys))
    delta = F.col("_x") - F.col("_y")
    return pairs.groupBy(*by).agg(F.avg(delta).alias("bias_mean"),
                                  F.stddev(delta).alias("bias_stddev"),
                                  F.count(delta).alias("n"))


def match_entity(stations: DataFrame, entities: DataFrame, key: str, codes: str,
                 code: str = "code_eh", attrs: Sequence[str] = (), sep: str = ",") -> DataFrame:
    """Attributes by the first listed code, else by the earliest other code that matches.

    Adds ``code`` (of the match), ``attrs``, ``matched_by`` ('PRIMARY', 'ANY'
    or NULL) and ``primary_code``. One exploded row per listed code, one join,
    and one first-per-key pass serve both steps: position 1 is the primary
    code, so the lowest matching position implements the order of preference.
    """
    lookup = (entities.withColumn("_code", F.trim(F.col(code)))
              .select("_code", F.col(code).alias("_entity"),
                      *[F.col(a).alias(f"_e_{a}") for a in attrs]))
    listed = (stations.select(key, F.posexplode(F.split(F.coalesce(F.col(codes), F.lit("")), "\\Q" + sep + "\\E"))
                              .alias("_pos", "_token"))
              .select(key, "_pos", F.trim("_token").alias("_code")).where("_code != ''"))
    hits = listed.join(lookup, "_code").drop("_code")
    best = (hits.groupBy(key)
            .agg(F.min_by(F.struct("_pos", "_entity", *[f"_e_{a}" for a in attrs]),
                          F.struct("_pos", "_entity")).alias("_hit")))
    joined = stations.join(best, key, "left")
    return joined.select(
        *stations.columns,
        F.col("_hit._entity").alias(code),
        *[F.col(f"_hit._e_{a}").alias(a) for a in attrs],
        F.when(F.col("_hit._pos") == 0, F.lit("PRIMARY"))
        .when(F.col("_hit._pos") > 0, F.lit("ANY")).alias("matched_by"),
        first_token(codes, sep).alias("primary_code"))


def coalesce_sources(df: DataFrame, attrs: Sequence[str], fallback: DataFrame, key: str
                     ) -> DataFrame:
    """Fill every attribute from ``fallback`` (same names) where it is still NULL."""
    other = fallback.select(key, *[F.col(a).alias(f"_f_{a}") for a in attrs])
    joined = df.join(other, key, "left")
    return joined.select(*[
        F.coalesce(F.col(c), F.col(f"_f_{c}")).alias(c) if c in attrs else F.col(c)
        for c in df.columns])


def monthly_counts(df: DataFrame, day: str, month: str = "m", n: str = "n") -> DataFrame:
    return df.groupBy(month_start(day).alias(month)).agg(F.count(F.lit(1)).alias(n))

"""Incremental refresh as pure queries over old and new rows.

Every function returns the rows to write; the sinks live in
``rivulet.sources.tables``. "Now" is always the ``as_of`` parameter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F


def _day(value) -> Column:
    return F.lit(str(value)).cast("date")


def latest(df: DataFrame, col: str):
    """The one scalar a refresh collects: MAX(col), None for an empty table."""
    return df.agg(F.max(col)).first()[0]


def lookback_bound(target: DataFrame | None, day: str, days: int = 7,
                   reprocess_from: date | str | None = None) -> date:
    """First day to read: ``reprocess_from``, else the target's maximum minus ``days``."""
    if reprocess_from is not None:
        return date.fromisoformat(str(reprocess_from)[:10])
    return _as_date(latest(target, day) or date(1900, 1, 1)) - timedelta(days=days)


def since_bound(src: DataFrame, bound: date, part: str = "year") -> DataFrame:
    """Without the year partitions before the bound, where the table has such partitions.

    Cleaned day columns reach no partition filter; this one does.
    """
    return src.where(F.col(part) >= bound.year) if part in src.columns else src


def lookback_filter(src: DataFrame, target: DataFrame | None, day: str, days: int = 7,
                    reprocess_from: date | str | None = None,
                    target_day: str | None = None) -> DataFrame:
    """Source rows since the target's own maximum minus ``days``.

    The bound is collected first, so the scan of ``src`` prunes files by it.
    """
    if reprocess_from is None and target_day is not None:
        target = target.select(F.col(target_day).alias(day))
    return src.where(F.col(day) >= _day(lookback_bound(target, day, days, reprocess_from)))


def newer_than(src: DataFrame, target: DataFrame, ts: str,
               target_ts: str | None = None, reprocess_from=None) -> DataFrame:
    """Strictly newer rows. Key it on the load time: keyed on the measure's own
    time it skips back-filled data."""
    if reprocess_from is not None:
        return src.where(F.col(ts) >= F.lit(str(reprocess_from)).cast("timestamp"))
    top = latest(target, target_ts or ts)
    return src if top is None else src.where(F.col(ts) > F.lit(top))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete + insert by key: old rows without a new version, plus all new rows."""
    kept = old.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def replace_recent(old: DataFrame, new: DataFrame, day: str, days: int, as_of: date | str
                   ) -> DataFrame:
    """Drop the last ``days`` days and append the re-fetched ones (same bound on both).

    Old rows without a day are in no window and stay.
    """
    cut = F.date_sub(_day(as_of), days)
    return old.where(_before(day, cut)).unionByName(new.where(F.col(day) >= cut))


def replace_range(old: DataFrame, new: DataFrame, ts: str, start, end) -> DataFrame:
    """Replace the days of [start, end]; the batch is cut to the same window first."""
    inside = F.to_date(ts).between(_day(start), _day(end))
    return old.where(~F.coalesce(inside, F.lit(False))).unionByName(new.where(inside))


def _before(day: str, cut: Column) -> Column:
    return F.coalesce(F.col(day) < cut, F.lit(True))


def recent_cut(as_of: date | str, days: int | None = None, months: int | None = None) -> Column:
    """First day of the last ``days`` days or of the last whole ``months``."""
    if months is not None:
        return F.trunc(F.add_months(_day(as_of), -months), "month")
    return F.date_sub(_day(as_of), days)


def recompute_recent(build: Callable[[Column | None], DataFrame], target: DataFrame, day: str,
                     as_of: date | str, days: int | None = None, months: int | None = None
                     ) -> DataFrame:
    """Rebuild a fact's last days (or whole months) and keep the rest.

    ``build`` receives the lower date bound, to apply to every source it reads.
    """
    cut = recent_cut(as_of, days, months)
    fresh = build(cut).where(F.col(day) >= cut)
    return target.where(_before(day, cut)).unionByName(fresh)


def recompute_months(aggregate: Callable[[DataFrame], DataFrame],
                     roll: Callable[[DataFrame], DataFrame], daily: DataFrame, day: str,
                     target: DataFrame, month: str, months: int = 25) -> DataFrame:
    """Rebuild the last months of a monthly fact, equal to a full rebuild.

    Only the daily rows of the rewritten months are read. The rolling columns
    look back over earlier months, which are taken from the stored fact; rows
    count, not calendar distance, so series with gaps keep their context.
    """
    top = latest(target, month)
    if top is None:
        return roll(aggregate(daily))
    since = F.trunc(F.add_months(_day(top), -months), "month")
    fresh = aggregate(daily.where(F.col(day) >= since))
    before = target.where(F.col(month) < since)
    rolled = roll(before.select(*fresh.columns).unionByName(fresh))
    return before.unionByName(rolled.where(F.col(month) >= since))


def recompute_active(build: Callable[[DataFrame], DataFrame], source: DataFrame,
                     active: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rebuild all rows of the recently active keys, keep the others as they are."""
    fresh = build(source.join(active, key, "left_semi"))
    return target.join(active, key, "left_anti").unionByName(fresh)


def map_new(points: DataFrame, mapped: DataFrame, key: str,
            build: Callable[[DataFrame], DataFrame], recompute_all: bool = False) -> DataFrame:
    """Compute the mapping of points that have none yet."""
    todo = points if recompute_all else points.join(mapped.select(key), key, "left_anti")
    fresh = build(todo)
    return fresh if recompute_all else mapped.unionByName(fresh)


def update_window(last: datetime | date | None, now: datetime | date, lag_days: int,
                  overlap: int = 2, cap: int = 60) -> tuple[date, date, str]:
    """Days to fetch next: (start, end, status) with status ok, gap, empty or up_to_date."""
    end = _as_date(now) - timedelta(days=lag_days)
    floor = end - timedelta(days=cap)
    if last is None:
        return floor, end, "empty"
    start, status = _as_date(last) - timedelta(days=overlap), "ok"
    if start < floor:
        start, status = floor, "gap"
    return (start, end, "up_to_date") if start >= end else (start, end, status)


def _as_date(value: datetime | date) -> date:
    return value.date() if isinstance(value, datetime) else value


def update_window_columns(last: str, now: Column, lag_days: int, overlap: int = 2, cap: int = 60
                          ) -> dict[str, Column]:
    """The same rule for one row per series."""
    end = F.date_sub(now, lag_days)
    floor = F.date_sub(end, cap)
    wanted = F.date_sub(F.col(last), overlap)
    start = F.coalesce(F.greatest(wanted, floor), floor)
    status = (F.when(F.col(last).isNull(), F.lit("empty"))
              .when(start >= end, F.lit("up_to_date"))
              .when(wanted < floor, F.lit("gap")).otherwise(F.lit("ok")))
    return {"window_start": start, "window_end": end, "window_status": status}

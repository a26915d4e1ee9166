"""Safe casts and token handling for text that comes from landed files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Trim; blank and the literal ``NULL`` become NULL."""
    trimmed = F.trim(col(c).cast("string"))
    return F.when(~trimmed.isin("", "NULL"), trimmed)


def clean_numeric(c: Column | str, strict: bool = True) -> Column:
    """Text to double. ``strict`` raises on bad text, otherwise NULL."""
    text = clean_text(c)
    return text.cast("double") if strict else text.try_cast("double")


def clean_int(c: Column | str, strict: bool = True) -> Column:
    """Text to integer, rounding half away from zero (12.6 gives 13)."""
    text = clean_text(c)
    number = text.cast("decimal(38,10)") if strict else text.try_cast("decimal(38,10)")
    return F.round(number).cast("int")


def clean_date(c: Column | str, strict: bool = True) -> Column:
    text = clean_text(c)
    return text.cast("date") if strict else text.try_cast("date")


def clean_timestamp(c: Column | str, strict: bool = True) -> Column:
    text = clean_text(c)
    return text.cast("timestamp_ntz") if strict else text.try_cast("timestamp_ntz")


def nan_to_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def to_float_or_null(c: Column | str) -> Column:
    """Text to double; anything unparsable, and NaN, becomes NULL."""
    return nan_to_null(F.trim(col(c).cast("string")).try_cast("double"))


def to_int_or_null(c: Column | str) -> Column:
    """Text to bigint; only plain integer text counts, so ``12.0`` is NULL."""
    text = F.trim(col(c).cast("string"))
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))


def snap(c: Column | str, digits: int = 1) -> Column:
    """Round a coordinate to the grid as DECIMAL, so that equality is exact."""
    return F.round(col(c).cast("decimal(20,14)"), digits).cast(f"decimal(6,{digits})")


def in_bbox(lat: Column | str, lon: Column | str,
            box: tuple[float, float, float, float] = (41.0, 52.0, -5.5, 10.0)) -> Column:
    """Inclusive (lat_min, lat_max, lon_min, lon_max) test."""
    lat_min, lat_max, lon_min, lon_max = box
    return col(lat).between(lat_min, lat_max) & col(lon).between(lon_min, lon_max)


def within_sentinels(c: Column | str, lo: float = -1e4, hi: float = 1e8) -> Column:
    """True for real measures; both bounds are strict."""
    return (col(c) > lo) & (col(c) < hi)


def decode(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Code to label; an unknown code gives NULL."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.create_map(*pairs)[col(c)]


def first_token(c: Column | str, sep: str = ",") -> Column:
    """First element of a separated list, trimmed; blank gives NULL."""
    text = F.coalesce(col(c), F.lit(""))
    return F.nullif(F.trim(F.split_part(text, F.lit(sep), F.lit(1))), F.lit(""))


def tokens(c: Column | str, sep: str = ",") -> Column:
    """All elements of a separated list, trimmed, blanks removed."""
    parts = F.split(F.coalesce(col(c), F.lit("")), f"\\Q{sep}\\E")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")

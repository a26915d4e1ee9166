"""Threshold labels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from rivulet.functions.clean import col

# Labels and cut-offs of the published classes.
QUINTILES = [(0.2, "TRES_BAS"), (0.4, "BAS"), (0.6, "NORMAL"), (0.8, "HAUT")]
QUINTILE_TOP = "TRES_HAUT"
SEVEN_CLASSES = [
    (-1.75, "EXTREMEMENT_BAS"), (-1.28, "TRES_BAS"), (-0.84, "BAS"),
    (0.84, "NORMAL"), (1.28, "HAUT"), (1.75, "TRES_HAUT"),
]
SEVEN_TOP = "EXTREMEMENT_HAUT"


def _below(c: Column, steps: list[tuple[float, str]], top: str) -> Column:
    chain = F
    for limit, label in steps:
        chain = chain.when(c < limit, F.lit(label))
    return chain.otherwise(F.lit(top))


def quintile_class(p: Column | str) -> Column:
    return _below(col(p), QUINTILES, QUINTILE_TOP)


def classify(z: Column | str) -> Column:
    """Seven classes of a standardized index, lower bound inclusive."""
    z = col(z)
    unknown = z.isNull() | F.isnan(z)
    return F.when(unknown, F.lit("UNKNOWN")).otherwise(_below(z, SEVEN_CLASSES, SEVEN_TOP))


def trend_class(slope: Column | str, threshold: float = 1e-4) -> Column:
    """The slope is in units per second (see ``linear_trend``)."""
    slope = col(slope)
    return (F.when(slope.isNull(), F.lit("INSUFFISANT"))
            .when(slope > threshold, F.lit("HAUSSE"))
            .when(slope < -threshold, F.lit("BAISSE"))
            .otherwise(F.lit("STABLE")))


def alert_level(slope: Column | str, alert: float = -5e-4, watch: float = -1e-4) -> Column:
    slope = col(slope)
    return (F.when(slope < alert, F.lit("ALERTE"))
            .when(slope < watch, F.lit("VIGILANCE"))
            .otherwise(F.lit("NORMAL")))


def trend_quality(r2: Column | str) -> Column:
    r2 = col(r2)
    return (F.when(r2.isNull(), F.lit("NON_CALCULEE"))
            .when(r2 >= 0.5, F.lit("FIABLE"))
            .when(r2 >= 0.2, F.lit("INDICATIVE"))
            .otherwise(F.lit("FAIBLE")))


def station_status(closed_on: Column | str, as_of: date | str) -> Column:
    closed_on = col(closed_on)
    today = F.lit(str(as_of)).cast("date")
    active = closed_on.isNull() | (closed_on > today)
    return F.when(active, F.lit("ACTIVE")).otherwise(F.lit("FERMEE"))


def pct_change(x: Column | str, prev: Column | str) -> Column:
    """Signed percent change; NULL when the earlier value is NULL or 0."""
    x, prev = col(x), col(prev)
    return F.try_divide(x - prev, F.abs(prev)) * 100

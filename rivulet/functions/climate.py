"""Reference evapotranspiration and moment fits, as plain expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from rivulet.functions.clean import col


def extraterrestrial_radiation(lat: Column | str, doy: Column | str) -> Column:
    """Ra in mm/day of evaporation equivalent (FAO-56 equations 21-25)."""
    phi = F.radians(col(lat).cast("double"))
    angle = col(doy).cast("double") * (2 * math.pi / 365)
    distance = 1 + 0.033 * F.cos(angle)
    declination = 0.409 * F.sin(angle - 1.39)
    # the sun neither rises nor sets beyond the polar circles
    cos_sunset = F.greatest(F.least(-F.tan(phi) * F.tan(declination), F.lit(1.0)), F.lit(-1.0))
    sunset = F.acos(cos_sunset)
    megajoule = (24 * 60 / math.pi) * 0.0820 * distance * (
        sunset * F.sin(phi) * F.sin(declination)
        + F.cos(phi) * F.cos(declination) * F.sin(sunset))
    return megajoule * 0.408


def hargreaves_et0(ra: Column | str, tmean: Column | str, tmin: Column | str,
                   tmax: Column | str) -> Column:
    """Daily ET0 (FAO-56 equation 52), floored at 0, NULL if a temperature is missing."""
    mean, low, high = (col(c).cast("double") for c in (tmean, tmin, tmax))
    et0 = 0.0023 * col(ra) * (mean + 17.8) * F.sqrt(F.greatest(high - low, F.lit(0.0)))
    # greatest() skips NULLs, so the presence test has to be explicit
    present = mean.isNotNull() & low.isNotNull() & high.isNotNull()
    return F.when(present, F.greatest(et0, F.lit(0.0)))


def gamma_moments(mean_pos: Column | str, var_pos: Column | str) -> tuple[Column, Column]:
    """Method-of-moments shape and scale of a gamma law on the positive values."""
    mean, var = col(mean_pos), col(var_pos)
    alpha = F.when(var > 0, mean * mean / F.nullif(var, F.lit(0.0)))
    beta = F.when((mean > 0) & (var > 0), var / F.nullif(mean, F.lit(0.0)))
    return alpha, beta

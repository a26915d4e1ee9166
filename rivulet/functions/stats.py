"""Distribution functions and standardized indices as native expressions.

Spark has no normal quantile, normal CDF or incomplete gamma. They are written
out here so that index jobs need no Python worker.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from rivulet.functions.clean import col
from rivulet.functions.geo import let

PROB_CLIP = (0.001, 0.999)
NEAR_ZERO_K = 1e-6

# AS 241 (Wichura 1988), routine PPND16; ascending powers.
PPND_A = [3.3871328727963666080e0, 1.3314166789178437745e+2, 1.9715909503065514427e+3,
          1.3731693765509461125e+4, 4.5921953931549871457e+4, 6.7265770927008700853e+4,
          3.3430575583588128105e+4, 2.5090809287301226727e+3]
PPND_B = [1.0, 4.2313330701600911252e+1, 6.8718700749205790830e+2, 5.3941960214247511077e+3,
          2.1213794301586595867e+4, 3.9307895800092710610e+4, 2.8729085735721942674e+4,
          5.2264952788528545610e+3]
PPND_C = [1.42343711074968357734e0, 4.63033784615654529590e0, 5.76949722146069140550e0,
          3.64784832476320460504e0, 1.27045825245236838258e0, 2.41780725177450611770e-1,
          2.27238449892691845833e-2, 7.74545014278341407640e-4]
PPND_D = [1.0, 2.05319162663775882187e0, 1.67638483018380384940e0, 6.89767334985100004550e-1,
          1.48103976427480074590e-1, 1.51986665636164571966e-2, 5.47593808499534494600e-4,
          1.05075007164441684324e-9]
PPND_E = [6.65790464350110377720e0, 5.46378491116411436990e0, 1.78482653991729133580e0,
          2.96560571828504891230e-1, 2.65321895265761230930e-2, 1.24266094738807843860e-3,
          2.71155556874348757815e-5, 2.01033439929228813265e-7]
PPND_F = [1.0, 5.99832206555887937690e-1, 1.36929880922735805310e-1, 1.48753612908506148525e-2,
          7.86869131145613259100e-4, 1.84631831751005468180e-5, 1.42151175831644588870e-7,
          2.04426310338993978564e-15]

# Hart (1968) rational form of the normal CDF; ascending powers.
HART_NUM = [220.206867912376, 221.213596169931, 112.079291497871, 33.912866078383,
            6.37396220353165, 0.700383064443688, 3.52624965998911e-2]
HART_DEN = [440.413735824752, 793.826512519948, 637.333633378831, 296.564248779674,
            86.7807322029461, 16.064177579207, 1.75566716318264, 8.83883476483184e-2]
HART_SPLIT = 7.07106781186547

# Lanczos approximation, g = 7, nine terms.
LANCZOS = [0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313,
           -176.61502916214059, 12.507343278686905, -0.13857109526572012,
           9.9843695780195716e-6, 1.5056327351493116e-7]


def _poly(x: Column, ascending: list[float]) -> Column:
    value = F.lit(ascending[-1])
    for coefficient in reversed(ascending[:-1]):
        value = value * x + coefficient
    return value


def norm_ppf(p: Column | str) -> Column:
    """Quantile of the standard normal law for 0 < p < 1, NULL elsewhere.

    The argument and the two polynomial variables are bound once. Written out
    flat, the expression is large enough to push a generated stage past the
    JVM's compilation limit, which costs far more than the bindings.
    """
    def centre(q: Column) -> Column:
        return let(0.180625 - q * q, lambda r: q * _poly(r, PPND_A) / _poly(r, PPND_B))

    def outer(v: Column) -> Column:
        return let(F.sqrt(-F.log(F.least(v, 1 - v))), lambda t: F.when(
            t <= 5, let(t - 1.6, lambda r: _poly(r, PPND_C) / _poly(r, PPND_D))).otherwise(
            let(t - 5.0, lambda r: _poly(r, PPND_E) / _poly(r, PPND_F))))

    def body(v: Column) -> Column:
        return (F.when((v <= 0) | (v >= 1), F.lit(None).cast("double"))
                .when(F.abs(v - 0.5) <= 0.425, let(v - 0.5, centre))
                .otherwise(F.signum(v - 0.5) * outer(v)))

    return let(col(p), body)


def norm_cdf(x: Column | str) -> Column:
    """Standard normal CDF, about 15 significant digits."""
    x = col(x)
    a = F.abs(x)
    density = F.exp(-a * a / 2)
    inner = density * _poly(a, HART_NUM) / _poly(a, HART_DEN)
    tail = a + 0.65
    for numerator in (4, 3, 2, 1):
        tail = a + F.lit(float(numerator)) / tail
    outer = density / tail / math.sqrt(2 * math.pi)
    upper = (F.when(a > 37, F.lit(0.0)).when(a < HART_SPLIT, inner).otherwise(outer))
    return F.when(x > 0, 1 - upper).otherwise(upper)


def lgamma(a: Column | str) -> Column:
    """log Gamma for a > 0."""
    a = col(a).cast("double")
    z = a - 1
    series = F.lit(LANCZOS[0])
    for i, coefficient in enumerate(LANCZOS[1:], start=1):
        series = series + coefficient / (z + i)
    t = z + 7.5
    return 0.5 * math.log(2 * math.pi) + (z + 0.5) * F.log(t) - t + F.log(series)


def gamma_cdf(x: Column | str, shape: Column | str, scale: Column | str | float = 1.0) -> Column:
    """P(shape, x / scale) by the power series, with as many terms as x needs.

    0 for x <= 0; 1 far in the upper tail, where the series would be long and
    the result rounds to 1 anyway.
    """
    scale = F.lit(float(scale)) if isinstance(scale, (int, float)) else col(scale)
    scaled = col(x).cast("double") / F.nullif(scale, F.lit(0.0))

    def body(u: Column, a: Column) -> Column:
        terms = F.ceil(F.greatest(u - a, F.lit(0.0)) + 6 * F.sqrt(u) + 18).cast("int")
        # nested (Horner) form of the series: one running double per term
        series = F.aggregate(F.sequence(terms, F.lit(1), F.lit(-1)), F.lit(1.0),
                             lambda acc, n: acc * u / (a + n) + 1)
        value = series * F.exp(a * F.log(u) - u - lgamma(a + 1))
        return (F.when(u.isNull() | a.isNull() | F.isnan(u) | F.isnan(a) | (a <= 0),
                       F.lit(None).cast("double"))
                .when(u <= 0, F.lit(0.0))
                .when(u > a + 40 * F.sqrt(a) + 50, F.lit(1.0))
                .otherwise(F.least(value, F.lit(1.0))))

    return let(scaled, lambda u: let(col(shape).cast("double"), lambda a: body(u, a)))


def clip_probability(p: Column | str, clip: tuple[float, float] = PROB_CLIP) -> Column:
    """``greatest``/``least`` skip NULLs, so NULL is kept explicitly."""
    low, high = (F.lit(float(v)) for v in clip)
    return let(col(p), lambda v: F.when(v.isNotNull(), F.least(F.greatest(v, low), high)))


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def spi_probability(x, alpha, beta, q) -> Column:
    """H(x) = q + (1 - q) G(x), clipped; NULL when the parameters are unusable."""
    x, alpha, beta = (col(c).cast("double") for c in (x, alpha, beta))
    q = col(q).cast("double")
    zero_share = F.when(_finite(q), q).otherwise(F.lit(0.0))
    usable = _finite(x) & _finite(alpha) & _finite(beta) & (alpha > 0) & (beta > 0)
    g = gamma_cdf(F.greatest(x, F.lit(0.0)), alpha, beta)
    return F.when(usable, clip_probability(zero_share + (1 - zero_share) * g))


def spi(x, alpha, beta, q, digits: int = 3) -> Column:
    return F.bround(let(spi_probability(x, alpha, beta, q), norm_ppf), digits)


def sti(t, mu, sigma, digits: int = 3) -> Column:
    t, mu, sigma = (col(c).cast("double") for c in (t, mu, sigma))
    usable = _finite(t) & _finite(mu) & _finite(sigma) & (sigma > 0)
    return F.when(usable, F.bround((t - mu) / F.nullif(sigma, F.lit(0.0)), digits))


def spei_probability(d, alpha, k, xi) -> Column:
    """Generalized-logistic CDF, clipped; NULL outside its support."""
    d, alpha, k, xi = (col(c).cast("double") for c in (d, alpha, k, xi))
    usable = (_finite(d) & _finite(alpha) & _finite(k) & _finite(xi)
              & (alpha > 0) & (F.abs(k) < 1))
    scaled = (d - xi) / F.when(alpha > 0, alpha)
    flat = F.abs(k) < NEAR_ZERO_K
    base = 1 - k * scaled
    logistic = 1 / (1 + F.exp(F.least(-scaled, F.lit(700.0))))
    # exp(log) keeps the power finite: beyond e^700 the CDF is 0 to all digits
    power = F.exp(F.least(F.log(F.when(base > 0, base)) / F.when(~flat, k), F.lit(700.0)))
    cdf = F.when(flat, logistic).when(base > 0, 1 / (1 + power))
    return F.when(usable, clip_probability(cdf))


def spei(d, alpha, k, xi, digits: int = 3) -> Column:
    return F.bround(let(spei_probability(d, alpha, k, xi), norm_ppf), digits)


def grid_probability(v, grid) -> Column:
    """Inverse linear interpolation of a value in a 1..99 percentile grid.

    Flat ends clamp to the first and last percentile; among equal neighbours
    the right-most one wins.
    """
    v, grid = col(v).cast("double"), col(grid)
    n = F.size(grid)
    pair = F.struct(v.alias("v"), F.size(F.filter(grid, lambda g: g <= v)).alias("i"))

    def body(p: Column) -> Column:
        low, high = F.try_element_at(grid, p["i"]), F.try_element_at(grid, p["i"] + 1)
        inside = p["i"] + F.try_divide(p["v"] - low, high - low)
        rank = (F.when(p["i"] == 0, F.lit(1.0)).when(p["i"] == n, n.cast("double"))
                .otherwise(inside))
        return rank / 100

    usable = v.isNotNull() & ~F.isnan(v) & grid.isNotNull()
    return F.when(usable, clip_probability(let(pair, body)))


def grid_to_zscore(v, grid, digits: int = 3) -> Column:
    return F.bround(let(grid_probability(v, grid), norm_ppf), digits)


# Percentiles of the seven-class boundaries.
CLASS_CUTOFFS = [4.01, 10.03, 20.05, 79.95, 89.97, 95.99]


def grid_class_bounds(grid, cutoffs: list[float] | None = None) -> Column:
    """Class boundaries in physical units, interpolated in the percentile grid."""
    grid = col(grid)

    def at(percentile: float) -> Column:
        low = min(max(int(percentile), 1), 98)
        a, b = F.element_at(grid, low), F.element_at(grid, low + 1)
        return a + (b - a) * (percentile - low)

    return F.when(grid.isNotNull(), F.array(*[at(c) for c in cutoffs or CLASS_CUTOFFS]))


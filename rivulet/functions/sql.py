"""The distribution functions and indices under names for SQL text.

``register_functions`` creates temporary SQL functions with the same formulas and fixed
values as the column functions; they are expanded into the query's plan, so no Python runs.
A function's argument can't be a lambda's variable, so bodies hold other functions written out.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

from rivulet.functions import classes, stats


def _poly(x: str, ascending: list[float]) -> str:
    value = f"{ascending[-1]!r}D"
    for coefficient in reversed(ascending[:-1]):
        value = f"({value} * {x} + {coefficient!r}D)"
    return value


def _let(name: str, value: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _norm_ppf(p: str = "p") -> str:
    def ratio(r: str, top: list[float], bottom: list[float]) -> str:
        return f"{_poly(r, top)} / {_poly(r, bottom)}"

    centre = _let("r", "0.180625D - (v - 0.5D) * (v - 0.5D)",
                  f"(v - 0.5D) * {ratio('r', stats.PPND_A, stats.PPND_B)}")
    outer = _let("t", "sqrt(-ln(least(v, 1 - v)))",
                 f"CASE WHEN t <= 5 THEN {_let('r', 't - 1.6D', ratio('r', stats.PPND_C, stats.PPND_D))} "
                 f"ELSE {_let('r', 't - 5.0D', ratio('r', stats.PPND_E, stats.PPND_F))} END")
    return _let("v", p, "CASE WHEN v <= 0 OR v >= 1 THEN CAST(NULL AS DOUBLE) "
                          f"WHEN abs(v - 0.5D) <= 0.425D THEN {centre} ELSE signum(v - 0.5D) * {outer} END")


def _norm_cdf() -> str:
    tail = "(a + 0.65D)"
    for numerator in (4, 3, 2, 1):
        tail = f"(a + {numerator}D / {tail})"
    upper = (f"CASE WHEN a > 37 THEN 0D WHEN a < {stats.HART_SPLIT!r}D THEN exp(-a * a / 2) * "
             f"{_poly('a', stats.HART_NUM)} / {_poly('a', stats.HART_DEN)} "
             f"ELSE exp(-a * a / 2) / {tail} / {math.sqrt(2 * math.pi)!r}D END")
    return _let("u", _let("a", "abs(x)", upper), "CASE WHEN x > 0 THEN 1 - u ELSE u END")


def _log_gamma(a: str = "a") -> str:
    series = " + ".join([f"{stats.LANCZOS[0]!r}D", *(
        f"{c!r}D / (z + {k})" for k, c in enumerate(stats.LANCZOS[1:], start=1))])
    return _let("z", f"{a} - 1", f"{0.5 * math.log(2 * math.pi)!r}D + (z + 0.5D) * ln(z + 7.5D) - (z + 7.5D) "
                              f"+ ln({series})")


def _gamma_cdf(x: str = "x", shape: str = "shape", scale: str = "scale") -> str:
    series = ("aggregate(sequence(CAST(ceil(greatest(u - a, 0D) + 6 * sqrt(u) + 18) AS INT), 1, -1), 1D, "
              "(acc, n) -> acc * u / (a + n) + 1)")
    body = ("CASE WHEN u IS NULL OR a IS NULL OR isnan(u) OR isnan(a) OR a <= 0 THEN CAST(NULL AS DOUBLE) "
            "WHEN u <= 0 THEN 0D WHEN u > a + 40 * sqrt(a) + 50 THEN 1D "
            f"ELSE least({series} * exp(a * ln(u) - u - {_log_gamma('(a + 1)')}), 1D) END")
    return _let("u", f"{x} / nullif({scale}, 0D)", _let("a", shape, body))


def _finite(*names: str) -> str:
    return " AND ".join(f"{n} IS NOT NULL AND NOT isnan({n}) AND abs({n}) <> double('infinity')" for n in names)


def _index(probability: str, usable: str) -> str:
    low, high = stats.PROB_CLIP
    clipped = f"least(greatest(h, {low!r}D), {high!r}D)"
    return _let("h", f"CASE WHEN {usable} THEN {probability} END",
                f"CASE WHEN h IS NOT NULL THEN bround({_norm_ppf(clipped)}, 3) END")


def _spi() -> str:
    zero = f"CASE WHEN {_finite('q')} THEN q ELSE 0D END"
    return _index(_let("s", zero, f"s + (1 - s) * {_gamma_cdf('greatest(x, 0D)', 'alpha', 'beta')}"),
                  f"{_finite('x', 'alpha', 'beta')} AND alpha > 0 AND beta > 0")


def _spei() -> str:
    scaled = "((d - xi) / CASE WHEN alpha > 0 THEN alpha END)"
    flat = f"abs(k) < {stats.NEAR_ZERO_K!r}D"
    power = (f"exp(least(ln(CASE WHEN 1 - k * {scaled} > 0 THEN 1 - k * {scaled} END) "
             f"/ CASE WHEN NOT {flat} THEN k END, 700D))")
    return _index(f"CASE WHEN {flat} THEN 1 / (1 + exp(least(-{scaled}, 700D))) "
                  f"WHEN 1 - k * {scaled} > 0 THEN 1 / (1 + {power}) END",
                  f"{_finite('d', 'alpha', 'k', 'xi')} AND alpha > 0 AND abs(k) < 1")


def _classify() -> str:
    steps = " ".join(f"WHEN z < {limit!r}D THEN '{label}'" for limit, label in classes.SEVEN_CLASSES)
    return f"CASE WHEN z IS NULL OR isnan(z) THEN 'UNKNOWN' {steps} ELSE '{classes.SEVEN_TOP}' END"


def register_functions(spark: SparkSession) -> list[str]:
    """Create the session's functions norm_ppf, norm_cdf, log_gamma, gamma_cdf, spi, sti, spei, classify."""
    sti = (f"CASE WHEN {_finite('t', 'mu', 'sigma')} AND sigma > 0 "
           "THEN bround((t - mu) / nullif(sigma, 0D), 3) END")
    bodies = {"norm_ppf": ("p", "DOUBLE", _norm_ppf()), "norm_cdf": ("x", "DOUBLE", _norm_cdf()),
              "log_gamma": ("a", "DOUBLE", _log_gamma()), "gamma_cdf": ("x shape scale", "DOUBLE", _gamma_cdf()),
              "spi": ("x alpha beta q", "DOUBLE", _spi()), "sti": ("t mu sigma", "DOUBLE", sti),
              "spei": ("d alpha k xi", "DOUBLE", _spei()), "classify": ("z", "STRING", _classify())}
    for name, (arguments, kind, body) in bodies.items():
        declared = ", ".join(f"{a} DOUBLE" for a in arguments.split())
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({declared}) RETURNS {kind} RETURN {body}")
    return list(bodies)

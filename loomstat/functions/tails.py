"""Tails and gamma functions as column expressions.

Continued fractions and series are evaluated from their last term inwards, so
each needs one number as state: an ``aggregate`` over a descending sequence.
``*_sql`` give the same recurrences as DuckDB expressions over ``list_reduce``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TERMS = 200        # terms of a fraction or a series
SERIES_TO = 3.0    # |z| up to which the normal tail is summed as a series
SHIFT = 30         # the gamma functions are expanded at x + SHIFT
LARGE_DOF = 1000   # degrees of freedom from which the t tail is a transformed normal tail

# Stirling's series of ln(gamma) in 1/x, 1/x^3, ...
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)
# gamma(x + 1/2) / (gamma(x) sqrt(x)) in powers of 1/x.
_HALF_STEP = (1.0, -1 / 8, 1 / 128, 5 / 1024, -21 / 32768, -399 / 262144, 869 / 4194304)


def _c(x) -> Column:
    return (x if isinstance(x, Column) else F.col(x)).cast("double")


def _inwards(start: Column, step, terms: int = TERMS) -> Column:
    """``step(f, m)`` for m = terms .. 1, beginning with ``start``."""
    down = F.transform(F.sequence(F.lit(terms), F.lit(1), F.lit(-1)), lambda m: m.cast("double"))
    return F.aggregate(down, start.cast("double"), step)


def _phi(z: Column) -> Column:
    return F.exp(-0.5 * z * z) * F.lit(1 / math.sqrt(2 * math.pi))


def normal_upper_tail(z) -> Column:
    """P(Z > z): 1/2 less the odd series up to ``SERIES_TO``, beyond it the
    continued fraction ``phi(z) / (z + 1 / (z + 2 / (z + ...)))``."""
    z = _c(z)
    a = F.abs(z)
    series = _inwards(F.lit(1.0), lambda s, k: 1 + a * a / (2 * k + 1) * s)
    fraction = _inwards(a, lambda f, k: a + k / f)
    upper = F.when(a <= SERIES_TO, 0.5 - _phi(a) * a * series).otherwise(_phi(a) / fraction)
    return F.when(z >= 0, upper).otherwise(1 - upper)


def log_gamma(x) -> Column:
    """ln(gamma(x)) for x > 0, NULL otherwise: Stirling's series at x + SHIFT,
    taken back by the recurrence."""
    x = _c(x)
    y = x + SHIFT
    series = _poly(_STIRLING, 1 / (y * y)) / y
    back = F.aggregate(F.sequence(F.lit(0), F.lit(SHIFT - 1)), F.lit(0.0).cast("double"), lambda s, k: s + F.log(x + k))
    return F.when(x > 0, (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - back)


def _poly(coef, x: Column) -> Column:
    acc = F.lit(coef[-1])
    for c in reversed(coef[:-1]):
        acc = acc * x + F.lit(c)
    return acc


def _half_step(a: Column) -> Column:
    """gamma(a + 1/2) / gamma(a)."""
    y = a + SHIFT
    back = F.aggregate(F.sequence(F.lit(0), F.lit(SHIFT - 1)), F.lit(1.0).cast("double"), lambda s, k: s * (a + k) / (a + k + 0.5))
    return F.sqrt(y) * _poly(_HALF_STEP, 1 / y) * back


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, both of its
    coefficients of a step at once."""
    def step(f, m):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return 1 + even / (1 + odd / f)
    first = -(a + b) * x / (a + 1)
    return 1 + first / _inwards(F.lit(1.0), step)


def t_two_sided_p(t, dof) -> Column:
    """P(|T| > |t|) of Student's t; NULL without a positive number of degrees.

    The regularised incomplete beta function I_x(dof/2, 1/2), by its fraction on
    the side where that converges fast; from ``LARGE_DOF`` degrees on the
    normal tail of a transformed t (relative error below 1e-9 there).
    """
    t, n = _c(t), _c(dof)
    half, x = n / 2, n / (n + t * t)
    front = F.exp(half * F.log(x)) * F.sqrt(t * t / (n + t * t)) * _half_step(half) / F.lit(math.sqrt(math.pi))
    direct = front / half / _beta_fraction(half, F.lit(0.5), x)
    swapped = 1 - front / 0.5 / _beta_fraction(F.lit(0.5), half, 1 - x)
    a = n - 0.5
    b, y = 48 * a * a, a * F.log1p(t * t / n)
    z = ((((-0.4 * y - 3.3) * y - 24) * y - 85.5) / (0.8 * y * y + 100 + b) + y + 3) / b + 1
    large = 2 * normal_upper_tail(z * F.sqrt(y))
    small = F.when(x < (half + 1) / (half + 2.5), direct).otherwise(swapped)
    return F.when((n > 0) & t.isNotNull(), F.when(t == 0, 1.0).when(F.abs(t) == float("inf"), 0.0).when(n >= LARGE_DOF, large).otherwise(small))


# --- the same recurrences as DuckDB expressions ------------------------------------

def _inwards_sql(start: str, step: str, terms: int = TERMS) -> str:
    return f"list_reduce(list_transform(range({terms}, 0, -1), lambda m: m::DOUBLE), lambda f, m: {step}, ({start})::DOUBLE)"


def _poly_sql(coef, x: str) -> str:
    sql = repr(float(coef[-1]))
    for c in reversed(coef[:-1]):
        sql = f"({sql} * {x} + {float(c)!r})"
    return sql


def normal_upper_tail_sql(z: str) -> str:
    a = f"abs({z})"
    phi = f"(exp(-0.5 * {a} * {a}) / sqrt(2 * pi()))"
    series = f"0.5 - {phi} * {a} * {_inwards_sql('1', f'1 + {a} * {a} / (2 * m + 1) * f')}"
    fraction = f"{phi} / {_inwards_sql(a, f'{a} + m / f')}"
    upper = f"(CASE WHEN {a} <= {SERIES_TO} THEN {series} ELSE {fraction} END)"
    return f"(CASE WHEN {z} >= 0 THEN {upper} ELSE 1 - {upper} END)"


def _half_step_sql(a: str) -> str:
    y = f"({a} + {SHIFT})"
    back = f"list_reduce(list_transform(range({SHIFT}), lambda k: ({a} + k) / ({a} + k + 0.5)), lambda s, k: s * k, 1.0::DOUBLE)"
    return f"(sqrt({y}) * {_poly_sql(_HALF_STEP, f'(1 / {y})')} * {back})"


def _beta_fraction_sql(a: str, b: str, x: str) -> str:
    even = f"m * ({b} - m) * {x} / (({a} + 2 * m - 1) * ({a} + 2 * m))"
    odd = f"(-({a} + m) * ({a} + {b} + m) * {x} / (({a} + 2 * m) * ({a} + 2 * m + 1)))"
    return f"(1 - ({a} + {b}) * {x} / ({a} + 1) / {_inwards_sql('1', f'1 + {even} / (1 + {odd} / f)')})"


def t_two_sided_p_sql(t: str, dof: str) -> str:
    """For 0 < |t| < infinity and fewer than ``LARGE_DOF`` or more degrees alike."""
    half, x = f"({dof} / 2.0)", f"({dof} / ({dof} + {t} * {t}))"
    front = f"(exp({half} * ln({x})) * sqrt({t} * {t} / ({dof} + {t} * {t})) * {_half_step_sql(half)} / sqrt(pi()))"
    direct = f"{front} / {half} / {_beta_fraction_sql(half, '0.5', x)}"
    swapped = f"1 - {front} / 0.5 / {_beta_fraction_sql('0.5', half, f'(1 - {x})')}"
    a = f"({dof} - 0.5)"
    b, y = f"(48 * {a} * {a})", f"({a} * ln(1 + {t} * {t} / {dof}))"
    z = f"(((((-0.4 * {y} - 3.3) * {y} - 24) * {y} - 85.5) / (0.8 * {y} * {y} + 100 + {b}) + {y} + 3) / {b} + 1)"
    large = f"2 * {normal_upper_tail_sql(f'({z} * sqrt({y}))')}"
    return (f"CASE WHEN {dof} <= 0 THEN NULL WHEN {t} = 0 THEN 1.0 WHEN {dof} >= {LARGE_DOF} THEN {large} "
            f"WHEN {x} < ({half} + 1) / ({half} + 2.5) THEN {direct} ELSE {swapped} END")

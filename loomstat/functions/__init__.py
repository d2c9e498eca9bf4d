"""Column expressions (F1-F15 and the distribution helpers).

Everything here returns a ``Column`` built from Spark built-ins; there is no
Python code at run time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


# --- calendar (F1-F3) ------------------------------------------------------

def month_text(ts, sep: str = "-") -> Column:
    """timestamp -> ``MM-yyyy`` (or ``MM/yyyy``) in the session zone (UTC)."""
    return F.date_format(_c(ts), f"MM{sep}yyyy")


def epoch_month_text(epoch, sep: str = "-") -> Column:
    """epoch seconds -> UTC month text, as ``strftime(gmtime(x))``."""
    return F.date_format(F.timestamp_seconds(_c(epoch)), f"MM{sep}yyyy")


def month_start(text, sep: str = "-") -> Column:
    """``MM-yyyy`` text -> first day of that month (DateType)."""
    return F.to_date(_c(text), f"MM{sep}yyyy")


def to_epoch(ts) -> Column:
    """Timestamp (or timestamp_ntz read as UTC) -> epoch seconds."""
    return F.unix_seconds(_c(ts).cast("timestamp"))


# --- text (F4-F8) -------------------------------------------------------------

# Fixed values (must equal the reference's): punctuation classes of the two
# spacing passes. Word characters use Unicode classes, as Python's \w does.
PUNCT_AFTER_WORD = r"""[.,;:!?'"”)]"""
PUNCT_BEFORE_WORD = r"""[.,;:!?'"“()]"""
WORD = r"[\p{L}\p{N}_]"
EOL_MARKER = " _EOL_ "


def space_punctuation(text) -> Column:
    """put a space between a word character and adjacent punctuation."""
    t = F.regexp_replace(_c(text), f"({WORD})({PUNCT_AFTER_WORD})", "$1 $2")
    return F.regexp_replace(t, f"({PUNCT_BEFORE_WORD})({WORD})", "$1 $2")


def regex_tokens(text) -> Column:
    """split on runs of Unicode whitespace keeping empty edge tokens, lower-cased."""
    return F.transform(F.split(_c(text), r"(?U)\s+", -1), lambda t: F.lower(t))


def ws_tokens(text) -> Column:
    """``str.split()``: split on whitespace, no empty tokens."""
    return F.filter(F.split(_c(text), r"(?U)\s+", -1), lambda t: t != F.lit(""))


def last_path_element(path) -> Column:
    """``p.split('/')[-1]``."""
    return F.element_at(F.split(_c(path), "/"), -1)


def with_eol(line) -> Column:
    """F8: ``str(line) + " _EOL_ "``."""
    return F.concat(_c(line).cast("string"), F.lit(EOL_MARKER))


# --- vectors (F10, F14) -------------------------------------------------------

def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y),
                       F.lit(0.0).cast("double"), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(_c(a), lambda x: x * x),
                              F.lit(0.0).cast("double"), lambda acc, v: acc + v))


def cosine(a, b) -> Column:
    """dot / (|a| |b|); NULL (not an error) when either norm is 0."""
    d = norm(a) * norm(b)
    return F.when(d != 0, dot(a, b) / d)


def argmax_index(a) -> Column:
    """zero-based index of the largest element (first on ties)."""
    return F.array_position(_c(a), F.array_max(_c(a))) - 1


def log_sum_exp(a) -> Column:
    """Stable ``ln(sum(exp(a)))`` of an array column."""
    m = F.array_max(_c(a))
    s = F.aggregate(F.transform(_c(a), lambda x: F.exp(x - m)),
                    F.lit(0.0).cast("double"), lambda acc, v: acc + v)
    return m + F.log(s)


# --- densities and quantile functions (F11, K5) -------------------------------

def normal_pdf(x, mu, sigma) -> Column:
    z = (_c(x) - _c(mu)) / _c(sigma)
    return F.exp(-0.5 * z * z) / (_c(sigma) * F.lit(math.sqrt(2 * math.pi)))


def laplace_pdf(x, loc, scale) -> Column:
    return F.exp(-F.abs(_c(x) - _c(loc)) / _c(scale)) / (2 * _c(scale))


def gamma_pdf(x, shape, scale, lgamma_shape) -> Column:
    """Two-parameter gamma density; ``lgamma_shape`` comes from the fit row."""
    k, th = _c(shape), _c(scale)
    return F.exp((k - 1) * F.log(_c(x)) - _c(x) / th - k * F.log(th) - _c(lgamma_shape))


def laplace_quantile(p, loc, scale) -> Column:
    p = _c(p)
    return F.when(p < 0.5, _c(loc) + _c(scale) * F.log(2 * p)) \
            .otherwise(_c(loc) - _c(scale) * F.log(2 - 2 * p))


# Coefficients of the public rational approximation of the
# standard normal quantile (relative error about 1.15e-9).
_NQ_A = (-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00)
_NQ_B = (-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01)
_NQ_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00)
_NQ_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
         3.754408661907416e+00)


def _horner(coef, x: Column) -> Column:
    acc = F.lit(coef[0])
    for c in coef[1:]:
        acc = acc * x + F.lit(c)
    return acc


def normal_quantile(p) -> Column:
    """Standard normal quantile as a column expression (K5)."""
    p = _c(p)
    lo = 0.02425
    q = p - 0.5
    r = q * q
    central = _horner(_NQ_A, r) * q / (_horner(_NQ_B, r) * r + 1)
    ql = F.sqrt(-2 * F.log(p))
    lower = _horner(_NQ_C, ql) / (_horner(_NQ_D, ql) * ql + 1)
    qu = F.sqrt(-2 * F.log(1 - p))
    upper = -_horner(_NQ_C, qu) / (_horner(_NQ_D, qu) * qu + 1)
    return F.when(p < lo, lower).when(p > 1 - lo, upper).otherwise(central)


# --- tails and gamma functions (K1, K4, K11, F12) -------------------------------

from loomstat.functions.tails import log_gamma, normal_upper_tail, t_two_sided_p  # noqa: E402,F401

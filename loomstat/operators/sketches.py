"""Mergeable quantile sketches (A9, A18): KLL sketches stored per period, merged
into longer periods without reading the rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIZE = 400            # the sketch's k
RANK_ERROR = 0.012    # normalised rank error held by tests for this size (99 % bound: about 0.007)


def quantile_sketches(df: DataFrame, period: Column, name: str, value: str, by: list[str] | None = None, size: int = SIZE) -> DataFrame:
    """``by, name, n, sketch``: one sketch of the non-NULL values of each period."""
    x = df.where(F.col(value).isNotNull())
    return x.groupBy(*(by or []), period.alias(name)).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size)).alias("sketch"))


def merged(sketched: DataFrame, *by: str, size: int = SIZE) -> DataFrame:
    """Sketches of longer periods from those of shorter ones."""
    return sketched.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))


def quantiles(sketched: DataFrame, keep: list[str], probs: list[float], name: str = "quantiles") -> DataFrame:
    """``keep, n, <name>``: estimated quantiles in the order of ``probs``."""
    each = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probs])
    return sketched.select(*keep, "n", each.alias(name))


def rank_errors(df: DataFrame, by: str, value: str, estimates: DataFrame, probs: list[float], name: str = "quantiles") -> DataFrame:
    """``estimates`` with ``rank_error``: for each probability, how far it lies
    outside the exact rank interval of its estimate (0: within).

    One pass over the rows against the few estimate rows: counts below and up to
    each estimate.
    """
    from loomstat.operators.joins import salted_join
    j = salted_join(df.where(F.col(value).isNotNull()).select(by, value), estimates.select(by, name), by)
    below = [F.count_if(F.col(value) < F.get(name, i)).alias(f"_b{i}") for i in range(len(probs))]
    up_to = [F.count_if(F.col(value) <= F.get(name, i)).alias(f"_t{i}") for i in range(len(probs))]
    c = j.groupBy(by).agg(F.count(F.lit(1)).alias("_n"), *below, *up_to)
    err = [F.greatest(F.col(f"_b{i}") / F.col("_n") - p, p - F.col(f"_t{i}") / F.col("_n"), F.lit(0.0)) for i, p in enumerate(probs)]
    e = c.select(F.col(by).alias("_by"), F.array(*err).alias("rank_error"))
    return estimates.join(e, F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")

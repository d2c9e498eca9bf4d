"""Summary statistics, distribution fits and tests (A6-A10, A16-A19, W1, W6,
W7, K1-K11, E3).

Aggregates are single-pass built-ins (partial + final ``HashAggregate``).
Exact percentiles use Spark's ``percentile`` (linear interpolation, as
numpy); its buffer is a value -> count map, so memory follows the number
of distinct values, not rows. Pass ``exact=False`` to switch to the
``percentile_approx`` sketch for high-cardinality columns at scale.
Fit results are one-row frames; densities, quantiles and tests are column
arithmetic on them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstat import functions as LF
from loomstat.operators.joins import attach_row, salted_join


def quantile_frame(df: DataFrame, col: str, probs, by: str | None = None,
                   exact: bool = True, name: str = "_q") -> DataFrame:
    """Quantiles of ``col`` (per ``by`` group) as an array column ``name``.

    ``exact`` uses the distributed exact method (``sampling.exact_quantiles``:
    counts per value, running totals, range lookup), which never gathers a
    group's values in one task; otherwise the ``percentile_approx`` sketch.
    """
    from loomstat.operators.sampling import exact_quantiles
    if exact:
        return exact_quantiles(df, col, list(probs), by=by, name=name)
    arr = F.array(*[F.lit(float(p)) for p in probs])
    g = [by] if by else []
    return df.groupBy(*g).agg(F.percentile_approx(col, arr, 10000).alias(name))


def summary(df: DataFrame, col: str, exact: bool = True) -> DataFrame:
    """Mean, median, sample std/var, quartiles, mean +/- one std,
    population excess kurtosis; one row."""
    s = df.agg(F.count(col).alias("n"), F.avg(col).alias("mean"),
               F.stddev_samp(col).alias("std"), F.var_samp(col).alias("var"),
               F.kurtosis(col).alias("kurtosis"),
               F.min(col).alias("min"), F.max(col).alias("max"))
    q = quantile_frame(df, col, [0.25, 0.5, 0.75], exact=exact)
    s = s.join(F.broadcast(q), how="left")  # both sides are single rows
    return s.select("n", "mean", F.get("_q", 1).alias("median"), "std", "var",
                    F.get("_q", 0).alias("p25"), F.get("_q", 2).alias("p75"),
                    (F.col("mean") - F.col("std")).alias("mean_minus_std"),
                    (F.col("mean") + F.col("std")).alias("mean_plus_std"),
                    "kurtosis", "min", "max")


def pearson_by_group(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """Pearson r and n per group (``corr`` partial aggregation)."""
    return df.groupBy(group).agg(F.corr(x, y).alias("r"), F.count(F.lit(1)).alias("n"))


def pearson_p(by_group: DataFrame) -> DataFrame:
    """Two-sided p-value of r from Student's t with n - 2 degrees of
    freedom; the tail is a column expression."""
    exact = F.abs("r") >= 1  # t is infinite: p = 0
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, F.greatest(1 - F.col("r") * F.col("r"), F.lit(0.0))))
    return by_group.withColumn("t", F.when(exact, F.signum("r") * F.lit(float("inf"))).otherwise(t)).withColumn(
        "p_value", F.when(exact, F.lit(0.0)).otherwise(
            LF.t_two_sided_p(F.coalesce(F.when(exact, F.lit(0.0)).otherwise(t), F.lit(0.0)), (F.col("n") - 2).cast("double"))))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """``np.histogram(x, bins)``: equal widths over [min, max], the last
    bin closed; empty bins reported with 0; density = count / (n * width)."""
    b = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"),
               F.count(col).alias("n_total"))
    # one value: numpy widens the range by one half on either side
    same = F.col("lo") == F.col("hi")
    b = b.select(F.when(same, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                 F.when(same, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"), "n_total")
    w = (F.col("hi") - F.col("lo")) / bins
    t = attach_row(df.select(col).filter(F.col(col).isNotNull()), b)
    counts = (t.select(F.least(F.lit(bins - 1),
                               F.floor((F.col(col) - F.col("lo")) / w)).cast("int").alias("bin"))
              .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    spine = b.select("lo", "hi", "n_total",
                     F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (spine.join(counts, "bin", "left")
            .select("bin", (F.col("lo") + F.col("bin") * w).alias("lower"),
                    (F.col("lo") + (F.col("bin") + 1) * w).alias("upper"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n"),
                    (F.coalesce("n", F.lit(0)) / (F.col("n_total") * w)).alias("density")))


def boxplot_stats(df: DataFrame, group: str, col: str, exact: bool = True) -> DataFrame:
    """Quartiles, 1.5 IQR fences, whiskers (furthest points inside the
    fences) and outlier count per group: the numbers behind a box plot."""
    q = quantile_frame(df, col, [0.25, 0.5, 0.75], by=group, exact=exact)
    q = q.select(group, F.get("_q", 0).alias("q1"), F.get("_q", 1).alias("median"),
                 F.get("_q", 2).alias("q3"))
    q = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
         .withColumn("lower_fence", F.col("q1") - 1.5 * F.col("iqr"))
         .withColumn("upper_fence", F.col("q3") + 1.5 * F.col("iqr")))
    # few groups, many rows each: the summary is spread over salts, so that no
    # task gets a whole group
    j = salted_join(df.select(group, col), q, group)
    inside = (F.col(col) >= F.col("lower_fence")) & (F.col(col) <= F.col("upper_fence"))
    return j.groupBy(group, "q1", "median", "q3", "iqr", "lower_fence", "upper_fence").agg(
        F.min(F.when(inside, F.col(col))).alias("whisker_low"),
        F.max(F.when(inside, F.col(col))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"))


def pct_change(df: DataFrame, by: str, order: list[str], value: str) -> DataFrame:
    """``(c / c.shift(1) - 1) * 100`` within each series; first row dropped.

    The previous value comes from ``lag`` inside sorted ranges
    (``ranges.with_previous``), so one dominant series is spread over many tasks.
    """
    from loomstat.operators.ranges import with_previous
    t = with_previous(df, order, [value], by=by)
    return (t.filter(F.col(f"prev_{value}").isNotNull())
            .withColumn("pct_return",
                        (F.try_divide(F.col(value), F.col(f"prev_{value}")) - 1) * 100))


def fit_normal(df: DataFrame, col: str) -> DataFrame:
    """K2: maximum likelihood normal: mean and population deviation."""
    return df.agg(F.avg(col).alias("loc"), F.stddev_pop(col).alias("scale"),
                  F.count(col).alias("n"))


def fit_laplace(df: DataFrame, col: str, exact: bool = True) -> DataFrame:
    """K3: location = median, scale = mean absolute deviation from it."""
    m = quantile_frame(df, col, [0.5], exact=exact).select(F.get("_q", 0).alias("loc"))
    t = attach_row(df.select(col), m)
    return t.groupBy("loc").agg(F.avg(F.abs(F.col(col) - F.col("loc"))).alias("scale"),
                                F.count(col).alias("n"))


def fit_gamma(df: DataFrame, col: str) -> DataFrame:
    """K4: two-parameter gamma (location 0) by the closed-form shape estimate
    ``k = (3 - s + sqrt((s - 3)^2 + 24 s)) / (12 s)``, ``s = ln(mean) - mean(ln x)``;
    scale = mean / k. Only positive values enter."""
    a = df.filter(F.col(col) > 0).agg(F.avg(col).alias("mean"),
                                      F.avg(F.log(col)).alias("mean_log"),
                                      F.count(col).alias("n"))
    s = F.log("mean") - F.col("mean_log")
    k = (3 - s + F.sqrt((s - 3) * (s - 3) + 24 * s)) / (12 * s)
    return (a.withColumn("shape", k).withColumn("scale", F.col("mean") / F.col("shape"))
            .select("shape", "scale", "n"))


def qq_table(df: DataFrame, col: str, dist: str, fit: DataFrame | None = None,
             order_key: str | None = None) -> DataFrame:
    """W7 + K5: ordered sample against theoretical quantiles.

    Plotting position ``(i - 0.5) / n`` (1-based rank ``i``, ties by an
    optional key), from the distributed ``ordered_index``. ``dist`` is
    ``laplace`` (closed form) or ``normal`` (rational approximation).
    """
    from loomstat.operators.sampling import ordered_index
    order = [col] + ([order_key] if order_key else [])
    idx = ordered_index(df.select(*order).filter(F.col(col).isNotNull()), order, "_i")
    f = fit if fit is not None else (fit_laplace(df, col) if dist == "laplace" else fit_normal(df, col))
    t = attach_row(idx, f.select("loc", "scale", F.col("n").alias("_n")))
    p = (F.col("_i") + 0.5) / F.col("_n")
    theo = (LF.laplace_quantile(p, "loc", "scale") if dist == "laplace"
            else F.col("loc") + F.col("scale") * LF.normal_quantile(p))
    return t.select((F.col("_i") + 1).alias("rank"), F.col(col).alias("sample"),
                    p.alias("prob"), theo.alias("theoretical"))


def group_means(df: DataFrame, group: str, col: str) -> DataFrame:
    """Mean per sample group (distribution of group means)."""
    return df.groupBy(group).agg(F.avg(col).alias("group_mean"))


def density_vs_histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """K6: histogram densities next to normal and Laplace densities of the
    fitted models at the bin centres."""
    h = histogram(df, col, bins)
    fn = fit_normal(df, col).select(F.col("loc").alias("n_loc"), F.col("scale").alias("n_scale"))
    fl = fit_laplace(df, col).select(F.col("loc").alias("l_loc"), F.col("scale").alias("l_scale"))
    t = attach_row(attach_row(h, fn), fl)
    centre = (F.col("lower") + F.col("upper")) / 2
    return t.select("bin", "lower", "upper", "n", "density", centre.alias("centre"),
                    LF.normal_pdf(centre, "n_loc", "n_scale").alias("normal_density"),
                    LF.laplace_pdf(centre, "l_loc", "l_scale").alias("laplace_density"))


def proportion_ztest(df: DataFrame, success: Column, p0: float,
                     alpha: float = 0.025) -> DataFrame:
    """K1 + F12: one-sample proportion z-test, upper tail; the verdict
    compares z with the normal critical value at ``alpha``."""
    a = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(success).alias("observed"))
    z = (F.col("observed") - F.col("n") * p0) / F.sqrt(F.col("n") * p0 * (1 - p0))
    crit = LF.normal_quantile(F.lit(1 - alpha))
    return (a.withColumn("z", z)
            .withColumn("verdict", F.when(F.col("z") > crit, F.lit("reject"))
                        .otherwise(F.lit("not rejected"))))


def with_upper_p(test: DataFrame) -> DataFrame:
    """K1: upper-tail p-value of ``z``."""
    return test.withColumn("p_value", LF.normal_upper_tail(F.col("z")))


def trapezoid(df: DataFrame, x: str, y: str, by: str | None = None) -> DataFrame:
    """K7: integral of tabulated ``y(x)`` by the trapezoid rule.

    Points are ordered by (x, y), so the area does not depend on input order
    when x repeats. Consecutive points are paired inside sorted ranges with one carry row
    each, so the sum is computed in parallel across the whole curve.
    """
    from loomstat.operators.ranges import with_previous
    t = with_previous(df.select(*([by] if by else []), x, y), [x, y], [x, y], by=by)
    t = t.filter(F.col(f"prev_{x}").isNotNull())
    area = (F.col(x) - F.col(f"prev_{x}")) * (F.col(y) + F.col(f"prev_{y}")) / 2
    g = [by] if by else []
    return t.groupBy(*g).agg(F.sum(area).alias("area"), (F.count(F.lit(1)) + 1).alias("points"))


def interval_share(df: DataFrame, col: str, a: float, b: float) -> DataFrame:
    """Empirical ``F(b) - F(a)`` = share of values in (a, b]."""
    return df.agg(F.avg(((F.col(col) > a) & (F.col(col) <= b)).cast("double")).alias("share"),
                  F.count(col).alias("n"))


def sum_distribution(h1: DataFrame, h2: DataFrame, block: int = 1_000) -> DataFrame:
    """K8: distribution of X + Y for independent X, Y given as probability
    tables ``(value, p)`` over a bounded support (binned or rounded values).

    The convolution pairs every support point of X with every one of Y (work
    by definition). Y is dealt into blocks of about ``block`` points; each
    point of X meets every block by an equi-join on (block, salt), whatever
    the sizes, and no side is broadcast.
    """
    n = h2.agg(F.greatest(F.ceil(F.count(F.lit(1)) / block), F.lit(1)).cast("int").alias("_k"))
    salts = 16
    a = attach_row(h1.select(F.col("value").alias("x"), F.col("p").alias("px")), n)
    a = (a.withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("_k") - 1))).drop("_k")
         .withColumn("_s", F.pmod(F.xxhash64("x"), F.lit(salts)).cast("int")))
    b = attach_row(h2.select(F.col("value").alias("y"), F.col("p").alias("py")), n)
    b = (b.withColumn("_b", F.pmod(F.xxhash64("y"), F.col("_k")).cast("int")).drop("_k")
         .withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    return (a.join(b, ["_b", "_s"])
            .groupBy((F.col("x") + F.col("y")).alias("value"))
            .agg(F.sum(F.col("px") * F.col("py")).alias("p")))


def chi_square_2x2(df: DataFrame, a: str, b: str) -> DataFrame:
    """Chi-square statistic of a contingency table, expected counts from
    the marginals; compared with the 0.001 critical value 10.828 (1 dof)."""
    obs = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
    ra = obs.groupBy(a).agg(F.sum("o").alias("ra"))
    cb = obs.groupBy(b).agg(F.sum("o").alias("cb"))
    tot = obs.agg(F.sum("o").alias("tot"))
    e = attach_row(obs.join(ra, a).join(cb, b), tot).withColumn(
        "e", F.col("ra") * F.col("cb") / F.col("tot"))
    return e.agg(F.sum((F.col("o") - F.col("e")) ** 2 / F.col("e")).alias("chi2"),
                 F.count(F.lit(1)).alias("cells")).withColumn(
        "reject_at_0001", F.col("chi2") > F.lit(10.828))

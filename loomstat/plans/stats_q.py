"""Catalogue part 2: calendar spine, summary statistics, windows, fits,
tests, samples and splits (SURVEY 7.2 steps 5-6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat import functions as LF
from loomstat.functions import tails
from loomstat.operators import calendar, clean, joins, sampling, stats
from loomstat.plans.registry import query, t


def _r(c, n=6):
    return F.round(F.col(c), n).alias(c)


def _calendar_sql(unit, end):
    return f"""
WITH per AS (SELECT CAST(date_trunc('{unit}', o_orderdate) AS DATE) AS period,
               sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total, count(*) AS n FROM orders GROUP BY 1),
spine AS (SELECT CAST(unnest(generate_series((SELECT min(period) FROM per),
                                             (SELECT max(period) FROM per), INTERVAL 1 {unit}))
                      AS DATE) AS period)
SELECT {end} AS period_end, CAST(coalesce(total, 0) AS DOUBLE) AS total, coalesce(n, 0) AS n
FROM spine LEFT JOIN per USING (period)"""


def _calendar(spark, d, unit):
    o = t(spark, d, "orders", "o_orderdate", "o_totalprice")
    o = o.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)"))
    return calendar.calendar_sum(o, "o_orderdate", "o_totalprice", unit)


@query("calendar_month_sum", _calendar_sql("month", "last_day(spine.period)"))
def calendar_month_sum(spark, d):
    """Monthly sums with a zero row for each empty month."""
    return _calendar(spark, d, "month")


@query("calendar_year_sum", _calendar_sql("year",
                                          "make_date(year(spine.period), 12, 31)"))
def calendar_year_sum(spark, d):
    """Yearly sums with a zero row for each empty year."""
    return _calendar(spark, d, "year")


_SUMMARY_COLS = ["mean", "median", "std", "var", "p25", "p75", "mean_minus_std",
                 "mean_plus_std", "kurtosis", "min", "max"]


@query("summary_stats", """
SELECT count(value) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS median,
       round(stddev_samp(value), 6) AS std, round(var_samp(value), 6) AS var,
       round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.75), 6) AS p75,
       round(avg(value) - stddev_samp(value), 6) AS mean_minus_std,
       round(avg(value) + stddev_samp(value), 6) AS mean_plus_std,
       round(kurtosis_pop(value), 6) AS kurtosis, round(min(value), 6) AS min, round(max(value), 6) AS max
FROM events""")
def summary_stats(spark, d):
    """Mean, median, sample deviation and variance, interpolated
    quartiles, mean +/- std, population excess kurtosis."""
    s = stats.summary(t(spark, d, "events", "value"), "value")
    return s.select("n", *[_r(c) for c in _SUMMARY_COLS])


@query("pearson_by_group", """
SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r, count(*) AS n
FROM lineitem GROUP BY 1""")
def pearson_by_group(spark, d):
    """Pearson r per group."""
    li = t(spark, d, "lineitem", "l_returnflag", "l_quantity", "l_extendedprice")
    return stats.pearson_by_group(li, "l_returnflag", "l_quantity", "l_extendedprice") \
        .select("l_returnflag", _r("r"), "n")


@query("pearson_p_by_group", f"""
WITH c AS (SELECT l_returnflag, corr(l_discount, l_tax) AS r, count(*)::DOUBLE AS n FROM lineitem GROUP BY 1),
s AS (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t FROM c)
SELECT l_returnflag, round(r, 6) AS r, n::BIGINT AS n, round(t, 6) AS t, round({tails.t_two_sided_p_sql('t', '(n - 2)')}, 6) AS p_value FROM s""")
def pearson_p_by_group(spark, d):
    """Pearson r with its two-sided p-value per group."""
    li = t(spark, d, "lineitem", "l_returnflag", "l_discount", "l_tax")
    p = stats.pearson_p(stats.pearson_by_group(li, "l_returnflag", "l_discount", "l_tax"))
    return p.select("l_returnflag", _r("r"), "n", _r("t"), _r("p_value"))


def _hist_sql(bins):
    return f"""
WITH s AS (SELECT min(value) lo, max(value) hi, count(value) nt FROM events),
c AS (SELECT CAST(least({bins - 1}, floor((value - lo) / ((hi - lo) / {bins}))) AS INTEGER) AS bin,
             count(*) AS n FROM events, s GROUP BY 1),
sp AS (SELECT CAST(unnest(range(0, {bins})) AS INTEGER) AS bin)
SELECT sp.bin, round(lo + sp.bin * ((hi - lo) / {bins}), 6) AS lower,
       round(lo + (sp.bin + 1) * ((hi - lo) / {bins}), 6) AS upper, coalesce(c.n, 0) AS n,
       round(coalesce(c.n, 0) / (nt * ((hi - lo) / {bins})), 9) AS density
FROM sp CROSS JOIN s LEFT JOIN c ON sp.bin = c.bin"""


@query("histogram10", _hist_sql(10))
def histogram10(spark, d):
    """10 equal-width bins, counts and density, empty bins included."""
    h = stats.histogram(t(spark, d, "events", "value"), "value", 10)
    return h.select("bin", _r("lower"), _r("upper"), "n", _r("density", 9))


@query("histogram_density", _hist_sql(100))
def histogram_density(spark, d):
    """100 bins with density = count / (n * width)."""
    h = stats.histogram(t(spark, d, "events", "value"), "value", 100)
    return h.select("bin", _r("lower"), _r("upper"), "n", _r("density", 9))


@query("boxplot_stats", """
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) q1, quantile_cont(value, 0.5) med,
                  quantile_cont(value, 0.75) q3 FROM events GROUP BY 1),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT e.event_type, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
       round(iqr, 6) AS iqr, round(lf, 6) AS lower_fence, round(uf, 6) AS upper_fence,
       round(min(value) FILTER (WHERE value >= lf AND value <= uf), 6) AS whisker_low,
       round(max(value) FILTER (WHERE value >= lf AND value <= uf), 6) AS whisker_high,
       count(*) FILTER (WHERE value < lf OR value > uf) AS n_outliers
FROM events e JOIN f USING (event_type) GROUP BY e.event_type, q1, med, q3, iqr, lf, uf""")
def boxplot_stats(spark, d):
    """The numbers behind a box plot, per group."""
    b = stats.boxplot_stats(t(spark, d, "events", "event_type", "value"), "event_type", "value")
    return b.select("event_type", *[_r(c) for c in ("q1", "median", "q3", "iqr", "lower_fence",
                                                    "upper_fence", "whisker_low", "whisker_high")],
                    "n_outliers")


@query("pct_return", """
SELECT event_id, user_id, round((value / nullif(prev, 0) - 1) * 100, 6) AS pct_return FROM (
  SELECT event_id, user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev
  FROM events) WHERE prev IS NOT NULL""")
def pct_return(spark, d):
    """Percentage change from the previous value of the same series."""
    e = t(spark, d, "events", "event_id", "user_id", "ts", "value")
    r = stats.pct_change(e, "user_id", ["ts", "event_id"], "value")
    return r.select("event_id", "user_id", _r("pct_return"))


_LAPLACE_FIT = """
f0 AS (SELECT quantile_cont(value, 0.5) AS loc FROM events),
fl AS (SELECT loc, avg(abs(value - loc)) AS scale, count(value) AS n FROM events, f0 GROUP BY loc)"""


@query("qq_laplace", f"""
WITH {_LAPLACE_FIT},
r AS (SELECT value, row_number() OVER (ORDER BY value, event_id) - 1 AS i FROM events)
SELECT i + 1 AS rank, value AS sample, round((i + 0.5) / n, 9) AS prob,
       round(CASE WHEN (i + 0.5) / n < 0.5 THEN loc + scale * ln(2 * (i + 0.5) / n)
                  ELSE loc - scale * ln(2 - 2 * (i + 0.5) / n) END, 6) AS theoretical
FROM r, fl""")
def qq_laplace(spark, d):
    """Ordered sample against fitted Laplace quantiles."""
    q = stats.qq_table(t(spark, d, "events", "event_id", "value"), "value", "laplace",
                       order_key="event_id")
    return q.select("rank", "sample", _r("prob", 9), _r("theoretical"))


def _rational(coef, x, plus_one=False):
    """Horner form of a polynomial as SQL."""
    sql = str(coef[0])
    for c in coef[1:]:
        sql = f"({sql} * {x} + {c})"
    return f"({sql} * {x} + 1)" if plus_one else sql


def _normal_quantile_sql(p):
    centre = f"({_rational(LF._NQ_A, f'(({p} - 0.5) * ({p} - 0.5))')} * ({p} - 0.5) / {_rational(LF._NQ_B, f'(({p} - 0.5) * ({p} - 0.5))', True)})"
    tail = lambda x: f"({_rational(LF._NQ_C, x)} / {_rational(LF._NQ_D, x, True)})"
    return (f"CASE WHEN {p} < 0.02425 THEN {tail(f'sqrt(-2 * ln({p}))')} WHEN {p} > 1 - 0.02425 THEN -{tail(f'sqrt(-2 * ln(1 - {p}))')} ELSE {centre} END")


@query("qq_normal", f"""
WITH r AS (SELECT value AS sample, row_number() OVER (ORDER BY value, event_id) AS rank, count(*) OVER () AS n FROM events WHERE value IS NOT NULL),
f AS (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events), p AS (SELECT *, (rank - 0.5) / n AS q FROM r, f)
SELECT rank, sample, round(q, 9) AS prob, round(m + s * {_normal_quantile_sql('q')}, 6) AS theoretical FROM p""")
def qq_normal(spark, d):
    """Ordered sample against fitted normal quantiles."""
    q = stats.qq_table(t(spark, d, "events", "event_id", "value"), "value", "normal",
                       order_key="event_id")
    return q.select("rank", "sample", _r("prob", 9), _r("theoretical"))


@query("fit_normal", """
SELECT round(avg(value), 6) AS loc, round(stddev_pop(value), 6) AS scale, count(value) AS n FROM events""")
def fit_normal(spark, d):
    """K2: maximum likelihood normal fit."""
    return stats.fit_normal(t(spark, d, "events", "value"), "value").select(
        _r("loc"), _r("scale"), "n")


@query("fit_laplace", f"""
WITH {_LAPLACE_FIT} SELECT round(loc, 6) AS loc, round(scale, 6) AS scale, n FROM fl""")
def fit_laplace(spark, d):
    """K3: Laplace fit: median and mean absolute deviation from it."""
    return stats.fit_laplace(t(spark, d, "events", "value"), "value").select(
        _r("loc"), _r("scale"), "n")


@query("fit_gamma", """
WITH a AS (SELECT avg(value) m, avg(ln(value)) ml, count(value) n FROM events WHERE value > 0),
s AS (SELECT ln(m) - ml AS s, m, n FROM a),
k AS (SELECT (3 - s + sqrt((s - 3) * (s - 3) + 24 * s)) / (12 * s) AS shape, m, n FROM s)
SELECT round(shape, 6) AS shape, round(m / shape, 6) AS scale, n FROM k""")
def fit_gamma(spark, d):
    """K4: two-parameter gamma fit by the closed-form shape estimate."""
    return stats.fit_gamma(t(spark, d, "events", "value"), "value").select(
        _r("shape"), _r("scale"), "n")


@query("gamma_density", """
WITH a AS (SELECT avg(value) m, avg(ln(value)) ml FROM events WHERE value > 0),
s AS (SELECT ln(m) - ml AS s, m FROM a),
k AS (SELECT (3 - s + sqrt((s - 3) * (s - 3) + 24 * s)) / (12 * s) AS shape, m FROM s),
f AS (SELECT shape, m / shape AS scale FROM k),
b AS (SELECT min(value) lo, max(value) hi, count(value) nt FROM events),
c AS (SELECT CAST(least(9, floor((value - lo) / ((hi - lo) / 10))) AS INTEGER) AS bin, count(*) AS n
      FROM events, b GROUP BY 1),
sp AS (SELECT CAST(unnest(range(0, 10)) AS INTEGER) AS bin),
h AS (SELECT sp.bin, lo + (sp.bin + 0.5) * ((hi - lo) / 10) AS centre,
             coalesce(c.n, 0) / (nt * ((hi - lo) / 10)) AS density
      FROM sp CROSS JOIN b LEFT JOIN c ON sp.bin = c.bin)
SELECT bin, round(density, 9) AS density,
       round(exp((shape - 1) * ln(centre) - centre / scale - shape * ln(scale) - lgamma(shape)), 9)
         AS gamma_density
FROM h, f""")
def gamma_density(spark, d):
    """Fitted gamma density at histogram bin centres (log-gamma of
    the shape from a pandas UDF on the one fit row)."""
    e = t(spark, d, "events", "value")
    fit = stats.fit_gamma(e, "value").withColumn("lg", LF.log_gamma(F.col("shape")))
    h = joins.attach_row(stats.histogram(e, "value", 10), fit.select("shape", "scale", "lg"))
    c = (F.col("lower") + F.col("upper")) / 2
    return h.select("bin", _r("density", 9),
                    F.round(LF.gamma_pdf(c, "shape", "scale", "lg"), 9).alias("gamma_density"))


@query("group_means_fit", """
WITH g AS (SELECT l_orderkey, avg(l_quantity) AS m FROM lineitem GROUP BY 1)
SELECT round(avg(m), 6) AS loc, round(stddev_pop(m), 6) AS scale, count(m) AS n FROM g""")
def group_means_fit(spark, d):
    """Distribution of per-order mean quantities, normal fit."""
    g = stats.group_means(t(spark, d, "lineitem", "l_orderkey", "l_quantity"),
                          "l_orderkey", "l_quantity")
    return stats.fit_normal(g, "group_mean").select(_r("loc"), _r("scale"), "n")


@query("density_vs_histogram", f"""
WITH s AS (SELECT min(value) lo, max(value) hi, count(value) nt, avg(value) mu,
                  stddev_pop(value) sd FROM events),
{_LAPLACE_FIT},
c AS (SELECT CAST(least(9, floor((value - lo) / ((hi - lo) / 10))) AS INTEGER) AS bin, count(*) AS n
      FROM events, s GROUP BY 1),
sp AS (SELECT CAST(unnest(range(0, 10)) AS INTEGER) AS bin),
h AS (SELECT sp.bin, lo + sp.bin * ((hi - lo) / 10) AS lower, lo + (sp.bin + 1) * ((hi - lo) / 10) AS upper,
             coalesce(c.n, 0) AS n, coalesce(c.n, 0) / (nt * ((hi - lo) / 10)) AS density, mu, sd
      FROM sp CROSS JOIN s LEFT JOIN c ON sp.bin = c.bin)
SELECT bin, round(lower, 6) AS lower, round(upper, 6) AS upper, h.n, round(density, 9) AS density,
       round((lower + upper) / 2, 6) AS centre,
       round(exp(-0.5 * power(((lower + upper) / 2 - mu) / sd, 2)) / (sd * sqrt(2 * pi())), 9)
         AS normal_density,
       round(exp(-abs((lower + upper) / 2 - loc) / scale) / (2 * scale), 9) AS laplace_density
FROM h, fl""")
def density_vs_histogram(spark, d):
    """Histogram density next to fitted normal and Laplace densities."""
    h = stats.density_vs_histogram(t(spark, d, "events", "value"), "value", 10)
    return h.select("bin", _r("lower"), _r("upper"), "n", _r("density", 9), _r("centre"),
                    _r("normal_density", 9), _r("laplace_density", 9))


@query("ztest_share", """
WITH a AS (SELECT count(*) AS n, count_if(event_type = 'purchase') AS observed FROM events)
SELECT n, observed, round((observed - n * 0.2) / sqrt(n * 0.2 * 0.8), 6) AS z,
       CASE WHEN (observed - n * 0.2) / sqrt(n * 0.2 * 0.8) > 1.959963984540054 THEN 'reject'
            ELSE 'not rejected' END AS verdict FROM a""")
def ztest_share(spark, d):
    """Is the purchase share above 0.2? z and verdict at 0.025."""
    z = stats.proportion_ztest(t(spark, d, "events", "event_type"),
                               F.col("event_type") == "purchase", 0.2)
    return z.select("n", "observed", _r("z"), "verdict")


@query("ztest_pvalue", f"""
WITH a AS (SELECT count(*)::DOUBLE AS n, count_if(event_type = 'purchase')::DOUBLE AS observed FROM events),
b AS (SELECT *, (observed - n * 0.2) / sqrt(n * 0.2 * 0.8) AS z FROM a)
SELECT n::BIGINT AS n, observed::BIGINT AS observed, round(z, 6) AS z, CASE WHEN z > 1.959963984540054 THEN 'reject' ELSE 'not rejected' END AS verdict,
       round({tails.normal_upper_tail_sql('z')}, 9) AS p_value FROM b""")
def ztest_pvalue(spark, d):
    """K1: the same test with its upper-tail p-value."""
    z = stats.proportion_ztest(t(spark, d, "events", "event_type"),
                               F.col("event_type") == "purchase", 0.2)
    p = stats.with_upper_p(z)
    return p.select("n", "observed", _r("z"), "verdict", _r("p_value", 9))


@query("trapezoid", """
WITH p AS (SELECT event_type, epoch_us(ts) / 86400000000.0 AS x, value AS y FROM events),
l AS (SELECT event_type, x, y, lag(x) OVER w AS px, lag(y) OVER w AS py FROM p
      WINDOW w AS (PARTITION BY event_type ORDER BY x, y))
SELECT event_type, round(sum((x - px) * (y + py) / 2), 6) AS area, count(*) AS points
FROM l GROUP BY 1""")
def trapezoid(spark, d):
    """K7: area under value(time in days) per event type, trapezoid rule."""
    e = t(spark, d, "events", "event_type", "ts", "value")
    p = e.select("event_type", (F.unix_micros(F.col("ts").cast("timestamp")) / 86400000000.0)
                 .alias("x"), F.col("value").alias("y"))
    return stats.trapezoid(p, "x", "y", by="event_type").select("event_type", _r("area"), "points")


@query("sum_of_histograms", """
WITH a AS (SELECT round(l_discount, 2) AS v, count(*) / (SELECT count(*) FROM lineitem) AS p
           FROM lineitem GROUP BY 1),
b AS (SELECT round(l_tax, 2) AS v, count(*) / (SELECT count(*) FROM lineitem) AS p
      FROM lineitem GROUP BY 1)
SELECT round(a.v + b.v, 2) AS value, round(sum(a.p * b.p), 9) AS p FROM a CROSS JOIN b GROUP BY 1""")
def sum_of_histograms(spark, d):
    """K8: distribution of discount + tax as independent variables."""
    li = t(spark, d, "lineitem", "l_discount", "l_tax")
    n = li.agg(F.count(F.lit(1)).alias("_n"))

    def pmf(c):
        g = li.groupBy(F.round(c, 2).alias("value")).agg(F.count(F.lit(1)).alias("_c"))
        return joins.attach_row(g, n).select("value", (F.col("_c") / F.col("_n")).alias("p"))
    s = stats.sum_distribution(pmf("l_discount"), pmf("l_tax"))
    return s.groupBy(F.round("value", 2).alias("value")).agg(F.round(F.sum("p"), 9).alias("p"))


@query("interval_share", """
SELECT round(avg(CAST(value > 10 AND value <= 50 AS DOUBLE)), 9) AS share, count(value) AS n FROM events""")
def interval_share(spark, d):
    """Empirical share of values in (10, 50]."""
    return stats.interval_share(t(spark, d, "events", "value"), "value", 10, 50).select(
        _r("share", 9), "n")


# --- samples and splits: the draw is a seeded md5, which the oracle repeats ---------

@query("sample_n", """
SELECT * FROM orders ORDER BY CAST(('0x' || substr(md5('7:' || o_orderkey), 1, 13)) AS BIGINT) / 4503599627370496.0, o_orderkey LIMIT 3""")
def sample_n(spark, d):
    """3 rows without replacement."""
    return sampling.sample_n(t(spark, d, "orders"), 3, ["o_orderkey"], seed=7)


@query("sample_frac", """
SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (ORDER BY CAST(('0x' || substr(md5('1:' || o_orderkey), 1, 13)) AS BIGINT) / 4503599627370496.0, o_orderkey) AS r FROM orders)
WHERE r <= (SELECT round(count(*) * 0.01) FROM orders)""")
def sample_frac(spark, d):
    """Exactly round(0.01 n) rows without replacement, seeded."""
    return sampling.sample_fraction(t(spark, d, "orders"), 0.01, ["o_orderkey"], seed=1)


@query("sample_replace", """
WITH o AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders),
j AS (SELECT unnest(range(CAST((SELECT round(count(*) * 0.01) FROM orders) AS BIGINT))) AS draw),
k AS (SELECT draw, CAST(('0x' || substr(md5('1:' || draw), 1, 13)) AS BIGINT) % (SELECT count(*) FROM orders) AS pos FROM j)
SELECT draw, o.* EXCLUDE (pos) FROM k JOIN o USING (pos)""")
def sample_replace(spark, d):
    """Exactly round(0.01 n) draws with replacement, seeded."""
    return sampling.sample_with_replacement(t(spark, d, "orders"), 0.01, ["o_orderkey"], seed=1)


@query("split_random", """
SELECT doc_id, source, CASE WHEN CAST(('0x' || substr(md5('42:' || doc_id), 1, 13)) AS BIGINT) / 4503599627370496.0 < 0.7 THEN 'train' ELSE 'test' END AS split FROM documents""")
def split_random(spark, d):
    """70/30 split by seeded hash of the key."""
    return sampling.split_random(t(spark, d, "documents", "doc_id", "source"), 0.3, ["doc_id"])


@query("split_group", """
WITH g AS (SELECT source, row_number() OVER (ORDER BY CAST(('0x' || substr(md5('0:' || source), 1, 13)) AS BIGINT) / 4503599627370496.0, source) - 1 AS r FROM (SELECT DISTINCT source FROM documents))
SELECT doc_id, source, CASE WHEN r < floor((SELECT count(*) FROM g) * 0.9) THEN 'training' ELSE 'heldout' END AS split
FROM documents JOIN g USING (source)""")
def split_group(spark, d):
    """90/10 split with whole sources on one side."""
    return sampling.split_groups(t(spark, d, "documents", "doc_id", "source"), "source", 0.9)


@query("kfold_hash", """
SELECT doc_id, CAST((row_number() OVER (ORDER BY CAST(('0x' || substr(md5('42:' || doc_id), 1, 13)) AS BIGINT) / 4503599627370496.0, doc_id) - 1) % 5 AS INTEGER) AS fold FROM documents""")
def kfold_hash(spark, d):
    """Shuffled 5-fold assignment."""
    return sampling.kfold_hash(t(spark, d, "documents", "doc_id"), 5, ["doc_id"])


@query("split_position", """
SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 < floor(count(*) OVER () * 0.8)
                    THEN 'train' ELSE 'test' END AS split FROM documents""")
def split_position(spark, d):
    """First 80 % by position are training."""
    return sampling.split_position(t(spark, d, "documents", "doc_id"), 0.8, ["doc_id"]) \
        .select("doc_id", "split")


_KFOLD_SQL = """
WITH k AS (SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1)
                                     / (floor(count(*) OVER () / 10) + 1)) AS INTEGER) AS fold
           FROM documents)"""


@query("kfold_contiguous", _KFOLD_SQL + " SELECT doc_id, fold FROM k")
def kfold_contiguous(spark, d):
    """Contiguous folds of size int(n / 10) + 1."""
    return sampling.kfold_contiguous(t(spark, d, "documents", "doc_id"), 10, ["doc_id"]) \
        .select("doc_id", "fold")


@query("all_but_fold", _KFOLD_SQL + " SELECT doc_id, fold FROM k WHERE fold <> 0")
def all_but_fold(spark, d):
    """Training rows of fold 0 = every other fold."""
    return joins.all_but(kfold_contiguous(spark, d), "fold", 0)


@query("stratified_fold", """
SELECT *, CAST((row_number() OVER (PARTITION BY quality ORDER BY CAST(('0x' || substr(md5('42:' || doc_id), 1, 13)) AS BIGINT) / 4503599627370496.0, doc_id) - 1) % 5 AS INTEGER) AS fold FROM labels""")
def stratified_fold(spark, d):
    """5 folds stratified by the quality label."""
    return sampling.stratified_folds(t(spark, d, "labels"), 5, "quality", ["doc_id"])


@query("binning_smooth", """
WITH b AS (SELECT l_quantity, CAST(ntile(3) OVER (ORDER BY l_quantity, l_orderkey, l_linenumber) AS INTEGER) AS bin FROM lineitem),
m AS (SELECT bin, min(l_quantity) AS lo, max(l_quantity) AS hi FROM b GROUP BY 1)
SELECT bin, CASE WHEN l_quantity - lo <= hi - l_quantity THEN lo ELSE hi END AS smoothed, count(*) AS n
FROM b JOIN m USING (bin) GROUP BY 1, 2""")
def binning_smooth(spark, d):
    """Equal-frequency bins into 3, smoothing by bin boundaries."""
    s = clean.smooth_by_bin_bounds(t(spark, d, "lineitem", "l_quantity", "l_orderkey", "l_linenumber"),
                                   "l_quantity", 3, ["l_quantity", "l_orderkey", "l_linenumber"])
    return s.groupBy("bin", "smoothed").agg(F.count(F.lit(1)).alias("n"))


@query("minmax", """
SELECT event_id, round((value - (SELECT min(value) FROM events))
                       / ((SELECT max(value) FROM events) - (SELECT min(value) FROM events)), 9)
       AS value FROM events""")
def minmax(spark, d):
    """Min-max normalisation."""
    m = clean.minmax_scale(t(spark, d, "events", "event_id", "value"), ["value"], keep=["event_id"])
    return m.select("event_id", _r("value", 9))


@query("chi2", """
WITH o AS (SELECT quality, toxic, count(*) AS o FROM labels GROUP BY 1, 2),
ra AS (SELECT quality, sum(o) AS ra FROM o GROUP BY 1),
cb AS (SELECT toxic, sum(o) AS cb FROM o GROUP BY 1),
e AS (SELECT o.o, ra * cb / (SELECT sum(o) FROM o) AS e FROM o JOIN ra USING (quality) JOIN cb USING (toxic))
SELECT round(sum((o - e) * (o - e) / e), 6) AS chi2, count(*) AS cells,
       sum((o - e) * (o - e) / e) > 10.828 AS reject_at_0001 FROM e""")
def chi2(spark, d):
    """Chi-square test of quality x toxic."""
    c = stats.chi_square_2x2(t(spark, d, "labels", "quality", "toxic"), "quality", "toxic")
    return c.select(_r("chi2"), "cells", "reject_at_0001")

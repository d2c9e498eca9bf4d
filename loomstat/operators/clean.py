"""Cleaning, duplicates and discretisation.

Column statistics (median, mean, deviation, min/max, quantile edges) are
computed in one aggregate pass that yields a single row, attached with a
bounded broadcast (``joins.attach_row``); the per-row work stays a narrow
projection.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.operators.joins import attach_row


def nullify(df: DataFrame, sentinels: dict[str, object]) -> DataFrame:
    """Sentinel value -> NULL (``replace('?', NaN)``)."""
    return df.select(*[F.nullif(F.col(c), F.lit(sentinels[c])).alias(c)
                       if c in sentinels else F.col(c) for c in df.columns])


def missing_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """A11 + A12: NULLs per column in one pass, unpivoted to long form."""
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return agg.unpivot(["n_rows"], cols, "column_name", "n_missing")


def fill_with(df: DataFrame, cols: list[str], stat: str = "median",
              digits: dict[str, int] | None = None) -> DataFrame:
    """Fill NULLs with the column median or mean, then optionally
    round half-to-even (pandas ``round``)."""
    if stat == "mean":
        stats = df.agg(*[F.avg(c).alias(f"_s_{c}") for c in cols])
    else:
        from loomstat.operators.stats import quantile_frame
        stats = None
        for c in cols:  # one exact-median row per column
            m = quantile_frame(df, c, [0.5]).select(F.get("_q", 0).alias(f"_s_{c}"))
            stats = m if stats is None else stats.join(F.broadcast(m), how="inner")
    out = attach_row(df, stats)
    for c in cols:
        v = F.coalesce(F.col(c), F.col(f"_s_{c}"))
        if digits and c in digits:
            v = F.bround(v, digits[c])
        out = out.withColumn(c, v)
    return out.drop(*[f"_s_{c}" for c in cols])


def drop_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """D3: ``dropna()``."""
    return df.na.drop("any", subset=cols)


def zscores(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """``(x - mean) / sample std``; NULLs stay NULL, and a constant column
    has no z-score (NULL, pandas' NaN)."""
    stats = df.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                   *[F.stddev_samp(c).alias(f"_d_{c}") for c in cols])
    z = attach_row(df, stats)
    return z.select(*(keep or []),
                    *[F.try_divide(F.col(c) - F.col(f"_m_{c}"), F.col(f"_d_{c}")).alias(c) for c in cols])


def within_bounds(cols: list[str], lo: float = -3.0, hi: float = 3.0) -> Column:
    """Every column in ``(lo, hi]``; a NULL cell fails (pandas compares False)."""
    return reduce(lambda a, b: a & b,
                  [F.coalesce((F.col(c) > lo) & (F.col(c) <= hi), F.lit(False)) for c in cols])


def drop_outliers(df: DataFrame, cols: list[str], keep: list[str] | None = None,
                  return_z: bool = True) -> DataFrame:
    """Rows whose z-score is in (-3, 3] on every column.

    ``return_z`` keeps z-scores, as the reference's ``Z2`` does (2.9-11);
    otherwise the kept rows' raw values are returned.
    """
    if return_z:
        return zscores(df, cols, keep=keep).filter(within_bounds(cols))
    zc = [f"_z_{c}" for c in cols]
    z = zscores(df.select(*df.columns, *[F.col(c).alias(f"_z_{c}") for c in cols]),
                zc, keep=df.columns)
    return z.filter(within_bounds(zc)).drop(*zc)


def row_digest(cols: list[str]) -> Column:
    """SHA-256 of the row's values (NULL-aware JSON of the columns): a
    32-byte stand-in for wide rows as a grouping / join key."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in cols])), 256)


def duplicate_flags(df: DataFrame, cols: list[str], order: str) -> DataFrame:
    """``duplicated()``: a row equal (on ``cols``) to an earlier row.

    The first occurrence per value group is found by an aggregate keyed by
    the row digest (map-side partial ``min``, so a hot group collapses
    before the shuffle, and 32-byte keys move instead of whole texts) and
    joined back on the digest; no window has to hold a whole group.
    """
    d = df.withColumn("_d", row_digest(cols))
    first = d.groupBy("_d").agg(F.min(order).alias("_first"))
    return (d.join(first, "_d")
            .withColumn("is_duplicate", F.col(order) != F.col("_first"))
            .drop("_d", "_first"))


def duplicate_count(df: DataFrame, cols: list[str]) -> DataFrame:
    """Number of duplicate rows = rows - distinct rows (one pass)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_distinct(row_digest(cols)).alias("n_distinct")).withColumn(
        "n_duplicates", F.col("n_rows") - F.col("n_distinct"))


def dedup(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``drop_duplicates()`` (hash aggregate, map-side combine)."""
    return df.dropDuplicates(cols) if cols else df.dropDuplicates()


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency of each value."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def map_values(col: str, mapping: dict, strict: bool = True) -> Column:
    """Fixed lookup; with ``strict`` an unmapped value raises an
    error naming it (the reference's ``KeyError``)."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    v = F.try_element_at(m, F.col(col))
    if strict:
        v = F.when(v.isNotNull(), v).otherwise(
            F.raise_error(F.concat(F.lit("unmapped label: "), F.col(col).cast("string"))))
    return v


def cut_equal_width(df: DataFrame, col: str, k: int) -> DataFrame:
    """``pd.cut(x, k)``: right-closed equal-width bins; the lowest edge
    is lowered by 0.1 % of the range so the minimum falls in bin 1.
    Adds ``bin`` (1..k; NULL for a NULL value), ``lower`` and ``upper``. A
    constant column is cut over 0.1 % of its value on either side."""
    b = df.agg(F.min(col).cast("double").alias("_mn"), F.max(col).cast("double").alias("_mx"))
    same = F.col("_mn") == F.col("_mx")
    pad = F.when(F.col("_mn") == 0, F.lit(0.001)).otherwise(F.abs("_mn") * 0.001)
    b = b.select(F.when(same, F.col("_mn") - pad).otherwise(F.col("_mn")).alias("_mn"),
                 F.when(same, F.col("_mx") + pad).otherwise(F.col("_mx")).alias("_mx"), same.alias("_same"))
    t = attach_row(df, b)
    w = (F.col("_mx") - F.col("_mn")) / k
    binno = F.when(F.col("_same"), F.lit((k + 1) // 2)).otherwise(
        F.greatest(F.lit(1), F.least(F.lit(k), F.ceil((F.col(col) - F.col("_mn")) / w))))
    return (t.withColumn("bin", F.when(F.col(col).isNotNull(), binno.cast("int")))
            .withColumn("lower", F.when((F.col("bin") == 1) & ~F.col("_same"),
                                        F.col("_mn") - (F.col("_mx") - F.col("_mn")) * 0.001)
                        .otherwise(F.col("_mn") + (F.col("bin") - 1) * w))
            .withColumn("upper", F.col("_mn") + F.col("bin") * w)
            .drop("_mn", "_mx", "_same"))


def cut_equal_depth(df: DataFrame, col: str, k: int) -> DataFrame:
    """``pd.qcut(x, k)``: edges are exact interpolated quantiles; bins
    right-closed, the lowest edge included; repeated edges raise."""
    probs = [i / k for i in range(k + 1)]
    from loomstat.operators.stats import quantile_frame
    t = attach_row(df, quantile_frame(df, col, probs, name="_e"))
    strictly = F.forall(F.sequence(F.lit(1), F.lit(k)),
                        lambda i: F.get("_e", i) > F.get("_e", i - 1))
    t = t.withColumn("_e", F.when(strictly, F.col("_e")).otherwise(
        F.raise_error(F.lit("repeated bin edges")).cast("array<double>")))
    binno = F.lit(k)
    for i in range(k - 1, 0, -1):
        binno = F.when(F.col(col) <= F.get("_e", i), F.lit(i)).otherwise(binno)
    return (t.withColumn("bin", F.when(F.col(col).isNotNull(), binno.cast("int")))
            .withColumn("lower", F.get("_e", F.col("bin") - 1))
            .withColumn("upper", F.get("_e", F.col("bin")))
            .drop("_e"))


def minmax_scale(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """``(x - min) / (max - min)``; NULL for a constant column (pandas' NaN)."""
    s = df.agg(*[F.min(c).alias(f"_lo_{c}") for c in cols],
               *[F.max(c).alias(f"_hi_{c}") for c in cols])
    t = attach_row(df, s)
    return t.select(*(keep or []), *[F.try_divide(F.col(c) - F.col(f"_lo_{c}"),
                                                  F.col(f"_hi_{c}") - F.col(f"_lo_{c}")).alias(c)
                                     for c in cols])


def smooth_by_bin_bounds(df: DataFrame, col: str, k: int, order: list[str]) -> DataFrame:
    """``k`` bins of equal counts by rank in ``order`` (the first bins take
    the remainder, as ``ntile``), each value replaced by the nearer of its
    bin's min and max (ties to the min). NULL values have no bin and are left out.

    Ranks come from the distributed ``ordered_index``; the ``k`` bounds are
    folded into one row and attached, so no bin is gathered in one task.
    """
    from loomstat.operators.sampling import ordered_index
    idx = ordered_index(df.filter(F.col(col).isNotNull()), order, "_i")
    n = df.agg(F.count(col).alias("_n"))
    t = attach_row(idx, n)
    q, rem = F.floor(F.col("_n") / k), F.col("_n") % k
    binno = F.when(F.col("_i") < rem * (q + 1), F.floor(F.col("_i") / (q + 1))).otherwise(
        rem + F.floor(F.try_divide(F.col("_i") - rem * (q + 1), q))) + 1
    t = t.withColumn("bin", binno.cast("int")).drop("_i", "_n")
    bounds = t.groupBy("bin").agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    one = bounds.agg(F.map_from_entries(F.collect_list(F.struct("bin", F.struct("lo", "hi")))).alias("_b"))  # k entries
    out = attach_row(t, one).withColumn("_b", F.col("_b")[F.col("bin")])
    out = out.withColumn("bin_min", F.col("_b.lo")).withColumn("bin_max", F.col("_b.hi")).drop("_b")
    near = F.when(F.col(col) - F.col("bin_min") <= F.col("bin_max") - F.col(col),
                  F.col("bin_min")).otherwise(F.col("bin_max"))
    return out.withColumn("smoothed", near)

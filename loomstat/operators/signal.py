"""Signal features on long tables ``(id, pos, x)``.

Per-id statistics are hash aggregates joined back where a row needs them
(no windows keyed by id, so one long signal does not land in one task);
consecutive samples are paired by a position self-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomstat.operators.ranges import with_previous


def peak_scaled(df: DataFrame, id_col: str, x: str) -> DataFrame:
    """``x / max(|x|)`` per id."""
    peak = df.groupBy(id_col).agg(F.max(F.abs(x)).alias("_peak"))
    return df.join(peak, id_col).withColumn(
        "scaled", F.when(F.col("_peak") > 0, F.col(x) / F.col("_peak"))).drop("_peak")


def track_summary(df: DataFrame, id_col: str, x: str) -> DataFrame:
    """Mean and deviation of a track with missing frames (0 when all are
    missing) and the share of present frames."""
    return df.groupBy(id_col).agg(
        F.coalesce(F.avg(x), F.lit(0.0)).alias("track_mean"),
        F.coalesce(F.stddev_pop(x), F.lit(0.0)).alias("track_std"),
        F.avg(F.col(x).isNotNull().cast("double")).alias("present_share"))


def signal_features(df: DataFrame, id_col: str, order: list[str], x: str,
                    track: str | None = None, min_len: int = 2) -> DataFrame:
    """G1 power, G3 zero-crossing rate (of the mean-centred signal) and
    G7 track summary per id; ids shorter than ``min_len`` are skipped (P23)."""
    s = peak_scaled(df, id_col, x)
    mean = s.groupBy(id_col).agg(F.avg("scaled").alias("_mu"))
    c = s.join(mean, id_col).withColumn("_c", F.col("scaled") - F.col("_mu"))
    p = with_previous(c, order, ["_c"], by=id_col)
    cross = (F.signum("_c") != F.signum("prev__c")).cast("double")
    base = p.groupBy(id_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("scaled") * F.col("scaled")).alias("power"),
        (F.sum(F.when(F.col("prev__c").isNotNull(), cross)) /
         (F.count(F.lit(1)) - 1)).alias("zcr"))
    out = base.filter(F.col("n") >= min_len)
    if track:
        out = out.join(track_summary(df, id_col, track), id_col)
    return out


def spectrum_features(df: DataFrame, id_col: str, pos: str, m: str,
                      rolloff: float = 0.85) -> DataFrame:
    """G4 centroid, G5 bandwidth, G6 roll-off of magnitude spectra."""
    tot = df.groupBy(id_col).agg(F.sum(m).alias("_sm"),
                                 (F.sum(F.col(pos) * F.col(m)) / F.sum(m)).alias("centroid"))
    t = df.join(tot, id_col)
    # a spectrum has a fixed bin count, so this window is bounded per id
    w = (Window.partitionBy(id_col).orderBy(pos)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    t = t.withColumn("_cum", F.sum(m).over(w))
    return t.groupBy(id_col, "centroid").agg(
        F.sqrt(F.sum(F.col(m) * (F.col(pos) - F.col("centroid")) ** 2) / F.first("_sm")).alias("bandwidth"),
        F.min(F.when(F.col("_cum") >= rolloff * F.col("_sm"), F.col(pos))).alias("rolloff"))

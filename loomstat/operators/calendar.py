"""Calendar aggregates (A1, A4, A5) over month or year periods.

All are hash aggregates with map-side partial aggregation; the period key
is computed before the shuffle so only (period, partial) rows move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.functions import month_start, month_text


def count_by_month(df: DataFrame, ts: str, sep: str = "-") -> DataFrame:
    """A1 + F1 + F2: rows per ``MM-yyyy`` month, with the month's first day."""
    return (df.select(month_text(ts, sep).alias("month"))
            .groupBy("month").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("month_start", month_start("month", sep)))


def mean_by_month(df: DataFrame, ts: str, value: str, digits: int = 2,
                  sep: str = "-") -> DataFrame:
    """A4: mean per month through Spark's (sum, count) partial buffer."""
    return (df.select(month_text(ts, sep).alias("month"), F.col(value))
            .groupBy("month")
            .agg(F.round(F.avg(value), digits).alias("mean_value"),
                 F.count(F.lit(1)).alias("n")))


def calendar_sum(df: DataFrame, ts: str, value: str, unit: str = "month") -> DataFrame:
    """A5: sum per calendar month or year; empty periods give 0.

    The period spine is generated from the data's min and max (one summary
    row, exploded to one row per period, so its size is the number of
    periods, not of rows) and left-joined to the per-period sums. The label
    is the period end, as pandas' ``Grouper(freq='M'|'Y')`` labels it.
    """
    trunc = "MM" if unit == "month" else "year"
    step = F.expr("INTERVAL 1 MONTH") if unit == "month" else F.expr("INTERVAL 1 YEAR")
    per = (df.select(F.trunc(F.col(ts).cast("date"), trunc).alias("period"), F.col(value))
           .groupBy("period").agg(F.sum(value).alias("total"),
                                  F.count(value).alias("n")))
    bounds = per.agg(F.min("period").alias("lo"), F.max("period").alias("hi"))
    spine = bounds.select(F.explode(F.sequence("lo", "hi", step)).alias("period"))
    end: Column = F.last_day("period") if unit == "month" else \
        F.make_date(F.year("period"), F.lit(12), F.lit(31))
    return (spine.join(per, "period", "left")
            .select(end.alias("period_end"),
                    F.coalesce("total", F.lit(0.0)).alias("total"),
                    F.coalesce("n", F.lit(0)).alias("n")))

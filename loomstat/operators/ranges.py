"""The previous row of a series in one shuffle.

Rows are dealt to ranges of their sort key, each range is sorted once and
``lag`` runs inside it; the first row of a range takes its value from a table
with one carry row for each range. A range is a slice of the whole order, not a
series, so one series that holds most rows is spread over many ranges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomstat.operators.joins import attach_row

SAMPLE = 20_000  # keys that shape the ranges, at most


def range_bounds(df: DataFrame, keys: list[str], ranges: int, sample: int = SAMPLE) -> DataFrame:
    """One row: ``_bounds``, the sorted keys that part the order into ``ranges``.

    The keys with the least hashes are a uniform sample, the same one whenever
    the plan is computed again, so nothing has to be written down to keep
    positions consistent. Its size is bounded whatever the input.
    """
    each = df.select(F.struct(*keys).alias("k"))
    some = each.orderBy(F.xxhash64("k"), "k").limit(sample)
    n, step = F.size("all"), F.greatest(F.size("all") / F.lit(ranges), F.lit(1.0))
    at = F.transform(F.sequence(F.lit(1), F.lit(max(ranges - 1, 1))), lambda i: F.floor(i * step).cast("int"))
    inside = F.filter(at, lambda i: (i < n) & F.lit(ranges > 1))
    return (some.agg(F.array_sort(F.collect_list("k")).alias("all"))
            .select(F.transform(inside, lambda i: F.get("all", i)).alias("_bounds")))


def range_of(bounds: str, keys: list[str], ranges: int):
    """Number of bounds at or below the row's key, by binary search."""
    key = F.struct(*keys)
    halves = [1 << i for i in reversed(range(max(1, ranges.bit_length())))]
    return F.aggregate(
        F.array(*[F.lit(h) for h in halves]), F.lit(0),
        lambda lo, h: F.when((lo + h <= F.size(bounds)) & (F.get(bounds, lo + h - 1) <= key), lo + h).otherwise(lo))


def with_previous(df: DataFrame, order: list[str], cols: list[str], by: str | None = None,
                  ranges: int | None = None) -> DataFrame:
    """``prev_<col>``: the value of ``cols`` in the row before, in ``order`` (a
    total order) within ``by``; NULL on the first row of a series.

    NULL is a series of its own. One exchange of the rows by their range and
    one sort; the carry rows are a map-side combined maximum of each range.
    """
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = list(dict.fromkeys(([by] if by else []) + order))
    rows = attach_row(df, range_bounds(df, keys, n)).withColumn("_range", range_of("_bounds", keys, n)).drop("_bounds")
    kept = F.struct(*([F.col(by).alias("_by")] if by else []), *[F.col(c).alias(f"v{i}") for i, c in enumerate(cols)])
    last = rows.groupBy("_range").agg(F.max(F.struct(F.struct(*keys).alias("k"), kept.alias("kept")))["kept"].alias("_carry"))
    # one row for each range; an empty range has none, so the row before is the last range that has rows
    before = last.select("_range", F.lag("_carry").over(Window.orderBy("_range")).alias("_carry"))
    w = Window.partitionBy("_range").orderBy(*keys)
    lagged = rows.withColumn("_prev", F.lag(kept).over(w))
    out = lagged.join(F.broadcast(before), "_range", "left").withColumn("_prev", F.coalesce("_prev", "_carry"))
    same = F.col("_prev").isNotNull() & (F.col("_prev._by").eqNullSafe(F.col(by)) if by else F.lit(True))
    return out.select(*df.columns, *[F.when(same, F.col(f"_prev.v{i}")).alias(f"prev_{c}") for i, c in enumerate(cols)])

"""Sorts and top-k (O1-O6) with an explicit tie rule.

``top_k`` plans as ``TakeOrderedAndProject``: each partition keeps a heap of
k rows and only k x partitions rows reach the final merge, so no full sort
or single-partition window is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, value: str, *keys: str) -> DataFrame:
    """O1: ``takeOrdered(k, key=-v)``; ties broken by the keys ascending."""
    return df.orderBy(F.col(value).desc(), *[F.col(c).asc() for c in keys]).limit(k)


def head_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows of an explicit order."""
    return df.orderBy(*order).limit(n)


def row_slice(df: DataFrame, start: int, stop: int, *order: str) -> DataFrame:
    """Rows ``[start, stop)`` of an explicit order (``df[start:stop]``).

    The top ``stop`` rows are taken first (bounded heap), so the numbering
    window only ever sees ``stop`` rows.
    """
    from pyspark.sql import Window
    top = df.orderBy(*order).limit(stop)
    w = Window.orderBy(*order)
    return (top.withColumn("_pos", F.row_number().over(w) - 1)
            .filter(F.col("_pos") >= start).withColumnRenamed("_pos", "pos"))


def sort_by(df: DataFrame, *order) -> DataFrame:
    """Distributed range-partitioned sort."""
    return df.orderBy(*order)

"""Class balancing by exact draws.

One global index over (class, seeded hash, key) gives every row its position in
its class: position less the first position of the class, a minimum with map-side
combine. No window is keyed by a class, so one that holds most rows is spread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.operators.joins import attach_row, salted_join
from loomstat.operators.sampling import hash_int, ordered_index


def class_positions(df: DataFrame, label: str, key: list[str], seed: int) -> tuple[DataFrame, DataFrame]:
    """``(rows with _pos, classes(label, _c))``; NULL is a class of its own."""
    clashing = {"_u", "_p", "_start", "_c", "_pos"} & set(df.columns)
    if clashing:
        raise ValueError(f"columns {sorted(clashing)} are used here")
    idx = ordered_index(df.withColumn("_u", hash_int(seed, *key)), [label, "_u", *key], "_p")
    per = idx.groupBy(label).agg(F.min("_p").alias("_start"), F.count(F.lit(1)).alias("_c"))
    rows = salted_join(idx, per.select(label, "_start"), label).withColumn("_pos", F.col("_p") - F.col("_start"))
    return rows.drop("_u", "_p", "_start"), per.select(label, "_c")


def balance(df: DataFrame, label: str, key: list[str], seed: int = 0, how: str = "down", size: int | None = None) -> DataFrame:
    """Every class with exactly the same number of rows.

    ``down`` draws without replacement to the size of the smallest class (or
    ``size``, if no class is smaller: else it raises), ``up`` with replacement
    to the size of the largest (or ``size``), adding the number of the ``draw``.
    Draws follow the md5 of seed and key, so they repeat; ``key`` is unique.
    An empty table stays empty.
    """
    rows, classes = class_positions(df, label, key, seed)
    pick = F.min if how == "down" else F.max
    least, most = classes.agg(F.min("_c"), F.max("_c")).first()
    if least is None:
        return rows.drop("_pos") if how == "down" else rows.drop("_pos").withColumn("draw", F.lit(0).cast("long"))
    if how == "down":
        if size is not None and size > least:
            raise ValueError(f"a class has only {least} rows")
        target = classes.agg((F.lit(size) if size is not None else pick("_c")).cast("long").alias("_m"))
        return attach_row(rows, target).where(F.col("_pos") < F.col("_m")).drop("_pos", "_m")
    m = size if size is not None else most
    spark = df.sparkSession
    # classes x m draws; the class table is repeated for each part of the draws
    parts = max(1, -(-m // 100_000))
    spread = classes.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    draws = spark.range(int(m)).withColumnRenamed("id", "draw").withColumn("_part", (F.col("draw") % parts).cast("int"))
    drawn = draws.join(spread, "_part").withColumn("_pos", F.pmod(hash_int(seed, label, "draw"), F.col("_c"))).drop("_part", "_c")
    same = drawn.withColumnRenamed(label, "_label").withColumnRenamed("_pos", "_at")
    return rows.join(same, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_pos") == F.col("_at"))).drop("_pos", "_at", "_label")

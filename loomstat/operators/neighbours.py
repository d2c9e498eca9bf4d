"""Approximate nearest neighbours (M5) by random projections in several tables.

Each table cuts the space with random hyperplanes; a row's bits, read from the
first on, name ever smaller buckets. Where rows crowd, more bits are read:

1. equal training vectors are one point with a count per label, so copies never
   fill a bucket;
2. the points of each prefix are counted (map-side combined). A *leaf* is the
   shortest prefix with at most ``bucket`` points; a prefix of all bits is a
   leaf whatever it holds, and is dealt into pieces that a query meets one by
   one (nothing is cut off);
3. a query walks down to its leaf in every table; the points of these leaves are
   its candidates, so its work is bounded by tables x bucket and not by the
   number of training rows;
4. exact distances rank the candidates. A query with fewer than ``k``
   neighbours among them is answered by the exact blocked search instead.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomstat.operators import models

BITS = 24      # hyperplanes of a table
STEP = 2       # bits read at once
TABLES = 12
BUCKET = 512   # points of a leaf


def _planes(width: int, tables: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(tables * BITS, width))


def signatures(rows: DataFrame, width: int, tables: int, seed: int, centre: list[float]) -> DataFrame:
    """``rows(pid, vec)`` with ``table, bits``: one row for each table."""
    planes, mid = _planes(width, tables, seed), np.array(centre)
    weight = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)

    def go(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack([np.asarray(v, np.float64) for v in pdf["vec"]]) - mid
            bits = ((x @ planes.T) > 0).reshape(len(x), tables, BITS) @ weight
            yield pd.DataFrame({"pid": pdf["pid"].to_numpy().repeat(tables), "table": np.tile(np.arange(tables, dtype=np.int32), len(x)), "bits": bits.ravel()})

    return rows.select("pid", "vec").mapInPandas(go, "pid long, table int, bits long")


def leaves(points: DataFrame, bucket: int) -> DataFrame:
    """``table, depth, prefix, c``: the leaves that hold points, by their bits."""
    depth = F.explode(F.sequence(F.lit(0), F.lit(BITS), F.lit(STEP))).alias("depth")
    at = points.select("table", "bits", depth).withColumn("prefix", _prefix("bits", "depth"))
    count = at.groupBy("table", "depth", "prefix").agg(F.count(F.lit(1)).alias("c"))
    # a prefix is a leaf if it is small enough (or complete) and the one above it is not
    above = count.where(F.col("c") > bucket).select(
        F.col("table").alias("_t"), (F.col("depth") + STEP).alias("_d"), F.col("prefix").alias("_p"))
    small = count.where((F.col("c") <= bucket) | (F.col("depth") == BITS))
    found = small.join(above, (F.col("table") == F.col("_t")) & (F.col("depth") == F.col("_d")) & (F.shiftright("prefix", STEP) == F.col("_p")), "left_semi")
    return found.unionByName(small.where("depth = 0"))


def _prefix(bits: str, depth: str):
    return F.expr(f"shiftright({bits}, {BITS} - {depth})")


def approximate_neighbours(train: DataFrame, test: DataFrame, id_col: str, vec: str, label: str, k: int = 5,
                           tables: int = TABLES, bucket: int = BUCKET, seed: int = 11, piece: int = 4096) -> DataFrame:
    """``qid, tid, nlabel, dist, exact``: the ``k`` nearest training rows found
    for each test row (Euclidean, ties by id); ``exact`` marks the fallback.

    Rows with a NULL id or vector take no part. Fewer than ``k`` training rows
    give fewer neighbours; no training row gives none.
    """
    tr = train.where(F.col(id_col).isNotNull() & F.col(vec).isNotNull()).select(
        F.col(id_col).cast("long").alias("tid"), F.col(vec).cast("array<double>").alias("vec"), F.col(label).cast("long").alias("nlabel"))
    te = test.where(F.col(id_col).isNotNull() & F.col(vec).isNotNull()).select(F.col(id_col).cast("long").alias("pid"), F.col(vec).cast("array<double>").alias("vec"))
    # equal vectors are one point; the point keeps the k copies with the smallest ids, all that a query can need
    copies = tr.withColumn("_r", F.row_number().over(Window.partitionBy("vec").orderBy("tid"))).where(F.col("_r") <= k)
    points = copies.groupBy("vec").agg(F.min("tid").alias("pid"), F.collect_list(F.struct("tid", "nlabel")).alias("rows"))  # k entries
    points = points.persist()
    try_one = points.select(F.size("vec").alias("w")).limit(1).collect()
    exact_schema = "qid long, tid long, nlabel long, dist double, exact boolean"
    if not try_one:
        return train.sparkSession.createDataFrame([], exact_schema)
    width = try_one[0]["w"]
    mid = points.agg(*[F.avg(F.get("vec", i)) for i in range(width)]).first()
    centre = [float(m or 0.0) for m in mid]  # as many numbers as a vector has
    mine = signatures(points, width, tables, seed, centre).persist()
    leaf = leaves(mine, bucket).persist()
    deep = leaf.select("depth").distinct()  # at most BITS / STEP + 1 rows
    place = lambda df: df.join(F.broadcast(deep), how="inner").withColumn("prefix", _prefix("bits", "depth"))
    held = place(mine).join(leaf, ["table", "depth", "prefix"])
    # a leaf above the bucket (all bits equal) is dealt into pieces; a query meets each
    pieces = F.greatest(F.ceil(F.col("c") / F.lit(piece)), F.lit(1)).cast("int")
    held = held.withColumn("piece", F.pmod(F.xxhash64("pid"), pieces).cast("int")).select("table", "depth", "prefix", "piece", F.col("pid").alias("point"))
    asked = (place(signatures(te, width, tables, seed, centre)).join(leaf, ["table", "depth", "prefix"])
             .withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))).select("table", "depth", "prefix", "piece", F.col("pid").alias("qid")))
    pairs = asked.join(held, ["table", "depth", "prefix", "piece"]).select("qid", "point").distinct()
    square = F.aggregate(F.zip_with("a", "b", lambda x, y: (x - y) * (x - y)), F.lit(0.0).cast("double"), lambda s, v: s + v)
    near = (pairs.join(te.select(F.col("pid").alias("qid"), F.col("vec").alias("a")), "qid")
            .join(points.select(F.col("pid").alias("point"), F.col("vec").alias("b"), "rows"), "point")
            .select("qid", F.sqrt(square).alias("dist"), F.explode("rows").alias("r"))
            .select("qid", "r.tid", "r.nlabel", "dist"))
    # a query's candidates are at most tables x bucket points
    w = Window.partitionBy("qid").orderBy("dist", "tid")
    found = near.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r").persist()
    full = found.groupBy("qid").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select("qid")
    short = te.join(full, te["pid"] == full["qid"], "left_anti").select(F.col("pid").alias(id_col), F.col("vec").alias(vec))
    rest = models.nearest(tr.select(F.col("tid").alias(id_col), F.col("vec").alias(vec), F.col("nlabel").alias(label)), short, id_col, vec, label, k)
    return (found.join(full, "qid").select("qid", "tid", "nlabel", "dist", F.lit(False).alias("exact"))
            .unionByName(rest.select("qid", "tid", "nlabel", "dist", F.lit(True).alias("exact"))))


def neighbour_recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: share of the exact ``(qid, tid)`` neighbours that were found, and the counts."""
    hit = exact.select("qid", "tid").join(found.select("qid", "tid").withColumn("_hit", F.lit(1)), ["qid", "tid"], "left")
    return hit.agg(F.avg(F.coalesce("_hit", F.lit(0)).cast("double")).alias("recall"), F.count(F.lit(1)).alias("neighbours"), F.count_distinct("qid").alias("queries"))


def expected_work(tables: int, bucket: int, n: int) -> float:
    """Candidates of a query at most, as a share of ``n`` training rows."""
    return math.inf if not n else tables * bucket / n

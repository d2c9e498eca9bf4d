"""Samples, splits and folds.

Row order is always explicit (SURVEY 2.9-23). Positions come from
``ordered_index``: a distributed zipWithIndex written with DataFrame ops -
range-partition by the order key, number rows inside each partition,
then add the running total of the partitions before it (a table with one
row per partition, so its size is bounded by the partition count, not the
data). No step puts all rows into one task.

Random draws are seeded hashes of the row key, so a sample replays
exactly and does not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomstat.operators.joins import salted_join
from loomstat.session import cut_lineage

_HEX = 13  # digits: 52 bits, exact in a double


def hash_int(seed, *cols) -> Column:
    """Seeded 52-bit number from the row key: the first hex digits of the md5
    of ``seed:key[:key...]`` (NULL keys count as empty), so that any SQL
    engine draws the same sample."""
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    keys = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in cols]
    digits = F.substring(F.md5(F.concat_ws(":", seed, *keys)), 1, _HEX)
    return F.conv(digits, 16, 10).cast("bigint")


def hash_unit(seed: int, *cols) -> Column:
    """Seeded uniform number in [0, 1) from the row key."""
    return hash_int(seed, *cols) / F.lit(float(16 ** _HEX))


def ordered_index(df: DataFrame, order: list, name: str = "idx",
                  partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (which must be a total order).

    1. ``repartitionByRange`` on the order key (sampled bounds, balanced),
       then ``sortWithinPartitions``;
    2. ``monotonically_increasing_id`` on the sorted partitions encodes the
       range partition (high bits) and the row's rank inside it (low 33
       bits) - no second shuffle;
    3. per-partition counts -> exclusive running sum (one row per partition);
    4. position = offset of the partition + rank inside it.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordc = [F.col(c) if isinstance(c, str) else c for c in order]
    mid = F.monotonically_increasing_id()
    local = (df.repartitionByRange(n, *ordc).sortWithinPartitions(*ordc)
             .withColumn("_mid", mid)
             .withColumn("_pid", F.shiftright("_mid", 33))
             .withColumn("_ln", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
             .drop("_mid"))
    # Range bounds are sampled with a seed tied to the RDD id and the ids
    # depend on the partition a row lands in, so the numbered partitions are
    # materialised once (reliable checkpoint in the shared folder); counts
    # and rows then come from the same files, and lineage is cut.
    local = cut_lineage(local)
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.select(
        "_pid", (F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt")).alias("_off"))
    # offsets has at most `n` rows (one per range partition): bounded broadcast.
    return (local.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + F.col("_ln"))
            .drop("_pid", "_ln", "_off"))


def sample_n(df: DataFrame, n: int, key: list[str], seed: int = 0) -> DataFrame:
    """``sample(n)`` without replacement, exact size, seeded (top-n heap)."""
    return (df.withColumn("_u", hash_unit(seed, *key))
            .orderBy("_u", *key).limit(n).drop("_u"))


def sample_fraction(df: DataFrame, frac: float, key: list[str], seed: int = 0) -> DataFrame:
    """Exact ``round(frac * n)`` rows without replacement, seeded.

    Keys (with a hash of the row, should a key repeat) are ranked by their
    seeded hash with ``ordered_index``; the rows before the one at position
    ``m - 1`` are kept, and of the rows equal to it as many as are missing.
    """
    # only the keys are numbered; the rows are then filtered by the hash at the cut
    draw = df.withColumn("_u", hash_unit(seed, *key)).withColumn("_h", F.xxhash64(*df.columns))
    order = ["_u", *key, "_h"]
    m = df.agg(F.round(F.count(F.lit(1)) * F.lit(frac)).cast("long").alias("_m"))
    ranked = ordered_index(draw.select(*order), order, "_r").join(F.broadcast(m), F.col("_r") < F.col("_m"))
    me = F.struct(*order)
    last = ranked.agg(F.max(me).alias("_cut"))
    at_cut = ranked.join(F.broadcast(last), me == F.col("_cut")).count()
    draw = draw.join(F.broadcast(last), me <= F.col("_cut"))
    kept = draw.where(me < F.col("_cut")).unionByName(draw.where(me == F.col("_cut")).limit(at_cut))
    return kept.drop("_u", "_h", "_cut")


def sample_with_replacement(df: DataFrame, frac: float, key: list[str],
                            seed: int = 0) -> DataFrame:
    """Exactly ``round(frac * n)`` draws with replacement, seeded.

    Draw ``j`` picks position ``hash(seed, j) mod n``; the draws table is a
    distributed ``range`` joined to the positions by equi-join.
    """
    idx = ordered_index(df, key, "_pos")
    stats = df.agg(F.count(F.lit(1)).alias("_n"),
                   F.round(F.count(F.lit(1)) * F.lit(frac)).cast("long").alias("_m"))
    spark = df.sparkSession
    m = stats.select("_m").first()[0]  # one scalar: the number of draws
    draws = spark.range(int(m or 0)).withColumnRenamed("id", "draw")
    draws = (draws.join(F.broadcast(stats.select("_n")), how="inner")
             .withColumn("_pos", F.pmod(hash_int(seed, "draw"), F.col("_n")))
             .drop("_n"))
    return draws.join(idx, "_pos").drop("_pos")


def split_random(df: DataFrame, test_size: float, key: list[str], seed: int = 42,
                 name: str = "split") -> DataFrame:
    """Hash-based train/test flag, reproducible without a shuffle."""
    return df.withColumn(name, F.when(hash_unit(seed, *key) < 1 - test_size,
                                      F.lit("train")).otherwise(F.lit("test")))


def _cut_keys(df: DataFrame, order: list[str], positions: DataFrame) -> DataFrame:
    """Order-key values found at the given 0-based positions (column ``_at``).

    Only the key columns are numbered (and checkpointed); the result has one
    row per requested position.
    """
    keys = df.select(*order)
    idx = ordered_index(keys, order, "_at")
    return idx.join(F.broadcast(positions), "_at").select("_at", F.struct(*order).alias("_key"))


def split_position(df: DataFrame, frac: float, order: list[str],
                   name: str = "split") -> DataFrame:
    """First ``int(frac * n)`` rows in order are train, the rest test.

    A row is in the first ``cut`` positions exactly when its (unique) order
    key is below the key at position ``cut``; that one key is found by
    numbering the key columns only, then every row is flagged by a
    comparison - no wide rows are renumbered or shuffled.
    """
    cut = df.agg(F.floor(F.count(F.lit(1)) * F.lit(frac)).cast("long").alias("_at"))
    at = _cut_keys(df, order, cut)  # zero rows when cut == n: all train
    t = df.join(F.broadcast(at.select("_key")), how="left")
    is_train = F.col("_key").isNull() | (F.struct(*order) < F.col("_key"))
    return t.withColumn(name, F.when(is_train, F.lit("train")).otherwise(F.lit("test"))) \
        .drop("_key")


def split_groups(df: DataFrame, group: str, frac: float, seed: int = 0,
                 name: str = "split", yes: str = "training", no: str = "heldout") -> DataFrame:
    """Whole groups on one side: distinct groups ranked by seeded hash,
    the first ``int(frac * k)`` are training."""
    g = df.select(group).distinct()
    ranked = ordered_index(g.withColumn("_u", hash_unit(seed, group)), ["_u", group], "_g")
    cut = g.agg(F.floor(F.count(F.lit(1)) * F.lit(frac)).cast("long").alias("_cut"))
    flags = (ranked.join(F.broadcast(cut), how="inner")
             .select(group, F.when(F.col("_g") < F.col("_cut"), F.lit(yes))
                     .otherwise(F.lit(no)).alias(name)))
    return salted_join(df, flags, group)  # a group may hold most rows


def kfold_hash(df: DataFrame, k: int, key: list[str], seed: int = 42,
               name: str = "fold") -> DataFrame:
    """Shuffled k-fold: position in seeded-hash order, mod k."""
    idx = ordered_index(df.withColumn("_u", hash_unit(seed, *key)), ["_u", *key], "_p")
    return idx.withColumn(name, F.pmod(F.col("_p"), F.lit(k)).cast("int")).drop("_u", "_p")


def kfold_contiguous(df: DataFrame, k: int, order: list[str], name: str = "fold") -> DataFrame:
    """Contiguous folds of size ``int(n / k) + 1`` by position
    (so n = 23, k = 10 gives 8 folds, as the reference does).

    The first key of each fold (at most ``k`` keys) is found by numbering
    the key columns only; a row's fold is the number of fold starts at or
    below its key, minus one.
    """
    size = df.agg(F.count(F.lit(1)).alias("_n"),
                  (F.floor(F.count(F.lit(1)) / F.lit(k)) + 1).cast("long").alias("_fs"))
    starts = size.select(F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("_f"), "_n", "_fs") \
        .select((F.col("_f") * F.col("_fs")).alias("_at"), "_n").filter(F.col("_at") < F.col("_n")) \
        .select("_at")
    keys = _cut_keys(df, order, starts)
    one = keys.agg(F.collect_list("_key").alias("_starts"))  # at most k entries
    t = df.join(F.broadcast(one), how="inner")
    me = F.struct(*order)
    fold = F.size(F.filter("_starts", lambda s_: s_ <= me)) - 1
    return t.withColumn(name, fold.cast("int")).drop("_starts")


def stratified_folds(df: DataFrame, k: int, label: str, key: list[str], seed: int = 42,
                     name: str = "fold") -> DataFrame:
    """Per-class hash order, position within class mod k.

    One global ``ordered_index`` over (class, hash) and the class's first
    position (a per-class min, map-side combined) give the in-class
    position without a per-class window, so a dominant class is not
    funnelled into one task.
    """
    idx = ordered_index(df.withColumn("_u", hash_unit(seed, *key)), [label, "_u", *key], "_p")
    start = idx.groupBy(label).agg(F.min("_p").alias("_s"))
    # classes are few and may be huge; NULL is a class of its own
    return (salted_join(idx, start, label)
            .withColumn(name, F.pmod(F.col("_p") - F.col("_s"), F.lit(k)).cast("int"))
            .drop("_u", "_p", "_s"))


def prefix_sums(df: DataFrame, order: list, cols: list[str],
                partitions: int | None = None) -> DataFrame:
    """Inclusive running sums of ``cols`` in ``order`` without a
    single-partition window: per-range-partition windows plus partition
    offsets (one row per partition). Adds ``cum_<col>`` columns."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordc = [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(n, *ordc).withColumn("_pid", F.spark_partition_id())
    w = (Window.partitionBy("_pid").orderBy(*ordc)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged
    for c in cols:
        local = local.withColumn(f"_l_{c}", F.sum(c).over(w))
    local = cut_lineage(local)  # one materialisation for rows and totals
    tot = local.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    wo = Window.orderBy("_pid")
    offs = tot.select("_pid", *[(F.sum(f"_t_{c}").over(wo) - F.col(f"_t_{c}")).alias(f"_o_{c}")
                                for c in cols])
    out = local.join(F.broadcast(offs), "_pid")
    for c in cols:
        out = out.withColumn(f"cum_{c}", F.col(f"_o_{c}") + F.col(f"_l_{c}"))
    return out.drop("_pid", *[f"_l_{c}" for c in cols], *[f"_o_{c}" for c in cols])


def with_previous(df: DataFrame, order: list[str], cols: list[str],
                  by: str | None = None) -> DataFrame:
    """``lag(col)`` within ``by`` in ``order`` as a position self-join.

    Rows get a global position in (by, order); the previous row is the one
    at position - 1 when it belongs to the same group. The equi-join on a
    unique position is balanced however large one group is, unlike a window
    partitioned by a hot key. Adds ``prev_<col>`` (NULL on a group's first row).
    """
    keys = ([by] if by else []) + order
    idx = ordered_index(df, keys, "_pos")
    prev = idx.select((F.col("_pos") + 1).alias("_pos"),
                      *([F.col(by).alias("_pby")] if by else []),
                      *[F.col(c).alias(f"prev_{c}") for c in cols])
    j = idx.join(prev, "_pos", "left")
    if by:
        same = F.col("_pby") == F.col(by)
        for c in cols:
            j = j.withColumn(f"prev_{c}", F.when(same, F.col(f"prev_{c}")))
        j = j.drop("_pby")
    return j.drop("_pos")


def exact_quantiles(df: DataFrame, col: str, probs: list[float], by: str | None = None,
                    name: str = "_q") -> DataFrame:
    """Exact interpolated quantiles (numpy's linear rule, Spark's
    ``percentile``) without gathering a group's values in one task.

    1. counts per (group, value): map-side combined, so a value repeated in
       a third of the rows is one row after the partial aggregate;
    2. distributed running totals over the sorted distinct values
       (``prefix_sums``);
    3. for each probability ``p`` the positions ``floor(h)``, ``ceil(h)`` with
       ``h = (n - 1) p`` are located by a range join against a table of
       (groups x probabilities) rows, and interpolated.

    Returns one row per group with ``name`` = array of quantiles in the
    order of ``probs`` (NULL for an empty group).
    """
    g = [by] if by else []
    vals = df.select(*g, F.col(col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    cnt = vals.groupBy(*g, "_v").agg(F.count(F.lit(1)).alias("_c"))
    pre = prefix_sums(cnt, [*g, "_v"], ["_c"])
    ends = pre.select(*g, (F.col("cum__c") - F.col("_c")).alias("_lo"), F.col("cum__c").alias("_hi"), "_v")
    per = ends.groupBy(*g).agg(F.min("_lo").alias("_start"), (F.max("_hi") - F.min("_lo")).alias("_n"))
    pa = F.array(*[F.lit(float(p)) for p in probs])
    pos = (per.select(*g, "_start", "_n", F.posexplode(pa).alias("_i", "_p"))
           .withColumn("_h", (F.col("_n") - 1) * F.col("_p"))
           .withColumn("_klo", F.col("_start") + F.floor("_h"))
           .withColumn("_khi", F.col("_start") + F.ceil("_h")))
    inside = lambda k: (F.col("_lo") <= F.col(k)) & (F.col(k) < F.col("_hi"))
    cond = inside("_klo") | inside("_khi")
    if by:
        j = ends.join(pos.withColumnRenamed(by, "_by"), F.col(by).eqNullSafe(F.col("_by")) & cond)  # NULL is a group
    else:  # pos has one row per probability
        j = ends.join(F.broadcast(pos), cond, "inner")
    q = j.groupBy(*g, "_i", "_h").agg(
        F.max(F.when(inside("_klo"), F.col("_v"))).alias("_vlo"),
        F.max(F.when(inside("_khi"), F.col("_v"))).alias("_vhi"))
    q = q.withColumn("_x", F.col("_vlo") + (F.col("_h") - F.floor("_h")) * (F.col("_vhi") - F.col("_vlo")))
    return q.groupBy(*g).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x"))), lambda s: s["_x"]).alias(name))

"""Joins (J1-J10).

No join here carries a broadcast hint unless the small side has a proven
size bound (a one-row aggregate). Otherwise the planner picks the strategy
from statistics and AQE re-plans from measured shuffle sizes: sort-merge
for two large sides, broadcast when the measured side is under
``spark.sql.autoBroadcastJoinThreshold``, and skewed keys split by the AQE
skew-join rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a single-row summary (a global aggregate) to every row.

    A global aggregate without grouping has exactly one row, so broadcasting
    it is bounded whatever the input size.
    """
    return df.join(F.broadcast(one_row), how="inner")


def salted_join(rows: DataFrame, few: DataFrame, key: str, salts: int = 64) -> DataFrame:
    """Many rows against one row for each key, when a key may hold most rows.

    Every row takes one of ``salts`` by the hash of its values; each row of
    ``few`` is repeated for all of them, so a hot key is spread over that many
    join keys. NULL is a key like any other.
    """
    many = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int"))
    each = few.withColumnRenamed(key, "_key").withColumn("_each", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = many.join(each, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_salt") == F.col("_each")))
    return joined.select(*rows.columns, *[c for c in few.columns if c != key])


def equi_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Bag-semantics equi-join; duplicate keys multiply (2.9-4)."""
    return left.join(right, on, how)


def join_pre_aggregated(facts: DataFrame, dims: DataFrame, key_fact: str,
                        key_dim: str, value: str, total: str = "total") -> DataFrame:
    """J4 + J5 + P9: aggregate the fact side per key before the join, then
    keep dimension rows whose total is not NULL. Catalyst rewrites the
    left join + not-null filter into an inner join."""
    agg = facts.groupBy(F.col(key_fact).alias(key_dim)).agg(F.sum(value).alias(total))
    return dims.join(agg, key_dim, "left").filter(F.col(total).isNotNull())


def lookup(df: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Left lookup join with a ``has_label`` missing-key flag."""
    lab = labels.withColumn("_hit", F.lit(True))
    return (df.join(lab, key, "left")
            .withColumn("has_label", F.coalesce("_hit", F.lit(False))).drop("_hit"))


def flag_membership(df: DataFrame, keys: DataFrame, key: str, flag: str,
                    yes: str = "training", no: str = "heldout") -> DataFrame:
    """Membership flag from a key set (distinct keys, left join)."""
    k = keys.select(key).distinct().withColumn("_in", F.lit(True))
    return (df.join(k, key, "left")
            .withColumn(flag, F.when(F.col("_in"), F.lit(yes)).otherwise(F.lit(no)))
            .drop("_in"))


def semi(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the key set."""
    return df.join(keys.select(key), key, "left_semi")


def anti(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the key set."""
    return df.join(keys.select(key), key, "left_anti")


def all_but(df: DataFrame, fold_col: str, k: int | Column) -> DataFrame:
    """Rows of every fold except ``k``."""
    return df.filter(F.col(fold_col) != (k if isinstance(k, Column) else F.lit(k)))

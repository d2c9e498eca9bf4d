"""Catalogue registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomstat.sources import spread, table

# tables whose rows carry long texts: per-row tokenising dominates, so the
# scan is spread over the cluster's parallelism when it is too narrow
TEXT_TABLES = {"documents", "conversations", "pages", "benchmark"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _canonical_zero(sql: str) -> str:
    """Wrap each ``round(...)`` as ``(0.0 + round(...))``.

    DuckDB's ``round`` keeps the sign of a tiny negative (``-0.0``) while
    Spark's decimal-based rounding returns ``0.0``; adding ``0.0`` maps
    ``-0.0`` to ``0.0`` and changes no other value.
    """
    out, i, low = [], 0, sql.lower()
    while True:
        j = low.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (low[j - 1].isalnum() or low[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = _canonical_zero(sql[j + 6:k])
        out.append(sql[i:j] + "(0.0 + round(" + inner + "))")
        i = k + 1


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with optional oracle SQL."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _canonical_zero(sql.strip())
        return fn
    return deco


def t(spark: SparkSession, d: str, name: str, *cols: str) -> DataFrame:
    df = table(spark, d, name, *cols)
    if name in TEXT_TABLES and (not cols or "text" in cols):
        df = spread(df)
    return df

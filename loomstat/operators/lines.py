"""Well-formed-line predicates for comma-split text.

One predicate replaces the reference's per-job ``good_line`` functions: a
field count and a ``try_cast`` probe for exactly the fields that are used
(SURVEY 2.9-2). ``split_valid`` keeps both outcomes so rejects are counted
rather than dropped without trace.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.sources import field, split_fields


def well_formed(fields: Column, n_fields: int, typed: dict[int, str]) -> Column:
    """True when the line has ``n_fields`` fields and each typed field casts."""
    checks = [F.size(fields) == n_fields]
    checks += [field(fields, i).try_cast(t).isNotNull() for i, t in typed.items()]
    return reduce(lambda a, b: a & b, checks)


def reject_reason(fields: Column, n_fields: int, typed: dict[int, str]) -> Column:
    """Text naming the first failed check, NULL for a good line."""
    expr = F.when(F.size(fields) != n_fields, F.lit(f"width!={n_fields}"))
    for i, t in typed.items():
        expr = expr.when(field(fields, i).try_cast(t).isNull(), F.lit(f"field{i}:{t}"))
    return expr


def parse_lines(lines: DataFrame, n_fields: int, typed: dict[int, str],
                line_col: str = "value", sep: str = ",") -> DataFrame:
    """Split and tag every line: columns ``f`` (array<string>) and ``reject``."""
    f = split_fields(line_col, sep)
    return lines.select(f.alias("f")).withColumn(
        "reject", reject_reason(F.col("f"), n_fields, typed))


def good(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject").isNull())


def reject_counts(parsed: DataFrame) -> DataFrame:
    """Counted reject output: one row per failure reason."""
    return (parsed.filter(F.col("reject").isNotNull())
            .groupBy("reject").agg(F.count(F.lit(1)).alias("n_lines")))


def nan_to_null(c: Column) -> Column:
    """SURVEY 2.9-10: NaN becomes NULL at the edge."""
    return F.when(~F.isnan(c), c)

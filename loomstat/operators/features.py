"""Feature selection: the k best terms by their chi-square with the class (E5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.operators.joins import attach_row
from loomstat.operators.text import explode_tokens


def class_counts(df: DataFrame, doc: str, cls: str, tokens: str) -> tuple[DataFrame, DataFrame]:
    """``(term, cls, o)``: documents of the class that hold the term, and ``(cls, n)``."""
    rows = df.where(F.col(cls).isNotNull()).select(F.col(doc).alias("doc"), F.col(cls).alias("cls"), F.array_distinct(tokens).alias("tokens"))
    # a term is counted once for each document row: no distinct over exploded rows
    seen = explode_tokens(rows, ["cls"], "tokens", "term").groupBy("term", "cls").agg(F.count(F.lit(1)).alias("o"))
    return seen, rows.groupBy("cls").agg(F.count(F.lit(1)).alias("n"))


def chi_square_terms(seen: DataFrame, classes: DataFrame) -> DataFrame:
    """``term, df, chi2``: presence of each term against the classes.

    With ``N`` documents, ``n`` of a class and ``df`` with the term, the statistic
    sums ``(o - e)^2 / e`` over presence and absence, ``e = df n / N``. Classes
    that never hold the term add ``e`` for presence; they are the total less the
    classes seen, so no (term, class) table is filled up. A term in every
    document has chi-square 0.
    """
    total = classes.agg(F.sum("n").cast("double").alias("all"))
    df = seen.groupBy("term").agg(F.sum("o").alias("df"))
    cell = attach_row(seen.join(df, "term").join(classes, "cls"), total)
    e = F.col("df") * F.col("n") / F.col("all")
    # (o - e)^2 / e + (o - e)^2 / (n - e); for o = 0: e + e^2 / (n - e)
    absent = F.when(F.col("df") < F.col("all"), (F.col("o") - e) * (F.col("o") - e) / (F.col("n") - e)).otherwise(0.0)
    none = e + F.when(F.col("df") < F.col("all"), e * e / (F.col("n") - e)).otherwise(0.0)
    each = cell.groupBy("term", "df", "all").agg(F.sum((F.col("o") - e) * (F.col("o") - e) / e + absent).alias("with_term"), F.sum(none).alias("if_none"))
    # over all classes the "none" part sums to df + df^2 / (all - df), as n cancels
    whole = F.col("df") + F.when(F.col("df") < F.col("all"), F.col("df") * F.col("df") / (F.col("all") - F.col("df"))).otherwise(0.0)
    return each.select("term", F.col("df").cast("long").alias("df"), (F.col("with_term") + whole - F.col("if_none")).alias("chi2"))


def best_terms(df: DataFrame, doc: str, cls: str, tokens: str, k: int, digits: int = 6) -> DataFrame:
    """E5: ``term, df, chi2, rank`` of the ``k`` best terms; ties (to ``digits``) by term.

    ``df`` has one row for each document. Rows with a NULL class are left out.
    """
    c = chi_square_terms(*class_counts(df, doc, cls, tokens)).withColumn("chi2", F.round("chi2", digits))
    top = c.orderBy(F.desc("chi2"), "term").limit(k)
    ranks = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("chi2")).alias("less"), "term", "df"))).alias("all"))  # k entries
    return ranks.select(F.posexplode("all").alias("rank", "x")).select(
        "x.term", "x.df", (0.0 - F.col("x.less")).alias("chi2"), (F.col("rank") + 1).cast("int").alias("rank"))

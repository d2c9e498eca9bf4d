"""Classification metrics.

All metrics derive from the long confusion table ``(label, prediction, n)``
- one hash aggregate over the scored rows - whose size is the square of the
class count, so everything after it is tiny.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat import functions as LF
from loomstat.operators.sampling import prefix_sums


def confusion_long(df: DataFrame, label: str, pred: str, labels: list, other=None) -> DataFrame:
    """M9: counts for every (label, prediction) cell of a fixed label list,
    zero cells included.

    A row whose label or prediction is not in the list (or NULL) raises; with
    ``other`` it is counted under that value instead. No row is left out.
    """
    def known(c: str):
        says = F.concat(F.lit("label not in the list: "), F.coalesce(F.col(c).cast("string"), F.lit("NULL")))
        return F.when(F.col(c).isin(labels), F.col(c)).otherwise(F.raise_error(says) if other is None else F.lit(other))

    counts = df.groupBy(known(label).alias("label"), known(pred).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))
    arr = F.array(*[F.lit(v) for v in [*labels, *([] if other is None else [other])]])
    spine = (df.sparkSession.range(1)
             .select(F.explode(arr).alias("label"))
             .select("label", F.explode(arr).alias("prediction")))
    return (spine.join(counts, ["label", "prediction"], "left")
            .select("label", "prediction", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def confusion_matrix(df: DataFrame, label: str, pred: str, labels: list) -> DataFrame:
    """M9: rows = true label, one column per predicted label (fixed order)."""
    return (confusion_long(df, label, pred, labels).groupBy("label")
            .pivot("prediction", labels).agg(F.first("n")).na.fill(0))


def per_class(conf: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class; a class never
    predicted gets precision 0 rather than an error."""
    tp = conf.filter(F.col("label") == F.col("prediction")).select(
        F.col("label").alias("cls"), F.col("n").alias("tp"))
    sup = conf.groupBy(F.col("label").alias("cls")).agg(F.sum("n").alias("support"))
    npred = conf.groupBy(F.col("prediction").alias("cls")).agg(F.sum("n").alias("npred"))
    t = sup.join(npred, "cls").join(tp, "cls", "left").na.fill(0, ["tp"])
    p = F.when(F.col("npred") > 0, F.col("tp") / F.col("npred")).otherwise(0.0)
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    t = t.withColumn("precision", p).withColumn("recall", r)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(0.0)
    return t.withColumn("f1", f1).select("cls", "precision", "recall", "f1",
                                         F.col("support").cast("long").alias("support"))


def report(conf: DataFrame) -> DataFrame:
    """Per-class rows plus ``accuracy``, ``macro avg`` and ``weighted avg``."""
    pc = per_class(conf)
    tot = conf.agg(F.sum("n").alias("n"),
                   F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n"))
                         .otherwise(0)).alias("correct"))
    acc = tot.select(F.lit("accuracy").alias("cls"),
                     *[(F.col("correct") / F.col("n")).alias(c) for c in ("precision", "recall", "f1")],
                     F.col("n").cast("long").alias("support"))
    macro = pc.agg(F.lit("macro avg").alias("cls"), F.avg("precision").alias("precision"),
                   F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                   F.sum("support").cast("long").alias("support"))
    return (pc.select(F.col("cls").cast("string").alias("cls"), "precision", "recall", "f1", "support")
            .unionByName(acc).unionByName(macro).unionByName(weighted(pc)))


def weighted(pc: DataFrame) -> DataFrame:
    """Support-weighted precision, recall and F."""
    s = F.sum("support")
    return pc.agg(F.lit("weighted avg").alias("cls"),
                  *[(F.sum(F.col(c) * F.col("support")) / s).alias(c)
                    for c in ("precision", "recall", "f1")],
                  s.cast("long").alias("support"))


def errors(df: DataFrame, label: str, pred: str, positive=1) -> DataFrame:
    """False positives and false negatives with a ``kind`` column."""
    return (df.filter(F.col(label) != F.col(pred))
            .withColumn("kind", F.when(F.col(pred) == positive, F.lit("FP"))
                        .otherwise(F.lit("FN"))))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """One ROC point per distinct score threshold (descending):
    cumulative TPR and FPR from distributed prefix sums."""
    g = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum((1 - F.col(label)).cast("long")).alias("neg"))
    tot = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    c = prefix_sums(g.withColumn("_o", -F.col("threshold")), ["_o"], ["pos", "neg"]).drop("_o")
    return (c.join(F.broadcast(tot), how="inner")
            .select("threshold", "pos", "neg",
                    F.try_divide(F.col("cum_pos"), F.col("P")).alias("tpr"),
                    F.try_divide(F.col("cum_neg"), F.col("N")).alias("fpr"),
                    "P", "N", "cum_pos"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Trapezoid area under the ROC curve. Per threshold the area
    slice is ``neg * (positives scored higher + pos / 2) / (P * N)``."""
    pts = roc_points(df, label, score)
    return pts.agg(
        F.try_divide(F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") + F.col("pos") / 2)),
                     F.first("P") * F.first("N")).alias("auc"),  # NULL with one class
        F.first("P").alias("n_pos"), F.first("N").alias("n_neg"))


def scored_loss(df: DataFrame, scores: str, label: str) -> DataFrame:
    """M16 + F14: mean cross-entropy of logits and accuracy of the arg-max."""
    t = df.select(LF.argmax_index(scores).alias("pred"), F.col(label),
                  (LF.log_sum_exp(scores)
                   - F.get(F.col(scores), F.col(label)).cast("double")).alias("loss"))
    return t.agg(F.avg("loss").alias("cross_entropy"),
                 F.avg((F.col("pred") == F.col(label)).cast("double")).alias("accuracy"),
                 F.count(F.lit(1)).alias("n"))

"""Catalogue part 4: metrics, scored sets, models and signal features
(SURVEY 7.2 steps 8-9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat import functions as LF
from loomstat.operators import metrics, models, sampling, signal, text
from loomstat.operators.joins import attach_row
from loomstat.plans.registry import query, t

_LABELS = [0, 1]


def _scored(spark, d):
    """labels as a scored set: truth = quality, prediction = 1 - toxic."""
    lab = t(spark, d, "labels", "doc_id", "quality", "toxic")
    return lab.select("doc_id", F.col("quality").alias("label"),
                      (1 - F.col("toxic")).alias("prediction"))


_SCORED_SQL = """
WITH s AS (SELECT doc_id, quality AS label, 1 - toxic AS prediction FROM labels),
cls AS (SELECT l AS cls FROM (VALUES (0), (1)) v(l)),
pc0 AS (SELECT cls, (SELECT count(*) FROM s WHERE label = cls AND prediction = cls) AS tp,
               (SELECT count(*) FROM s WHERE prediction = cls) AS npred,
               (SELECT count(*) FROM s WHERE label = cls) AS support FROM cls),
pc AS (SELECT cls, CASE WHEN npred > 0 THEN tp / npred ELSE 0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall, support FROM pc0),
pf AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                      ELSE 0 END AS f1 FROM pc)
"""


def _r(c, n=6):
    return F.round(F.col(c), n).alias(c)


@query("confusion", """
WITH s AS (SELECT quality AS label, 1 - toxic AS prediction FROM labels),
sp AS (SELECT a.l AS label, b.l AS prediction FROM (VALUES (0), (1)) a(l), (VALUES (0), (1)) b(l))
SELECT sp.label, sp.prediction, count(s.label) AS n
FROM sp LEFT JOIN s ON s.label = sp.label AND s.prediction = sp.prediction GROUP BY 1, 2""")
def confusion(spark, d):
    """M9: confusion counts in a fixed label order, zero cells included."""
    return metrics.confusion_long(_scored(spark, d), "label", "prediction", _LABELS)


@query("confusion_matrix", """
SELECT quality AS label, count(*) FILTER (WHERE 1 - toxic = 0) AS "0",
       count(*) FILTER (WHERE 1 - toxic = 1) AS "1" FROM labels GROUP BY 1""")
def confusion_matrix(spark, d):
    """M9: the same as a matrix, one column per predicted label."""
    return metrics.confusion_matrix(_scored(spark, d), "label", "prediction", _LABELS)


@query("report", _SCORED_SQL + """
SELECT CAST(cls AS VARCHAR) AS cls, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, support FROM pf
UNION ALL SELECT 'accuracy', round(a, 6), round(a, 6), round(a, 6), n
  FROM (SELECT avg(CAST(label = prediction AS DOUBLE)) AS a, count(*) AS n FROM s)
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
  sum(support) FROM pf
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
  sum(support) FROM pf""")
def report(spark, d):
    """Precision, recall, F1, support per class; accuracy; macro and weighted means."""
    conf = metrics.confusion_long(_scored(spark, d), "label", "prediction", _LABELS)
    return metrics.report(conf).select("cls", _r("precision"), _r("recall"), _r("f1"), "support")


@query("weighted_prf", _SCORED_SQL + """
SELECT round(sum(precision * support) / sum(support), 6) AS precision,
       round(sum(recall * support) / sum(support), 6) AS recall,
       round(sum(f1 * support) / sum(support), 6) AS f1 FROM pf""")
def weighted_prf(spark, d):
    """Support-weighted precision, recall and F."""
    conf = metrics.confusion_long(_scored(spark, d), "label", "prediction", _LABELS)
    return metrics.weighted(metrics.per_class(conf)).select(_r("precision"), _r("recall"), _r("f1"))


@query("errors", """
SELECT doc_id, quality AS label, 1 - toxic AS prediction,
       CASE WHEN 1 - toxic = 1 THEN 'FP' ELSE 'FN' END AS kind
FROM labels WHERE quality <> 1 - toxic""")
def errors(spark, d):
    """False positives and false negatives."""
    return metrics.errors(_scored(spark, d), "label", "prediction")


_ROC_SQL = """
WITH s AS (SELECT l.quality AS label, d.n_chars AS score FROM labels l JOIN documents d USING (doc_id)),
tot AS (SELECT sum(label) AS P, sum(1 - label) AS N FROM s),
g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY 1),
c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS cum_pos,
             sum(neg) OVER (ORDER BY score DESC) AS cum_neg FROM g)
"""


def _roc_input(spark, d):
    lab = t(spark, d, "labels", "doc_id", "quality")
    docs = t(spark, d, "documents", "doc_id", "n_chars")
    return lab.join(docs, "doc_id").select(F.col("quality").alias("label"),
                                           F.col("n_chars").alias("score"))


@query("roc_auc", _ROC_SQL + """
SELECT round(sum(neg * (cum_pos - pos + pos / 2.0)) / (max(P) * max(N)), 9) AS auc,
       max(P) AS n_pos, max(N) AS n_neg FROM c, tot""")
def roc_auc(spark, d):
    """Area under the ROC curve of document length as a quality score."""
    a = metrics.roc_auc(_roc_input(spark, d), "label", "score")
    return a.select(_r("auc", 9), "n_pos", "n_neg")


@query("roc_points", _ROC_SQL + """
SELECT score AS threshold, round(cum_pos / P, 9) AS tpr, round(cum_neg / N, 9) AS fpr FROM c, tot""")
def roc_points(spark, d):
    """TPR and FPR at every distinct score threshold."""
    p = metrics.roc_points(_roc_input(spark, d), "label", "score")
    return p.select("threshold", _r("tpr", 9), _r("fpr", 9))


@query("argmax", """
SELECT vec_id, list_position(s, list_max(s)) - 1 AS pred, label
FROM (SELECT vec_id, label, embedding AS s FROM embeddings)""")
def argmax(spark, d):
    """index of the largest score."""
    e = t(spark, d, "embeddings", "vec_id", "embedding", "label")
    return e.select("vec_id", LF.argmax_index("embedding").alias("pred"), "label")


@query("cross_entropy", """
WITH s AS (SELECT label, CAST(embedding AS DOUBLE[]) AS s FROM embeddings),
l AS (SELECT label, list_position(s, list_max(s)) - 1 AS pred,
             ln(list_sum(list_transform(s, lambda x: exp(x - list_max(s))))) + list_max(s)
             - s[label + 1] AS loss FROM s)
SELECT round(avg(loss), 6) AS cross_entropy, avg(CAST(pred = label AS DOUBLE)) AS accuracy,
       count(*) AS n FROM l""")
def cross_entropy(spark, d):
    """Mean cross-entropy of the vector as logits, and accuracy."""
    e = t(spark, d, "embeddings", "embedding", "label")
    s = e.select(F.col("embedding").cast("array<double>").alias("s"), "label")
    return metrics.scored_loss(s, "s", "label").select(_r("cross_entropy"), "accuracy", "n")


def _emb_split(spark, d, frac):
    return sampling.split_position(t(spark, d, "embeddings"), frac, ["vec_id"])


@query("knn_vote", """
WITH e AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 < floor(count(*) OVER () * 0.7) AS is_train
           FROM embeddings),
tr AS (SELECT vec_id, embedding, label FROM e WHERE is_train),
te AS (SELECT vec_id, embedding, label FROM e WHERE NOT is_train),
dd AS (SELECT te.vec_id AS qid, tr.vec_id AS tid, tr.label AS nlabel,
              list_distance(CAST(te.embedding AS DOUBLE[]), CAST(tr.embedding AS DOUBLE[])) AS dist
       FROM te, tr),
nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS r FROM dd)
       WHERE r <= 5),
v AS (SELECT qid, nlabel, count(*) AS votes FROM nn GROUP BY 1, 2),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY votes DESC, nlabel) AS r FROM v)
      WHERE r = 1)
SELECT te.vec_id, te.label, CAST(b.nlabel AS INTEGER) AS predicted FROM te JOIN b ON b.qid = te.vec_id""")
def knn_vote(spark, d):
    """M5: 5 nearest training vectors (Euclidean), majority vote."""
    e = _emb_split(spark, d, 0.7)
    train = e.filter(F.col("split") == "train")
    test = e.filter(F.col("split") == "test")
    p = models.knn_vote(train, test, "vec_id", "embedding", "label", k=5)
    return test.select("vec_id", "label").join(p, "vec_id")


def _emb_features(spark, d, binary=False):
    e = sampling.split_random(t(spark, d, "embeddings"), 0.3, ["vec_id"])
    e = models.vectors(e, "embedding")
    if binary:
        e = e.withColumn("label", (F.col("label") < 5).cast("int"))
    return e.filter(F.col("split") == "train"), e.filter(F.col("split") == "test")


def _emb_model(kind, binary=False, **kw):
    def run(spark, d):
        train, test = _emb_features(spark, d, binary)
        return models.fit_predict(train, test, models.estimator(kind, **kw), ["vec_id"])
    return run


query("random_forest")(_emb_model("random_forest"))
query("gbt")(_emb_model("gbt", binary=True))
query("mlp")(_emb_model("mlp", layers=[64, 32, 10]))
query("softmax")(_emb_model("softmax"))


def _text_set(spark, d):
    docs = t(spark, d, "documents", "doc_id", "text")
    lab = t(spark, d, "labels", "doc_id", "quality")
    s = text.punct_tokens(docs.join(lab, "doc_id"), "text")
    return s.withColumnRenamed("quality", "label")


@query("linear_svm")
def linear_svm(spark, d):
    """Bag-of-words linear SVM on document quality, 70/30 split."""
    s = sampling.split_random(_text_set(spark, d), 0.3, ["doc_id"])
    s = s.select("doc_id", "label", "tokens", "split").persist()
    train, test = s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")
    return models.fit_predict(models.text_features(train, "tokens"), models.text_features(test, "tokens"),
                              models.estimator("linear_svm", maxIter=50), ["doc_id"], scale=False)


def _fold_scores(s, k):
    train, test = s.filter(F.col("fold") != k), s.filter(F.col("fold") == k)
    pred = models.fit_predict(train, test, models.estimator("linear_svm", maxIter=30),
                              ["doc_id"], scale=False)
    conf = metrics.confusion_long(pred, "label", "prediction", _LABELS)
    w = metrics.weighted(metrics.per_class(conf))
    acc = conf.agg((F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")))
                    / F.sum("n")).alias("accuracy"))
    row = attach_row(w, acc).select(F.lit(str(k)).alias("fold"), "precision", "recall", "f1",
                                  "accuracy")
    return row


@query("cv_report")
def cv_report(spark, d):
    """10 contiguous folds; for each, fit on the other nine and
    report weighted precision/recall/F and accuracy; plus their mean.

    The ten fits are independent Spark jobs and are submitted from a thread
    pool, as MLlib's ``CrossValidator(parallelism=...)`` does."""
    from concurrent.futures import ThreadPoolExecutor
    s = sampling.kfold_contiguous(_text_set(spark, d), 10, ["doc_id"])
    s = models.text_features(s, "tokens").select("doc_id", "label", "fold", "raw").cache()
    folds = sorted(r[0] for r in s.select("fold").distinct().collect())  # at most 10 fold ids
    with ThreadPoolExecutor(max_workers=4) as pool:
        rows = list(pool.map(lambda k: _fold_scores(s, k), folds))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    mean = out.agg(F.lit("mean").alias("fold"), *[F.avg(c).alias(c) for c in
                                                   ("precision", "recall", "f1", "accuracy")])
    return out.unionByName(mean)


@query("grid_search")
def grid_search(spark, d):
    """M6: grid x 5 folds (hash-shuffled fold column), accuracy, refit on all."""
    train, _ = _emb_features(spark, d)
    train = sampling.kfold_hash(train, 5, ["vec_id"])
    est = models.estimator("softmax", maxIter=30)
    _, rows = models.grid_search(train, est, {"regParam": [0.0, 0.01, 0.1]}, "fold", 5)
    data = [(p["regParam"], s) for p, s in rows]
    return spark.createDataFrame(data, "regParam double, mean_accuracy double")


@query("best_model")
def best_model(spark, d):
    """Several models on one split, accuracy table and the winner."""
    train, test = _emb_features(spark, d, binary=True)
    scores = None
    for kind in ("linear_svm", "random_forest", "gbt", "softmax"):
        p = models.fit_predict(train, test, models.estimator(kind), ["vec_id"])
        a = p.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy")) \
            .select(F.lit(kind).alias("model"), "accuracy")
        scores = a if scores is None else scores.unionByName(a)
    best = scores.agg(F.max_by("model", "accuracy").alias("best"))
    return attach_row(scores, best).select("model", "accuracy",
                                         (F.col("model") == F.col("best")).alias("is_best"))


@query("pca2")
def pca2(spark, d):
    """Centred PCA to two components; scores per vector."""
    e = models.vectors(t(spark, d, "embeddings", "vec_id", "embedding", "label"), "embedding")
    scores, _ = models.pca(e, 2, ["vec_id", "label"])
    return scores


@query("pca_variance")
def pca_variance(spark, d):
    """Explained variance ratio of the first two components, standardised input."""
    e = models.vectors(t(spark, d, "embeddings", "vec_id", "embedding"), "embedding")
    _, ratios = models.pca(e, 2, ["vec_id"], standardise=True)
    return spark.createDataFrame([(i + 1, float(r)) for i, r in enumerate(ratios)],
                                 "component int, explained_variance_ratio double")


# --- signal features ---------------------------------------------------------------------

@query("signal_features", """
WITH e AS (SELECT user_id, ts, event_id, value,
                  CASE WHEN event_type <> 'error' THEN value END AS track FROM events),
pk AS (SELECT user_id, max(abs(value)) AS peak FROM e GROUP BY 1),
s AS (SELECT e.*, CASE WHEN peak > 0 THEN value / peak END AS scaled FROM e JOIN pk USING (user_id)),
m AS (SELECT user_id, avg(scaled) AS mu FROM s GROUP BY 1),
c AS (SELECT s.*, scaled - mu AS cc FROM s JOIN m USING (user_id)),
l AS (SELECT *, lag(cc) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pc FROM c)
SELECT user_id, count(*) AS n, round(avg(scaled * scaled), 6) AS power,
       round(sum(CASE WHEN pc IS NOT NULL THEN CAST(sign(cc) <> sign(pc) AS DOUBLE) END)
             / (count(*) - 1), 6) AS zcr,
       round(coalesce(avg(track), 0), 6) AS track_mean,
       round(coalesce(stddev_pop(track), 0), 6) AS track_std,
       round(avg(CAST(track IS NOT NULL AS DOUBLE)), 6) AS present_share
FROM l GROUP BY 1 HAVING count(*) >= 2""")
def signal_features(spark, d):
    """Per-user value series as a signal: peak scaling,
    mean power, zero-crossing rate, sparse-track summary; short series skipped."""
    e = t(spark, d, "events", "user_id", "ts", "event_id", "value", "event_type")
    e = e.withColumn("track", F.when(F.col("event_type") != "error", F.col("value")))
    f = signal.signal_features(e, "user_id", ["ts", "event_id"], "value", track="track")
    return f.select("user_id", "n", *[_r(c) for c in ("power", "zcr", "track_mean", "track_std",
                                                      "present_share")])


@query("spectrum_features", """
WITH x AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos,
                  abs(CAST(unnest(embedding) AS DOUBLE)) AS m FROM embeddings),
tt AS (SELECT vec_id, sum(m) AS sm, sum(pos * m) / sum(m) AS centroid FROM x GROUP BY 1),
c AS (SELECT x.*, tt.sm, tt.centroid,
             sum(m) OVER (PARTITION BY vec_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS cum
      FROM x JOIN tt USING (vec_id))
SELECT vec_id, round(centroid, 6) AS centroid,
       round(sqrt(sum(m * (pos - centroid) * (pos - centroid)) / max(sm)), 6) AS bandwidth,
       min(pos) FILTER (WHERE cum >= 0.85 * sm) AS rolloff
FROM c GROUP BY vec_id, centroid""")
def spectrum_features(spark, d):
    """Centroid, bandwidth and 85 % roll-off of |embedding| as a spectrum."""
    e = t(spark, d, "embeddings", "vec_id", "embedding")
    x = e.select("vec_id", F.posexplode(F.col("embedding").cast("array<double>")).alias("pos", "x"))
    x = x.withColumn("m", F.abs("x"))
    f = signal.spectrum_features(x, "vec_id", "pos", "m")
    return f.select("vec_id", _r("centroid"), _r("bandwidth"), "rolloff")

"""Invariants of the distributed primitives, checked against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loomstat import functions as LF
from loomstat.operators import metrics, models, sampling, stats


@pytest.fixture(scope="module")
def ev(spark):
    return spark.read.parquet("/root/testdata/sf0.01/events.parquet")


def test_ordered_index_matches_row_number(spark, ev):
    idx = sampling.ordered_index(ev.select("event_id", "user_id", "ts"), ["user_id", "ts", "event_id"], "i")
    ref = ev.withColumn("j", F.row_number().over(Window.orderBy("user_id", "ts", "event_id")) - 1)
    assert idx.join(ref, "event_id").filter(F.col("i") != F.col("j")).count() == 0


def test_with_previous_matches_lag(spark, ev):
    wp = sampling.with_previous(ev, ["ts", "event_id"], ["value"], by="user_id")
    ref = ev.withColumn("lv", F.lag("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    j = wp.join(ref.select("event_id", "lv"), "event_id")
    assert j.filter(~F.col("prev_value").eqNullSafe(F.col("lv"))).count() == 0


def test_prefix_sums(spark):
    df = spark.range(1000).withColumn("v", F.col("id") % 7)
    p = sampling.prefix_sums(df, ["id"], ["v"]).orderBy("id").collect()
    assert [r["cum_v"] for r in p] == list(np.cumsum([i % 7 for i in range(1000)]))


def test_sample_sizes_and_repeatability(spark):
    df = spark.range(1234).withColumnRenamed("id", "k")
    a = sampling.sample_fraction(df, 0.1, ["k"], seed=3)
    b = sampling.sample_fraction(df, 0.1, ["k"], seed=3)
    assert a.count() == round(0.1 * 1234)
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())
    assert sampling.sample_n(df, 3, ["k"]).count() == 3
    w = sampling.sample_with_replacement(df, 0.5, ["k"], seed=1)
    assert w.count() == 617


def test_folds_disjoint_and_balanced(spark):
    df = spark.range(1003).withColumnRenamed("id", "k")
    f = sampling.kfold_hash(df, 5, ["k"])
    sizes = sorted(r["count"] for r in f.groupBy("fold").count().collect())
    assert sum(sizes) == 1003 and sizes[-1] - sizes[0] <= 1
    s = sampling.stratified_folds(df.withColumn("c", (F.col("k") % 3 == 0).cast("int")), 5, "c", ["k"])
    per = s.groupBy("c", "fold").count().collect()
    for c in (0, 1):
        v = [r["count"] for r in per if r["c"] == c]
        assert max(v) - min(v) <= 1


def test_split_groups_whole(spark):
    df = spark.range(500).withColumn("g", F.col("id") % 20)
    s = sampling.split_groups(df, "g", 0.9)
    assert s.groupBy("g").agg(F.countDistinct("split").alias("n")).filter("n > 1").count() == 0
    assert s.filter(F.col("split") == "training").select("g").distinct().count() == 18


def test_roc_auc_matches_pairwise(spark):
    rng = np.random.default_rng(0)
    lab = rng.integers(0, 2, 300)
    sc = rng.integers(0, 40, 300)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(lab, sc)], "label int, score long")
    auc = metrics.roc_auc(df, "label", "score").first()["auc"]
    pos, neg = sc[lab == 1], sc[lab == 0]
    ref = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert math.isclose(auc, ref, rel_tol=1e-12)


def test_kurtosis_and_fits(spark, ev):
    x = np.array([r[0] for r in ev.select("value").collect()])
    s = stats.summary(ev, "value").first()
    m2 = ((x - x.mean()) ** 2).mean()
    m4 = ((x - x.mean()) ** 4).mean()
    assert math.isclose(s["kurtosis"], m4 / m2 ** 2 - 3, rel_tol=1e-9)
    lap = stats.fit_laplace(ev, "value").first()
    assert math.isclose(lap["loc"], np.median(x))
    assert math.isclose(lap["scale"], np.abs(x - np.median(x)).mean(), rel_tol=1e-9)


def test_student_t_and_normal_quantile(spark):
    # P(|T| > 2.0) with 10 dof = 0.0733880347...
    p = spark.range(1).select(LF.t_two_sided_p(F.lit(2.0), F.lit(10.0)).alias("p")).first()["p"]
    assert math.isclose(p, 0.07338803477074, rel_tol=1e-9)
    r = spark.range(1).select(LF.normal_quantile(F.lit(0.975)).alias("q"),
                              LF.normal_quantile(F.lit(0.01)).alias("q2")).first()
    assert abs(r["q"] - 1.959963984540054) < 1e-8
    assert abs(r["q2"] + 2.326347874040841) < 1e-8


def test_knn_exact_vs_numpy(spark):
    rng = np.random.default_rng(1)
    tr = rng.normal(size=(300, 8))
    te = rng.normal(size=(40, 8))
    lab = rng.integers(0, 3, 300)
    train = spark.createDataFrame([(i, tr[i].tolist(), int(lab[i])) for i in range(300)],
                                  "id long, v array<double>, label int")
    test = spark.createDataFrame([(1000 + i, te[i].tolist(), 0) for i in range(40)],
                                 "id long, v array<double>, label int")
    got = {r["id"]: r["predicted"] for r in
           models.knn_vote(train, test, "id", "v", "label", k=5, block_rows=64).collect()}
    for i in range(40):
        d = np.sqrt(((tr - te[i]) ** 2).sum(axis=1))
        nn = np.lexsort((np.arange(300), d))[:5]
        votes = np.bincount(lab[nn], minlength=3)
        assert got[1000 + i] == int(np.argmax(votes))


def test_pca_variance_matches_numpy(spark):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    X = np.array([r[0] for r in e.select("embedding").collect()], dtype=float)
    _, ratios = models.pca(models.vectors(e, "embedding"), 2, ["vec_id"])
    ev = np.linalg.eigvalsh(np.cov(X.T))[::-1]
    assert np.allclose(ratios, ev[:2] / ev.sum(), rtol=1e-6)


def test_exact_quantiles_match_numpy(spark, ev):
    x = np.array([r[0] for r in ev.select("value").collect()])
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0, 1 / 3]
    got = sampling.exact_quantiles(ev, "value", probs).first()["_q"]
    assert np.allclose(got, np.percentile(x, [p * 100 for p in probs]), rtol=0, atol=1e-9)
    # one value holding most rows collapses to one counted row
    hot = spark.createDataFrame([(7.0,)] * 500 + [(1.0,), (9.0,)], "x double")
    assert sampling.exact_quantiles(hot, "x", [0.0, 0.5, 1.0]).first()["_q"] == [1.0, 7.0, 9.0]


def test_hot_key_previous_row_and_duplicates(spark):
    # one user holds two thirds of the rows; positions still spread over
    # range partitions and every previous value matches lag()
    rows = [(i, 0 if i % 3 else 1 + i % 5, float(i % 11)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, user long, v double")
    wp = sampling.with_previous(df, ["id"], ["v"], by="user")
    ref = df.withColumn("lv", F.lag("v").over(Window.partitionBy("user").orderBy("id")))
    j = wp.join(ref.select("id", "lv"), "id")
    assert j.filter(~F.col("prev_v").eqNullSafe(F.col("lv"))).count() == 0
    idx = sampling.ordered_index(df, ["user", "id"], "p")
    per_part = idx.withColumn("pid", F.spark_partition_id()).groupBy("pid").count().collect()
    assert max(r["count"] for r in per_part) < 3000  # the hot user is not one task
    from loomstat.operators.clean import duplicate_flags
    d = duplicate_flags(df.select("id", (F.col("user") == 0).cast("string").alias("t")), ["t"], "id")
    assert d.filter(~F.col("is_duplicate")).count() == 2


def test_cosine_hot_terms_blocked_equals_term_join(spark):
    from loomstat.operators import similarity
    rng = np.random.default_rng(3)
    rows_tr = [(f"d{d}", f"t{t}", int(rng.integers(1, 4))) for d in range(12) for t in range(40)
               if rng.random() < (0.9 if t < 5 else 0.2)]
    rows_te = [(f"d{d}", f"t{t}", int(rng.integers(1, 4))) for d in range(9) for t in range(40)
               if rng.random() < (0.9 if t < 5 else 0.2)]
    tr = spark.createDataFrame(rows_tr, "doc string, term string, n long")
    te = similarity.closed_vocabulary(spark.createDataFrame(rows_te, "doc string, term string, n long"), tr)
    cold = {(r[0], r[1]): r[2] for r in similarity.cosine_pairs(te, tr).collect()}
    hot = {(r[0], r[1]): r[2] for r in similarity.cosine_pairs(te, tr, hot_pairs=20, cell_docs=4).collect()}
    assert set(cold) == set(hot)
    assert all(math.isclose(cold[k], hot[k], rel_tol=1e-12) for k in cold)

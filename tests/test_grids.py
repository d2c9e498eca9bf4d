"""Grids, text models from raw text, random Fourier features."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from loomstat.operators import grids, models


def ring(spark, n=900):
    rng = np.random.default_rng(2)
    r = np.where(np.arange(n) % 2, .6, 1.6) + rng.normal(0, .12, n)
    a = rng.uniform(0, 2 * math.pi, n)
    rows = [(i, [float(x * math.cos(t)), float(x * math.sin(t))], int(i % 2), "test" if i % 3 == 0 else "train") for i, (x, t) in enumerate(zip(r, a))]
    return spark.createDataFrame(rows, "id int, v array<double>, label int, split string").repartition(4)


def accuracy(data):
    p = models.fit_predict(data.where("split = 'train'"), data.where("split = 'test'"), models.estimator("linear_svm", maxIter=50, regParam=1e-4), ["id"], scale=False)
    return p.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]


def test_kernel_beats_linear_on_a_ring(spark):
    df = ring(spark)
    assert accuracy(models.vectors(df, "v")) < 0.7
    assert accuracy(grids.fourier_features(df, "v", 2, features=96, scale=0.7, seed=1)) > 0.95


def test_fourier_features_approximate_the_kernel(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(12, 3))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(99, None)], "id int, v array<double>")
    rows = grids.fourier_features(df, "v", 3, features=3000, scale=1.5, seed=4).orderBy("id").collect()
    assert df.columns + ["raw"] == list(rows[0].asDict()) and rows[-1]["raw"] is None
    z = np.array([r["raw"].toArray() for r in rows[:-1]])
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * 1.5 ** 2))
    assert np.abs(z @ z.T - want).max() < 0.12


def test_text_model_reloaded_row_by_row(spark):
    rng = random.Random(1)
    good, bad = [f"fine{i}" for i in range(30)], [f"poor{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(good if i % 2 else bad) for _ in range(15)).upper() if i % 5 else None if i == 0 else " ".join(good if i % 2 else bad), int(i % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, text string, y int").repartition(3)
    model = grids.fit_text(df, "text", "y", width=1 << 10, max_iter=20)
    one = {r["id"]: r["prediction"] for r in grids.predict_text(model, df, "text", ["id"]).collect()}
    two = {r["id"]: r["prediction"] for r in grids.predict_text(grids.reloaded(model, df), df, "text", ["id"]).collect()}
    assert len(one) == 200 and one == two
    assert sum(one[i] == i % 2 for i in range(1, 200)) > 195


def test_grid_finds_the_model_that_fits(spark):
    df = models.vectors(ring(spark, 450), "v").withColumn("fold", F.pmod("id", F.lit(3)))
    train, held = df.where("split = 'train'"), df.where("split = 'test'")
    specs = grids.settings("random_forest", {"numTrees": [4, 8], "maxDepth": [1, 6]}) + grids.settings("linear_svm", {"regParam": [0.01]})
    assert [s for _, s in specs[:2]] == [{"numTrees": 4, "maxDepth": 1}, {"numTrees": 4, "maxDepth": 6}]
    found = grids.grid(train.withColumn("fold", F.pmod(F.col("id") * 7 % 11, F.lit(3))), held, specs, "fold")
    best = max(found, key=lambda r: r[2])
    assert best[0] == "random_forest" and best[1]["maxDepth"] == 6 and best[3] > 0.85
    assert sum(r[3] is not None for r in found) == 1 and found[-1][2] < 0.75


def test_fourier_svm_fits_without_wide_rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 2))
    rows = [([float(v) for v in r], int(r @ r < 1.2)) for r in x]
    df = spark.createDataFrame([*rows, (None, 1)], "v array<double>, label int").repartition(3)
    planes = dict(width=2, features=64, scale=1.0, seed=3)
    weights, intercept = grids.fit_fourier_svm(df, "v", "label", **planes, max_iter=30, reg=1e-4)
    wide = grids.fourier_features(df, "v", **planes).dropna()
    own = grids.predict_linear(wide, weights, intercept, "label", [])
    mllib = models.fit_predict(wide, wide, models.estimator("linear_svm", maxIter=30, regParam=1e-4), [], scale=False)
    hit = lambda p: p.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    assert hit(own) > 0.95 and hit(own) > hit(mllib) - 0.02


def test_grid_shares_its_passes(spark):
    """settings and folds share passes over the rows; accuracies are those of fits one by one."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(4000, 3)) * [1, 20, .1] + [5, 0, 0]
    y = ((x[:, 0] - 5) ** 2 + x[:, 1] / 40 + rng.normal(0, .2, 4000) > .7).astype(int)
    df = models.vectors(spark.createDataFrame([([float(v) for v in r], int(c), i % 3) for i, (r, c) in enumerate(zip(x, y))], "v array<double>, label int, fold int").repartition(3), "v").select("raw", "label", "fold").persist()
    specs = (grids.settings("random_forest", {"numTrees": [5, 10], "maxDepth": [2, 5]}) + grids.settings("gbt", {"maxDepth": [3], "maxIter": [5, 10]})
             + grids.settings("linear_svm", {"regParam": [0.001, 0.1]}))
    spark.sparkContext.setJobGroup("grid", "F1")
    found = grids.grid(df, df, specs, "fold")
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("grid"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs < 120  # 600 and more where each setting reads the rows for itself
    few = [specs[4], specs[6]]
    for kind, setting, hit, _ in grids._grid_by_fits(df, df, few, "fold", [0, 1, 2], 4):
        assert abs(hit - found[specs.index((kind, setting))][2]) < 0.01
    assert found[3][2] > 0.88  # a forest draws at random
    assert max(f[3] for f in found if f[3] is not None) > 0.88
    df.unpersist()


def test_trees_from_counted_cells():
    """a tree grown from cells is the tree of their rows; cuts lie between values."""
    from loomstat.operators import trees
    assert trees.splits(np.array([1., 2, 2, 4]), np.ones(4)).tolist() == [1.5, 3]
    many = trees.splits(np.arange(1000.), np.ones(1000))
    assert len(many) == 31 and abs(many[15] - 499.5) < 2
    x = np.random.default_rng(1).integers(0, 8, (500, 2)) / 4
    cuts = [trees.splits(x[:, j], np.ones(500)) for j in (0, 1)]
    codes = trees.bin_codes(x, cuts)
    assert (trees.bins_of(codes, 2) == x * 4).all()
    y = ((x[:, 0] > 1) & (x[:, 1] > .5)).astype(int)
    cell, at = np.unique(codes, return_inverse=True)
    n = np.stack([np.bincount(at, y == c, len(cell)) for c in (0, 1)], 1)
    assert (trees.boosted(trees.bins_of(cell, 2), n, maxIter=3, maxDepth=2)[at] == y).all()
    assert (trees.forest(trees.bins_of(cell, 2), n, numTrees=9, maxDepth=4)[at] == y).mean() > .97


def test_fourier_svm_in_single_precision(spark):
    """features are made as 4-byte numbers, once a pass, for the fit and for the predictions alike."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(v) for v in r], int(r @ r < 1.2)) for i, r in enumerate(rng.normal(size=(2000, 2)))]
    df = spark.createDataFrame([*rows, (-1, None, 1), (-2, [9.0, 9.0], None)], "id int, v array<double>, label int").repartition(3)
    planes = dict(width=2, features=64, scale=1.0, seed=3)
    asked = []
    was = grids.hinge.totals

    def totals(blocks, sums, size, *part):
        asked.append(sums.__closure__ and [c.cell_contents for c in sums.__closure__ if callable(c.cell_contents)])
        return was(blocks, sums, size, *part)
    grids.hinge.totals = totals
    try:
        weights, intercept = grids.fit_fourier_svm(df, "v", "label", **planes, max_iter=20, reg=1e-4)
    finally:
        grids.hinge.totals = was
    made = [f for fs in asked for f in fs or () if f.__name__ == "make"]
    assert made and made[0](np.zeros((5, 2))).dtype == np.float32
    one = {r["id"]: (r["label"], r["prediction"]) for r in grids.predict_fourier(df, "v", weights, intercept, "label", ["id"], **planes).collect()}
    two = {r["id"]: (r["label"], r["prediction"]) for r in grids.predict_linear(grids.fourier_features(df.where("id >= -2 and v is not null"), "v", **planes), weights, intercept, "label", ["id"]).collect()}
    assert len(one) == 2002 and one[-1] == (1, None) and one[-2][0] is None
    assert sum(one[i] != p for i, p in two.items()) <= 2 and len(two) == 2001 and sum(y == p for y, p in one.values()) > 1900

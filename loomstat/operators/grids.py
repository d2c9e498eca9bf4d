"""Grids over several models (M6), text models from raw text (M8) and random
Fourier features (M2).
"""

from __future__ import annotations

import itertools
import math
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import HashingTF, RegexTokenizer, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstat import functions as LF
from loomstat.operators import hinge, models, trees
from loomstat.operators.joins import attach_row
from loomstat.session import scratch_path

# --- M6 --------------------------------------------------------------------------


def settings(kind: str, grid: dict[str, list]) -> list[tuple[str, dict]]:
    """The product of a model's parameter values, in the order given."""
    return [(kind, dict(zip(grid, v))) for v in itertools.product(*grid.values())]


def _accuracy(predicted: DataFrame) -> float:
    hit = predicted.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    return float(hit) if hit is not None else math.nan


OWN = {"random_forest": {"numTrees", "maxDepth"}, "gbt": {"maxIter", "maxDepth"}, "linear_svm": {"maxIter", "regParam"}}
CELLS = 1 << 20  # counted cells that the driver may hold, by the bins of the columns
DEPTH = 10       # levels of a tree that is grown from them


def grid(train: DataFrame, held_out: DataFrame, specs: list[tuple[str, dict]], fold: str, parallelism: int = 4):
    """M6 over several models: ``[(kind, setting, mean accuracy, refit accuracy)]``.

    ``train(raw, label, <fold>)``. The best setting (ties: the first) is fitted
    again on all of ``train`` and scored on ``held_out``; the others have None
    there. Forests, boosted trees and SVMs of two classes share their passes over
    the rows (``_grid_by_passes``) as long as the cells of the columns' bins are
    bounded by ``CELLS``; other grids are fitted by MLlib, one by one.
    """
    found = sorted({tuple(r) for r in train.select(fold, "label").distinct().collect()}, key=str)  # a handful
    folds = sorted({k for k, _ in found})
    first = train.where(F.col("raw").isNotNull()).select(F.size(vector_to_array("raw"))).first()
    width = first[0] if first else 0
    if (0 < width and len(folds) > 1 and trees.BINS ** min(width, 20) * 4 * (len(folds) + 1) <= CELLS and {y for _, y in found} == {0, 1}
            and all(set(setting) <= OWN.get(kind, set()) and kind in OWN and setting.get("maxDepth", 0) <= DEPTH for kind, setting in specs)):
        return _grid_by_passes(train, held_out, specs, fold, folds, width)
    return _grid_by_fits(train, held_out, specs, fold, folds, parallelism)


def _grid_by_fits(train, held_out, specs, fold, folds, parallelism):
    """The scaler of a fold is fitted once and its features are kept for all
    settings, then released; fits run side by side."""
    scores: dict[int, list[float]] = {i: [] for i in range(len(specs))}
    for k in folds:
        scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True).fit(train.where(F.col(fold) != k))
        data = scaler.transform(train).select("features", "label", (F.col(fold) == k).alias("_test")).persist()
        fit_on, test_on = data.where("not _test"), data.where("_test")

        def one(i: int, fit_on=fit_on, test_on=test_on) -> tuple[int, float]:
            kind, setting = specs[i]
            return i, _accuracy(models.estimator(kind, **setting).fit(fit_on).transform(test_on))
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            for i, a in pool.map(one, range(len(specs))):
                scores[i].append(a)
        data.unpersist()
    mean = [sum(scores[i]) / len(scores[i]) for i in range(len(specs))]
    best = max(range(len(specs)), key=lambda i: (mean[i], -i))
    model = models.scaled_model(models.estimator(specs[best][0], **specs[best][1])).fit(train)
    refit = _accuracy(model.transform(held_out))
    return [(kind, setting, mean[i], refit if i == best else None) for i, (kind, setting) in enumerate(specs)]


def _summaries(blocks: DataFrame, folds: int, width: int) -> list[list[list[tuple[np.ndarray, float]]]]:
    """Quantiles of each fold and column, one list from each task, each with its number of rows."""
    def go(batches):
        held: dict[tuple[int, int], list] = {}
        for x, _, f in hinge.unpacked(batches, hinge.BLOCK):
            for k in range(folds):
                for j in range(width):
                    if len(v := x[f == k, j]):
                        held.setdefault((k, j), []).append((trees.quantiles(v, np.ones(len(v)), min(len(v), trees.SUMMARY // 2)), len(v)))
        for (k, j), parts in held.items():
            v, w = trees.joined(parts)
            v = trees.quantiles(v, w, min(len(v), trees.SUMMARY))
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([j], pa.int32()), pa.array([v.tobytes()], pa.binary()), pa.array([float(w.sum())])], names=["k", "j", "v", "n"])
    out: list[list[list]] = [[[] for _ in range(width)] for _ in range(folds)]
    for r in sorted(blocks.mapInArrow(go, "k int, j int, v binary, n double").collect(), key=lambda r: (r["k"], r["j"], r["v"])):
        out[r["k"]][r["j"]].append((np.frombuffer(r["v"]), r["n"]))
    return out


def _cells(blocks: DataFrame, cuts: list[list[np.ndarray]], left_out: list[int | None], width: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(bins, rows that train, rows that test)`` for each set of cuts: rows by cell and label."""
    size = trees.BINS ** width

    def go(batches):
        total = np.zeros(len(cuts) * size * 4, np.int64)
        for x, y, f in hinge.unpacked(batches, hinge.BLOCK):
            for s, (cut, k) in enumerate(zip(cuts, left_out)):
                total[s * size * 4:(s + 1) * size * 4] += np.bincount(trees.bin_codes(x, cut) * 4 + (y == 1) * 2 + (f == (-1 if k is None else k)), minlength=size * 4)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "n"])
    total = np.zeros(len(cuts) * size * 4, np.int64)
    for r in blocks.mapInArrow(go, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow().to_batches():  # at most CELLS
        total[r.column("at").to_numpy()] = r.column("n").to_numpy()
    out = []
    for t in total.reshape(len(cuts), size, 2, 2):
        seen = np.flatnonzero(t.any((1, 2)))
        out.append((trees.bins_of(seen, width), t[seen, :, 0], t[seen, :, 1]))
    return out


def _grid_by_passes(train, held_out, specs, fold, folds, width):
    """All settings and folds at once: trees grow from counted cells (one pass for
    the bins of each fold's training rows, one for the counts), SVMs of all folds
    are minimised side by side by passes over packed rows."""
    position = F.array_position(F.array(*[F.lit(k) for k in folds]), F.col(fold)) - 1
    blocks = hinge.packed(train, vector_to_array("raw"), F.col("label"), position).persist()
    sets: list[int | None] = [*range(len(folds)), None]  # the fold left out
    summary = _summaries(blocks, len(folds), width)
    cuts = [[trees.splits(*trees.joined([p for k in range(len(folds)) if k != s for p in summary[k][j]])) for j in range(width)] for s in sets]
    cells = _cells(blocks, cuts, sets, width)
    grow = {"random_forest": trees.forest, "gbt": trees.boosted}

    def by_cells(s: int, kind: str, setting: dict) -> np.ndarray:
        bins, n, _ = cells[s]
        return grow[kind](bins, n, **setting)
    scores: list[list[float]] = [[] for _ in specs]
    for i, (kind, setting) in enumerate(specs):
        for s in range(len(folds)) if kind in grow else ():
            hit, test = by_cells(s, kind, setting), cells[s][2]
            scores[i].append(float(test[np.arange(len(hit)), hit].sum() / test.sum()))

    # keeps float32 features near 0
    whole = [trees.joined([p for of in summary for p in of[j]]) for j in range(width)]
    shift = np.array([np.average(v, weights=w) for v, w in whole])
    spread = np.array([np.sqrt(np.average((v - m) ** 2, weights=w)) or 1.0 for (v, w), m in zip(whole, shift)])

    def features(x):
        return ((x - shift) / spread).astype(np.float32)

    def svms(which: list[tuple[int, int | None]]) -> list[tuple[np.ndarray, float]]:
        """SVMs of some settings by ``maxIter``; all of one length run side by side."""
        out: dict[int, tuple[np.ndarray, float]] = {}
        for most in sorted({specs[i][1].get("maxIter", 50) for i, _ in which}):
            mine = [x for x, (i, _) in enumerate(which) if specs[i][1].get("maxIter", 50) == most]
            fitted = hinge.fits(blocks, features, width, list(range(len(folds))), [(which[x][1], specs[which[x][0]][1].get("regParam", 0.01)) for x in mine], most)
            out |= dict(zip(mine, fitted))
        return [out[x] for x in range(len(which))]
    which = [(i, k) for i, (kind, _) in enumerate(specs) if kind == "linear_svm" for k in range(len(folds))]
    if which:
        planes = [(k, w, b) for (_, k), (w, b) in zip(which, svms(which))]

        def hits(x, y, f):
            z = features(x).astype(np.float64)
            return np.array([v for k, w, b in planes for v in (((z @ w + b > 0) == y)[f == k].sum(), (f == k).sum())], np.float64)
        for (i, _), (hit, n) in zip(which, hinge.totals(blocks, hits, 2 * len(which)).reshape(-1, 2)):
            scores[i].append(float(hit / n))
    mean = [sum(x) / len(x) for x in scores]
    best = max(range(len(specs)), key=lambda i: (mean[i], -i))
    kind, setting = specs[best]
    if kind in grow:
        table, cut = np.zeros(trees.BINS ** width, np.int8), cuts[-1]
        names = np.arange(trees.BINS ** width)
        bins, n, _ = cells[-1]
        known = len(bins)
        every = trees.bins_of(names, width)  # held-out rows may lie in cells that no training row is in
        table[:] = grow[kind](np.concatenate([bins, every]), np.concatenate([n, np.zeros((len(every), 2), n.dtype)]), **setting)[known:]
        predict = lambda x: table[trees.bin_codes(x, cut)]
    else:
        w, b = svms([(best, None)])[0]
        predict = lambda x: features(x).astype(np.float64) @ w + b > 0
    blocks.unpersist()
    hit, n = hinge.totals(hinge.packed(held_out, vector_to_array("raw"), F.col("label")), lambda x, y, f: np.array([(predict(x) == y).sum(), len(y)], np.float64), 2, hinge.BLOCK)
    refit = float(hit / n) if n else math.nan
    return [(kind, setting, mean[i], refit if i == best else None) for i, (kind, setting) in enumerate(specs)]


# --- M8 --------------------------------------------------------------------------

def text_pipeline(text: str, label: str, width: int = models.TEXT_WIDTH, max_iter: int = 50) -> Pipeline:
    """From raw text to a label: tokens, hashed counts, linear SVM, as one pipeline."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=r"\s+", toLowercase=True),
        HashingTF(inputCol="_tokens", outputCol="_counts", numFeatures=width),
        models.estimator("linear_svm", label, maxIter=max_iter).setFeaturesCol("_counts")])


def fit_text(train: DataFrame, text: str, label: str, **kw) -> PipelineModel:
    """Rows with a NULL text count as empty texts; a NULL label takes no part."""
    rows = train.where(F.col(label).isNotNull()).withColumn(text, F.coalesce(text, F.lit("")))
    return text_pipeline(text, label, **kw).fit(rows)


def predict_text(model: PipelineModel, df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``prediction`` of raw texts, NULL texts included."""
    out = model.transform(df.withColumn("_was", F.col(text)).withColumn(text, F.coalesce(text, F.lit(""))))
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"))


def reloaded(model: PipelineModel, df: DataFrame) -> PipelineModel:
    """The model written to the shared folder and read again."""
    path = scratch_path(df.sparkSession, "model")
    model.write().save(path)
    return PipelineModel.load(path)


# --- M2 --------------------------------------------------------------------------

def _planes(df: DataFrame, width: int, features: int, scale: float, seed: int) -> DataFrame:
    """One row: ``features`` planes ``(w, b)`` from seeded hashes."""
    unit = lambda *at: (F.pmod(F.xxhash64(F.lit(seed), *at), F.lit(1 << 40)) + 0.5) / F.lit(float(1 << 40))
    each = F.transform(F.sequence(F.lit(0), F.lit(features - 1)), lambda i: F.struct(
        F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda j: LF.normal_quantile(unit(i, j)) / scale).alias("w"),
        (unit(i, F.lit(-1)) * 2 * math.pi).alias("b")))
    return df.sparkSession.range(1).select(each.alias("_planes"))


def fourier_features(df: DataFrame, arr: str, width: int, features: int = 256, scale: float = 1.0, seed: int = 0, out: str = "raw") -> DataFrame:
    """Random Fourier features of a Gaussian kernel ``exp(-|x - y|^2 / (2 scale^2))``.

    ``sqrt(2 / features) cos(w x + b)`` with normal ``w`` and uniform ``b`` from
    seeded hashes: one row of (features x width) numbers, attached to every row,
    and a column expression on it. NULL arrays stay NULL.
    """
    one = _planes(df, width, features, scale, seed)
    x = F.coalesce("_x", F.array_repeat(F.lit(0.0), width))
    z = F.transform("_planes", lambda p: F.cos(LF.dot(p["w"], x) + p["b"]) * math.sqrt(2 / features))
    rows = attach_row(df.withColumn("_x", F.col(arr).cast("array<double>")), one)
    return rows.withColumn(out, F.when(F.col("_x").isNotNull(), array_to_vector(z))).drop("_planes", "_x")


def _maker(df: DataFrame, width: int, features: int, scale: float, seed: int):
    """``fourier_features`` of an array of rows, as 4-byte numbers."""
    planes = _planes(df, width, features, scale, seed).first()["_planes"]  # features x (width + 1) numbers
    plane, norm = np.array([[*p["w"], p["b"]] for p in planes], np.float32).T.copy(), np.float32(math.sqrt(2 / features))

    def make(x: np.ndarray) -> np.ndarray:
        one = np.ones((len(x), width + 1), np.float32)
        one[:, :-1] = x
        z = one @ plane
        np.cos(z, out=z)
        z *= norm
        return z
    return make


def fit_fourier_svm(train: DataFrame, arr: str, label: str, width: int, features: int = 256, scale: float = 1.0, seed: int = 0,
                    max_iter: int = 50, reg: float = 0.01) -> tuple[list[float], float]:
    """M2: a linear SVM on ``fourier_features``: ``(weights, intercept)`` for them.

    The objective is that of ``LinearSVC`` (mean hinge loss, L2 on the weights of
    standardised features), minimised by L-BFGS. Each pass makes the features of
    a few thousand rows at a time inside the tasks, which send back one row of
    sums; rows are kept as wide as their input, never as wide as the features.
    Rows with a NULL array or label take no part.
    """
    blocks = hinge.packed(train, F.col(arr), F.col(label)).persist()
    (weights, intercept), = hinge.fits(blocks, _maker(train, width, features, scale, seed), features, [0], [(None, reg)], max_iter)
    blocks.unpersist()
    return weights.tolist(), intercept


def predict_fourier(df: DataFrame, arr: str, weights: list[float], intercept: float, label: str, keep: list[str], width: int,
                    features: int = 256, scale: float = 1.0, seed: int = 0) -> DataFrame:
    """``predict_linear`` on ``fourier_features``, a few thousand rows at a time: no row is ever as wide as the features.

    A row with a NULL array keeps its place and has no prediction.
    """
    make, plane = _maker(df, width, features, scale, seed), np.array(weights)
    rows = df.select(*keep, F.col(label).alias("label"), F.col(arr).cast("array<double>").alias("_x"))

    def go(batches):
        for batch in batches:
            known = np.asarray(batch.column("_x").is_valid())
            x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            margin = np.full(len(known), np.nan)
            margin[known] = np.concatenate([make(x[i:i + hinge.PART]) @ plane for i in range(0, len(x), hinge.PART)] or [np.zeros(0)]) + intercept
            prediction = pa.array((margin > 0).astype(np.int32), mask=np.isnan(margin))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], prediction], names=[*batch.schema.names[:-1], "prediction"])
    return rows.mapInArrow(go, T.StructType([*rows.schema.fields[:-1], T.StructField("prediction", T.IntegerType())]))


def predict_linear(df: DataFrame, weights: list[float], intercept: float, label: str, keep: list[str], raw: str = "raw") -> DataFrame:
    """``keep``, label and prediction of vectors under a linear model."""
    margin = LF.dot(vector_to_array(raw), F.lit(weights)) + intercept
    return df.select(*keep, F.col(label).alias("label"), (margin > 0).cast("int").alias("prediction"))

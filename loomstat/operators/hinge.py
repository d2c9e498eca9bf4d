"""Linear SVMs of several settings and folds, minimised side by side (M2, M6).

The rows are packed once into blocks of bytes, as wide as their input. Every pass
makes the features of a few thousand rows at a time inside the tasks and returns
one row of sums from each task, for all the fits that are still running.
"""

from __future__ import annotations

from collections.abc import Callable, Generator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 16_384  # rows of a packed block
PART = 1_024    # rows whose features exist at once
STEPS = (1.0, 0.5, 0.25, 0.0625)  # step lengths tried in one pass over the rows


def packed(df: DataFrame, arr: Column, label: Column, fold: Column | None = None) -> DataFrame:
    """``x, y, f``: the rows of ``df`` in blocks of bytes (doubles, labels and folds).

    Rows with a NULL array, label or fold take no part.
    """
    rows = df.select(arr.cast("array<double>").alias("x"), label.cast("double").alias("y"), (F.lit(0) if fold is None else fold).cast("int").alias("f")).dropna()

    def go(batches):
        held: list[tuple[np.ndarray, ...]] = []

        def block():
            x, y, f = (np.concatenate(c) for c in zip(*held))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x, y, f)], names=["x", "y", "f"])
        for batch in batches:
            if batch.num_rows:
                held.append((batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.float64), batch.column("y").to_numpy(zero_copy_only=False), batch.column("f").to_numpy(zero_copy_only=False)))
            if sum(len(y) for _, y, _ in held) >= BLOCK:
                yield block()
        if held:
            yield block()
    return rows.mapInArrow(go, "x binary, y binary, f binary")


def unpacked(batches, part: int = PART):
    """``(x, y, f)`` of some rows at a time, of packed blocks."""
    for batch in batches:
        for x, y, f in zip(batch.column("x"), batch.column("y"), batch.column("f")):
            y, f = np.frombuffer(y.as_buffer(), np.float64), np.frombuffer(f.as_buffer(), np.int32)
            x = np.frombuffer(x.as_buffer(), np.float64).reshape(len(y), -1)
            for i in range(0, len(y), part):
                yield x[i:i + part], y[i:i + part], f[i:i + part]


def totals(blocks: DataFrame, sums: Callable, size: int, part: int = PART) -> np.ndarray:
    """The sum of ``sums(x, y, f)`` over all rows, ``size`` numbers; one row of them from each task."""
    def go(batches):
        total, any_rows = np.zeros(size), False
        for rows in unpacked(batches, part):
            total += sums(*rows)
            any_rows = True
        if any_rows:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["s"])
    parts = [np.frombuffer(r["s"], np.float64) for r in blocks.mapInArrow(go, "s binary").collect()]
    return sum(parts, np.zeros(size))


def spread(blocks: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of the columns (1 for a constant one), to bring them near 0 before they become 4-byte numbers."""
    first = totals(blocks, lambda x, y, f: np.concatenate([[len(x)], x.sum(0)]), width + 1, BLOCK)
    mean = first[1:] / max(first[0], 1)
    std = np.sqrt(totals(blocks, lambda x, y, f: ((x - mean) ** 2).sum(0), width, BLOCK) / max(first[0], 1))
    return mean, np.where(std > 0, std, 1.0)


Point = np.ndarray


def _minimise(size: int, max_iter: int) -> Generator[list[Point], list[tuple[float, Point]], Point]:
    """L-BFGS that asks for losses and gradients at some points and ends with the best one."""
    at = np.zeros(size)
    loss, g = (yield [at])[0]
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(max_iter):
        d, kept = -g, []
        for s, y in reversed(past):
            kept.append((s @ d) / (s @ y))
            d = d - kept[-1] * y
        if past:
            s, y = past[-1]
            d = d * ((s @ y) / (y @ y))
        else:
            d = d / max(1.0, float(np.linalg.norm(g)))
        for (s, y), a in zip(past, reversed(kept)):
            d = d + (a - (y @ d) / (s @ y)) * s
        tried = [at + t * d for t in STEPS]
        best = min(zip((yield tried), tried), key=lambda x: x[0][0])
        if not best[0][0] < loss - 1e-6 * max(abs(loss), 1e-6):
            if not past:
                break
            past.clear()  # once more along the gradient
            continue
        (new_loss, new_g), new = best
        if (new - at) @ (new_g - g) > 1e-12:
            past = [*past[-9:], (new - at, new_g - g)]
        at, loss, g = new, new_loss, new_g
    return at


def fits(blocks: DataFrame, features: Callable, size: int, folds: list[int], problems: list[tuple[int | None, float]], max_iter: int) -> list[tuple[np.ndarray, float]]:
    """``(weights, intercept)`` of each problem ``(fold left out or None, L2 weight)``.

    The objective is that of ``LinearSVC``: the mean hinge loss, L2 on the weights of
    features standardised over the rows of the fit. ``features(x)`` gives ``size``
    float32 numbers a row; sums are kept as doubles.
    """
    def moments(x, y, f):
        z = features(x)
        out = []
        for k in folds:
            v = z[f == k].astype(np.float64)
            out += [[len(v)], v.sum(0), (v * v).sum(0)]
        return np.concatenate(out)
    by_fold = totals(blocks, moments, len(folds) * (1 + 2 * size)).reshape(len(folds), -1)
    seen = [np.array([k != left_out for k in folds]) for left_out, _ in problems]
    scale = []
    for use in seen:
        m = by_fold[use].sum(0)
        n, mean = m[0], m[1:size + 1] / max(m[0], 1)
        std = np.sqrt(np.maximum(m[size + 1:] - n * mean * mean, 0) / max(n - 1, 1))
        scale.append((n, mean, np.divide(1.0, std, out=np.zeros(size), where=std > 0)))

    running = {i: _minimise(size + 1, max_iter) for i in range(len(problems))}
    asked, done = {i: next(r) for i, r in running.items()}, {}
    while asked:
        points = [(i, p) for i, ps in asked.items() for p in ps]
        plane = np.empty((size + 1, len(points)))
        for c, (i, p) in enumerate(points):
            n, mean, inverse = scale[i]
            plane[:-1, c] = p[:-1] * inverse
            plane[-1, c] = p[-1] - mean @ plane[:-1, c]
        plane = plane.astype(np.float32)
        columns = [np.flatnonzero([seen[i][j] for i, _ in points]) for j in range(len(folds))]
        planes, m = [np.ascontiguousarray(plane[:, c]) for c in columns], len(points)

        def sums(x, y, f):
            z, sign, out = features(x), (2 * y - 1).astype(np.float32)[:, None], np.zeros((size + 2, m))
            for k, p, c in zip(folds, planes, columns):
                a, s = (z[f == k], sign[f == k]) if len(folds) > 1 else (z, sign)
                if len(a) and len(c):
                    slack = 1 - s * (a @ p[:-1] + p[-1])
                    on = (slack > 0) * s
                    out[0, c] = np.maximum(slack, 0).sum(0, dtype=np.float64)
                    out[1:-1, c], out[-1, c] = -(a.T @ on), -on.sum(0, dtype=np.float64)
            return out.ravel()
        t = totals(blocks, sums, (size + 2) * m).reshape(size + 2, m)
        found: dict[int, list] = {i: [] for i in asked}
        for c, (i, p) in enumerate(points):
            n, mean, inverse = scale[i]
            loss, g, bias = t[0, c] / max(n, 1), t[1:-1, c] / max(n, 1), t[-1, c] / max(n, 1)
            reg = problems[i][1]
            found[i].append((loss + reg / 2 * p[:-1] @ p[:-1], np.append((g - mean * bias) * inverse + reg * p[:-1], bias)))
        for i in list(asked):
            try:
                asked[i] = running[i].send(found[i])
            except StopIteration as end:
                weights = end.value[:-1] * scale[i][2]
                done[i] = (weights, float(end.value[-1] - scale[i][1] @ weights))
                del asked[i]
    return [done[i] for i in range(len(problems))]

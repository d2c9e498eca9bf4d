"""Principal components of few rows with many columns.

MLlib's PCA holds a columns x columns matrix; with few rows and many columns the
rows x rows Gram matrix has the same non-zero eigenvalues. Here

1. the columns are dealt into blocks that each hold whole columns; a task
   centres (and scales) its columns and forms its part of the Gram matrix;
2. the parts are added up per row: one row of the matrix is one Spark row;
3. the leading eigenvectors come from subspace iteration: the matrix stays
   distributed, a step multiplies it by the current basis; estimates come from
   the (small) products of the basis and its image, and the scaled images of the
   estimates are the next basis;
4. the scores are the eigenvectors times the root of the eigenvalue, the
   loadings one more pass over the columns.

Only (components + ``EXTRA``) squared numbers ever reach the driver. Sign rule:
the score of largest magnitude is positive (ties: the first row).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.operators.joins import attach_row
from loomstat.session import cut_lineage, scratch_path

EXTRA = 16           # more basis vectors than components, for fast convergence
CELLS = 4_000_000    # numbers in a block of columns
MOST_ROWS = 20_000   # "few" rows: a row of the Gram matrix is one array
STEPS = 500
EXACT = 1e-13


def long_cells(df: DataFrame, row: str, features: str) -> DataFrame:
    """``row, col, x`` of rows with an array of features."""
    return df.select(F.col(row).alias("row"), F.posexplode(F.col(features).cast("array<double>")).alias("col", "x"))


def numbered_rows(cells: DataFrame) -> tuple[DataFrame, int]:
    """``row, i``: rows in order, and how many there are (few: checked)."""
    rows = cells.select("row").distinct()
    n = rows.count()
    if n > MOST_ROWS:
        raise ValueError(f"{n} rows: the Gram matrix is for at most {MOST_ROWS}; use the column covariance")
    all_ = rows.agg(F.array_sort(F.collect_list("row")).alias("all"))  # at most MOST_ROWS
    return all_.select(F.posexplode("all").alias("i", "row")), n


def _saved(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "gram")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gram_rows(cells: DataFrame, rows: DataFrame, n: int, standardise: bool = False) -> DataFrame:
    """``i, g``: row ``i`` of the Gram matrix of the centred columns.

    ``cells(row, col, x)`` may leave out zeros. Columns without spread add
    nothing (also when standardised).
    """
    per = max(1, CELLS // max(n, 1))  # columns of a block
    columns = cells.agg(F.count_distinct("col")).first()[0]
    blocks = max(1, -(-columns // per))

    def part(t: pa.Table) -> pa.Table:
        cols, at = np.unique(t.column("col").to_numpy(zero_copy_only=False), return_inverse=True)
        x = np.zeros((n, len(cols)))
        np.add.at(x, (t.column("i").to_numpy(), at), t.column("x").to_numpy())
        x -= x.mean(0)
        if standardise:
            s = x.std(0, ddof=1) if n > 1 else np.zeros(len(cols))
            x = x[:, s > 0] / s[s > 0]
        g = x @ x.T
        return pa.table({"i": np.arange(n, dtype=np.int32), "g": pa.array(list(g), pa.list_(pa.float64()))})

    def add(t: pa.Table) -> pa.Table:
        g = np.zeros(n)
        for x in t.column("g"):
            g += x.values.to_numpy()
        return pa.table({"i": pa.array([t.column("i")[0].as_py()], pa.int32()), "g": pa.array([g], pa.list_(pa.float64()))})

    parts = (cells.where(F.col("x").isNotNull()).join(rows, "row")
             .select(F.pmod(F.xxhash64("col"), F.lit(blocks)).alias("block"), F.col("i").cast("int").alias("i"), "col", "x")
             .groupBy("block").applyInArrow(part, "i int, g array<double>"))
    return parts.groupBy("i").applyInArrow(add, "i int, g array<double>")


def eigenvectors(gram: DataFrame, n: int, k: int, steps: int = STEPS, exact: float = EXACT):
    """``(DataFrame(i, u), eigenvalues, trace)``: the ``k`` leading eigenvectors
    of the symmetric matrix ``gram(i, g)``; ``u`` holds a row's entries."""
    m = min(n, k + EXTRA)
    gram = _saved(gram)
    trace = gram.agg(F.sum(F.get("g", F.col("i")))).first()[0] or 0.0
    # a start without structure: hashes of (row, column) between -1 and 1
    start = F.array(*[F.xxhash64("i", F.lit(c)) / F.lit(float(1 << 63)) for c in range(m)])
    basis, before, values = gram.select("i", start.alias("u")), None, np.zeros(m)
    if trace <= 0:
        return basis.select("i", F.array(*[F.lit(0.0)] * k).alias("u")), np.zeros(k), 0.0
    for _ in range(steps):
        image = cut_lineage(_product(gram, basis, m))
        uu, uw = _inner(image, "u", "u", m), _inner(image, "u", "w", m)
        e, v = np.linalg.eigh((uu + uu.T) / 2)  # the basis is made orthonormal on the small side
        white = v[:, e > 1e-12 * e[-1]] / np.sqrt(e[e > 1e-12 * e[-1]])
        small = white.T @ ((uw + uw.T) / 2) @ white
        values, turn = np.linalg.eigh(small)
        order = [x for x in np.argsort(-values) if values[x] > 1e-13 * max(values[-1], 1e-300)]
        values, vectors = values[order], white @ turn[:, order]  # directions without spread leave the basis
        if before is not None and len(before) >= min(k, len(values)) and np.max(np.abs(values[:k] - before[:k][:len(values)])) <= exact * values[0]:
            break
        before, m = values, len(values)
        # images of the present estimates, scaled: close to orthonormal again
        basis = _turned(image.select("i", F.col("w").alias("u")), vectors / values)
    return _turned(image.select("i", "u"), vectors[:, :k]), np.concatenate([values, np.zeros(k)])[:k], trace


def _product(gram: DataFrame, basis: DataFrame, m: int) -> DataFrame:
    """``i, u, w``: the basis and its image, row by row."""
    whole = basis.agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "u"))), lambda s: s["u"]).alias("all"))  # rows x m numbers
    cols = whole.select(F.array(*[_column(c) for c in range(m)]).alias("cols"))
    dot = lambda c: F.aggregate(F.zip_with("g", c, lambda a, b: a * b), F.lit(0.0).cast("double"), lambda s, v: s + v)
    image = attach_row(gram, cols).select("i", F.transform("cols", dot).alias("w"))
    return image.join(basis, "i").select("i", "u", "w")


def _column(c: int):
    return F.transform("all", lambda u: F.get(u, c))


def _inner(df: DataFrame, a: str, b: str, m: int) -> np.ndarray:
    """The m x m inner products of two array columns."""
    row = F.transform(a, lambda x: F.transform(b, lambda y: x * y))  # m x m numbers of each of the few rows
    cells = df.select(F.posexplode(F.flatten(row)).alias("c", "x")).groupBy("c").agg(F.sum("x").alias("x"))
    out = np.zeros(m * m)
    for r in cells.collect():  # m x m rows
        out[r["c"]] = r["x"]
    return out.reshape(m, m)


def _turned(df: DataFrame, by: np.ndarray) -> DataFrame:
    """``i, u``: each row's ``u`` times a small matrix."""
    out = [sum((F.get("u", x) * F.lit(float(by[x, y])) for x in range(len(by))), F.lit(0.0)) for y in range(by.shape[1])]
    return df.select("i", F.array(*out).alias("u"))


def pca_few_rows(cells: DataFrame, k: int, standardise: bool = False):
    """K12 for few rows: ``(scores(row, pc1..), ratios, cells' column loadings(col, pc1..))``.

    ``cells(row, col, x)``: absent and NULL cells count as 0; row and column ids
    of any orderable type; repeated cells add up. With fewer than ``k``
    directions of spread the others are 0.
    """
    rows, n = numbered_rows(cells)
    rows = cut_lineage(rows)
    if n == 0:
        raise ValueError("no rows")
    vectors, values, trace = eigenvectors(gram_rows(cells, rows, n, standardise), n, min(k, n))
    values = np.concatenate([values, np.zeros(k - len(values))])
    root = np.sqrt(np.where(values > 1e-12 * max(values[0], 1e-300), values, 0.0))
    u = [F.coalesce(F.get("u", c), F.lit(0.0)) for c in range(k)]
    u = cut_lineage(vectors.select("i", *[x.alias(f"u{c}") for c, x in enumerate(u)]))
    top = u.agg(*[F.max_by(F.signum(f"u{c}"), F.struct(F.round(F.abs(f"u{c}"), 12), -F.col("i"))) for c in range(k)]).first()
    sign = [1.0 if not s else float(s) for s in top]
    scores = u.join(rows, "i").select("row", *[(F.col(f"u{c}") * F.lit(float(root[c] * sign[c]))).alias(f"pc{c + 1}") for c in range(k)])
    ratios = [float(v / trace) if trace else 0.0 for v in values]
    # loadings: columns times eigenvectors; centring drops out as each vector sums to 0
    safe = [F.lit(float(sign[c] / root[c]) if root[c] else 0.0) for c in range(k)]
    weighed = cells.where(F.col("x").isNotNull()).join(rows, "row").join(u, "i")
    sums = [F.sum(F.col("x") * F.col(f"u{c}") * safe[c]).alias(f"pc{c + 1}") for c in range(k)]
    if standardise:
        spread = F.sqrt(F.greatest(F.sum(F.col("x") * F.col("x")) - F.sum("x") * F.sum("x") / n, F.lit(0.0)) / max(n - 1, 1))
        loadings = weighed.groupBy("col").agg(*sums, spread.alias("_s")).select(
            "col", *[F.coalesce(F.try_divide(f"pc{c + 1}", "_s"), F.lit(0.0)).alias(f"pc{c + 1}") for c in range(k)])
    else:
        loadings = weighed.groupBy("col").agg(*sums)
    return scores, ratios, loadings

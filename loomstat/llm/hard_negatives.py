"""Hard-negative mining with L2AP-style threshold joins.

Anchors (every row whose id is divisible by ``EVERY``) meet all rows in cells
of at most about ``CHUNK`` anchors by ``BLOCK`` rows. In a cell:

1. ``Index``: dimensions in order of their energy, in strips. For a threshold, a
   row is indexed only up to the first strip after which its suffix norm can no
   longer reach the threshold alone; the dimensions covered by that bound are
   omitted. A strip's list is the rows that still need it.
2. ``Index.scan`` adds up partial scores strip by strip, bounds the rest by the
   product of the remaining norms, and computes the exact score only for pairs
   that can still reach their anchor's threshold.
3. ``windows`` lowers the thresholds of the anchors whose windows are not full,
   until each window holds ``TOP`` rows or its lower end is reached.

A first join finds each anchor's ``TOP`` rows of the same label, a second one the
rows of other labels in the window of each of these. A cell passes on at most
``TOP`` rows for each window, which Spark merges; nothing else leaves a cell.

Defined results: rows with a null id, a null label, a null vector or a null or
non-finite component take no part; of rows that share an id the least (label,
vector) counts; shorter vectors count as padded by zeros; ties go to the smaller
id; scores must fit into 62 bits (else the query raises); extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomstat.llm import common as C

EVERY = 100          # ids of anchors
TOP = 5              # positives of an anchor, negatives of a positive
LEAST, MOST = 80, 100  # percent of the positive's score that a negative may have
STRIP = 8            # dimensions whose partial scores are added up at once
CHUNK = 4096         # anchors of a cell
BLOCK = 8192         # rows of a cell
TILE = 256           # anchors scored at once
LOWER = 0.7          # each round lowers the thresholds by this factor


def vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """``id, label, v`` of the rows that take part: labels and components as the scores use them."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    whole = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    return (rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole)
            .select(F.col("vec_id").cast("long").alias("id"), label.alias("label"), F.transform(x, lambda c: F.floor(c * scale)).alias("v")))


class Index:
    """Rows of a block, their dimensions in strips, most energy first."""

    def __init__(self, y: np.ndarray):
        self.exact = y
        self.by = np.argsort(-(y.astype(np.float64) ** 2).sum(0), kind="stable")
        self.y = y[:, self.by].astype(np.float64)
        self.cuts = [*range(0, y.shape[1], STRIP), y.shape[1]] if y.shape[1] else [0]
        self.rest = _suffix_norms(self.y, self.cuts)  # norms from each cut on
        self.most = float(self.rest[:, 0].max()) if len(y) else 0.0

    def scan(self, q: np.ndarray, low: np.ndarray):
        """``(anchor, row, score)`` of all pairs with ``score >= low[anchor]``, row by row in order."""
        z = q[:, self.by].astype(np.float64)
        rest = _suffix_norms(z, self.cuts)
        norm = np.maximum(rest[:, 0], 1e-300)
        least = float(np.min(low / norm)) if len(q) else 0.0  # suffixes of a smaller norm reach no threshold
        depth = (self.rest >= least).sum(1) if least > 0 else np.full(len(self.y), len(self.cuts))
        depth = np.minimum(depth, len(self.cuts) - 1)  # strips of each row that are indexed
        order = np.argsort(-depth, kind="stable")
        y, depth = self.y[order], depth[order]
        part = np.zeros((len(z), len(y)))
        for s, (a, b) in enumerate(zip(self.cuts[:-1], self.cuts[1:])):
            n = int(np.searchsorted(-depth, -s, "left"))  # rows with more than s strips
            if n:
                part[:, :n] += z[:, a:b] @ y[:n, a:b].T
        bound = part + rest[:, depth] * self.rest[order, depth]
        slack = 1e-9 * norm * max(self.most, 1.0) + 1e-6
        i, k = np.nonzero(bound >= (low - slack)[:, None])
        k = order[k]
        score = np.empty(len(i), np.int64)
        for lo in range(0, len(i), 1 << 16):
            x, w = q[i[lo:lo + (1 << 16)]], self.exact[k[lo:lo + (1 << 16)]]
            score[lo:lo + (1 << 16)] = np.einsum("ij,ij->i", x, w)
        ok = score >= low[i]
        i, k, score = i[ok], k[ok], score[ok]
        sort = np.lexsort((k, i))
        return i[sort], k[sort], score[sort]


def _suffix_norms(x: np.ndarray, cuts: list[int]) -> np.ndarray:
    out = np.zeros((len(x), len(cuts)))
    for s in range(len(cuts) - 2, -1, -1):
        out[:, s] = out[:, s + 1] + (x[:, cuts[s]:cuts[s + 1]] ** 2).sum(1)
    return np.sqrt(out)


def _best(score: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` largest scores, earlier places first among ties."""
    if len(score) > 4 * top:
        least = np.partition(score, len(score) - top)[len(score) - top]
        some = np.flatnonzero(score >= least)
    else:
        some = np.arange(len(score))
    return some[np.argsort(-score[some], kind="stable")[:top]]


def windows(index: Index, q: np.ndarray, fit, start: np.ndarray, floor: np.ndarray, lower: float = LOWER):
    """Fill the windows of the anchors ``q``, lowering their thresholds.

    ``fit(anchor, rows, scores)`` returns the row places of each of the anchor's
    windows among the rows found so far and whether all windows are full;
    ``start`` and ``floor`` are the first and the last threshold of each anchor.
    Returns ``(anchor, window, rows, scores)`` tuples.
    """
    out, live, at = [], np.arange(len(q)), np.ceil(np.maximum(start, floor))
    while len(live):
        i, k, score = index.scan(q[live], at[live])
        cut = np.searchsorted(i, np.arange(len(live) + 1))
        left = []
        for x, a in enumerate(live.tolist()):
            rows, s = k[cut[x]:cut[x + 1]], score[cut[x]:cut[x + 1]]
            found, full = fit(a, rows, s)
            if full or at[a] <= floor[a]:
                out += [(a, w, rows[p], s[p]) for w, p in enumerate(found) if len(p)]
            else:
                left.append(a)
        live = np.array(left, np.int64)
        step = np.floor(at[live] * lower)
        scale = np.sqrt((q[live].astype(np.float64) ** 2).sum(1)) * index.most
        at[live] = np.maximum(np.where(step > 0.05 * scale, step, floor[live]), floor[live])
    return out


def _matrix(col: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    size = np.diff(np.asarray(col.offsets)).astype(np.int64)
    flat = np.asarray(col.flatten()).astype(np.int64)
    out = np.zeros((len(size), max(width or 0, int(size.max()) if len(size) else 0)), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def _sides(left: pa.Table, right: pa.Table):
    """Both sides of a cell by id, of one width; scores must stay exact."""
    left, right = left.sort_by("id"), right.sort_by("id")
    q, y = _matrix(left.column("v")), _matrix(right.column("v"))
    width = max(q.shape[1], y.shape[1])
    q, y = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (q, y))
    norms = [float(np.sqrt((m.astype(np.float64) ** 2).sum(1)).max()) if m.size else 0.0 for m in (q, y)]
    if norms[0] * norms[1] >= float(1 << 62):
        raise OverflowError("scores do not fit into 62 bits")
    return left, right, q, y


def _tiles(n: int):
    return ((a, min(a + TILE, n)) for a in range(0, n, TILE))


def _positives(left: pa.Table, right: pa.Table) -> pa.Table:
    """Per anchor, the ``TOP`` rows of its label in a cell."""
    left, right, q, y = _sides(left, right)
    index, ids = Index(y), np.asarray(right.column("id"))
    label, of, mine = np.asarray(right.column("label")), np.asarray(left.column("label")), np.asarray(left.column("id"))
    found: list[tuple] = []
    for a, z in _tiles(len(q)):
        def fit(i, rows, s, a=a):
            some = np.flatnonzero((label[rows] == of[a + i]) & (ids[rows] != mine[a + i]))
            best = some[_best(s[some], TOP)]
            return [best], len(best) == TOP
        norm = np.sqrt((q[a:z].astype(np.float64) ** 2).sum(1)) * index.most
        found += [(a + i, rows, s) for i, _, rows, s in windows(index, q[a:z], fit, 0.5 * norm, np.floor(-norm) - 1)]
    at = np.repeat(np.array([i for i, _, _ in found], np.int64), [len(r) for _, r, _ in found])
    rows = np.concatenate([r for _, r, _ in found] or [np.zeros(0, np.int64)])
    score = np.concatenate([s for _, _, s in found] or [np.zeros(0, np.int64)])
    return pa.table({"anchor_id": mine[at], "positive_id": ids[rows], "positive_score": score})


def _negatives(left: pa.Table, right: pa.Table) -> pa.Table:
    """Per anchor and positive, the first ``TOP`` rows of other labels in the window."""
    left, right, q, y = _sides(left, right)
    index, ids = Index(y), np.asarray(right.column("id"))
    label, of, mine = np.asarray(right.column("label")), np.asarray(left.column("label")), np.asarray(left.column("id"))
    held = left.column("positives").to_pylist()
    low = [[-(-LEAST * p["score"] // 100) for p in x] for x in held]  # the least whole score of each window
    high = [[p["score"] * MOST // 100 for p in x] for x in held]
    open_ = [[a <= b for a, b in zip(x, z)] for x, z in zip(low, high)]
    out: list[tuple] = []
    some = np.array([i for i, x in enumerate(open_) if any(x)], np.int64)
    floor = np.array([min(a for a, o in zip(low[i], open_[i]) if o) for i in some], np.float64)
    start = np.array([min(b for b, o in zip(high[i], open_[i]) if o) for i in some], np.float64) * 0.96
    for a, z in _tiles(len(some)):
        def fit(i, rows, s, a=a):
            i = int(some[a + i])
            other = np.flatnonzero(label[rows] != of[i])
            found, full = [], True
            for lo, hi, o in zip(low[i], high[i], open_[i]):
                mine_ = other[(s[other] >= lo) & (s[other] <= hi)] if o else other[:0]
                best = mine_[_best(s[mine_], TOP)]
                found.append(best)
                full &= not o or len(best) == TOP
            return found, full
        out += [(int(some[a + i]), w, rows, s) for i, w, rows, s in windows(index, q[some[a:z]], fit, start[a:z], floor[a:z], 0.96)]
    cols: list[list] = [[] for _ in range(5)]
    for i, w, rows, s in out:
        for c, v in zip(cols, (np.full(len(rows), mine[i]), np.full(len(rows), held[i][w]["id"]), ids[rows], np.full(len(rows), held[i][w]["score"]), s)):
            c.append(v)
    names = ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")
    return pa.table({k: np.concatenate(c or [np.zeros(0, np.int64)]).astype(np.int64) for k, c in zip(names, cols)})


def _cells(anchors: DataFrame, rows: DataFrame, chunks: int, blocks: int, go, schema: str) -> DataFrame:
    """Each chunk of anchors meets each block of rows once."""
    left = anchors.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
    right = rows.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks))).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<long>")))
    empty = pa.schema([(c.split()[0], pa.int64()) for c in schema.split(", ")]).empty_table()

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        return go(a, b) if a.num_rows and b.num_rows else empty

    return left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInArrow(cell, schema)


def _first(df: DataFrame, by: list[str], *order: Column) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= TOP)


def mine(rows: DataFrame) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    C.prepare(rows.sparkSession)
    base = C.cut(vectors(rows).groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v"))
    is_anchor = F.col("id") % EVERY == 0
    n, a = base.agg(F.count(F.lit(1)), F.count_if(is_anchor)).first()
    chunks, blocks = max(1, -(-a // CHUNK)), max(1, -(-n // BLOCK))
    anchors = base.where(is_anchor).select(*(F.col(c).alias(c) for c in base.columns))  # columns of its own: both sides meet in a cogroup
    near = C.cut(_cells(anchors, base, chunks, blocks, _positives, "anchor_id long, positive_id long, positive_score long"))
    # at most TOP rows of an anchor come from each block
    held = (_first(near, ["anchor_id"], F.desc("positive_score"), F.col("positive_id")).groupBy(F.col("anchor_id").alias("id"))
            .agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives")))  # TOP entries
    found = _cells(anchors.join(held, "id"), base, chunks, blocks, _negatives,
                   "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    return (_first(found, ["anchor_id", "positive_id"], F.desc("negative_score"), F.col("negative_id"))
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


def op13_l2ap_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(C.documents(spark, sf_dir, "embeddings"))


ORACLE = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, a.label AS of, b.id AS id, b.label AS label, list_dot_product(a.v, b.v)::BIGINT AS score
      FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 100 = 0),
p AS (SELECT anchor_id, of, id AS positive_id, score AS positive_score FROM s WHERE label = of
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)::INTEGER AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.of
 AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""

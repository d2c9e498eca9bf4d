"""Helpers shared by the training-data operators.

Texts are read from Arrow buffers and split into words with numpy over whole
groups of documents, so no Python runs per byte. Work arrays cover at most
``SEGMENT`` bytes (a longer document is cut at a separator and joined again),
which bounds the memory of a task however long one text is.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.session import ensure_checkpoint_dir, scratch_path, ship_package

SEGMENT = 250_000

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Byte table: True where a byte lies in one of the closed ranges."""
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a:b + 1] = True
    return t


#: words are ``[^\x20\x09-\x0D]+``
SPACES = separators((0x20, 0x20), (0x09, 0x0D))
#: words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of lower-cased bytes
PUNCT = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def prepare(spark: SparkSession) -> SparkSession:
    """Shared folder and package for the executors (idempotent)."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def cut(df: DataFrame) -> DataFrame:
    """The rows as a table written to the shared folder: lineage ends there,
    and so do the constraints that a checkpointed plan would carry on."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._loomstat_table = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables written by ``cut`` that nothing reads any more (their
    successors are written in full)."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t._loomstat_table)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


_EMPTY: dict[str, Callable[[], None]] = {}


def in_use(owner: str, empty: Callable[[], None] = lambda: None) -> None:
    """Called in a worker by the step that runs there: the caches of all other
    steps are emptied, as workers outlive the steps that filled them."""
    for k in [k for k in _EMPTY if k != owner]:
        _EMPTY.pop(k)()
    _EMPTY[owner] = empty


def release(spark: SparkSession) -> None:
    """Let the shuffle files of finished steps go: Spark removes them when the
    driver's garbage collector finds their plans unused."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def hashed_sample(df: DataFrame, n: int, seed: int, *cols: str) -> pa.Table:
    """The ``n`` rows whose id has the least seeded hash: columns ``cols``.

    The cut is found on the hashes alone, so no task gathers texts.
    """
    u = F.xxhash64(F.lit(seed), "doc_id")
    least = df.select(u.alias("u")).orderBy("u").limit(n).agg(F.max("u")).first()[0]
    return df.where(u <= F.lit(least)).orderBy(u, *cols).limit(n).select(*cols).toArrow()


def held_out(col: str, mod: int, rest: int) -> Column:
    """crc32 of the id as text, modulo ``mod``, equals ``rest`` (null id: false)."""
    return F.coalesce(F.crc32(F.col(col).cast("string").cast("binary")) % mod == rest, F.lit(False))


def buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    col = pc.fill_null(pc.cast(col, pa.large_string()), "")
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = col.buffers()[2] if len(col) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offs


def groups(offs: np.ndarray, size: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes sum to about ``size`` (a longer row stands alone)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, SEGMENT + 1)
        _POWERS.clear()
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            a = np.full(n, base, np.uint64)
            a[0] = 1
            _POWERS.append(np.cumprod(a, dtype=np.uint64))
    return _POWERS[0][:n], _POWERS[1][:n]


_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)


def _words_of(b: np.ndarray, cuts: np.ndarray, sep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word = ~sep[b]
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    cuts = cuts[(cuts > 0) & (cuts < len(b))]
    start[cuts] = word[cuts]
    end[cuts - 1] = word[cuts - 1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    power, inverse = _powers(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_VALUES[b] * power[:len(b)], out=total[1:])
    h = (total[e] - total[s]) * inverse[s]
    return mix(h + (e - s).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)), s, e


def words(data: np.ndarray, offs: np.ndarray, sep: np.ndarray, lower: bool = True):
    """64-bit hashes of the words of some rows.

    Returns ``(hash, start, end, first)``: byte positions within
    ``data[offs[0]:offs[-1]]`` and, per row, the index of its first word
    (one more entry than rows).
    """
    base, n = int(offs[0]), int(offs[-1] - offs[0])
    b = data[base:base + n]
    if lower:
        b = LOWER[b]
    cuts = offs - base
    if n <= 2 * SEGMENT:
        parts = [_words_of(b, cuts, sep)] if n else []
    else:
        parts, i = [], 0
        while i < n:
            j = min(i + SEGMENT, n)
            while j < n and not sep[b[j]]:  # a word stays in one segment
                cut = np.flatnonzero(sep[b[j:j + SEGMENT]])
                j = j + int(cut[0]) if len(cut) else min(j + SEGMENT, n)
            h, s, e = _words_of(b[i:j], cuts - i, sep)
            parts.append((h, s + i, e + i))
            i = j
    if not parts:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, np.zeros(len(offs), np.int64)
    h, s, e = (np.concatenate(x) if len(parts) > 1 else x[0] for x in zip(*parts))
    return h, s, e, np.searchsorted(s, cuts)


def word_grams(raw: np.ndarray, start: np.ndarray, end: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of words (byte ranges of ``raw``), each with its closing space:
    ``context << 8 | byte``, with up to ``depth`` bytes of context back to the
    space before the word, and the index of the word."""
    n = end - start + 1
    word = np.repeat(np.arange(len(start)), n)
    k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)  # place in the word
    at = np.repeat(start, n) + k
    padded = np.concatenate([raw, [0x20]]).astype(np.int64)
    byte = np.where(k == n[word] - 1, 0x20, padded[np.minimum(at, len(raw))])
    key = byte
    for d in range(1, depth + 1):  # the space before the word is context too
        c = np.where(k >= d, padded[np.maximum(at - d, 0)], np.where(k == d - 1, 0x20, 0))
        key = key | (c << (8 * d))
    return key, word


def running_text(raw: np.ndarray, start: np.ndarray, end: np.ndarray, first: np.ndarray, head: bytes,
                 tail: bytes = b"") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows as running text: ``head``, the row's words (byte ranges of ``raw``,
    all its bytes but separators), a space after each, ``tail``.

    Returns ``(bytes, row, word)``: where each row begins (one more entry than
    rows) and where each word begins.
    """
    n, rows = end - start + 1, len(first) - 1
    around = len(head) + len(tail)
    total = np.concatenate([[0], np.cumsum(n)])
    row = total[first] + np.arange(rows + 1) * around
    word = total[:-1] + np.repeat(np.arange(rows), np.diff(first)) * around + len(head)
    inside = np.ones(int(row[-1]), bool)
    text = np.full(len(inside), 0x20, np.uint8)
    inside[word + n - 1] = False
    for k, byte in enumerate(head):
        text[row[:-1] + k], inside[row[:-1] + k] = byte, False
    for k, byte in enumerate(reversed(tail)):
        text[row[1:] - 1 - k], inside[row[1:] - 1 - k] = byte, False
    text[inside] = raw[~SPACES[raw]]
    return text, row, word


def running_grams(text: np.ndarray, row: np.ndarray, head: int, depth: int, step: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(from, to, key, event)`` over parts of ``step`` bytes of ``running_text``:
    ``context << 8 | byte`` with the ``depth`` bytes before, whatever they are; an
    event is any byte but those of the ``head``, which holds ``depth`` bytes at least."""
    for x in range(0, len(text), step):
        y = min(x + step, len(text))
        back = min(x, depth)
        part = text[x - back:y].astype(np.int64)
        key = part.copy()
        for d in range(1, depth + 1):
            key[d:] |= part[:-d] << (8 * d) if d < len(part) else 0
        event = np.ones(y - x, bool)
        near = row[np.searchsorted(row, x - head, "right"):np.searchsorted(row, y)]
        for k in range(head):
            at = near[(near + k >= x) & (near + k < y)] + k - x
            event[at] = False
        yield x, y, key[back:], event


def add_spans(total: np.ndarray, begin: np.ndarray, x: int, values: np.ndarray) -> None:
    """Add the values of the bytes from ``x`` on to the spans (beginning at
    ``begin``, each up to the next) in which they lie."""
    lo = max(int(np.searchsorted(begin, x, "right")) - 1, 0)
    hi = int(np.searchsorted(begin, x + len(values)))
    if lo < hi:
        total[lo:hi] += np.add.reduceat(values, np.maximum(begin[lo:hi] - x, 0))


def _forest(edges: DataFrame) -> DataFrame:
    """Each task replaces its edges by stars with the same components."""
    def go(batches):
        root: dict = {}

        def top(x):
            while (y := root.setdefault(x, x)) != x:
                root[x] = x = root[y]
            return x

        schema = None
        for batch in batches:
            schema = batch.schema
            for x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = top(x), top(y)
                if x != y:
                    root[max(x, y)] = min(x, y)
        if schema is not None:
            node = [x for x in root if top(x) != x]
            yield pa.RecordBatch.from_arrays([pa.array([top(x) for x in node], schema.field("a").type), pa.array(node, schema.field("b").type)], names=["a", "b"])

    return edges.select("a", "b").mapInArrow(go, edges.select("a", "b").schema)


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``edges(a, b)``: ``(node, root)``.

    Minimum-label propagation with a pointer jump in each round; only
    aggregates and equi-joins, cut each round. Tasks first reduce their edges
    to stars, and once more after these are dealt by their leaves: a leaf has at
    most one edge of each task, where a root may have most of all edges.
    """
    stars = cut(_forest(_forest(edges).repartition("b")))
    both = cut(stars.select("a", "b").union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .where("a <> b").distinct())
    discard(stars)
    table = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                        .select("node", F.least("node", "m").alias("root")))
    label = table
    while True:
        near = (both.join(label, both["b"] == label["node"]).groupBy("a").agg(F.min("root").alias("m")))
        step = (label.join(near, label["node"] == near["a"])
                .select("node", F.least("root", "m").alias("root"), F.col("root").alias("old")))
        up = label.select(F.col("node").alias("root"), F.col("root").alias("top"))
        new = cut(step.join(up, "root", "left")
                          .select("node", F.coalesce(F.least("root", "top"), "root").alias("root"), "old"))
        moved = new.where("root <> old").limit(1).count()
        discard(table)
        table, label = new, new.select("node", "root")
        if not moved:
            discard(both)
            return label

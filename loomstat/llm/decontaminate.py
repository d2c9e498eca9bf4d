"""Benchmark decontamination with an FM-index per training shard.

A shard is one Arrow batch of documents. Its words become ids of the
benchmark's vocabulary; stretches that cannot hold a test phrase (a word or a
pair of neighbours that no phrase has, or fewer words than the shortest
phrase) are left out, which is lossless. The remaining stretches are indexed:
suffix array, Burrows-Wheeler transform, wavelet matrix for ranks and a
sampled suffix array. All phrases are searched backwards at once; the matching
rows are walked to sampled positions and their word ranges merged into the
spans to remove.

Phrases are all windows of ``window`` words of an item, or the whole item when
it has fewer words. The benchmark is taken in blocks of at most ``BLOCK_WORDS``
words, so the broadcast has a fixed bound; each block is one pass.

Defined results: null or wordless texts have no words and no hits; null or
wordless items have no phrase; an item with a null id marks words but is not
listed; repeated rows stay repeated; extra columns are ignored; an empty table
of either kind gives no rows or no hits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import common as C

WINDOW = 10
BLOCK_WORDS = 2_000_000
SAMPLE = 16  # every so many text positions keep their place


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; ``text`` ends with its unique least symbol."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:n - step] = rank[step:] + 1
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1 or step >= n:
            return order
        step *= 2


class FMIndex:
    """Backward search over a sequence of non-negative ids (vectorised over patterns)."""

    def __init__(self, ids: np.ndarray, sample: int = SAMPLE):
        text = np.concatenate([ids.astype(np.int64) + 1, [0]])
        self.n = len(text)
        sa = suffix_array(text)
        bwt = text[sa - 1]
        self.top = int(text.max())
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.top + 1))])
        self.levels = []
        x = bwt
        for bit in range(max(1, self.top.bit_length()) - 1, -1, -1):
            ones = (x >> bit) & 1
            count = np.concatenate([[0], np.cumsum(ones)]).astype(np.int64)
            self.levels.append((bit, count, self.n - int(count[-1])))
            x = np.concatenate([x[ones == 0], x[ones == 1]])
        self.kept = (sa % sample == 0) | (sa == self.n - 1)
        self.place = np.where(self.kept, sa, -1)

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbols ``c`` among the first ``i`` of the transform."""
        s = np.zeros_like(i)
        for bit, ones, zeros in self.levels:
            up = ((c >> bit) & 1).astype(bool)
            i = np.where(up, zeros + ones[i], i - ones[i])
            s = np.where(up, zeros + ones[s], s - ones[s])
        return i - s

    def step(self, rows: np.ndarray) -> np.ndarray:
        """Row of the suffix one position to the left."""
        c, i, s = np.zeros_like(rows), rows, np.zeros_like(rows)
        for bit, ones, zeros in self.levels:
            up = (ones[i + 1] - ones[i]).astype(bool)
            c = (c << 1) | up
            i = np.where(up, zeros + ones[i], i - ones[i])
            s = np.where(up, zeros + ones[s], s - ones[s])
        return self.before[c] + i - s

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row range of each pattern (rows of a 2-d array of ids)."""
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        for k in range(patterns.shape[1] - 1, -1, -1):
            c = patterns[:, k].astype(np.int64) + 1
            known = c <= self.top
            c = np.where(known, c, 0)
            lo, hi = self.before[c] + self.rank(c, lo), self.before[c] + self.rank(c, hi)
            hi = np.where(known, hi, lo)
        return lo, np.maximum(lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows by walking to a sampled one."""
        out, walked = np.empty(len(rows), np.int64), 0
        todo, at = np.arange(len(rows)), rows
        while len(todo):
            done = self.kept[at]
            out[todo[done]] = self.place[at[done]] + walked
            todo, at = todo[~done], self.step(at[~done])
            walked += 1
        return out


class Phrases:
    """Test phrases of one block of items: vocabulary, neighbour pairs and distinct windows."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], window: int):
        every = np.concatenate([w for _, w in items]) if items else np.zeros(0, np.uint64)
        self.vocabulary = np.unique(every)
        seen: dict[bytes, set] = {}
        pairs = []
        for name, w in items:
            ids = self.ids(w)
            m = min(window, len(ids))
            pairs.append(ids[:-1] * (len(self.vocabulary) + 1) + ids[1:])
            for k in range(len(ids) - m + 1):
                seen.setdefault(ids[k:k + m].tobytes(), set()).add(name)
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        by: dict[int, list] = {}
        for key, names in seen.items():
            by.setdefault(len(key) // 8, []).append((key, names))
        #: per length: the windows and the items that have each
        self.windows = [(m, np.frombuffer(b"".join(k for k, _ in v), np.int64).reshape(-1, m), [n for _, n in v]) for m, v in sorted(by.items())]
        self.least = min((m for m, _, _ in self.windows), default=1)

    def ids(self, h: np.ndarray) -> np.ndarray:
        """1-based vocabulary ids, 0 for other words."""
        v = self.vocabulary
        if not len(v) or not len(h):
            return np.zeros(len(h), np.int64)
        at = np.searchsorted(v, h)
        at[at == len(v)] = 0
        return np.where(v[at] == h, at + 1, 0)

    def stretches(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the word stretches that may hold a window."""
        n = len(ids)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        key = ids[:-1] * (len(self.vocabulary) + 1) + ids[1:]
        near = (ids[:-1] > 0) & (ids[1:] > 0)
        at = np.flatnonzero(near)
        p = np.searchsorted(self.pairs, key[at])
        p[p == len(self.pairs)] = 0
        near[at] = self.pairs[p] == key[at] if len(self.pairs) else False
        cut = first[(first > 0) & (first < n)]
        near[cut - 1] = False
        start = (ids > 0) & ~np.concatenate([[False], near])
        end = (ids > 0) & ~np.concatenate([near, [False]])
        s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
        long = e - s >= self.least
        return s[long], e[long]

    def find(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
        """Occurrences in a shard: starts, lengths and ``(word, length index, window)``."""
        s, e = self.stretches(ids, first)
        if not len(s):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), []
        size = e - s
        head = np.concatenate([[0], np.cumsum(size + 1)])[:-1]  # a stretch and a 0 after it
        text = np.zeros(int((size + 1).sum()), np.int64)
        source = np.repeat(s - head, size + 1) + np.arange(len(text))
        inside = np.ones(len(text), bool)
        inside[head + size] = False
        text[inside] = ids[source[inside]]
        index = FMIndex(text)
        starts, lengths, which = [], [], []
        for k, (m, windows, _) in enumerate(self.windows):
            lo, hi = index.search(windows)
            n = hi - lo
            w = np.repeat(np.arange(len(windows)), n)
            rows = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            at = source[index.locate(rows)]
            starts.append(at)
            lengths.append(np.full(len(at), m))
            which.append((k, w))
        found = [(p, k, x) for (k, w), at in zip(which, starts) for p, x in zip(at.tolist(), w.tolist())]
        return np.concatenate(starts), np.concatenate(lengths), found


def _spans(starts: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words covered, and the maximal runs of covered words."""
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, starts, 1)
    np.add.at(delta, starts + lengths, -1)
    hit = np.cumsum(delta[:n]) > 0
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return hit, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


SCHEMA = "_row long, doc_id long, n_words long, hits array<long>, items array<string>, spans array<array<long>>"


def _shard(p: Phrases, b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word ids of all documents of a batch, each row's first word, and the
    byte range of every word of the vocabulary."""
    data, offs = C.buffer(b.column("text"))
    parts = []
    for i, j in C.groups(offs):
        h, s, e, first = C.words(data, offs[i:j + 1], C.PUNCT)
        ids = p.ids(h)
        known = np.where(ids > 0, [s, e], 0) + np.where(ids > 0, int(offs[i]), 0)
        parts.append((ids, first, known))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros((2, 0), np.int64)
    base = np.cumsum([0] + [len(x[0]) for x in parts])
    first = np.concatenate([x[1][:-1] + o for x, o in zip(parts, base)] + [base[-1:]])
    return np.concatenate([x[0] for x in parts]), first, np.concatenate([x[2] for x in parts], 1)


def _scan(docs: DataFrame, phrases) -> DataFrame:
    def go(batches):
        C.in_use("decontaminate")
        p = phrases.value
        for b in batches:
            rows = {"n_words": [], "hits": [], "items": [], "spans": []}
            ids, first, place = _shard(p, b)
            offs = C.buffer(b.column("text"))[1]
            starts, lengths, found = p.find(ids, first)
            hit, lo, hi = _spans(starts, lengths, len(ids))
            names: dict[int, set] = {}
            doc_of = np.searchsorted(first, [f[0] for f in found], "right") - 1 if found else []
            for d, (_, k, x) in zip(np.asarray(doc_of).tolist(), found):
                names.setdefault(d, set()).update(n for n in p.windows[k][2][x] if n is not None)
            total = np.concatenate([[0], np.cumsum(hit)])
            # a span lies in one document, as stretches do, unless two meet at a border
            for d in range(b.num_rows):
                a, z = int(first[d]), int(first[d + 1])
                rows["n_words"].append(z - a)
                if total[z] == total[a]:
                    rows["hits"].append([])
                    rows["items"].append([])
                    rows["spans"].append([])
                    continue
                rows["hits"].append((np.flatnonzero(hit[a:z])).tolist())
                rows["items"].append(sorted(names.get(d, ())))
                k0, k1 = np.searchsorted(hi, a, "right"), np.searchsorted(lo, z, "left")
                o = int(offs[d])
                rows["spans"].append([[int(place[0, max(x, a)]) - o, int(place[1, min(y, z) - 1]) - o] for x, y in zip(lo[k0:k1].tolist(), hi[k0:k1].tolist())])
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), b.column("doc_id"), pa.array(rows["n_words"], pa.int64()), pa.array(rows["hits"], pa.list_(pa.int64())),
                 pa.array(rows["items"], pa.list_(pa.string())), pa.array(rows["spans"], pa.list_(pa.list_(pa.int64())))],
                names=["_row", "doc_id", "n_words", "hits", "items", "spans"])

    return docs.mapInArrow(go, SCHEMA)


def drop_contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` (all columns) without an occurring phrase."""
    sc = C.prepare(docs.sparkSession).sparkContext
    for phrases in _blocks(bench, window, block_words):
        docs = _clean(docs, sc.broadcast(phrases))
    return docs


def _clean(docs: DataFrame, phrases) -> DataFrame:
    def go(batches):
        C.in_use("decontaminate")
        p = phrases.value
        for b in batches:
            ids, first, _ = _shard(p, b)
            starts, _, _ = p.find(ids, first)
            keep = np.ones(b.num_rows, bool)
            keep[np.searchsorted(first, starts, "right") - 1] = False
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(go, docs.schema)


def _blocks(bench: DataFrame, window: int, block_words: int):
    """Phrases of the benchmark, at most about ``block_words`` words at a time."""
    size = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // block_words) or 1  # a word has one character at least
    rows = bench.select(F.col("item_id").cast("string").alias("item_id"), "text")
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == k) if n > 1 else rows
        items = []
        for b in part.toArrow().to_batches():
            data, offs = C.buffer(b.column("text"))
            names = b.column("item_id").to_pylist()
            h, _, _, first = C.words(data, offs, C.PUNCT)
            items += [(names[r], h[first[r]:first[r + 1]]) for r in range(b.num_rows) if first[r + 1] > first[r]]
        yield Phrases(items, window)


def contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document row: ``doc_id, n_words, n_hit, items, spans``.

    ``items`` are the ids, as sorted strings, of items with an occurring
    phrase; ``spans`` are the merged byte ranges ``[start, end)`` to remove.
    """
    spark = C.prepare(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = [spark.sparkContext.broadcast(p) for p in _blocks(bench, window, block_words)]
    if len(blocks) == 1:
        return _scan(rows, blocks[0]).select("doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), "items", "spans")
    rows = C.cut(rows)  # the row numbers must be the same in each pass
    out = None
    for p in blocks:
        one = _scan(rows, p)
        out = one if out is None else out.union(one)
    merged = out.groupBy("_row").agg(  # as many rows each as the benchmark has blocks
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.size(F.array_distinct(F.flatten(F.collect_list("hits")))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    join = F.aggregate(  # spans of two blocks may overlap
        "spans", F.array().cast("array<array<bigint>>"),
        lambda acc, s: F.when((F.size(acc) > 0) & (F.element_at(F.element_at(acc, F.greatest(F.size(acc), F.lit(1))), 2) >= s[0]),
                              F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                                       F.array(F.array(F.element_at(F.element_at(acc, -1), 1),
                                                       F.greatest(F.element_at(F.element_at(acc, -1), 2), s[1])))))
        .otherwise(F.concat(acc, F.array(s))))
    return merged.select("doc_id", "n_words", "n_hit", "items", join.alias("spans"))


def remove_spans(text: str, spans: list[list[int]]) -> str:
    """The text without the bytes of ``spans``."""
    raw, at, out = text.encode(), 0, []
    for s, e in spans:
        out.append(raw[at:s])
        at = e
    return b"".join([*out, raw[at:]]).decode()


def op6_fm_index_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(C.documents(spark, sf_dir), C.documents(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, w, least(10, len(w)) AS m FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS k FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM b)),
dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS k FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM b) WHERE len(w) >= m)),
occ AS (SELECT doc_id, i, dw.m AS m, item_id FROM dw JOIN win ON dw.k = win.k AND dw.m = win.m),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM occ) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(it.n, 0) AS BIGINT) AS n_items,
 sha256(coalesce(it.l, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN it ON it.doc_id = d.doc_id
"""

"""Exact top-k retrieval of single documents by cosine (T2, T6) without a pair table.

Documents are dealt into blocks and queries into chunks; each (chunk, block)
cell meets once. In a cell the common terms of all queries are scored as a matrix
product, the others from inverted lists, and the documents that can be among the
``k`` best are scored exactly (``Block``). A cell of a few queries takes them one
by one (``Lists``): the inverted lists are ordered by impact (weight over norm),
each term with the largest impact as its upper bound. A query takes its terms by
falling bound: while the bounds of the terms left could still lift a document that
was not met yet into the top ``k``, their lists are read; after that they only
complete documents that can still get there. A cell passes on ``k`` documents for
each query, which Spark merges: no row for a pair of documents ever exists.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomstat.operators.sampling import ordered_index
from loomstat.session import cut_lineage

CELL_DOCS = 16_000     # documents of a block
CELL_QUERIES = 16_000  # queries of a chunk
FEW_QUERIES = 8        # a cell with fewer takes them one by one
BATCH = 256            # queries scored at once
HOT_TERMS = 1_024      # terms of the matrix, at most
HOT_SHARE = 0.004      # of the pairs of a cell that meet in such a term, at least
DIGITS = 12            # similarities are compared to so many digits, ties by document


class Lists:
    """Inverted lists of one block, impacts falling along each list."""

    def __init__(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n: int):
        order = np.lexsort((doc, -impact, term))
        self.n, self.doc, self.impact = n, doc[order], impact[order]
        self.terms, first = np.unique(term[order], return_index=True)
        self.cut = np.concatenate([first, [len(term)]])
        self.bound = self.impact[self.cut[:-1]] if len(first) else np.zeros(0)
        by_doc = np.lexsort((term, doc))
        self.at = np.searchsorted(doc[by_doc], np.arange(n + 1))
        self.doc_term, self.doc_impact = np.searchsorted(self.terms, term[by_doc]), impact[by_doc]

    def best(self, term: np.ndarray, weight: np.ndarray, k: int, digits: int = DIGITS):
        """``(documents, scores, postings read)`` of the ``k`` best for a query of unit norm."""
        at = np.searchsorted(self.terms, term)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == term if len(self.terms) else np.zeros(len(term), bool)
        at, weight = at[known], weight[known]
        most = weight * self.bound[at]
        order = np.argsort(-most, kind="stable")
        at, weight, most = at[order], weight[order], most[order]
        rest = np.concatenate([np.cumsum(most[::-1])[::-1], [0.0]])  # what the terms from here on can add
        score, read = np.zeros(self.n), 0
        for i, (t, w) in enumerate(zip(at.tolist(), weight.tolist())):
            a, z = self.cut[t], self.cut[t + 1]
            score[self.doc[a:z]] += w * self.impact[a:z]
            read += z - a
            if i % 8 == 7 and self.n > k and rest[i + 1] < score.max():  # else it can't be under the k-th best either
                least = np.partition(score, self.n - k)[self.n - k]
                if rest[i + 1] < least - 10.0 ** -digits:  # no document without a term so far can get there
                    alive = np.flatnonzero(score + rest[i + 1] >= least - 10.0 ** -digits)
                    if len(alive) <= 8 * k:
                        return self._complete(alive, score, at[i + 1:], weight[i + 1:], k, read, digits)
        met = np.flatnonzero(score > 0)
        return *self._top(met, score[met], k, digits), read

    def _complete(self, alive, score, at, weight, k, read, digits):
        """The other terms of the documents that are left, from their own entries."""
        w = np.zeros(len(self.terms))
        w[at] = weight
        full = score[alive].copy()
        for x, d in enumerate(alive.tolist()):
            a, z = self.at[d], self.at[d + 1]
            full[x] += w[self.doc_term[a:z]] @ self.doc_impact[a:z]
            read += z - a
        return *self._top(alive, full, k, digits), read

    @staticmethod
    def _top(docs, score, k, digits):
        score = np.round(score, digits)
        order = np.lexsort((docs, -score))
        order = order[score[order] > 0][:k]
        return docs[order], score[order]


class Block:
    """Documents of one block, for many queries at once.

    Terms that many documents and queries hold are multiplied as a matrix of
    4-byte numbers, the others are added up from their lists; what can reach the
    top ``k`` within the error of the 4-byte sums is scored once more exactly.
    """

    def __init__(self, terms: np.ndarray, impact: np.ndarray, size: np.ndarray):
        self.n, self.impact, self.at = len(size), impact, np.concatenate([[0], np.cumsum(size)])
        order = np.argsort(terms, kind="stable")
        ordered = terms[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[:len(ordered)])
        self.terms, self.cut = ordered[first], np.concatenate([first, [len(ordered)]])
        self.term = np.empty(len(terms), np.int32)  # of the documents' entries
        self.term[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(self.cut))
        self.doc, self.by_term = np.repeat(np.arange(self.n), size)[order], impact[order]

    def best(self, terms: np.ndarray, weight: np.ndarray, size: np.ndarray, k: int, digits: int = DIGITS):
        """``(documents, scores)`` of the ``k`` best for each query of unit norm."""
        many, none = len(size), (np.zeros(0, np.int64), np.zeros(0))
        if not len(self.terms):
            yield from (none for _ in range(many))
            return
        at = np.searchsorted(self.terms, terms)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == terms
        query = np.repeat(np.arange(many), size)[known]
        at, weight = at[known], weight[known]
        end = np.searchsorted(query, np.arange(many + 1))

        share = np.bincount(at, minlength=len(self.terms)) * np.diff(self.cut).astype(np.float64)
        hot = np.argsort(-share, kind="stable")[:HOT_TERMS]
        hot = hot[share[hot] >= HOT_SHARE * many * self.n]
        column = np.full(len(self.terms), -1)
        column[hot] = np.arange(len(hot))
        dense = np.zeros((len(hot), self.n), np.float32)
        for h, t in enumerate(hot.tolist()):
            dense[h, self.doc[self.cut[t]:self.cut[t + 1]]] = self.by_term[self.cut[t]:self.cut[t + 1]]
        # unit vectors without negative weights: a 4-byte sum errs by at most so much
        slack = 2 * (len(hot) + 16) * 2.0 ** -24 + 10.0 ** -digits
        whole = np.zeros(len(self.terms))
        for lo in range(0, many, BATCH):
            hi = min(lo + BATCH, many)
            a, z = end[lo], end[hi]
            of, w, q = at[a:z], weight[a:z], query[a:z] - lo
            is_hot = column[of] >= 0
            left = np.zeros((hi - lo, len(hot)), np.float32)
            left[q[is_hot], column[of[is_hot]]] = w[is_hot]
            score = left @ dense
            cold, cold_w = of[~is_hot], w[~is_hot]
            cold_at = np.searchsorted(q[~is_hot], np.arange(hi - lo + 1))
            starts, ends = self.cut[cold].tolist(), self.cut[cold + 1].tolist()
            for i in range(hi - lo):
                b, e = cold_at[i], cold_at[i + 1]
                if b < e:
                    spans = [slice(x, y) for x, y in zip(starts[b:e], ends[b:e])]
                    docs = np.concatenate([self.doc[s] for s in spans])
                    added = np.concatenate([self.by_term[s] for s in spans]) * np.repeat(cold_w[b:e], self.cut[cold[b:e] + 1] - self.cut[cold[b:e]])
                    score[i] += np.bincount(docs, added, self.n)
            least = np.zeros(hi - lo, np.float32)
            if self.n > k:
                least = np.maximum(np.partition(score, self.n - k, axis=1)[:, self.n - k] - slack, 0).astype(np.float32)
            found = np.flatnonzero((score > 0) & (score >= least[:, None]))
            row = found // self.n
            cut = np.searchsorted(row, np.arange(hi - lo + 1))
            for i in range(hi - lo):
                docs = found[cut[i]:cut[i + 1]] - i * self.n
                if not len(docs):
                    yield none
                    continue
                mine = slice(end[lo + i], end[lo + i + 1])
                whole[at[mine]] = weight[mine]
                length = self.at[docs + 1] - self.at[docs]
                first = np.cumsum(length) - length
                entry = np.repeat(self.at[docs] - first, length) + np.arange(length.sum())
                exact = np.add.reduceat(whole[self.term[entry]] * self.impact[entry], first)
                whole[at[mine]] = 0
                yield Lists._top(docs, exact, k, digits)


def _rows(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms, weights over the norm and the number of terms of each row."""
    size = np.array([len(x) for x in t.column("terms")], np.int64)
    flat = lambda c: t.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat("terms"), flat("ws").astype(np.float64) / np.repeat(t.column("norm").to_numpy(), size), size


def _cell(k: int, digits: int):
    def go(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["doc1", "doc2", "similarity"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        right = right.sort_by("doc")
        ids, queries = right.column("doc").combine_chunks(), left.column("doc").combine_chunks()
        terms, impact, size = _rows(right)
        of, weight, length = _rows(left)
        if len(length) < FEW_QUERIES:
            lists, at = Lists(np.repeat(np.arange(len(size)), size), terms, impact, len(size)), np.concatenate([[0], np.cumsum(length)])
            best = [lists.best(of[a:z], weight[a:z], k, digits)[:2] for a, z in zip(at[:-1], at[1:])]
        else:
            best = list(Block(terms, impact, size).best(of, weight, length, k, digits))
        number = np.repeat(np.arange(len(best)), [len(d) for d, _ in best])
        return pa.table([queries.take(pa.array(number, pa.int64())), ids.take(pa.array(np.concatenate([d for d, _ in best]), pa.int64())),
                         pa.array(np.concatenate([s for _, s in best]), pa.float64())], names=names)
    return go


def numbered_terms(docs: DataFrame) -> DataFrame:
    """``term, t``: the terms of ``docs`` by falling document frequency (ties by
    term), so that common terms have small numbers; cut, as two sides read it."""
    df = docs.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return ordered_index(df.select((-F.col("df")).alias("less"), "term"), ["less", "term"], "t").select("term", "t")


def unit_rows(vectors: DataFrame, terms: DataFrame, w: str = "n", number: str = "long") -> DataFrame:
    """``doc, norm, terms, ws``: one row for each document, its terms by number.

    A row is copied into every cell it meets, so it is kept small: numbers of
    type ``number``, weights as they came, one norm. Terms without a number (of
    queries only) count in the norm.
    """
    x = vectors.select(F.col("doc").cast("long").alias("doc"), F.col("term").alias("word"), F.col(w).alias("w")).where("w <> 0")
    x = x.join(terms, F.col("word").eqNullSafe(F.col("term")), "left")
    entry = F.when(F.col("t").isNotNull(), F.struct(F.col("t").cast(number).alias("t"), "w"))
    rows = x.groupBy("doc").agg(F.sqrt(F.sum(F.col("w").cast("double") * F.col("w").cast("double"))).alias("norm"),
                                F.sort_array(F.collect_list(entry)).alias("e"))  # of one document
    return rows.select("doc", "norm", F.transform("e", lambda e: e["t"]).alias("terms"), F.transform("e", lambda e: e["w"]).alias("ws"))


def top_documents(queries: DataFrame, docs: DataFrame, k: int, w: str = "n", cell_docs: int = CELL_DOCS, cell_queries: int = CELL_QUERIES, digits: int = DIGITS) -> DataFrame:
    """``doc1, doc2, similarity, rank``: the ``k`` most similar documents of each
    query, of those that share a term (ties: smaller document id).

    ``queries`` and ``docs`` are vectors ``(doc, term, <w>)`` with non-negative
    weights and whole-number ids; a query without a term has no row. The query's
    norm covers all of its terms; similarities are compared to ``digits`` digits; restrict it to the vocabulary before if the
    others should not count. Every row is copied once for each chunk or block of
    the other side, so cells are as large as a task's memory allows.
    """
    terms = numbered_terms(docs.where(F.col(w) != 0))
    number = "int" if terms.count() < 1 << 31 else "long"
    # both sides are counted before they are dealt
    left, right = (cut_lineage(unit_rows(v, terms, w, number)) for v in (queries, docs))
    n, m, cores = left.count(), right.count(), docs.sparkSession.sparkContext.defaultParallelism
    for part in (1, 2, 4, 8, 16):  # smaller cells while there are too few for the cores
        chunks, blocks = max(1, -(-n * part // cell_queries)), max(1, -(-m * min(part, 4) // cell_docs))
        if chunks * blocks >= 2 * cores:
            break
    left = left.withColumn("c", F.pmod(F.xxhash64("doc"), F.lit(chunks))).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")))
    right = right.withColumn("b", F.pmod(F.xxhash64("doc"), F.lit(blocks))).withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<long>")))
    found = left.groupBy("c", "b").cogroup(right.groupBy("c", "b")).applyInArrow(_cell(k, digits), "doc1 long, doc2 long, similarity double")
    # at most k rows of a query come from each block
    rank = F.row_number().over(Window.partitionBy("doc1").orderBy(F.desc("similarity"), "doc2"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("doc1", "doc2", "similarity", "rank")

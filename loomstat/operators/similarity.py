"""Document vectors and cosine retrieval.

Vectors are sparse long tables ``(doc, term, w)``. Cosine scores are an
equi-join on ``term`` followed by a (doc1, doc2) aggregate: only pairs that
share a term are produced, never the full product. Terms shared by many
documents are scored in blocked cells instead of per-term pairs; both ways
give the same pairs. Pairs with no shared term have similarity 0 and are
accounted for by counting, not enumeration.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomstat.operators.joins import attach_row
from loomstat.operators.sampling import ordered_index


def closed_vocabulary(vec: DataFrame, train_vec: DataFrame) -> DataFrame:
    """T1 / 2.9-21: keep only terms seen in training (semi-join on vocabulary)."""
    return vec.join(train_vec.select("term").distinct(), "term", "left_semi")


def doc_frequency_filter(vec: DataFrame, doc: str, min_df: int = 1,
                         max_df_ratio: float = 1.0) -> DataFrame:
    """E5: keep terms whose document frequency is within [min_df, max_df * N]."""
    n_docs = vec.agg(F.countDistinct(doc).alias("_N"))
    dfreq = vec.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
    keep = (dfreq.join(F.broadcast(n_docs), how="inner")
            .filter((F.col("_df") >= min_df) & (F.col("_df") <= F.col("_N") * max_df_ratio))
            .select("term"))
    return vec.join(keep, "term", "left_semi")


def tfidf(vec: DataFrame, doc: str, n: str = "n") -> DataFrame:
    """Smoothed idf ``ln((1 + N) / (1 + df)) + 1`` times the raw count."""
    n_docs = vec.agg(F.countDistinct(doc).alias("_N"))
    dfreq = vec.groupBy("term").agg(F.count(F.lit(1)).alias("_df"))
    idf = dfreq.join(F.broadcast(n_docs), how="inner").select(
        "term", (F.log((1 + F.col("_N")) / (1 + F.col("_df"))) + 1).alias("idf"))
    return vec.join(idf, "term").withColumn("w", F.col(n) * F.col("idf")).drop("idf")


def _hot_cell_dots(q: pd.DataFrame, t: pd.DataFrame) -> pd.DataFrame:
    """Dot products of every test doc with every train doc of one cell over
    the hot terms (sparse test rows against a dense train block)."""
    cols = {"doc1": pd.Series(dtype="object"), "doc2": pd.Series(dtype="object"),
            "dot": pd.Series(dtype="float64")}
    if q.empty or t.empty:
        return pd.DataFrame(cols)
    width = int(max(t["idx"].map(lambda a: max(a) if len(a) else -1).max(),
                    q["idx"].map(lambda a: max(a) if len(a) else -1).max())) + 1
    T = np.zeros((len(t), max(width, 1)))
    for r, (ix, vs) in enumerate(zip(t["idx"], t["val"])):
        T[r, np.asarray(ix, dtype=np.int64)] = np.asarray(vs, dtype=np.float64)
    out = []
    for d1, ix, vs in zip(q["doc"], q["idx"], q["val"]):
        ix = np.asarray(ix, dtype=np.int64)
        dots = T[:, ix] @ np.asarray(vs, dtype=np.float64)
        nz = np.nonzero((T[:, ix] != 0).any(axis=1))[0]  # all that share a term, as the term join gives them
        if len(nz):
            out.append(pd.DataFrame({"doc1": d1, "doc2": t["doc"].to_numpy()[nz], "dot": dots[nz]}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame(cols)


def cosine_pairs(test: DataFrame, train: DataFrame, w: str = "n",
                 hot_pairs: int = 1_000_000, cell_docs: int = 2_000) -> DataFrame:
    """T2 / J8 + F10 on sparse vectors ``(doc, term, w)``.

    Returns ``(doc1, doc2, similarity)`` for every pair sharing a term; the
    test side must already be restricted to the training vocabulary so that
    unseen terms leave the norm too (2.9-21).

    A term shared by ``df_test`` test and ``df_train`` training documents
    costs ``df_test * df_train`` joined rows. Terms up to ``hot_pairs`` go
    through the term equi-join. Hotter terms never pair rows per term: each
    document's hot-term weights become one sparse row, documents are hashed
    into cells of at most ``cell_docs`` per side, and each (test chunk,
    train block) cell meets once in a ``cogroup`` whose numpy product emits
    one partial dot per document pair. Both parts are summed per pair.
    """
    a = test.select(F.col("doc").alias("doc1"), "term", F.col(w).cast("double").alias("w1"))
    b = train.select(F.col("doc").alias("doc2"), "term", F.col(w).cast("double").alias("w2"))
    d1 = a.groupBy("term").agg(F.count(F.lit(1)).alias("_d1"))
    d2 = b.groupBy("term").agg(F.count(F.lit(1)).alias("_d2"))
    cost = d1.join(d2, "term").select("term", (F.col("_d1") * F.col("_d2") > hot_pairs).alias("_hot"))
    cost = cost.persist()
    hot = cost.filter(F.col("_hot")).select("term")
    any_hot = hot.limit(1).count() > 0
    if any_hot:
        cold = cost.filter(~F.col("_hot")).select("term")
        a_c, b_c = a.join(cold, "term", "left_semi"), b.join(cold, "term", "left_semi")
    else:
        a_c, b_c = a, b
    cold_dots = (a_c.join(b_c, "term")
                 .groupBy("doc1", "doc2").agg(F.sum(F.col("w1") * F.col("w2")).alias("dot")))
    dots = cold_dots
    if any_hot:
        hot_idx = ordered_index(hot, ["term"], "_ti")
        n_hot = hot_idx.count()
        ha = a.join(hot_idx, "term").groupBy("doc1").agg(
            F.collect_list("_ti").alias("idx"), F.collect_list("w1").alias("val"))
        hb = b.join(hot_idx, "term").groupBy("doc2").agg(
            F.collect_list("_ti").alias("idx"), F.collect_list("w2").alias("val"))
        # dense train rows are n_hot wide: keep a block within ~256 MB
        per_block = max(1, min(cell_docs, (256 << 20) // (8 * max(n_hot, 1))))
        n_b = max(1, -(-hb.count() // per_block))
        n_c = max(1, -(-ha.count() // cell_docs))
        qa = (ha.withColumnRenamed("doc1", "doc")
              .withColumn("c", F.pmod(F.xxhash64("doc"), F.lit(n_c)))
              .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_b - 1)))))
        tb = (hb.withColumnRenamed("doc2", "doc")
              .withColumn("b", F.pmod(F.xxhash64("doc"), F.lit(n_b)))
              .withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(n_c - 1)))))
        schema = (f"doc1 {test.schema['doc'].dataType.simpleString()}, "
                  f"doc2 {train.schema['doc'].dataType.simpleString()}, dot double")
        hot_dots = (qa.groupBy("c", "b").cogroup(tb.groupBy("c", "b"))
                    .applyInPandas(_hot_cell_dots, schema))
        dots = cold_dots.unionByName(hot_dots).groupBy("doc1", "doc2").agg(F.sum("dot").alias("dot"))
    n1 = a.groupBy("doc1").agg(F.sqrt(F.sum(F.col("w1") * F.col("w1"))).alias("norm1"))
    n2 = b.groupBy("doc2").agg(F.sqrt(F.sum(F.col("w2") * F.col("w2"))).alias("norm2"))
    return (dots.join(n1, "doc1").join(n2, "doc2")
            .select("doc1", "doc2", (F.col("dot") / (F.col("norm1") * F.col("norm2")))
                    .alias("similarity")))


def rank_targets(pairs: DataFrame, test_docs: DataFrame, train_docs: DataFrame) -> DataFrame:
    """W3 + T3: rank of the same-named training document for each test document.

    Ranking follows a stable sort by similarity descending over training
    documents in name order, so rank = 1 + (#higher) + (#equal and earlier).
    Zero-similarity training documents are counted from positions instead
    of being enumerated. A test document whose name has no training document
    gets no rank (the reference would fail there).
    """
    tr = ordered_index(train_docs.select(F.col("doc").alias("doc2")).distinct(), ["doc2"], "pos2")
    n_train = tr.agg(F.count(F.lit(1)).alias("n_train"))
    p = pairs.join(tr, "doc2")
    target = (test_docs.select(F.col("doc").alias("doc1")).distinct()
              .join(tr.withColumnRenamed("doc2", "doc1"), "doc1")
              .join(p.filter(F.col("doc1") == F.col("doc2"))
                    .select("doc1", F.col("similarity").alias("t_sim")), "doc1", "left")
              .withColumn("t_sim", F.coalesce("t_sim", F.lit(0.0)))
              .withColumnRenamed("pos2", "t_pos"))
    j = p.join(target, "doc1")
    better = ((F.col("similarity") > F.col("t_sim"))
              | ((F.col("similarity") == F.col("t_sim")) & (F.col("pos2") < F.col("t_pos"))))
    nz = j.groupBy("doc1").agg(
        F.count_if(better).alias("n_better_nz"),
        F.count_if((F.col("similarity") > 0) & (F.col("pos2") < F.col("t_pos"))).alias("n_nz_before"))
    t = target.join(nz, "doc1", "left").na.fill(0, ["n_better_nz", "n_nz_before"])
    # when the target's similarity is 0, zero-similarity documents placed
    # before it in name order also rank above it
    zero_before = F.when(F.col("t_sim") == 0, F.col("t_pos") - F.col("n_nz_before")).otherwise(0)
    return t.select("doc1", F.col("t_sim").alias("target_similarity"),
                    (1 + F.col("n_better_nz") + zero_before).cast("long").alias("rank"))


def ir_scores(ranks: DataFrame) -> DataFrame:
    """Mean rank, mean target similarity, accuracy (rank == 1)."""
    return ranks.agg(F.avg("rank").alias("mean_rank"),
                     F.avg("target_similarity").alias("mean_cosine"),
                     F.avg((F.col("rank") == 1).cast("double")).alias("accuracy"),
                     F.count(F.lit(1)).alias("n_queries"))


def extreme_pairs(pairs: DataFrame, test_docs: DataFrame | None = None,
                  train_docs: DataFrame | None = None) -> DataFrame:
    """Most and least similar (doc1, doc2) over all test x train
    pairs (ties: larger names for the maximum, smaller for the minimum).

    Pairs sharing no term have similarity 0 and are not enumerated: given
    the document lists, the first test document with fewer scored partners
    than there are training documents, and its first unscored training
    document, give the zero-similarity minimum.
    """
    s = F.struct("similarity", "doc1", "doc2")
    ext = pairs.agg(F.max(s).alias("hi"), F.min(s).alias("lo"))
    if test_docs is not None and train_docs is not None:
        d1 = test_docs.select(F.col("doc").alias("doc1")).distinct()
        d2 = train_docs.select(F.col("doc").alias("doc2")).distinct()
        n2 = d2.agg(F.count(F.lit(1)).alias("_n2"))
        deg = pairs.groupBy("doc1").agg(F.count(F.lit(1)).alias("_deg"))
        short = (d1.join(deg, "doc1", "left").join(F.broadcast(n2), how="inner")
                 .filter(F.coalesce("_deg", F.lit(0)) < F.col("_n2"))
                 .agg(F.min("doc1").alias("_z1")))
        z1 = short.filter(F.col("_z1").isNotNull())
        z2 = (d2.join(F.broadcast(z1), how="inner")
              .join(pairs.select("doc1", "doc2"),
                    (F.col("doc1") == F.col("_z1")) & (d2["doc2"] == pairs["doc2"]), "left_anti")
              .agg(F.min(d2["doc2"]).alias("_z2")))
        zero = attach_row(z1, z2).select(
            F.struct(F.lit(0.0).alias("similarity"), F.col("_z1").alias("doc1"),
                     F.col("_z2").alias("doc2")).alias("_zero"))
        ext = ext.join(F.broadcast(zero), how="left").select(
            "hi", F.when(F.col("_zero").isNotNull(), F.col("_zero")).otherwise(F.col("lo")).alias("lo"))
    return ext.select(
        F.col("hi.doc1").alias("max_doc1"), F.col("hi.doc2").alias("max_doc2"),
        F.col("hi.similarity").alias("max_similarity"),
        F.col("lo.doc1").alias("min_doc1"), F.col("lo.doc2").alias("min_doc2"),
        F.col("lo.similarity").alias("min_similarity"))


def dense_centroids(train: DataFrame, vec: str, label: str) -> DataFrame:
    """Class centroids of dense vectors: mean per (class, position)."""
    x = train.select(F.col(label).alias("label"),
                     F.posexplode(F.col(vec).cast("array<double>")).alias("pos", "x"))
    c = x.groupBy("label", "pos").agg(F.avg("x").alias("x"))
    return c.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"])
        .alias("centroid"))


def cosine_to_centroids(test: DataFrame, centroids: DataFrame, id_col: str, vec: str,
                        block: int = 256, salts: int = 64) -> DataFrame:
    """F10 / J8 for dense vectors: every test vector against every class
    centroid. The centroids are folded into rows of about ``block`` classes;
    every test row meets each of these rows once by an equi-join on (block,
    salt), so work is linear in the test rows and nothing is broadcast by hint."""
    from loomstat import functions as LF
    from loomstat.operators.joins import attach_row
    n = centroids.agg(F.greatest(F.ceil(F.count(F.lit(1)) / block), F.lit(1)).cast("int").alias("_k"))
    few = (attach_row(centroids, n).withColumn("_b", F.pmod(F.xxhash64("label"), F.col("_k")).cast("int"))
           .groupBy("_b").agg(F.collect_list(F.struct("label", "centroid")).alias("_cs"))
           .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    rows = attach_row(test.select(id_col, F.col(vec).cast("array<double>").alias("_v")), n)
    rows = (rows.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(salts)).cast("int"))
            .withColumn("_b", F.explode(F.sequence(F.lit(0), F.col("_k") - 1))))
    pairs = rows.join(few, ["_b", "_salt"]).select(id_col, F.explode(F.transform(
        "_cs", lambda s: F.struct(s["label"].alias("label"),
                                  LF.cosine(F.col("_v"), s["centroid"]).alias("similarity"))))
        .alias("_p"))
    return pairs.select(id_col, "_p.label", "_p.similarity")

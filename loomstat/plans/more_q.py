"""Catalogue part 5: wide principal components, approximate neighbours, retrieval
of single documents, best features, class balancing, mergeable quantiles, JSON files."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.operators import balance, features, gram, models, neighbours, retrieval, sampling, sketches, text
from loomstat.plans.registry import query, t

_WORDS = "list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^a-z]+'), lambda x: x <> '')"


def _words(df):
    return df.withColumn("tokens", F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]+", -1), lambda x: x != ""))


# --- K12: few rows, many columns ----------------------------------------------------------

#: power iteration on the 20 x 20 matrix, the second component after deflation
_PCA_WIDE = f"""
WITH RECURSIVE tok AS (SELECT source, unnest({_WORDS}) AS term FROM documents WHERE source IS NOT NULL),
bag AS (SELECT source, term, count(*)::DOUBLE AS x FROM tok GROUP BY 1, 2),
src AS (SELECT source, row_number() OVER (ORDER BY source) AS i FROM (SELECT DISTINCT source FROM bag)),
n AS (SELECT count(*)::DOUBLE AS n FROM src),
mu AS (SELECT term, sum(x) / (SELECT n FROM n) AS m FROM bag GROUP BY 1),
dots AS (SELECT a.i AS i, b.i AS j, coalesce(d.v, 0) AS v FROM src a CROSS JOIN src b LEFT JOIN (
  SELECT x.source AS s, y.source AS t, sum(x.x * y.x) AS v FROM bag x JOIN bag y USING (term) GROUP BY 1, 2) d ON d.s = a.source AND d.t = b.source),
own AS (SELECT s.i, sum(b.x * mu.m) AS r FROM bag b JOIN mu USING (term) JOIN src s USING (source) GROUP BY 1),
mm AS (SELECT sum(m * m) AS q FROM mu),
g AS (SELECT i, list(v - (SELECT r FROM own o WHERE o.i = dots.i) - (SELECT r FROM own o WHERE o.i = dots.j) + (SELECT q FROM mm) ORDER BY j) AS row FROM dots GROUP BY i),
mat AS (SELECT list(row ORDER BY i) AS g, sum(row[i]) AS trace FROM g),
it1(k, v, w) AS (SELECT 0, list_transform(range(len(g)), lambda i: sin(i + 1.0)), 0.0::DOUBLE FROM mat
  UNION ALL SELECT k + 1, list_transform(y, lambda x: x / s), s FROM (
    SELECT k, y, sqrt(list_dot_product(y, y)) AS s FROM (SELECT k, list_transform(g, lambda r: list_dot_product(r, v)) AS y FROM it1, mat WHERE k < 3000))),
p1 AS (SELECT v, w FROM it1 WHERE k = 3000),
mat2 AS (SELECT list_transform(g, lambda r, i: list_transform(r, lambda x, j: x - p1.w * p1.v[i] * p1.v[j])) AS g FROM mat, p1),
it2(k, v, w) AS (SELECT 0, list_transform(range(len(g)), lambda i: cos(i + 1.0)), 0.0::DOUBLE FROM mat2
  UNION ALL SELECT k + 1, list_transform(y, lambda x: x / s), s FROM (
    SELECT k, y, sqrt(list_dot_product(y, y)) AS s FROM (SELECT k, list_transform(g, lambda r: list_dot_product(r, v)) AS y FROM it2, mat2 WHERE k < 3000))),
p2 AS (SELECT v, w FROM it2 WHERE k = 3000),
z AS (SELECT p1.v AS a, p2.v AS b, p1.w AS wa, p2.w AS wb,
             sign(list_aggregate(p1.v, 'max') + list_aggregate(p1.v, 'min')) AS sa, sign(list_aggregate(p2.v, 'max') + list_aggregate(p2.v, 'min')) AS sb FROM p1, p2)
SELECT source, round(sa * sqrt(wa) * a[i], 3) AS pc1, round(sb * sqrt(wb) * b[i], 3) AS pc2,
       round(wa / trace, 6) AS ratio1, round(wb / trace, 6) AS ratio2 FROM src, z, mat"""


@query("pca_wide", _PCA_WIDE)
def pca_wide(spark, d):
    """K12 for few rows and many columns: sources as rows, every word a column."""
    docs = _words(t(spark, d, "documents", "source", "text").where("source is not null"))
    bag = text.explode_tokens(docs, ["source"], "tokens", "term").groupBy("source", "term").agg(F.count(F.lit(1)).cast("double").alias("x"))
    scores, ratios, _ = gram.pca_few_rows(bag.select(F.col("source").alias("row"), F.col("term").alias("col"), "x"), 2)
    return scores.select(F.col("row").alias("source"), F.round("pc1", 3).alias("pc1"), F.round("pc2", 3).alias("pc2"),
                         F.round(F.lit(ratios[0]), 6).alias("ratio1"), F.round(F.lit(ratios[1]), 6).alias("ratio2"))


# --- M5: approximate neighbours ----------------------------------------------------------

@query("knn_approximate", """
WITH e AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 < floor(count(*) OVER () * 0.7) AS is_train FROM embeddings)
SELECT count(*) * 5 AS neighbours, count(*) AS queries, true AS recall_ok FROM e WHERE NOT is_train""")
def knn_approximate(spark, d):
    """M5: five neighbours from random-projection buckets; recall against the exact search."""
    e = sampling.split_position(t(spark, d, "embeddings"), 0.7, ["vec_id"])
    train, test = e.filter(F.col("split") == "train"), e.filter(F.col("split") == "test")
    found = neighbours.approximate_neighbours(train, test, "vec_id", "embedding", "label")
    recall = neighbours.neighbour_recall(found, models.nearest(train, test, "vec_id", "embedding", "label", 5))
    return recall.select("neighbours", "queries", (F.col("recall") >= 0.9).alias("recall_ok"))


@query("knn_weighted", """
WITH e AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 < floor(count(*) OVER () * 0.7) AS is_train FROM embeddings),
dd AS (SELECT te.vec_id AS qid, tr.vec_id AS tid, tr.label AS nlabel, list_distance(CAST(te.embedding AS DOUBLE[]), CAST(tr.embedding AS DOUBLE[])) AS dist
       FROM e te, e tr WHERE tr.is_train AND NOT te.is_train),
nn AS (SELECT * FROM dd QUALIFY row_number() OVER (PARTITION BY qid ORDER BY dist, tid) <= 5),
v AS (SELECT qid, nlabel, sum(CASE WHEN dist = 0 THEN 1e300 ELSE 1 / dist END) AS votes FROM nn GROUP BY 1, 2)
SELECT qid AS vec_id, CAST(nlabel AS INTEGER) AS predicted FROM v QUALIFY row_number() OVER (PARTITION BY qid ORDER BY votes DESC, nlabel) = 1""")
def knn_weighted(spark, d):
    """M5: 5 nearest training vectors, each voting by the inverse of its distance."""
    e = sampling.split_position(t(spark, d, "embeddings"), 0.7, ["vec_id"])
    return models.knn_vote(e.filter(F.col("split") == "train"), e.filter(F.col("split") == "test"), "vec_id", "embedding", "label", k=5, weights="distance")


# --- T2, T6: single documents ------------------------------------------------------------

def _retrieval_sql(caps=None):
    keep = "rn <= CASE WHEN is_train THEN %d ELSE %d END" % caps if caps else "TRUE"
    return f"""
WITH d AS (SELECT doc_id, source, text, row_number() OVER (ORDER BY doc_id) - 1 < floor(count(*) OVER () * 0.8) AS is_train FROM documents),
dc AS (SELECT *, row_number() OVER (PARTITION BY source, is_train ORDER BY doc_id) AS rn FROM d),
bag AS (SELECT doc_id AS doc, is_train, term, count(*)::DOUBLE AS w FROM (SELECT doc_id, is_train, unnest({_WORDS}) AS term FROM dc WHERE {keep}) GROUP BY ALL),
tr AS (SELECT doc, term, w FROM bag WHERE is_train),
te AS (SELECT doc, term, w FROM bag WHERE NOT is_train AND term IN (SELECT term FROM tr)),
n1 AS (SELECT doc, sqrt(sum(w * w)) AS n FROM te GROUP BY 1), n2 AS (SELECT doc, sqrt(sum(w * w)) AS n FROM tr GROUP BY 1),
p AS (SELECT te.doc AS doc1, tr.doc AS doc2, sum(te.w * tr.w) AS dot FROM te JOIN tr USING (term) GROUP BY 1, 2),
s AS (SELECT doc1, doc2, round(dot / (n1.n * n2.n), 9) AS similarity FROM p JOIN n1 ON n1.doc = doc1 JOIN n2 ON n2.doc = doc2)
SELECT doc1, doc2, similarity, row_number() OVER (PARTITION BY doc1 ORDER BY similarity DESC, doc2)::INTEGER AS rank FROM s QUALIFY rank <= 10"""


def _retrieve(spark, d, caps=None):
    s = sampling.split_position(t(spark, d, "documents", "doc_id", "source", "text"), 0.8, ["doc_id"])
    if caps:
        s = text.first_n_per_group(s.filter(F.col("split") == "train"), "source", ["doc_id"], caps[0]).unionByName(
            text.first_n_per_group(s.filter(F.col("split") == "test"), "source", ["doc_id"], caps[1]))
    e = text.explode_tokens(_words(s).withColumnRenamed("doc_id", "doc"), ["doc", "split"], "tokens", "term")
    bag = e.groupBy("doc", "split", "term").agg(F.count(F.lit(1)).alias("n")).persist()
    train = bag.filter(F.col("split") == "train").select("doc", "term", "n")
    test = bag.filter(F.col("split") == "test").select("doc", "term", "n").join(train.select("term").distinct(), "term", "left_semi")
    top = retrieval.top_documents(test, train, 10, digits=9)
    return top.select("doc1", "doc2", "similarity", F.col("rank").cast("int").alias("rank"))


@query("top_documents", _retrieval_sql())
def top_documents(spark, d):
    """The ten most similar training documents of each test document."""
    return _retrieve(spark, d)


@query("top_documents_400_40", _retrieval_sql((400, 40)))
def top_documents_400_40(spark, d):
    """The same over at most 400 training and 40 test documents of each source."""
    return _retrieve(spark, d, (400, 40))


# --- E5: best features ---------------------------------------------------------------------

@query("best_features", f"""
WITH x AS (SELECT DISTINCT d.doc_id, l.quality AS cls, unnest({_WORDS}) AS term FROM documents d JOIN labels l USING (doc_id)),
docs AS (SELECT DISTINCT d.doc_id, l.quality AS cls FROM documents d JOIN labels l USING (doc_id)),
nc AS (SELECT cls, count(*)::DOUBLE AS n FROM docs GROUP BY 1), tot AS (SELECT sum(n) AS n FROM nc),
o AS (SELECT term, cls, count(*)::DOUBLE AS o FROM x GROUP BY 1, 2),
df AS (SELECT term, sum(o) AS df FROM o GROUP BY 1),
cells AS (SELECT df.term, df.df, nc.cls, nc.n AS n, coalesce(o.o, 0) AS o FROM df CROSS JOIN nc LEFT JOIN o ON o.term = df.term AND o.cls = nc.cls),
c AS (SELECT term, df, sum(power(o - df * cells.n / tot.n, 2) / (df * cells.n / tot.n)
        + CASE WHEN tot.n > df THEN power(df * cells.n / tot.n - o, 2) / ((tot.n - df) * cells.n / tot.n) ELSE 0 END) AS chi2 FROM cells, tot GROUP BY 1, 2)
SELECT term, df::BIGINT AS df, round(chi2, 6) AS chi2, row_number() OVER (ORDER BY round(chi2, 6) DESC, term)::INTEGER AS rank FROM c QUALIFY rank <= 50""")
def best_features(spark, d):
    """E5: the 50 words whose presence depends most on the quality label (chi-square)."""
    docs = t(spark, d, "documents", "doc_id", "text").join(t(spark, d, "labels", "doc_id", "quality"), "doc_id")
    return features.best_terms(_words(docs), "doc_id", "quality", "tokens", 50)


# --- E9: class balancing ---------------------------------------------------------------------

_BAL = """
WITH b AS (SELECT doc_id, quality, ('0x' || substr(md5('7:' || doc_id::VARCHAR), 1, 13))::BIGINT AS u FROM labels),
r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY u, doc_id) - 1 AS pos, count(*) OVER (PARTITION BY quality) AS c FROM b),
m AS (SELECT {size}(c) AS m FROM (SELECT count(*) AS c FROM b GROUP BY quality))
"""


@query("balance_down", _BAL.format(size="min") + "SELECT doc_id, quality FROM r, m WHERE pos < m")
def balance_down(spark, d):
    """Every class cut down to the size of the smallest, without replacement."""
    return balance.balance(t(spark, d, "labels", "doc_id", "quality"), "quality", ["doc_id"], seed=7, how="down")


@query("balance_up", _BAL.format(size="max") + """,
dr AS (SELECT quality, c, unnest(range(m)) AS draw FROM (SELECT DISTINCT quality, c FROM r), m),
dd AS (SELECT quality, draw, ('0x' || substr(md5('7:' || coalesce(quality::VARCHAR, '') || ':' || draw::VARCHAR), 1, 13))::BIGINT % c AS pos FROM dr)
SELECT r.doc_id, dd.quality, dd.draw FROM dd JOIN r ON r.quality = dd.quality AND r.pos = dd.pos""")
def balance_up(spark, d):
    """Every class drawn with replacement to the size of the largest."""
    return balance.balance(t(spark, d, "labels", "doc_id", "quality"), "quality", ["doc_id"], seed=7, how="up")


# --- A9, A18: mergeable quantiles -------------------------------------------------------------

@query("quantile_rollup", """
SELECT date_trunc('month', ts) AS month, count(value) AS n, true AS p25_ok, true AS median_ok, true AS p75_ok FROM events GROUP BY 1""")
def quantile_rollup(spark, d):
    """Quantile sketches per day, merged per month, their rank error held against the exact ranks."""
    e = t(spark, d, "events", "ts", "value")
    daily = sketches.quantile_sketches(e, F.date_trunc("day", "ts"), "day", "value")
    month = sketches.merged(daily.withColumn("month", F.date_trunc("month", "day")), "month")
    q = sketches.quantiles(month, ["month"], [0.25, 0.5, 0.75])
    err = sketches.rank_errors(e.withColumn("month", F.date_trunc("month", "ts")), "month", "value", q, [0.25, 0.5, 0.75])
    ok = [(F.get("rank_error", i) <= sketches.RANK_ERROR).alias(c) for i, c in enumerate(("p25_ok", "median_ok", "p75_ok"))]
    return err.select(F.col("month").cast("timestamp_ntz").alias("month"), "n", *ok)

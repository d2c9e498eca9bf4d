r"""Catalogue part 3: tokens, bags of words, speaker documents, closed
vocabulary, cosine retrieval and the text items of SURVEY 2.17 (step 7).

Oracle SQL here uses raw strings: ``\pL``/``\pN`` for Unicode word
characters and ``\s`` for whitespace (only ASCII space and newline occur
in the text tables).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat import functions as LF
from loomstat.operators import sampling, similarity, text
from loomstat.plans.registry import query, t

_PUNCT_SQL = r"""
WITH p AS (SELECT doc_id, regexp_replace(regexp_replace(text,
             '([\pL\pN_])([.,;:!?''"”)])', '\1 \2', 'g'),
             '([.,;:!?''"“()])([\pL\pN_])', '\1 \2', 'g') AS s FROM documents),
tk AS (SELECT doc_id, list_transform(string_split_regex(s, '\s+'), lambda x: lower(x)) AS tokens FROM p)
"""
_WS = r"list_filter(string_split_regex({c}, '\s+'), lambda x: x <> '')"


def _punct(spark, d):
    return text.punct_tokens(t(spark, d, "documents", "doc_id", "text"), "text")


@query("tokens_punct", _PUNCT_SQL + """
SELECT doc_id, len(tokens) AS n_tokens, md5(array_to_string(tokens, '|')) AS tokens_md5 FROM tk""")
def tokens_punct(spark, d):
    """Punctuation split off words, whitespace tokens (edge empties
    kept), lower-cased; the token sequence is fingerprinted."""
    tk = _punct(spark, d)
    return tk.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"),
                     F.md5(F.array_join("tokens", "|")).alias("tokens_md5"))


@query("tokens_ws", f"""
SELECT doc_id, len({_WS.format(c='text')}) AS n_words FROM documents""")
def tokens_ws(spark, d):
    """``str.split()`` words per document."""
    return text.word_counts(t(spark, d, "documents", "doc_id", "text"), "doc_id", "text") \
        .withColumn("n_words", F.col("n_words").cast("long"))


@query("word_totals", f"""
SELECT lang, sum(len({_WS.format(c='text')})) AS total_words, count(*) AS n_docs
FROM documents GROUP BY 1""")
def word_totals(spark, d):
    """Total words per language."""
    w = text.word_counts(t(spark, d, "documents", "doc_id", "lang", "text"), "lang", "text")
    return w.groupBy("lang").agg(F.sum("n_words").cast("long").alias("total_words"),
                                 F.count(F.lit(1)).alias("n_docs"))


@query("bag_of_words", _PUNCT_SQL + """
SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(tokens) AS term FROM tk) GROUP BY 1, 2""")
def bag_of_words(spark, d):
    """Token counts per document."""
    return text.bag_of_words(_punct(spark, d), "doc_id", "tokens")


@query("bag_plus_extra", f"""
WITH x AS (SELECT doc_id, unnest({_WS.format(c='text')}) AS term FROM documents
           UNION ALL SELECT doc_id, 'lang=' || lang FROM documents
           UNION ALL SELECT doc_id, 'source=' || source FROM documents)
SELECT doc_id, term, count(*) AS n FROM x GROUP BY 1, 2""")
def bag_plus_extra(spark, d):
    """Word counts plus one count per extra feature."""
    docs = t(spark, d, "documents", "doc_id", "lang", "source", "text")
    docs = text.ws_tokens(docs, "text").withColumn(
        "extra", F.array(F.concat(F.lit("lang="), "lang"), F.concat(F.lit("source="), "source")))
    return text.bag_plus_extra(docs, "doc_id", "tokens", "extra")


@query("speaker_documents", r"""
WITH f AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS rn FROM conversations),
g AS (SELECT role, count(*) AS n_lines,
             string_agg(text || ' _EOL_ ', '' ORDER BY conv_id, turn) AS document
      FROM f WHERE rn <= 40 GROUP BY role)
SELECT role, n_lines, md5(document) AS doc_md5,
       len(list_filter(string_split_regex(document, '\s+'), lambda x: x <> '')) AS n_words FROM g""")
def speaker_documents(spark, d):
    """One document per speaker from its first 40 lines."""
    conv = t(spark, d, "conversations", "conv_id", "turn", "role", "text")
    s = text.speaker_documents(conv, "role", ["conv_id", "turn"], "text", 40)
    return s.select("role", "n_lines", F.md5("document").alias("doc_md5"),
                    F.col("n_words").cast("long").alias("n_words"))


@query("first_n_per_group", """
SELECT conv_id, turn, role FROM (
  SELECT *, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS rn FROM conversations)
WHERE rn <= 40""")
def first_n_per_group(spark, d):
    """First 40 lines of each speaker in order."""
    conv = t(spark, d, "conversations", "conv_id", "turn", "role")
    return text.first_n_per_group(conv, "role", ["conv_id", "turn"], 40)


# --- closed vocabulary and retrieval ------------------------------------------------

_SPLIT_DOCS_SQL = f"""
d AS (SELECT doc_id, source, text,
             row_number() OVER (ORDER BY doc_id) - 1 < floor(count(*) OVER () * 0.8) AS is_train
      FROM documents),
dc AS (SELECT *, row_number() OVER (PARTITION BY source, is_train ORDER BY doc_id) AS rn FROM d),
"""


def _split_docs(spark, d):
    docs = t(spark, d, "documents", "doc_id", "source", "text")
    return sampling.split_position(docs, 0.8, ["doc_id"])


@query("term_vectors_closed_vocab", "WITH " + _SPLIT_DOCS_SQL + f"""
tok AS (SELECT doc_id, is_train, unnest({_WS.format(c='text')}) AS term FROM d),
vocab AS (SELECT DISTINCT term FROM tok WHERE is_train)
SELECT doc_id, term, count(*) AS n FROM tok
WHERE NOT is_train AND term IN (SELECT term FROM vocab) GROUP BY 1, 2""")
def term_vectors_closed_vocab(spark, d):
    """Test-document term counts over the training vocabulary only.

    Training documents give terms only, so none of their counts is shuffled;
    a ``doc_id`` that stands in several rows gives its counts for each."""
    s = _split_docs(spark, d).filter(F.col("doc_id").isNotNull())
    train, test = s.filter(F.col("split") == "train"), s.filter(F.col("split") == "test")
    terms = text.explode_tokens(text.ws_tokens(train, "text"), [], "tokens")
    bag = text.bag_of_words(text.ws_tokens(test, "text").select("doc_id", "tokens"), "doc_id", "tokens")
    out = similarity.closed_vocabulary(bag, terms).select("doc_id", "term", "n")
    rows = test.groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("_rows")).filter(F.col("_rows") > 1)
    if rows.limit(1).count():
        out = (out.join(rows, "doc_id", "left")
               .withColumn("_row", F.explode(F.sequence(F.lit(1), F.coalesce("_rows", F.lit(1)))))
               .select("doc_id", "term", "n"))
    return out


def _retrieval_vectors(spark, d, caps=None):
    """Per-source training and test vectors (term counts), test restricted
    to the training vocabulary. ``caps`` = (train, test) documents per
    source, taken in doc_id order (T6)."""
    s = _split_docs(spark, d)
    if caps:
        tr = text.first_n_per_group(s.filter(F.col("split") == "train"), "source", ["doc_id"], caps[0])
        te = text.first_n_per_group(s.filter(F.col("split") == "test"), "source", ["doc_id"], caps[1])
        s = tr.unionByName(te)
    s = text.ws_tokens(s, "text")
    e = text.explode_tokens(s.withColumnRenamed("source", "doc"), ["doc", "split"], "tokens")
    # the bag feeds the train side, the test side and the vocabulary: computed
    # once, kept (memory and disk) for the branches and dealt by term (at most
    # two rows a source), so that no count or join by term shuffles it again
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bag = e.groupBy("doc", "split", "term").agg(F.count(F.lit(1)).alias("n")).repartition(parts, "term").persist()
    bag.count()  # plans made before the rows are kept do not know how they lie
    train = bag.filter(F.col("split") == "train").drop("split")
    test = similarity.closed_vocabulary(bag.filter(F.col("split") == "test").drop("split"), train)
    return train, test


def _retrieval_sql(caps=None):
    keep = "rn <= CASE WHEN is_train THEN %d ELSE %d END" % caps if caps else "TRUE"
    return "WITH " + _SPLIT_DOCS_SQL + f"""
tok AS (SELECT source, is_train, unnest({_WS.format(c='text')}) AS term FROM dc WHERE {keep}),
tr AS (SELECT source AS doc, term, count(*) AS w FROM tok WHERE is_train GROUP BY 1, 2),
te AS (SELECT source AS doc, term, count(*) AS w FROM tok
       WHERE NOT is_train AND term IN (SELECT term FROM tr) GROUP BY 1, 2),
n1 AS (SELECT doc, sqrt(sum(w * w)) AS nrm FROM te GROUP BY 1),
n2 AS (SELECT doc, sqrt(sum(w * w)) AS nrm FROM tr GROUP BY 1),
dots AS (SELECT te.doc AS doc1, tr.doc AS doc2, sum(te.w * tr.w) AS dot FROM te JOIN tr USING (term)
         GROUP BY 1, 2),
pairs AS (SELECT doc1, doc2, dot / (n1.nrm * n2.nrm) AS similarity
          FROM dots JOIN n1 ON n1.doc = doc1 JOIN n2 ON n2.doc = doc2),
allp AS (SELECT q.doc AS doc1, c.doc AS doc2, coalesce(p.similarity, 0) AS similarity
         FROM (SELECT DISTINCT doc FROM te) q CROSS JOIN (SELECT DISTINCT doc FROM tr) c
         LEFT JOIN pairs p ON p.doc1 = q.doc AND p.doc2 = c.doc),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc1 ORDER BY similarity DESC, doc2) AS rk FROM allp)
"""


_EVAL_SELECT = """
SELECT round(avg(rk), 6) AS mean_rank, round(avg(similarity), 6) AS mean_cosine,
       avg(CAST(rk = 1 AS DOUBLE)) AS accuracy, count(*) AS n_queries FROM ranked WHERE doc1 = doc2"""


def _eval(spark, d, caps=None):
    train, test = _retrieval_vectors(spark, d, caps)
    # the scored pairs (the similarity matrix, one row per pair) feed the
    # target lookup and the ranking: kept once
    pairs = similarity.cosine_pairs(test, train).persist()
    ranks = similarity.rank_targets(pairs, test, train)
    s = similarity.ir_scores(ranks)
    return s.select(F.round("mean_rank", 6).alias("mean_rank"),
                    F.round("mean_cosine", 6).alias("mean_cosine"), "accuracy", "n_queries")


@query("cosine_rank_eval", _retrieval_sql() + _EVAL_SELECT)
def cosine_rank_eval(spark, d):
    """Per-source documents; each test source ranks the
    training sources by cosine; mean rank, mean target cosine, accuracy."""
    return _eval(spark, d)


@query("cosine_rank_eval_capped", _retrieval_sql((360, 40)) + _EVAL_SELECT)
def cosine_rank_eval_capped(spark, d):
    """The same with at most 360 training and 40 test documents per source."""
    return _eval(spark, d, (360, 40))


@query("similarity_matrix", _retrieval_sql() + """
SELECT doc1, doc2, round(similarity, 6) AS similarity FROM pairs""")
def similarity_matrix(spark, d):
    """T4: similarity of every (test, training) pair sharing a term, long form."""
    train, test = _retrieval_vectors(spark, d)
    p = similarity.cosine_pairs(test, train)
    return p.select("doc1", "doc2", F.round("similarity", 6).alias("similarity"))


_SOURCES = [f"src{i}" for i in range(20)]


@query("similarity_pivot", _retrieval_sql() + ", pr AS (SELECT doc1, doc2, round(similarity, 6) AS similarity FROM pairs) SELECT doc1, " + ", ".join(f"max(CASE WHEN doc2 = '{s}' THEN similarity END) AS {s}" for s in _SOURCES) + " FROM pr GROUP BY doc1")
def similarity_pivot(spark, d):
    """T4: the matrix itself, one row per test document and one column per
    training document, for a fixed list of training documents."""
    train, test = _retrieval_vectors(spark, d)
    p = similarity.cosine_pairs(test, train)
    p = p.withColumn("similarity", F.round("similarity", 6))
    return p.groupBy("doc1").pivot("doc2", _SOURCES).agg(F.first("similarity"))


@query("extreme_pairs", _retrieval_sql() + """
SELECT * FROM
 (SELECT doc1 AS max_doc1, doc2 AS max_doc2, round(similarity, 6) AS max_similarity FROM pairs
  ORDER BY similarity DESC, doc1 DESC, doc2 DESC LIMIT 1),
 (SELECT doc1 AS min_doc1, doc2 AS min_doc2, round(similarity, 6) AS min_similarity FROM allp
  ORDER BY similarity, doc1, doc2 LIMIT 1)""")
def extreme_pairs(spark, d):
    """Most and least similar scored pair."""
    train, test = _retrieval_vectors(spark, d)
    e = similarity.extreme_pairs(similarity.cosine_pairs(test, train), test, train)
    return e.select("max_doc1", "max_doc2", F.round("max_similarity", 6).alias("max_similarity"),
                    "min_doc1", "min_doc2", F.round("min_similarity", 6).alias("min_similarity"))


@query("cosine_pairs_dense", """
WITH e AS (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 < floor(count(*) OVER () * 0.8) AS is_train
           FROM embeddings),
x AS (SELECT vec_id, label, is_train, CAST(unnest(embedding) AS DOUBLE) AS v,
             generate_subscripts(embedding, 1) AS pos FROM e),
c AS (SELECT label, pos, avg(v) AS cv FROM x WHERE is_train GROUP BY 1, 2),
cn AS (SELECT label, sqrt(sum(cv * cv)) AS nc FROM c GROUP BY 1),
tt AS (SELECT vec_id, pos, v FROM x WHERE NOT is_train),
tn AS (SELECT vec_id, sqrt(sum(v * v)) AS nt FROM tt GROUP BY 1),
dots AS (SELECT tt.vec_id, c.label, sum(tt.v * c.cv) AS dot FROM tt JOIN c USING (pos) GROUP BY 1, 2)
SELECT vec_id, label, round(dot / (nt * nc), 6) AS similarity
FROM dots JOIN tn USING (vec_id) JOIN cn USING (label)""")
def cosine_pairs_dense(spark, d):
    """Cosine of each held-out vector with each training class centroid."""
    e = sampling.split_position(t(spark, d, "embeddings"), 0.8, ["vec_id"])
    cents = similarity.dense_centroids(e.filter(F.col("split") == "train"), "embedding", "label")
    p = similarity.cosine_to_centroids(e.filter(F.col("split") == "test"), cents, "vec_id",
                                       "embedding")
    return p.select("vec_id", "label", F.round("similarity", 6).alias("similarity"))


# --- SURVEY 2.17 text items --------------------------------------------------------------

@query("ngrams", f"""
WITH tk AS (SELECT {_WS.format(c='text')} AS t FROM conversations)
SELECT ngram, count(*) AS n FROM (
  SELECT unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS ngram FROM tk)
GROUP BY 1""")
def ngrams(spark, d):
    """Bigram counts."""
    c = text.ws_tokens(t(spark, d, "conversations", "text"), "text")
    g = text.ngrams(c, "tokens", 2)
    return text.explode_tokens(g, [], "ngrams", "ngram").groupBy("ngram") \
        .agg(F.count(F.lit(1)).alias("n"))


_DOC_TERMS_SQL = f"""
WITH tk AS (SELECT DISTINCT doc_id, unnest({_WS.format(c='text')}) AS term FROM documents),
df AS (SELECT term, count(*) AS df FROM tk GROUP BY 1),
nd AS (SELECT count(DISTINCT doc_id) AS n FROM tk)
"""


def _doc_bag(spark, d):
    # dealt by term, so that neither the document frequencies nor the join with
    # them shuffles the kept bag again
    docs = text.ws_tokens(t(spark, d, "documents", "doc_id", "text"), "text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bag = text.bag_of_words(docs, "doc_id", "tokens", parts=parts).withColumnRenamed("doc_id", "doc").persist()
    bag.count()  # plans made before the rows are kept do not know how they lie
    return bag


@query("df_filter", _DOC_TERMS_SQL + """
SELECT term, df FROM df, nd WHERE df >= 2 AND df <= 0.5 * n""")
def df_filter(spark, d):
    """E5: terms with document frequency in [2, 0.5 N]."""
    kept = similarity.doc_frequency_filter(_doc_bag(spark, d), "doc", 2, 0.5)
    return kept.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


@query("tfidf", f"""
WITH tk AS (SELECT doc_id, unnest({_WS.format(c='text')}) AS term FROM documents),
bag AS (SELECT doc_id, term, count(*) AS n FROM tk GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM bag GROUP BY 1),
nd AS (SELECT count(DISTINCT doc_id) AS n FROM bag)
SELECT doc_id, term, round(bag.n * (ln((1 + nd.n) / (1 + df)) + 1), 6) AS w FROM bag JOIN df USING (term), nd""")
def tfidf(spark, d):
    """Smoothed tf-idf weights."""
    w = similarity.tfidf(_doc_bag(spark, d), "doc")
    return w.select(F.col("doc").alias("doc_id"), "term", F.round("w", 6).alias("w"))


# A short English stop-word list.
STOPWORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he",
             "in", "is", "it", "its", "of", "on", "that", "the", "to", "was", "were", "will",
             "with"]


@query("stopwords", f"""
SELECT doc_id, len(list_filter({_WS.format(c='text')},
                               lambda x: NOT list_contains({STOPWORDS!r}, lower(x)))) AS n_kept
FROM documents""")
def stopwords(spark, d):
    """Tokens left after stop-word removal."""
    s = text.remove_stopwords(text.ws_tokens(t(spark, d, "documents", "doc_id", "text"), "text"),
                              "tokens", STOPWORDS)
    return s.select("doc_id", F.size("filtered").cast("long").alias("n_kept"))


@query("scene_context", """
SELECT conv_id, turn, md5(concat_ws(' ', lag(text) OVER w, text, lead(text) OVER w)) AS context_md5
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def scene_context(spark, d):
    """Each line with its neighbouring lines of the same conversation."""
    c = text.neighbour_context(t(spark, d, "conversations", "conv_id", "turn", "text"),
                               "conv_id", ["turn"], "text", 1)
    return c.select("conv_id", "turn", F.md5("context").alias("context_md5"))

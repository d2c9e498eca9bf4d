"""Tokenising, bags of words and per-speaker documents (F4-F8, A20-A23, W2,
A26, E4, E6, E8).

Bags of words are long tables ``(doc, term, n)``: ``explode`` + a hash
aggregate keyed by (doc, term). A hot term or a long document is
pre-aggregated map-side, so no task ever holds a whole document's token
list beyond the row being exploded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomstat import functions as LF


def explode_tokens(df: DataFrame, keep: list[str], tokens: str, out: str = "term") -> DataFrame:
    """One row per token.

    ``explode_outer`` + a NULL filter on the generated column gives the same
    rows as ``explode`` but stops Catalyst from inferring a ``size(tokens) >
    0`` filter below the generator, which would evaluate the (regex)
    tokeniser a second time.
    """
    return (df.select(*keep, F.explode_outer(tokens).alias(out))
            .filter(F.col(out).isNotNull()))


def punct_tokens(df: DataFrame, text: str, out: str = "tokens") -> DataFrame:
    """F4 + F5: punctuation spacing, whitespace split (edge empties kept), lower."""
    return df.withColumn(out, LF.regex_tokens(LF.space_punctuation(text)))


def ws_tokens(df: DataFrame, text: str, out: str = "tokens") -> DataFrame:
    """``str.split()``."""
    return df.withColumn(out, LF.ws_tokens(text))


def bag_of_words(df: DataFrame, doc: str, tokens: str, lower: bool = False, parts: int | None = None) -> DataFrame:
    """``(doc, term, n)`` term counts; with ``parts`` dealt by term into so
    many, tokens being shuffled once and the counts not again for work by term."""
    e = explode_tokens(df, [doc], tokens)
    if lower:
        e = e.withColumn("term", F.lower("term"))
    if parts:
        e = e.repartition(parts, "term")
    return e.groupBy(doc, "term").agg(F.count(F.lit(1)).alias("n"))


def bag_plus_extra(df: DataFrame, doc: str, tokens: str, extra: str) -> DataFrame:
    """Term counts plus one count per extra feature of the document."""
    words = explode_tokens(df, [doc], tokens)
    extras = explode_tokens(df, [doc], extra)
    return (words.unionByName(extras).groupBy(doc, "term")
            .agg(F.count(F.lit(1)).alias("n")))


def word_counts(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Whitespace words per document."""
    return df.select(doc, F.size(LF.ws_tokens(text)).alias("n_words"))


def first_n_per_group(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """First ``n`` rows of each group in order.

    ``row_number() <= n`` is planned with ``WindowGroupLimit``: each map
    task keeps at most ``n`` rows per group before the shuffle, so a
    dominant group sends at most ``n`` rows per task.
    """
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def speaker_documents(df: DataFrame, speaker: str, order: list[str], line: str,
                      max_lines: int) -> DataFrame:
    """W2 + A20 + A26 + F8: one document per speaker from its first
    ``max_lines`` lines in order, each followed by `` _EOL_ ``.

    The collected list per speaker is bounded by ``max_lines``.
    """
    top = first_n_per_group(df, speaker, order, max_lines)
    st = F.struct(*[F.col(c) for c in order], F.col(line).alias("_line"))
    g = top.groupBy(speaker).agg(F.array_sort(F.collect_list(st)).alias("_l"),
                                 F.count(F.lit(1)).alias("n_lines"))
    doc = F.array_join(F.transform("_l", lambda s: LF.with_eol(s["_line"])), "")
    return g.select(speaker, "n_lines", doc.alias("document")).withColumn(
        "n_words", F.size(LF.ws_tokens("document")))


def ngrams(df: DataFrame, tokens: str, n: int, out: str = "ngrams") -> DataFrame:
    """Space-joined n-grams of a token array.

    Built by zipping ``n`` shifted slices of the array, so the work is
    linear in the token count (a per-position ``slice`` lambda would
    re-evaluate the token array for every position).
    """
    k = F.greatest(F.size(tokens) - n + 1, F.lit(0))
    shifted = [F.slice(tokens, j + 1, k) for j in range(n)]
    z = F.arrays_zip(*[s_.alias(f"t{j}") for j, s_ in enumerate(shifted)])
    return df.withColumn(out, F.transform(
        z, lambda e: F.concat_ws(" ", *[e[f"t{j}"] for j in range(n)])))


def neighbour_context(df: DataFrame, group: str, order: list[str], line: str,
                      k: int = 1) -> DataFrame:
    """Each line with up to ``k`` neighbouring lines of the same group.

    Neighbours are found by position self-joins (global position in
    (group, order), offset +/- i, same group), so a very long group is
    spread over many tasks rather than sorted in one window task.
    """
    from loomstat.operators.sampling import ordered_index
    idx = ordered_index(df, [group, *order], "_pos")
    out = idx
    offsets = [-i for i in range(k, 0, -1)] + list(range(1, k + 1))
    for o in offsets:
        nb = idx.select((F.col("_pos") - o).alias("_pos"), F.col(group).alias(f"_g{o}"),
                        F.col(line).alias(f"_l{o}"))
        out = out.join(nb, "_pos", "left").withColumn(
            f"_l{o}", F.when(F.col(f"_g{o}") == F.col(group), F.col(f"_l{o}"))).drop(f"_g{o}")
    parts = [F.col(f"_l{o}") for o in offsets if o < 0] + [F.col(line)] + \
        [F.col(f"_l{o}") for o in offsets if o > 0]
    return out.withColumn("context", F.concat_ws(" ", *parts)) \
        .drop("_pos", *[f"_l{o}" for o in offsets])


def remove_stopwords(df: DataFrame, tokens: str, stopwords: list[str],
                     out: str = "filtered") -> DataFrame:
    """Drop tokens in a stop list (case-insensitive)."""
    sw = F.array(*[F.lit(w.lower()) for w in stopwords])
    return df.withColumn(out, F.filter(tokens, lambda t: ~F.array_contains(sw, F.lower(t))))

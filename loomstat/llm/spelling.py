"""Grouping of spelling variants with PartEnum signatures.

1. ``vocabulary``: runs of letters are counted over the whole corpus; tasks
   add up before the shuffle.
2. ``signatures``: a word's letter multiset is a binary vector with one
   dimension for each (letter, how often it came before). One inserted or
   deleted letter changes one dimension, one replaced letter two, so near words
   have Hamming distance at most two. The dimensions are partitioned into
   ``PARTS`` parts; any two differing dimensions touch at most two parts, so
   near words agree on all the other parts. Each choice of two parts to leave
   out gives one exact signature of the rest.
3. ``near_words``: an equi-join on the signature, verified by the edit distance
   in the join itself. Words that share a signature with more than ``HOT``
   others also share their first or their last ``ENDS`` letters if they are
   near, so such signatures are split by these ends (no pair is lost).
4. ``forms``: the near word of largest count, and by pointer jumping the last
   of the chain. Counts grow along a chain, so there is no cycle.

Defined results: null or empty text has no words; repeated rows count each
time; a null id counts as an empty id in the checksum; ties between near words
go to the smallest in code-point order; texts of any length are read in pieces;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import common as C

PARTS = 7            # parts of the dimensions: 21 signatures a word
HOT = 64             # words of a signature that are joined as they are
ENDS = 3             # letters at either end; MIN_LENGTH must be at least twice that
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5            # a form is this many times as common as its variant
EVERY = 199          # one (document, run) in so many loses a letter
PIECE = 1 << 20      # characters read at once
HELD = 200_000       # words that a task adds up before it passes them on

_RUN = re.compile("[a-zÀ-ÿ]+")
_OTHER = re.compile("[^a-zÀ-ÿ]")


def letter_runs(raw: bytes) -> Counter:
    """Counts of the maximal runs ``[A-Za-zÀ-ÿ]+`` of a UTF-8 text, A-Z lower-cased."""
    low, found, at = raw.lower().decode(), Counter(), 0  # bytes.lower() changes A-Z only
    while at < len(low):
        end = at + PIECE
        if end < len(low):
            m = _OTHER.search(low, end)
            end = m.start() if m else len(low)
        found.update(_RUN.findall(low, at, end))
        at = end
    return found


def misspelt(run: str, h: int) -> str:
    """The run as it is counted: checksums divisible by ``EVERY`` take a letter out."""
    if h % EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame, least_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: words of at least ``MIN_LENGTH`` letters and ``least_count`` occurrences."""
    def count(batches):
        total: dict[str, int] = {}

        def out():
            rows = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return rows

        for b in batches:
            texts = pc.cast(b.column("text"), pa.large_binary())
            for i, raw in zip(b.column("doc_id").to_pylist(), texts):
                if not (raw := raw.as_py()):
                    continue
                start = zlib.crc32(f"{'' if i is None else i}:".encode())
                for run, n in letter_runs(raw).items():
                    word = misspelt(run, zlib.crc32(run.encode(), start))
                    if len(word) >= MIN_LENGTH:
                        total[word] = total.get(word, 0) + n
                if len(total) >= HELD:
                    yield out()
        yield out()

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


def signatures(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """``sig`` and the columns of ``words(word, ...)``: one row for each signature."""
    letters = F.array_sort(F.filter(F.split("word", ""), lambda c: c != ""))
    dims = F.transform("letters", lambda c, i: F.xxhash64(c, i - F.array_position("letters", c)))
    rows = words.withColumn("letters", letters).withColumn("dims", dims)

    def part(g: int):  # a set of dimensions is the exclusive or of their hashes
        return F.aggregate(F.filter("dims", lambda d: F.pmod(d, F.lit(parts)) == g), F.lit(0).cast("long"), lambda a, d: a.bitwiseXOR(d))

    rows = rows.select(*words.columns, *(part(g).alias(f"part{g}") for g in range(parts)))
    of = []
    for pair in combinations(range(parts), 2):
        rest = [F.col(f"part{g}") for g in range(parts) if g not in pair]
        of.append(F.xxhash64(F.lit(pair[0] * parts + pair[1]), *rest))
    return rows.select(F.explode(F.array(*of)).alias("sig"), *words.columns)


def near_words(words: DataFrame) -> DataFrame:
    """``a, b, a_n, b_n``: each pair of words at edit distance one, once (``a < b``)."""
    rows = C.cut(signatures(words.select("word", "n")))
    shared = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    ends = F.array(F.concat(F.lit("<"), F.substring("word", 1, ENDS)), F.concat(F.lit(">"), F.expr(f"right(word, {ENDS})")))
    rows = (rows.join(shared, "sig")
            .withColumn("end", F.explode(F.when(F.col("c") > HOT, ends).otherwise(F.array(F.lit("")))))
            .select("sig", "end", "word", "n", F.length("word").alias("len")))
    x, y = rows.alias("x"), rows.alias("y")
    return (x.join(y, (F.col("x.sig") == F.col("y.sig")) & (F.col("x.end") == F.col("y.end")) & (F.col("x.word") < F.col("y.word"))
                   & (F.abs(F.col("x.len") - F.col("y.len")) <= 1) & (F.levenshtein("x.word", "y.word", 1) == 1))
            .select(F.col("x.word").alias("a"), F.col("y.word").alias("b"), F.col("x.n").alias("a_n"), F.col("y.n").alias("b_n"))
            .dropDuplicates(["a", "b"]))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms(word, form)``, a forest: the last of each chain."""
    at = C.cut(forms.select("word", F.col("form").alias("root")))
    while True:
        up = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = C.cut(at.join(up, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        at = new.select("word", "root")
        if not new.where("moved").limit(1).count():
            return at


def group_variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of the vocabulary."""
    C.prepare(docs.sparkSession)
    words = C.cut(vocabulary(docs))
    pairs = near_words(words)
    sides = F.array(F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
                    F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    sides = pairs.select(F.inline(sides))
    best = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    found = (words.join(best, "word", "left")
             .withColumn("ok", F.coalesce(-F.col("best.less") >= F.lit(RATIO) * F.col("n"), F.lit(False)))
             .select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                     F.when(F.col("ok"), F.col("best.near")).alias("form"), F.when(F.col("ok"), -F.col("best.less")).alias("form_n")))
    found = C.cut(found)
    return (found.join(roots(found.where("form is not null")), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op12_partenum_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(C.documents(spark, sf_dir))

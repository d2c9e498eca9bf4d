"""Quality rules: n-gram perplexity bands of a modified Kneser-Ney model.

The model's n-grams are those of bytes of the running text (its words, ASCII
letters in lower case, a space after each), up to order ``ORDER`` and across words,
counted by Spark over all distinct texts of each language. Lower orders hold continuation
counts, n-grams at a text's start raw counts; the three discounts of an order come
from its counts of counts; every kept n-gram stores its interpolated log-probability and every
context its back-off weight, in sorted arrays of exact keys (the text's start is a
byte that no word holds, a NUL counts as byte 1).

Each word, after what stands before it, is scored under every language's model. A document's language is the
model that explains all its words best (a wrong label does not count against
it); its value is the mean negative log-probability per byte, each word taken
under its best model, so that texts in two languages are judged by their words
too. The bands are ``RANGE`` interquartile ranges, at least ``LEAST_WIDTH``, beyond the
quartiles of all distinct texts of that language that pass the base rules, so
copies count once; documents outside are rejected, as are those that fail the base rules.

Defined results: null text has no words; a null language is a language of its
own; a text without words has no value and fails the base rules; repeated rows
stay repeated; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import common as C
from loomstat.llm.jaccard_join import shingle_hashes

ORDER = 5
START = bytes(ORDER - 2) + b"\n"  # before a text
RANGE = 2.5
LEAST_WIDTH = 0.02  # nats per byte
SHORT = 200  # words; the bands of shorter texts widen with the spread of a mean
CACHED = 500_000  # n-grams of a worker's cache (32 bytes each with six languages)
BATCH = 500_000  # bytes of texts measured at once
HELD = 300_000  # n-grams of further pieces that a task holds before it adds them up
PIECE = 250_000  # bytes of running text whose n-grams are formed at once

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _words(batch: pa.RecordBatch):
    """Groups of rows: ``(i, j, byte offsets, raw bytes, hash, start, end, first)``."""
    data, offs = C.buffer(batch.column("text"))
    for i, j in C.groups(offs, BATCH):
        yield i, j, offs[i:j + 1] - offs[i], data[offs[i]:offs[j]], *C.words(data, offs[i:j + 1], C.SPACES, lower=False)


def _running(raw: np.ndarray, s: np.ndarray, e: np.ndarray, first: np.ndarray):
    """``C.running_text`` of some rows, and the parts of its n-grams."""
    text, row, word = C.running_text(np.maximum(C.LOWER[raw], 1), s, e, first, START)
    return row, word, C.running_grams(text, row, len(START), ORDER - 1, PIECE)


def _order(key: np.ndarray) -> np.ndarray:
    """Bytes of an n-gram: fewer than ``ORDER`` at a text's start only."""
    return 2 + sum(((key >> (8 * o)) != 0).astype(np.int32) for o in range(2, ORDER))


def _merged(held: list) -> tuple[np.ndarray, np.ndarray]:
    u, inv = np.unique(np.concatenate([p[0] for p in held]), return_inverse=True)
    return u, np.bincount(inv, np.concatenate([p[1] for p in held]), len(u))


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang, ord, key, n`` of ``docs(lang, text)``: the highest order throughout the text, lower ones at its start.
    The copies of a text share one count."""
    digest = F.xxhash64("text").alias("digest")
    copies = C.cut(docs.groupBy("lang", digest).agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    rows = docs.select("lang", "text", digest).join(copies, ["lang", "digest"], "left")

    def go(batches):
        C.in_use("quality.grams")
        for b in batches:
            lang = np.array(b.column("lang").to_pylist(), object)
            names, which = np.unique(lang.astype(str), return_inverse=True) if len(lang) else (np.zeros(0, str), np.zeros(0, int))
            share = np.asarray(b.column("share"))
            held: list = []
            for i, j, offs, raw, h, s, e, first in _words(b):
                row, _, parts = _running(raw, s, e, first)
                for x, y, key, event in parts:
                    at = np.searchsorted(row, x, "right") - 1, np.searchsorted(row, y)  # rows in this part
                    size = np.diff(np.clip(row[at[0]:at[1] + 1], x, y))
                    of, part = (np.repeat(v[i:j][at[0]:at[1]], size)[event] for v in (which, share))
                    u, inv = np.unique((of << (8 * ORDER)) | key[event], return_inverse=True)
                    held.append((u, np.bincount(inv, part, len(u))))
                if sum(len(u) for u, _ in held[1:]) > HELD:
                    held[:] = [_merged(held)]
            if not held:
                continue
            u, n = _merged(held)
            key = u & ((1 << (8 * ORDER)) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(names[u >> (8 * ORDER)].tolist(), pa.string()), pa.array(_order(key).astype(np.int32)), pa.array(key), pa.array(n)], names=["lang", "ord", "key", "n"])

    return (rows.select("lang", "text", (1 / F.coalesce("c", F.lit(1))).alias("share")).mapInArrow(go, "lang string, ord int, key long, n double")
            .groupBy("lang", "ord", "key").agg(F.round(F.sum("n")).cast("long").alias("n")))


def _discounted(raw: DataFrame) -> DataFrame:
    """``lang, key, n, off, total, b`` of one order: the discount of each
    n-gram, the total of its context and the context's back-off weight."""
    d = raw.groupBy("lang").agg(*[F.sum((F.col("n") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)])
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

    def discount(k: int):
        d = k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}"))
        return F.greatest(F.least(F.coalesce(d, F.lit(k / 2)), F.lit(0.95 * k)), F.lit(0.1)).alias(f"d{k}")

    rows = raw.join(F.broadcast(d.select("lang", *(discount(k) for k in (1, 2, 3)))), "lang")  # one row for each language
    off = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = rows.select("lang", "key", F.shiftright("key", 8).alias("ctx"), F.col("n").cast("double").alias("n"), off.alias("off"))
    total = rows.groupBy("lang", "ctx").agg(F.sum("n").alias("total"), F.sum("off").alias("left"))
    return rows.join(total, ["lang", "ctx"]).withColumn("b", F.col("left") / F.col("total"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """``lang, ord, key, p, b``: ``p`` the interpolated probability of an
    n-gram, ``b`` the back-off weight of its context."""
    at = lambda o: counts.where(F.col("ord") == o).select("lang", "key", "n")
    suffix = lambda df, bytes_: (df.groupBy("lang", F.col("key").bitwiseAND(F.lit((1 << 8 * bytes_) - 1)).alias("key"))
                                 .agg(F.count(F.lit(1)).alias("n")))
    raw = {ORDER: at(ORDER)}
    for o in range(ORDER - 1, 1, -1):
        raw[o] = C.cut(at(o).union(suffix(raw[o + 1], o)))
    raw[1] = C.cut(suffix(raw[2], 1))
    out, lower = None, None
    for o in range(1, ORDER + 1):
        rows, base = _discounted(raw[o]), F.lit(1 / 256)
        if lower is not None:
            low = lower.select("lang", F.col("key").alias("suffix"), F.col("p").alias("q"))
            rows = rows.withColumn("suffix", F.col("key").bitwiseAND(F.lit((1 << 8 * (o - 1)) - 1))).join(low, ["lang", "suffix"])
            base = F.col("q")
        lower = C.cut(rows.select("lang", F.lit(o).alias("ord"), "key", ((F.col("n") - F.col("off")) / F.col("total") + F.col("b") * base).alias("p"), "b"))
        out = lower if out is None else out.union(lower)
    return out


class Model:
    """Sorted arrays of one language."""

    def __init__(self, order: np.ndarray, key: np.ndarray, p: np.ndarray, b: np.ndarray):
        self.grams, self.contexts = {}, {}
        for o in range(1, ORDER + 1):
            m = order == o
            u, at = np.unique(key[m], return_index=True)
            self.grams[o] = (u, np.log(p[m][at]).astype(np.float32))
            u, at = np.unique(key[m] >> 8, return_index=True)
            self.contexts[o] = (u, np.log(b[m][at]).astype(np.float32))

    def log_probs(self, key: np.ndarray) -> np.ndarray:
        """Natural log-probability of each n-gram's last byte."""
        out = np.full(len(key), np.log(1 / 256))
        size = _order(key)
        for o in range(1, ORDER + 1):
            part = key & ((1 << 8 * o) - 1)
            there = size >= o
            found, value = _look(self.grams[o], part)
            seen, back = _look(self.contexts[o], part >> 8)
            out = np.where(there, np.where(found, value, out + np.where(seen, back, 0)), out)
        return out


def _look(table: tuple[np.ndarray, np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, values = table
    if not len(keys):
        return np.zeros(len(x), bool), np.zeros(len(x))
    at = np.searchsorted(keys, x)
    at[at == len(keys)] = 0
    return keys[at] == x, values[at]


def load(model: DataFrame) -> dict[str, Model]:
    """The arrays of every language (12 bytes for each distinct n-gram of at most ``ORDER`` bytes)."""
    out = {}
    for lang in [r[0] for r in model.select("lang").distinct().collect()]:  # languages
        t = model.where(F.col("lang") == lang).select("ord", "key", "p", "b").toArrow()
        out[lang] = Model(*(np.asarray(t.column(c)) for c in ("ord", "key", "p", "b")))
    return out


_LAST: list = []


def _cache(mark: str) -> dict:
    C.in_use("quality", _LAST.clear)
    if not _LAST or _LAST[0] != mark:
        _LAST[:] = [mark, {}]
    return _LAST[1]


def _repeats(s: np.ndarray, width: int) -> int:
    """Words covered by windows (hashes ``s``) that occur twice or more."""
    _, inv, c = np.unique(s, return_inverse=True, return_counts=True)
    twice = c[inv] > 1
    if not twice.any():
        return 0
    delta = np.zeros(len(s) + width, np.int64)
    at = np.flatnonzero(twice)
    delta[at] += 1
    delta[at + width] -= 1
    return int((np.cumsum(delta)[:-1] > 0).sum())


def _duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    if "\n" not in text:
        return 0
    for line in text.split("\n"):
        if line.strip(" \t\n\r\x0b\x0c"):
            n += line in seen
            seen.add(line)
    return n


def measure(docs: DataFrame, models: dict[str, Model]) -> DataFrame:
    """``doc_id, digest`` (of the text), ``lang`` (best model), the base counts, ``value`` (nats per byte; null without words)."""
    sc = C.prepare(docs.sparkSession).sparkContext
    shared = sc.broadcast(models)
    mark = f"{sc.applicationId}-{shared._jbroadcast.id()}"

    names = sorted(models)

    def go(batches):
        known = _cache(mark)

        def look_up(grams):
            """Places of sorted distinct n-grams in this worker's table of log-probabilities, completed as needed."""
            key, table = known.get("table", (np.zeros(0, np.int64), np.zeros((0, len(names)), np.float32)))
            at = np.searchsorted(key, grams)
            new = grams[key[np.minimum(at, len(key) - 1)] != grams] if len(key) else grams
            if len(new):
                if len(key) + len(new) > CACHED:
                    key, table, new = key[:0], table[:0], grams
                rows = np.array([shared.value[m].log_probs(new) for m in names], np.float32).reshape(len(names), len(new)).T
                key, order = np.concatenate([key, new]), np.argsort(np.concatenate([key, new]), kind="stable")
                key, table = key[order], np.concatenate([table, rows])[order]
                known["table"] = key, table
                at = np.searchsorted(key, grams)
            return at, table

        def values(raw, s, e, first):
            """Scores of the words in their places under every model, and the best of them."""
            _, word, parts = _running(raw, s, e, first)
            out = np.zeros((len(names) + 1, len(word)))
            for x, y, key, event in parts:
                u, inv = np.unique(key[event], return_inverse=True)
                at, table = look_up(u)
                for k in range(len(names)):
                    value = np.zeros(y - x)
                    value[event] = table[at, k][inv]
                    C.add_spans(out[k], word, x, value)
            if names:
                out[-1] = out[:-1].max(0)
            return out.T

        for b in batches:
            best = np.zeros(b.num_rows, np.int64)
            text = b.column("text").to_pylist()
            n = np.zeros((4, b.num_rows), np.int64)
            value = np.full(b.num_rows, np.nan)
            lines = [_duplicate_lines(t) if t else 0 for t in text]
            for i, j, offs, raw, h, s, e, first in _words(b):
                total = lambda m: np.diff(np.concatenate([[0], np.cumsum(m)])[offs])
                n[0, i:j] = np.diff(first)
                n[1, i:j] = total(((raw & 0xC0) != 0x80) & ~C.SPACES[raw])
                n[2, i:j] = total(_SYMBOL[raw])
                for r in range(i, j):
                    w = h[first[r - i]:first[r - i + 1]]
                    n[3, r] = _repeats(shingle_hashes(w, 3), 3) if len(w) > 3 else 0
                score = values(raw, s, e, first)
                add = lambda x: np.diff(np.concatenate([np.zeros((1, x.shape[1])), np.cumsum(x, 0)])[first], axis=0)
                each = add(score[:, :len(names)])
                best[i:j] = each.argmax(1) if len(names) else 0
                own = add(score[:, -1:])[:, 0]
                size = add((e - s + 1)[:, None].astype(np.float64))[:, 0]
                value[i:j] = np.where(size > 0, -own / np.maximum(size, 1), np.nan)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("digest"), pa.array([names[k] if ok and names else None for k, ok in zip(best, n[0] > 0)], pa.string()), *(pa.array(x) for x in (n[0], n[1], n[2])), pa.array(lines, pa.int64()), pa.array(n[3]),
                 pa.array(value, from_pandas=True)],
                names=["doc_id", "digest", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "value"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("digest"), "text").mapInArrow(
        go, "doc_id long, digest long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, value double")


def judge(docs: DataFrame, width: float = RANGE) -> DataFrame:
    """Per document row: the base counts, ``base_failed``, ``value``, its band and ``kept``."""
    docs = docs.select("doc_id", F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    models = load(C.cut(kneser_ney(C.cut(gram_counts(docs)))))
    rows = C.cut(measure(docs, models).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))
    texts = rows.where("not base_failed").groupBy("lang", "digest").agg(F.min("value").alias("value"))
    band = (texts.groupBy("lang")
            .agg(F.percentile_approx("value", [0.25, 0.75], 10_000).alias("q"))
            .select("lang", "q", F.greatest(width * (F.col("q")[1] - F.col("q")[0]), F.lit(LEAST_WIDTH)).alias("width")))
    wide = F.col("width") * F.sqrt(F.greatest(F.lit(1.0), F.try_divide(F.lit(float(SHORT)), F.col("n_words"))))
    inside = F.col("value").between(F.col("q")[0] - wide, F.col("q")[1] + wide)
    return (rows.join(F.broadcast(band), "lang", "left")  # one row for each language
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))))


def op9_kneser_ney_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(C.documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lang", "value")

"""Removal of repeated passages by relative Lempel-Ziv parsing.

A word is removed when a window of ``WINDOW`` consecutive words that covers it
also starts at any other place of the corpus, the same document included.

Parsing every document against every block of a corpus would be quadratic, so
the corpus is first dealt into reference blocks such that equal windows always
meet in the same block, without loss:

1. ``window_runs``: each window names the leftmost least hash of its
   ``GRAM``-word strings. Windows that share this place form a run of at most
   ``WINDOW - GRAM + 1`` windows; equal windows have equal least hashes, and a
   key that occurs once needs nothing more.
2. Runs with the same key and the same words form a class. A class with two
   members is one factor of the reference as a whole: all its members go.
3. Classes whose key has other classes too are dealt by key to reference
   blocks. A block is indexed once (``Reference``: a suffix array over word
   names) and each class with one member is parsed greedily against it: a factor
   is the longest string from here on that also starts elsewhere in the block.
   Factors of ``WINDOW`` words or more are duplicate spans. A window that
   straddles a factor's end can occur elsewhere only if the next factor reaches
   its end: so only windows at factor ends are looked up, and at most
   ``WINDOW - 1`` of them each.
4. A key with more than ``BLOCK`` classes (a phrase that many different
   passages hold) would overload a block. Its classes are keyed anew, window
   by window, which makes every class a single window; counts settle these.

Defined results: null text has no words; texts with fewer than ``WINDOW`` words
are kept; repeated rows are documents of their own, so both go; rows that
share an id are told apart by their text; a null id is an id of its own; the
kept words are joined by one space; extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import common as C

WINDOW = 35
GRAM = 8
BLOCK = 10_000        # classes of a reference block
PIECE = 200_000       # words that one pass of the run search takes
_PLACE = np.uint64((1 << 20) - 1)
TAG = 27              # bits of a text's crc32 that tell rows with one id apart
_NO_ID = -(1 << 63)


def window_runs(h: np.ndarray, first: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """Runs of windows of some texts, given the hashes of their words and the
    place of each text's first word (at most ``2**20`` words together).

    Returns ``(first window, number of windows, key, content hash)``.
    """
    n = len(h)
    if n < window:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    power, inverse = C._powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * power[:n], out=total[1:])
    grams = C.mix((total[gram:] - total[:n - gram + 1]) * inverse[:n - gram + 1])
    least = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    width, step = window - gram + 1, 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[:len(least) - (width - step)], least[width - step:])
    place = (least & _PLACE).astype(np.int64)
    text = np.zeros(n, np.int32)
    inner = first[(first > 0) & (first < n)]
    np.add.at(text, inner, 1)
    text = np.cumsum(text)
    ok = text[:n - window + 1] == text[window - 1:]     # the window lies in one text
    new = np.ones(len(ok), bool)
    new[1:] = (place[1:] != place[:-1]) | ~ok[:-1]
    start = np.flatnonzero(new & ok)
    last = np.flatnonzero(np.concatenate([new[1:] | ~ok[1:], [True]]) & ok)
    end = last + window
    content = C.mix((total[end] - total[start]) * inverse[start] + (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return start, last - start + 1, grams[place[start]], content


def _tag(raw) -> int:
    return zlib.crc32(raw) & ((1 << TAG) - 1)


def runs(docs: DataFrame) -> DataFrame:
    """``key, content, id, at`` of ``docs(id, text)``; ``at`` packs the run's
    first window, its number of windows (5 bits) and the text's tag."""
    def go(batches):
        for b in batches:
            data, offs = C.buffer(b.column("text"))
            ids = np.asarray(b.column("id")).astype(np.int64)
            for i, j in C.groups(offs):
                h, _, _, first = C.words(data, offs[i:j + 1], C.SPACES, lower=False)
                tags = np.array([_tag(data[x:y]) for x, y in zip(offs[i:j], offs[i + 1:j + 1])], np.int64)
                at = 0
                while at < max(len(h), 1):  # pieces overlap by a window less one word
                    start, n, key, content = window_runs(h[at:at + PIECE], first - at)
                    start = start + at
                    row = np.searchsorted(first, start, "right") - 1
                    place = ((start - first[row]) << (5 + TAG)) | (n << TAG) | tags[row]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key.view(np.int64), content.view(np.int64), ids[i + row], place)], names=["key", "content", "id", "at"])
                    if at + PIECE >= len(h):
                        break
                    at += PIECE - WINDOW + 1

    return docs.mapInArrow(go, "key long, content long, id long, at long")


class Reference:
    """Suffix array over the words of some texts (``bodies``), each counted once."""

    def __init__(self, bodies: list[np.ndarray], depth: int):
        self.size = np.array([len(b) for b in bodies], np.int64)
        self.head = np.concatenate([[0], np.cumsum(self.size + 1)])[:-1]
        words = np.unique(np.concatenate(bodies), return_inverse=True)[1]
        s = np.zeros(int((self.size + 1).sum()) + depth + 1, np.int64)  # 0 ends a text
        text = np.repeat(np.arange(len(bodies)), self.size)
        s[np.arange(len(words)) + text] = words + 1
        self.words, n = s, len(s)
        rank, step = s, 1
        while step <= depth:  # ranks of the first ``step`` words are doubled
            key = rank * (int(rank.max()) + 1)
            key[:n - step] += rank[step:]
            rank, step = np.unique(key, return_inverse=True)[1], 2 * step
        self.order = np.argsort(rank, kind="stable")
        self.rank = np.empty(n, np.int64)
        self.rank[self.order] = np.arange(n)
        end = np.flatnonzero(s[:-depth - 1] == 0)
        self.left = np.zeros(n, np.int64)  # words up to the end of the text
        self.left[:n - depth - 1] = end[np.searchsorted(end, np.arange(n - depth - 1))] - np.arange(n - depth - 1)

    def longest(self, at: np.ndarray, most: int | None = None) -> np.ndarray:
        """Words from each place on that also start at another place: the longer
        of the prefixes shared with the two neighbours in suffix order."""
        limit = self.left[at] if most is None else np.minimum(self.left[at], most)
        found = np.zeros(len(at), np.int64)
        for side in (-1, 1):
            r = self.rank[at] + side
            inside = (r >= 0) & (r < len(self.order))
            other = self.order[np.where(inside, r, 0)]
            same = np.flatnonzero(inside & (limit > 0))
            k = 0
            while len(same):
                same = same[self.words[at[same] + k] == self.words[other[same] + k]]
                k += 1
                found[same] = np.maximum(found[same], k)
                same = same[limit[same] > k]
        return found

    def spans(self, of: np.ndarray, window: int = WINDOW):
        """Duplicate spans ``(text, from, to)`` of the texts ``of`` by greedy parsing."""
        out = []
        at, end = self.head[of].copy(), self.head[of] + self.size[of]
        before = at.copy()  # start of the factor before this one
        live = np.arange(len(of))
        while len(live):
            a = at[live]
            b = a + np.maximum(self.longest(a), 1)
            long = b - a >= window
            out.append((live[long], a[long], b[long]))
            # windows from p that straddle the factor end a: before < p < a, p + window <= b
            lo, hi = np.maximum(before[live] + 1, a - window + 1), np.minimum(a - 1, b - window)
            some = np.flatnonzero(hi >= lo)
            n = hi[some] - lo[some] + 1
            p = np.repeat(lo[some], n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            hit = self.longest(p, window) >= window
            who = live[np.repeat(some, n)[hit]]
            out.append((who, p[hit], p[hit] + window))
            before[live], at[live] = a, b
            live = live[b < end[live]]
        who, s, e = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        return of[who], s - self.head[of[who]], e - self.head[of[who]]


def _parse_block(t: pa.Table) -> pa.Table:
    """Spans ``id, tag, s, e`` of the classes with one member in one block."""
    key, m, ids, at = (np.asarray(t.column(c)).astype(np.int64) for c in ("key", "m", "id", "at"))
    bodies = [np.frombuffer(x, np.uint64) for x in t.column("body").to_pylist()]
    ref = Reference(bodies, 2 * WINDOW - GRAM)
    who, s, e = ref.spans(np.flatnonzero(m == 1))
    first, tag = at[who] >> (5 + TAG), at[who] & ((1 << TAG) - 1)
    return pa.table({"id": ids[who], "tag": tag.astype(np.int32), "s": (first + s).astype(np.int32), "e": (first + e).astype(np.int32)})


def _parts(at: str = "at"):
    first = F.shiftright(at, 5 + TAG)
    return first, F.shiftright(at, TAG).bitwiseAND(31), F.col(at).bitwiseAND((1 << TAG) - 1).cast("int")


def _bodies(docs: DataFrame, leads: DataFrame) -> DataFrame:
    """``key, k, m, id, at, body``: word hashes of each lead's run."""
    held = leads.groupBy("id", _parts()[2].alias("tag")).agg(F.collect_list(F.struct("key", "k", "m", "at")).alias("runs"))  # of one text

    def cut_out(batches):
        for b in batches:
            data, offs = C.buffer(b.column("text"))
            ids, tags, found = b.column("id").to_pylist(), b.column("tag").to_pylist(), b.column("runs")
            for r in range(b.num_rows):
                if _tag(data[offs[r]:offs[r + 1]]) != tags[r]:
                    continue  # another row with the same id
                h = C.words(data, offs[r:r + 2], C.SPACES, lower=False)[0]
                mine = found[r].as_py()
                at = np.array([x["at"] for x in mine], np.int64)
                first = at >> (5 + TAG)
                end = first + ((at >> TAG) & 31) + WINDOW - 1
                body = [h[x:y].tobytes() for x, y in zip(first, end)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[c] for x in mine], pa.int64()) for c in ("key", "k", "m")] + [pa.array([ids[r]] * len(mine), pa.int64()), pa.array(at), pa.array(body, pa.binary())],
                    names=["key", "k", "m", "id", "at", "body"])

    return docs.join(held, "id").select("id", "tag", "text", "runs").mapInArrow(cut_out, "key long, k long, m long, id long, at long, body binary").dropDuplicates(["id", "at"])


def _single_windows(bodies: DataFrame) -> DataFrame:
    """Duplicate spans of classes with one member, each window a class of its own."""
    def go(batches):
        for b in batches:
            out: list[list] = [[] for _ in range(5)]
            for m, i, at, body in zip(*(b.column(c).to_pylist() for c in ("m", "id", "at", "body"))):
                first, n = at >> (5 + TAG), (at >> TAG) & 31
                for k in range(n):
                    for c, v in zip(out, (hashlib.blake2b(body[8 * k:8 * (k + WINDOW)], digest_size=16).digest(), m, i, at & ((1 << TAG) - 1), first + k)):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["w", "m", "id", "tag", "s"])

    windows = bodies.select("m", "id", "at", "body").mapInArrow(go, "w binary, m long, id long, tag int, s int")
    often = windows.groupBy("w").agg(F.sum("m").alias("all")).where(F.col("all") > 1).select("w")
    return windows.where("m = 1").join(often, "w").select("id", "tag", "s", (F.col("s") + WINDOW).alias("e"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``id, tag, s, e``: word ranges to remove from ``docs(id, text)`` (they may overlap)."""
    spark = C.prepare(docs.sparkSession)
    every = C.cut(runs(docs))
    shared = C.cut(every.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"))  # written: a hot key of the join can be split
    rows = C.cut(every.join(shared, "key"))
    C.discard(every)
    C.release(spark)
    classes = C.cut(rows.groupBy("key", "content").agg(F.min_by("at", "id").alias("at"), F.min("id").alias("id"), F.count(F.lit(1)).alias("m")))
    first, n, tag = _parts()
    whole = C.cut(rows.join(classes.where("m > 1").select("key", "content"), ["key", "content"])
                  .select("id", tag.alias("tag"), first.cast("int").alias("s"), (first + n + WINDOW - 1).cast("int").alias("e")))
    C.discard(rows)
    C.release(spark)
    many = C.cut(classes.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where("k > 1"))
    leads = C.cut(classes.join(many, "key").drop("content"))
    C.discard(classes)
    bodies = C.cut(_bodies(docs, leads))
    C.discard(leads)
    C.release(spark)
    fit = bodies.where(F.col("k") <= BLOCK)
    blocks = max(1, -(-fit.count() // BLOCK))  # keys are hashes: they spread evenly
    parsed = (fit.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
              .groupBy("block").applyInArrow(_parse_block, "id long, tag int, s int, e int"))
    found = C.cut(parsed.union(_single_windows(bodies.where(F.col("k") > BLOCK))))
    C.discard(bodies)
    C.release(spark)
    return whole.union(found)


def deduplicate(docs: DataFrame) -> DataFrame:
    """``doc_id, kept, n_words, n_removed`` per row; ``kept`` holds the remaining words."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("id"), "text")
    found = C.cut(repeated_spans(keyed).groupBy("id", "tag").agg(F.collect_list(F.struct("s", "e")).alias("spans")))  # of one text
    C.release(docs.sparkSession)
    found = found.select(F.col("id").alias("_id"), F.col("tag").alias("_tag"), "spans")
    tag = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).bitwiseAND((1 << TAG) - 1)
    rows = (docs.join(found, (F.coalesce("doc_id", F.lit(_NO_ID)) == F.col("_id")) & (tag == F.col("_tag")), "left").select("doc_id", "text", "spans"))

    def go(batches):
        for b in batches:
            kept, n, gone = [], [], []
            spans = b.column("spans")
            for r, raw in enumerate(pc.cast(b.column("text"), pa.large_binary()).to_pylist()):
                words = (raw or b"").split()  # bytes.split() takes 0x20 and 0x09 to 0x0D
                n.append(len(words))
                cut = spans[r].values if spans[r].is_valid else None
                if cut is not None:
                    delta = np.zeros(len(words) + 1, np.int64)
                    np.add.at(delta, np.asarray(cut.field("s")), 1)
                    np.add.at(delta, np.asarray(cut.field("e")), -1)
                    stay = np.flatnonzero(np.cumsum(delta)[:-1] == 0)
                    words = [words[x] for x in stay]
                gone.append(n[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(gone, pa.int64())], names=["doc_id", "kept", "n_words", "n_removed"])

    return rows.mapInArrow(go, "doc_id long, kept string, n_words long, n_removed long")


def op11_relative_lz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(C.documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
p AS (SELECT doc_id, words, unnest(generate_series(1, len(words))) AS i FROM w),
s AS (SELECT doc_id, i, words[i] AS word,
             CASE WHEN i + 34 <= len(words) THEN sha256(array_to_string(words[i:i + 34], ' ')) END AS win FROM p),
c AS (SELECT *, CASE WHEN win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 THEN 1 ELSE 0 END AS dup FROM s),
k AS (SELECT doc_id, i, word, max(dup) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM c),
d AS (SELECT doc_id, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM k GROUP BY doc_id)
SELECT w.doc_id, len(w.words)::BIGINT AS n_words, coalesce(d.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(d.kept, '')) AS kept_sha256
FROM w LEFT JOIN d ON w.doc_id = d.doc_id
"""

"""Language-model scoring by context-tree weighting.

Events are the bytes of tokens (lower-cased words, each followed by a space;
then one end of the document). A byte is coded bit by bit; each of the 255
inner nodes of that binary decomposition has its own context tree over the
``DEPTH`` bytes before it in the running text, across words, back to a space
before the document (``running=False`` scores words alone: contexts then begin
at the space before the word). All depths take part: with Krichevsky-Trofimov
block probabilities ``Pe``,

    Pw(node) = (Pe(node) + prod Pw(children)) / 2,   Pw(leaf) = Pe(leaf),

and a bit's probability mixes the estimates along the path with the weights
``Pe / (2 Pw)`` from the root down.

Spark counts words and byte contexts (``running_counts``: context and byte in one
integer) over all training documents in one pass; a task adds up its own sums by
sorting before they are shuffled. Trees that share the two latest context bytes are
weighted together in numpy, in hash groups; the two upper depths have at most
256 x 256 nodes and are weighted from the groups' sums. The result, a
probability for each gram, is broadcast while it has at most ``MOST_GRAMS``
rows, else texts are scored by a join of their distinct grams.

Base counts come from the word table: the ``HEAD`` commonest words are
broadcast (a fixed bound), all others meet their counts in a join; a word that
was not learned has none.

Defined results: null text counts as empty and has only its end; the grams of
held-out documents enter with count 0; with no training document every bit has
probability 1/2; repeated rows stay repeated; a null id is not held out; extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import common as C

DEPTH = 6
HEAD = 1_000_000
MOST_GRAMS = 6_000_000      # of words
MOST_TEXT_GRAMS = 16_000_000  # of running text: 12 bytes each
CACHED = 300_000    # words of a worker's cache (some 160 bytes each)
BATCH = 2_000_000   # bytes of texts whose words are counted at once
SLICE = 1 << 17     # bytes of words whose grams are formed at once
HELD = 250_000      # grams that a task adds up before it passes them on
TEXT_HELD = 3_000_000  # grams, and words, of running text that a task adds up before it passes them on
PIECE = 500_000     # bytes of running text whose grams are formed at once
ROWS = 256          # rows whose grams are sorted at once: a gram has 56 bits, its row the other 8
SORTED = 4_000_000  # grams of running text that are sorted at once to be counted
TREES = 60_000      # grams whose trees are weighted at once (one context of two bytes at least)
END = 0x0A    # no word holds it
SPACE = 0x20
_LN2, _LN10 = float(np.log(2)), float(np.log(10))


def lgamma(x: np.ndarray) -> np.ndarray:
    """log Gamma for x >= 0.5 (Stirling's series after a shift by 8)."""
    shift = np.zeros_like(x, dtype=np.float64)
    for i in range(8):
        shift += np.log(x + i)
    y = x + 8
    return (y - .5) * np.log(y) - y + .5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - 1 / (1680 * y ** 7) - shift


#: log Gamma at whole numbers below ``SMALL`` plus a half, and plus one
SMALL = 4096
_HALF, _ONE = lgamma(np.arange(SMALL) + .5), lgamma(np.arange(SMALL) + 1.0)


def _lgamma_after(n: np.ndarray, table: np.ndarray, more: float) -> np.ndarray:
    """log Gamma of whole numbers ``n`` plus ``more``, by the table while they are small."""
    out = table[np.minimum(n, SMALL - 1).astype(np.int64)]
    large = np.flatnonzero(n >= SMALL)
    out[large] = lgamma(n[large] + more)
    return out


def kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov block probability of n0 zeros and n1 ones."""
    return _lgamma_after(n0, _HALF, .5) + _lgamma_after(n1, _HALF, .5) - np.log(np.pi) - _lgamma_after(n0 + n1, _ONE, 1.0)


#: the end is coded after the space before it
END_GRAM = (SPACE << 8) | END
#: bytes before a document: contexts end at the space
HEAD_BYTES, TAIL_BYTES = bytes(DEPTH - 1) + bytes([SPACE]), bytes([END])


def _nodes(key: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Per gram and bit: node ``context of d bytes << 8 | bit prefix``, and the bit."""
    byte = (key & 255)[:, None]
    j = np.arange(8)
    m = (1 << j) | (byte >> (8 - j))
    context = (key >> 8) & ((1 << (8 * d)) - 1)
    return (context[:, None] << 8) | m, (byte >> (7 - j)) & 1


class Forest:
    """Weighted trees of the grams of some groups, from depth ``low`` down."""

    def __init__(self, key: np.ndarray, n: np.ndarray, low: int):
        self.low, self.key = low, key
        self.at, self.n0, self.n1, self.logw, self.logpe, self.names = {}, {}, {}, {}, {}, {}
        child = None
        for d in range(DEPTH, low - 1, -1):
            node, bit = _nodes(key, d)
            names, at = np.unique(node, return_inverse=True)
            at = at.reshape(node.shape)
            w = np.repeat(n.astype(np.float64), 8)
            ones = np.bincount(at.ravel(), w * bit.ravel(), len(names))
            zeros = np.bincount(at.ravel(), w * (1 - bit.ravel()), len(names))
            logpe = kt(zeros, ones)
            if child is None:
                logw = logpe
            else:
                inner = np.zeros(len(names))
                up = np.zeros(len(child), np.int64)  # each child's parent, by any gram that has both
                up[self.at[d + 1].ravel()] = at.ravel()
                np.add.at(inner, up, child)
                logw = np.logaddexp(logpe, inner) - _LN2
            self.at[d], self.n0[d], self.n1[d], self.logw[d], self.logpe[d], self.names[d] = at, zeros, ones, logw, logpe, names
            child = logw

    def predict(self, upper: "Upper") -> np.ndarray:
        """log10 probability of each gram's byte in its context."""
        _, bit = _nodes(self.key, 0)
        p = None
        for d in range(DEPTH, -1, -1):
            if d >= self.low:
                at = self.at[d]
                n0, n1, share = self.n0[d][at], self.n1[d][at], np.exp(self.logpe[d] - _LN2 - self.logw[d])[at]
            else:
                node = _nodes(self.key, d)[0]
                n0, n1, share = upper.n0[d][node], upper.n1[d][node], upper.share[d][node]
            here = (np.where(bit == 1, n1, n0) + .5) / (n0 + n1 + 1)
            p = here if p is None else share * here + (1 - share) * p
        return np.log(p).sum(1) / _LN10


class Upper:
    """Depths 1 and 0, from the sums of the depth-2 trees: at most 256 x 256 nodes."""

    def __init__(self, node: np.ndarray, n0: np.ndarray, n1: np.ndarray, child: np.ndarray):
        one = [np.zeros(1 << 16) for _ in range(3)]
        for a, v in zip(one, (n0, n1, child)):
            a[node] = v
        z, o, inner = one
        pe = kt(z, o)
        w = np.logaddexp(pe, inner) - _LN2
        fold = lambda v: v.reshape(256, 256).sum(0)  # noqa: E731  over the context byte
        z0, o0, w0 = fold(z), fold(o), fold(w)
        pe0 = kt(z0, o0)
        top = np.logaddexp(pe0, w0) - _LN2
        self.n0, self.n1 = {1: z, 0: z0}, {1: o, 0: o0}
        self.share = {1: np.exp(pe - _LN2 - w), 0: np.exp(pe0 - _LN2 - top)}


def vocabulary(docs: DataFrame) -> DataFrame:
    """``h, word, c`` of all distinct words of ``docs(text, learn)``; ``c`` counts learned occurrences."""
    def go(batches):
        C.in_use("context_tree.vocabulary")
        for b in batches:
            data, offs = C.buffer(b.column("text"))
            learn = np.asarray(b.column("learn")).astype(np.int64)
            for i, j in C.groups(offs, BATCH):
                h, s, e, first = C.words(data, offs[i:j + 1], C.SPACES)
                u, at, inv = np.unique(h, return_index=True, return_inverse=True)
                c = np.bincount(inv, np.repeat(learn[i:j], np.diff(first)), len(u)).astype(np.int64)
                raw = memoryview(C.LOWER[data[offs[i]:offs[j]]])
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array([bytes(raw[x:y]) for x, y in zip(s[at].tolist(), e[at].tolist())], pa.binary()), pa.array(c)],
                                                 names=["h", "word", "c"])

    return (docs.select("text", "learn").mapInArrow(go, "h long, word binary, c long")
            .groupBy("h").agg(F.first("word").alias("word"), F.sum("c").alias("c")))


def grams(words: DataFrame, ends: int) -> DataFrame:
    """``key, n`` over ``words(word, c)`` and the ends of the learned documents."""
    def go(batches):
        C.in_use("context_tree.grams")
        held: list[tuple[np.ndarray, np.ndarray]] = []
        rows = 0

        def flush():
            key, n = (np.concatenate(x) for x in zip(*held))
            u, inv = np.unique(key, return_inverse=True)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(np.bincount(inv, n, len(u)).astype(np.int64))], names=["key", "n"])

        for b in batches:
            word = pa.array(b.column("word"))
            offs = np.frombuffer(word.buffers()[1], np.int32)[word.offset:word.offset + len(word) + 1].astype(np.int64)
            raw = np.frombuffer(word.buffers()[2], np.uint8) if word.buffers()[2] else np.zeros(0, np.uint8)
            c = np.asarray(b.column("c")).astype(np.float64)
            for i, j in C.groups(offs, SLICE):
                key, at = C.word_grams(raw[offs[i]:offs[j]], offs[i:j] - offs[i], offs[i + 1:j + 1] - offs[i], DEPTH)
                u, inv = np.unique(key, return_inverse=True)
                held.append((u, np.bincount(inv, c[i:j][at], len(u))))
                rows += len(u)
                if rows > HELD:
                    yield flush()
                    held.clear()
                    rows = 0
        if held:
            yield flush()

    spark = words.sparkSession
    end = spark.createDataFrame([(END_GRAM, int(ends))], "key long, n long")
    return words.select("word", "c").mapInArrow(go, "key long, n long").union(end).groupBy("key").agg(F.sum("n").alias("n"))


class Tally:
    """Sums by key, distinct keys in order."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.key, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, key: np.ndarray, n: np.ndarray) -> None:
        """Add the sums ``n`` of distinct keys in order."""
        at = np.searchsorted(self.key, key)
        old = at < len(self.key)
        old[old] = self.key[at[old]] == key[old]
        self.n[at[old]] += n[old]
        new = np.flatnonzero(~old)
        place = at[new] + np.arange(len(new))
        rest = np.ones(len(self.key) + len(new), bool)
        rest[place] = False
        for name, more in (("key", key), ("n", n)):
            both = np.empty(len(rest), np.int64)
            both[rest], both[place] = getattr(self, name), more[new]
            setattr(self, name, both)


def _starts(key: np.ndarray) -> np.ndarray:
    """Where each distinct value of sorted keys begins."""
    return np.flatnonzero(np.concatenate([np.ones(min(len(key), 1), bool), key[1:] != key[:-1]]))


def _pieces(offs: np.ndarray):
    """Row ranges of about ``PIECE`` bytes and ``ROWS`` rows at most."""
    for i, j in C.groups(offs, PIECE):
        for k in range(i, j, ROWS):
            yield k, min(k + ROWS, j)


def task_counts(batches):
    """``word, key, n`` of the texts of one task: hashes of learned words, and
    grams of all running text; ``n`` counts learned occurrences."""
    C.in_use("context_tree.counts")
    hashes: list[np.ndarray] = []
    keys: list[np.ndarray] = []  # a gram and whether it was learned
    words, grams = Tally(), Tally()
    rows = 0

    def add():
        h, key = np.concatenate(hashes), np.concatenate(keys)
        hashes.clear()
        keys.clear()
        h.sort()
        start = _starts(h)
        words.add(h[start], np.diff(start, append=len(h)))
        key.sort()
        learned = key & 1
        key >>= 1
        start = _starts(key)
        grams.add(key[start], np.add.reduceat(learned, start) if len(start) else learned)

    def passed_on(t: Tally, word: bool):
        for x in range(0, len(t.key), HELD):
            key, n = t.key[x:x + HELD], t.n[x:x + HELD]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), word)), pa.array(key), pa.array(n)], names=["word", "key", "n"])
        t.clear()

    for b in batches:
        data, offs = C.buffer(b.column("text"))
        learn = np.asarray(b.column("learn")).astype(bool)
        for i, j in C.groups(offs, PIECE):
            h, s, e, first = C.words(data, offs[i:j + 1], C.SPACES)
            hashes.append(h.view(np.int64)[np.repeat(learn[i:j], np.diff(first))])
            text, row, _ = C.running_text(C.LOWER[data[offs[i]:offs[j]]], s, e, first, HEAD_BYTES, TAIL_BYTES)
            weight = np.repeat(learn[i:j], np.diff(row))
            for x, y, key, event in C.running_grams(text, row, DEPTH, DEPTH, PIECE):
                keys.append((key[event] << 1) | weight[x:y][event])
                rows += len(keys[-1])
                if rows > SORTED:
                    add()
                    hashes.append(np.zeros(0, np.int64))
                    rows = 0
            if len(grams.key) > TEXT_HELD:
                yield from passed_on(grams, False)
            if len(words.key) > TEXT_HELD:
                yield from passed_on(words, True)
    if keys:
        add()
    yield from passed_on(words, True)
    yield from passed_on(grams, False)


def running_counts(docs: DataFrame) -> DataFrame:
    """``word, key, n`` over the running text of ``docs(text, learn)``: learned
    words by their hashes, and all grams, ends included; ``n`` counts learned
    occurrences. Tasks have added up their own rows, so these are dealt as they are."""
    return (docs.select("text", "learn").mapInArrow(task_counts, "word boolean, key long, n long")
            .repartition("word", "key").groupBy("word", "key").agg(F.sum("n").alias("n")))


def _portions(t: pa.Table):
    """Grams and counts of one group, some whole contexts of two bytes at a time."""
    key, n = np.asarray(t.column("key")), np.asarray(t.column("n"))
    latest = (key >> 8) & 0xFFFF
    order = np.argsort(latest, kind="stable")
    start = np.flatnonzero(np.diff(latest[order], prepend=-1))
    for i, j in C.groups(np.append(start, len(key)), TREES):
        at = order[start[i]:start[j] if j < len(start) else len(key)]
        yield key[at], n[at]


def probabilities(gram: DataFrame) -> DataFrame:
    """``key, logp``: log10 probability of each gram's byte in its context, over a table ``gram``."""
    spark = gram.sparkSession
    latest = F.shiftright("key", 8).bitwiseAND(F.lit(0xFFFF))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    grouped = gram.withColumn("part", F.pmod(F.xxhash64(latest), F.lit(parts)))

    def lower(t: pa.Table) -> pa.Table:
        return pa.concat_tables([sums_of(*x) for x in _portions(t)])

    def sums_of(key: np.ndarray, n: np.ndarray) -> pa.Table:
        f = Forest(key, n, 2)
        node, at = np.unique(f.names[2] & 0xFFFF, return_inverse=True)
        s = lambda v: np.bincount(at, v, len(node))
        return pa.table({"node": node, "n0": s(f.n0[2]), "n1": s(f.n1[2]), "child": s(f.logw[2])})

    sums = (grouped.groupBy("part").applyInArrow(lower, "node long, n0 double, n1 double, child double")
            .groupBy("node").agg(F.sum("n0"), F.sum("n1"), F.sum("child")).toArrow())  # 65,536 rows at most
    upper = spark.sparkContext.broadcast(Upper(*(np.asarray(sums.column(i)) for i in range(4))))

    def score(t: pa.Table) -> pa.Table:
        return pa.concat_tables([pa.table({"key": key, "logp": Forest(key, n, 2).predict(upper.value)}) for key, n in _portions(t)])

    return grouped.groupBy("part").applyInArrow(score, "key long, logp double")


class WordScores:
    """Scores of distinct words, kept from task to task while they fit."""

    def __init__(self, mark: str, key: np.ndarray, logp: np.ndarray):
        self.mark, self.key, self.logp = mark, key, logp
        self.known: dict[int, float] = {}

    def of(self, h: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Scores of distinct words with hashes ``h`` at byte ranges of ``raw``."""
        names = h.tolist()
        if len(self.known) + len(names) > CACHED:
            self.known.clear()
        new = np.array([i for i, x in enumerate(names) if x not in self.known], np.int64)
        if len(new):
            out = np.zeros(len(new))
            size = np.cumsum(end[new] - start[new] + 1)
            for lo, hi in C.groups(np.concatenate([[0], size]), SLICE):
                k = new[lo:hi]
                key, at = C.word_grams(raw, start[k], end[k], DEPTH)
                out[lo:hi] = np.bincount(at, self.logp[np.searchsorted(self.key, key)], hi - lo)
            self.known.update(zip(h[new].tolist(), out.tolist()))
        return np.fromiter(map(self.known.__getitem__, names), np.float64, len(names))


_LAST: list[WordScores] = []


def word_scores(mark: str, table) -> WordScores:
    C.in_use("context_tree", _LAST.clear)
    if not _LAST or _LAST[0].mark != mark:
        _LAST[:] = [WordScores(mark, *table.value)]
    return _LAST[0]


def _sorted_table(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order with their log10 probabilities (single precision)."""
    t = table.select("key", F.col("logp").cast("float").alias("logp")).orderBy("key").toArrow()
    return np.asarray(t.column("key")), np.asarray(t.column("logp"))


def scores(docs: DataFrame, keep: list[str], running: bool = False) -> DataFrame:
    """Score ``docs(text, learn, *keep)``: ``keep`` columns and ``n_bytes,
    n_tokens, n_known, train_tokens, base_score, score, bits_per_byte``.
    ``running``: contexts reach across words, else they begin with the word."""
    spark = C.prepare(docs.sparkSession)
    sc = spark.sparkContext
    if running:
        counts = C.cut(running_counts(docs))
        words = counts.where("word").select(F.col("key").alias("h"), F.col("n").alias("c"))
    else:
        words = C.cut(vocabulary(docs))
    ends = docs.where("learn").count()
    n, v = words.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    whole = running and v <= HEAD  # no other word was learned
    n, v = n + ends, v + (ends > 0)
    gram = counts.where("not word").select("key", "n") if running else C.cut(grams(words, ends))
    table = C.cut(probabilities(gram))
    small = table.count() <= (MOST_TEXT_GRAMS if running else MOST_GRAMS)
    model = sc.broadcast(_sorted_table(table)) if small else None  # 12 bytes a gram
    end = None if running else table.where(F.col("key") == END_GRAM).first()  # a running text has its own end
    end_score = float(end["logp"]) if end else 0.0
    top = words.where("c > 0").select("h", "c").orderBy(F.desc("c"), "h").limit(HEAD).toArrow()
    hh, cc = np.asarray(top.column("h")).astype(np.int64).view(np.uint64), np.asarray(top.column("c")).astype(np.int64)
    order = np.argsort(hh)
    head = sc.broadcast((hh[order], cc[order]))
    mark = f"{sc.applicationId}-{model._jbroadcast.id()}" if small else ""

    def of_text(low, s, e, first):
        """Scores of rows, or the place, key and number of each row's grams when these are scored by the join."""
        text, begin, _ = C.running_text(low, s, e, first, HEAD_BYTES, TAIL_BYTES)
        own, each = np.zeros(len(first) - 1), []
        of = np.repeat(np.arange(len(own), dtype=np.uint64), np.diff(begin))
        for x, y, key, event in C.running_grams(text, begin, DEPTH, DEPTH, PIECE):
            both = (key[event].view(np.uint64) << np.uint64(8)) | of[x:y][event]  # gram and row
            both.sort()
            at, key = (both & np.uint64(ROWS - 1)).view(np.int64), (both >> np.uint64(8)).view(np.int64)
            start = _starts(key if small else both)
            times = np.diff(start, append=len(both))
            if small:
                value = model.value[1][np.searchsorted(model.value[0], key[start])]
                own += np.bincount(at, np.repeat(value, times), len(own))
            else:
                each.append((at[start], key[start], times))
        return own, each

    def go(batches):
        known, count = head.value
        if running:
            C.in_use("context_tree")
        for b in batches:
            data, offs = C.buffer(b.column("text"))
            row = np.asarray(b.column("_row")).astype(np.int64)
            ids, tails, joined = [], [], []
            for i, j in _pieces(offs) if running else C.groups(offs, 4_000_000):
                h, s, e, first = C.words(data, offs[i:j + 1], C.SPACES)
                low = C.LOWER[data[offs[i]:offs[j]]]
                u, inv = np.unique(h, return_inverse=True)
                p = np.searchsorted(known, u)
                p[p == len(known)] = 0
                common = known[p] == u if len(known) and (small or running) else np.zeros(len(u), bool)
                c = np.where(common, count[p], 0) if len(known) else np.zeros(len(u), np.int64)
                own = np.zeros(len(u))
                if small and not running:
                    at = np.unique(inv, return_index=True)[1]
                    own = word_scores(mark, model).of(u, low, s[at], e[at])
                sums = []
                for x in (np.where(common, np.log10(c + 1.0), 0.0), common.astype(np.float64), own):
                    t = np.concatenate([[0.0], np.cumsum(x[inv])])
                    sums.append(t[first[1:]] - t[first[:-1]])
                if running:
                    sums[2], each = of_text(low, s, e, first)
                    joined += [(row[i:j][a], k, n) for a, k, n in each]
                ids.append((row[i:j], np.diff(offs[i:j + 1]), np.diff(first), *sums))
                if whole:
                    continue
                rare = np.flatnonzero(~common[inv])  # all words when they are scored by the join
                tails.append((np.repeat(row[i:j], np.diff(first))[rare], u[inv[rare]].view(np.int64)))
            for parts, kind in ((ids, 0), (tails, 1), (joined, 2)):
                if not parts:
                    continue
                cols = [np.concatenate(x) for x in zip(*parts)]
                m = len(cols[0])
                null = lambda t: pa.nulls(m, t)
                kept = [b.column(k) if kind == 0 else null(b.column(k).type) for k in carried]
                if kind == 0:
                    out = [pa.array(cols[0]), null(pa.int64()), null(pa.int64()), pa.array(cols[1]), pa.array(cols[2]), pa.array(cols[3]), pa.array(cols[4].astype(np.int64)), pa.array(cols[5])]
                else:
                    times = pa.array(cols[2]) if kind == 2 else null(pa.int64())
                    out = [pa.array(cols[0]), pa.array(cols[1]), times, null(pa.int64()), null(pa.int64()), null(pa.float64()), null(pa.int64()), null(pa.float64())]
                yield pa.RecordBatch.from_arrays(out + kept, names=["_row", "h", "times", "n_bytes", "n_words", "lg", "seen", "own", *carried])

    carried = [f"_k_{k}" for k in keep]
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), "text", *[F.col(k).alias(f"_k_{k}") for k in keep])
    kinds = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name in carried)
    out = C.cut(numbered.mapInArrow(go, "_row long, h long, times long, n_bytes long, n_words long, lg double, seen long, own double" + kinds))
    each = words.select("h", "c")
    by_word = not small and not running
    if by_word:
        each = each.join(_joined_scores(words, table), "h")
    rare = (out.where("h is not null and times is null").select("_row", "h").join(each, "h", "left").groupBy("_row")
            .agg(F.sum(F.log10(F.col("c") + 1.0)).alias("lg2"), F.sum((F.col("c") > 0).cast("long")).alias("seen2"),
                 *([F.sum("word_score").alias("own2")] if by_word else [])))
    found = out.where("h is null").drop("h", "times").join(rare, "_row", "left")
    if running and not small:
        found = found.join(out.where("times is not null").select("_row", F.col("h").alias("key"), "times").join(table, "key")
                           .groupBy("_row").agg(F.sum(F.col("times") * F.col("logp")).alias("own2")), "_row", "left")
    zero = F.lit(0.0)
    return (found
            .select(*[F.col(f"_k_{k}").alias(k) for k in keep], "n_bytes", (F.col("n_words") + 1).alias("n_tokens"),
                    (F.col("seen") + F.coalesce("seen2", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
                    F.lit(n).cast("long").alias("train_tokens"),
                    (F.col("lg") + F.coalesce("lg2", zero) + F.lit(float(np.log10(ends + 1.0)))
                     - (F.col("n_words") + 1) * F.lit(float(np.log10(n + v + 1.0)))).alias("base_score"),
                    (F.col("own") + (zero if small else F.coalesce("own2", zero)) + F.lit(end_score)).alias("score"))
            .withColumn("bits_per_byte", F.try_divide(-F.col("score") * F.lit(float(np.log2(10))), F.col("n_bytes"))))


def _joined_scores(words: DataFrame, table: DataFrame) -> DataFrame:
    """``h, word_score`` when the gram table is too large to broadcast."""
    def go(batches):
        for b in batches:
            raw = [np.frombuffer(w, np.uint8) for w in b.column("word").to_pylist()]
            h = np.asarray(b.column("h"))
            size = np.array([len(x) for x in raw], np.int64)
            end = np.cumsum(size)
            key, at = C.word_grams(np.concatenate(raw) if raw else np.zeros(0, np.uint8), end - size, end, DEPTH)
            yield pa.RecordBatch.from_arrays([pa.array(h[at]), pa.array(key)], names=["h", "key"])

    return (words.select("h", "word").mapInArrow(go, "h long, key long").join(table, "key")
            .groupBy("h").agg(F.sum("logp").alias("word_score")))


def op8_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text", C.held_out("doc_id", 7, 2).alias("held_out"))
    return scores(docs.withColumn("learn", ~F.col("held_out")), ["doc_id", "held_out"], running=True)
